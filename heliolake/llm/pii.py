"""Personal data behind disguises: offset-preserving transducers, detection, spans mapped back.

A text passes three transducers in turn. Each rewrites parts of it and remembers, for every rewritten
part, where it came from:

1. glyphs: full-width and styled letters and digits, digits of other scripts, letters that Unicode names as
   forms of a Latin one, look-alikes of other scripts, invisible characters;
2. ``at`` / ``dot`` disguises, in brackets or as words in an address or number, with any white space around them and any
   number of labels; a bare ``at`` needs evidence that an address follows (``evidence``);
3. spelled digits (three or more in a run; also ``double``, ``triple``, ``plus``);
4. letters that stand for digits (O, o, l, I) in runs of at least as many digits.

The detectors of the plain text then run on the normalised one, and what they find is mapped back
to code points of the source. Spans of the plain text stay; a mapped span is added where it covers
a rewritten part and no plain span of its kind.

Every detector is linear in the text (it starts at ``@``, at a digit run or at ``+``). Null text is
empty, repeated rows are scanned alike, other columns are not read, and an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm.common import short_batches, table, text_or_empty
from heliolake.llm.spans import Span, digest, joined

# fixed values: kinds in their listed order
KINDS = ("email", "ip", "card", "phone")
ORDER = {k: i for i, k in enumerate(KINDS)}

# fixed values: letters of other scripts that look like Latin ones
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S",
    "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ԍ": "G", "Ԍ": "G", "Ӏ": "I", "ь": "b", "п": "n", "ѡ": "w", "ү": "y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V",
    "γ": "y", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ϲ": "c", "ϳ": "j", "Ϲ": "C",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "յ": "j", "զ": "q", "ց": "g",
    "Ꭺ": "A", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮃ": "W", "Ꮓ": "Z",
    "ı": "i", "ɡ": "g", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
# fixed values: spelled digits
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
               "eight": "8", "nine": "9"}

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost, non-overlapping: the local part reaches back from each ``@`` that a domain follows."""
    end = 0
    for m in DOMAIN.finditer(text):
        a = m.start()
        while a > end and text[a - 1] in LOCAL:
            a -= 1
        if a < m.start():
            yield "email", a, m.end()
            end = m.end()


def detect(text: str) -> list[Span]:
    """The base spans of a text."""
    out: list[Span] = list(emails(text)) if "@" in text else []
    if not ANY_DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


class Rewritten:
    """A text after a transducer, with the source place of every rewritten part."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        """``edits``: (start, end, replacement), ascending and apart."""
        parts, at, n = [], 0, 0
        self.out_start, self.out_end, self.src = [], [], []
        for a, b, new in edits:
            parts += [text[at:a], new]
            n += a - at
            self.out_start.append(n)
            n += len(new)
            self.out_end.append(n)
            self.src.append((a, b))
            at = b
        parts.append(text[at:])
        self.text = "".join(parts)

    def _back(self, pos: int, starts: bool) -> int:
        """Source place of a boundary: inside a rewritten part it is that part's start or end."""
        i = bisect_right(self.out_start, pos if starts else pos - 1) - 1
        while starts and i + 1 < len(self.out_start) and self.out_start[i + 1] == pos and self.out_end[i + 1] > pos:
            i += 1
        if i < 0:
            return pos
        if pos < self.out_end[i] or (not starts and pos <= self.out_end[i]):
            return self.src[i][0] if starts else self.src[i][1]
        return self.src[i][1] + pos - self.out_end[i]

    def back(self, start: int, end: int) -> tuple[int, int]:
        return self._back(start, True), self._back(end, False)


#: Characters whose Unicode name calls them a form of one Latin letter (accented letters are letters of their own).
LATIN_FORM = re.compile(r"(?!COMBINING|TAG)(?:.* )?LATIN (?:(?P<case>SMALL|CAPITAL) LETTER (?:SCRIPT |DOTLESS )?|LETTER SMALL CAPITAL )(?P<letter>[A-Z]|ALPHA|IOTA|UPSILON)")


def latin(ch: str) -> str | None:
    m = LATIN_FORM.fullmatch(unicodedata.name(ch, ""))
    return m and (m["letter"][0] if m["case"] == "CAPITAL" else m["letter"][0].lower())


class _Glyphs(dict):
    """Code point -> plain character: digits of any script, compatibility forms, forms of Latin letters, look-alikes; filled as met."""

    def __missing__(self, cp: int) -> int | str:
        ch = chr(cp)
        plain = LOOKALIKES.get(ch)
        if plain is None and cp > 127:
            digit = unicodedata.decimal(ch, None)
            wide = unicodedata.normalize("NFKC", ch)
            plain = str(digit) if digit is not None else wide if len(wide) == 1 and wide.isascii() else latin(ch)
        self[cp] = value = cp if plain is None else plain
        return value


GLYPHS = _Glyphs()
INVISIBLE = re.compile("[\u00ad\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u2069\ufe00-\ufe0f\ufeff\U000e0000-\U000e007f]")


def odd(text: str) -> bool:
    """Whether ``glyphs`` changes the text: told by its different characters, whatever stands beside them."""
    return not text.isascii() and any(GLYPHS[ord(c)] != ord(c) or INVISIBLE.match(c) for c in set(text))


def glyphs(text: str) -> Rewritten:
    return Rewritten(text.translate(GLYPHS), [(m.start(), m.end(), "") for m in INVISIBLE.finditer(text)])


# fixed values: last labels that speak for an address
LAST_LABELS = frozenset(
    "com org net edu gov info biz io co dev app me eu uk de fr es it nl ch at pl se no dk fi pt us ca au nz in jp cn kr br mx ru".split())
# fixed values: words that speak for an address before it, and against one behind a bare "at"
CUES = frozenset("email e-mail mail mailto contact write reach address adresse courriel schreib correo".split())
AGAINST = frozenset("the a an this that these those each every all any some my our your his her its their least last first most".split())
ENOUGH = 2

MARK = re.compile(r"[\[({<]\s*(?P<inside>at|@|dot|\.)\s*[\])}>]|\b(?P<bare>at|dot)\b", re.I)
LABEL = re.compile(r"[A-Za-z0-9-]+")
LETTERS = re.compile(r"[A-Za-z]{2,}")
DISGUISED = re.compile(r"\bdot\b|[\[({<]\s*(?:at|@|\.)\s*[\])}>]", re.I)


class Mark(NamedTuple):
    """A written-out ``@`` or ``.`` with the white space around it."""
    start: int
    end: int
    sign: str
    bare: bool


def _identifier(ch: str) -> bool:
    return ch.isascii() and ch.isalnum()


def marks(text: str) -> list[Mark]:
    """All that can stand for ``@`` or ``.``: dots between two letters or digits, bracketed ``at`` anywhere, bare ``at`` behind a letter or digit."""
    out: list[Mark] = []
    for m in MARK.finditer(text):
        a, b, bare = m.start(), m.end(), m["bare"] is not None
        least = out[-1].end if out else 0
        while a > least and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        if bare and (a == m.start() or b == m.end()):
            continue
        sign = "@" if (m["bare"] or m["inside"]).lower() in ("at", "@") else "."
        before = a > 0 and _identifier(text[a - 1])
        if (before and b < len(text) and _identifier(text[b])) if sign == "." else (before or not bare):
            out.append(Mark(a, b, sign, bare))
    return out


def evidence(text: str, at: Mark, dots: list[Mark], end: int) -> int:
    """What speaks for an address at a bare ``at`` whose labels are joined by ``dots`` and end at ``end``; ``ENOUGH`` is enough.

    Two for a common last label, a bracketed dot or a cue before the name; one for any last label of letters, for a name
    with a digit or joint, and for the end of a clause behind; three against for a word that starts a plain phrase.
    """
    last, first = text[dots[-1].end:end], LABEL.match(text, at.end)[0].lower()
    if not LETTERS.fullmatch(last):
        return 0
    a = at.start
    while a > 0 and text[a - 1] in LOCAL:
        a -= 1
    name = text[a:at.start]
    word = b = a
    while b > 0 and (text[b - 1].isspace() or text[b - 1] in ":<("):
        b -= 1
    word = b
    while word > 0 and (text[word - 1].isalpha() or text[word - 1] == "-"):
        word -= 1
    cued = ":" in text[b:a] or "<" in text[b:a] or text[word:b].lower() in CUES
    closes = end == len(text) or text[end] in ".,;:!?)>]}\"'\n"
    return (2 * (last.lower() in LAST_LABELS) + 2 * any(not d.bare for d in dots) + 2 * cued + 1
            + any(not c.isalpha() for c in name) + closes - 3 * (first in AGAINST))


def addresses(text: str) -> Rewritten:
    """Marks become signs; a bare ``at`` only before labels that marks join, with evidence for an address."""
    found = marks(text)
    edits = []
    for i, mark in enumerate(found):
        if mark.sign == "@" and mark.bare:
            j, label = i + 1, LABEL.match(text, mark.end)
            while label and j < len(found) and found[j].sign == "." and found[j].start == label.end():
                label = LABEL.match(text, found[j].end)
                j += 1
            if j == i + 1 or evidence(text, mark, found[i + 1:j], label.end()) < ENOUGH:
                continue
        edits.append((mark.start, mark.end, mark.sign))
    return Rewritten(text, edits)


_DIGIT = "(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
RUN = re.compile(rf"(?:\bplus[\s-]+)?\b(?:(?:(?:double|triple)[\s-]+)?{_DIGIT}\b|[0-9]+)(?:[\s,.-]{{1,3}}(?:(?:(?:double|triple)[\s-]+)?{_DIGIT}\b|[0-9]+))+", re.I)
PIECE = re.compile(rf"(?P<plus>plus[\s-]+)|(?:(?P<times>double|triple)[\s-]+)?(?P<digit>{_DIGIT})\b|(?P<gap>[\s,-]+)", re.I)
SPELLED = re.compile(rf"\b{_DIGIT}\b", re.I)


def spelled(text: str) -> bool:
    """Whether the text has three spelled digits, which a rewritten run has at least."""
    return next(islice(SPELLED.finditer(text), 2, None), None) is not None


def numerals(text: str) -> Rewritten:
    edits = []
    for run in RUN.finditer(text):
        pieces = list(PIECE.finditer(text, run.start(), run.end()))
        if sum(bool(p["digit"]) for p in pieces) < 3:
            continue
        for p in pieces:
            times = {"double": 2, "triple": 3}.get((p["times"] or "").lower(), 1)
            edits.append((p.start(), p.end(), "+" if p["plus"] else DIGIT_WORDS[p["digit"].lower()] * times if p["digit"] else ""))
    return Rewritten(text, edits)


RUN_OF_DIGITS = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OolI][0-9OolI\x20().-]*[0-9OolI](?![A-Za-z0-9])")
LETTER_FOR_DIGIT = {"O": "0", "o": "0", "l": "1", "I": "1"}
MIXED = re.compile(r"[0-9][\x20().-]*[OolI]|[OolI][\x20().-]*[0-9]")


def misread(text: str) -> Rewritten:
    edits = []
    for run in RUN_OF_DIGITS.finditer(text):
        letters = [(i, i + 1, LETTER_FOR_DIGIT[c]) for i, c in enumerate(run[0], run.start()) if c in LETTER_FOR_DIGIT]
        if letters and len(letters) <= sum("0" <= c <= "9" for c in run[0]):
            edits += letters
    return Rewritten(text, edits)


#: (signal, transducer): a transducer runs where its signal holds; the signal holds wherever the transducer changes anything.
TRANSDUCERS: tuple[tuple[Callable[[str], object], Callable[[str], Rewritten]], ...] = (
    (odd, glyphs), (DISGUISED.search, addresses), (spelled, numerals), (MIXED.search, misread))


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the normalised text shows, in code points of the source."""
    steps, now = [], text
    for signal, transduce in TRANSDUCERS:
        if signal(now):
            steps.append(transduce(now))
            now = steps[-1].text
    if not steps or now == text:
        return []
    out = []
    for kind, a, b in detect(now):
        found = now[a:b]
        for step in reversed(steps):
            a, b = step.back(a, b)
        if text[a:b] != found and not any(k == kind and s < b and a < e for k, s, e in base):
            out.append((kind, a, b))
    return out


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_disguised long, n_spans long, found array<struct<kind:string,start:long,end:long,disguised:boolean>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disguised", pa.bool_())]))
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            t = text.as_py()
            base = detect(t)
            more = disguised(t, base)
            n = Counter(k for k, *_ in base)
            rows.append([n[k] for k in KINDS] + [digest(base, ORDER), joined(base + more, ORDER), len(more), len(base) + len(more),
                        [{"kind": k, "start": a, "end": b, "disguised": i >= len(base)} for i, (k, a, b) in enumerate(base + more)]])
        columns = list(zip(*rows)) if rows else [[]] * 9
        types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), pa.int64(), found_type]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(list(c), t) for c, t in zip(columns, types)]],
                                         names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_disguised", "n_spans", "found"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: base counts and digest, all spans, and ``found`` with each span's kind and place."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_scan, SCHEMA)


def op4_disguised_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: personal data, plain and disguised, in every whole text of ``documents``."""
    return personal_data(table(spark, sf_dir, "documents")).drop("found")
