"""Output codes on held-out rows, periodic runs and source divergences against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from heliolake.llm import divergence, languages, periodic

from .cases import SCHEMA, awkward, awkward_rows, empty, prose, row


# languages

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "re"], "bb": ["sch", "ung", "ein", "der", "ich"], "cc": ["ção", "ñe", "éal", "qui", "oux"],
             "dd": ["при", "вет", "ого", "ста", "ень"], "ee": ["的是", "不了", "在有", "我他", "这中"]}


def tongue(lang, seed, n=30):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_output_codes_on_held_out_rows(spark):
    rows = [row(i, tongue(lang, i), lang) for i in range(600) for lang in [list(SYLLABLES)[i % 5]]]
    rows += [row(1000, None, "aa"), row(1001, "", "aa"), row(1002, "12 -- 3²½!", "bb"), row(1003, "X" * 3, None), row(None, tongue("aa", 7), "aa"), row(1004, tongue("dd", 5) + "\x00", None),
             row(1005, tongue("bb", 3, 60_000), "bb"), row(1, tongue("bb", 1), "bb")]
    # labels of held-out rows must not be learned: these are wrong, and belong to a language that is nowhere else
    rows += [row(i, tongue("aa", i), "only held out") for i in range(5000, 5200) if held_out(i)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = languages.learn(docs)
    assert model.languages == sorted(SYLLABLES)
    got = languages.identify(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in range(600):
        assert by_id[i].held_out == held_out(i) and (by_id[i].lang_pred == list(SYLLABLES)[i % 5] or i == 1)
        assert 0 <= by_id[i].score <= 1
    for i in (1000, 1001, 1002):
        assert tuple(by_id[i])[2:] == ("und", 0.0, None, False)
    assert by_id[1003].lang_pred in SYLLABLES and by_id[1004].lang_pred == "dd" and by_id[1005].lang_pred == "bb"
    assert by_id[None].lang_pred == "aa" and not by_id[None].held_out
    again = languages.identify(docs, languages.learn(docs)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_output_codes_without_or_with_one_language(spark):
    assert languages.identify(empty(spark), languages.learn(empty(spark))).count() == 0
    unlabelled = spark.createDataFrame([row(1, "abc", None), row(2, "def", None)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in languages.identify(unlabelled, languages.learn(unlabelled)).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([row(i, tongue("aa", i), "aa") for i in range(8)] + [row(99, "7", "aa")], SCHEMA)
    assert Counter((r.lang_pred, r.score, r.ambiguous) for r in languages.identify(one, languages.learn(one)).collect()) == {("aa", 1.0, False): 8, ("und", 0.0, False): 1}
    two = spark.createDataFrame([row(i, tongue(x, i), x) for i in range(80) for x in [("aa", "bb")[i % 2]]], SCHEMA)
    assert all(r.lang_pred == ("aa", "bb")[r.doc_id % 2] for r in languages.identify(two, languages.learn(two)).collect())
    assert {r.lang_pred for r in languages.identify(awkward(spark), languages.learn(awkward(spark))).collect()} <= {"en", "de", "fr", "es", "und"}


def test_sample_is_bounded_and_counts_equal_texts_once(spark):
    rows = [row(i, tongue("aa", i % 500), "aa") for i in range(4000)] + [row(10_000 + i, tongue("bb", i), "bb") for i in range(30)]
    sample = languages.training_sample(spark.createDataFrame(rows, SCHEMA), rows=50).collect()
    n = Counter(r.lang for r in sample)
    assert n["aa"] == 50 and 15 <= n["bb"] <= 30
    assert len({(r.lang, r.text) for r in sample}) == len(sample)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 4, 7, 8, 40])
def test_codewords_differ_and_every_bit_splits(k):
    code = languages.codebook(k)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1, 1}
    if k > 1:
        assert (abs(code.sum(0, dtype=int)) < k).all()
        apart = min(int((code[i] != code[j]).sum()) for i in range(k) for j in range(i))
        assert apart >= (1 << (k - 2) if k <= languages.EXHAUSTIVE else code.shape[1] // 5)


def test_a_wrong_bit_is_corrected():
    code = languages.codebook(4)
    model = languages.Codes(["a", "b", "c", "d"], code, np.zeros((1, 7), np.float32), np.stack([np.zeros(7), np.ones(7)]), np.full((4, 7), 1 / 7))
    for i in range(4):
        for b in range(7):
            margins = code[i].astype(float) * 3
            margins[b] *= -1
            assert model.distances(margins[None, :]).argmin() == i


def test_grams_of_pieces_equal_grams_of_whole_texts(monkeypatch):
    texts = [" " + prose(s, n) + " è漢😀 " for s, n in ((1, 3), (2, 60), (3, 400))] + ["a", "", " ab "]

    def counts():
        out = [Counter() for _ in texts]
        for numbers, windows, found in languages.grams(texts):
            at = 0
            for i, n in zip(numbers.tolist(), windows.tolist()):
                out[i].update(found[at:at + n].tolist())
                at += n
        return out
    whole = counts()
    monkeypatch.setattr(languages, "PIECE", 17)
    assert counts() == whole
    assert [sum(c.values()) for c in whole] == [sum(max(0, len(t) - n + 1) for n in languages.ORDERS) for t in texts]


# runs

def brute_runs(s):
    found, n = [], len(s)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and s[i] == s[i + q]:
                i += 1
            length = i - a + q
            part = s[a:a + length]
            if length >= max(24, 3 * q) and not any(part[:-p] == part[p:] for p in range(1, q)):
                found.append((a, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 30)), min_size=1, max_size=5))
def test_runs_equal_brute_force(parts):
    s = [w for unit, times in parts for w in unit * times]
    assert periodic.by_start_and_period(periodic.word_runs(np.array(s))) == brute_runs(s)


@pytest.mark.parametrize("words", [[], [1] * 23, [1] * 24, [1] * 500, [1, 2] * 12, [1, 2] * 11 + [1], list(range(8)) * 3, list(range(9)) * 3, list(range(9)) * 2 + list(range(8)),
                                   ([1] * 30 + [2]) * 4, list(range(400)) * 3, list(range(300)) + list(range(100)) * 4 + list(range(300))])
def test_runs_at_the_limits(words):
    assert periodic.by_start_and_period(periodic.word_runs(np.array(words, int))) == brute_runs(words)


def test_suffix_array_and_lcp():
    for seed in range(20):
        r = random.Random(seed)
        s = [r.randrange(3) for _ in range(r.randrange(1, 60))]
        e = periodic.SuffixArray(np.array(s))
        assert e.sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])

        def common(i, j):
            n = 0
            while max(i, j) + n < len(s) and s[i + n] == s[j + n]:
                n += 1
            return n
        assert e.lcp.tolist()[1:] == [common(e.sa[k - 1], e.sa[k]) for k in range(1, len(s))]


def brute_row(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words) if len(words) < 1500 else periodic.by_start_and_period(periodic.word_runs(periodic.word_ids(words)))
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(a + q <= i < a + n for a, n, q in found)]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def test_periodic_runs_of_awkward_rows(spark):
    rows = awkward_rows() + [row(300 + i, prose(i, 40) + " a b c" * 12 + " " + prose(i + 1, 20)) for i in range(30)] + [row(400, ("x y \x1c z " * 20))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    plain = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = periodic.periodic_runs(docs, change=periodic.repeated_tail).collect()
    assert sorted((tuple(r[c] for c in plain) for r in got), key=str) == sorted((brute_row(r[0], r[1]) for r in rows), key=str)
    assert any(r.n_runs for r in got) and all(len(r.runs) == r.n_runs for r in got)
    assert all(hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 for r in got)
    assert periodic.periodic_runs(empty(spark)).count() == 0
    unchanged = periodic.periodic_runs(spark.createDataFrame([row(1, "k " * 30)], SCHEMA)).first()
    assert tuple(unchanged)[:6] == (1, 1, 0, 30, 1, 30000) and unchanged.collapsed == "k"


# divergence

def brute_divergence(rows):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= 10]
        v = len(kept)
        sources = sorted({d[1] for d in mine})
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= 10) for s in sources}
        whole = sum(count.values(), Counter())
        p = {s: {t: 1 + 10 ** 9 * (count[s][t] + 2) // (sum(count[s].values()) + 2 * v) for t in kept} for s in sources}
        q = {t: 1 + 10 ** 9 * (whole[t] + 2) // (sum(whole.values()) + 2 * v) for t in kept}

        def f(x, y):
            return (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            out += [(lang, s, "pair", o.decode(), -value, i + 1) for i, (value, o) in enumerate(pairs)]
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[s][t] and p[s][t] > q[t])[:10]
            out += [(lang, s, "term", t.decode(), -value, i + 1) for i, (value, t) in enumerate(terms)]
    return out


@pytest.mark.parametrize("cells, held", [(divergence.CELLS, divergence.HELD), (8, 100)])
def test_divergence_equals_brute_force(spark, monkeypatch, cells, held):
    monkeypatch.setattr(divergence, "CELLS", cells)
    r = random.Random(9)
    rows = awkward_rows() + [row(500 + i, " ".join(r.choice(["The", "ÉA", "b1c", "a", "zeta", "日本", "w%d" % r.randrange(6)]) for _ in range(r.randrange(30))), r.choice(["en", "fr", None, ""]),
                                 r.choice(["s1", "s2", "é", None, ""])) for i in range(150)]
    rows += [row(900 + i, None, "xx", f"lonely{i}") for i in range(3)] + [row(950, "K K \x00 [a]", "yy", "s")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = [tuple(x) for x in divergence.divergences(docs).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert sorted(got) == sorted(brute_divergence(rows))
    assert divergence.divergences(empty(spark)).count() == 0


def test_partial_counts_do_not_depend_on_cuts(monkeypatch):
    texts = [prose(i, 50) + " ÉTÉ été" for i in range(40)] + [""]
    batch = pa.record_batch({"lang": ["a", "b"] * 20 + ["a"], "source": ["s", "t", "u"] * 13 + ["s", "z"], "text": texts})

    def sums():
        out = Counter()
        for b in divergence._partial_counts(iter([batch, batch.slice(3, 7)])):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["term"], "n"] += r["n"]
                out[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return +out
    whole = sums()
    monkeypatch.setattr(divergence, "SPLIT_BYTES", 300)
    monkeypatch.setattr(divergence, "HELD", 50)
    assert sums() == whole


def test_rates_are_exact_for_huge_counts():
    r = random.Random(3)
    for total in (1, 7, 10 ** 12 + 9, divergence.MOST_TOTAL):
        c = [r.randrange(0, total) for _ in range(50)]
        assert divergence.rate(np.array(c), total).tolist() == [1 + 10 ** 9 * (x + 2) // total for x in c]
    with pytest.raises(OverflowError):
        divergence.rate(np.array([1]), divergence.MOST_TOTAL + 1)
