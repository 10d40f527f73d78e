"""Records of files of any size, cut by many tasks.

JSON arrays and quoted CSV cannot be cut at line ends: a record's end depends on all that stands before it. Here Spark's text
reader splits files into blocks as usual, and a block into fragments at a separator that no long stretch of such a file
lacks (a closing brace, a line end), so no value ever holds a whole file. Python tasks put the fragments of a block together
again, piece by piece, and cut records with numpy. A JSON file with a longer stretch without a brace (an array of numbers, say) shows
by the bytes that are missing from its fragments, and is read again in fragments between commas.

A file of one block needs one pass. For the others a first pass describes what each block does to the reader's state,
whatever that state is at its beginning: inside or outside a string, by how much the depth changes, at which relative depths
commas stand. Folding these descriptions in the order of the blocks gives the state at the beginning of each block (a small
row), and then all blocks are cut at once. A record that crosses blocks comes as parts, which Spark joins.

Nothing here knows the file's bytes but through Spark's reader, so any file system and codec that Spark reads will do.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from heliolake.session import unique_dir

#: Bytes that are put together before they are looked at.
CHUNK = 1 << 18
#: A record beyond this many bytes is not put together from its parts; it is also what one JSON variant holds at most.
LONGEST = 1 << 27
#: States of blocks that are handed to the tasks at once (some 100 bytes each); files with more are cut in several scans.
MOST_STATES = 1 << 20

#: Fragments at braces beyond this many bytes are not read.
LONGEST_FRAGMENT = 1 << 24
#: Files that are named one by one for the reading between commas; if more need it, all files are read so.
MOST_NAMED = 10_000
#: What Spark's text reader decompresses; such a file's size does not tell whether it ends with a separator.
COMPRESSED = r"\.(gz|bz2|deflate|snappy|lz4|zst|zstd)$"

LINES, ARRAY, OBJECT, CSV = "lines", "array", "object", "csv"
#: (between blocks) a brace has opened the file and its line has not ended, so it may be an object or JSON lines
FIRST = "first"


class State(NamedTuple):
    """The reader at the beginning of a block, and how the block ends."""

    mode: str | None = None
    inside: bool = False          # a string or quoted field
    depth: int = 0
    tail_lines: bool = False      # what follows the block's last cut never ends: take its lines
    separator: bool = False       # (last block) the file ends with a separator


class Item(NamedTuple):
    text: bytes
    starts: bool                  # its first byte is in this block
    ends: bool
    line: bool
    opens: int                    # brackets that open a value of the item itself: more than one is two values


# ---- JSON ----

_ESCAPE = re.compile(rb'\\["\\]')
_MARK = np.zeros(256, bool)
_MARK[list(b'"{}[],\n')] = True
_STEP = np.zeros(256, np.int64)
_STEP[list(b"{[")] = 1
_STEP[list(b"}]")] = -1
_BLANK = b" \t\r\n"


def json_marks(chunk: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Places, bytes and steps in depth of the marks outside strings, and whether the chunk ends inside one.

    A raw line end cannot stand in a JSON string, so it ends a broken one.
    """
    data = np.frombuffer(_ESCAPE.sub(b"..", chunk) if b"\\" in chunk else chunk, np.uint8)
    at = np.flatnonzero(_MARK[data])
    code = data[at]
    if not len(at):
        return at, code, np.empty(0, np.int64), inside
    quotes = np.cumsum(code == 34)
    base = np.maximum.accumulate(np.where(code == 10, quotes, -1))
    odd = ((quotes - np.where(base < 0, int(inside), base)) & 1).astype(bool)
    out = ~odd & (code != 34)
    return at[out], code[out], _STEP[code[out]], bool(odd[-1]) if code[-1] != 10 else False


class JsonBlock:
    """Cuts one block: elements of an array, one object, or lines.

    The first character that is not blank tells: ``[`` begins an array, whose elements end at the commas of depth 1; ``{`` begins
    an object, unless it closes on its line (then the file is JSON lines); anything else is JSON lines. What follows the end of
    the array or object is lines, and so is an element or object that never ends.
    """

    def __init__(self, state: State, first: bool):
        self.mode, self.inside, self.depth = state.mode, state.inside, state.depth
        self.open, self.starts, self.opens, self.cut = [], first, 0, False
        self.head, self.look = b"", 0

    def _close(self, text: bytes, line: bool) -> Item:
        item = Item(b"".join([*self.open, text]), self.starts, True, line, self.opens)
        self.open, self.starts, self.opens, self.cut = [], True, 0, True
        return item

    def feed(self, chunk: bytes) -> Iterator[Item]:
        if self.mode is None:
            chunk = self._decide(chunk)
        if self.mode in (ARRAY, OBJECT):
            at, code, step, self.inside = json_marks(chunk, self.inside)
            depth = self.depth + np.cumsum(step)
            over = np.flatnonzero((step < 0) & (depth <= 0))
            n = int(over[0]) if len(over) else len(at)
            self.depth = int(depth[-1]) if len(depth) else self.depth
            opened = at[:n][(step[:n] > 0) & (depth[:n] == 2)]
            begin = 0
            if self.mode == ARRAY:
                cuts = at[:n][(code[:n] == 44) & (depth[:n] == 1)]
                counts = np.searchsorted(opened, cuts)
                done = 0
                for c, k in zip(cuts.tolist(), counts.tolist()):
                    self.opens += k - done
                    yield self._close(chunk[begin:c], False)
                    begin, done = c + 1, k
                self.opens += len(opened) - done
            if not len(over):
                self.open.append(chunk[begin:])
                return
            end = int(at[n])
            # an object's own bracket belongs to it
            yield self._close(chunk[begin:end + (self.mode == OBJECT)], False)
            self.mode, chunk = LINES, chunk[end + 1:]
        if self.mode == LINES:
            *lines, rest = chunk.split(b"\n")
            for line in lines:
                yield self._close(line, True)
            self.open.append(rest)

    def _decide(self, chunk: bytes) -> bytes:
        """Find the mode; returns the bytes to go on with (none while it is open)."""
        self.head += chunk
        start = self.head.lstrip(_BLANK)
        if not start:
            return b""
        if start[:1] == b"[":
            self.mode, self.depth, chunk = ARRAY, 1, start[1:]
        elif start[:1] == b"{":
            if len(start) < self.look:
                return b""
            self.look = 2 * len(start)
            at, code, step, _ = json_marks(start, False)
            closed = np.flatnonzero((step < 0) & (np.cumsum(step) <= 0))
            line = np.flatnonzero(code == 10)
            if len(closed) and (not len(line) or closed[0] < line[0]):
                self.mode = LINES
            elif len(line):
                self.mode = OBJECT
            else:
                return b""
            chunk = start
        else:
            self.mode, chunk = LINES, start
        self.head = b""
        return chunk

    def settle(self, last: bool) -> Iterator[Item]:
        """Decide at the block's end."""
        self.look = 0
        chunk = self._decide(b"")
        if self.mode is None:
            self.mode, chunk, self.head = LINES if last else OBJECT, self.head.lstrip(_BLANK), b""
        yield from self.feed(chunk)

    def finish(self, state: State, last: bool, alone: bool) -> Iterator[Item]:
        """The open item; ``alone`` is the only block of its file."""
        if self.mode is None:        # blank, or one line that has not closed when last looked at
            yield from self.settle(last)
        if self.mode != LINES and (alone or state.tail_lines):
            text, self.open, self.mode = b"".join(self.open), [], LINES
            yield from self.feed(text)
        yield Item(b"".join(self.open), self.starts, last, self.mode == LINES, self.opens)


class JsonSummary:
    """What a block does from either state: for a start outside and inside a string its end, the change and least of the
    depth, its least before the first line end, and the relative depths of commas."""

    def __init__(self):
        self.now, self.newline = [False, True], False
        self.delta, self.least, self.early, self.commas = [0, 0], [0, 0], [0, 0], [set(), set()]

    def feed(self, chunk: bytes) -> None:
        before = list(self.now)
        for s in (0, 1):
            # both starts soon lead to the same state (at a line end, if not sooner); the marks are then the same, too
            if not s or before[0] != before[1]:
                at, code, step, now = json_marks(chunk, before[s])
            self.now[s] = now
            if len(at):
                depth = self.delta[s] + np.cumsum(step)
                self.least[s] = min(self.least[s], int(depth.min()))
                if not self.newline:
                    ends = np.flatnonzero(code == 10)
                    line = depth[:ends[0]] if len(ends) else depth
                    self.early[s] = min(self.early[s], int(line.min(initial=0)))
                self.commas[s] |= set(np.unique(depth[code == 44]).tolist())
                self.delta[s] = int(depth[-1])
        self.newline = self.newline or b"\n" in chunk

    def row(self) -> dict:
        return {"ends": list(self.now), "delta": self.delta, "least": self.least, "early": self.early, "newline": self.newline, "commas": [sorted(c) for c in self.commas]}


# ---- CSV ----

_QUOTED = re.compile(rb'(?:(?<=[,\n])|\A)"(?:[^"]++|"")*+("|\Z)')
_REST_OF_QUOTED = re.compile(rb'(?:[^"]++|"")*+("|\Z)')


def csv_cuts(chunk: bytes, inside: bool) -> tuple[list[int], bool]:
    """Line ends outside quoted fields, and whether the chunk ends inside one; a quote opens a field only at its beginning."""
    at = 0
    if inside:
        m = _REST_OF_QUOTED.match(chunk)
        if not m[1]:
            return [], True
        at = m.end()
    text, inside = chunk[at:], False
    if b'"' in text:
        outside, done = [], 0
        for m in _QUOTED.finditer(text):
            outside += [text[done:m.start()], b"." * (m.end() - m.start())]
            done, inside = m.end(), not m[1]
        text = b"".join([*outside, text[done:]])
    return (at + np.flatnonzero(np.frombuffer(text, np.uint8) == 10)).tolist(), inside


class CsvBlock:
    def __init__(self, state: State, first: bool):
        self.inside, self.open, self.starts, self.mode, self.depth, self.cut = state.inside, [], first, CSV, 0, False

    def feed(self, chunk: bytes) -> Iterator[Item]:
        cuts, self.inside = csv_cuts(chunk, self.inside)
        begin = 0
        for c in cuts:
            yield Item(b"".join([*self.open, chunk[begin:c]]), self.starts, True, True, 0)
            self.open, self.starts, begin = [], True, c + 1
        self.open.append(chunk[begin:])

    def finish(self, state: State, last: bool, alone: bool) -> Iterator[Item]:
        yield Item(b"".join(self.open), self.starts, last, True, 0)


class CsvSummary:
    def __init__(self):
        self.now = [False, True]

    def feed(self, chunk: bytes) -> None:
        self.now = [csv_cuts(chunk, s)[1] for s in self.now]

    def row(self) -> dict:
        return {"ends": list(self.now), "delta": [0, 0], "least": [0, 0], "early": [0, 0], "newline": False, "commas": [[], []]}


# ---- tasks ----

_KINDS = {"json": (JsonBlock, JsonSummary), "csv": (CsvBlock, CsvSummary)}


def _blocks(batches: Iterator[pa.RecordBatch], separator: bytes) -> Iterator[tuple[tuple[str, int, bool, int], Iterator[bytes]]]:
    """The blocks of a task one after another: (path, block, last, size) and their bytes in chunks, without the separator at
    the very end."""
    def runs():
        for batch in batches:
            if batch.num_rows:
                paths, starts = batch.column("path"), batch.column("block")
                change = pc.or_(pc.not_equal(paths[1:], paths[:-1]), pc.not_equal(starts[1:], starts[:-1]))
                edges = [0, *(np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
                for a, b in zip(edges, edges[1:]):
                    key = (paths[a].as_py(), starts[a].as_py(), batch.column("last")[a].as_py(), batch.column("size")[a].as_py())
                    pieces = pa.LargeListArray.from_arrays(pa.array([0, b - a], pa.int64()), batch.column("value").slice(a, b - a).cast(pa.large_binary()))
                    yield key, pc.binary_join(pieces, pa.scalar(separator, pa.large_binary()))[0].as_py()

    stream = runs()
    ahead = next(stream, None)

    def chunks(key):
        nonlocal ahead
        held, size, begun = [], 0, False
        while ahead is not None and ahead[0] == key:
            if begun:
                held.append(separator)
            begun = True
            held.append(ahead[1])
            size += len(ahead[1]) + 1
            ahead = next(stream, None)
            if size >= CHUNK:
                yield b"".join(held)
                held, size = [], 0
        if held:
            yield b"".join(held)

    while ahead is not None:
        key = ahead[0]
        yield key, chunks(key)


ITEMS = "path string, block long, starts boolean, ends boolean, line boolean, first boolean, opens long, text binary"
_ITEMS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("starts", pa.bool_()), ("ends", pa.bool_()), ("line", pa.bool_()), ("first", pa.bool_()), ("opens", pa.int64()), ("text", pa.binary())])


def _dealt(path: str, scans: int) -> int:
    return zlib.crc32(path.encode()) % scans


def _cut(kind: str, separator: bytes, states, skipped: frozenset[str] = frozenset(), scans: int = 1, scan: int = 0):
    """Items of every block; ``states`` (a broadcast) holds those of files that were summarised. Blocks of ``skipped`` files, and
    of those that another scan cuts, are passed over here, since a filter of the scan would change where Spark splits files."""
    block_kind, _ = _KINDS[kind]

    def batch_of(path: str, start: int, items: list[Item], first: list[bool]) -> pa.RecordBatch:
        text, starts, ends, line, opens = zip(*items)
        n = len(items)
        return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([start] * n, pa.int64()), pa.array(starts, pa.bool_()), pa.array(ends, pa.bool_()),
                                           pa.array(line, pa.bool_()), pa.array(first, pa.bool_()), pa.array(opens, pa.int64()), pa.array(text, pa.binary())], schema=_ITEMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = states.value if states is not None else {}
        for (path, start, last, size), chunks in _blocks(batches, separator):
            if path in skipped or scans > 1 and _dealt(path, scans) != scan:
                for _ in chunks:
                    pass
                continue
            alone = last and start == 0
            state = known.get((path, start)) or State()
            if state.mode is None and start and (path, start) not in known:
                raise RuntimeError(f"block {start} of {path} has not been summarised; do blocks differ between scans?")
            block, seen, first = block_kind(state, start == 0), 0, start == 0
            for chunk in chunks:
                seen += len(chunk)
                items = list(block.feed(chunk))
                if items:
                    yield batch_of(path, start, items, [first] + [False] * (len(items) - 1))
                    first = False
            if not last or state.separator or (alone and seen + 1 == size):
                items = list(block.feed(separator))
            else:
                items = []
            items += block.finish(state, last, alone)
            yield batch_of(path, start, items, [first] + [False] * (len(items) - 1))
    return run


_SUMMARY = pa.schema([("path", pa.string()), ("block", pa.int64()), ("last", pa.bool_()), ("size", pa.int64()), ("bytes", pa.int64()), ("mode", pa.string()), ("cut", pa.bool_()),
                      ("ends", pa.list_(pa.bool_())), ("delta", pa.list_(pa.int64())), ("least", pa.list_(pa.int64())), ("early", pa.list_(pa.int64())), ("newline", pa.bool_()), ("commas", pa.list_(pa.list_(pa.int64())))])
SUMMARIES = ("path string, block long, last boolean, size long, bytes long, mode string, cut boolean, ends array<boolean>, delta array<long>, least array<long>, "
             "early array<long>, newline boolean, commas array<array<long>>")


def _summarise(kind: str, separator: bytes):
    """One row a block: for the first of a file its mode and end, for the others what they do from either state."""
    block_kind, summary_kind = _KINDS[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, start, last, size), chunks in _blocks(batches, separator):
            block = block_kind(State(), True) if start == 0 else summary_kind()
            seen = 0
            for chunk in chunks:
                seen += len(chunk)
                for _ in block.feed(chunk) or ():
                    pass
            if not last:
                for _ in block.feed(separator) or ():
                    pass
            row = {"path": path, "block": start, "last": last, "size": size, "bytes": seen + 1, "mode": None, "cut": False}
            if start == 0:
                mode = block.mode
                if mode is None:
                    for _ in block.settle(last):
                        pass
                    mode = FIRST if block.mode == OBJECT else block.mode
                row |= {"mode": mode, "cut": block.cut, "ends": [block.inside], "delta": [block.depth], "least": [0], "early": [0], "newline": False, "commas": [[]]}
            else:
                row |= block.row()
            yield pa.RecordBatch.from_pylist([row], schema=_SUMMARY)
    return run


STATES = "path string, block long, mode string, inside boolean, depth long, tail_lines boolean, separator boolean, whole boolean"
_STATES = pa.schema([("path", pa.string()), ("block", pa.int64()), ("mode", pa.string()), ("inside", pa.bool_()), ("depth", pa.int64()), ("tail_lines", pa.bool_()),
                     ("separator", pa.bool_()), ("whole", pa.bool_())])


def block_states(t: pa.Table, separator: bytes) -> pa.Table:
    """The states of one file's blocks from their summaries (a row for each 128 MB or so); ``whole``: no byte is missing."""
    rows = t.sort_by("block").to_pylist()
    size, seen = rows[-1]["size"], sum(r["bytes"] for r in rows)
    mode, inside, depth = None, False, 0
    out, last_cut = [], 0
    for i, r in enumerate(rows):
        out.append({"path": r["path"], "block": r["block"], "mode": mode, "inside": inside, "depth": depth, "tail_lines": False, "separator": False, "whole": seen in (size, size + 1)})
        if i == 0:
            mode, inside, depth = r["mode"], r["ends"][0], r["delta"][0]
        elif mode == CSV:
            inside = r["ends"][int(inside)]
        elif mode != LINES:
            s = int(inside)
            if mode == FIRST:
                if depth + r["early"][s] <= 0:       # it closes on its line: JSON lines
                    mode, inside, depth = LINES, False, 0
                    out[i].update(mode=LINES, inside=False, depth=0)
                    continue
                out[i]["mode"] = OBJECT
                if r["newline"]:
                    mode = OBJECT
            if depth + r["least"][s] <= 0:
                mode, inside, depth = LINES, False, 0
            else:
                if mode == ARRAY and 1 - depth in r["commas"][s]:
                    last_cut = i
                inside, depth = r["ends"][s], depth + r["delta"][s]
    out[-1]["separator"] = seen == size
    if mode in (ARRAY, OBJECT) and out[-1]["separator"] and not inside:
        # the separator at the file's very end
        if separator == b"," and mode == ARRAY and depth == 1:
            last_cut = len(out) - 1
        if separator == b"}" and depth == 1:
            mode = LINES
    if mode in (ARRAY, OBJECT, FIRST):      # it never ends: its lines, from the last cut on
        out[last_cut]["tail_lines"] = True
        for row in out[last_cut + 1:]:
            row.update(mode=LINES, inside=False, depth=0)
    return pa.Table.from_pylist(out, schema=_STATES)


# ---- Spark ----

def _bytes(spark: SparkSession, key: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


def _items(spark: SparkSession, fragments: DataFrame, checked: Column, kind: str, separator: str, states: DataFrame, n: int, skipped: list[str]) -> DataFrame:
    """Items of all blocks. The states go to the tasks in one broadcast of at most ``MOST_STATES`` rows (128 TB at the usual
    block size); beyond that bound the files are dealt over several scans with a broadcast each.

    Where Spark splits files depends on which files a scan reads, so the files that were summarised are read by the very scan that
    summarised them; all others have one block.
    """
    items = fragments.where(~checked).mapInArrow(_cut(kind, separator.encode(), None), ITEMS)
    scans = -(-n // MOST_STATES)
    for i in range(scans):
        rows = states.where(F.crc32(F.col("path").cast("binary")) % scans == i).toLocalIterator()
        known = spark.sparkContext.broadcast({(s["path"], s["block"]): State(s["mode"], s["inside"], s["depth"], s["tail_lines"], s["separator"]) for s in rows})
        items = items.unionByName(fragments.where(checked).mapInArrow(_cut(kind, separator.encode(), known, frozenset(skipped), scans, i), ITEMS))
    return items.withColumn("text", F.col("text").cast("string"))


def _joined(items: DataFrame, n: int) -> DataFrame:
    """Whole records: an item's parts belong to the one that began last in the file. A block has two parts at most, so what is
    ordered by file is two rows for each 128 MB; where no file was summarised (``n`` = 0) there are none."""
    columns = ("path", "line", "first", "opens", "text")
    if not n:
        return items.select(*columns)
    parts = items.where("NOT (starts AND ends)")
    # in a block the part that ends an item stands before the one that begins the next
    began = F.max(F.when(F.col("starts"), F.col("block"))).over(Window.partitionBy("path").orderBy("block", "starts").rowsBetween(Window.unboundedPreceding, 0))
    size = F.sum(F.octet_length("text")).over(Window.partitionBy("path", "item"))
    parts = parts.withColumn("item", began).withColumn("size", size).withColumn("text", F.when(F.col("size") <= LONGEST, F.col("text")))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda p: p["text"])
    joined = parts.groupBy("path", "item").agg(F.bool_or("line").alias("line"), F.bool_or("first").alias("first"), F.sum("opens").alias("opens"),
                                               F.when(F.max("size") <= LONGEST, F.array_join(in_order, "")).alias("text"))
    return items.where("starts AND ends").select(*columns).unionByName(joined.select(*columns))


def cut(spark: SparkSession, scan: Callable[[str, int | None, list[str] | None], DataFrame], kind: str) -> DataFrame:
    """Records of all files: ``path, line, first, opens, text`` (``first``: a file's first one; a NULL text: beyond ``LONGEST``).

    ``scan(separator, longest, paths)`` gives the fragments ``value binary, path, block, last, size`` as Spark's text reader does, in its
    order: those of at most ``longest`` bytes, of all files or of the files named. Files that may have several blocks, or lack
    fragments, are summarised first.
    """
    least = min(_bytes(spark, "spark.sql.files.openCostInBytes"), _bytes(spark, "spark.sql.files.maxPartitionBytes"), LONGEST_FRAGMENT)

    def prepared(separator: str, longest: int | None, paths: list[str] | None):
        fragments = scan(separator, longest, paths)
        checked = F.col("size") > least
        if longest is not None:
            checked |= F.col("path").rlike(COMPRESSED)
        path = unique_dir(spark, "block-states")
        folded = fragments.where(checked).mapInArrow(_summarise(kind, separator.encode()), SUMMARIES).groupBy("path")
        folded.applyInArrow(lambda t: block_states(t, separator.encode()), STATES).write.parquet(path)
        states = spark.read.schema(STATES).parquet(path)
        return fragments, checked, kind, separator, states, states.count()

    if kind == "csv":
        now = prepared("\n", None, None)
        return _joined(_items(spark, *now, []), now[-1])
    coarse = prepared("}", LONGEST_FRAGMENT, None)
    states, n = coarse[-2:]
    named = [r["path"] for r in states.where(~F.col("whole") | F.col("path").rlike(COMPRESSED)).select("path").distinct().limit(MOST_NAMED + 1).collect()] if n else []
    if len(named) > MOST_NAMED:
        now = prepared(",", None, None)
        return _joined(_items(spark, *now, []), now[-1])
    items = _items(spark, *coarse, named)
    if named:
        items = items.unionByName(_items(spark, *prepared(",", None, named), []))
    return _joined(items, n)
