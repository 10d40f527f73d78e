"""Maximal periodic runs of words, by the branching-tandem test on an enhanced suffix array.

Per document: the suffix array of the word ids comes from prefix doubling, whose ranks at each power of two are kept; they
give the LCP array and every later equality test exactly. The LCP intervals are read off the array with a stack and never
stored as nodes. For an interval of depth q, each suffix i of a child that is not the largest looks up ISA[i + q] and
ISA[i - q]: inside the interval but in another child means that a square of period q begins at i (or i - q) and that the word
behind it breaks the period. Rotating such a branching square to the left as far as the words repeat gives the run; all
squares of a run, and those of multiples of its period, meet in one (start, end), where the smallest period stays.

A run of at least 24 words and three periods repeats some 16 words (its length less one period). A document whose 16-word
windows are all different therefore has no run, and its suffix array is not built; the windows are compared by hash, so the
screen lets too many through, never too few.

One document is one unit of work; it takes memory for its words times the logarithm of its longest repeat.

Defined results: null and empty texts have no words, no runs, and the digest of an empty text; a null ``doc_id`` leaves the
words as they are; repeated rows give repeated rows; extra columns are not read. Ties of the greatest exponent go to the
smallest start, then period.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm.common import short_batches, table
from heliolake.llm.words import U, mix, runs as window_hashes

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words that any run repeats: 24 less a period of up to 8, or two periods of more.
REPEATED = 16
#: Suffixes looked up in one go.
PIECE = 1 << 18

Run = tuple[int, int, int]


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal words, equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def may_repeat(ids: np.ndarray) -> bool:
    """False only if all windows of ``REPEATED`` words differ."""
    windows = window_hashes(mix(ids.astype(U) + U(0x9E3779B97F4A7C15)), REPEATED)
    if len(windows) < 2:
        return False
    windows.sort()
    return bool((windows[1:] == windows[:-1]).any())


class SuffixArray:
    """Ranks of the prefixes of 2^k words of all suffixes, the suffix array, its inverse and the LCP array.

    Equal ranks at level k mean equal prefixes of 2^k words; a suffix that ends earlier has a rank of its own.
    """

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        self.levels, length = [rank.astype(np.int32)], 1
        while n and int(rank.max()) < n - 1:
            behind = np.zeros(n, np.int64)
            if length < n:
                behind[:n - length] = rank[length:] + 1
            rank = np.unique(rank * (n + 1) + behind, return_inverse=True)[1].astype(np.int64)
            self.levels.append(rank.astype(np.int32))
            length *= 2
        self.n, self.isa = n, rank
        self.sa = np.empty(n, np.int64)
        self.sa[rank] = np.arange(n)
        self.lcp = np.zeros(n, np.int64)
        if n > 1:
            self.lcp[1:] = self.common(self.sa[:-1], self.sa[1:])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``i`` and ``j`` (different places) have in common."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            same = np.flatnonzero((i < self.n) & (j < self.n))
            same = same[level[i[same]] == level[j[same]]]
            for x in (i, j, out):
                x[same] += 1 << k
        return out

    def common_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the texts before ``i`` and ``j`` (i < j) have in common at their ends."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step, level = 1 << k, self.levels[k]
            same = np.flatnonzero(i >= step)
            same = same[level[i[same] - step] == level[j[same] - step]]
            i[same] -= step
            j[same] -= step
            out[same] += step
        return out

    def smaller_children(self) -> np.ndarray:
        """``(depth, interval first, interval last, child first, child last)`` of every child but the largest of each LCP
        interval of depth 1 or more; a child may be one suffix."""
        out = array("q")
        lcp = self.lcp.tolist()
        lcp.append(0)
        stack: list[tuple[int, int, list[int]]] = []    # depth, first suffix, first suffixes of the later children
        for r in range(1, self.n + 1):
            depth, first = lcp[r], r - 1
            while stack and stack[-1][0] > depth:
                d, first, cuts = stack.pop()
                edges = [first, *cuts, r]
                sizes = [b - a for a, b in zip(edges, edges[1:])]
                largest = sizes.index(max(sizes))
                for c in range(len(sizes)):
                    if c != largest:
                        out.extend((d, first, r - 1, edges[c], edges[c + 1] - 1))
            if depth:
                if stack and stack[-1][0] == depth:
                    stack[-1][2].append(r)
                else:
                    stack.append((depth, first, [r]))
        return np.frombuffer(out, np.int64).reshape(-1, 5) if out else np.empty((0, 5), np.int64)

    def branching_squares(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(start, period)`` of squares that the next word breaks, in bounded portions; periods of which ``LEAST_PERIODS`` fit."""
        children = self.smaller_children()
        children = children[children[:, 0] * LEAST_PERIODS <= self.n]
        sizes = children[:, 4] - children[:, 3] + 1
        ends = np.cumsum(sizes)
        at = 0
        while at < len(children):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
            size = sizes[at:upto]
            q, first, last, child, child_last = (np.repeat(children[at:upto, c], size) for c in range(5))
            i = self.sa[child + np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size)]
            for step in (q, -q):
                j = i + step
                there = np.flatnonzero((j >= 0) & (j < self.n))
                place = self.isa[j[there]]
                ok = (place >= first[there]) & (place <= last[there]) & ((place < child[there]) | (place > child_last[there]))
                there = there[ok]
                yield np.minimum(i[there], j[there]), q[there]
            at = upto


def word_runs(ids: np.ndarray) -> list[Run]:
    """``(start, length, period)`` of all runs, by start, then period."""
    if len(ids) < LEAST_WORDS or not may_repeat(ids):
        return []
    suffixes = SuffixArray(ids)
    least: dict[tuple[int, int], int] = {}
    for start, q in suffixes.branching_squares():
        if not len(start):
            continue
        end = start + 2 * q
        start = start - suffixes.common_before(start, start + q)
        length = end - start
        long = (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * q)
        for a, n, p in zip(start[long].tolist(), length[long].tolist(), q[long].tolist()):
            least[a, n] = min(p, least.get((a, n), p))
    return sorted((a, n, p) for (a, n), p in least.items())


def by_start_and_period(runs: list[Run]) -> list[Run]:
    return sorted(runs, key=lambda r: (r[0], r[2]))


def greatest(runs: list[Run]) -> Run | None:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    best = None
    for r in by_start_and_period(runs):
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for a, n, p in runs:
        edges[a + p] += 1
        edges[a + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's change: in a tenth of the documents the words from some place on repeat with some period."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    times, rest = divmod(n - a, p)
    return words[:a] + unit * times + unit[:rest]


COLUMNS = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
           "runs array<struct<start:long,length:long,period:long>>, collapsed string")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _rows(change, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw")):
                words = raw.as_py().split()          # bytes.split() cuts at ASCII white space and nothing else
                words = change(words, doc_id) if change else words
                found = by_start_and_period(word_runs(word_ids(words)))
                best = greatest(found)
                listed = "".join(f"{a},{n},{p}\n" for a, n, p in found)
                kept = b" ".join(collapsed(words, found))
                out.append((doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
                            [{"start": a, "length": n, "period": p} for a, n, p in found], kept.decode("utf-8", "replace") if texts else None))
            cols = list(zip(*out)) if out else [[]] * 10
            kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [_RUNS, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)],
                                             names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, *, change=None, texts: bool = True) -> DataFrame:
    """Every row of ``docs`` with its runs, the greatest of them, and (``texts``) the text without the repeats.

    ``change(words, doc_id)`` may rewrite the words first.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))
    return rows.mapInArrow(_rows(change, texts), COLUMNS)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: runs of all ``documents`` after the contract's change, and digests of them and of the collapsed words."""
    found = periodic_runs(table(spark, sf_dir, "documents"), change=repeated_tail, texts=False)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
