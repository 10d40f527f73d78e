"""Exact removal of repeated word windows, with a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document. Every window belongs to the place of its
smallest ``GRAM``-word hash (leftmost on ties), its anchor. Equal windows have equal anchors at equal
places inside them, and windows at different starts that are equal have different anchor places, so an
anchor's count never falls below the count of any window it stands for.

1. Every task counts its anchors in a count-min sketch; the merged sketch overestimates counts.
2. Only windows whose anchor is estimated to occur twice are sent on, grouped exactly: first whole
   runs of windows that share an anchor (equal runs keep their first place only), then, for anchors
   with several different runs, single windows. Keys are two independent 64-bit hashes of the words.
3. What comes back to a document is the list of windows that are first occurrences; all its other
   estimated windows are repeats, and their words are removed.

Nothing is lost by the sketch, whose size is fixed; past its capacity more windows are grouped. A hot passage is
combined before every shuffle to one row per task, and no group is gathered anywhere.

Order of documents: by id, null ids last, rows of one id by the CRC of their text; rows equal in both are
one document, and get the same result. Null text has no words (its kept text is empty); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm import sketch
from heliolake.llm.common import short_batches, stored, table, text_or_empty
from heliolake.llm.words import U, documents, mix, powers, runs

WINDOW = 20
GRAM = 5
DEPTH = 2
#: Bytes of text for one anchor, roughly; only the sketch's width depends on it.
BYTES_AN_ANCHOR = 55
#: Stands for a null id, which comes last.
LAST_ID = (1 << 63) - 1


def anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and for each window start the place of its smallest gram (leftmost on ties)."""
    grams = runs(hashes, gram)
    span = window - gram + 1
    low, at = grams, np.arange(len(grams))
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        left, right = low[:-step], low[step:]
        later = right < left
        at = np.where(later, at[step:], at[:-step])
        low = np.where(later, right, left)
        reach += step
    return grams, at


class Segments:
    """The runs of windows of one document that share an anchor."""

    def __init__(self, hashes: np.ndarray, window: int, gram: int):
        self.n = max(0, len(hashes) - window + 1)
        if not self.n:
            self.first = self.size = np.empty(0, np.int64)
            self.anchor = np.empty(0, U)
            return
        grams, at = anchors(hashes, window, gram)
        self.first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        self.size = np.diff(np.append(self.first, self.n))
        self.anchor = grams[at[self.first]]

    def windows(self, hashes: np.ndarray, window: int) -> np.ndarray:
        return runs(hashes, window, 0xFF51AFD7ED558CCD)


def run_keys(windows: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One hash for each run of window hashes."""
    up, down = powers(0x9FB21C651E98DF25 | 1, len(windows) + 1)
    total = np.concatenate((np.zeros(1, U), np.cumsum(windows * up[:len(windows)], dtype=U)))
    return mix((total[first + size] - total[first]) * down[first] + size.astype(U))


def _anchor_hashes(window: int, gram: int):
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, bounds, words in documents(batch.column("text").to_pylist()):
            for a, b in zip(bounds[:-1], bounds[1:]):
                if b - a >= window:
                    yield Segments(words[a:b], window, gram).anchor
    return hashes


RUN_SCHEMA = "anchor long, run long, doc long, tie int, start int, windows array<long>"


def _estimated_runs(bitmap, window: int, gram: int):
    """Rows of the runs whose anchor is estimated to occur at least twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = bitmap.value
        for batch in batches:
            docs, ties = batch.column("doc").to_pylist(), batch.column("tie").to_pylist()
            for first, bounds, words in documents(batch.column("text").to_pylist()):
                cols: list[list[np.ndarray]] = [[], [], [], [], []]
                payload: list[np.ndarray] = []
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    if b - a < window:
                        continue
                    seg = Segments(words[a:b], window, gram)
                    hit = np.flatnonzero(repeated.holds(seg.anchor))
                    if not len(hit):
                        continue
                    win = seg.windows(words[a:b], window)
                    start, size = seg.first[hit], seg.size[hit]
                    for c, v in zip(cols, (seg.anchor[hit], run_keys(win, start, size), np.full(len(hit), docs[first + i], np.int64),
                                           np.full(len(hit), ties[first + i], np.int32), start)):
                        c.append(v)
                    payload += [win[s:s + m] for s, m in zip(start.tolist(), size.tolist())]
                if payload:
                    x = [np.concatenate(c) for c in cols]
                    ends = np.concatenate(([0], np.cumsum([len(w) for w in payload]))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[0].view(np.int64)), pa.array(x[1].view(np.int64)), pa.array(x[2]), pa.array(x[3]),
                         pa.array(x[4].astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(payload).view(np.int64)))],
                        names=["anchor", "run", "doc", "tie", "start", "windows"])
    return run


RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _kept(bitmap, window: int, gram: int, with_text: bool):
    """Removes from each text the windows that are estimated to repeat and are not a first occurrence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = bitmap.value
        for batch in batches:
            texts, firsts = batch.column("text").to_pylist(), batch.column("firsts").to_pylist()
            out = []
            for first, bounds, hashes in documents(texts):
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    words = texts[first + i].encode("utf-8", "surrogatepass").split()
                    n, removed = int(b - a), 0
                    if n >= window:
                        seg = Segments(hashes[a:b], window, gram)
                        gone = np.repeat(repeated.holds(seg.anchor), seg.size)
                        for s, m in firsts[first + i] or ():
                            gone[s:s + m] = False
                        if gone.any():
                            edge = np.zeros(n + 1, np.int64)
                            edge[:len(gone)] += gone
                            edge[window:window + len(gone)] -= gone
                            cover = np.cumsum(edge)[:n] > 0
                            removed = int(cover.sum())
                            words = list(compress(words, ~cover))
                    kept = b" ".join(words)
                    out.append((n, removed, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if with_text else None))
            cols = list(zip(*out)) if out else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(list(c), t) for c, t in zip(cols, types)]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays[:4 if with_text else 3]], names=names[:5 if with_text else 4])
    return run


def repeated_windows_removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False,
                             id_col: str = "doc_id", text_col: str = "text", log2: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``kept``, the text that stays) for every row."""
    spark = docs.sparkSession
    short_batches(spark)
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
                       (F.crc32(text.cast("binary")) - (1 << 31)).cast("int").alias("tie"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    log2 = log2 or sketch.width(size / BYTES_AN_ANCHOR)
    bitmap = sketch.merged(spark, sketch.sketch(rows.select("text"), _anchor_hashes(window, gram), log2, DEPTH), log2, DEPTH, 2)

    found = rows.select("doc", "tie", "text").mapInArrow(_estimated_runs(bitmap, window, gram), RUN_SCHEMA)
    # one row for each different run: its first place, with the windows it holds
    firsts = stored(found.groupBy("anchor", "run").agg(F.min(F.struct("doc", "tie", "start", "windows")).alias("f"))
                    .select("anchor", "f.*"), "substring-runs")
    # an anchor's single run goes on whole (its key has no window); several runs as single windows, grouped where the join by anchor has put them
    counted = firsts.join(firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "anchor")
    whole = F.col("n") == 1
    windows = (counted.withColumn("m", F.when(whole, F.size("windows")).otherwise(1))
               .select("anchor", "doc", "tie", "start", "m", F.posexplode(F.when(whole, F.array(F.lit(None).cast("long"))).otherwise(F.col("windows"))).alias("at", "win")))
    kept = (windows.groupBy("anchor", "win").agg(F.min(F.struct("doc", "tie", (F.col("start") + F.col("at")).alias("start"), "m")).alias("f")).select("f.*")
            .groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "m")).alias("firsts")))
    final = rows.join(kept, ["doc", "tie"], "left").select("doc_id", "text", F.transform("firsts", lambda f: F.array(f["start"], f["m"])).alias("firsts"))
    return final.mapInArrow(_kept(bitmap, window, gram, with_text), RESULT_SCHEMA + (", kept string" if with_text else ""))


def op5_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: windows of 20 words over every whole text of ``documents``."""
    return repeated_windows_removed(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, r, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
k AS (SELECT doc_id, r, i, array_to_string(w[i:i + 19], ' ') AS x FROM s),
f AS (SELECT r, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS n FROM k),
c AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS i FROM f WHERE n > 1),
p AS (SELECT d.doc_id, d.r, len(d.w) AS n, unnest(range(1, len(d.w) + 1)) AS i, unnest(d.w) AS x FROM d),
t AS (SELECT p.r, count(c.i) AS gone, string_agg(p.x, ' ' ORDER BY p.i) FILTER (c.i IS NULL) AS kept FROM p LEFT JOIN c ON p.r = c.r AND p.i = c.i GROUP BY p.r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(t.gone, 0)::BIGINT AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON d.r = t.r
"""
