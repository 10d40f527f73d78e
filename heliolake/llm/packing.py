"""Vector best-fit packing: residual tokens, document count and attention cost choose the bin.

Documents are tokenised whole in Python tasks, which keep lengths and checksums of the pieces, not
the ids. A document longer than a sequence is cut into full pieces (each its own sequence) and one
shorter first piece. The rest, one piece per document at most, is dealt by hash into groups of about
``GROUP_ROWS`` pieces. Inside a group pieces go in falling order of tokens, each into the open bin
with the smallest weighted residual norm (or the largest weighted dot product) among those where
every capacity still holds. Groups are independent, bounded, and rerun alike when an executor is lost;
one extra bin per group is all that dealing costs.

Defined results: null text is empty and yields one piece with the end id alone; repeated rows are
separate documents; an empty table gives no rows; other columns are not read. A piece that alone
exceeds a capacity other than tokens gets a bin to itself.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm.common import short_batches, stored, table, text_or_empty

END_ID = 2
CAPACITY = 1024
#: Pieces packed together; the groups' number grows with the input.
GROUP_ROWS = 8192
VOCABULARY = "byte_bpe_50k"
#: A word or gap this long goes to the tokenizer whose merging stays fast on long words.
LONG_RUN = re.compile(r"\S{600}|\s{600}")


@dataclass(frozen=True)
class Bins:
    """Capacities of one sequence, and the weights of the dimensions in the choice of a bin."""

    tokens: int = CAPACITY
    documents: int = CAPACITY
    attention: int = CAPACITY * CAPACITY
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    choice: str = "norm"  # or "dot"


@lru_cache(maxsize=2)
def encoders(vocabulary: str):
    """The vocabulary in both libraries; both give the same ids, special strings being ordinary text."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    slow.encode_special_tokens = True
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, slow


def token_ids(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    fast, slow = encoders(vocabulary)
    if LONG_RUN.search(text):
        return slow.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces: full ones, the first one shorter if need be."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = array("I", token_ids(text.as_py(), vocabulary))
                ids.append(END_ID)
                raw = memoryview(np.asarray(ids, "<u4")).cast("B")
                out += [(doc_id, k, a, n, zlib.crc32(raw[4 * a:4 * (a + n)])) for k, (a, n) in enumerate(cut(len(ids), capacity))]
            cols = list(zip(*out)) if out else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_pieces(vocabulary, capacity), PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, bins: Bins) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece and its offset there. Pieces come in falling order of length."""
    n = len(lengths)
    cap = np.array([bins.tokens, bins.documents, bins.attention], float)
    weight = np.array(bins.weights, float)
    residual = np.empty((3, 256))
    open_bins, place, offset = 0, np.empty(n, np.int64), np.empty(n, np.int64)
    for i, length in enumerate(lengths):
        item = np.array([length, 1.0, float(length) * length])
        best = -1
        left = residual[:, :open_bins]
        fits = np.flatnonzero((left[0] >= item[0]) & (left[1] >= item[1]) & (left[2] >= item[2]))
        if len(fits):
            room, part = left[:, fits] / cap[:, None], (item / cap)[:, None]
            if bins.choice == "dot":
                best = fits[int((weight[:, None] * room * part).sum(0).argmax())]
            else:
                best = fits[int((weight[:, None] * (room - part) ** 2).sum(0).argmin())]
        if best < 0:
            if open_bins == residual.shape[1]:
                residual = np.concatenate([residual, np.empty_like(residual)], axis=1)
            best, open_bins = open_bins, open_bins + 1
            residual[:, best] = cap
        place[i], offset[i] = best, bins.tokens - residual[0, best]
        residual[:, best] -= item
    return place, offset


def _pack_group(bins: Bins):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "row"], ascending=[False, True, True], kind="stable")
        place, offset = best_fit(pdf["length"].to_numpy(), bins)
        return pdf.assign(sequence_id=(key[0] << 32) + place, offset=offset)[
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]
    return run


def pack(docs: DataFrame, bins: Bins = Bins(), vocabulary: str = VOCABULARY, group_rows: int = GROUP_ROWS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut_up = stored(pieces(docs, bins.tokens, vocabulary, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    full = F.col("length") == bins.tokens
    rest = cut_up.where(~full)
    groups = max(1, round(rest.count() / group_rows))
    out_schema = PIECE_SCHEMA + ", sequence_id long, offset long"
    packed = (rest.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("g").applyInPandas(_pack_group(bins), out_schema))
    # a full piece is a sequence by itself; negative numbers keep clear of the groups' ones
    alone = cut_up.where(full).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all ``documents`` in sequences of at most 1024 tokens; the other capacities never bind below that."""
    return pack(table(spark, sf_dir, "documents"))
