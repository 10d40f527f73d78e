"""Hilbert-curve sharding: quantise metadata dimensions, order by curve index, cut equal runs.

* Each dimension is quantised to ``2^bits`` cells at its own quantiles, so a value that holds a
  third of the rows takes one cell and the others are still spread. Strings go by their first six bytes after
  the prefix that all values share, as a number, which keeps their order.
* The cell becomes a Hilbert index by folding over the bit levels with one look-up per level in a
  table of the curve's orientations (made below from the Gray-code rule).
* The global rank is an offset per curve cell (at most ``2^(bits * dims)`` cells, whatever the
  input), an offset per hash range inside the cell, and a row number inside that range. So a cell
  holding a third of all rows is sorted by many tasks, without a sampling pass.
* Shards are runs of that order: ``rows`` (counts at most one apart) or ``bytes`` (sizes near equal).

DataFrame functions only. Defined results: null dimensions fall in cell 0, null text counts no
bytes, repeated rows are rows of their own (told apart by nothing, so they follow each other), an empty
table gives an empty result, and extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from heliolake.llm.common import stored, table, text_or_empty

BITS = 5
SHARDS = 40
#: Hash ranges inside one curve cell; each is sorted by itself.
RANGES = 64
ACCURACY = 10_000


def curve_table(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next orientation for ``orientation * 2^dims + cell bits``.

    An orientation is an entry corner ``e`` and a direction ``d``. The digit of a cell is the
    inverse Gray code of its bits seen from there; the orientation inside that cell follows from the digit.
    """
    size = 1 << dims

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x >> by) | (x << (dims - by))) & (size - 1)

    def ungray(g: int) -> int:
        return reduce(lambda a, s: a ^ (g >> s), range(1, dims), g)

    def entry(w: int) -> int:
        k = 2 * ((w - 1) // 2)
        return 0 if w == 0 else k ^ (k >> 1)

    def trailing_ones(w: int) -> int:
        return next(i for i in range(dims + 1) if not (w >> i) & 1)

    def direction(w: int) -> int:
        return 0 if w == 0 else (trailing_ones(w - 1) if w % 2 == 0 else trailing_ones(w)) % dims

    digits, following = [], []
    for state in range(size * dims):
        e, d = divmod(state, dims)
        for bits in range(size):
            w = ungray(turn(bits ^ e, d + 1))
            digits.append(w)
            e2 = e ^ turn(entry(w), dims - (d + 1) % dims)
            following.append(e2 * dims + (d + direction(w) + 1) % dims)
    return digits, following


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Curve index of integer coordinates in ``[0, 2^bits)``; JVM-side fold, one step per bit level."""
    dims = len(cells)
    digits, following = curve_table(dims)
    point = F.array(*[c.cast("int") for c in cells])
    digit_of, next_of = F.array(*map(F.lit, digits)), F.array(*map(F.lit, following))

    def step(acc: Column, level: Column) -> Column:
        corner = F.aggregate(acc["p"], F.lit(0), lambda a, x: a * 2 + F.getbit(x.cast("long"), level).cast("int"))
        at = acc["s"] * (1 << dims) + corner
        return F.struct((acc["h"] * (1 << dims) + F.get(digit_of, at)).alias("h"), F.get(next_of, at).alias("s"),
                        acc["p"].alias("p"))

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("s"), point.alias("p"))
    levels = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(levels, start, step, lambda acc: acc["h"])


def _as_number(df: DataFrame, dims: list[str]) -> dict[str, Column]:
    """Order-preserving numbers of the dimensions (strings: six bytes after the shared prefix)."""
    text = [d for d in dims if isinstance(df.schema[d].dataType, StringType)]
    ends = df.agg(*[f(d).alias(f"{n}_{i}") for i, d in enumerate(text) for n, f in (("a", F.min), ("z", F.max))]).first() if text else None
    out = {}
    for d in dims:
        if d not in text:
            out[d] = F.col(d).cast("double")
            continue
        i = text.index(d)
        a, z = ((ends[f"{n}_{i}"] or "").encode() for n in "az")
        shared = next((k for k, (x, y) in enumerate(zip(a, z)) if x != y), min(len(a), len(z)))
        part = F.rpad(F.hex(F.substring(F.col(d).cast("binary"), shared + 1, 6)), 12, "0")
        out[d] = F.conv(part, 16, 10).cast("double")
    return out


def _cell_of(cuts: Column, number: Column) -> Column:
    return F.coalesce(F.size(F.filter(cuts, lambda c: c < number)), F.lit(0))


def quantised(df: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """Cell of each dimension: how many of its ``2^bits - 1`` distinct quantiles are below the value.

    Two aggregations reach the driver, of ``2 * dims`` strings and ``dims * 2^bits`` numbers.
    """
    numbers = _as_number(df, dims)
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(numbers[d], shares, ACCURACY).alias(str(i)) for i, d in enumerate(dims)]).first()
    out = []
    for i, d in enumerate(dims):
        at = F.array(*[F.lit(float(x)) for x in sorted(set(cuts[i] or []))]).cast("array<double>")
        out.append(_cell_of(at, numbers[d]))
    return out


def hilbert_shards(df: DataFrame, dims: list[str], size: Column, shards: int = SHARDS, law: str = "rows",
                   bits: int = BITS, ties: list[Column] | None = None, ranges: int = RANGES, keep: list[Column] = ()) -> DataFrame:
    """``keep`` columns plus ``hilbert, size, shard, slot`` (slot: place in the shard, gapless from 0).

    ``ties`` order rows inside one curve cell after their hash; rows equal in all of them are interchangeable.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law is 'rows' or 'bytes'")
    cells = quantised(df, dims, bits)
    ties = list(ties or [])
    rows = df.select(*keep, size.cast("long").alias("size"), hilbert_index(cells, bits).alias("hilbert"),
                     *[t.alias(f"_t{i}") for i, t in enumerate(ties)])
    tie_cols = [f"_t{i}" for i in range(len(ties))]
    rows = rows.withColumn("_hash", F.xxhash64(*tie_cols) if tie_cols else F.xxhash64("size"))
    # unsigned order of the hash: its top bits are the range
    rows = rows.withColumn("_range", F.shiftrightunsigned("_hash", 40) % ranges)
    counts = rows.groupBy("hilbert", "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_b"))
    cells_n = counts.groupBy("hilbert").agg(F.sum("_n").alias("_n"), F.sum("_b").alias("_b"))
    before = W.unboundedPreceding, -1
    whole = W.partitionBy().orderBy("hilbert")
    cells_n = cells_n.select("hilbert", *[F.coalesce(F.sum(c).over(whole.rowsBetween(*before)), F.lit(0)).alias(f"_c{c}") for c in ("_n", "_b")],
                             *[F.sum(c).over(W.partitionBy()).alias(f"_all{c}") for c in ("_n", "_b")])
    inside = W.partitionBy("hilbert").orderBy("_range").rowsBetween(*before)
    starts = counts.select("hilbert", "_range", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_r{c}") for c in ("_n", "_b")])
    starts = starts.join(cells_n, "hilbert").select(
        "hilbert", "_range", (F.col("_c_n") + F.col("_r_n")).alias("_start_n"), (F.col("_c_b") + F.col("_r_b")).alias("_start_b"), "_all_n", "_all_b")
    own = W.partitionBy("hilbert", "_range").orderBy("_hash", *tie_cols, "size")
    placed = (rows.withColumn("_i", F.row_number().over(own) - 1)
              .withColumn("_size_before", F.coalesce(F.sum("size").over(own.rowsBetween(*before)), F.lit(0)))
              .join(starts, ["hilbert", "_range"])
              .withColumn("rank", F.col("_start_n") + F.col("_i")))
    kept = [c for c in rows.columns if c not in ("hilbert", "size", "_hash", "_range", *tie_cols)]
    if law == "rows":
        # shard s holds the ranks from ceil(s * n / shards) on
        shard = F.expr(f"rank * {shards} div _all_n")
        first = F.expr(f"({shards} - 1 + shard * _all_n) div {shards}")
        return placed.withColumn("shard", shard).select(*kept, "hilbert", "size", F.col("shard").cast("int").alias("shard"),
                                                        (F.col("rank") - first).cast("long").alias("slot"))
    # a row goes by the middle of its bytes; sizes differ by at most about one document
    middle = F.col("_start_b") + F.col("_size_before") + F.col("size") / 2
    placed = placed.withColumn("shard", F.least(F.floor(middle * shards / F.col("_all_b")), F.lit(shards - 1)).cast("int"))
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("_first")))  # one row per shard
    return placed.join(firsts, "shard").select(*kept, "hilbert", "size", "shard", (F.col("rank") - F.col("_first")).cast("long").alias("slot"))


#: Rows of one file of a shard.
FILE_ROWS = 1 << 20


def write_shards(docs: DataFrame, dims: list[str], path: str, *, size: Column | None = None, shards: int = SHARDS, law: str = "rows", bits: int = BITS, file_rows: int = FILE_ROWS) -> str:
    """Write every row of ``docs`` to a folder per shard, in curve order and in files of ``file_rows`` slots, so that min/max of the
    dimensions prune files. Returns the name of the column that holds the shard: ``shard``, with underscores before it if
    the documents have such a column.

    Rows are numbered and stored first and keep their number, so null and repeated ids and repeated rows come back as they
    were; a shard is written by as many tasks as it has files.
    """
    numbered = docs.select(F.struct("*").alias("_doc"), (size if size is not None else F.lit(1)).cast("long").alias("_size")).withColumn("_row", F.monotonically_increasing_id())
    numbered = stored(numbered, "shard-rows")
    flat = numbered.select("_row", "_size", *[F.col(f"_doc.`{d}`").alias(f"_d{i}") for i, d in enumerate(dims)])
    placed = hilbert_shards(flat, [f"_d{i}" for i in range(len(dims))], F.col("_size"), shards, law, bits, keep=[F.col("_row")], ties=[F.col("_row")])
    rows = numbered.join(placed.select("_row", "shard", "slot"), "_row").withColumn("_file", F.expr(f"slot div {int(file_rows)}"))
    column = "shard"
    while column.lower() in {c.lower() for c in docs.columns}:
        column = "_" + column
    (rows.repartition("shard", "_file").sortWithinPartitions("shard", "slot").select("_doc.*", F.col("shard").alias(column))
     .write.option("maxRecordsPerFile", int(file_rows)).partitionBy(column).parquet(path))
    return column


DIMENSIONS = ["lang", "source", "n_chars"]


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all ``documents`` in 40 shards along the curve through (lang, source, n_chars), by the law ``rows``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", *DIMENSIONS)
    crc = F.crc32(text_or_empty().cast("binary"))
    out = hilbert_shards(docs, DIMENSIONS, F.octet_length(text_or_empty()) + 16, keep=[F.col("doc_id"), crc.alias("text_crc32")],
                         ties=[F.col("doc_id"), crc])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "hilbert")
