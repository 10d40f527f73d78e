"""Mixing sources to target weights: hash-random keys, prefix sums, a cut at each exact budget.

Every document gets a random key, the MD5 of its id, text and a seed. Within a source the rows are
dealt to ``ranges`` key ranges and sorted by key inside each; a prefix sum over the small
``(source, range)`` table gives each range its start. The cut is at the exact budget, so one
document of a source may be taken in part. A budget above the source's size takes whole epochs first.

Because keys are hash-random, a source holding a third of all rows is spread evenly over its
ranges: no task holds a whole source, no row is sampled, and a rerun takes the same words.

Defined results: null source is a source of its own (last in order); null text has size 0; repeated
rows are separate rows with the same key, taken one after the other; an empty table gives an empty
result; columns of the input that clash with the ones made here are not read beyond id, text and source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliolake.llm.common import WORD, stored, table

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Key ranges of one source; each is sorted by itself (2^20 rows a range serve 4e9 rows a source).
RANGES = 4096


def words(col: Column) -> Column:
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size)`` -> also ``target``: the total shared by weight, none above its cap.

    The excess of capped sources is reshared by weight until none is above: sources are ordered by
    cap / weight, a prefix of them is capped, the others share what is left. The table has one row
    per source, so one task orders it.
    """
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.partitionBy().orderBy(F.col("source").isNull(), "source")
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.col("_rank") - 1) % n + 1).cast("int"))
    by_ratio = W.partitionBy().orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    df = (sizes.withColumn("_rank", F.row_number().over(order)).withColumn("_w", w)
          .withColumn("_cap", F.col("source_size") * most_epochs)
          .withColumn("_total", F.sum("source_size").over(everything))
          .withColumn("_all_w", F.sum("_w").over(everything))
          .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
          .withColumn("_w_before", F.coalesce(F.sum("_w").over(before), F.lit(0))))
    # words per unit of weight if all sources before this one are capped; this one is capped too if it gets more
    df = df.withColumn("_level", (F.col("_total") - F.col("_cap_before")) / (F.col("_all_w") - F.col("_w_before")))
    df = df.withColumn("_capped", F.col("_level") * F.col("_w") > F.col("_cap"))
    level = F.min(F.when(~F.col("_capped"), F.struct(F.col("_w_before").alias("b"), F.col("_level").alias("v")))).over(everything)
    return df.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap").cast("double"))
                     .otherwise(level["v"] * F.col("_w")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: int = 0, ranges: int = RANGES,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row with ``size, source_size, target, taken``; ``taken`` counts repeats of whole epochs.

    Returns ``doc_id, size, source, source_size, target, taken`` (and the sort key ``mix_key``).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       words(F.col(text_col)).alias("size"),
                       F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                                         F.md5(text))).alias("mix_key"))
    rows = stored(rows.withColumn("_range", (F.conv(F.substring("mix_key", 1, 6), 16, 10).cast("long") % ranges)), "mix-rows")
    same_source = F.col("s.source").eqNullSafe(F.col("r.source"))
    ranged = rows.groupBy("source", "_range").agg(F.sum("size").alias("_in_range"))
    starts = ranged.withColumn("_start", F.coalesce(F.sum("_in_range").over(
        W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    targets = source_targets(ranged.groupBy("source").agg(F.sum("_in_range").alias("source_size")), weights, most_epochs)
    plan = (starts.alias("r").join(targets.alias("s"), same_source)
            .select("r.source", "_range", "_start", "source_size", "target"))
    within = W.partitionBy("source", "_range").orderBy("mix_key", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    p, q = placed.alias("p"), plan.alias("q")
    out = p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p._range") == F.col("q._range")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("_start") - F.col("_before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return out.select("doc_id", "size", F.col("p.source").alias("source"), "source_size", "target",
                      taken.cast("long").alias("taken"), "mix_key")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: int = 0) -> DataFrame:
    """The documents of the mix as rows: one per epoch, the one at the cut if at least half of it fits.

    Documents without words (null, empty or blank) cost nothing: they stay, once, or once per whole epoch of their source.

    Keeps the columns of ``docs``. The decision joins on id, source and the text's hash, so repeated
    rows (which get the same decisions in the same numbers) stay apart from other rows of that id.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("_doc"), F.col("source").alias("_source"), F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))).alias("_key"))
    plan = mix(docs, weights, most_epochs, seed)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(F.lit(1))
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.greatest(F.lit(1), epochs)).cast("int")
    # repeated rows share a key: their copies are dealt out over them as one number
    plan = (plan.withColumn("_copies", copies).groupBy("source", "mix_key")
            .agg(F.sum("_copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")).where("_copies > 0"))
    joined = keyed.join(plan, (F.col("_key") == F.col("mix_key")) & F.col("_source").eqNullSafe(F.col("source")))
    single = joined.where("_rows = 1").withColumn("_n", F.col("_copies"))
    # by the rest of their columns, so that reruns agree
    own = F.row_number().over(W.partitionBy("_key", "_source").orderBy(F.xxhash64(F.to_json("_doc")), F.to_json("_doc")))
    several = joined.where("_rows > 1").withColumn("_n", F.expr("_copies div _rows") + (own <= F.col("_copies") % F.col("_rows")).cast("int"))
    both = single.select("_doc", F.col("_n").cast("int")).unionByName(several.select("_doc", F.col("_n").cast("int")))
    return both.where("_n > 0").select("_doc", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_doc.*")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: the whole of ``documents`` mixed by the weights 5, 2, 1, at most 3 epochs."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, source_size * 3 AS cap FROM r),
c AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
  coalesce(sum(cap) OVER b, 0) AS cap_before, coalesce(sum(w) OVER b, 0) AS w_before FROM w
  WINDOW b AS (ORDER BY cap::DOUBLE / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, (total - cap_before)::DOUBLE / (all_w - w_before)::DOUBLE AS level FROM c),
x AS (SELECT *, level * w > cap AS capped FROM v),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE (SELECT arg_min(level, w_before) FROM x WHERE NOT capped) * w END AS target FROM x),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY (('0x' || substr(k, 1, 6))::BIGINT % 4096), k, doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT p.doc_id, p.size, p.source, t.source_size, t.target,
  (CASE WHEN t.source_size > 0 THEN (floor(t.target)::BIGINT // t.source_size) * p.size + greatest(0, least(p.size,
     floor(t.target)::BIGINT - (floor(t.target)::BIGINT // t.source_size) * t.source_size - p.before)) ELSE 0 END)::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""
