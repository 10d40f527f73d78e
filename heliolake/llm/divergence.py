"""How far the sources of a language diverge, from term counts of the whole corpus.

Counting is an Arrow compute pipeline inside ``mapInArrow``: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and a
hash ``group_by`` turn the batches of a task into partial counts of (lang, source, term), which Spark deals out by (lang, term)
and sums. Terms in at least ten documents of their language are kept. The kept counts are then cut into columnar shards: some
terms of one language, dealt by hash, each shard with all of the language's sources. A shard computes the rates of its terms
in every source, its share of every pair's divergence, and its ten best terms a source; shares are summed, and the best of the
shards' best are ranked. A shard's width follows from the number of sources, so a matrix never holds more than ``CELLS`` cells.

Rates are whole numbers, ``1 + floor(10^9 (count + 2) / (N + 2 V))``, divided in steps of three digits, so they are exact for
totals below 9 * 10^15 words; a larger total raises.

Defined results: null text, lang and source are as empty; a text without terms still makes its group occur; a language with one
source has no pairs, one without kept terms has pairs of value 0 and no terms. Repeated rows count again. An empty table gives
no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliolake.llm.common import short_batches, slots, stored, table, text_or_empty

#: Whatever is not a letter A-Z, a-z or beyond ASCII separates terms.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 10
TOP_TERMS = 10
SCALE_STEPS, SCALE_STEP = 3, 1000          # 10^9 in steps whose products stay below 2^63
MOST_TOTAL = (1 << 63) // SCALE_STEP - 1
#: Bytes of text split in one go, and partial counts that a task holds before it merges or sends them.
SPLIT_BYTES = 2 << 20
HELD = 1 << 19
#: Cells of a shard's matrix, and terms of one, at most.
CELLS, MOST_TERMS = 1 << 21, 4096

PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
PARTIAL_SQL = "lang string, source string, term string, n long, docs long"
_SUMS = [("n", "sum"), ("docs", "sum")]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``SPLIT_BYTES`` of text, whole rows each."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SPLIT_BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def term_counts(batch: pa.RecordBatch) -> pa.Table:
    """Partial counts of one batch of (lang, source, text): occurrences and documents of every (lang, source, term).

    The term ``""``, which no text has, counts the group's documents.
    """
    groups = pa.table({"lang": batch.column("lang"), "source": batch.column("source")})
    number = np.arange(batch.num_rows)
    seen = groups.append_column("n", pa.array(np.zeros(batch.num_rows, np.int64))).group_by(["lang", "source"]).aggregate([("n", "count")])
    marks = pa.table({"lang": seen["lang"], "source": seen["source"], "term": pa.array([""] * seen.num_rows, pa.string()),
                      "n": pa.array(np.zeros(seen.num_rows, np.int64)), "docs": seen["n_count"]})
    parts = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=SEPARATORS)
    row, terms = pc.list_parent_indices(parts), pc.list_flatten(parts)
    some = pc.not_equal(terms, "")
    coded = pc.dictionary_encode(pc.filter(terms, some))
    in_docs = pa.table({"row": pc.take(pa.array(number), pc.filter(row, some)), "code": coded.indices}).group_by(["row", "code"]).aggregate([([], "count_all")])
    at = in_docs["row"].combine_chunks()
    found = pa.table({"lang": pc.dictionary_encode(batch.column("lang")).indices.take(at), "source": pc.dictionary_encode(batch.column("source")).indices.take(at),
                      "code": in_docs["code"], "n": in_docs["count_all"]})
    found = found.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ("n", "count")])
    return pa.concat_tables([marks, pa.table({
        "lang": pc.dictionary_encode(batch.column("lang")).dictionary.take(found["lang"]), "source": pc.dictionary_encode(batch.column("source")).dictionary.take(found["source"]),
        "term": coded.dictionary.take(found["code"]), "n": found["n_sum"], "docs": found["n_count"]}).cast(PARTIAL)])


def merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate(_SUMS)
    return pa.table({"lang": t["lang"], "source": t["source"], "term": t["term"], "n": t["n_sum"], "docs": t["docs_sum"]})


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        for part in _slices(batch):
            held.append(term_counts(part))
            rows += held[-1].num_rows
            if rows > HELD:
                held = [merged(held)]
                pa.default_memory_pool().release_unused()
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=1 << 16)
                    held, rows = [], 0
    if held:
        yield from merged(held).to_batches(max_chunksize=1 << 16)


def counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs, lang_docs`` over all documents; the term ``""`` marks the groups that occur.

    The partial counts are dealt by (lang, term) once, which serves their sum and the sum over a language's sources.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], text_or_empty().alias("text"))
    summed = (rows.mapInArrow(_partial_counts, PARTIAL_SQL).repartition("lang", "term")
              .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return summed.withColumn("lang_docs", F.sum("docs").over(Window.partitionBy("lang", "term")))


def rate(count: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(10^9 * (count + 2) / total)`` in 64 bits."""
    if total > MOST_TOTAL:
        raise OverflowError(f"a group of more than {MOST_TOTAL} words")
    whole, rest = np.divmod(count + 2, total)
    for _ in range(SCALE_STEPS):
        whole *= SCALE_STEP
        more, rest = np.divmod(rest * SCALE_STEP, total)
        whole += more
    return 1 + whole


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


SHARE = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])
SHARE_SQL = "lang string, source string, part string, item string, value long"


def shard_shares(t: pa.Table) -> pa.Table:
    """One shard: rows ``lang, shard, source, term, n, total, lang_total``; a null term names a source and its total.

    Gives every pair's share of the divergence (one row for the two directions) and each source's best terms.
    """
    head = t.filter(pc.is_null(t["term"])).sort_by("source")
    body = t.filter(pc.is_valid(t["term"]))
    sources, coded = head["source"].combine_chunks(), pc.dictionary_encode(body["term"].combine_chunks())
    terms = coded.dictionary
    matrix = np.zeros((len(sources), len(terms)), np.int64)
    matrix[pc.index_in(body["source"], sources).to_numpy(), coded.indices.to_numpy()] = body["n"].to_numpy()
    lang, lang_total = head["lang"][0].as_py(), head["lang_total"][0].as_py()
    p = np.stack([rate(row, total) for row, total in zip(matrix, head["total"].to_pylist())]) if len(terms) else matrix
    q = rate(matrix.sum(0), lang_total) if len(terms) else None
    names, words = sources.to_pylist(), np.array(terms.to_pylist(), object)
    utf8 = [w.encode() for w in words]
    out: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}

    def add(source: str, part: str, items: list[str], values: list[int]) -> None:
        for k, v in (("source", [source] * len(items)), ("part", [part] * len(items)), ("item", items), ("value", values)):
            out[k].extend(v)

    for i, name in enumerate(names):
        add(name, "pair", names[i + 1:], apart(p[i], p[i + 1:]).sum(1).tolist())
        if len(terms):
            over = np.flatnonzero((matrix[i] > 0) & (p[i] > q))
            value = apart(p[i][over], q[over])
            if len(over) > TOP_TERMS:       # all that reach the tenth value; ties are told by their bytes
                least = np.partition(value, len(value) - TOP_TERMS)[len(value) - TOP_TERMS]
                over, value = over[value >= least], value[value >= least]
            best = sorted(zip((-value).tolist(), [utf8[j] for j in over], over.tolist()))[:TOP_TERMS]
            add(name, "term", [words[j] for _, _, j in best], [-v for v, _, _ in best])
    return pa.table({"lang": pa.array([lang] * len(out["source"]), pa.string()), **{k: pa.array(v, SHARE.field(k).type) for k, v in out.items()}}).select(SHARE.names)


def divergences(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` for every other source of the language, part ``term`` for the
    ten terms that set the source apart from its language most."""
    all_counts = stored(counts(docs).where((F.col("lang_docs") >= LEAST_DOCS) | (F.col("term") == "")), "divergence-counts")
    kept = all_counts.where("term != ''").select("lang", "term", "source", "n")
    groups = all_counts.where("term = ''").select("lang", "source")
    # V from the distinct terms, N from the counts: small tables of one row a language or group
    vocabulary = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("words"))
    langs = (groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(vocabulary, "lang", "left")
             .select("lang", F.coalesce("v", F.lit(0)).alias("v"), (F.coalesce("words", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("lang_total"), "sources"))
    width = F.greatest(F.lit(1), F.least(F.lit(MOST_TERMS), F.floor(F.lit(CELLS) / F.col("sources"))))
    langs = langs.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("v") / width)).cast("int"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    heads = (groups.join(langs, "lang").join(totals, ["lang", "source"], "left")
             .select("lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
                     (F.coalesce("words", F.lit(0)) + 2 * F.col("v")).alias("total"), "lang_total"))
    # a language may hold most of the rows, so its shard number is joined under as many keys as there are partitions
    salts = slots(docs.sparkSession)
    salted = langs.select("lang", "shards", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    body = (kept.withColumn("salt", F.pmod(F.xxhash64("term", "source"), F.lit(salts)).cast("int")).join(salted, ["lang", "salt"])
            .select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "source", "term", "n", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("lang_total")))
    # read twice below; a shard's shares are few next to its counts
    shares = stored(heads.unionByName(body).groupBy("lang", "shard").applyInArrow(shard_shares, SHARE_SQL), "divergence-shares")
    pair = F.col("part") == "pair"
    # a pair's share stands for both directions
    both = shares.where(pair).select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("d"), "value")
    pairs = (both.groupBy("lang", "d.source", "d.item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = shares.where(~pair).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP_TERMS)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(terms.select("lang", "source", "part", "item", "value", "rank"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: divergences of the sources of each language over all ``documents``."""
    return divergences(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
nl AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2),
tot AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY 1, 2),
ltot AS (SELECT lang, sum(n)::HUGEINT AS total FROM c GROUP BY 1),
p AS (SELECT tot.lang, tot.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (tot.total + 2 * v.v) AS p
      FROM tot JOIN kept ON kept.lang = tot.lang JOIN v ON v.lang = tot.lang LEFT JOIN c ON c.lang = tot.lang AND c.source = tot.source AND c.term = kept.term),
q AS (SELECT nl.lang, nl.term, 1 + (1000000000::HUGEINT * (nl.n + 2)) // (ltot.total + 2 * v.v) AS q FROM nl JOIN ltot USING (lang) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                 coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                           WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q)) // (p.p + q.q) AS value
          FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
