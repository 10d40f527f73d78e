"""Exact n-gram Jaccard self-join by prefix filters under several global token orders.

A document's set is its distinct word n-grams (hashed to 64 bits). If two sets reach the similarity,
then under *any* global order of the tokens their prefixes (the first ``n - ceil(s n) + 1`` tokens) share
a token. Three orders are used:

* order 1 puts rare tokens first, by levels of frequency from a corpus-wide sketch, and goes by hash within a level. An
  inverted index over these prefixes yields the candidates; frequent passages stay out of it unless a set
  consists of little else. A pair must fit in size and share enough of these tokens: all common tokens up to the
  prefix end that comes first are counted, and what lies beyond it is at most the rest of that set;
* orders 2 and 3 go by two other hashes. A candidate pair must also share a prefix token under each of them;
  only then are whole sets moved and compared.

Equal sets are one node from the start. An index entry with up to ``SHORT`` sets gives its pairs. A longer one comes
from a large group of near copies (its sets are frequent tokens mostly), and is joined by differences instead: a hub
is chosen, the member with the most frequent tokens, and a member x is kept as D(x), the tokens that it or the hub has
alone. With r(x) hub tokens missing, two members share ``n(hub) - r(x) - r(y) + |D(x) & D(y)|`` tokens. So a pair is either
similar whatever D holds, and then both are linked to the member that needs least (the condition is a sum of two
numbers), or it must share k >= 1 tokens of D, and a prefix filter over D, the tokens of fewest members first, finds it. Members are dealt to
bands of what they need, so that k is known when prefixes are cut. No group is capped, sampled or gathered.

Node ids are 64-bit hashes of whole sets (two different sets of a corpus of N share one with probability N^2 / 2^65).

Defined results: null or empty text has an empty set and links with nothing; with fewer words than n
the whole sequence is one token; a null id never names a component unless it is alone; repeated rows are equal
sets; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm import sketch
from heliolake.llm.common import WORD, short_batches, stored, table, text_or_empty
from heliolake.llm.components import components
from heliolake.llm.words import U, documents, mix, powers, runs

NGRAM = 5
PERCENT = 80
#: Sets that hold a token from which on it counts as more frequent, besides twice the sketch's own load.
FREQUENT = (4, 16, 64, 256, 1024, 4096, 16384)
#: log2 of the sketch's cells, at most; its levels are 32 MB then.
MOST_CELLS = 26
#: Sets of an index entry up to which all its pairs are candidates at once.
SHORT = 64
_ORDER2, _ORDER3 = U(0x2545F4914F6CDD1D), U(0x6A09E667F3BCC909)


def token_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct tokens of a document."""
    if not len(words):
        return np.empty(0, U)
    if len(words) < n:
        return runs(words, len(words), 0x94D049BB133111EB + 2 * len(words))
    return np.unique(runs(words, n))


def node_id(tokens: np.ndarray) -> int:
    up, _ = powers(0xD6E8FEB86659FD93, len(tokens) + 1)
    return int(mix(np.array([np.sum(tokens * up[:len(tokens)], dtype=U) + U(len(tokens))], U)).view(np.int64)[0])


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, bounds, words in documents(batch.column("text").to_pylist(), fold=True):
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            yield first + i, token_set(words[a:b], n)


NODE_SCHEMA = "doc_id long, text_hash string, n long, node long, " + sketch.SCHEMA


def _nodes_and_counts(n: int, log2: int):
    """One row per document with its set's size and node, and sketch rows of the tokens of all sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = sketch.Counter(log2, 1)

        def sketched(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
            part = sketch.as_batch(rows)
            empty = pa.nulls(part.num_rows, pa.int64())
            return pa.RecordBatch.from_arrays([empty, pa.nulls(part.num_rows, pa.string()), empty, empty, *part.columns], names=["doc_id", "text_hash", "n", "node", *part.schema.names])

        for batch in batches:
            sizes, nodes, more = [], [], []
            for _, tokens in _sets(batch, n):
                sizes.append(len(tokens))
                nodes.append(node_id(tokens) if len(tokens) else None)
                more += counter.add(tokens)
            k = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary())],
                names=["doc_id", "text_hash", "n", "node", "block", "cells", "counts"])
            if more:
                yield sketched(more)
        yield sketched(list(counter.flush()))
    return run


def ordered_prefix(tokens: np.ndarray, frequency: sketch.Levels, percent: int) -> tuple[np.ndarray, int]:
    """Prefix under order 1 (by level of frequency, then by hash), and the level of its last token."""
    level = frequency.of(tokens)
    order = np.argsort(level, kind="stable")[:prefix_size(len(tokens), percent)]
    return tokens[order], int(level[order[-1]])


def hashed_prefix(tokens: np.ndarray, order: U, percent: int) -> np.ndarray:
    """Prefix under an order by another hash."""
    p = prefix_size(len(tokens), percent)
    keys = mix(tokens ^ order)
    return tokens[np.argpartition(keys, p - 1)[:p]] if p < len(tokens) else tokens


PREFIX_SCHEMA = "node long, n int, level int, last long, p1 array<long>"


def _longs(arrays) -> pa.Array:
    return pa.array([x.view(np.int64) for x in arrays], pa.list_(pa.int64()))


def _prefixes(frequency, n: int, percent: int):
    """Prefix of every set under order 1. Its end is ``(level, last)``: the last token with its
    sign bit turned, so that signed numbers keep the order of the hashes, and its level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, seen = [], set()
            for _, s in _sets(batch, n):
                if len(s) and (k := node_id(s)) not in seen:
                    seen.add(k)
                    found.append((k, len(s), *ordered_prefix(s, frequency.value, percent)))
            last = np.array([f[2][-1] for f in found], U) ^ U(1 << 63)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[3] for f in found], pa.int32()),
                 pa.array(last.view(np.int64)), _longs(f[2] for f in found)], names=["node", "n", "level", "last", "p1"])
    return run


def _only_shared(shared):
    """The prefixes' tokens that other sets hold, too; sets without any drop out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("p1")
            ends = tokens.offsets.to_numpy()
            flat = tokens.values.to_numpy()
            hit = shared.value.holds(flat.view(U))
            hit[:ends[0]] = False
            kept = np.concatenate(([0], np.cumsum(hit)))[ends].astype(np.int32)
            p1 = pa.ListArray.from_arrays(pa.array(kept - kept[0]), pa.array(flat[hit][:kept[-1]]))
            some = pa.array(np.diff(kept) > 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("node", "n", "level", "last")], p1],
                                             names=["node", "n", "level", "last", "p1"]).filter(some)
    return run


SET_SCHEMA = "node long, p2 array<long>, p3 array<long>, tokens array<long>"


def _whole_sets(wanted, n: int, percent: int):
    """The whole sets of candidate nodes (and of few others that the bitmap lets through), with prefixes under orders 2 and 3."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, seen = [], set()
            for _, s in _sets(batch, n):
                if len(s) and (k := node_id(s)) not in seen and np.int64(k).astype(U) in wanted.value:
                    seen.add(k)
                    found.append((k, s))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int64()), _longs(hashed_prefix(s, _ORDER2, percent) for _, s in found),
                 _longs(hashed_prefix(s, _ORDER3, percent) for _, s in found), _longs(s for _, s in found)], names=["node", "p2", "p3", "tokens"])
    return run


def _longs_of(column: str):
    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch.column(column).to_numpy().view(U)
    return hashes


def members_bitmap(df: DataFrame, column: str):
    """A broadcast bitmap that holds all values of ``column`` (and lets few others through)."""
    values = stored(df.select(column).distinct(), "ngram-members")
    log2 = sketch.width(values.count())
    return sketch.merged(df.sparkSession, sketch.sketch(values, _longs_of(column), log2, 2), log2, 2, 1)


def filtered(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that share a prefix token under orders 2 and 3 as well."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("p2").alias(f"p2{x}"), F.col("p3").alias(f"p3{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(F.arrays_overlap("p2a", "p2b") & F.arrays_overlap("p3a", "p3b")).select("a", "b"))


def enough_shared(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs, one row per shared prefix token, that can still reach the similarity.

    Tokens up to the earlier prefix end are all in both prefixes, so the sets share ``c`` of them and at most
    the rest of the set whose prefix ends there; similar sets share ``percent / (100 + percent)`` of both sizes. ``la`` and ``lb``
    are how many shared tokens the prefixes hold that are not counted here.
    """
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first(F.struct("na", "nb", "la", "lb", "a_first")).alias("s")).select("a", "b", "c", "s.*")
    needed = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))
    n = F.when(F.col("a_first"), F.col("na")).otherwise(F.col("nb"))
    rest = F.expr(f"({percent} * n1 + 99) div 100 - 1")
    return (counted.withColumn("n1", n).where(F.col("c") + F.least("la", "lb") + rest >= needed).select("a", "b"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach the similarity."""
    whole = lambda x: sets.select(F.col("node").alias(x), F.col("tokens").alias(f"t{x}"))
    both = pairs.join(whole("a"), "a").join(whole("b"), "b")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.where(common * 100 >= (F.size("ta") + F.size("tb") - common) * percent).select("a", "b")


MEMBER_SCHEMA = "hub long, node long, nh int, n int, r int, need long, band int, d array<long>"
#: Bands of a hub's members are this share of the hub's size wide.
BAND = 0.02


def _members(percent: int):
    """Members of a hub as differences from it: ``r``, ``need`` = percent * n + (100 + percent) * r, its band, and D."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for hub, node, h, x in zip(*[batch.column(c).to_pylist() for c in ("hub", "node")], batch.column("th"), batch.column("tx")):
                h, x = h.values.to_numpy().view(U), x.values.to_numpy().view(U)
                gone = np.setdiff1d(h, x, assume_unique=True)
                d = np.concatenate((gone, np.setdiff1d(x, h, assume_unique=True)))
                need = percent * len(x) + (100 + percent) * len(gone)
                band = int(need // max(1, int((100 + percent) * BAND * len(h))))
                out.append((hub, node, len(h), len(x), len(gone), need, band, d))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([*[pa.array([o[i] for o in out], t) for i, t in enumerate(types)], _longs(o[7] for o in out)],
                                             names=["hub", "node", "nh", "n", "r", "need", "band", "d"])
    return run


def _difference_prefixes(percent: int):
    """``(hub, token, lo, hi, band, node, n)``: for every band of the hub, the tokens of D that a similar member of that band must share one of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = 100 + percent
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], [], [], []]
            rows = zip(*[batch.column(c).to_pylist() for c in ("hub", "node", "nh", "n", "need", "band", "sure", "least")], batch.column("d"))
            for hub, node, nh, n, need, band, sure, least, d in rows:
                d = d.values.to_numpy()
                for other in least:
                    k = max(1, -((whole * nh - need - other["need"]) // whole))
                    tokens = d[:max(0, len(d) - k + 1)]
                    m = len(tokens)
                    for c, v in zip(cols, (hub, None, min(band, other["band"]), max(band, other["band"]), band, node, n, sure)):
                        c.append(tokens if v is None else np.full(m, v))
            arrays = [np.concatenate(c) if c else np.empty(0, np.int64) for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(arrays, (np.int64, np.int64, np.int32, np.int32, np.int32, np.int64, np.int32, np.bool_))],
                                             names=["hub", "token", "lo", "hi", "band", "node", "n", "sure"])
    return run


def near_copies(long_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that connect the sets of long index entries as all their similar pairs would."""
    whole = 100 + percent
    tokens = sets.select("node", "tokens")
    pairs = long_.select("hub", "node").distinct()
    both = (pairs.join(tokens.withColumnRenamed("tokens", "tx"), "node")
            .join(tokens.select(F.col("node").alias("hub"), F.col("tokens").alias("th")), "hub"))
    members = stored(both.select("hub", "node", "th", "tx").mapInArrow(_members(percent), MEMBER_SCHEMA), "ngram-members")
    first = F.min(F.struct("need", "node"))
    easiest = members.groupBy("hub").agg(first.alias("e"))
    members = members.join(easiest, "hub").withColumn("sure", F.col("need") + F.col("e.need") <= whole * F.col("nh"))
    sure = members.where(F.col("sure") & (F.col("node") != F.col("e.node"))).select(F.col("e.node").alias("a"), F.col("node").alias("b"))

    bands = members.groupBy("hub", "band").agg(F.min("need").alias("need"))
    bands = bands.groupBy("hub").agg(F.collect_list(F.struct("band", "need")).alias("least"))
    # D by how many members of the hub hold a token, rarest first: what most of them share and the hub lacks comes last
    each = members.select("hub", "node", F.explode("d").alias("token"))
    held = each.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("held"))
    ordered = (each.join(held, ["hub", "token"]).groupBy("hub", "node")
               .agg(F.transform(F.array_sort(F.collect_list(F.struct("held", "token"))), lambda x: x["token"]).alias("d")))
    index = members.drop("d").join(ordered, ["hub", "node"]).join(bands, "hub").select("hub", "node", "nh", "n", "need", "band", "sure", "least", "d").mapInArrow(
        _difference_prefixes(percent), "hub long, token long, lo int, hi int, band int, node long, n int, sure boolean")
    p, q = index.where("band = lo").alias("p"), index.where("band = hi").alias("q")
    same = [F.col(f"p.{c}") == F.col(f"q.{c}") for c in ("hub", "token", "lo", "hi")]
    found = p.join(q, same[0] & same[1] & same[2] & same[3] & ((F.col("p.lo") < F.col("p.hi")) | (F.col("p.node") < F.col("q.node")))
                   & ~(F.col("p.sure") & F.col("q.sure"))       # those two are connected already
                   & (F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * percent))
    found = found.select(F.col("p.hub").alias("hub"), F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()
    side = lambda x: members.select("hub", F.col("node").alias(x), F.col("nh").alias(f"nh{x}"), F.col("need").alias(f"need{x}"), F.col("d").alias(f"d{x}"))
    checked = (found.join(side("a"), ["hub", "a"]).join(side("b"), ["hub", "b"])
               .where(F.size(F.array_intersect("da", "db")) * whole >= F.col("needa") + F.col("needb") - F.col("nha") * whole))
    return sure.unionByName(checked.select("a", "b")).distinct()


def labelled_sets(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                  frequent_at: tuple[int, ...] = FREQUENT, short: int = SHORT) -> DataFrame:
    """``doc_id, text_hash, n, comp`` for every row; ``comp`` names its group (null: no words)."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.md5(text_or_empty(text_col)).alias("text_hash"), text_or_empty(text_col).alias("text"))
    words = (rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0) / 6
    log2 = min(sketch.width(words, 1), MOST_CELLS)
    first = stored(rows.mapInArrow(_nodes_and_counts(ngram, log2), NODE_SCHEMA), "ngram-nodes")
    nodes = first.where("block is null").select("doc_id", "text_hash", "n", "node")
    load = int(words / (1 << log2))
    frequency = sketch.levels(spark, first.where("block is not null").select("block", "cells", "counts"), log2, [f + 2 * load for f in frequent_at])

    texts = rows.select("text")
    prefixes = stored(texts.mapInArrow(_prefixes(frequency, ngram, percent), PREFIX_SCHEMA), "ngram-prefixes")
    index = prefixes.select("node", F.explode("p1").alias("token"))
    shared = members_bitmap(index.groupBy("token").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x != y"), "token")
    held = prefixes.mapInArrow(_only_shared(shared), PREFIX_SCHEMA)
    held = held.groupBy("node").agg(F.first(F.struct("n", "level", "last", "p1")).alias("p")).select("node", "p.*")

    entries = held.select("node", "n", "level", "last", F.explode("p1").alias("token"))
    sized = entries.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    entries = entries.join(sized, "token")
    kind = F.col("held") > short
    of_long = entries.groupBy("node").agg(F.count_if(kind).alias("in_long"))
    entries = stored(entries.join(of_long, "node"), "ngram-entries")
    p, q = entries.where(~kind).alias("p"), entries.where(~kind).alias("q")
    each = p.join(q, (F.col("p.token") == F.col("q.token")) & (F.col("p.node") < F.col("q.node"))
                  & (F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * percent))
    a_first = F.struct("p.level", "p.last") <= F.struct("q.level", "q.last")
    near = enough_shared(each.select(F.col("p.node").alias("a"), F.col("q.node").alias("b"), F.col("p.n").alias("na"), F.col("q.n").alias("nb"),
                                     F.col("p.in_long").alias("la"), F.col("q.in_long").alias("lb"), a_first.alias("a_first")), percent)
    near = stored(near, "ngram-near")

    long_ = entries.where(kind)
    hubs = long_.groupBy("token").agg(F.max(F.struct("in_long", "node"))["node"].alias("hub"))
    long_ = long_.join(hubs, "token").select("hub", "node")
    ends = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).unionByName(long_.select("node"))
    sets = texts.mapInArrow(_whole_sets(members_bitmap(ends, "node"), ngram, percent), SET_SCHEMA)
    sets = stored(sets.groupBy("node").agg(F.first(F.struct("p2", "p3", "tokens")).alias("s")).select("node", "s.*"), "ngram-sets")
    joined = components(verified(filtered(near, sets), sets, percent).unionByName(near_copies(long_, sets, percent)))

    return nodes.join(joined, "node", "left").select("doc_id", "text_hash", "n", F.coalesce("comp", "node").alias("comp"))


def similar_groups(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, **more) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: documents linked, directly or through others, share the
    smallest doc_id among them."""
    labels = labelled_sets(docs, ngram, percent, **more)
    least = labels.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return labels.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                     F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each_group(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """The row of ``docs`` with the smallest doc_id of every group (null ids last, ties by text hash); rows without words all stay.

    Rows equal in id and text are one document, of which one row stays.
    """
    labels = stored(labelled_sets(docs, ngram, percent), "ngram-labels")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
    kept = (labels.where("comp is not null").groupBy("comp").agg(F.min(place).alias("k")).select("k.id", "k.h"))
    counted = (labels.where("comp is not null").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_rows"))
               .select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), "_rows"))
    kept = kept.join(counted, F.col("id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_t"))).select("id", "h", "_rows")
    rows = docs.select(F.struct("*").alias("_doc")).withColumn("_id", F.col("_doc.doc_id").cast("long")).withColumn("_h", F.md5(F.coalesce("_doc.text", F.lit(""))))
    wordless = F.coalesce(~F.col("_doc.text").rlike(WORD), F.lit(True))
    found = rows.where(~wordless).join(kept, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_h") == F.col("h")))
    several = found.where("_rows > 1").groupBy("_id", "_h").agg(F.first("_doc").alias("_doc"))
    return (found.where("_rows = 1").select("_doc").unionByName(several.select("_doc")).unionByName(rows.where(wordless).select("_doc"))).select("_doc.*")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: 4-word shingles, similarity at least 0.85, over every whole text of ``documents``."""
    return similar_groups(table(spark, sf_dir, "documents"), ngram=4, percent=85)


OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(reach) FROM r WHERE r.doc_id = d.doc_id)::BIGINT AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""
