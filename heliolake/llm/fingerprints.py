"""Merkle fingerprints: leaves are word runs, then paragraphs, sections and one root per text.

A paragraph is a line. It is cut into leaves of ``LEAF_WORDS`` words from its own start, so an edit
moves leaves of its paragraph only. A paragraph's hash covers its leaves. A section is a run of paragraphs that ends
where the content says so, behind a paragraph hash divisible by 8 (or at the end), so a paragraph that comes, goes or moves
changes the sections it touches and no others. A section's hash covers its paragraph hashes, the root (SHA-256)
covers the sections and the text's exact bytes: equal roots mean equal texts, and unequal branches lead down to the edits.

The fingerprint is one string: ``root|section,section|paragraph paragraph,paragraph|leaf leaf,leaf leaf``; the paragraphs of
a section stand between commas, and so do the leaves of a paragraph. The likeness of two fingerprints is the Dice share
of their different leaves, 1 for equal roots. ``located_edits`` descends two trees and lists the branches that differ.

DataFrame functions only; texts never leave the JVM. Null text is empty (one empty leaf); equal texts have
equal fingerprints; ties in ``doc_id`` are ordered by text hash; a null id comes last; a single document is its own next one;
an empty table gives no rows and other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliolake.llm.common import stored, table, text_or_empty

LEAF_WORDS = 8
#: A run of up to LEAF_WORDS words within a line; possessive, so it never backtracks.
LEAF = rf"[^\x20\t\r]*+(?:[\x20\t\r]++[^\x20\t\r]*+){{0,{LEAF_WORDS - 1}}}+[\x20\t\r]*+"
#: The last digit of a paragraph hash that is divisible by 8, and what follows it inside a text.
SECTION_END = "([08]) "


def _short(col: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.crc32(col.cast("binary"))), 8, "0"))


def _line_leaves(line: Column) -> Column:
    runs = F.filter(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), lambda x: x != "")
    return F.array_join(F.transform(runs, _short), " ")


def leaves(text: Column) -> Column:
    """Leaf hashes (8 hexadecimal digits), blank between leaves, comma between paragraphs."""
    return F.array_join(F.transform(F.split(text, "\n"), _line_leaves), ",")


def paragraphs(tree: Column) -> Column:
    """Paragraph hashes from a text's ``leaves``: blank between paragraphs, comma between sections."""
    return F.regexp_replace(F.array_join(F.transform(F.split(tree, ","), _short), " "), SECTION_END, "$1,")


def fingerprint(text_hash: Column, tree: Column) -> Column:
    """``root|sections|paragraphs|leaves`` from a text's SHA-256 and its ``leaves``."""
    nodes = paragraphs(tree)
    branches = F.array_join(F.transform(F.split(nodes, ","), _short), ",")
    return F.concat_ws("|", F.sha2(F.concat_ws("|", text_hash, branches), 256), branches, nodes, tree)


def _leaf_set(fp: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.substring_index(fp, "|", -1), "[ ,]"), lambda x: x != ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the Dice share of the different leaves; 1 for equal roots."""
    x, y = _leaf_set(a), _leaf_set(b)
    total = F.size(x) + F.size(y)
    dice = F.when(total > 0, 2.0 * F.size(F.array_intersect(x, y)) / total).otherwise(F.lit(1.0))
    return F.when(F.substring_index(a, "|", 1) == F.substring_index(b, "|", 1), F.lit(1.0)).otherwise(dice)


def _level(fp: Column, level: int) -> Column:
    return F.element_at(F.split(fp, "[|]"), level)


def _nodes(pairs: DataFrame, key: str, fp: str, side: str) -> DataFrame:
    """One row per paragraph: its place, hash, leaves, section (place and hash) and the hashes beside it (empty at the ends)."""
    tree = F.col(fp)
    sections = F.split(_level(tree, 2), ",")
    each = F.split(_level(tree, 3), ",")
    base = pairs.select(F.col(key).alias("key"), F.posexplode(F.arrays_zip(sections.alias("section"), each.alias("nodes"))).alias("s", "z"),
                        F.split(_level(tree, 4), ",").alias("leaves"), F.split(_level(tree, 3), "[ ,]").alias("every"))
    # a section starts behind the paragraphs of all earlier ones; places follow from one count over the tree's sections
    inside = F.size(F.split("z.nodes", " "))
    before = F.coalesce(F.sum(inside).over(W.partitionBy("key").orderBy("s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("int")
    rows = base.withColumn("first", before).select("key", "s", "z.section", "first", "leaves", "every", F.posexplode(F.split("z.nodes", " ")).alias("i", "node"))
    at = F.col("first") + F.col("i")
    beside = lambda d: F.coalesce(F.get("every", at + d), F.lit(""))
    return rows.select("key", F.lit(side).alias("side"), "s", "section", at.alias("place"), "node", F.get("leaves", at).alias("leaves"),
                       F.concat_ws(">", beside(F.lit(-1)), "node").alias("back"), F.concat_ws(">", "node", beside(F.lit(1))).alias("ahead"))


def located_edits(pairs: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """``key, side, level, place, leaf``: branches of two fingerprints per row that the other tree does not have.

    The descent takes rows whose roots differ, then sections (``level`` section) whose hash the other tree lacks, and inside these

    * paragraphs whose hash the other tree lacks (changed, inserted, deleted), or whose neighbours on both sides
      are others there (moved, or one more copy of a paragraph that is there already);
    * leaves, of paragraphs of the first kind, whose hash the other tree lacks.

    ``side`` is ``a`` or ``b``; ``place`` counts from 0 within the tree (``leaf``: within the paragraph). A block of several paragraphs that
    moves whole shows in its sections only. Sides and levels meet by joins on (key, hash), so a long text is no single task's
    work but for the counting of its sections. ``key`` names the row and must differ between
    rows; null keys and null fingerprints give nothing.
    """
    open_ = pairs.where(F.col(key).isNotNull() & (_level(F.col(a), 1) != _level(F.col(b), 1))).select(F.col(key).alias("_key"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    trees = _nodes(open_, "_key", "_a", "a").unionByName(_nodes(open_, "_key", "_b", "b"))
    other = F.when(F.col("side") == "a", F.lit("b")).otherwise(F.lit("a")).alias("side")

    def lacking(rows: DataFrame, column: str) -> DataFrame:
        """Rows whose hash in ``column`` no row of the other side's tree has."""
        return rows.join(trees.select("key", other, column).distinct(), ["key", "side", column], "left_anti")

    inside = lacking(trees, "section")
    new = lacking(inside, "node")
    elsewhere = lacking(lacking(inside, "back"), "ahead")
    words = F.posexplode(F.split("leaves", " ")).alias("leaf", "hash")
    theirs = trees.select("key", other, F.explode(F.split("leaves", " ")).alias("hash")).distinct()
    leaf = new.select("key", "side", "place", words).where("hash != ''").join(theirs, ["key", "side", "hash"], "left_anti")
    none = F.lit(None).cast("int").alias("leaf")
    level = lambda rows, name, place: rows.select("key", "side", F.lit(name).alias("level"), F.col(place).alias("place"), none).distinct()
    return (level(inside, "section", "s").unionByName(level(new.unionByName(elsewhere.select(new.columns)), "paragraph", "place"))
            .unionByName(leaf.select("key", "side", F.lit("leaf").alias("level"), "place", "leaf")))


def next_of(ids: DataFrame) -> DataFrame:
    """``(k, doc_id)`` -> ``k, next_k``: the follower by descending ``doc_id`` (nulls last, ties by ``k``); the last one's is the first.

    The rows are range-partitioned and sorted once and stored with their partition and place, which
    gives every row its global rank from one offset per partition; no task sees all rows.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("k").desc()]
    at = F.monotonically_increasing_id()
    ordered = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ordered.select("k", F.shiftright(at, 33).alias("p"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("i")), "fingerprint-order")
    sizes = kept.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy().orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    # one row per partition of the sort
    offsets = sizes.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"), F.sum("n").over(W.partitionBy()).alias("every"))
    ranked = kept.join(F.broadcast(offsets), "p").select("k", (F.col("o") + F.col("i")).alias("rank"), "every")
    following = ranked.select(F.col("k").alias("next_k"), F.pmod(F.col("rank") - 1 + F.col("every"), F.col("every")).alias("rank"))
    return ranked.drop("every").join(following, "rank").select("k", "next_k")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``n_chars``, the edited text's hash, both fingerprints, their likeness and the next document's.

    The edited text has its last ``n_chars div 2`` code points replaced by the first ones of the next document.
    Texts are shuffled once, by document; what moves besides are the heads of the next documents.
    Rows equal in id and text are one document.
    """
    text = text_or_empty(text_col)
    doc_id = F.col(id_col).cast("long")
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text))
    ids = docs.select(doc_id.alias("doc_id"), key.alias("k"), F.char_length(text).alias("n")).groupBy("k", "doc_id").agg(F.max("n").alias("n"))
    pairs = next_of(ids.select("k", "doc_id")).join(ids.select("k", F.expr("n div 2").cast("int").alias("half")), "k")
    pairs = pairs.select(F.col("k").alias("target"), F.col("next_k").alias("k"), "half")
    base = docs.select(doc_id.alias("doc_id"), text.alias("text"), key.alias("k"))
    # both joins read the same exchange of the texts, so they ask for the same columns; leaves are cut after it on either side
    heads = base.join(pairs, "k").withColumn("tree", leaves(F.col("text"))).select(F.col("target").alias("k"), F.struct(
        F.col("doc_id").alias("next_id"), F.expr("substring(text, 1, half)").alias("head"),
        fingerprint(F.sha2(F.col("text").cast("binary"), 256), F.col("tree")).alias("next_fp")).alias("next"))
    heads = heads.groupBy("k").agg(F.first("next").alias("next"))
    both = base.join(heads, "k").withColumn("tree", leaves(F.col("text")))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - char_length(text) div 2)"),
                      F.expr("substring(next.head, 1, cast(char_length(text) div 2 as int))"))
    rows = both.select("doc_id", n.cast("long").alias("n_chars"), "next", fingerprint(F.sha2(F.col("text").cast("binary"), 256), F.col("tree")).alias("fingerprint"),
                       edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "next", "fingerprint", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), leaves(F.col("edited")).alias("edited_tree"))
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited_sha256"), F.col("edited_tree")))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next.next_fp")).alias("near_next"), F.col("next.next_id").alias("next_id"))


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all ``documents``, with their edited texts and next documents."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
