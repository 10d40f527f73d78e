"""Secret scan with corpus-wide ownership frequency.

Pass 1 scans every whole text in Python for base spans (assignments, access keys, hex strings) and
for further candidates (credentials in URLs, opaque mixed tokens). It keeps offsets and hashes of the
values, never the texts. Pass 2 counts, per value hash, the distinct
repositories and owners that hold it, in nested groupings that each combine before the shuffle, so a
value copied into a third of all documents moves as one row per task. A value held by several owners,
or by many repositories of one, or one that reads like a placeholder, is a widely copied example; a
varied value held by one owner looks live.

Here a document stands for a repository (equal texts are one) and its source for the owner.

Defined results: null text is empty; a null owner is one owner of its own; rows of equal texts are one
repository but separate result rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm.common import short_batches, stored, table, text_or_empty
from heliolake.llm.spans import digest

# fixed values: kinds in their listed order; the last two are what the method adds
KINDS = ("assign", "access", "hex", "url", "opaque")
BASE_KINDS = KINDS[:3]
ORDER = {k: i for i, k in enumerate(KINDS)}
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
PLACEHOLDERS = ("example", "changeme", "change_me", "placeholder", "dummy", "sample", "your", "xxxx", "1234567890", "redacted")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Whole runs, so no length is lost; both stay linear, since a run is entered at its start only.
URL = re.compile(r"://[^\s/:@]+:([^\s/:@]+)@")
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
OPAQUE = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_+/=-])")
HAS_DIGIT = re.compile(r"[0-9]")

#: Values in at least this many owners are widely copied.
COPIED_OWNERS = 3
#: Values in at least this many different texts are widely copied, even of one owner.
COPIED_REPOS = 10
#: Share of the most bits a character that a live-looking value can have, by its length and up to an alphabet of 16: 3 bits from 16 characters on.
LIVE_SHARE, LIVE_ALPHABET = 0.75, 16
OPAQUE_ENTROPY = 3.5


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def varied(value: str) -> bool:
    """Whether a value has the entropy of a live-looking one, for its length."""
    return len(value) > 1 and entropy(value) >= LIVE_SHARE * math.log2(min(len(value), LIVE_ALPHABET))


Found = tuple[str, int, int, str]


def base_spans(text: str) -> list[Found]:
    """``(kind, start, end, value)``; the value is what the span ends with; runs of 20 / 24 are matched whole, so no shorter match can hide one."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return out


def has_scheme(text: str, end: int) -> bool:
    """Whether a letter and one or more further characters of a scheme stand before ``end``."""
    a = end
    while a > 0 and text[a - 1] in SCHEME:
        a -= 1
    return any("a" <= c <= "z" for c in text[a:max(a, end - 1)])


def further_spans(text: str, base: list[Found]) -> list[Found]:
    found = []
    if "://" in text:
        found = [("url", m.start(1), m.end(1), m[1]) for m in URL.finditer(text) if len(m[1]) >= 6 and has_scheme(text, m.start())]
    if HAS_DIGIT.search(text):
        for m in OPAQUE.finditer(text):
            v = m[0]
            if re.search("[a-z]", v) and re.search("[A-Z]", v) and HAS_DIGIT.search(v) and entropy(v) >= OPAQUE_ENTROPY:
                found.append(("opaque", m.start(), m.end(), v))
    return [x for x in found if not any(x[1] < b[2] and b[1] < x[2] for b in base)]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_start", pa.int64()), ("hash", pa.string()),
                  ("varied", pa.bool_()), ("placeholder", pa.bool_())])
SCAN_SCHEMA = ("doc_id long, owner string, text_hash string, base_sha256 string, n_assign long, n_access long, n_hex long, "
               "found array<struct<kind:string,start:long,end:long,value_start:long,hash:string,varied:boolean,placeholder:boolean>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, counts, found = [], [], []
        for text in batch.column("text"):
            t = text.as_py()
            base = base_spans(t)
            n = Counter(k for k, *_ in base)
            counts.append([n[k] for k in BASE_KINDS])
            digests.append(digest([x[:3] for x in base], ORDER))
            found.append([{"kind": k, "start": a, "end": b, "value_start": b - len(v), "hash": hashlib.sha256(v.encode()).hexdigest()[:32],
                           "varied": varied(v), "placeholder": any(p in v.lower() for p in PLACEHOLDERS)}
                          for k, a, b, v in base + further_spans(t, base)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("owner"), batch.column("text_hash"), pa.array(digests, pa.string()),
             *[pa.array([c[i] for c in counts], pa.int64()) for i in range(3)], pa.array(found, pa.list_(SPAN))],
            names=["doc_id", "owner", "text_hash", "base_sha256", "n_assign", "n_access", "n_hex", "found"])


def ownership(candidates: DataFrame, copied_owners: int = COPIED_OWNERS, copied_repos: int = COPIED_REPOS) -> DataFrame:
    """``(hash, owner, repo, varied, placeholder)`` -> per hash its owners, repositories, occurrences and verdict."""
    same = [F.first("varied").alias("varied"), F.first("placeholder").alias("placeholder")]
    repos = (candidates.groupBy("hash", "repo").agg(F.count(F.lit(1)).alias("n"), *same)
             .groupBy("hash").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("occurrences"), *same))
    owners = candidates.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    copied = (F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos)
    verdict = (F.when(F.col("placeholder") | copied, "example")
               .when((F.col("owners") == 1) & F.col("varied"), "live").otherwise("unclear"))
    return repos.join(owners, "hash").withColumn("verdict", verdict)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                copied_owners: int = COPIED_OWNERS, copied_repos: int = COPIED_REPOS) -> DataFrame:
    """One row per input row: base counts and digest, and ``found``, all spans with their verdicts.

    Further spans (``url``, ``opaque``) are left out where the corpus shows a widely copied example.
    """
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
                       F.md5(text_or_empty(text_col)).alias("text_hash"), text_or_empty(text_col).alias("text"))
    scanned = stored(rows.mapInArrow(_scan, SCAN_SCHEMA).withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    each = scanned.where(F.size("found") > 0).select("row", F.col("text_hash").alias("repo"), "owner", F.explode("found").alias("f")).select("row", "repo", "owner", "f.*")
    verdicts = ownership(each, copied_owners, copied_repos).select("hash", "owners", "repos", "verdict")
    judged = each.join(verdicts, "hash").where(F.col("kind").isin(*BASE_KINDS) | (F.col("verdict") != "example"))
    spans = judged.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "value_start", "verdict", "owners", "repos")).alias("found"))
    counted = scanned.drop("found").join(spans, "row", "left").withColumn(
        "found", F.coalesce("found", F.array().cast(spans.schema["found"].dataType)))
    return counted.drop("row", "owner")


def span_text(found: Column) -> Column:
    """All spans as ``kind:start:end`` by start, then kind as listed, then end."""
    place = F.create_map(*[F.lit(x) for k, i in ORDER.items() for x in (k, i)])
    ordered = F.array_sort(F.transform(found, lambda f: F.struct(f["start"].alias("a"), place[f["kind"]].alias("k"), f["end"].alias("b"), f["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda f: F.concat_ws(":", f["kind"], f["a"].cast("string"), f["b"].cast("string"))), ",")


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every whole text of ``documents``, values counted by owner (source) over the whole corpus."""
    out = secret_scan(table(spark, sf_dir, "documents"))
    verdict = lambda v: F.size(F.filter("found", lambda f: f["verdict"] == v)).cast("long")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", span_text(F.col("found")).alias("spans"),
                      verdict("live").alias("n_live"), verdict("example").alias("n_example"))


def live_secrets_masked(docs: DataFrame) -> DataFrame:
    """``docs`` with the values of live-looking credentials replaced by as many asterisks; nothing else changes.

    The places depend on a text alone, so they are joined by its hash and equal texts are masked alike.
    """
    live = (secret_scan(docs).select("text_hash", F.explode("found").alias("f")).where("f.verdict = 'live'")
            .groupBy("text_hash").agg(F.collect_set(F.struct(F.col("f.value_start").alias("a"), (F.col("f.end") - F.col("f.value_start")).alias("n"))).alias("_mask")))
    rows = docs.select(F.struct("*").alias("_doc")).withColumn("_hash", F.md5(F.coalesce("_doc.text", F.lit(""))))
    joined = rows.join(live, F.col("_hash") == F.col("text_hash"), "left")
    masked = F.aggregate("_mask", F.col("_doc.text"), lambda t, m: F.overlay(t, F.repeat(F.lit("*"), m["n"].cast("int")),
                                                                            (m["a"] + 1).cast("int"), m["n"].cast("int")))
    text = F.when(F.col("_mask").isNull(), F.col("_doc.text")).otherwise(masked)
    return joined.select(F.col("_doc").withField("text", text).alias("_doc")).select("_doc.*")
