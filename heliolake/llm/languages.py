"""Language identification by error-correcting output codes over character n-grams.

Every learned language has a codeword of bits. For each bit a binary classifier tells, from the character n-grams of a
text, whether the text's language has a 1 or a 0 there: the weight of an n-gram is the log odds of its rate among the
languages with a 1 against those with a 0, and a logistic function, fitted on a third of the sample that the rates did not
come from, turns a text's mean weight into a margin. Decoding is loss-weighted: the distance of a text to a codeword is the
logistic loss of the bits' margins against the codeword's bits, each bit weighted by how well its classifier did on that
language, so bits that are weak for a language count little. The nearest codeword wins; a second one nearly as near makes
the result ambiguous.

The n-gram rates come from a bounded sample (``ROWS_PER_LANGUAGE`` different texts a language, the lowest hashes), counted by
Spark over hashed n-grams. All texts are scored whole, in Arrow batches that need no shuffle.

Defined results: a null text, and one without a letter, is ``und`` with score 0 and not ambiguous; so is every text where no
labelled text was learned. One learned language is always predicted, with score 1. A null ``lang`` is not learned from; a null
``doc_id`` counts as an empty text in the remainder. Repeated rows score alike; ties go to the language that sorts first;
extra columns are not read. Languages are classes of a model in memory: more than ``MOST_LANGUAGES`` raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliolake.llm.common import short_batches, stored, table
from heliolake.llm.toxicity import fit_logistic
from heliolake.llm.words import U, mix

UNKNOWN = "und"
#: Different texts of one language that the model is fitted on, at most.
ROWS_PER_LANGUAGE = 2_000
#: How many times that are read before equal texts are counted once.
OVERSAMPLE = 3
MOST_LANGUAGES = 2_048
ORDERS = (2, 3, 4)
LOG2_GRAMS = 16
SMOOTHING = 0.5
#: Up to this many languages every split of them is a bit; beyond it bits are drawn at random.
EXHAUSTIVE = 7
#: A second codeword whose distance is within this of the first makes a text ambiguous.
AMBIGUOUS = 0.25
#: Code points hashed in one go.
PIECE = 1 << 16

TOKEN = regex.compile(r"[\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


def normal(text: str | None) -> str | None:
    """Lower-cased words of letters with one blank around each; None without a letter."""
    if text is None or not LETTER.search(text):
        return None
    return " " + " ".join(TOKEN.findall(text.lower())) + " "


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of (text number, piece) of about ``PIECE`` code points; a piece overlaps the next by a window less one."""
    over = max(ORDERS) - 1
    numbers, pieces, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), PIECE):
            piece = t[at:at + PIECE + over]
            numbers.append(i)
            pieces.append(piece)
            size += len(piece)
            if size >= PIECE:
                yield numbers, pieces
                numbers, pieces, size = [], [], 0
    if pieces:
        yield numbers, pieces


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text numbers, windows of each, hashed n-grams)``: the n-grams of a piece lie one behind the other."""
    for numbers, pieces in _pieces(texts):
        sizes = np.array([len(p) for p in pieces])
        offsets = np.cumsum(sizes) - sizes
        points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), "<u4").astype(U)
        values = mix(points + U(0x9E3779B97F4A7C15))
        hashes, n = values, 1
        for order in ORDERS:
            while n < order:
                hashes = hashes[:-1] * U(0xC2B2AE3D27D4EB4F) + values[n:]
                n += 1
            windows = np.clip(np.minimum(sizes - order + 1, PIECE), 0, None)
            starts = np.repeat(offsets - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
            yield np.array(numbers), windows, (mix(hashes[starts] ^ U(order)) >> U(64 - LOG2_GRAMS)).astype(np.int64)


def codebook(k: int, seed: int = 11) -> np.ndarray:
    """Codewords of ``k`` languages, as rows of +1 and -1.

    Up to ``EXHAUSTIVE`` languages: each way to split them in two. Beyond that: random bits, of several draws the one whose
    nearest codewords are farthest apart.
    """
    if k <= EXHAUSTIVE:
        splits = np.arange(1, 1 << max(k - 1, 0))
        return np.where((splits[None, :] >> np.arange(k)[:, None]) & 1, -1, 1).astype(np.int8)[:, :max(0, (1 << max(k - 1, 0)) - 1)]
    bits, rng = 8 * (k - 1).bit_length() + 7, np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(32):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        if (abs(code.sum(0, dtype=int)) == k).any():
            continue
        like = code.astype(np.int32) @ code.T.astype(np.int32)
        np.fill_diagonal(like, -bits)
        least = int((bits - like.max()) // 2)
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Codes:
    """A fitted model: languages, their codewords, n-gram weights of each bit, margins' coefficients, loss weights."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    coefficients: np.ndarray
    trust: np.ndarray

    def means(self, texts: list[str]) -> np.ndarray:
        """Mean n-gram weight of each bit, one row a text."""
        sums, n = np.zeros((len(texts), self.code.shape[1])), np.zeros(len(texts))
        for numbers, windows, found in grams(texts):
            some = windows > 0
            if some.any():
                at = (np.cumsum(windows) - windows)[some]
                np.add.at(sums, numbers[some], np.add.reduceat(self.weights[found], at, axis=0, dtype=np.float64))
                np.add.at(n, numbers[some], windows[some])
        return sums / np.maximum(n, 1)[:, None]

    def distances(self, means: np.ndarray) -> np.ndarray:
        """Loss-weighted distance of each text to each codeword."""
        margins = np.clip(self.coefficients[0] + self.coefficients[1] * means, -30, 30)
        return np.stack([np.logaddexp(0, -margins * c) @ t for c, t in zip(self.code.astype(float), self.trust)], axis=1)

    def decode(self, texts: list[str | None]) -> tuple[list[str], list[float], list[str | None], list[bool]]:
        """Language, score, second language and ambiguity of each text."""
        normals = [normal(t) for t in texts]
        use = [i for i, t in enumerate(normals) if t is not None] if self.languages else []
        pred, score, second, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts), [False] * len(texts)
        if not use:
            return pred, score, second, unsure
        d = self.distances(self.means([normals[i] for i in use]))
        order = np.argsort(d, axis=1, kind="stable")
        like = np.exp(-(d - d.min(1, keepdims=True)))
        top = (like.max(1) / like.sum(1)).tolist()
        for row, i in enumerate(use):
            pred[i], score[i] = self.languages[order[row, 0]], top[row]
            if len(self.languages) > 1:
                second[i] = self.languages[order[row, 1]]
                unsure[i] = bool(d[row, order[row, 1]] - d[row, order[row, 0]] < AMBIGUOUS)
        return pred, score, second, unsure


def remainder(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4 (null id: as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4


def _shares(rows: DataFrame, most: float) -> DataFrame:
    """``lang, share``: which part of each language's rows makes about ``most``; a table bounded by ``MOST_LANGUAGES``."""
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages are labelled; they are classes of a model that is held in memory")
    return F.broadcast(rows.sparkSession.createDataFrame([(r["lang"], min(1.0, most / r["n"])) for r in counted], "lang string, share double"))


def training_sample(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """``lang, text, part`` (0 to 2): at most ``rows`` different texts of each language, none held out.

    A first pass counts languages from ids alone; a hash threshold then keeps about ``OVERSAMPLE * rows`` rows of each, so one
    frequent language costs no more than a rare one and no group is ever sorted whole. Equal texts are counted once, and a
    second threshold, on the hash of the text, leaves little more than ``rows`` for the exact cut.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 2))
    usable = usable.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def unit(h: Column) -> Column:
        return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))
    picked = usable.join(_shares(usable, OVERSAMPLE * rows), "lang").where(unit(F.xxhash64("doc_id")) < F.col("share")).withColumn("h", F.md5("text"))
    different = stored(picked.select("lang", "h", "text").dropDuplicates(["lang", "h"]), "language-texts")
    fewer = different.join(_shares(different, 1.2 * rows + 50), "lang").where(unit(F.xxhash64("h")) < F.col("share")).select("lang", "h")
    ranked = fewer.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h"))).where(F.col("r") <= rows)
    sample = different.join(ranked.select("lang", "h"), ["lang", "h"])
    return stored(sample.select("lang", "text", (F.crc32(F.col("h").cast("binary")) % 3).cast("int").alias("part")), "language-sample")


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            t = normal(text)
            if t is not None:
                into = counts.setdefault(lang, np.zeros(1 << LOG2_GRAMS, np.int64))
                for _, _, found in grams([t]):
                    into += np.bincount(found, minlength=1 << LOG2_GRAMS)
    for lang, n in counts.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["lang", "gram", "n"])


def _means_of(model: Codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, t) for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()) if (t := normal(text)) is not None]
            means = model.means([t for _, t in rows])
            yield pa.RecordBatch.from_arrays([pa.array([lang for lang, _ in rows], pa.string()), pa.array(list(means), pa.list_(pa.float64()))], names=["lang", "means"])
    return run


def _trust(code: np.ndarray, margins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of a language's texts that each bit tells rightly, above chance; each language's weights sum to 1."""
    out = np.ones(code.shape)
    for i in range(len(code)):
        right = (margins[y == i] * code[i] > 0).sum(0)
        out[i] = np.maximum((right + 1) / ((y == i).sum() + 2) - 0.5, 0.01)
    return out / np.maximum(out.sum(1, keepdims=True), 1e-12)


def learn(docs: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> Codes:
    """Fit the bits' classifiers on the bounded sample of ``docs``."""
    spark = docs.sparkSession
    short_batches(spark)
    sample = training_sample(docs, rows)
    counted = sample.where("part > 0").mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    k, size = len(languages), 1 << LOG2_GRAMS
    code = codebook(k)
    # at most MOST_LANGUAGES * 2^LOG2_GRAMS pairs of numbers, whatever the corpus
    found = counted.toArrow().to_pydict()
    rates = np.zeros((k, size), np.float64)
    place = {lang: i for i, lang in enumerate(languages)}
    rates[[place[lang] for lang in found["lang"]], found["gram"]] = found["n"]
    rates = (rates + SMOOTHING) / (rates.sum(1, keepdims=True) + SMOOTHING * size)
    if k:
        one, zero = (code > 0).astype(float), (code < 0).astype(float)
        weights = np.log((one / np.maximum(one.sum(0), 1)).T @ rates) - np.log((zero / np.maximum(zero.sum(0), 1)).T @ rates)
    else:
        weights = np.zeros((0, size))
    model = Codes(languages, code, np.ascontiguousarray(weights.T, np.float32), np.stack([np.zeros(code.shape[1]), np.ones(code.shape[1])]),
                  np.full(code.shape, 1 / max(code.shape[1], 1)))
    if not code.shape[1]:
        return model
    shared = spark.sparkContext.broadcast(model)
    held = sample.where("part = 0").mapInArrow(lambda b: _means_of(shared.value)(b), "lang string, means array<double>")
    # at most `rows` short vectors a language
    rows_held = [r for r in held.collect() if r["lang"] in place]
    y = np.array([place[r["lang"]] for r in rows_held], int)
    means = np.array([r["means"] for r in rows_held]).reshape(len(y), code.shape[1])
    for b in range(code.shape[1]):
        bit = (code[y, b] > 0).astype(float)
        if 0 < bit.sum() < len(bit):
            model.coefficients[:, b] = fit_logistic(means[:, [b]], bit)
    model.trust = _trust(code, model.coefficients[0] + model.coefficients[1] * means, y)
    return model


def identify(docs: DataFrame, model: Codes) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, second, ambiguous`` for every row."""
    spark = docs.sparkSession
    short_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, second, unsure = shared.value.decode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(second, pa.string()), pa.array(unsure, pa.bool_())],
                                             names=["doc_id", "held_out", "lang_pred", "score", "second", "ambiguous"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder() == 2).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, second string, ambiguous boolean")


def op11_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the codes learned from ``lang`` outside the held-out quarter name the language of all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
