"""Exact search against brute force, toxicity on held-out rows, components, sketches, word hashes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliolake.llm import search, sketch, toxicity, words
from heliolake.llm.components import components

from .cases import SCHEMA, awkward, empty, prose, row


def test_top_k(spark):
    r = random.Random(2)
    rows = [(i, [r.uniform(-1, 1) for _ in range(8)], "x") for i in range(300)]
    rows += [(50, rows[50][1], "twin"), (700, None, "x"), (701, [1.0, None], "x"), (702, [float("nan")] * 8, "x"), (703, [float("inf")] * 8, "x"), (704, [0.5], "short"),
             (None, [1.0] * 8, "x"), (750, [], "x"), (751, [1e300] + [0.0] * 7, "huge"), (800, [-1e20] * 8, "huge"), (850, [16384.5] + [0.0] * 7, "huge"),
             (852, [16000.25] + [0.0] * 7, "large"), (-100, [0.9] * 8, "x")]
    rows += [(800 + i, [0.25] * 8, "tie") for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    vectors = search.integer_vectors(df)
    got = search.top_k(vectors, vectors.where("vec_id % 50 = 0"), shard_rows=64, query_block=4).collect()
    usable = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) and abs(x) * 256 < 1 << 22 for x in v)]
    want = []
    for a, (i, v) in enumerate(usable):
        if i % 50 == 0:
            best = sorted(((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(usable) if a != b))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    none = search.integer_vectors(df.limit(0))
    assert search.top_k(none, none).count() == 0


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(120)] + [(5000, 6000 + i) for i in range(200)]
    out = {x["node"]: x["comp"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert out == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_sketch_never_underestimates(spark):
    r = np.random.default_rng(3)
    values = np.concatenate([np.arange(5000), np.repeat(np.arange(100), 3)]).astype(np.int64)
    r.shuffle(values)
    df = spark.createDataFrame([(int(v),) for v in values], "node long").repartition(4)

    def hashes(batch):
        yield words.mix(batch.column("node").to_numpy().view(np.uint64))
    bitmap = sketch.merged(spark, sketch.sketch(df, hashes, 16, 2), 16, 2, 4).value
    assert bitmap.holds(words.mix(np.arange(100, dtype=np.uint64))).all()
    assert bitmap.holds(words.mix(np.arange(100, 5000, dtype=np.uint64))).mean() < 0.05


def test_word_hashes_split_like_bytes():
    r = random.Random(1)
    texts = ["".join(r.choice("ab \n\x0bA\té ") for _ in range(r.randrange(30))) for _ in range(800)] + ["x" * 70_000 + " y", "", " "]
    by_word, by_hash = {}, {}
    for first, bounds, hashes in words.documents(texts, most=300):
        for i in range(len(bounds) - 1):
            split = texts[first + i].encode().split()
            own = hashes[bounds[i]:bounds[i + 1]].tolist()
            assert len(split) == len(own)
            for w, h in zip(split, own):
                assert by_word.setdefault(w, h) == h and by_hash.setdefault(h, w) == w
    folded = words.word_hashes("ABC abc ÀB àb".encode(), fold=True)[1]
    assert folded[0] == folded[1] and folded[2] != folded[3]


def test_clause_grammar():
    g = toxicity.Grammar({"idiot": 3.0, "vequ*": 4.0})
    w = lambda s: toxicity.clause_weight(s, g)
    assert w("you idiot") > w("an idiot") > w("he is not an idiot") - 1e-9
    assert w("not an idiot") < w("an idiot") and w("he said an idiot came by") < w("an idiot came by with him")
    assert w("vequnort") == 4.0 and w("vequ") == 0 and w("idiots") == 0
    assert w("i will kill you") > 0 and w("i kill time") == 0
    assert toxicity.score("", g) == toxicity.score("nothing here", g) < 0.5
    assert toxicity.score("you idiot. you idiot", g) > toxicity.score("you idiot. fine words here", g)


def test_toxicity_held_out(spark):
    r = random.Random(9)
    marks = ["zugnak", "borfle", "idiot", "vequ"]
    docs, labels = [], []
    for i in range(1500):
        toxic = r.random() < 0.2
        w = prose(10_000 + i, 60, 3000).split(" ")
        for _ in range(2 * toxic):
            m = r.choice(marks)
            w[r.randrange(len(w))] = m + (f"x{chr(97 + r.randrange(20))}y" if m == "vequ" else "")
        docs.append(row(i, " ".join(w)))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(docs, SCHEMA).unionByName(awkward(spark).withColumn("doc_id", F.col("doc_id") + 100_000))
    lab = spark.createDataFrame(labels + [(5, None), (None, 1), (999_999, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(df, toxicity.learn(df, lab)).where("held_out and doc_id < 1500").collect()
    truth = dict(labels)
    tp = sum(x["predicted"] and truth[x["doc_id"]] for x in out)
    assert tp >= 0.9 * sum(truth[x["doc_id"]] for x in out) and sum(x["predicted"] for x in out) - tp <= 5
    none = toxicity.learn(df.limit(0), lab.limit(0))
    assert toxicity.toxicity(empty(spark), none).count() == 0
    scored = toxicity.toxicity(awkward(spark), none)
    assert scored.count() == awkward(spark).count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    clean = toxicity.without_toxic(awkward(spark), none)
    assert clean.columns == awkward(spark).columns and clean.count() == awkward(spark).count()


@pytest.mark.parametrize("text, label", [("tail", 0)])
def test_remainder_is_the_crc_of_the_id(spark, text, label):
    import zlib
    out = spark.range(200).select("id", toxicity.remainder("id").alias("m")).collect()
    assert all(x["m"] == zlib.crc32(str(x["id"]).encode()) % 3 for x in out)


def test_unsettled_components_are_not_returned(spark, monkeypatch):
    from heliolake.llm import components as module
    monkeypatch.setattr(module, "MOST_ROUNDS", 2)
    with pytest.raises(RuntimeError, match="not settled"):
        components(spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long"))


@pytest.mark.parametrize("between", [0, 60, 90, 5000])
def test_reported_speech_reaches_through_a_clause_of_any_length(between):
    grammar = toxicity.Grammar({"idiot": 2.0})
    filler = "word " * between
    reported = toxicity.evidence(f"He said {filler}you are an idiot", grammar)
    plain = toxicity.evidence(f"He sang {filler}you are an idiot", grammar)
    cut = toxicity.evidence(f"He said. {filler}you are an idiot", grammar)
    assert reported[1] == pytest.approx(plain[1] * toxicity.REPORTED) and cut[1] == pytest.approx(plain[1])
    after = toxicity.evidence(f"You are an idiot {filler}she said", grammar)
    assert after[1] == pytest.approx(plain[1] * toxicity.REPORTED)


def plain_evidence(text, grammar):
    """The grammar clause by clause over the whole text, without a search for hits."""
    import math
    import re
    weights = []
    low = text.lower()
    for clause in re.split(r"[.!?;:\n]", low):
        words = re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)?", clause)
        total = 0.0
        for i, w in enumerate(words):
            x = max([grammar.terminals.get(w, 0.0)] + [grammar.terminals.get(w[:n] + "*", 0.0) for n in range(3, 9) if len(w) > n])
            near = words[max(0, i - 4):i + 5]
            if w in toxicity.HARM and set(near) & toxicity.TARGETS and set(near) & toxicity.MODALS:
                x = 3.0
            if x > 0:
                x *= 1.25 if set(near) & toxicity.TARGETS else 1
                x *= 0.5 if set(words[max(0, i - 3):i]) & toxicity.NEGATORS else 1
                x *= 0.6 if clause.count('"') >= 2 or set(words) & toxicity.REPORTS else 1
                total += x
        if total > 0:
            weights.append(total)
    if not weights:
        return 0.0, 0.0, 0.0
    return math.log1p(sum(weights)), min(max(weights), 12.0), min(100.0 * len(weights) / max(1, low.count(" ") + low.count("\n") + 1), 5.0)


def test_scores_of_a_given_grammar_equal_a_plain_version(spark):
    import math
    grammar = toxicity.Grammar({"idiot": 2.0, "stup*": 1.5, "scum": 3.0, "scu*": 1.0}, (-2.0, 0.7, 0.3, 0.2))
    r = random.Random(12)
    pool = ["idiot", "Idiots", "stupid", "STUPIDITY", "scum", "scumbag", "kill", "you", "will", "not", "never", "said", "he", "the", "cat", '"', ".", "!", "\n", "3idiot", "x-scum", "l'idiot", "ok;", "and"]
    texts = [" ".join(r.choice(pool) for _ in range(r.randrange(1, 60))) for _ in range(400)] + ["", "idiot", "i will kill you " * 3000]
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)] + [row(9999, None)], SCHEMA).repartition(3)
    got = {x.doc_id: (x.score, x.predicted) for x in toxicity.toxicity(docs, grammar).collect()}
    for i, t in [*enumerate(texts), (9999, "")]:
        z = -2.0 + sum(a * b for a, b in zip((0.7, 0.3, 0.2), plain_evidence(t, grammar)))
        want = 1 / (1 + math.exp(-z))
        assert got[i][0] == pytest.approx(want) and got[i][1] == int(got[i][0] >= 0.7)
