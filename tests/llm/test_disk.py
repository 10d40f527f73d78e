"""What the corpus operators write to disk and broadcast."""

import re

import numpy as np

from heliolake.llm import sketch
from heliolake.llm.substrings import repeated_windows_removed
from heliolake.llm.words import U, mix


def test_single_windows_are_not_shuffled_again(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:40] + ["x"] + words[20:])), (3, "y " + " ".join(words[5:50]))], "doc_id long, text string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")          # as with large tables
    try:
        found = repeated_windows_removed(docs)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert {r.doc_id: (r.n_words, r.n_removed) for r in found.collect()} == {1: (60, 0), 2: (81, 80), 3: (46, 45)}
    assert "win#" in plan and not re.search(r"hashpartitioning\(anchor#\d+L?, win", plan)


def test_levels_take_four_bits_a_cell(spark):
    hashes = mix(np.arange(1, 401, dtype=U))
    times = np.array([1, 3, 9, 20] * 100)
    held = np.repeat(hashes, times)
    df = spark.createDataFrame([(x,) for x in held.view(np.int64).tolist()], "h long").repartition(3)
    rows = sketch.sketch(df, lambda batch: iter([batch.column("h").to_numpy().view(U)]), 22, 1)
    levels = sketch.levels(spark, rows, 22, [2, 8, 16]).value
    assert levels.cells.nbytes == 1 << 21
    assert np.mean(levels.of(hashes) == np.searchsorted([2, 8, 16], times, "right")) > 0.99
    assert not levels.of(mix(np.arange(10_000, 10_100, dtype=U))).any()
