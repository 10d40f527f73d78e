"""The stages one after another, on awkward rows and on empty tables."""

import corpus_pipeline as P
from heliolake.llm.common import stored

from .cases import SCHEMA, awkward, empty, prose, row

SECRET = "password=Zq9xLmR2vT7w"


def _tables(spark, root, docs):
    docs.write.parquet(f"{root}/documents.parquet")
    labels = [(5000 + i, int(i % 4 == 0)) for i in range(600)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{root}/labels.parquet")


def test_stages_keep_columns_and_take_effect(spark, scratch):
    root = scratch + "/in"
    insult = ["scum", "idiot", "worthless"]
    train = [row(5000 + i, prose(5000 + i, 50, 5000) + (f" you {insult[i % 3]}" * 3 if i % 4 == 0 else ""), source=f"s{i % 5}") for i in range(600)]
    own = [row(9000, prose(9000, 60, 5000) + " " + SECRET, source="s1")]
    _tables(spark, root, awkward(spark).unionByName(spark.createDataFrame(train + own, SCHEMA)))
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, texts = docs.columns, {}
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, root), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
        texts[name] = docs.select("doc_id").collect() if name == "packing" else docs.select("doc_id", "text").collect()
    kept = lambda name: [r["doc_id"] for r in texts[name]]
    toxic = {5000 + i for i in range(600) if i % 4 == 0}
    assert len(toxic & set(kept("toxicity"))) <= 8 and len(set(kept("toxicity")) - toxic) >= 450 + 60
    assert not {7, 8, 9, 201} & set(kept("near_duplicates")) and {6, 9000, 1, 2, 3} <= set(kept("near_duplicates"))
    assert sorted(map(str, kept("secrets"))) == sorted(map(str, kept("near_duplicates")))
    masked = {r["doc_id"]: r["text"] for r in texts["secrets"]}[9000]
    assert masked.endswith("password=" + "*" * 12)
    assert set(kept("mixing")) <= set(kept("secrets")) and len(kept("mixing")) > 100
    pieces = docs.collect()
    assert {r["doc_id"] for r in pieces} == set(kept("mixing"))
    assert sum(r["piece"] == 0 for r in pieces) == len(kept("mixing"))


def test_empty_documents(spark, scratch):
    _tables(spark, scratch + "/none", empty(spark))
    assert P.run(spark, scratch + "/none").count() == 0
