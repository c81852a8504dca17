"""No step of an operator is done on a part or without effect."""

from pyspark.sql import functions as F

from tabprep.llm import mixing, pii


def test_trees_see_documents_beyond_any_first_few_thousand(spark):
    ids = spark.range(5150).select(F.col("id").alias("doc_id"))
    late = {r["doc_id"] for r in ids.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").tail(150)}
    rows = [(i, f"write to user{i}@mail{i}.example.org or call +49 30 {1000000 + i}, not 12:{i % 60}" if i in late else "plain words") for i in range(5150)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert model is not None and len(model[0]) == 8


def test_the_schedule_governs_the_mix(spark, monkeypatch):
    rows = [(i, ("a", "b")[i % 2], "word " * (5 + i % 7)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    whole = {r["source"] for r in mixing.mixed(docs).select("source").distinct().collect()}
    full = mixing.schedule
    monkeypatch.setattr(mixing, "schedule", lambda targets, slots: full(targets, slots).filter("src = 1"))
    left = {r["source"] for r in mixing.mixed(docs).select("source").distinct().collect()}
    assert whole == {"a", "b"} and left == {"a"}
