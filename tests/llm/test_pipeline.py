"""The pipeline's stages against plain versions of them, on a small table."""

import random
import zlib

import numpy as np
from pyspark.sql import types as T

import corpus_pipeline
from tabprep.llm import mixing, packing
from tabprep.llm.encoding import encoder
from tests.llm import cases

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def rows_and_labels():
    rng, rows, labels = random.Random(12), [], []
    shared = "every one of these documents carries the same closing line of text"
    for i in range(320):
        good = i % 4 != 0
        if i % 4 == 3:  # near copy of the one before
            words = rows[-1][1].split()  # on one line, so that it is not its lines that give it away
            words[rng.randrange(len(words))] = "other"
            text = " ".join(words)
        else:
            text = cases.prose(rng, rng.randrange(60, 220), f"d{i}x")
        if not good:
            text = "!! ".join(text.upper().split())
        rows.append((i, text + "\n" + shared, "en", rng.choice(["s0", "s0", "s1", None]), len(text)))
        if i % 8:
            labels.append((i, int(good), 0))
    rows += [(500, None, "en", "s1", None), (501, "", "en", "s0", 0), (502, "short text", "en", "s0", 10)]
    return rows, labels


def test_stages_against_plain_versions(spark, tmp_path):
    rows, labels = rows_and_labels()
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    state, kept = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        state = stage(spark, state, str(tmp_path))
        path = str(tmp_path / f"stage{k}.parquet")
        state.write.parquet(path)
        state = spark.read.parquet(path)
        if k < 4:
            assert state.columns == docs.columns
            kept[name] = sorted(tuple(r) for r in state.collect())
    good = {r[0] for r in rows if r[0] < 320 and r[0] % 4}
    assert len(good ^ {r[0] for r in kept["quality_rules"]}) <= 3  # junk goes, clean documents stay

    first = [(r[0], r[1], r[3]) for r in kept["quality_rules"]]
    gone = {d: {int(x) for x in s.split(",") if x} for d, _, _, s in cases.line_cut(first)}
    want = {d: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[d]) for d, t, _ in first}
    assert {r[0]: r[1] for r in kept["line_dedup"]} == {d: t for d, t in want.items() if cases.words(t)}
    assert all(r[4] == len(r[1]) for r in kept["line_dedup"])

    second = [(r[0], r[1], r[3]) for r in kept["line_dedup"]]
    classes = cases.jaccard_classes(second, 5, 80)
    assert [r[0] for r in kept["ngram_jaccard"]] == sorted(d for d, (_, c) in classes.items() if c == d)
    assert len(kept["ngram_jaccard"]) < len(second)

    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.taken(spark.read.parquet(str(tmp_path / "stage2.parquet"))).collect()}
    copies = {}
    for r in kept["source_mix"]:
        copies[r[0]] = copies.get(r[0], 0) + 1
    assert copies == {d: -(-t // n) for d, (t, n) in taken.items() if t}

    pieces, enc = {}, encoder()
    for r in state.collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    for d, t in {r[0]: r[1] for r in kept["source_mix"]}.items():
        ids = [*enc.tokenizer.encode(t, add_special_tokens=False).ids, packing.END]
        spans = {(r["start"], r["length"], r["ids_crc32"]) for r in pieces[d]}
        assert spans == {(a, len(ids[a:a + 1024]), zlib.crc32(np.array(ids[a:a + 1024], "<u4").tobytes())) for a in range(0, len(ids), 1024)}
        assert len(pieces[d]) == copies[d] * len(spans)

    again = sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert again == sorted(tuple(r)[:5] for r in state.collect())


def test_stages_take_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
