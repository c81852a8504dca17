import numpy as np
import pytest
from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler
from pyspark.sql import functions as F

from tabprep.operators import knn
from tabprep.plans import q_balance


def test_lsh_queries_ask_every_twentieth_row_against_all(spark, tmp_path):
    vectors = F.array(*[F.rand(i) for i in range(8)]).alias("embedding")
    spark.range(200).select(F.col("id").alias("vec_id"), (F.col("id") % 2).cast("int").alias("label"), vectors).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = q_balance.q_knn_lsh(spark, str(tmp_path)).collect()
    assert {r["q_key"] for r in got} == set(range(0, 200, 20)) and len(got) == 50
    assert any(r["c_key"] % 20 for r in got)
    assert q_balance.q_knn_lsh_recall(spark, str(tmp_path)).first()["exact_pairs"] == 50


@pytest.mark.parametrize("width, within", [(12, None), (2, "z")])
def test_buckets_met_in_blocks_give_the_pairs_of_the_similarity_join(spark, monkeypatch, width, within):
    def no_pairs(*args, **how):
        raise AssertionError("every pair of a bucket became a row")

    rng = np.random.default_rng(width)
    m = rng.normal(size=(300, width)).round(1)
    m[200:260] = m[100:160]  # ties
    feats = [f"v{i}" for i in range(width)]
    df = spark.createDataFrame([(i % 290, *map(float, r), i % 2) for i, r in enumerate(m)] + [(7, *map(float, m[7]), 1)], "k long, " + ", ".join(f"{f} double" for f in feats) + ", z int")
    va = VectorAssembler(inputCols=feats, outputCol="x").transform(df)
    length = width ** 0.5
    model = BucketedRandomProjectionLSH(inputCol="x", outputCol="h", bucketLength=length, numHashTables=5, seed=42).fit(va)
    pairs = model.approxSimilarityJoin(va.where("k % 3 = 0"), va, length, distCol="d").where("datasetA.k != datasetB.k" + (" and datasetA.z = datasetB.z" if within else ""))
    want: dict = {}
    for q, d, c, z in sorted((r["q"], r["d"], r["c"], r["z"]) for r in pairs.selectExpr("datasetA.k q", "d", "datasetB.k c", "datasetB.z z").distinct().collect()):
        want.setdefault(q, []).append((c, d, z))
    want = {q: v[:3] for q, v in want.items() if len(v) >= 3}
    assert len(want) > 20
    monkeypatch.setattr(type(model), "approxSimilarityJoin", no_pairs)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 50)
    monkeypatch.setattr(knn, "LOT_ROWS", 20)
    got: dict = {}
    for r in sorted(knn.knn_lsh(df.where("k % 3 = 0"), df, feats, 3, "k", "k", cand_label="z", bucket_length=length, threshold=length, within=within).collect(), key=lambda r: (r["q_key"], r["rank"])):
        got.setdefault(r["q_key"], []).append((r["c_key"], r["dist"], r["c_label"]))
    assert all(got[q] == v for q, v in want.items()) and len(got) == df.where("k % 3 = 0").select("k").distinct().count()
