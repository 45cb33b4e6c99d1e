import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import topk


def brute(vectors, k):
    out = []
    fine = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for at, (q, own) in enumerate(fine):
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for n, (i, v) in enumerate(fine) if n != at)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<float>, score int, g int")


@pytest.mark.parametrize(("block", "group", "queries"), [(256, 64, 2048), (8, 2, 3)])
def test_top_k(spark, monkeypatch, block, group, queries):
    for name, value in (("BLOCK", block), ("GROUP", group), ("QUERIES", queries)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(200)]
    vectors += [(300 + i, [0.5] * 8) for i in range(30)] + [(400, None), (401, [float("nan")] * 8), (420, [None] + [1.0] * 7), (440, [float("inf")] * 8), (460, [0.0] * 8), (None, [1.0] * 8), (480, [0.5, 0.5])]
    vectors += [(7, [0.9] * 8)] * 12 + [(7, [0.1] * 8), (40, [0.9] * 8), (40, [-0.2] * 8), (60, vectors[60][1])]
    got = topk.top_k(frame(spark, vectors), F.col("vec_id") % 20 == 0, k=7)
    assert sorted(tuple(r) for r in got.collect()) == brute(vectors, 7)


def test_fewer_than_k_and_empty(spark):
    assert topk.top_k(frame(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    got = topk.top_k(frame(spark, [(0, [1.0]), (3, [2.0]), (3, [1.0])]), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 3, 64 * 128), (0, 2, 3, 64 * 64)]


def test_large_components_stay_exact():
    a = np.array([[1 << 40, 3], [2, 1]])
    assert topk.products(a, a).tolist() == (a @ a.T).tolist()
    b = np.array([[1 << 20, -1]])
    assert topk.products(b, b).tolist() == [[(1 << 40) + 1]]


def test_equals_its_sql_on_repeated_ids(spark, tmp_path):
    import duckdb

    from flightlake.llm import queries

    rng = np.random.default_rng(3)
    data = [(int(i) % 30, rng.normal(0, 0.3, 4).astype(np.float32).tolist()) for i in range(90)] + [(20, [0.5] * 4)] * 3
    spark.createDataFrame(data, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = queries.op7_block_top_k(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(db.execute(queries.ORACLES["op7_block_top_k"]).fetchall())
