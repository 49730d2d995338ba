import numpy as np
from pyspark.sql import functions as F

from lakeops.llm import ann


def frame(spark, vectors, extra=False):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in vectors]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumn("id", F.lit(1)).withColumn("list", F.lit("x")) if extra else df


def exact(vectors, query, k=10):
    of = {i: np.array(v, np.float32).astype(float) for i, v in vectors}
    return sorted((float(np.sqrt(((v - of[query]) ** 2).sum())), i) for i, v in of.items() if i != query)[:k]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 32)) * 3
    vectors = [(i, (centres[i % 20] + rng.standard_normal(32)).tolist()) for i in range(3000)]
    got = ann.search(frame(spark, vectors, extra=True), F.col("id") % 100 == 0, cell_rows=64).toPandas()
    hit = 0
    for q, rows in got.groupby("query_id"):
        want = exact(vectors, q)
        rows = rows.sort_values("rank")
        assert list(rows["rank"]) == list(range(1, 11))
        assert (np.diff(rows.score) >= 0).all()
        of = {i: s for s, i in exact(vectors, q, 3000)}
        assert np.allclose([of[i] for i in rows.id], rows.score, rtol=1e-12)
        hit += len({i for _, i in want} & set(rows.id))
    assert got.query_id.nunique() == 30 and hit / 300 >= 0.9


def test_hot_vector_ties_go_to_smaller_ids(spark):
    vectors = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [float(i), 1.0, -5.0]) for i in range(200)]
    got = ann.search(frame(spark, vectors), F.col("id") == 100, cell_rows=32).orderBy("rank").collect()
    assert [(r.id, r.score) for r in got] == [(i, 0.0) for i in range(10)]


def test_edges(spark):
    vectors = [(0, [1, 0]), (1, [0, 1]), (1, [0, 1]), (2, [0, 0]), (3, None), (4, [1, None]), (5, [float("nan"), 1]),
               (6, [float("inf"), 1]), (7, [1, 2, 3]), (None, [1, 1]), (8, [3, 0]), (8, [0, 1]), (9, [])]
    got = ann.search(frame(spark, vectors), F.col("id").isin(0, 2, 4, 8), k=10)
    rows = sorted((r.query_id, r.rank, r.id, round(r.score, 6)) for r in got.collect())
    assert rows == [(0, 1, 1, 1.414214), (0, 2, 8, 1.414214), (8, 1, 1, 0.0), (8, 2, 0, 1.414214)]
    assert ann.search(frame(spark, vectors).where("vec_id < 0"), F.col("id") == 0).count() == 0


def test_early_abandoning_keeps_the_near_rows():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((2000, 64))
    x[:30] = x[0] + rng.standard_normal((30, 64)) * 0.05
    ids = np.arange(2000)
    near, score = ann.scan_cell(np.ascontiguousarray(x.T), ids, x, 0, x[0], x[0], 10)
    want = np.argsort(((x - x[0]) ** 2).sum(1), kind="stable")[1:11]
    assert near.tolist() == want.tolist() and (np.diff(score) >= 0).all()


def test_every_query_gets_k_rows_on_tight_clusters_with_outliers(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((200, 16)) * 50
    vectors = [(i, (centres[i % 200] + rng.standard_normal(16) * 0.01).tolist()) for i in range(8000)]
    vectors += [(8000 + 20 * i, (rng.standard_normal(16) * 500).tolist()) for i in range(6)]
    got = ann.search(frame(spark, vectors), F.col("id") % 100 == 0, k=10).toPandas()
    asked = [i for i, _ in vectors if i % 100 == 0]
    assert got.groupby("query_id").size().to_dict() == dict.fromkeys(asked, 10)
    hit = sum(len({i for _, i in exact(vectors, q)} & set(rows.id)) for q, rows in got.groupby("query_id"))
    assert hit >= 9 * len(asked)


def test_fewer_candidates_than_k_are_all_returned(spark):
    vectors = [(i, [float(i), 1.0]) for i in range(6)] + [(3, [9.0, 1.0]), (3, [9.0, 1.0])]
    got = ann.search(frame(spark, vectors), F.col("id") == 0, k=10).orderBy("rank").collect()
    assert [r.id for r in got] == [1, 2, 3, 4, 5]


def test_abandoning_leaves_k_rows_of_a_cell():
    """All of a row's distance in its first block: the estimate would abandon even the nearest ones."""
    x = np.zeros((40, 64))
    x[:, 0] = np.arange(40) * 10.0
    near, _ = ann.scan_cell(np.ascontiguousarray(x.T), np.arange(40), x, 0, x[0], x[0], 10)
    assert near.tolist() == list(range(1, 11))
