import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import queries, whitening


def frame(spark, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows],
                               "vec_id long, embedding array<double>")
    return df.withColumn("key", F.lit("k")).withColumn("x", F.lit(1)).withColumn("id", F.lit(2)).repartition(3)


def plain(rows, top=16, weights="one"):
    """Covariance, components and deviations from the definition, in Python integers and numpy."""
    xs = {i: tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for i, v in rows}
    counts = {}
    for x in xs.values():
        counts[x] = counts.get(x, 0) + 1
    if weights == "one":
        counts = dict.fromkeys(counts, 1)
    n = sum(counts.values())
    sums = [sum(x[d] * m for x, m in counts.items()) for d in range(len(next(iter(counts))))]
    fitted = np.array([[n * c - s for c, s in zip(x, sums)] for x in counts], float) / n
    weight = np.array(list(counts.values()), float)
    cov = (fitted * weight[:, None]).T @ fitted / n
    values, columns = np.linalg.eigh(cov)
    order = np.argsort(-values)[:top]
    return xs, n, sums, values[order], columns[:, order], np.trace(cov)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_against_the_definition(spark, weights):
    rng = np.random.default_rng(2)
    mixed = rng.standard_normal((400, 12)) @ rng.standard_normal((12, 12))
    rows = [(i, mixed[i % 300 if i < 400 else 7].tolist()) for i in range(700)]  # a vector holds nearly half of all rows
    got = whitening.whiten(frame(spark, rows), top=16, weights=weights).toPandas()
    xs, n, sums, values, columns, trace = plain(rows, weights=weights)
    assert len(got) == 700 * 12 and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    signs = {}
    for r in got.itertuples():
        x, c = xs[r.id], r.component - 1
        off = [n * a - s for a, s in zip(x, sums)]
        assert int(r.deviation) == sum(o * o for o in off)
        assert abs(r.explained - values[c] / trace) < 1e-9
        want = float(np.array(off, float) / n @ columns[:, c]) / np.sqrt(values[c])
        if abs(want) > 1e-3:
            signs.setdefault(c, set()).add(int(np.sign(want * r.whitened)))
        assert abs(abs(want) - abs(r.whitened)) < 1e-7
    assert all(len(s) == 1 for s in signs.values())


def test_whole_table_has_unit_covariance(spark):
    got = queries.op12_whitening(spark, "/root/testdata/sf0.001").toPandas()
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    xs = np.array([[int(np.floor(64 * float(c))) for c in r.embedding]
                   for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()])
    distinct = np.unique(xs, axis=0, return_index=True)[1]
    z = wide.to_numpy()[distinct]
    cov = np.cov(z.T, bias=True)
    assert np.abs(cov - np.eye(16)).max() < 1e-8 and len(distinct) == got.n[0]
    assert (np.diff([got[got.component == c].explained.iloc[0] for c in range(1, 17)]) <= 1e-12).all()


def test_edges(spark):
    rows = [(0, [1, 0]), (1, [0, 1]), (1, [0, 1]), (2, [0, 0]), (3, None), (4, [1, None]), (5, [float("nan"), 1]),
            (6, [float("inf"), 1]), (7, [1, 2, 3]), (None, [1, 1]), (8, [1e300, 0]), (9, []), (10, [3, -2.001])]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    ids = sorted((-1 if i != i else int(i)) for i in got[got.component == 1].id)
    assert ids == [-1, 0, 1, 1, 2, 10] and set(got.component) == {1, 2} and set(got.n) == {5}
    assert got.identity_error[0] < 1e-9


def test_large_integers_stay_exact(spark):
    rows = [(i, [float(2 ** 45 + i * 3), float(-(2 ** 44) - i * i)]) for i in range(50)]
    got = whitening.whiten(frame(spark, rows)).where("component = 1").toPandas()
    xs, n, sums, *_ = plain(rows)
    assert {r.id: int(r.deviation) for r in got.itertuples()} == {
        i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in xs.items()}


def test_without_variance(spark):
    one = whitening.whiten(frame(spark, [(i, [1.5, 2.5, 0]) for i in range(4)])).toPandas()
    assert len(one) == 12 and one.whitened.isna().all() and one.identity_error.isna().all()
    assert set(one.deviation) == {0} and set(one.explained) == {0.0}
    flat = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)])).toPandas()
    assert flat[flat.component == 1].whitened.notna().all() and flat[flat.component == 3].whitened.isna().all()
    assert flat.identity_error[0] < 1e-9


def test_empty(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0])]).where("vec_id < 0")).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).columns == [
        "id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_weights_are_checked(spark):
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, [(1, [1.0])]), weights="twice").count()
