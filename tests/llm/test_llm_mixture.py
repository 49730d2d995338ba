import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeops.llm import mixture, oracles
from llm_cases import edge_docs, no_docs, rows_of


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    """Targets by sharing the excess again and again; ``sizes`` in order."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    full = set()
    while True:
        left = sum(sizes) - sum(cap * sizes[i] for i in full)
        over = sum(x for i, x in enumerate(w) if i not in full)
        target = [cap * s if i in full else w[i] * left / over for i, s in enumerate(sizes)]
        more = {i for i in range(len(sizes)) if i not in full and target[i] > cap * sizes[i]}
        if not more:
            return target
        full |= more


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 1, 2, 3, 5], [0, 10, 0, 7], [5], [10, 2000, 30, 4, 1, 1]])
def test_targets(spark, sizes):
    rows = [(i == len(sizes) - 1, "" if i == len(sizes) - 1 else f"s{i}", n) for i, n in enumerate(sizes)]
    got = {r.sid: r for r in mixture.targets(spark.createDataFrame(rows, "none boolean, source string, size long"))
           .collect()}
    assert [got[i].target for i in range(len(sizes))] == pytest.approx(plain_targets(sizes))
    assert got[len(sizes) - 1].none  # null comes last
    assert sum(r.target for r in got.values()) == pytest.approx(sum(sizes))


def test_sources_by_code_point(spark):
    names = ["b", "B", "é", "a", "🙂", "￿"]
    rows = [(False, n, 5) for n in names] + [(True, "", 5)]
    got = mixture.targets(spark.createDataFrame(rows, "none boolean, source string, size long")).collect()
    assert [r.source for r in sorted(got, key=lambda r: r.sid)] == ["B", "a", "b", "é", "￿", "🙂", ""]


def test_any_run_of_slots_is_close_to_the_shares(spark):
    unit = 1 << 32
    shares = spark.createDataFrame([(0, 0, unit // 2), (1, unit // 2, unit // 2 + unit // 8), (2, unit // 2 + unit // 8, unit)],
                                   "sid long, low long, high long")
    slots = [r.sid for r in mixture.schedule(spark, shares, 4000).orderBy("slot").collect()]
    for at in range(0, 3800, 190):
        run = slots[at:at + 200]
        for sid, share in ((0, .5), (1, .125), (2, .375)):
            assert abs(run.count(sid) - 200 * share) <= 4


def test_mix(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = mixture.mix(docs).toPandas()
    assert (got.taken <= 3 * got["size"]).all() and len(got) == docs.count()
    by = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by.taken - by.target) <= 3 * 32 + 1).all()
    again = mixture.mix(docs.repartition(7)).toPandas()
    key = ["id", "size", "taken"]
    pd.testing.assert_frame_equal(got[key].sort_values("id", ignore_index=True), again[key].sort_values("id", ignore_index=True))


def test_edges(spark):
    got = mixture.mix(edge_docs(spark), least_block=4)
    rows = rows_of(got, "id", "size", "taken")
    assert len(rows) == 12 and all(0 <= t <= 3 * s for _, s, t in rows)
    assert [s for i, s, _ in rows if i in (2, 3, 4)] == [0, 0, 0]
    assert mixture.mix(no_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert rows_of(mixture.mix(blank), "size", "taken", "target") == [(0, 0, 0.0), (0, 0, 0.0)]


def test_plan_has_no_python(spark):
    plan = mixture.mix(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "ArrowEval", "Cartesian", "NestedLoop"):
        assert word not in plan


def test_hot_source_with_null_and_tiny_sources_matches_sql(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 90)), "hot" if i % 3 else f"s{i % 7}" if i % 2 else None) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    documents = docs.toPandas()  # noqa: F841 - read by name
    want = duckdb.sql(f"WITH {oracles.mixture_ctes()} SELECT doc_id, size, taken FROM mixed").fetchall()
    got = mixture.mix(docs).select(F.col("id"), "size", "taken").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_blocks_do_not_grow_with_the_corpus(spark, monkeypatch):
    class Scheduled(Exception):
        pass

    def schedule(spark, shares, n_slots):
        raise Scheduled(n_slots)

    monkeypatch.setattr(mixture, "sizes", lambda text: F.lit(500_000_000).cast("bigint"))
    monkeypatch.setattr(mixture, "schedule", schedule)
    docs = spark.createDataFrame([(i, "", "small" if i == 3 else "large") for i in range(10)], "doc_id long, text string, source string")
    with pytest.raises(Scheduled) as told:
        mixture.mix(docs)
    assert told.value.args[0] == 5_000_000_000 // 32


def test_points_of_slots_beyond_the_range_of_products(spark):
    """``slot * GOLDEN`` leaves a long from slot 3.47 billion on; from 2 ** 32 on the points start anew."""
    slots = [0, 1, 65535, 65536, 3_474_700_000, 3_600_000_000, int(2 ** 31.7), (1 << 32) - 1, 1 << 32, (1 << 32) + 1, 10 ** 13 + 7]
    df = spark.createDataFrame([(s,) for s in slots], "slot long").select("slot", mixture.point(F.col("slot")).alias("p"))
    assert {r.slot: r.p for r in df.collect()} == {s: (s * mixture.GOLDEN + (1 << 31)) % (1 << 32) for s in slots}
