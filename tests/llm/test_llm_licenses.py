import re

from pyspark.sql import functions as F

from lakeops.llm import licenses
from llm_cases import edge_docs, edge_rows, no_docs

GRANT = next(t.text for t in licenses.LONGER if t.name == "mit-grant")


def plain_places(text):
    words = re.findall(licenses.WORD, "".join(c.lower() if c.isascii() else c for c in text or ""))
    return len(words), sorted((t.label, i) for t in licenses.BASE for p in [t.text.split()]
                              for i in range(len(words)) if words[i:i + len(p)] == p)


def scan(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.id: r for r in licenses.scan(rows).collect()}


def test_places_are_those_of_a_plain_search(spark):
    texts = ["cc by nc cc by nc", "under the mit license under the mit under the mit license",
             "Apache License, Version 2.0 APACHE-LICENSE VERSION 2", "by nc", "", "cc  by\nnc", None,
             "the MIT license" * 5, "x " * 500 + "under THE mit LICENSE"]
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        n, places = plain_places(t)
        assert (got[i].n_words, [(p.label, p.start) for p in got[i].places]) == (n, places)


def test_quoted_license_with_changes(spark):
    words = GRANT.split()
    changed = words[:10] + ["really"] + words[10:30] + words[32:]
    got = scan(spark, ["some text first. " + GRANT + " and after", " ".join(changed), " ".join(words[:20]), "clean " * 99])
    assert [s.label for s in got[0].spans] == ["mit"] and got[0].spans[0].covered == 1.0
    assert got[0].spans[0].start == 3
    assert [s.label for s in got[1].spans] == ["mit"] and 0.8 <= got[1].spans[0].covered < 1
    assert got[2].spans == [] and got[3].spans == []


def test_edges(spark):
    got = licenses.scan(edge_docs(spark))
    rows = sorted(((r.id, r.n_words, [(p.label, p.start) for p in r.places]) for r in got.collect()), key=repr)
    assert rows == sorted(((r[0], *plain_places(r[1])) for r in edge_rows()), key=repr)
    assert licenses.scan(no_docs(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = licenses.scan(edge_docs(spark).withColumn("text", F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan) and "BroadcastHashJoin" in plan
