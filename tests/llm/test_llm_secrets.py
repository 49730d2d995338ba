import re
import uuid

from pyspark.sql import functions as F

from lakeops.llm import secrets
from lakeops.session import scratch_path
from llm_cases import edge_docs, no_docs


def test_spans():
    key = "AKIA" + "Z" * 12
    text = f"é PassWord: 'abcdefgh' token=short {key} x" + "ab12" * 8 + " secret=secret=12345678 API_KEY = \"zzzzzzzzz"
    got = secrets.find_spans(text)
    assert [k for k, _, _ in got] == ["assign", "access", "hex", "assign", "assign"]
    assert text[got[0][1]:got[0][2]] == "PassWord: 'abcdefgh"
    assert text[got[3][1]:got[3][2]] == "secret=secret=12345678"
    assert secrets.find_spans("") == []


def test_a_match_that_is_too_short_uses_up_its_characters():
    # "token=token" is matched and dropped; what is left has no keyword before its sign.
    assert secrets.find_spans("token=token\"=abcdefgh") == []


def test_spans_at_one_start_follow_the_rules():
    rules = (secrets.Rule("b", "[a-z]+", 1, base=True), secrets.Rule("a", "[a-z0-9]+", 1))
    assert secrets.find_spans("abc1", rules) == [("b", 0, 3), ("a", 0, 4)]


def test_ledger_scans_only_what_it_has_not_seen(spark):
    ledger = secrets.BlobLedger(spark, scratch_path(spark, "ledger"))
    day1 = spark.createDataFrame([("a", 1, "password=abcdefgh1"), ("b", 1, "password=abcdefgh1"), ("c", 1, None)],
                                 "path string, version int, content string")
    day2 = day1.union(spark.createDataFrame([("a", 2, "AKIA" + "B" * 16), ("c", 2, "clean")], day1.schema))
    version = ledger.update(day1)
    assert (ledger.scans().count(), ledger.findings().count()) == (2, 2)
    ledger.update(day1)
    assert ledger.findings().count() == 2
    ledger.update(day2)
    assert ledger.findings().count() == 4 and ledger.scans().count() == 4
    got = {(r.path, r.version): [s.kind for s in r.spans] for r in ledger.join_back(day2, version).collect()}
    assert got == {("a", 1): ["assign"], ("b", 1): ["assign"], ("c", 1): [], ("a", 2): ["access"], ("c", 2): []}
    # Other rules are another version: every blob is due again.
    other = (secrets.Rule("word", "clean", 1),)
    name = ledger.update(day2, other)
    assert name != version and ledger.findings().where(F.col("rule_version") == name).count() == 4
    assert ledger.join_back(day2, name).where(F.size("spans") > 0).count() == 1


def test_masked(spark):
    text = "日本 password=abcdefgh1, " + "0" * 40 + " end"
    spans = [{"kind": k, "start": s, "end": e} for k, s, e in secrets.find_spans(text)]
    overlap = [{"kind": "a", "start": 0, "end": 5}, {"kind": "b", "start": 3, "end": 8}]
    rows = spark.createDataFrame([(text, spans), ("x", []), (None, []), ("abcdefghij", overlap)],
                                 f"text string, spans {secrets.SPANS}")
    got = [r[0] for r in rows.select(secrets.masked(F.col("text"), F.col("spans"))).collect()]
    assert got == ["日本 [assign], [hex] end", "x", None, "[a]ij"]


def test_edges(spark):
    versions = edge_docs(spark).select("doc_id", F.col("text").alias("content"))
    ledger = secrets.BlobLedger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    back = ledger.join_back(versions, ledger.update(versions))
    assert back.count() == 12
    assert [(r.doc_id, secrets.RULES[0].kind) for r in back.where(F.size("spans") > 0).collect()] == [(7, "assign")]
    empty = secrets.BlobLedger(spark, scratch_path(spark, "ledger-empty"))
    none = no_docs(spark).select("doc_id", F.col("text").alias("content"))
    assert empty.join_back(none, empty.update(none)).count() == 0


def test_patterns_know_ascii_case_only():
    assert secrets.find_spans("paſſword=abcdefghi") == []
    assert re.compile(secrets.BASE_RULES[0].pattern).match("API_key = abcdefgh")
