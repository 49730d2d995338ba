"""Secret scans over an incremental blob ledger.

Every historical version of every path is content-addressed by SHA-256.  The
ledger remembers which pairs of blob and rule version have been scanned, and
what was found; a run scans only the pairs it has not seen, each blob once
however many paths hold it, and joins the findings back to all paths.

A ledger is two Parquet tables in one shared folder, both appended to:
``scans(blob, rule_version)`` and ``findings(blob, rule_version, spans)``.
Findings are written before scans, and readers take each pair once, so a run
that is lost half-way is simply scanned again.

Nulls and edges: null content counts as empty text; an empty text is a blob
without findings; repeated rows and equal texts share one scan; rows with a
null path are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches of at least ``least`` characters in ``group`` count.

    ``base`` rules are the contract's; the others are added by this method.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    base: bool = False


# The base kinds, in the order in which spans at one start are listed.
BASE_RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, group=2, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 16, base=True),
    Rule("hex", r"[0-9a-f]+", 32, base=True),
)
# Added by the method: public formats of private keys and service tokens.
EXTRA_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]+", 20),
)
RULES = BASE_RULES + EXTRA_RULES


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    """A name for a set of rules that changes whenever one of them does."""
    told = json.dumps([[r.kind, r.pattern, r.least, r.group] for r in rules])
    return hashlib.sha256(told.encode()).hexdigest()[:16]


def find_spans(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start, then in the rules' order.

    Per kind, matches are leftmost and do not overlap; one that is too short is
    dropped and still uses up its characters.
    """
    found = []
    for order, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text):
            start, end = m.span(rule.group)
            if end - start >= rule.least:
                found.append((m.start(), order, m.end()))
    return [(rules[order].kind, start, end) for start, order, end in sorted(found)]


def spans_column(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The spans of each text, found in Arrow batches."""

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t, rules)]
                             for t in texts], dtype=object)

    return F.pandas_udf(scan, SPANS)(text)


class BlobLedger:
    """What has been scanned, and what was found, in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scans(self) -> DataFrame:
        return self._read("scans", "blob string, rule_version string")

    def findings(self) -> DataFrame:
        return self._read("findings", f"blob string, rule_version string, spans {SPANS}")

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, content: str = "content") -> str:
        """Scan the blobs of ``versions`` that these rules have not seen; return the rule version."""
        name = rule_version(rules)
        text = F.coalesce(F.col(content), F.lit(""))
        seen = self.scans().where(F.col("rule_version") == name).select("blob")
        # One row per blob: copies are dropped in each task before the shuffle.
        unseen = (versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
                  .dropDuplicates(["blob"]).join(seen, "blob", "left_anti"))
        (unseen.select("blob", F.lit(name).alias("rule_version"), spans_column(F.col("text"), rules).alias("spans"))
         .write.mode("append").parquet(f"{self.path}/findings"))
        done = self.findings().where(F.col("rule_version") == name).select("blob", "rule_version").distinct()
        (done.join(seen, "blob", "left_anti").write.mode("append").parquet(f"{self.path}/scans"))
        return name

    def join_back(self, versions: DataFrame, version: str, content: str = "content", blob: str = "blob",
                  spans: str = "spans") -> DataFrame:
        """``versions`` without its content, each row with its ``blob`` and ``spans``."""
        text = F.coalesce(F.col(content), F.lit(""))
        rows = versions.withColumn(blob, F.sha2(text, 256)).drop(content)
        found = (self.findings().where((F.col("rule_version") == version) & (F.size("spans") > 0))
                 .select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob]))
        return rows.join(found, blob, "left").withColumn(spans, F.coalesce(spans, F.array().cast(SPANS)))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by ``[kind]``; overlapping spans are masked as one.

    Runs over the sorted spans once, so a text is rebuilt in time proportional
    to its length and number of spans.
    """

    def step(acc, s):
        return F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["parts"], F.array(
                F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")),
                F.concat(F.lit("["), s["kind"], F.lit("]")))).alias("parts"),
            s["end"].alias("at"))).otherwise(F.struct(
                acc["parts"].alias("parts"), F.greatest(acc["at"], s["end"]).alias("at")))

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("bigint").alias("at"))
    rest = lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(
        text, acc["at"].cast("int") + 1, F.char_length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
