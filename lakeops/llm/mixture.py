"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Targets are filled like water: every source gets its share by weight, but no
more than ``cap`` times what it has; the excess is shared out again by weight.

The schedule is a row of slots of equally many words.  Slot ``t`` lies at the
golden-ratio point ``t * phi mod 1``, and the cumulative targets say whose slot
that is, so every run of slots holds the sources close to their shares.  Each
source's documents are shuffled by a hash, laid end to end and cut into blocks
of as many words; its slots, ranked, take its blocks in turn, again from the
first when all are used.

All arithmetic of the schedule is in integers (points and cumulative shares are
parts of 2**32), so reruns and other engines agree exactly.

Scale: a block has ``least_block`` words however large the corpus is, so a source's
error is the same few blocks everywhere; slots grow with the words.  Rankings and
running sums go by chunks, so a source that holds most rows is spread over many
tasks.

Nulls and edges: a null text has size 0; null is a source like any other, the
last one; a document of size 0 takes part in no block and is taken 0 times;
repeated rows are separate documents, each with a place of its own;
a corpus without words has no slots.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import SPACE_WORD, chunked_running, materialise

# 2**32 divided by the golden ratio, to the nearest odd integer (fixed value).
GOLDEN = 2654435769
UNIT = 1 << 32
# Slots, or sources, in one chunk of a running sum.
_CHUNK = 1 << 16


def sizes(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``(none, source, sid, size, weight, target)`` from ``(none, source, size)``.

    ``none`` marks the null source.  Sources are numbered by code point, null
    last, and weigh ``weights`` in turn.  Each round of sharing is an aggregate of
    the source table; only its totals come to the driver.
    """
    # Ranks by ranges of names: a range is numbered on its own and starts after those before it.
    ranged = sources.repartitionByRange("none", "source").withColumn("part", F.spark_partition_id())
    numbered = materialise(
        chunked_running(materialise(ranged.withColumn("one", F.lit(1)).withColumn("all", F.lit(0)), "sources"),
                        ["all"], "part", ["none", "source"], "one", "sid")
        .select("none", "source", F.col("sid").cast("bigint").alias("sid"), "size",
                F.element_at(F.array(*[F.lit(w) for w in weights]),
                             (F.col("sid") % len(weights) + 1).cast("int")).cast("bigint").alias("weight")),
        "source-ranks")
    total = numbered.agg(F.sum("size")).first()[0] or 0
    # A source is full once cap * size <= weight * left / weights of the others; cross-multiplied, exact.
    left, over = total, numbered.agg(F.sum("weight")).first()[0] or 0
    full = F.lit(False)
    while over:
        at_cap = (F.lit(cap).cast("decimal(38,0)") * F.col("size") * F.lit(over)
                  < F.lit(left).cast("decimal(38,0)") * F.col("weight"))
        used, stay = numbered.agg(F.coalesce(F.sum(F.when(at_cap, cap * F.col("size"))), F.lit(0)),
                                  F.coalesce(F.sum(F.when(~at_cap, F.col("weight"))), F.lit(0))).first()
        full = at_cap
        if (total - used, stay) == (left, over):
            break
        left, over = total - used, stay
    share = (F.col("weight") * F.lit(left)) / F.lit(over or 1).cast("double")
    return numbered.withColumn("target", F.when(full, (cap * F.col("size")).cast("double"))
                               .otherwise(share.cast("double")))


def point(slot: Column) -> Column:
    """``slot * GOLDEN + UNIT / 2`` modulo ``UNIT``, in halves that no product of which leaves a long.

    Each run of ``UNIT`` slots visits every point once, so what follows it may start anew.
    """
    high, low = F.shiftright(slot, 16) % (1 << 16), slot % (1 << 16)
    return (low * GOLDEN + (high * GOLDEN % (1 << 16)) * (1 << 16) + (UNIT >> 1)) % UNIT


def schedule(spark: SparkSession, shares: DataFrame, n_slots: int) -> DataFrame:
    """``(slot, sid)`` for ``n_slots`` slots; ``shares(sid, low, high)`` cut ``[0, 2**32)``.

    Slots and shares meet by the leading bits of their place: a share is listed
    under every bucket that it touches, so no slot is compared with all sources.
    """
    buckets = max(1, shares.count())
    width = max(1, UNIT // buckets)
    slots = (spark.range(n_slots).withColumnRenamed("id", "slot")
             .withColumn("point", point(F.col("slot")))
             .withColumn("bucket", F.floor(F.col("point") / width)))
    listed = shares.where("high > low").withColumn("bucket", F.explode(F.sequence(
        F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    return (slots.join(listed, "bucket").where("low <= point AND point < high").select("slot", "sid"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, least_block: int = 32) -> DataFrame:
    """``(id, key, size, source_size, target, taken, sid)`` for each row of ``docs``.

    ``taken``: words that the mix takes from the row, repeats counted; ``key``: the
    hash of its text, by which callers find the row again; ``sid``: its source's number.
    """
    spark = docs.sparkSession
    rows = materialise(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(source_col).isNull().alias("none"),
        F.coalesce(source_col, F.lit("")).alias("source"), sizes(F.col(text_col)).alias("size")), "mix-sizes")
    sources = targets(rows.groupBy("none", "source").agg(F.sum("size").alias("size")), weights, cap)
    sources = materialise(sources, "mix-targets")
    total, n_sources, last = sources.agg(F.sum("size"), F.count("*"), F.max("sid")).first()
    block, n_slots = least_block, -(-(total or 0) // least_block)
    # Shares of the schedule as parts of 2**32; what rounding leaves belongs to the last source.
    parts = sources.select("sid", "size", F.floor(F.col("target") / F.lit(float(total or 1)) * UNIT).alias("part"))
    placed = chunked_running(parts.withColumn("all", F.lit(0)).withColumn("chunk", F.floor(F.col("sid") / _CHUNK)),
                             ["all"], "chunk", ["sid"], "part", "low")
    shares = placed.select("sid", "low", F.when(F.col("sid") == last, F.lit(UNIT))
                           .otherwise(F.col("low") + F.col("part")).alias("high"))
    ranked = chunked_running(
        schedule(spark, shares, n_slots).withColumn("one", F.lit(1))
        .withColumn("chunk", F.floor(F.col("slot") / _CHUNK)),
        ["sid"], "chunk", ["slot"], "one", "rank")
    # Documents end to end in the order of a hash of their id.
    numbered = rows.join(sources.select("none", "source", "sid", F.col("size").alias("source_size"), "target"),
                         ["none", "source"])
    shuffled = F.md5(F.concat(F.lit("mix"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    laid = chunked_running(
        numbered.withColumn("order", shuffled).withColumn("chunk", F.substring(shuffled, 1, 3)),
        ["sid"], "chunk", ["order", "id", "key"], "size", "begin")
    laid = materialise(laid.select("sid", "id", "key", "size", "source_size", "target", "begin"), "mix-laid")
    # How often each block is taken: its source's slots in turn, at most ``cap`` rounds.
    blocks = F.ceil(F.col("size") / block).cast("bigint")
    taken_blocks = (ranked.join(sources.select("sid", "size").where("size > 0"), "sid")
                    .where(F.col("rank") < cap * blocks)
                    .groupBy("sid", (F.col("rank") % blocks).alias("block")).agg(F.count("*").alias("times")))
    # The blocks that each document touches, and how many of its words are in each.
    touched = (laid.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block))))
        .withColumn("words", F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block)
                    - F.greatest(F.col("begin"), F.col("block") * block)))
    taken = (touched.join(taken_blocks, ["sid", "block"])
             .groupBy("sid", "begin").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    # Where documents of size 0 begin, another one does too: they take nothing.
    return (laid.join(taken, ["sid", "begin"], "left")
            .select("id", "key", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0))
                    .cast("bigint").alias("taken"), "sid"))


def copies(mixed: DataFrame) -> DataFrame:
    """``(id, key, copies)``: what the mix takes, in whole documents.

    The documents of a source are gone through in an order of their own (a hash), and a running sum
    of the shares taken is rounded up: each source's copies are what was taken, to less than one
    document more, and a source from which anything is taken keeps at least one document.
    """
    unit = 1 << 20
    shares = (mixed.where("size > 0").groupBy("sid", "id", "key")
              .agg(F.ceil(F.sum("taken") * unit / F.sum("size")).cast("bigint").alias("share"))
              .withColumn("order", F.md5(F.concat_ws(":", F.lit("copies"), F.col("id").cast("string"), "key"))))
    run = chunked_running(shares.withColumn("chunk", F.substring("order", 1, 3)), ["sid"], "chunk", ["order", "id", "key"],
                          "share", "before")
    upto = lambda c: F.ceil(c / unit)
    return run.select("id", "key", (upto(F.col("before") + F.col("share")) - upto(F.col("before"))).cast("int").alias("copies"))
