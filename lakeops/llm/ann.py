"""Approximate nearest neighbours by adaptive dimension scan.

Vectors are rotated at random and assigned to the list of their nearest
centroid.  A query probes some lists; within a list the rotated vectors are held
by columns and scanned in blocks of dimensions.  After each block a hypothesis
test abandons the candidates whose partial distance already says that, but for a
small error, the whole distance exceeds the k-th best found so far.  The k best
are scored again on the original vectors in double precision.

The index (rotation, centroids, number of probes) is fitted on a bounded sample
of ``sample_rows`` rows; its size is bounded by that and ``max_lists``, so it
may be broadcast.  The probes are the fewest that find ``aim`` of the true
neighbours of sampled queries within the sample; a query whose lists hold too few
rows goes on to further ones until k candidates are certain, so every query gets k
rows, or all there are.  Every row is indexed.

A list may hold any share of the rows: it is dealt to tasks in cells of at most
about ``cell_rows`` rows, by a hash of the id, and a query is sent to each cell of
its lists; the k best of each cell are merged.

Nulls and edges: vectors that are null, zero, of another length than the most
frequent one, or that hold null or non-finite components take no part; neither
do rows with a null id.  Repeated rows (equal id and vector) count once; of
different vectors under one id the nearest counts.  A query's own id is no
candidate.  With fewer candidates than k all are returned.  Ties go to the smaller
id.  An empty table gives an empty result.  Only the two named columns are read, so
clashing names of others do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import materialise

# Dimensions scanned between two tests.
BLOCK = 16
# Of the test: a candidate is abandoned beyond (1 + EPSILON / sqrt(dimensions scanned)) times the bound.
EPSILON = 2.1


@dataclass
class Index:
    rotation: np.ndarray
    centroids: np.ndarray  # rotated
    probes: int


def usable(vector: Column, dims: int) -> Column:
    """Of the right length, all components finite, not all zero."""
    return F.coalesce((F.size(vector) == dims)
                      & F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nearest_lists(rotated: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centroids of each row, nearest first."""
    d = (centroids ** 2).sum(1) - 2 * rotated @ centroids.T
    return np.argsort(d, axis=1, kind="stable")[:, :n]


def _centroids(x: np.ndarray, n: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), n, replace=False)]
    for _ in range(rounds):
        own = _nearest_lists(x, c, 1)[:, 0]
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        held = np.bincount(own, minlength=n)
        c = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], c)
    return c


def fit(vectors: DataFrame, dims: int, k: int = 10, sample_rows: int = 20_000, max_lists: int = 1024,
        aim: float = 0.97, queries: int = 200, seed: int = 17) -> Index:
    """Learn an index from about ``sample_rows`` of ``vectors(id, vector)``, chosen by a hash of the id."""
    n = vectors.count()
    share = min(1.0, sample_rows / max(1, n))
    picked = vectors.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30))
    sample = picked.orderBy("id").select("vector").toPandas()["vector"]
    rng = np.random.default_rng(seed)
    q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
    rotation = q * np.sign(np.diag(r))
    if not len(sample):
        return Index(rotation, np.zeros((1, dims)), 1)
    x = np.array(sample.tolist(), float) @ rotation
    different = np.unique(x, axis=0)
    lists = int(max(1, min(max_lists, len(different), round(len(x) ** 0.5))))
    centroids = _centroids(different, lists, 10, rng)
    # Probes: how deep the true neighbours of sampled queries lie among their nearest lists.
    chosen = x[rng.choice(len(x), min(queries, len(x)), replace=False)]
    own = _nearest_lists(x, centroids, 1)[:, 0]
    order = _nearest_lists(chosen, centroids, lists)
    place = np.argsort(order, axis=1)
    squares = (x ** 2).sum(1)
    depths = []
    for i, y in enumerate(chosen):
        near = np.argsort(squares - 2 * x @ y, kind="stable")[1:k + 1]
        depths.append(place[i, own[near]])
    depths = np.concatenate(depths) if depths else np.zeros(1, int)
    probes = int(np.quantile(depths, aim, method="higher")) + 1 if len(depths) else lists
    return Index(rotation, centroids, min(lists, probes))


def scan_cell(rotated: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray,
              turned: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``k`` nearest rows of a cell.  ``rotated``: dimensions by rows."""
    dims, n = rotated.shape
    alive = np.flatnonzero(ids != query_id)
    partial = np.zeros(len(alive))
    bound, sure = np.inf, np.zeros(n, bool)
    for at in range(0, dims, BLOCK):
        if at and np.isfinite(bound):
            # Partial distances scaled up to all dimensions estimate the whole ones.
            stay = (partial * (dims / at) <= bound * (1 + EPSILON / at ** 0.5) ** 2) | sure[alive]
            alive, partial = alive[stay], partial[stay]
        block = rotated[at:at + BLOCK][:, alive] - turned[at:at + BLOCK, None]
        partial = partial + np.einsum("ij,ij->j", block, block)
        if at == 0 and len(alive) > k:
            # The whole distances of the k most promising rows give the first bound.
            first = alive[np.argpartition(partial, k - 1)[:k]]
            sure[first] = True  # a cell with k candidates gives k, whatever is abandoned
            gap = rotated[:, first] - turned[:, None]
            bound = float(np.einsum("ij,ij->j", gap, gap).max())
    if len(alive) > 4 * k:
        # Float sums may differ in the last places: keep some more for exact scoring, and all ties.
        cut = np.partition(partial, 2 * k)[2 * k]
        alive = alive[partial <= cut * (1 + 1e-5)]
    gap = vectors[alive] - query
    score = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    best = np.lexsort((ids[alive], score))
    # Several vectors under one id: the nearest one counts.
    _, first = np.unique(ids[alive][best], return_index=True)
    best = best[np.sort(first)][:k]
    return ids[alive][best], score[best]


def search(table: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           cell_rows: int = 8192, index: Index | None = None, **fitting) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest rows of each row that ``is_query``.

    ``is_query`` is a condition on a column named ``id``.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("bigint").alias("id"),
                        F.col(vector_col).cast("array<double>").alias("vector")).where("id IS NOT NULL")
    length = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("n")).count() \
        .orderBy(F.desc("count"), "n").first()
    dims = length["n"] if length else 1
    rows = materialise(rows.where(usable(F.col("vector"), dims)).dropDuplicates(["id", "vector"]), "ann-vectors")
    index = index or fit(rows, dims, k, **fitting)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for rows in batches:
            x = np.array(rows["vector"].tolist(), float).reshape(len(rows), dims) @ known.rotation
            yield rows.assign(list=_nearest_lists(x, known.centroids, 1)[:, 0].astype(np.int32),
                              rotated=list(x.astype(np.float32)))[["id", "vector", "list", "rotated"]]

    listed = rows.mapInPandas(assign, "id bigint, vector array<double>, list int, rotated array<float>")
    # Cells: as many for each list as its rows ask for.
    sizes = materialise(listed.groupBy("list").count(), "ann-lists")
    cells = sizes.select("list", F.ceil(F.col("count") / cell_rows).cast("int").alias("cells"))
    # Rows of each list, at most ``max_lists`` numbers; an id may have several rows, its own or another one's.
    held_by = np.zeros(len(index.centroids), np.int64)
    for r in sizes.collect():
        held_by[r["list"]] = r["count"]
    ids = rows.agg(F.count_distinct("id")).first()[0]
    needed = min(k + 1 + int(held_by.sum()) - ids, int(held_by.sum()))
    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for rows in batches:
            x = np.array(rows["vector"].tolist(), float).reshape(len(rows), dims) @ known.rotation
            order = _nearest_lists(x, known.centroids, len(known.centroids)).astype(np.int32)
            # As many lists as the index says, and on until k others must be among them.
            depth = np.maximum((np.cumsum(held_by[order], axis=1) < needed).sum(1) + 1, known.probes)
            yield rows.assign(list=[o[:d] for o, d in zip(order, depth)],
                              rotated=list(x.astype(np.float32)))[["id", "vector", "list", "rotated"]]

    cell = F.pmod(F.xxhash64("id", F.lit("cell")), F.col("cells")).cast("int")
    base = listed.join(cells, "list").select("list", cell.alias("cell"), "id", "vector", "rotated")
    asked = (rows.where(is_query).mapInPandas(
        probe, "id bigint, vector array<double>, list array<int>, rotated array<float>")
        .withColumn("list", F.explode("list")).join(cells, "list")
        .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .select("list", "cell", "id", "vector", "rotated"))

    def answer(held: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(queries):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        ids = held["id"].to_numpy(np.int64)
        vectors = np.array(held["vector"].tolist(), float)
        columns = np.ascontiguousarray(np.array(held["rotated"].tolist(), float).T)
        found = []
        for i, vector, turned in zip(queries["id"], queries["vector"], queries["rotated"]):
            near, score = scan_cell(columns, ids, vectors, i, np.array(vector, float), np.array(turned, float), k)
            found.append(pd.DataFrame({"query_id": i, "id": near, "score": score}))
        return pd.concat(found)

    found = (base.groupBy("list", "cell").cogroup(asked.groupBy("list", "cell"))
             .applyInPandas(answer, "query_id bigint, id bigint, score double"))
    best = found.groupBy("query_id", "id").agg(F.min("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
