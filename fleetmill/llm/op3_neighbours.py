"""Approximate nearest neighbours, by inner product, with a permutation index.

Rows get one more component, sqrt(M^2 - |v|^2), with M the largest norm among the drawn rows, and
queries a zero: the order of rows by angle to a query is then that by inner product, whatever their
norms. (Rows longer than M get a zero as well and are always reranked: about one in DRAWN.) A vector
is represented by the order of its LISTED nearest pivots. Rows are dealt into blocks; inside a block
each pivot has an inverted file of the rows that list it, with its place in each row's order. A query
reads the files of its own LISTED pivots and adds up LISTED - max(own place, row's place), which ranks
as the footrule distance does (places beyond LISTED count as LISTED): rows that share no pivot with
the query are not touched. The nearest by footrule, a fixed SHARE of the block but at least DEPTH
times the neighbours asked for, with all ties, are reranked by their exact inner products, summed in
the order of components, so equal vectors score alike to the last bit. The best of all blocks are
merged.

The share is of the block, so the candidates grow with the table and recall does not sink with it;
there is no cap on ties. That makes work queries times rows in the end: in these data, near uniform
on a sphere of 64 dimensions, fewer candidates lose recall. Pivots are a bounded, documented sample
(PIVOTS of DRAWN rows, drawn by a hash of vec_id); every row is indexed. Queries are dealt into
chunks, and a task has one block and one chunk, so memory is bounded whatever the numbers of rows and
queries.

Vectors that are null, zero, or that hold null or non-finite components, take no part, neither as
query nor as candidate; nor do rows with a null vec_id. Vectors are compared with those of their own
length: the most frequent length (of the drawn rows) is indexed, others are compared one by one. With
fewer candidates than asked for, all come out. Rows that share a vec_id count as one vector (the
smallest by components). Ties go to the smaller vec_id. Empty tables give no rows. Very long vectors
need no more than their block's memory; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmill.llm.common import read
from fleetmill.shipping import ship

PIVOTS, LISTED, DRAWN = 512, 64, 1024
SHARE, DEPTH = 0.15, 8
BLOCK, CHUNK = 8192, 4096


def usable(c: Column) -> Column:
    """Whether a vector takes part: finite components, not all zero."""
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(c.isNotNull() & fine & F.exists(c, lambda x: x != 0), F.lit(False))


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors of one more component, whose angles to a query order as inner products do."""
    more = np.sqrt(np.maximum(longest**2 - (rows * rows).sum(axis=1), 0))
    out = np.column_stack([rows, more])
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def choose_pivots(drawn: np.ndarray, pivots: int) -> np.ndarray:
    """The first drawn vectors, each once: copies would take the same places in all orders."""
    _, first = np.unique(drawn, axis=0, return_index=True)
    return drawn[np.sort(first)[:pivots]]


def orders(vectors: np.ndarray, pivots: np.ndarray, listed: int) -> np.ndarray:
    """For each vector its nearest pivots, in order."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :listed]


class Postings:
    """The inverted files of a block: for each pivot the rows that list it and its place there."""

    def __init__(self, rows: np.ndarray, pivots: np.ndarray, listed: int):
        self.size, self.pivots = len(rows), pivots
        self.listed = min(listed, len(pivots))
        order = orders(rows, pivots, self.listed).ravel()
        by_pivot = np.argsort(order, kind="stable")
        self.rows, self.places = by_pivot // self.listed, by_pivot % self.listed
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(order, minlength=len(pivots)))))

    def candidates(self, query: np.ndarray, want: int) -> np.ndarray:
        """At least ``want`` rows, if there are, nearest by footrule; all that tie with the last."""
        own = orders(query[None, :], self.pivots, self.listed)[0]
        parts = [slice(self.starts[p], self.starts[p + 1]) for p in own]
        near = np.concatenate([self.listed - np.maximum(self.places[s], r) for r, s in enumerate(parts)])
        score = np.bincount(np.concatenate([self.rows[s] for s in parts]), weights=near, minlength=self.size)
        if want >= self.size:
            return np.arange(self.size)
        return np.flatnonzero(score >= np.partition(score, self.size - want)[self.size - want])


def in_order(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed component by component: the same bits for the same vector anywhere."""
    total = np.zeros(len(rows))
    for k in range(len(query)):
        total += rows[:, k] * query[k]
    return total


def best_of(ids: np.ndarray, rows: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest rows by exact score, ties by id. A quick product first leaves out what can't
    be among them, whichever way its sum is rounded."""
    other = ids != query_id
    ids, rows = ids[other], rows[other]
    if len(ids) > k:
        with np.errstate(over="ignore", invalid="ignore"):
            quick = rows @ query
            noise = 8 * len(query) * np.finfo(float).eps * (np.abs(rows) @ np.abs(query)).max()
            least = np.partition(quick, len(quick) - k)[len(quick) - k] - noise
        if np.isfinite(least):
            ids, rows = ids[quick >= least], rows[quick >= least]
    exact = in_order(rows, query)
    best = np.lexsort((ids, -exact))[:k]
    return ids[best], exact[best]


def search_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray | None, longest: float, k: int, share: float = SHARE, listed: int = LISTED, scale: float = 1.0) -> pd.DataFrame:
    """The ``k`` nearest of the block for each query, among the nearest ``share`` by footrule; without
    pivots among all. The index sees vectors divided by ``scale``, scores are of the original ones."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if pivots is not None:
        small = rows / scale
        files = Postings(lifted(small, longest), pivots, listed)
        long = np.flatnonzero(np.linalg.norm(small, axis=1) > longest)
        want = min(len(ids), max(int(np.ceil(share * len(ids))), DEPTH * k))
        asking = np.column_stack([queries / np.abs(queries).max(axis=1, keepdims=True), np.zeros(len(queries))])
    for q in range(len(query_ids)):
        near = np.arange(len(ids)) if pivots is None else np.union1d(files.candidates(asking[q], want), long)
        found, exact = best_of(ids[near], rows[near], query_ids[q], queries[q], k)
        out["query_id"] += [int(query_ids[q])] * len(found)
        out["vec_id"] += found.tolist()
        out["score"] += exact.tolist()
    return pd.DataFrame(out)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int = PIVOTS, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Both of ``(vec_id long, embedding array)`` -> ``(query_id, rank, vec_id, score)``; a query
    isn't its own candidate."""
    spark = vectors.sparkSession
    ship(spark)

    def clean(df: DataFrame) -> DataFrame:
        vector = F.col("embedding").cast("array<double>")
        return df.where(F.col("vec_id").isNotNull() & usable(vector)).select("vec_id", vector.alias("v"))

    rows, asked = clean(vectors), clean(queries)
    # the first of a fixed order by hash: a bounded sample
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(DRAWN, 2 * pivots)).collect()
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = Counter(len(r["v"]) for r in drawn).most_common(1)[0][0]
    sample = np.array([r["v"] for r in drawn if len(r["v"]) == size])
    # far from the largest double, so that squares are finite
    scale = float(np.abs(sample).max())
    longest = float(np.linalg.norm(sample / scale, axis=1).max())
    found = choose_pivots(lifted(sample / scale, longest), pivots)
    n, m = rows.count(), asked.count()
    blocks, chunks = max(1, -(-n // block)), max(1, -(-m // chunk))
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    left = rows.withColumn("block", dealt).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if ours.empty or theirs.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

        def once(pdf: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
            """Ids and vectors by length; one vector for each id."""
            first = pdf
            if pdf["vec_id"].duplicated().any():
                first = pdf.assign(key=pdf["v"].map(tuple)).sort_values(["vec_id", "key"], kind="stable").drop_duplicates("vec_id")
            lengths = first["v"].map(len)
            return {int(n): (first.loc[lengths == n, "vec_id"].to_numpy(np.int64), np.stack(first.loc[lengths == n, "v"].to_numpy())) for n in lengths.unique()}

        rows, asked = once(ours), once(theirs)
        none = {"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")}
        out = [pd.DataFrame(none)]
        for n in rows.keys() & asked.keys():
            (ids, v), (query_ids, queries) = rows[n], asked[n]
            if n != size:
                out.append(search_block(ids, v, query_ids, queries, None, 0.0, k))
                continue
            out.append(search_block(ids, v, query_ids, queries, found, longest, k, scale=scale))
        return pd.concat(out)

    got = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return got.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))
