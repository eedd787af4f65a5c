"""Operators on ordered rows of a key: consecutive pairs and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_previous(df: DataFrame, key: list[str], order: list[str], columns: list[str], prefix: str = "prev_") -> DataFrame:
    """Adds the previous row's columns; the first row of each key is left out. One window
    expression carries them all."""
    last = F.lag(F.struct(*columns)).over(W.partitionBy(*key).orderBy(*order))
    got = df.withColumn("_prev", last).where(F.col("_prev").isNotNull())
    return got.select(*df.columns, *[F.col(f"_prev.{c}").alias(prefix + c) for c in columns])


def dedup_first(df: DataFrame, key: list[str | Column], order: list[str]) -> DataFrame:
    """One row for each key, the first by ``order``: the same whichever way rows are dealt. An
    aggregation, so that duplicates meet before they are shuffled."""
    names = [f"_k{i}" for i in range(len(key))]
    keyed = df.withColumns({n: F.col(k) if isinstance(k, str) else k for n, k in zip(names, key, strict=True)})
    best = keyed.groupBy(*names).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def entered(df: DataFrame, key: list[str], order: list[str], inside: str) -> DataFrame:
    """Rows at which a flag turns true, the first row of a key included if it is."""
    before = F.lag(inside, 1, False).over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("_before", before).where(F.col(inside) & ~F.coalesce("_before", F.lit(False))).drop("_before")
