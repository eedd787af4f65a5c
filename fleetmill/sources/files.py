"""File sources: JSON streams, static CSV feeds bound by column name, and SQL over files."""

from __future__ import annotations

import os
import shutil
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import IO
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill import schemas
from fleetmill.config import DEFAULT, Settings


def json_stream(spark: SparkSession, path: str, schema: str = schemas.RAW_POSITIONS, files_per_batch: int | None = None, latest_first: bool = False) -> DataFrame:
    """New files of JSON lines, gzip too, as they appear. Folders such as year=…/hour=… are walked;
    only the schema's columns come out."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("latestFirst", latest_first)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def table_stream(spark: SparkSession, path_or_name: str, schema: str | None = None) -> DataFrame:
    """A Parquet folder (with a schema) or a catalog table (without) as a stream."""
    return spark.readStream.schema(schema).parquet(path_or_name) if schema else spark.readStream.table(path_or_name)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, bound by name: columns may stand in any order, more are ignored, missing
    ones are null, and what doesn't parse is null."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    found = {c.strip().lstrip("﻿"): c for c in raw.columns}
    fields = [f.strip().split() for f in schema.split(",")]
    return raw.select(*[(F.trim(F.col(f"`{found[n]}`")).try_cast(t) if n in found else F.lit(None).cast(t)).alias(n) for n, t in fields])


def download_feed(url: str, target: str, timeout: float = 120, fetch: Callable[..., IO[bytes]] = urlopen) -> str:
    """Downloads an archive to ``target`` in a stream; an unfinished one leaves no file there."""
    part = f"{target}.part"
    os.makedirs(os.path.dirname(os.path.abspath(target)), exist_ok=True)
    with fetch(url, timeout=timeout) as answer, open(part, "wb") as f:
        shutil.copyfileobj(answer, f)
    os.replace(part, target)
    return target


@contextmanager
def extracted(archive: str, folder: str) -> Iterator[str]:
    """A zip feed unpacked into ``folder`` (one that executors see); removed afterwards, so results
    have to be written inside the block."""
    os.makedirs(folder, exist_ok=True)
    try:
        with zipfile.ZipFile(archive) as z:
            z.extractall(folder)
        yield folder
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def read_gtfs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The feed's files by name."""
    return {name: read_csv(spark, f"{folder}/{name}.txt", schema) for name, schema in schemas.GTFS.items()}


def read_census(spark: SparkSession, path: str, cfg: Settings = DEFAULT) -> DataFrame:
    """Tracts of the municipality, from CSV or Parquet by the path's ending."""
    rows = spark.read.schema(schemas.CENSUS).parquet(path) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path, schemas.CENSUS)
    return rows.where(F.col("municipality_code") == cfg.municipality)


def create_from_csv(spark: SparkSession, table: str, path: str, select: str = "*") -> None:
    """CREATE TABLE … AS SELECT over a CSV file with a header; replaces the table."""
    view = f"_csv_{uuid.uuid4().hex}"  # a name of its own: several may run in one session
    spark.read.option("header", True).csv(path).createOrReplaceTempView(view)
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet AS SELECT {select} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
