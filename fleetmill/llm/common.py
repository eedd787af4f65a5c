"""Helpers that the training-data operators share: reading tables, cutting lineage in the
cluster's shared folder, running a Python function over Arrow batches of texts, and connected
components on DataFrames."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetmill.shipping import ship

#: Bytes of texts that are Python objects at a time: bounds a worker's memory whatever the texts'
#: lengths (a longer text is taken alone).
ARROW_BYTES = 4 << 20

#: A side is broadcast only below this many rows (of two or three numbers each); it is counted first.
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir. Where that is unset, a local run gets
    an own one; on a cluster that is an error, as executors would write to their own disks."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        found = "file://" + tempfile.mkdtemp(prefix="fleetmill-")
        sc.setCheckpointDir(found)
    return found


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # the JVM has gone: the cluster cleans its folder
        return


def materialize(df: DataFrame, count: Column | None = None) -> tuple[DataFrame, Callable[[], None]]:
    """Write ``df`` as a table in the shared folder and read it back: lineage is cut, a lost
    executor costs nothing already written, and the work is done once (checkpoint() would run
    the plan twice). Also returns a function that deletes the table. The table knows how many rows it
    has (rows_of), counted while it was written, or for how many of them ``count`` is true."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/fleetmill-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), (F.count_if(count) if count is not None else F.lit(0)).alias("counted")).write.parquet(path)
    atexit.register(_drop_at_exit, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    got = seen.get
    if "rows" not in got:  # a plan that is known to be empty may be cut to nothing
        got = {"rows": out.count(), "counted": out.where(count).count() if count is not None else 0}
    out.written_rows, out.counted_rows = got["rows"], got["counted"]
    return out, lambda: drop_path(spark, path)


def rows_of(df: DataFrame) -> int:
    """The rows of a table: known, if it was written here, else counted."""
    known = getattr(df, "written_rows", None)
    return df.count() if known is None else known


class Tables:
    """Written intermediate tables that are dropped together, once the result is itself written."""

    def __init__(self):
        self.drops: list[Callable[[], None]] = []

    def put(self, df: DataFrame) -> DataFrame:
        out, drop = materialize(df)
        self.drops.append(drop)
        return out

    def finish(self, df: DataFrame) -> DataFrame:
        """``df`` as a written table; the others go."""
        out, _ = materialize(df)
        for drop in self.drops:
            drop()
        self.drops.clear()
        return out


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of about ARROW_BYTES, so that few texts are Python objects at a time."""
    rows = max(1, batch.num_rows * ARROW_BYTES // max(1, batch.nbytes))
    for k in range(0, max(1, batch.num_rows), rows):
        yield batch.slice(k, rows)


def map_texts(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """``rows`` turns the columns of one Arrow batch (as Python lists) into the output columns. Spark
    bounds its batches by bytes (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless set); they
    are worked on in slices of ARROW_BYTES."""
    spark = df.sparkSession
    ship(spark)
    out_schema = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                got = rows({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out_schema)


def join_small(left: DataFrame, right: DataFrame, on: str | list[str], how: str, rows: int | None = None) -> DataFrame:
    """Join with a right side of few short rows: broadcast if it was counted below BROADCAST_ROWS,
    else an ordinary shuffle join."""
    n = rows_of(right) if rows is None else rows
    return left.join(F.broadcast(right) if n <= BROADCAST_ROWS else right, on, how)


#: Keys with so many rows, and with a share of all rows, are hubs.
HUB_ROWS, HUB_SHARE = 1000, 1000


def hubs(rows: DataFrame, key: str) -> list:
    """Keys that a thousandth of all rows have: HUB_SHARE at most, whatever the table's size."""
    n = rows_of(rows)
    least = max(HUB_ROWS, n // HUB_SHARE)
    return [] if n < least else [r[key] for r in rows.groupBy(key).count().where(F.col("count") >= least).select(key).collect()]


def join_hubs(rows: DataFrame, values: DataFrame, key: str, found: list) -> DataFrame:
    """Inner join of many rows with one row of ``values`` for each key. Rows of the hubs ``found`` get
    theirs by broadcast, so no hub's rows are gathered; the others meet by a shuffle."""
    if not found:
        return rows.join(values, key)
    at_hub = F.col(key).isin(found)
    return rows.where(~at_hub).join(values, key).unionByName(rows.where(at_hub).join(F.broadcast(values.where(at_hub)), key))


def connected_components(edges: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``edges(a, b)`` of longs, in any direction, repeats allowed -> ``(node, component)``, the
    smallest node reachable. Labels hook to the smallest neighbouring label, then jump to their
    label's label, so long chains halve each round. All state stays in DataFrames; each round's
    labels are a written table (the last one dropped with ``tables``). A hub's edges are not gathered,
    and minima are taken before rows are shuffled."""
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both, drop_both = materialize(both.distinct())
    labels, drop = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    found = hubs(both, "b")
    while True:
        near = join_hubs(both, labels.select(F.col("node").alias("b"), "component"), "b", found)
        hooked = near.groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        new = labels.join(hooked, "node").select("node", F.least("component", "near").alias("low"), F.col("component").alias("was"))
        up = labels.select(F.col("node").alias("low"), F.col("component").alias("top"))
        new = new.join(up, "low").select("node", F.least("low", "top").alias("component"), "was")
        new, drop_new = materialize(new, F.col("component") != F.col("was"))
        drop()
        labels, drop = new.select("node", "component"), drop_new
        if not new.counted_rows:
            drop_both()
            labels.written_rows = new.written_rows
            if tables:
                tables.drops.append(drop)
            return labels


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
