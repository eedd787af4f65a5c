from datetime import datetime, timedelta

from core_data import DATA
from pyspark.sql import functions as F

from fleetmill import schemas
from fleetmill.plans import gold, silver
from fleetmill.plans import queries as registered
from fleetmill.plans import testbed as tb
from fleetmill.streaming import jobs, sinks


def test_replays_equal_batch_plans(spark):
    q = registered.queries()
    once = {(r["vehicle_id"], r["event_ts"]): r["event_id"] for r in silver.filter_box(tb.positions(spark, DATA)).collect()}
    got = q["stream_dedup_replay"](spark, DATA).collect()
    assert {(r["vehicle_id"], r["event_ts"]): r["event_id"] for r in got} == once and len(got) == len(once)
    columns = ["window_start", "h3_index", "line_code", "observation_count", "avg_speed_kmh"]
    batch = q["speed_hourly"](spark, DATA).select(*columns).collect()
    assert sorted(q["stream_hourly_replay"](spark, DATA).select(*columns).collect()) == sorted(batch)


def test_late_and_repeated_rows_are_dropped(spark, tmp_path):
    t = datetime(2026, 3, 16, 12)
    schema = "vehicle_id string, event_ts timestamp, latitude double, longitude double"
    batches = [[("a", t)], [("a", t), ("b", t + timedelta(hours=1))], [("c", t + timedelta(hours=2))], [("late", t)]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(v, at, -23.5, -46.6) for v, at in rows], schema.replace("timestamp", "timestamp_ntz"))
        df.withColumn("event_ts", F.col("event_ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = stream.withWatermark("event_ts", "10 minutes").dropDuplicatesWithinWatermark(["vehicle_id", "event_ts"]).withColumn("_event_date", F.lit("d"))
    sinks.append_stream(out, str(tmp_path / "out"), str(tmp_path / "check"), "late_rows").awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("vehicle_id").collect()) == ["a", "b", "c"]


def test_bronze_to_gold(spark, tmp_path):
    rows = tb.positions(spark, DATA).where("event_id < 400")
    # another vehicle of the line comes seven minutes later, so that there are headways
    more = rows.withColumns({"vehicle_id": F.concat(F.lit("x"), "vehicle_id"), "event_ts": F.col("event_ts") + F.expr("interval 7 minutes")})
    rows = rows.unionByName(more)
    at = lambda days: (F.col("event_ts") + F.expr(f"interval {days} days")).cast("string")
    raw = lambda days: rows.select("vehicle_id", "line_code", "line_number", "line_direction", "latitude", "longitude", "is_accessible", at(days).alias("event_timestamp"), at(days).alias("ingestion_timestamp"))
    raw(0).write.option("compression", "gzip").json(str(tmp_path / "raw"))
    p = lambda x: str(tmp_path / x)
    jobs.bronze(spark, p("raw"), p("bronze"), p("c1")).awaitTermination()
    assert {"_source_file", "_bronze_ingested_at"} <= set(spark.read.parquet(p("bronze")).columns)
    jobs.silver_positions(spark, p("bronze"), tb.routes(spark, DATA), p("silver"), p("c2")).awaitTermination()
    positions = spark.read.parquet(p("silver")).withColumn("_event_date", F.col("_event_date").cast("string"))
    assert positions.count() == silver.filter_box(rows).count()
    jobs.speed(spark, p("silver"), p("gold"), p("c3")).awaitTermination()
    got = spark.read.parquet(p("gold"))
    near = positions.withColumn("_d", F.col("event_ts"))
    assert 0 < got.agg(F.sum("observation_count")).first()[0] <= gold.instantaneous_speed(near).count()
    stops = tb.stops(spark, DATA).withColumn("route_id", F.lit("R"))
    jobs.stop_arrivals(spark, p("silver"), stops, p("arrivals"), p("c4")).awaitTermination()
    arrivals = spark.read.schema(schemas.STOP_ARRIVALS).parquet(p("arrivals"))
    # windows that the watermark has passed are given out, exactly as a batch has them
    batch = silver.stop_arrivals(positions, stops)
    last = silver.arrival_candidates(positions, stops).agg(F.max("arrival_time")).first()[0] - timedelta(minutes=15)
    closed = batch.where(F.window("arrival_time", "5 minutes")["end"] <= F.lit(last))
    key = ["vehicle_id", "stop_id", "arrival_time", "distance_to_stop_m"]
    assert sorted(arrivals.select(*key).collect()) == sorted(closed.select(*key).collect()) != []
    assert arrivals.count() > 0.9 * batch.count()
    # gold of arrivals, streamed from the table while it grows
    calls = tb.timetable(spark, DATA).drop("stop_id").crossJoin(stops.select("stop_id"))
    for days in (0, 30):
        if days:
            raw(days).write.mode("append").option("compression", "gzip").json(p("raw"))
            jobs.bronze(spark, p("raw"), p("bronze"), p("c1")).awaitTermination()
            jobs.silver_positions(spark, p("bronze"), tb.routes(spark, DATA), p("silver"), p("c2")).awaitTermination()
            jobs.stop_arrivals(spark, p("silver"), stops, p("arrivals"), p("c4")).awaitTermination()
        jobs.headway(spark, p("arrivals"), p("headway"), p("c5")).awaitTermination()
        jobs.on_time(spark, p("arrivals"), calls, p("on_time"), p("c6")).awaitTermination()
    arrivals = spark.read.schema(schemas.STOP_ARRIVALS).parquet(p("arrivals"))
    for path, want in (("headway", gold.headway_metrics(gold.headways(arrivals))), ("on_time", gold.on_time_hourly(gold.match_schedule(arrivals, calls)))):
        got = spark.read.parquet(p(path)).withColumn("_event_date", F.col("_event_date").cast("string")).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


def test_a_repeated_batch_leaves_no_rows_twice(spark, tmp_path):
    handle = sinks.batch_writer(str(tmp_path / "out"), "q")
    for _ in range(2):
        handle(spark.range(5), 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02")], "x int, _event_date string")
    sinks.replace_partitions(df, str(tmp_path / "t"))
    sinks.replace_partitions(df.where("x = 2").withColumn("x", F.lit(9)), str(tmp_path / "t"))
    assert sorted(r["x"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 9]


def test_touched_days_are_read_alone(spark, tmp_path):
    """A late row costs its own days, not those between."""
    rows = spark.createDataFrame([(str(d), f"2026-01-{d:02d}") for d in range(1, 29)], "x string, _event_date string")
    rows.write.partitionBy("_event_date").parquet(str(tmp_path / "silver"))
    seen = []

    def compute(df):
        seen.append(sorted(r[0] for r in df.select("_event_date").distinct().collect()))
        return df

    handle = sinks.recompute_touched(str(tmp_path / "silver"), str(tmp_path / "gold"), compute, "x", "x string, _event_date string")
    handle(rows.where("x in ('3', '20')"), 0)
    assert seen == [[f"2026-01-{d:02d}" for d in (2, 3, 4, 19, 20, 21)]]
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "gold")).select("x").collect()) == ["20", "21", "3", "4"]


def test_runner_runs_all_jobs_in_order(spark, tmp_path):
    from fleetmill import runner

    rows = tb.positions(spark, DATA).where("event_id < 300").withColumn("event_ts", F.col("event_ts").cast("string"))
    raw = rows.select("vehicle_id", "line_code", "line_number", "line_direction", "latitude", "longitude", "is_accessible", F.col("event_ts").alias("event_timestamp"), F.col("event_ts").alias("ingestion_timestamp"))
    root = str(tmp_path / "lake")
    raw.write.json(f"{root}/raw")
    tb.routes(spark, DATA).write.parquet(f"{root}/gtfs_routes")
    tb.stops(spark, DATA).withColumn("route_id", F.lit("R")).write.parquet(f"{root}/gtfs_stops")
    tb.timetable(spark, DATA).write.parquet(f"{root}/gtfs_stop_times")
    silver.census_table(tb.census(spark, DATA)).write.parquet(f"{root}/census")
    day = rows.select(F.substring("event_ts", 1, 10)).first()[0]
    runner.main(["pipeline", "--root", root, "--date", day], spark)
    for table in ("bronze", "positions", "stop_arrivals", "speed_congestion", "fleet_utilization", "coverage_equity"):
        assert spark.read.parquet(f"{root}/{table}").count() > 0, table
    runner.main(["fleet", "--root", root, "--date", day], spark)
    assert {str(r[0]) for r in spark.read.parquet(f"{root}/fleet_utilization").select("_event_date").distinct().collect()} == {day}
