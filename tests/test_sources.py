import gzip
import json
import zipfile
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from fleetmill import schemas
from fleetmill.sources import api, files, messages, tables

RECORDS = [{"vehicle_id": str(i), "line_code": 1} for i in range(10)]


def test_writer_chunks_and_sends_again_what_was_refused():
    calls, pauses = [], []

    def send(rows):
        calls.append([k for k, _ in rows])
        return [not (k == "3" and len(calls) == 1) for k, _ in rows]

    writer = messages.MessageWriter(send, batch=5, sleep=pauses.append)
    assert writer.write(RECORDS) == 10
    assert [len(c) for c in calls] == [5, 1, 5] and calls[1] == ["3"] and pauses == [0.5]
    assert messages.MessageWriter(lambda rows: [False] * len(rows), batch=5, sleep=pauses.append).write(RECORDS[:2]) == 0 and pauses == [0.5, 0.5, 1.0]
    assert messages.MessageWriter(send).write([]) == 0


def test_json_lines_in_dated_folders(tmp_path):
    at = datetime(2026, 3, 16, 7, 5, tzinfo=timezone.utc)
    assert messages.write_json_lines(RECORDS, str(tmp_path), at) == 10
    (found,) = tmp_path.rglob("*.json.gz")
    assert "year=2026/month=03/day=16/hour=07" in str(found) and [json.loads(x) for x in gzip.open(found, "rt")] == RECORDS


def test_archive_and_stream_agree(spark, tmp_path):
    df = spark.createDataFrame([("v", "2026-03-16T07:05:00")], "vehicle_id string, event_timestamp string")
    messages.archive(df, str(tmp_path / "a"), "event_timestamp")
    stream = files.json_stream(spark, str(tmp_path / "a"))
    assert stream.columns == [c.split()[0] for c in schemas.RAW_POSITIONS.split(", ")]
    query = stream.writeStream.format("memory").queryName("archived").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("archived").select("vehicle_id").collect()[0][0] == "v"


def test_objects_without_line_breaks():
    assert messages.split_objects('{"a":1}{"a":2} \n{"a":3}') == [{"a": 1}, {"a": 2}, {"a": 3}]


class Fake:
    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, method, path, cookie):
        self.asked.append((method, cookie))
        return self.answers.pop(0)


BODY = json.dumps({"hr": "12:00", "l": [{"c": "8000-10", "cl": 1, "sl": 1, "vs": [{"p": 5, "a": True, "ta": "t", "py": 1.0, "px": 2.0}]}, {"c": "x", "cl": 2, "sl": 1, "vs": []}]})


def test_client_signs_in_once_and_again_when_refused():
    fake = Fake((200, "true", "c1"), (200, BODY, None), (401, "", None), (200, "true", "c2"), (200, BODY, None))
    client = api.PositionClient(fake, "token")
    assert client.positions() == client.positions()
    assert fake.asked == [("POST", None), ("GET", "c1"), ("GET", "c1"), ("POST", None), ("GET", "c2")]
    for answers in ([(200, "false", None)], [(200, "true", "c"), (500, "", None)], [(200, "true", "c"), (401, "", None), (200, "true", "c"), (401, "", None)]):
        with pytest.raises(api.PollError):
            api.PositionClient(Fake(*answers), "token").positions()


def test_one_poll(tmp_path):
    summary = api.ingest_once(api.PositionClient(Fake((200, "true", "c"), (200, BODY, None)), "t"), str(tmp_path))
    assert (summary["status"], summary["written"], summary["lines"], summary["mode"]) == (200, 1, 2, "files")
    sent = []
    writer = messages.MessageWriter(lambda rows: sent.extend(rows) or [True] * len(rows))
    assert api.ingest_once(api.PositionClient(Fake((200, "true", "c"), (200, BODY, None)), "t"), writer)["written"] == 1 and sent[0][0] == "5"
    assert api.ingest_once(api.PositionClient(Fake((200, "true", "c"), (200, '{"hr": "1", "l": []}', None)), "t"), writer)["written"] == 0
    assert api.ingest_once(api.PositionClient(Fake((200, "false", None)), "t"), writer)["status"] == 500


def test_csv_binds_by_name_and_gtfs_loads(spark, tmp_path):
    feed = {
        "routes": "route_type,route_id,extra,route_short_name\n3,33000-10,x,8000\njunk,y,z,w\n",
        "stops": "stop_lat,stop_id,stop_lon,stop_name\n-23.5,s1,-46.6,One\n",
        "trips": "trip_id,route_id\nt1,33000-10\n",
        "stop_times": "trip_id,stop_id,arrival_time,departure_time,stop_sequence\nt1,s1,25:00:00,25:00:30,1\nt9,s1,01:00:00,01:00:00,1\n",
        "shapes": "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\n",
    }
    with zipfile.ZipFile(tmp_path / "feed.zip", "w") as z:
        for name, text in feed.items():
            z.writestr(f"{name}.txt", text)
    counts = tables.load_gtfs(spark, str(tmp_path / "feed.zip"), str(tmp_path / "work"), str(tmp_path / "out"))
    assert counts == {"routes": 2, "stops": 1, "trips": 1, "stop_times": 1, "shapes": 0} and not (tmp_path / "work").exists()
    routes = spark.read.parquet(str(tmp_path / "out/gtfs_routes")).orderBy("route_id").collect()
    assert [(r["route_id"], r["route_type"], r["line_code"], r["route_color"]) for r in routes] == [("33000-10", 3, 33000, None), ("y", None, None, None)]
    assert spark.read.parquet(str(tmp_path / "out/gtfs_stop_times")).first()["route_id"] == "33000-10"


def test_census_and_sql_tables(spark, tmp_path):
    (tmp_path / "census.csv").write_text("tract_code,municipality_code,population,households,avg_income_brl,area_km2,centroid_lat,centroid_lon\na,3550308,100,10,900,0.5,-23.5,-46.6\nb,1,5,5,5,5,0,0\n")
    assert tables.load_census(spark, str(tmp_path / "census.csv"), str(tmp_path / "out")) == 1
    assert spark.read.parquet(str(tmp_path / "out")).first()["income_bracket"] == "low"
    files.create_from_csv(spark, "tracts", str(tmp_path / "census.csv"), "tract_code, cast(population AS INT) AS population")
    files.create_from_csv(spark, "tracts", str(tmp_path / "census.csv"), "tract_code, cast(population AS INT) AS population")
    assert spark.table("tracts").agg(F.sum("population")).first()[0] == 105
    spark.sql("DROP TABLE tracts")


def test_download_leaves_no_part_behind(tmp_path):
    import io

    got = files.download_feed("https://example.org/feed.zip", str(tmp_path / "a/feed.zip"), fetch=lambda url, timeout: io.BytesIO(b"x" * 100_000))
    assert open(got, "rb").read() == b"x" * 100_000 and [f.name for f in (tmp_path / "a").iterdir()] == ["feed.zip"]

    def broken(url, timeout):
        raise OSError("no answer")

    with pytest.raises(OSError):
        files.download_feed("https://example.org/x", str(tmp_path / "b.zip"), fetch=broken)
    assert not (tmp_path / "b.zip").exists()


def test_tables_that_grew_a_column(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    spark.range(2, 4).selectExpr("id", "'new' AS extra").write.mode("append").parquet(str(tmp_path / "t"))
    assert sorted((r["id"], r["extra"]) for r in tables.read_table(spark, str(tmp_path / "t")).collect()) == [(0, None), (1, None), (2, "new"), (3, "new")]


def test_bronze_days_are_those_of_events(spark, tmp_path):
    from fleetmill.plans import silver

    (tmp_path / "a.json").write_text('{"vehicle_id": "1", "event_timestamp": "2026-03-16T23:59:00"}\n{"vehicle_id": "2", "event_timestamp": "junk"}\n')
    got = silver.with_lineage(spark.read.schema(schemas.RAW_POSITIONS).json(str(tmp_path))).orderBy("vehicle_id").collect()
    assert [str(r["_event_date"]) for r in got] == ["2026-03-16", "None"] and all(r["_source_file"].endswith("a.json") for r in got)


def test_polls_as_a_spark_source(spark, tmp_path):
    from fleetmill.shipping import ship

    (tmp_path / "fleet_fake.py").write_text(f"import json\ndef answer():\n    return json.loads({BODY!r})\n")
    spark.sparkContext.addPyFile(str(tmp_path / "fleet_fake.py"))
    ship(spark)
    spark.dataSource.register(api.PositionSource)
    got = spark.read.format("vehicle_positions").option("fetch", "fleet_fake:answer").load().collect()
    assert [r["vehicle_id"] for r in got] == ["5"] and got[0]["ingestion_timestamp"]
