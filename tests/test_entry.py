import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from core_data import DATA

from fleetmill.plans import oracle
from fleetmill.plans import queries as registered

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    value = lambda x: round(x, 4) if isinstance(x, float) else str(x)
    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql_and_the_entry_needs_no_session():
    assert set(oracle.oracle_sql()) == set(registered.queries())
    top = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert len(e.queries()) >= 47"], cwd=top, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("name", ["speed_hourly", "headway_hourly", "stop_arrivals_grid", "on_time_hourly", "fleet_utilization", "coverage_equity"])
def test_results_equal_sql(spark, name):
    engine = duckdb.connect()
    for t in TABLES:
        engine.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = registered.queries()[name](spark, DATA)
    cursor = engine.execute(oracle.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    want = plain(cursor.fetchall(), names)
    assert sorted(names) == sorted(got.columns)
    assert plain(got.collect(), got.columns) == want
