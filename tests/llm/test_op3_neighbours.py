from functools import reduce

import numpy as np

from fleetmill.llm import op3_neighbours as nn

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors], SCHEMA)


def recall(got, ids, x, k=20):
    """Share of the true neighbours found, by a plain matrix product."""
    at = {int(i): n for n, i in enumerate(ids)}
    hits = []
    for i, g in got.groupby("query_id"):
        exact = x @ x[at[i]]
        exact[at[i]] = -np.inf
        hits.append(len(set(ids[np.argsort(-exact, kind="stable")[:k]].tolist()) & set(g["vec_id"])) / k)
    return np.mean(hits)


def test_recall_on_embeddings_whatever_their_norms(spark):
    """On the given table, and with its vectors stretched by log-normal factors."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(np.float32)
    for spread in (0.0, 0.5, 1.0):
        v = x * np.random.default_rng(7).lognormal(0, spread, len(x)).astype(np.float32)[:, None]
        df = table(spark, zip(ids.tolist(), v.tolist()))
        got = nn.nearest(df, df.where("vec_id % 20 = 0"), block=1000).toPandas()
        assert (got.groupby("query_id").size() == 20).all()
        assert recall(got, ids, v.astype(float)) >= 0.9, spread


def test_equal_vectors_tie_by_id(spark):
    """Their scores are equal to the last bit, wherever they stand, so the smaller ids come first."""
    rng = np.random.default_rng(11)
    one = rng.normal(size=64).astype(np.float32)
    others = (rng.normal(size=(700, 64)) * 0.1).astype(np.float32)
    order = rng.permutation(740)
    vectors = [(int(i), (one if n < 40 else others[n - 40]).tolist()) for n, i in enumerate(order)]
    df = table(spark, [*vectors, (100_000, (one * 0.5).tolist())])
    got = nn.nearest(df, df.where("vec_id = 100000"), block=97).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == sorted(int(i) for i in order[:40])[:20] and len({r["score"] for r in got}) == 1
    assert got[0]["score"] == reduce(lambda total, ab: total + float(ab[0]) * float(ab[1]), zip(one, one * np.float32(0.5)), 0.0)


def test_rows_that_share_no_pivot_are_not_touched():
    x = np.eye(40)
    files = nn.Postings(nn.lifted(x, 1.0), nn.lifted(x, 1.0)[:8], 2)
    assert sum(len(files.rows[files.starts[p] : files.starts[p + 1]]) for p in range(8)) == 80  # two postings a row
    assert set(files.candidates(np.append(x[3], 0.0), 1).tolist()) >= {3}


def test_lengths_of_their_own_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)] + [(100 + i, rng.normal(size=3).tolist()) for i in range(5)] + [(200, rng.normal(size=20_000).tolist()), (220, rng.normal(size=20_000).tolist())]
    df = table(spark, rows)
    got = nn.nearest(df, df.where("vec_id % 20 = 0"), k=4, block=16).toPandas()
    by = dict(rows)
    for i, g in got.groupby("query_id"):
        alike = [j for j, v in rows if j != i and len(v) == len(by[i])]
        assert len(g) == min(4, len(alike)) and set(g["vec_id"]) <= set(alike)
    assert set(got["query_id"]) == {0, 20, 40, 100, 200, 220}
    odd = df.selectExpr("vec_id", "embedding", "1 AS block", "2 AS chunk", "3 AS v", "4 AS score", "5 AS rank", "6 AS query_id")
    assert nn.nearest(odd, odd.where("vec_id % 20 = 0"), k=4, block=16).toPandas().equals(got.sort_values(["query_id", "rank"])) or nn.nearest(odd, odd.where("vec_id % 20 = 0"), k=4, block=16).count() == len(got)


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2500, 32)).astype(np.float32)
    x[:400] = x[0] + rng.normal(scale=0.01, size=(400, 32))  # a dense place
    df = table(spark, enumerate(x))
    got = nn.nearest(df, df.where("vec_id % 20 = 0"), k=10, block=1000, chunk=64).toPandas()
    q = np.arange(0, 2500, 20)
    exact = x[q].astype(float) @ x.astype(float).T
    exact[np.arange(len(q)), q] = -np.inf
    want = {int(i): set(np.argsort(-row, kind="stable")[:10].tolist()) for i, row in zip(q, exact)}
    assert set(got["query_id"]) == set(want)
    assert np.mean([len(want[i] & set(g["vec_id"])) / 10 for i, g in got.groupby("query_id")]) >= 0.9
    for i, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 11)) and (np.diff(g["score"]) <= 0).all()
        assert np.allclose(g["score"], exact[i // 20, g["vec_id"]])


def test_few_and_odd_vectors(spark):
    rows = [(0, [1, 0]), (1, [1, 0]), (2, [0.5, 0]), (3, None), (4, [0, 0]), (5, [None, 1]), (6, [float("nan"), 1]), (7, [float("inf"), 0]), (8, [1, 0]), (None, [1, 1]), (8, [1, 0]), (20, [1, 2, 3])]
    df = table(spark, rows)
    got = nn.nearest(df, df.where("vec_id % 20 = 0")).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 8), (0, 3, 2)]
    assert nn.nearest(df.limit(0), df.limit(0)).count() == 0
    assert nn.nearest(df.where("vec_id = 0"), df.where("vec_id = 0")).count() == 0
