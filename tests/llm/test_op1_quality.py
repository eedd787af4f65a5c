import math
import re
import zlib
from collections import Counter

import numpy as np
from llm_data import DATA, long_text
from pyspark.sql import functions as F

from fleetmill.llm import op1_quality as q
from fleetmill.llm.common import read


def test_rules_find_a_conjunction_and_compile_to_the_same_score(spark):
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(q.STATS)))
    y = ((x[:, 3] > 0.5) & (x[:, 7] <= 0.4)).astype(float)
    intercept, rules = q.fit(x, y)
    assert 0 < len(rules) < 300
    by_hand = intercept + sum(w * np.logical_and.reduce([(x[:, f] > b) == above for f, above, b in rule]) for w, rule in rules)
    assert (((1 / (1 + np.exp(-by_hand))) >= 0.5) == (y == 1)).mean() > 0.98
    table = spark.createDataFrame([tuple(float(v) for v in row) for row in x[:200]], list(q.STATS))
    got = [r[0] for r in table.select(q.compile_score(intercept, rules)).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-by_hand[:200])))


def test_held_out_accuracy(spark):
    labels = read(spark, DATA.replace("0.001", "0.01"), "labels")
    got = q.query(spark, DATA.replace("0.001", "0.01")).join(labels, "doc_id").where("held_out")
    n, right = got.agg(F.count("*"), F.count_if(F.col("predicted") == F.col("quality"))).first()
    assert n > 40 and right / n > 0.93


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (99, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = q.score_quality(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (1 if r["score"] >= 0.3 else 0) for r in got)
    assert q.score_quality(no_docs, labels).count() == 0
    assert {r["score"] for r in q.score_quality(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert q.statistics(None) == q.statistics("")


def by_definition(text):
    """The statistics once more, from the text's bytes as characters, by expressions and sets."""
    t = (text or "").encode().decode("latin-1")
    share = lambda pattern: len(re.findall(pattern, t)) / max(1, len(t))
    words = re.findall(r"[^ \t\n\r\x0b\x0c]+", t)
    lines = [line for line in t.split("\n") if re.search(r"[^ \t\n\r\x0b\x0c]", line)]
    n, m, counted = max(1, len(words)), max(1, len(lines)), Counter(words)
    named = {"upper": "[A-Z]", "digit": "[0-9]", "blank": r"[ \t\n\r\x0b\x0c]", "stop": r"""[.,;:?'"()-]""", "symbol": r"[#$%&*+/<=>@\\^_`{|}~\[\]!]", "beyond_ascii": r"[\x80-\xff]"}
    out = {k: share(v) for k, v in named.items()}
    out["other_ascii"] = (1 - sum(out.values())) if t else 0.0
    out |= {"chars": math.log(1 + len(t)), "words": math.log(1 + len(words)), "word_length": sum(map(len, words)) / n, "distinct_words": len(counted) / n, "top_word": max(counted.values(), default=0) / n}
    out |= {"lines": math.log(1 + len(lines)), "repeated_lines": 1 - len(set(lines)) / m if lines else 0.0, "line_words": math.log(1 + len(words) / m)}
    out["repeated_pairs"] = 1 - len({(a, b) for a, b in zip(words, words[1:])}) / (len(words) - 1) if len(words) > 1 else 0.0
    out["capital_words"] = sum(re.match("[A-Z]", w) is not None for w in words) / n
    out["plain_words"] = sum(re.fullmatch("[A-Za-z]+", w) is not None for w in words) / n
    out["ended_lines"] = sum(re.search(r"[.!?][ \t\n\r\x0b\x0c]*\Z", line) is not None for line in lines) / m
    return [out[s] for s in q.STATS]


def test_every_score_equals_a_plain_recomputation(spark):
    """Statistics, rules and the fold of all documents, by other means."""
    docs = read(spark, DATA, "documents").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()} | {-1: None, -2: "", -3: "é\x0b ß!\n\n x\x1cy. \r\nx\x1cy.", -4: long_text(50_000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = read(spark, DATA, "labels")
    stats = q.text_statistics(df)
    for r in stats.collect():
        assert np.allclose([r[s] for s in q.STATS], by_definition(texts[r["doc_id"]])), r["doc_id"]
    learnt = labels.where(~q.held_out())
    assert {r["doc_id"] for r in learnt.collect()} == {r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    intercept, rules = q.learn(stats, learnt)
    for r in q.score_quality(df, labels).collect():
        x = by_definition(texts[r["doc_id"]])
        z = intercept + sum(w for w, rule in rules if all((x[f] > b) == above for f, above, b in rule))
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-6
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3)


def test_weights_are_the_lasso_optimum_and_the_first_split_the_best():
    rng = np.random.default_rng(1)
    x = rng.random((600, len(q.STATS)))
    y = ((x[:, 2] > 0.3) & (x[:, 5] > 0.5) | (x[:, 9] > 0.9)).astype(float)
    rules = q.boosted_rules(x, y)
    m = np.stack([np.logical_and.reduce([(x[:, f] > b) == above for f, above, b in rule]) for rule in rules[:40]], axis=1).astype(float)
    intercept, w = q.lasso_logistic(m, y)
    slope = m.T @ (1 / (1 + np.exp(-(m @ w + intercept))) - y) / len(y)
    assert (np.abs(slope[w == 0]) <= q.LASSO + 1e-4).all() and np.allclose(slope[w != 0], -q.LASSO * np.sign(w[w != 0]), atol=3e-4)
    best = (0.0, None)
    for f in range(x.shape[1]):
        for b in np.unique(np.quantile(x[:, f], np.linspace(0, 1, q.BINS + 1)[1:-1])):
            left = x[:, f] <= b
            gain = sum((y[s] - 0.5).sum() ** 2 / (0.25 * s.sum() + 1) for s in (left, ~left))
            if min(left.sum(), (~left).sum()) >= 5 and gain > best[0] + 1e-9:
                best = (gain, (f, b))
    assert {rule[0][0::2] for rule in rules if len(rule) == 1} >= {best[1]}


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(i, long_text(20 + i, i) if i % 2 else "!!! ### 12", 1, 2, 3.0) for i in range(60)]
    df = spark.createDataFrame(rows + rows[:30], "doc_id long, text string, score int, held_out int, chars double")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] * 2, "doc_id long, quality int, toxic int")
    got = q.score_quality(df, labels).collect()
    assert len(got) == 90 and len({(r["doc_id"], r["score"]) for r in got}) == 60
