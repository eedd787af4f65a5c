import math
import zlib
from collections import Counter

import numpy as np
from llm_data import DATA, long_text
from pyspark.sql import functions as F

from fleetmill.llm import op8_language as g
from fleetmill.llm.common import read


def test_held_out_accuracy(spark):
    d = DATA.replace("0.001", "0.01")
    got = g.query(spark, d).join(read(spark, d, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    n, right, sure = got.agg(F.count("*"), F.count_if(F.col("lang_pred") == F.col("lang")), F.avg("score")).first()
    assert n > 150 and right / n > 0.98 and abs(sure - right / n) < 0.05


def test_penalty_leaves_weights_at_zero_and_temperature_fits():
    rng = np.random.default_rng(0)
    m = g.Ftrl(3, 50)
    for _ in range(600):
        k = rng.integers(3)
        at = np.unique(np.append(rng.integers(3, 50, 5), k))
        m.learn(at, np.full(len(at), 0.4), int(k))
    w = m.weights()
    assert (w == 0).mean() > 0.02 and all(w[k, k] == w[:, k].max() > 0 for k in range(3))
    labels = rng.integers(0, 2, 4000)
    wrong = rng.random(4000) < 0.2
    scores = np.eye(2)[np.where(wrong, 1 - labels, labels)] * 20.0
    p = g.softmax(scores / g.temperature(scores, labels)).max(axis=1)
    assert abs(p.mean() - 0.8) < 0.03


def test_odd_rows(spark, odd_docs, no_docs):
    got = g.identify(odd_docs, g.fit(g.training_rows(odd_docs))).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r["doc_id"] in (2, 3, 4, 7):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert g.fit(g.training_rows(no_docs)) is None
    assert g.identify(no_docs, None).count() == 0
    assert {r["lang_pred"] for r in g.identify(odd_docs, None).collect()} == {"und"}
    assert g.keep_identified(odd_docs, None, 0.5).count() == 0


def grams(text):
    """Hashed n-grams by plain loops over characters."""
    t = " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
    t, wrap = f" {t} " if t else "", 2**64
    out = Counter()
    place = lambda code, k: code * k % wrap >> (64 - g.BITS)
    for i in range(len(t)):
        if t[i] != " ":
            out[place(ord(t[i]), 0x9E3779B97F4A7C15)] += 1
        if i + 1 < len(t):
            out[place((ord(t[i]) * 0x1F123BB5 + ord(t[i + 1])) % wrap, 0xC2B2AE3D27D4EB4F)] += 1
        if i + 2 < len(t):
            out[place(((ord(t[i]) * 0x1F123BB5 + ord(t[i + 1])) * 0x2545F491 + ord(t[i + 2])) % wrap, 0xD6E8FEB86659FD93)] += 1
    return dict(out)


def test_ngrams_equal_plain_loops():
    for text in (None, "", "12 !", "a", "a b", "Ab  c-D", "É1ß日本 x", long_text(3000), " \n x \t"):
        at, n = g.ngram_counts(text)
        assert dict(zip(at.tolist(), n.tolist())) == grams(text), text


def test_ftrl_equals_a_loop_over_coordinates():
    rng = np.random.default_rng(3)
    model, z, n = g.Ftrl(3, 30), {}, {}
    weight = lambda c, i: 0.0 if abs(z.get((c, i), 0.0)) <= g.L1 else -(z[c, i] - math.copysign(g.L1, z[c, i])) / ((g.BETA + math.sqrt(n[c, i])) / g.ALPHA + g.L2)
    for _ in range(200):
        at = np.sort(rng.choice(30, 6, replace=False))
        x, label = rng.random(6), int(rng.integers(3))
        model.learn(at, x, label)
        e = [math.exp(sum(weight(c, i) * v for i, v in zip(at.tolist(), x))) for c in range(3)]
        old = {(c, i): weight(c, i) for c in range(3) for i in at.tolist()}
        for c in range(3):
            for i, v in zip(at.tolist(), x.tolist()):
                slope = (e[c] / sum(e) - (c == label)) * v
                grown = n.get((c, i), 0.0) + slope * slope
                z[c, i] = z.get((c, i), 0.0) + slope - (math.sqrt(grown) - math.sqrt(n.get((c, i), 0.0))) / g.ALPHA * old[c, i]
                n[c, i] = grown
    got = model.weights()
    assert all(abs(got[c, i] - weight(c, i)) < 1e-9 for c in range(3) for i in range(30) if (c, i) in z)


def test_every_prediction_equals_a_plain_recomputation(spark):
    """Folds, document frequencies, features and probabilities of all documents, by other means."""
    docs = read(spark, DATA, "documents")
    rows = docs.collect()
    learnt = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] is not None and r["text"] is not None]
    model = g.fit(g.training_rows(docs))
    seen = Counter(k for r in learnt for k in grams(r["text"]))
    assert np.allclose(model["idf"], [math.log((1 + len(learnt)) / (1 + seen[k])) + 1 for k in range(1 << g.BITS)], rtol=1e-5)
    assert model["langs"] == sorted({r["lang"] for r in learnt})
    got = {r["doc_id"]: r for r in g.identify(docs, model).collect()}
    kept = {r["doc_id"] for r in g.keep_identified(docs, model, 0.5).collect()}
    for r in rows:
        x = {k: math.log(1 + c) * float(model["idf"][k]) for k, c in grams(r["text"]).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        z = [sum(float(w[k]) * v for k, v in x.items()) / norm / model["temperature"] if norm else 0.0 for w in model["weights"]]
        p = [math.exp(v - max(z)) for v in z]
        own = got[r["doc_id"]]
        assert own["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if norm:
            assert abs(own["score"] - max(p) / sum(p)) < 1e-4 and p[model["langs"].index(own["lang_pred"])] / sum(p) > max(p) / sum(p) - 1e-4
        else:
            assert (own["lang_pred"], own["score"]) == ("und", 0.0)
        assert (r["doc_id"] in kept) == (own["lang_pred"] != "und" and own["score"] >= 0.5)


def test_labels_beyond_the_bound_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(g, "LANGS", 2)
    rows = [(i, ("the and of to " if i % 2 else "der und das ist ") * 5, "en" if i % 2 else "de", 1.0, True) for i in range(80)] + [(1000 + i, "x y z", f"dirt{i}", 1.0, True) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, held_out boolean")
    model = g.fit(g.training_rows(df))
    assert model["langs"] == ["de", "en"]
    got = {r["doc_id"]: r["lang_pred"] for r in g.identify(df, model).collect()}
    assert all(got[i] == ("en" if i % 2 else "de") for i in range(80))
