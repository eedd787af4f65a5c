"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams,
trained by follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties, its
probabilities then calibrated by one temperature.

Document frequencies are counted over all training rows, in Spark. The weights are fitted on the
driver from at most about SAMPLE rows (documented bound), drawn by a hash of doc_id and evenly from
the languages, so the model costs the same at any input size; a fifth of them only sets the
temperature. The whole text of every row is scored.

Texts without a letter (null, empty, digits) get ``und`` and score 0; so do all texts if there is
nothing to learn from. Rows with a null language or a null doc_id are not learnt from, but scored
(a null doc_id is not held out). Of more than LANGS labels the most frequent are learnt. Very long
texts are read whole. Repeated rows score alike; the first language by name wins a tie. An empty
table gives no rows; columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.llm.common import map_texts, read
from fleetmill.shipping import ship

SAMPLE = 3000
#: Labels beyond so many (documented bound) are taken for dirt.
LANGS = 500
BITS = 14
UND = "und"
#: FTRL: learning rate and its smoothing, L1 and L2.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.01, 4

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1- to 3-grams of the lower-cased letters (all else is one blank) and their counts."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), np.uint32)
    points = np.where(letters()[points], points, 32).astype(np.uint64)
    points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0)
    one = points[points != 32] * np.uint64(0x9E3779B97F4A7C15)
    two = (points[:-1] * np.uint64(0x1F123BB5) + points[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    three = ((points[:-2] * np.uint64(0x1F123BB5) + points[1:-1]) * np.uint64(0x2545F491) + points[2:]) * np.uint64(0xD6E8FEB86659FD93)
    at = (np.concatenate([one, two, three]) >> np.uint64(64 - BITS)).astype(np.int64)
    counts = np.bincount(at, minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.float64)


def tf_idf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[found]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


class Ftrl:
    """Multinomial FTRL-proximal; weights that the L1 penalty holds at zero stay zero."""

    def __init__(self, classes: int, size: int):
        self.z, self.n = np.zeros((classes, size)), np.zeros((classes, size))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(w @ x)
        p[label] -= 1
        g = p[:, None] * x
        n = self.n[:, at]
        grown = n + g * g
        self.z[:, at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[:, at] = grown


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores that makes the labels likeliest, by golden-section search."""
    if not len(scores):
        return 1.0

    def loss(log_t: float) -> float:
        return -np.log(softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels] + 1e-12).mean()

    low, high, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict | None:
    """``docs(doc_id, text, lang)``: the training rows. A model of plain arrays, or None."""
    ship(docs.sparkSession)
    per_lang = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS).collect()}
    if not per_lang:
        return None
    langs = sorted(per_lang)

    def frequencies(batches):
        import pyarrow as pa

        total, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total[ngram_counts(text)[0]] += 1
                rows += 1
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, -1), pa.int64()), pa.array(np.append(total[met], rows), pa.int64())], ["gram", "n"])

    # one row for each n-gram and partition: far less than the texts of a partition
    counted = docs.select("text").mapInArrow(frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(1 << BITS)
    real = counted["gram"] >= 0
    df[counted.loc[real, "gram"]] = counted.loc[real, "n"]
    idf = np.log((1 + float(counted.loc[~real, "n"].sum())) / (1 + df)) + 1

    share = sample / len(langs)
    chance = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, share / per_lang[lang])))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    picked = docs.where(draw < chance[F.col("lang")]).select("doc_id", "text", "lang")

    def features(cols: dict[str, list]) -> dict[str, list]:
        got = [ngram_counts(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "lang": cols["lang"], "at": [a for a, _ in got], "n": [n for _, n in got]}

    rows = map_texts(picked, features, "doc_id long, lang string, at array<int>, n array<float>").toPandas()
    rows = rows[rows["at"].map(len) > 0].sort_values("doc_id", key=lambda s: s.map(lambda x: (int(x) * 0x9E3779B97F4A7C15) % 2**64), kind="stable")
    xs = [(np.asarray(a, np.int64), tf_idf(np.asarray(a, np.int64), np.asarray(n, np.float64), idf)) for a, n in zip(rows["at"], rows["n"], strict=True)]
    labels = np.array([langs.index(x) for x in rows["lang"]], np.int64)
    model = Ftrl(len(langs), 1 << BITS)
    kept_back = np.arange(len(xs)) % 5 == 4
    for _ in range(EPOCHS):
        for k in np.flatnonzero(~kept_back).tolist():
            model.learn(*xs[k], labels[k])
    weights = model.weights()
    scores = np.array([weights[:, a] @ x for (a, x), back in zip(xs, kept_back, strict=True) if back]).reshape(-1, len(langs))
    return {"langs": langs, "idf": idf.astype(np.float32), "weights": weights.astype(np.float32), "temperature": temperature(scores, labels[kept_back])}


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _predict(model: dict | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    langs, scores = [], []
    for text in texts:
        at, n = ngram_counts(text)
        if model is None or not len(at):
            langs.append(UND)
            scores.append(0.0)
            continue
        p = softmax((model["weights"][:, at] @ tf_idf(at, n, model["idf"])) / model["temperature"])
        k = int(p.argmax())
        langs.append(model["langs"][k])
        scores.append(float(p[k]))
    return langs, scores


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of all rows. The model, of bounded size, is sent
    once to each executor."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(cols: dict[str, list]) -> dict[str, list]:
        langs, scores = _predict(shared.value, cols["text"])
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": langs, "score": scores}

    return map_texts(docs.select("doc_id", "text", held_out().alias("held_out")), rows, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict | None, least: float) -> DataFrame:
    """The rows whose language is told with at least this score, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(cols: dict[str, list]) -> dict[str, list]:
        langs, scores = _predict(shared.value, cols["text"])
        kept = [k for k, (x, s) in enumerate(zip(langs, scores, strict=True)) if x != UND and s >= least]
        return {name: [values[k] for k in kept] for name, values in cols.items()}

    return map_texts(docs, rows, ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).where("lang is not null and text is not null").select("doc_id", "text", "lang")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit(training_rows(docs)))
