"""Quality classifier by a sparse rule ensemble.

Statistics of every whole text are computed in one pass. Small boosted trees are fitted to labelled
rows, each path from a root to a node becomes a conjunctive rule over the statistics, a logistic
model with a lasso penalty weighs the rules (most get none), and the rules that stay are compiled
into one Spark column expression, which scores the table of statistics.

The trees and weights are fitted on the driver, from at most about SAMPLE labelled rows (documented
bound, drawn by a hash of doc_id); statistics and scores cover all rows. Null texts count as empty
ones and are scored. Labels that are null, and labels of unknown documents, are not learnt from;
without labels every score is 0.5. Very long texts are read whole. Repeated rows score alike, and are
learnt from once; of different texts under one doc_id the one with the least statistics. Rules of
equal gain (ties) are taken in the order of statistics and bounds. A null doc_id is not held out. An
empty table gives no rows; columns other than those named are not read, so none can clash.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.llm.common import Tables, join_small, map_texts, read

SAMPLE = 12_000
TREES, DEPTH, RATE, BINS, LASSO, STEPS = 60, 3, 0.3, 32, 0.0015, 400
THRESHOLD = 0.3
STATS = (
    "chars", "words", "word_length", "upper", "digit", "blank", "stop", "symbol", "other_ascii", "beyond_ascii", "distinct_words",
    "top_word", "repeated_lines", "lines", "line_words", "repeated_pairs", "capital_words", "plain_words", "ended_lines",
)
SYMBOLS = frozenset(b"#$%&*+/<=>@\\^_`{|}~[]!")
_CLASSES = np.array([3 if c in b" \t\n\r\x0b\x0c" else 0 if 65 <= c <= 90 else 1 if 48 <= c <= 57 else 2 if c in b".,;:?'\"()-" else 4 if c in SYMBOLS else 6 if c >= 128 else 5 for c in range(256)])


def statistics(text: str | None) -> list[float]:
    """The values of STATS; shares are of all bytes, words or lines, and 0 where there are none."""
    raw = (text or "").encode()
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digit, stop, blank, symbol, other, beyond = (int(n) for n in np.bincount(_CLASSES, weights=by_byte, minlength=7))
    size = max(1, len(raw))
    words = raw.split()
    n = max(1, len(words))
    counted = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    return [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / n, upper / size, digit / size, blank / size, stop / size, symbol / size, other / size,
        beyond / size, len(counted) / n, max(counted.values(), default=0) / n, 1 - len(set(lines)) / m if lines else 0.0, math.log1p(len(lines)), math.log1p(len(words) / m),
        1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0, sum(w[:1].isupper() for w in words) / n, sum(w.isalpha() for w in words) / n, sum(x.rstrip()[-1:] in b".!?" for x in lines) / m,
    ]


Rule = tuple[tuple[int, bool, float], ...]  # statistic, whether above, bound


def boosted_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of gradient-boosted trees on binned statistics."""
    bounds = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(bounds, x.T, strict=True)], axis=1)
    z, rules = np.full(len(y), 0.0), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        todo: list[tuple[np.ndarray, Rule]] = [(np.arange(len(y)), ())]
        while todo:
            rows, path = todo.pop()
            if path:
                rules[tuple(sorted(path))] = None
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-6, -1, -1)
            if len(path) < DEPTH and len(rows) >= 20:
                for f, cuts in enumerate(bounds):
                    if not len(cuts):
                        continue
                    left_g = np.bincount(binned[rows, f], weights=g[rows], minlength=len(cuts) + 1).cumsum()[:-1]
                    left_h = np.bincount(binned[rows, f], weights=h[rows], minlength=len(cuts) + 1).cumsum()[:-1]
                    count = np.bincount(binned[rows, f], minlength=len(cuts) + 1).cumsum()[:-1]
                    gain = left_g**2 / (left_h + 1) + (gs - left_g) ** 2 / (hs - left_h + 1) - gs**2 / (hs + 1)
                    gain[(count < 5) | (len(rows) - count < 5)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
            if best[1] < 0:
                z[rows] += RATE * gs / (hs + 1)
                continue
            _, f, k = best
            above = binned[rows, f] > k
            for side in (False, True):
                todo.append((rows[above == side], (*path, (f, side, float(bounds[f][k])))))
    return list(rules)


def lasso_logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept bears no penalty."""
    n = len(y)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w, b = np.zeros(m.shape[1]), math.log(rate / (1 - rate))
    v, c, t = w.copy(), b, 1.0
    probe = np.ones(m.shape[1])
    for _ in range(20):  # largest eigenvalue, for the step
        probe = m.T @ (m @ probe)
        norm = np.linalg.norm(probe)
        probe /= norm or 1.0
    step = 1 / (0.25 * (norm / n + 1) * 1.05)
    for _ in range(STEPS):
        r = 1 / (1 + np.exp(-(m @ v + c))) - y
        new_w, new_b = v - step * (m.T @ r) / n, c - step * r.mean()
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * LASSO, 0)
        new_t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return b, w


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[float, Rule]]]:
    """The intercept and the weighted rules that the lasso keeps."""
    if not len(y):
        return 0.0, []
    rules = boosted_rules(x, y)
    if not rules:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return math.log(rate / (1 - rate)), []
    m = np.stack([np.logical_and.reduce([(x[:, f] > b) == above for f, above, b in rule]) for rule in rules], axis=1).astype(np.float64)
    intercept, w = lasso_logistic(m, y)
    return float(intercept), [(float(k), r) for k, r in zip(w, rules, strict=True) if k]


def compile_score(intercept: float, rules: list[tuple[float, Rule]]) -> Column:
    """The rules as one Spark expression over columns named as STATS."""
    total = F.lit(intercept)
    for weight, rule in rules:
        cond = F.lit(True)
        for f, above, bound in rule:
            c = F.col(STATS[f])
            cond = cond & (c > bound if above else c <= bound)
        total = total + F.when(cond, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def text_statistics(docs: DataFrame) -> DataFrame:
    def rows(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], **dict(zip(STATS, zip(*map(statistics, cols["text"]), strict=True), strict=True))} if cols["doc_id"] else {k: [] for k in ("doc_id", *STATS)}

    return map_texts(docs.select("doc_id", "text"), rows, "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


def learn(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[float, list[tuple[float, Rule]]]:
    """``labels(doc_id, quality)``: those that may be learnt from."""
    labels = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").distinct()
    share = min(1.0, sample / max(1, labels.count()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    # about `sample` rows meet the statistics by broadcast, and each label comes out once
    met = join_small(stats, labels.where(draw < share), "doc_id", "inner").groupBy("doc_id", "quality").agg(F.min(F.struct(*STATS)).alias("s")).select("doc_id", "quality", "s.*")
    rows = met.toPandas().sort_values(["doc_id", "quality"], kind="stable")
    return fit(rows[list(STATS)].to_numpy(np.float64), rows["quality"].to_numpy(np.float64))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of all ``docs(doc_id, text)``."""
    tables = Tables()
    stats = tables.put(text_statistics(docs))
    score = compile_score(*learn(stats, labels.where(~held_out()), sample))
    scored = stats.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return tables.finish(scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
