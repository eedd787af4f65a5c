import random
from collections import Counter

import numpy as np
from llm_data import long_text

from fleetmill.llm import op2_jaccard as j


def words(text):
    return [w for w in (text or "").encode().lower().split()]


def shingles(text, size=3):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(docs, size=3, percent=90):
    sets = {d: shingles(t, size) for d, t in docs}
    comp, links = {d: d for d in sets}, {d: 0 for d in sets}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
        low, high = sorted((comp[a], comp[b]))
        comp = {d: low if c == high else c for d, c in comp.items()}
    return {d: (len(sets[d]), comp[d], links[d]) for d in sets}


def corpus(rng, families, copies, length):
    docs = []
    for f in range(families):
        base = long_text(length, f * 31).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, length // 60))):
                w[rng.randrange(len(w))] = f"edit{rng.random()}"
            docs.append(" ".join(w))
    rng.shuffle(docs)
    return list(enumerate(docs))


def run(spark, docs):
    got = j.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got}


def test_equals_brute_force(spark):
    docs = corpus(random.Random(1), 12, 6, 120) + [(1000 + i, t) for i, t in enumerate(["", None, "one", "ONE", "one two", "one two three", "One Two\tThree", "a b c d", "é É"])]
    assert run(spark, docs) == brute(docs)


def test_components_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(j, "TOKENS", 700)
    docs = corpus(random.Random(2), 2, 50, 90)
    assert run(spark, docs) == brute(docs)
    assert components(spark, docs) == {d: c for d, (_, c, _) in brute(docs).items()}


def test_components_alone_equal_brute_force(spark):
    """Families of near copies that share long passages, so that keys hold several groups."""
    rng = random.Random(5)
    common = long_text(60, 5)
    docs = [(i, f"{common} {t}" if rng.random() < 0.6 else t) for i, t in corpus(rng, 10, 8, 70)]
    for words, percent in ((3, 90), (5, 80)):
        want = {d: c for d, (_, c, _) in brute(docs, words, percent).items()}
        assert components(spark, docs, words=words, threshold=percent) == want
        got = j.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), threshold=percent, words=words).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == brute(docs, words, percent)


def test_repeated_rows_do_not_add_links_to_others(spark):
    docs = corpus(random.Random(6), 1, 3, 90)
    got = {r["doc_id"]: r["n_links"] for r in j.jaccard_components(spark.createDataFrame([*docs, docs[0]], "doc_id long, text string")).collect()}
    assert got == {0: 3, 1: 3, 2: 3} and all(n == 2 for _, _, n in brute(docs).values())


def test_hub_edges(spark, monkeypatch):
    from fleetmill.llm import common

    monkeypatch.setattr(common, "HUB_ROWS", 5)
    monkeypatch.setattr(common, "HUB_SHARE", 2)
    edges = [(7, k) for k in range(100, 130)] + [(k, k + 1) for k in range(200, 220)] + [(129, 200), (300, 301), (300, 300)]
    got = {r["node"]: r["component"] for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{n: 7 for n in (7, *range(100, 130), *range(200, 221))}, 300: 300, 301: 300}


def components(spark, docs, **more):
    got = j.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), links=False, **more).collect()
    return {r["doc_id"]: r["component_id"] for r in got}


def test_linked_sets_share_a_kept_key():
    """Of a crowd of sets, each keeps its rarest keys; linked ones always keep an equal one."""
    rng = np.random.default_rng(3)
    for percent in (80, 90):
        for n in (1, 2, 3, 9, 10, 11, 40, 300, 2000):
            base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            sets = [base]
            for drop in range(0, n * (100 - percent) // 100 + 1, max(1, n // 40)):
                sets += [base[drop:], np.unique(np.concatenate([base[drop:], rng.integers(0, 2**63, drop).astype(np.uint64)])), np.unique(np.concatenate([base[: n // 3], rng.integers(0, 2**63, n - n // 3).astype(np.uint64)]))]
            keys = [list(zip([need for need, _ in j.key_counts(s, percent)], j.segment_keys(s, percent), strict=True)) for s in sets]
            assert all([len(k) for k in j.segment_keys(s, percent)] == [n for _, n in j.key_counts(s, percent)] for s in sets)
            seen = Counter(k for of in keys for _, ks in of for k in ks.tolist())
            kept = []
            for of in keys:
                kept.append(set())
                for need, ks in of:
                    last = sorted(seen[k] for k in ks.tolist())[need - 1]
                    kept[-1] |= {k for k in ks.tolist() if seen[k] <= last and seen[k] > 1}
            for a in range(len(sets)):
                for b in range(a):
                    both = len(np.intersect1d(sets[a], sets[b]))
                    if len(sets[a]) and len(sets[b]) and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        assert kept[a] & kept[b]


def test_trees_prune_nothing_that_links():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, 60).astype(np.uint64)
        sets += [np.unique(np.concatenate([base[k:], rng.integers(0, 2**63, k).astype(np.uint64)])) for k in (0, 1, 2, 6)]
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if 100 * (s := len(np.intersect1d(sets[a], sets[b]))) >= 90 * (len(sets[a]) + len(sets[b]) - s)}
    assert {tuple(sorted(p)) for p in j.join_trees(sets, list(range(len(sets))))} == want
    left, right = list(range(0, len(sets), 2)), list(range(1, len(sets), 2))
    assert {tuple(sorted(p)) for p in j.join_trees(sets, left, right)} == {p for p in want if p[0] % 2 != p[1] % 2}


def test_odd_rows(spark, odd_docs, no_docs):
    got = j.jaccard_components(odd_docs.withColumnRenamed("source", "component")).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[2]["component_id"] == 2 and by[2]["n_shingles"] == 0 and by[4]["n_links"] == 0 and by[1]["n_links"] == 1
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    assert j.jaccard_components(no_docs).count() == 0
