import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_data import DATA
from tokenizers import Tokenizer

from fleetmill.llm import op9_packing as p
from fleetmill.llm.common import read


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_library():
    rng = random.Random(0)
    texts = ["", " ", "  two", "a <|endoftext|> b", "<|endoftext|>", "x  \n\n y'll ²³ ªº \x1c a\xa0 b ½ __ a_b", "foo \x1c! \x1d\x1d a\x1c b", " lead", "trail ", "\n", "don't 'sx 日本 😀", "a" * 3000]
    texts += ["".join(rng.choice("abcdefgh theTHE'sd  \n\t\xa0üß日本😀0123456789.,-_=(){}\\/|<>") for _ in range(rng.randint(1, 80))) for _ in range(800)]
    ours, theirs = p.TokenIds("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"), library()
    for text in texts * 2:  # the second time from what is kept
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(text)


def best_fit_by_hand(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(150):
        h = {n: rng.randint(0, 6) for n in rng.sample(range(1, 41), 12)}
        bins = {}
        for length, a, b, first, each, at in p.plan(h, 40):
            for k in range(b - a):
                bins.setdefault(first + k // each, []).append((at + k % each * length, length))
        for parts in bins.values():
            parts.sort()
            assert parts[0][0] == 0 and all(x + n == y for (x, n), (y, _) in zip(parts, parts[1:]))
        assert sorted(40 - sum(n for _, n in x) for x in bins.values()) == best_fit_by_hand([n for n, c in h.items() for _ in range(c)], 40)
        assert sorted(bins) == list(range(len(bins)))
    assert p.plan({}) == []


def test_segment_tree():
    t = p.SegmentTree(11)
    assert t.first_from(0) is None
    t.add(3, 2)
    t.add(10, 1)
    assert [t.first_from(i) for i in (0, 3, 4, 10, 11)] == [3, 3, 10, 10, None]
    t.add(3, -2)
    assert t.first_from(0) == 10


def test_documents(spark, odd_docs, no_docs):
    tok = library()
    for docs in (read(spark, DATA, "documents"), odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])):
        got = p.pack(docs).toPandas()
        ids = {r["doc_id"]: tok.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
        assert set(got["doc_id"]) == set(ids)
        for doc_id, g in got.sort_values("piece").groupby("doc_id"):
            own = ids[doc_id]
            assert g["piece"].tolist() == list(range(len(g))) and g["start"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() == len(own)
            assert (g["length"].iloc[1:] == 2048).all()
            for r in g.itertuples():
                assert r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        ends = 0
        for _, g in got.sort_values("offset").groupby("sequence_id"):
            assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 2048
            ends += 1
        assert ends == len(best_fit_by_hand(got["length"].tolist(), 2048))
    assert p.pack(no_docs).count() == 0
    assert p.pack(odd_docs).where("doc_id is null").count() >= 2


def test_other_partitions_in_the_second_scan_lose_nothing(spark):
    docs = spark.createDataFrame([(i, " ".join(["word"] * (1 + i % 7))) for i in range(400)], "doc_id long, text string").repartition(8)
    got = p.pack(docs, capacity=16)
    other = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.minPartitionNum": "40", "spark.sql.files.openCostInBytes": "1"}
    was = {name: spark.conf.get(name, None) for name in other}
    for name, value in other.items():
        spark.conf.set(name, value)
    try:
        rows = got.collect()
    finally:
        for name, value in was.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert {r["doc_id"] for r in rows} == set(range(400)) and len(rows) == 400
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in map(sorted, bins.values()):
        assert parts[0][0] == 0 and all(x + n == y for (x, n), (y, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 16


def test_a_piece_without_a_place_fails(spark, monkeypatch):
    pieces = spark.createDataFrame([(i, 5) for i in range(10)], "doc_id long, length long")
    monkeypatch.setattr(p, "plan", lambda histogram, capacity, whole=p.plan: whole({k: n - 1 for k, n in histogram.items()}, capacity))
    with pytest.raises(Exception, match="a piece has no place"):
        p.best_fit(pieces, 16).collect()


def test_clashing_columns(spark):
    names = ["part", "n", "rank", "before", "first", "end", "bin", "each", "place", "sequence_id", "offset"]
    rows = [(i, 1 + i % 6, *([i] * len(names))) for i in range(50)]
    got = p.best_fit(spark.createDataFrame(rows, "doc_id long, length long, " + ", ".join(f"`{c}` int" for c in names)), 16).collect()
    assert all(r[c] == r["doc_id"] for r in got for c in names[:-2]) and sum(r["length"] for r in got) == sum(1 + i % 6 for i in range(50))
    assert len({r["sequence_id"] for r in got}) == len(best_fit_by_hand([1 + i % 6 for i in range(50)], 16))


def test_ranks_are_used_only_if_they_say_the_same(tmp_path):
    json_file, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert len(p.ranks_of(json_file, ranks)) == 50_256
    assert p.ranks_of(json_file, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")) is None and p.ranks_of(json_file, "/none") is None
    lines = open(ranks, "rb").read().splitlines()
    lines[1000], lines[1001] = lines[1000].split()[0] + b" 1001", lines[1001].split()[0] + b" 1000"
    (tmp_path / "other").write_bytes(b"\n".join(lines))
    assert p.ranks_of(json_file, str(tmp_path / "other")) is None
    own, theirs = p.TokenIds("byte_bpe_50k.json", "none"), library()
    for text in ("a b <|endoftext|> c", "don't  stop\n", "", "日本 ½ x"):
        assert np.frombuffer(own.ids(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
