import random

import numpy as np
import public_tokenizers
import sentencepiece
from llm_data import DATA

from fleetmill.llm import op7_tokens as t
from fleetmill.llm.common import read

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_equals_the_library_on_odd_texts():
    rng = random.Random(0)
    texts = ["", None, " ", "   a  ", "\n\n a\n", "▁x▁▁ y", "<s>hello</s><unk>", "日本語 naïve 😀\x00\x07", "a" * 9000, "ab" * 9000, "aAbB01+/" * 3000, "x y" * 4000]
    texts += ["".join(rng.choice("abcdefghij theTHE  ▁\n\tüß日本😀0123456789.,-_=(){}\\/") for _ in range(rng.randint(1, 80))) for _ in range(800)]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    counter = t.PieceCounter.from_model(PATH)
    assert counter.count(texts) == [len(library.encode(x or "")) for x in texts]
    assert counter.count([]) == []


def test_states_built_anew_count_the_same(monkeypatch):
    from fleetmill.llm import transducer

    counter = t.PieceCounter.from_model(PATH)
    texts = ["the tokenizer compiles its transitions", "as inputs ask for them"] * 3
    want = counter.count(texts)
    monkeypatch.setattr(transducer, "MAX_STATES", 5)
    assert counter.count(texts) == want == counter.count(texts)


def test_parts_and_a_small_table_count_the_same(monkeypatch):
    from fleetmill.llm import transducer

    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefghij theTHE  ▁\n\tüß日本😀0123456789.,-_") for _ in range(3000)) for _ in range(5)] + [" \n \n  a", "x" * 3000 + " y", "\n", " " * 500]
    want = [len(library.encode(x)) for x in texts]
    monkeypatch.setattr(t, "PART", 100)
    assert t.PieceCounter.from_model(PATH).count(texts) == want
    assert all("".join(t._parts(x, 7)) == x for x in (y.replace(" ", t.BLANK) for y in texts))
    monkeypatch.setattr(transducer, "MAX_BYTES", 1 << 20)
    counter = t.PieceCounter.from_model(PATH)
    assert counter.count(texts) == want and counter.transducer.moves.nbytes <= 1 << 20


def test_scan_composes_maps():
    maps = [{0: (1, 2), 1: (0, 5)}, {0: (0, 1), 1: (1, 7)}, {0: (1, 1), 1: (0, 0)}, {0: (0, 3), 1: (1, 9)}, {0: (1, 2), 1: (1, 4)}]

    def run(first, last, entry):
        state, total = entry, 0
        for m in maps[first : last + 1]:
            state, n = m[state]
            total += n
        return state, total

    want = [{s: run(0, k, s) for s in (0, 1)} for k in range(len(maps))]
    assert t.prefix_scan(maps, run) == want
    lacking = [maps[0], {1: (1, 7)}, {0: (1, 1)}, {}, {0: (1, 2)}]
    assert t.prefix_scan(lacking, run) == want


def test_block_maps_equal_a_sequential_run(monkeypatch):
    """Maps are made for each block alone; every entry in them, not only the one that turns up."""
    monkeypatch.setattr(t, "BLOCK", 50)
    counter = t.PieceCounter.from_model(PATH)
    rng = random.Random(9)
    counter.count(["the tokenizer learns states from other texts", "aabbab ab"] * 3)
    for text in ("ab" * 400, "".join(rng.choice("abcdefgherstin") for _ in range(1200)), "日本" * 200, "a"):
        classes = counter.classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        blocks = [classes[i : i + 50] for i in range(0, len(classes), 50)]
        maps = counter.transducer.maps(blocks, [None, *(counter.transducer.chars[b[-1]] for b in blocks[:-1])])
        assert max(map(len, maps)) > 1 or len(blocks) == 1 or "日" in text
        for block, m in zip(blocks, maps, strict=True):
            assert m == {entry: counter._sequential(block, entry) for entry in m} != {}
        assert counter.long_run(classes) == counter._sequential(classes, counter.transducer.start)[1]


def test_documents_and_odd_rows(spark, odd_docs, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r["doc_id"]: r["text"] for r in read(spark, DATA, "documents").collect()}
    for r in t.query(spark, DATA).collect():
        n = len(library.encode(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 4096)
    got = t.token_counts(odd_docs.withColumnRenamed("n_chars", "n_tokens")).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(library.encode(r["text"] or "")) for r in odd_docs.collect())
    assert t.token_counts(no_docs).count() == 0
