import numpy as np
import public_tokenizers
from llm_data import DATA
from tokenizers import Tokenizer

import corpus_pipeline as c
from fleetmill.llm import op5_secrets
from fleetmill.llm.common import read


def test_stages_do_what_they_say(spark):
    docs = read(spark, DATA, "documents")
    names = [n for n, _ in c.STAGES]
    assert names == ["language", "near_duplicates", "decontaminate", "secrets", "pack"]
    ids, seen = {r["doc_id"] for r in docs.select("doc_id").collect()}, []
    for _, stage in c.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept <= ids
        seen.append(len(ids - kept))
        ids = kept
    assert seen[1] > 0 and seen[2] > 0 and seen[3] == 0
    assert all(not op5_secrets.scan(r["text"])[0] for r in docs.collect())
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(tok.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect())
    got = c.run(spark, DATA).toPandas()
    assert set(got["doc_id"]) == ids and got["length"].sum() == total
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]]


def test_near_duplicates_keep_one_of_each_group(spark):
    base = " ".join(f"word{i}" for i in range(100))
    rows = [(3, base, "en", "a", 1), (2, base + " more", "en", "a", 1), (9, "quite another text here", "en", "a", 1), (2, base + " more", "en", "a", 1), (None, base, "en", "a", 1), (4, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in c.near_duplicates(spark, docs, DATA).collect())
    assert got == [(False, 2), (False, 4), (False, 9), (True, 0)]


def test_near_duplicates_take_five_words_and_four_fifths(spark):
    words = [f"w{i}" for i in range(200)]
    near, far = words.copy(), words.copy()
    for i in (30, 80, 130):  # 15 of 196 shingles of five words: 0.86; 9 of 198 of three: 0.91
        near[i] = f"near{i}"
    near[170] = "near170"  # 0.81 of five words, 0.89 of three
    for i in range(20, 180, 20):  # 0.66
        far[i] = f"far{i}"
    rows = [(k, " ".join(x), "en", "a", 1) for k, x in enumerate((words, near, far))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in c.near_duplicates(spark, docs, DATA).collect()) == [0, 2]


ODD = "doc_id long, text string, lang string, source string, n_chars long, component long, h string, words string, node long, n int, part int"


def tables(spark, folder, rows):
    spark.createDataFrame(rows, ODD).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "How many of the seven old ships left the quiet harbour before the storm came in from the north?")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_run_on_odd_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, one number for two texts, and columns whose names
    the operators use."""
    english = " ".join(f"the and of to in that it was for on are as with his they at {i}" for i in range(12))
    german = " ".join(f"der und das ist nicht von zu den mit sich auf eine dem auch {i}" for i in range(12))
    more = (9, "h", "w", 5, 6, 7)
    rows = [(i, f"{english} number{i} " + " ".join(f"w{i}x{k}" for k in range(60)), "en", "a", 1, *more) for i in range(30)]
    rows += [(100 + i, f"{german} nummer{i} " + " ".join(f"v{i}x{k}" for k in range(60)), "de", "a", 1, *more) for i in range(30)]
    long = " ".join(f"the old house number {i} and the road to it" for i in range(20_000))
    rows += [(200, None, "en", None, None, *more), (201, "", None, "a", 0, *more), (202, " 12 !", "en", "a", 5, *more), (203, long, "en", "a", 1, *more), (None, f"{english} without a number", "en", "a", 1, *more)]
    rows += [rows[0], (5, f"{german} another text of the same number " + " ".join(f"u{k}" for k in range(60)), "de", "a", 1, *more), (300, rows[1][1], "en", "a", 1, *more)]
    tables(spark, str(tmp_path), rows)
    got = c.run(spark, str(tmp_path)).toPandas()
    kept = got[got["piece"] == 0].groupby("doc_id", dropna=False).size().to_dict()
    assert all(kept.get(i) == 1 for i in range(30) if i != 5) and kept.get(5) == 2 and all(kept.get(100 + i) == 1 for i in range(30))
    assert not {200, 201, 202, 300} & set(kept) and kept[203] == 1
    assert got["doc_id"].isna().sum() >= 1 and got[got["doc_id"] == 203]["length"].sum() > 100_000
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() <= 2048


def test_run_on_an_empty_table(spark, tmp_path):
    tables(spark, str(tmp_path), [])
    assert c.run(spark, str(tmp_path)).count() == 0
