"""A corpus pipeline of five of the training-data operators.

Each stage gets the documents that its predecessor kept and returns those that it keeps, with the
columns of ``documents``; the last returns the packed pieces. A stage's result is written as
Parquet and read again as the next one's input, so each works on whole results and a lost executor
repeats one stage at most.

1. language: documents without any letter, or whose language is told with less than even odds, go.
2. near_duplicates: one document of each component of similar ones (five-word shingles, Jaccard 0.8
   or more) stays, the smallest doc_id.
3. decontaminate: documents that hold a benchmark item go.
4. secrets: documents stay; each secret found, decoded layers included, is replaced by a mark.
5. pack: documents are tokenized, cut and packed.

Rows with a null doc_id pass the filters (they can't be named in a result) but for the first, which
judges their text; repeated rows (of one doc_id and text) leave the second stage once, different
texts of one doc_id all. Null texts are no language and go first. Texts are read whole, however
long; further columns go through all stages but the last. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmill.llm import op2_jaccard, op5_secrets, op8_language, op9_packing, op10_decontaminate
from fleetmill.llm.common import join_small, materialize, read

SURE = 0.5
#: Near duplicates: shingles of so many words, Jaccard similarity in percent.
SHINGLE_WORDS, SIMILAR = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The scores ride with the rows, so keeping needs no join. With no language to learn, only
    documents without a letter go."""
    model = op8_language.fit(op8_language.training_rows(docs))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return op8_language.keep_identified(docs, model, SURE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = op2_jaccard.jaccard_components(docs, threshold=SIMILAR, words=SHINGLE_WORDS, links=False).where("doc_id is not null")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = join_small(docs, gone, "doc_id", "left_anti")
    repeated = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = join_small(kept, repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return join_small(kept, repeated, "doc_id", "left_anti").unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = op10_decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"))
    gone, _ = materialize(found.select("doc_id").distinct())
    return join_small(docs, gone, "doc_id", "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("pack", pack),
]

#: A trained model, graph components and a tokenizer: not for SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's result a written table."""
    docs, drop = read(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, drop_own = materialize(docs)
            if drop:
                drop()
            drop = drop_own
    return docs
