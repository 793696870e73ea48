"""From documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``docs``.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacancylens.llm import decontam, dedup, language, packing, pii
from vacancylens.llm.frames import stored, table
from vacancylens.llm.tokens import TokenizerFile
from vacancylens.session import configure

#: Near duplicates share words in this many percent of their five-word shingles.
SHINGLE_WORDS, PERCENT = 5, 80
#: Stands for the deployment's secret.
SURROGATE_KEY = b"corpus pipeline"
CAPACITY, END_ID = 4096, 1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; the others go."""
    model = language.train(docs.select("doc_id", "text", "lang"))
    return language.keep_known(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return dedup.keep_first(docs, SHINGLE_WORDS, PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; crowded values may get longer ones."""
    return pii.replace(docs, SURROGATE_KEY, count_col=None)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    file = TokenizerFile(public_tokenizers.path("word_bpe_49k.json"), "word")
    return packing.pack_documents(docs, file, END_ID, CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("surrogates", surrogates),
    ("best_fit_packing", best_fit_packing),
]

#: Learning and tokens are not SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
