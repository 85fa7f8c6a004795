"""The corpus pipeline: documents in, packed training sequences out.

Stages, each on all that its predecessor kept: toxicity and language filters, SimHash near-duplicates,
repeated passages, packing. A stage takes (spark, docs, folder) and returns a DataFrame; all but the
last return the columns of documents. ``run`` writes each result as Parquet to the shared folder and
hands it, read again, to the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import language, packing, simhash, substring, toxicity
from lapsewise.llm.common import stored, table

#: What a language score must reach: below, the text is as likely to be in another language.
LEAST_LANGUAGE_SCORE = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold of their language.

    The model learns from all labelled documents of the table ``documents``. Null and empty texts
    have a score like any other."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, model)


def reject_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be identified: rejected are those without a letter and those
    that no language fits."""
    model = language.fit(table(spark, sf_dir, "documents"))
    return language.kept(docs, model, LEAST_LANGUAGE_SCORE)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words and more that a document of smaller id has.

    A text that loses nothing stays as it is; of another the kept words remain, joined by one space,
    and n_chars follows. A document that loses everything stays as an empty one."""
    cut = substring.repeats(docs, window=50)
    lost = F.col("cut.n_removed") > 0
    changed = {"text": F.when(lost, F.col("cut.kept")).otherwise(F.col("text")), "n_chars": F.when(lost, F.length("cut.kept").cast("long")).otherwise(F.col("n_chars"))}
    return cut.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("language ID", reject_unknown_language),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("substring dedup", without_repeats),
    ("packing", pack_sequences),
]

#: The models and the fingerprints have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
