"""Training-data pipeline over ``documents``: five stages, each one operator of ``vistasieve.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet to the shared scratch
folder and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.

1. ``language_id``    drops documents without a letter and those whose language the network cannot tell from a guess
                      (``MIN_SCORE``); without any label to learn from it keeps every document.
2. ``near_dedup``     keeps one document of each SimHash group (3-word shingles, 2 bits): the one with the least id.
3. ``substring_dedup`` cuts sentences covered by a repeated run of ``SPAN`` sentences; documents left empty go.
4. ``decontaminate``  drops documents of which at least one word in twenty lies in a benchmark window of 13 words.
5. ``encode``         gives each document's piece ids and the text they decode to.

Defined cases: rows with a null text have no letter and go in the first stage; rows that repeat a kept document's id
and text are copies of it, so the second stage keeps one of them; documents with a null id are kept or dropped by the
same rules, a group's null-id members going when it has an id; empty tables pass through as empty tables; columns beyond
those of ``documents`` travel along unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vistasieve.functions.files import delete_tree
from vistasieve.llm import decontam_fm, lang_cnn, sentence_spans, simhash_pivot
from vistasieve.llm.common import table, written
from vistasieve.llm.queries import SENTENCE_SPAN, encode_and_decode, learned_language
from vistasieve.session import scratch_scope

SPAN = SENTENCE_SPAN  # sentences; shorter runs count from ``sentence_spans.WORDS`` words
MIN_SCORE = 0.3  # of the predicted language; a guess among four languages has 0.25 (1 of 10,000 documents of sf0.1 is below)


def _whole(docs: DataFrame) -> DataFrame:
    """``row``, all columns as one struct (so that no name can clash), and the ``text`` to judge."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").alias("text"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learned_language(docs)
    if model is None:
        return docs
    judged = lang_cnn.predict(_whole(docs), model, id_col="row")
    return judged.where((F.col("lang_pred") != lang_cnn.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ident = F.col("row").getField("doc_id")
    # a row is named by its id and text, ids in order and null ones last; rows that agree in both are one
    names = {"no_id": ident.isNull(), "id": F.coalesce(ident, F.lit(0)), "h": F.xxhash64("text")}
    rows = _whole(docs).withColumns(names)
    groups = simhash_pivot.near_duplicates(rows.select(F.struct(*names).alias("key"), "text"), shingle=3, max_bits=2, id_col="key")
    first = groups.where(F.col("key") == F.col("component_id")).select("key.*").distinct()
    return rows.join(first, list(names), "left_semi").dropDuplicates(list(names)).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = sentence_spans.dedup_sentences(docs, SPAN).where("text <> ''")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam_fm.decontaminate(_whole(docs), table(spark, sf_dir, "benchmark"), id_col="row")
    return decontam_fm.verdicts(found, id_col="row").where("not contaminated").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_and_decode(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontaminate", decontaminate), ("encode", encode)]
ORACLE_SQL = None  # a trained network and a Viterbi search are not SQL; the tests hold the stages to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table: ``doc_id``, ``ids``, ``n_fallback`` and ``decoded`` of what is kept.

    A stage's scratch tables are deleted once its result is written, and that result once the next one is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch_scope(spark) as made:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            result = made.pop()
        if before:
            delete_tree(spark, before)
        before = result
    return docs
