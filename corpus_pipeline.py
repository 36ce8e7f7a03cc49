"""A corpus from raw documents to packed sequences, in stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's docs. All stages but the
last return the columns of `documents`.

language       documents without letters, or of no sure language, go
near_copies    one document of each near-duplicate class stays, the one of least id
decontaminate  documents that hold a window of a benchmark item go
pack           documents are packed into sequences

Language ID and tokenisation have no SQL form, so ORACLE_SQL is None;
tests/llm/test_pipeline.py holds the stages against brute force.

Defined results
---------------
Null, empty or letterless text goes in `language`. Where no document has both
letters and a `lang`, there is nothing to learn from: every document with letters
stays, and a warning says so. Null ids stay, in `near_copies` without being
compared. Of rows that repeat an id and its words one stays; of other ties the
least id, then the text, decides. An empty table passes through all stages. Very
long texts are read whole. Columns beyond those of `documents` are kept up to the
last stage, whatever their names.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import store, table
from tallyforge.llm.crf_language import UNKNOWN, predict_language
from tallyforge.llm.decontaminate import find_contamination
from tallyforge.llm.ngram_join import keep_one
from tallyforge.llm.packing import pack

log = logging.getLogger(__name__)

#: Mean probability of a document's language from which it is kept.
SURE = 0.4


def columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def fresh(docs: DataFrame, name: str) -> str:
    """A name that no column has, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    letters = F.rlike(F.coalesce(F.col("text"), F.lit("")), F.lit(r"\p{L}"))
    if docs.filter(F.col("lang").isNotNull() & letters).isEmpty():
        log.warning("no document has a language to learn from: all that have letters stay")
        return docs.filter(letters)
    name = fresh(docs, "__language")
    found = predict_language(docs, F.lit(True), F.col("doc_id"), result=name)
    return found.filter((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= SURE)).select(*columns(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs).select(*columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = fresh(docs, "__contamination")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), result=name)
    return found.filter(F.col(f"{name}.n_hit") == 0).select(*columns(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("decontaminate", decontaminate), ("pack", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
