"""Every operator on tables whose columns have odd and clashing names; ids that are no numbers; no labels."""

import corpus_pipeline
from pyspark.sql import functions as F
from tallyforge.llm import crf_language, decontaminate, lattice_lm, ngram_join, packing, periodic_runs, phrases, spotsigs, token_counts, warc
from tests.conftest import SF
from tests.llm.tables import documents

ODD = ["a.b", "__id", "__items", "__raw", "__mark", "n", "key", "row", "raw", "ranges", "items", "__row", "__text", "__language", "__contamination", "grp", "w1", "digest", "Select"]


def odd(spark):
    docs = documents(spark)
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in ODD])


def own(rows):
    return all(r[c] == f"own {c}" for r in rows for c in ODD)


def test_stages_keep_all_columns(spark):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        rows = kept.collect()
        assert kept.columns == docs.columns and rows and own(rows), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_operators_keep_all_columns(spark):
    docs = odd(spark)
    bench = spark.createDataFrame([("q-1", "one two"), ("q-2", "never seen anywhere"), (None, "one two")], "`item.id` string, text string")
    for most in (4_000_000, 1):  # one automaton, several
        found = decontaminate.find_contamination(docs, bench, item="item.id", most_words=most).collect()
        assert own(found) and {r["doc_id"]: r["contamination"]["items"] for r in found}[108] == ["q-1"]
    assert decontaminate.find_contamination(docs, bench, item="item.id", keep=["a.b"]).columns == ["a.b", "contamination"]
    assert own(ngram_join.keep_one(docs).collect()) and own(periodic_runs.find_runs(docs).collect())
    assert own(crf_language.predict_language(docs, F.lit(True), F.col("doc_id")).collect())


def test_operators_that_return_columns_of_their_own(spark):
    docs = odd(spark)
    n = docs.count()
    assert ngram_join.near_duplicates(docs).count() == n and packing.pack(docs).count() >= n
    assert phrases.collocations(docs, min_count=2).count() > 0 and token_counts.length_histogram(docs).count() > 0
    assert warc.page_records(docs, "doc_id", "source", "text").count() == n


def test_a_corpus_without_labels_stays(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, SF).collect()}
    assert kept == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}


def test_numerals_are_no_letters(spark):
    docs = documents(spark, [(500, "½ ² Ⅳ ①", "en"), (501, "½ la maison est grande", "fr")])
    found = {r["doc_id"]: r["language"] for r in crf_language.predict_language(docs, F.lit(True), F.col("doc_id")).collect()}
    assert found[500]["lang"] == crf_language.UNKNOWN and found[501]["lang"] != crf_language.UNKNOWN
