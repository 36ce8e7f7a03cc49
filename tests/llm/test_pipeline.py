"""The pipeline's stages against brute force over the smallest tables."""

import corpus_pipeline
from tallyforge.llm.decontaminate import WIDTH, words
from tests.conftest import SF
from tests.llm.tables import documents
from tests.llm.test_pairs_and_windows import brute_classes
from tests.llm.test_tokens_and_chats import check_packing


def windows(text):
    w = words((text or "").encode())
    return [b" " + b" ".join(w[i : i + WIDTH]) + b" " for i in range(max(1, len(w) - WIDTH + 1))] if w else []


def test_stages_against_brute_force(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    bench = [w for (t,) in duck.sql("SELECT text FROM benchmark").fetchall() for w in windows(t)]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        ids = {r["doc_id"] for r in kept.collect()}
        if name == "language":  # clean texts stay
            assert ids == {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}
        elif name == "near_copies":
            assert ids == {c for _, c, _ in brute_classes([(i, t) for i, t in rows.items() if i in before])}
        else:
            hit = {i for i in before if any(w in b" " + b" ".join(words((rows[i] or "").encode())) + b" " for w in bench)}
            assert hit and ids == before - hit
        before = ids
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    used, least = check_packing(packed, [(i, rows[i]) for i in before], 2048)
    assert used <= 1.02 * least + 1
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"]) for r in again) == sorted((r["doc_id"], r["piece"]) for r in packed)


def test_awkward_rows_pass_through(spark):
    docs = documents(spark)
    for rows in (docs, docs.limit(0)):
        kept = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, kept, SF).count()
