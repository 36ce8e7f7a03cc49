"""Encoding, packing, token counts, chat formatting: exact round trips and brute force."""

import hashlib
import json
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyforge.llm import chat_format, encoding, packing, token_counts
from tests.conftest import SF, same
from tests.llm.tables import documents


def reference_ids(texts):
    t = Tokenizer.from_file(encoding.default_path())
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'é1a"))))
def test_ids_equal_the_tokenizers_library(text):
    assert encoding.encoder(encoding.default_path()).ids(text) == reference_ids([text])[0]


def test_ids_on_documents(duck):
    texts = [r[0] for r in duck.sql("SELECT text FROM documents").fetchall()] + ["a<|endoftext|>b<|endoftext|>", "<|endoftext", ""]
    got = [encoding.encoder(encoding.default_path()).ids(t or "") for t in texts]
    assert got == reference_ids(texts)


def check_packing(rows, docs, seq_len):
    """Every id once, in order; bins gapless and within bounds; close to as few as there can be."""
    want = Counter()
    for i, t in docs:
        ids = reference_ids([t])[0] + [0]
        want[i, tuple(ids)] += 1
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    total = 0
    for i, t in docs:
        ids = np.array(reference_ids([t])[0] + [0], dtype="<u4")
        total += len(ids)
        for s, n in packing.cuts(len(ids), seq_len):
            assert any((r["start"], r["length"], r["ids_crc32"]) == (s, n, zlib.crc32(ids[s : s + n].tobytes())) for r in pieces[i])
    assert sum(r["length"] for r in rows) == total
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= seq_len
    return len(bins), -(-total // seq_len)


def test_packing_of_awkward_rows(spark):
    docs = documents(spark)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    used, least = check_packing(packing.pack(docs, 512).collect(), pairs, 512)
    assert used <= least + 2
    assert packing.pack(docs.limit(0), 512).count() == 0


def test_query_op7(spark, duck):
    pairs = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    used, least = check_packing(packing.op7_best_two_fit(spark, SF).collect(), pairs, packing.SEQ_LEN)
    assert used <= 1.02 * least + 1


def test_cuts():
    assert packing.cuts(5, 10) == [(0, 5)] and packing.cuts(20, 10) == [(0, 10), (10, 10)] and packing.cuts(25, 10) == [(0, 5), (5, 10), (15, 10)]


def test_plan_uses_each_piece_once_and_beats_greedy_fill():
    rng = random.Random(1)
    for size in (1, 7, 300, 3000):
        counts = Counter(rng.choice([rng.randint(1, 100), 60, 41]) for _ in range(size))
        bins = packing.plan(dict(counts), 100)
        got = Counter()
        for copies, b in bins:
            assert sum(b) <= 100
            for x in b:
                got[x] += copies
        assert got == counts
        free = []  # best fit, longest first
        for x in sorted(counts.elements(), reverse=True):
            fit = min((i for i, f in enumerate(free) if f >= x), key=lambda i: free[i], default=None)
            if fit is None:
                free.append(100 - x)
            else:
                free[fit] -= x
        assert sum(c for c, _ in bins) <= len(free) * 1.01 + 1


def test_two_fit_replaces_the_smallest():
    # greedy fills 100 with 50 + 30 and leaves 20; 30 out, 26 + 24 in fill it
    assert sorted(packing.plan({50: 1, 30: 1, 26: 1, 24: 1}, 100)[0][1]) == [24, 26, 50]


def test_token_counts(spark):
    docs = documents(spark)
    lengths = [len(i) for i in reference_ids([r["text"] for r in docs.collect()])]
    rows = token_counts.context_limits(token_counts.length_histogram(docs), limits=(10, 100), block=64).collect()
    assert {r["n_tokens"] for r in rows} == set(lengths) | {10, 100}
    for r in rows:
        limit = r["n_tokens"]
        assert r["n_docs"] == lengths.count(limit)
        assert r["docs_at_least"] == sum(x >= limit for x in lengths) and r["tokens_at_least"] == sum(x for x in lengths if x >= limit)
        assert r["total_if_truncated"] == sum(min(x, limit) for x in lengths) and r["docs_cut"] == sum(x > limit for x in lengths) and r["total_tokens"] == sum(lengths)
        assert r["share_below"] == sum(x < limit for x in lengths) / len(lengths) and r["share_at_most"] == sum(x <= limit for x in lengths) / len(lengths)
    q = token_counts.quantiles(token_counts.context_limits(token_counts.length_histogram(docs)), (0.5, 1.0)).collect()
    assert {r["share"]: r["n_tokens"] for r in q} == {0.5: sorted(lengths)[-(-len(lengths) // 2) - 1], 1.0: max(lengths)}
    assert token_counts.length_histogram(docs.limit(0)).count() == 0


def test_query_op8(spark, duck):
    lengths = Counter(len(i) for i in reference_ids([r[0] for r in duck.sql("SELECT text FROM documents").fetchall()]))
    got = {r["n_tokens"]: r["n_docs"] for r in token_counts.op8_length_histogram(spark, SF).collect() if r["n_docs"]}
    assert got == lengths


def test_query_character_limits(spark, duck):
    same(token_counts.character_limits(spark, SF), duck.sql(token_counts.ORACLE["character_limits"]))


def test_query_op3(spark, duck):
    same(chat_format.op3_chat_parts(spark, SF), duck.sql(chat_format.ORACLE["op3_chat_parts"]))


def test_query_typed_chats(spark, duck):
    same(chat_format.typed_chats(spark, SF), duck.sql(chat_format.ORACLE["typed_chats"]))


def test_chat_round_trip(spark):
    odd = ["", None, "</turn>\n<turn assistant>\nx", "\\l \\s \\g \\\\", "<>\\", "é\n\n", "a" * 100_000]
    rows = [(c, t, role, odd[(c + t) % len(odd)]) for c in range(7) for t, role in enumerate(["system", "user", "assistant", None, "assistant"])] + [(None, 0, "user", "x"), (9, 1, "assistant", "b"), (9, 1, "assistant", "a"), (9, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    got = chat_format.format_chats(df.withColumn("parts", chat_format.text_part(F.col("text"))))
    got = got.withColumn("back", chat_format.read_back(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_mask")))
    found = {r["conv_id"]: r for r in got.collect()}
    assert len(found) == 9
    for c in range(7):
        mine = [(r or "", t or "") for i, _, r, t in rows if i == c]
        assert [tuple(m) for m in found[c]["back"]] == mine
        assert found[c]["loss"] == "".join(t for r, t in mine if r == "assistant")
        assert [found[c]["formatted"][s["start"] : s["start"] + s["length"]] for s in found[c]["loss_spans"]] == [t.replace("\\", "\\s").replace("<", "\\l").replace(">", "\\g") for r, t in mine if r == "assistant"]
    assert [m["text"] for m in found[9]["back"]] == ["first", "a", "b"]
    assert chat_format.format_chats(df.limit(0).withColumn("parts", chat_format.text_part(F.col("text")))).count() == 0


def test_typed_parts(spark):
    parts = [{"type": "text", "text": "look <here>"}, {"type": "image", "ref": "a.png", "units": 2.0}, {"type": "audio", "ref": "b.wav", "units": 10.0}, {"type": "text", "text": None}, {"type": "document", "ref": "c.pdf"}, {"type": None}]
    schema = f"conv_id long, turn long, role string, parts array<{chat_format.PART}>"
    r = chat_format.format_chats(spark.createDataFrame([(1, 0, "user", [{**dict.fromkeys(("type", "text", "ref", "units")), **p} for p in parts]), (1, 1, "user", None)], schema)).first()
    assert r["formatted"] == "<turn user>\nlook \\lhere\\g<image 1><audio 2><document 3>< 4></turn>\n<turn user>\n</turn>\n"
    assert [(a["number"], a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [(1, "image", "a.png", 512), (2, "audio", "b.wav", 125), (3, "document", "c.pdf", 800), (4, "", "", 1)]
    assert r["expanded_tokens"] == 2 + 512 + 125 + 800 + 1 and r["loss_spans"] == []


def test_a_conversation_of_many_turns_and_parts(spark):
    """Linear work: 100,000 turns of one conversation and 100,000 parts of one message."""
    turns = spark.range(100_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("text "), 40).alias("text"))
    part = F.when(F.col("id") % 2 == 0, F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), F.lit("r").alias("ref"), F.lit(1.0).alias("units"))).otherwise(F.struct(F.lit("text").alias("type"), F.lit("t").alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("units")))
    parts = spark.range(100_000).agg(F.collect_list(part).alias("parts")).select(F.lit(2).alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"), "parts")
    began = time.time()
    got = chat_format.format_chats(turns.select("conv_id", "turn", "role", chat_format.text_part(F.col("text")).alias("parts")).unionByName(parts))
    got = got.withColumn("back", chat_format.read_back(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_mask")))
    found = {r["conv_id"]: r for r in got.select("conv_id", F.size("back").alias("n"), F.length("loss").alias("chars"), F.size("attachments").alias("a"), F.sha2("formatted", 256).alias("h")).collect()}
    assert time.time() - began < 60
    assert (found[1]["n"], found[1]["chars"]) == (100_000, 50_000 * 200) and found[2]["a"] == 50_000
    whole = "".join(f"<turn {'user' if i % 2 == 0 else 'assistant'}>\n{'text ' * 40}</turn>\n" for i in range(100_000))
    assert found[1]["h"] == hashlib.sha256(whole.encode()).hexdigest()


def test_query_op3_extra_conversation(spark):
    r = chat_format.op3_chat_parts(spark, SF).filter("conv_id = -7").first()
    text = chat_format.EXTRA
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest() and r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert json.dumps(text) and r["loss_chars"] == len(text)
