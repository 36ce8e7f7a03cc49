"""Near duplicates, decontamination, SpotSigs against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, ngram_join, spotsigs
from tallyforge.llm.components import components, join_by_key
from tests.conftest import SF, same
from tests.llm.tables import documents, words


def grams(text, n=5):
    w = decontaminate.words((text or "").encode())
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_classes(rows, threshold=0.8):
    """doc_id -> (class, links) from all pairs."""
    n = len(rows)
    root = list(range(n))
    links = [0] * n

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [grams(t) for _, t in rows]
    for a in range(n):
        for b in range(a):
            x, y = sets[a], sets[b]
            near = (not x and not y and (rows[a][1] or "") == (rows[b][1] or "")) or (x and y and len(x & y) >= threshold * len(x | y) - 1e-9)
            if near:
                links[a] += 1
                links[b] += 1
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for i in range(n):
        least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], least[top(i)], links[i]) for i in range(n))


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    base = words(rng, 80).split()
    extra = []
    for i in range(60):  # a group of near copies, some near each other only by way of others
        w = list(base)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(80)] = words(rng, 1) + "x"
        extra.append((300 + i, " ".join(w), "en"))
    docs = documents(spark, extra)
    for block in (1024, 16):  # 16: the group is dealt into several blocks
        got = ngram_join.near_duplicates(docs, block=block).collect()
        want = brute_classes([(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None])
        assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got if r["doc_id"] is not None) == want
        assert [tuple(r)[1:3] for r in got if r["doc_id"] is None] == [(None, 0)]


def test_keep_one(spark):
    docs = documents(spark)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    classes = {r["class_id"] for r in ngram_join.near_duplicates(docs).collect() if r["doc_id"] is not None}
    assert ids == sorted(classes) and kept.filter("doc_id IS NULL").count() == 1
    assert 100 in ids and 101 not in ids and 102 not in ids
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_keep_one_judges_texts_not_ids(spark):
    rng = random.Random(3)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    near = b.split()
    near[30] = "changed"
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, " ".join(near), "x"), (3, c, "x"), (3, d, "z"), (3, d.upper(), "x"), (3, d, "y"), (4, d, "x"), (None, a, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    want = sorted(map(str, [(1, a, "x"), (2, b, "x"), (3, c, "x"), (3, min(d, d.upper()), "x"), (None, a, "x")]))
    for parts in (1, 7):
        kept = ngram_join.keep_one(df.repartition(parts))
        assert kept.columns == df.columns and sorted(str(tuple(r)) for r in kept.collect()) == want


def test_banding():
    bands, rows = ngram_join.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= ngram_join.RECALL and bands * rows <= ngram_join.MAX_HASHES


def test_components(spark):
    rng = random.Random(2)
    edges = [(f"{a:03}", f"{b:03}") for a, b in ((rng.randrange(200), rng.randrange(200)) for _ in range(150))] + [(f"{900 + i}", f"{901 + i}") for i in range(40)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    want = sorted((x, top(x)) for x in parent if top(x) != x)
    got = sorted(tuple(r) for r in components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect())
    assert got == want


def test_a_large_star_spreads(spark):
    """The hub's 100,000 edges stay in the tasks that hold them; only other nodes are shuffled on."""
    edges = spark.range(100_000).select(F.lit("a").alias("a"), F.format_string("n%06d", "id").alias("b"))
    got = components(edges, "a", "b")
    assert got.count() == 100_000 and [r[0] for r in got.select("root").distinct().collect()] == ["a"]
    values = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    joined = join_by_key(edges.repartition(8), values, ["a"], 100_000)
    spread = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 100_000 and max(r["count"] for r in spread) < 20_000


def test_repeated_ids_with_one_text(spark):
    rng = random.Random(9)
    base = words(rng, 60).split()
    rows = [(1, " ".join(base))] * 300 + [(1, " ".join([*base[:30], f"other{i}", *base[31:]])) for i in range(40)] + [(2, words(rng, 50))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.near_duplicates(df, block=16).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute_classes(rows)
    assert sorted(r["doc_id"] for r in ngram_join.keep_one(df, block=16).collect()) == [1, 2]


def test_chains_of_near_texts(spark):
    """Texts that are near the next few only: one long group."""
    rng = random.Random(12)
    many = words(rng, 1_000).split()
    chain = [f"{w}{i}" for i, w in enumerate(many)]
    rows = [(i, " ".join(chain[4 * i : 4 * i + 120])) for i in range(200)] + [(1_000 + i, " ".join(many[:200] + [f"end{i}"])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_classes(rows)
    assert len({c for _, c, _ in want}) == 2
    got = ngram_join.near_duplicates(docs, block=64).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want


def test_near_duplicates_of_very_long_texts(spark):
    rng = random.Random(13)
    base = words(rng, 120_000).split()
    rows = [(i, " ".join([*base[: 2_000 * i], f"other{i}", *base[2_000 * i + 1 :]])) for i in range(1, 7)] + [(9, " ".join(reversed(base)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_join.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == [*((i, 1, 5) for i in range(1, 7)), (9, 9, 0)]


def test_query_op10(spark, duck):
    same(ngram_join.op10_minhash_join(spark, SF), duck.sql(ngram_join.ORACLE["op10_minhash_join"]))


def brute_hits(text, items, width=10):
    w = decontaminate.words((text or "").encode())
    hit, found = set(), set()
    for item, t in items:
        b = decontaminate.words((t or "").encode())
        k = min(width, len(b))
        for j in range(len(b) - k + 1 if b else 0):
            for i in range(len(w) - k + 1):
                if w[i : i + k] == b[j : j + k]:
                    hit |= set(range(i, i + k))
                    found.add(item)
    return len(w), hit, found


@pytest.mark.parametrize("most_words, lane", [(1 << 20, 256), (150, 256), (1 << 20, 7)])
def test_decontamination_against_brute_force(spark, monkeypatch, most_words, lane):
    monkeypatch.setattr(decontaminate, "LANE", lane)
    docs = documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [(1, " ".join(texts[3].upper().split()[5:30])), (2, "one, TWO"), (3, None), (4, "?!"), (5, " ".join(texts[100].split()[100:111])), (5, "nothing like it"), (6, texts[3])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, most_words=most_words)
    assert got.columns == [c for c in docs.columns if c != "contamination"] + ["contamination"]
    for r in got.collect():
        n, hit, found = brute_hits(r["text"], items)
        c = r["contamination"]
        assert (c["n_words"], c["n_hit"], set(c["items"])) == (n, len(hit), found), r["doc_id"]
        covered = sum(len(decontaminate.words(r["text"][s["start"] : s["end"]].encode())) for s in c["spans"])
        assert covered == len(hit)
    assert decontaminate.find_contamination(docs, bench.limit(0)).filter("contamination.n_hit > 0").count() == 0
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0


def test_automaton_against_brute_force():
    """Few different words, so that blocks, short items and windows overlap and repeat in every way."""
    rng = random.Random(4)
    known = decontaminate.Hashes()
    for lane, width in ((256, 10), (5, 10), (3, 4), (64, 1), (16, 7)):
        decontaminate.LANE, before = lane, decontaminate.LANE
        text = lambda n, k=3: " ".join(rng.choice("abcdefg"[:k]) for _ in range(n))
        docs = [text(rng.randint(0, 200), rng.choice([2, 3, 7])) for _ in range(40)] + ["", "a"]
        items = [(rng.randint(0, 9), text(rng.randint(0, 40), rng.choice([2, 3, 7]))) for _ in range(25)] + [(3, docs[0]), (4, docs[5][-40:])]
        words_ = [decontaminate.word_hashes(t.encode(), known) for _, t in items]
        built = decontaminate.Automaton(np.concatenate(words_), np.array([len(w) for w in words_]), np.array([i for i, _ in items]), width)
        got = built.scan([decontaminate.word_hashes(d.encode(), known) for d in docs])
        decontaminate.LANE = before
        for d, (ranges, found) in zip(docs, got):
            _, hit, want = brute_hits(d, items, width)
            assert {x for a, b in ranges for x in range(a, b)} == hit and set(found) == want
            assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
    nothing = decontaminate.Automaton(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert nothing.scan([words_[0]]) == [([], [])]


def test_original_spans_and_slices(monkeypatch):
    raw = "Ä one-TWO  three,\nfour é five".encode()
    assert [raw.decode()[s["start"] : s["end"]] for s in decontaminate.original_spans(raw, [(0, 2), (3, 4), (5, 7)])] == ["Ä one", "three", "é five"]
    assert decontaminate.original_spans(raw, []) == []
    whole = decontaminate.word_hashes(raw * 50, decontaminate.Hashes())
    monkeypatch.setattr(decontaminate, "SLICE", 11)
    monkeypatch.setattr(decontaminate, "KEPT", 2)
    assert (decontaminate.word_hashes(raw * 50, decontaminate.Hashes()) == whole).all() and len(whole) == len(decontaminate.words(raw * 50))


def test_query_op6(spark, duck):
    same(decontaminate.op6_aho_corasick(spark, SF), duck.sql(decontaminate.ORACLE["op6_aho_corasick"]))


def brute_signatures(text):
    import regex

    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, run, spots, content = set(), ["^"], [], []
    for x in (x for x in regex.split(r"[^\p{L}\p{N}]+", line) if x):
        if x in spotsigs.ANCHORS:
            run.append(x)
        else:
            content.append(x)
            spots.append("".join(a + spotsigs.MARK for a in run))
            run = []
    # words stand for anchors where these are rare
    ends_in_anchor = bool(content) and bool(run)
    if len(content) > 1 and not ends_in_anchor and not any(s.strip(spotsigs.MARK + "^") for s in spots):
        spots = [s or "^" + spotsigs.MARK for s in spots[:-1]] + spots[-1:]
    else:
        bare = [not s for s in spots]
        i = 0
        while i < len(content):
            j = i
            while j < len(content) and bare[j]:
                j += 1
            for k in range(i, j) if j - i >= spotsigs.RUN else ():
                if k < len(content) - 1 or ends_in_anchor:
                    spots[k] = "^" + spotsigs.MARK
            i = max(j, i + 1)
    for i, (s, c) in enumerate(zip(spots, content)):
        if s:
            out.add(" ".join([s + c, *content[i + 1 : i + spotsigs.CHAIN]]))
    return out


def test_signatures_against_brute_force(spark):
    cases = ["The cat sat on the mat of the old house and then", "and the of", "x", "", None, "the end", "Das  ist, der Hund! in the", "a " * 30 + "b"]
    df = spark.createDataFrame([(t,) for t in [*cases, "the " * 30_000 + "cat", "w " * 30_000]], "t string")
    for r in spotsigs.with_signatures(spotsigs.with_chains(df, "t", "s"), "t", "h").collect():
        assert set(r["s"]) == brute_signatures(r["t"]) and len(r["h"]) == len(set(r["s"])), r["t"] and r["t"][:50]


def test_texts_with_few_anchors(spark):
    rng = random.Random(7)
    plain = [f"wort{rng.randrange(10**6)}x{i}" for i in range(60)]
    texts = [" | ".join(plain), " | ".join(plain[:30] + plain[29::-1]), " ".join(["the", *plain]), " ".join(["the", *plain[:-1], "other"]), " ".join(plain[:4]), " ".join(plain[:3] + ["other"])]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    sets = {r["i"]: set(r["h"]) for r in spotsigs.with_signatures(df, "t", "h").collect()}
    assert len(sets[0]) == 59 and 0.3 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.6
    assert len(sets[2]) >= 59 and sets[2] != sets[3] and len(sets[2] & sets[3]) >= 57
    assert sets[4] != sets[5]
    # each word counts, and an edit changes the signatures near it alone
    changed = spark.createDataFrame([(i, " ".join([*plain[:i], "other", *plain[i + 1 :]])) for i in range(60)], "i int, t string")
    for r in spotsigs.with_signatures(changed, "t", "h").collect():
        assert 57 <= len(sets[0] & set(r["h"])) < 59


def test_edited_texts_without_anchors(spark, tmp_path):
    rows = [(i, " | ".join(f"n{i}z{k}" for k in range(40))) for i in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert all(0.2 < r["near_edited"] < 1 and r["near_next"] == 0 for r in spotsigs.op4_spotsigs(spark, str(tmp_path)).collect())


def test_query_op4(spark, duck):
    got = {r["doc_id"]: r for r in spotsigs.op4_spotsigs(spark, SF).collect()}
    rows = duck.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    assert len(got) == len(rows)
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        assert got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest() and got[i]["n_chars"] == len(t)
    jaccard = lambda a, b: len(a & b) / len(a | b) if a or b else 1.0
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        mine = brute_signatures(t)
        assert got[i]["near_edited"] == pytest.approx(jaccard(mine, brute_signatures(t[: len(t) - half] + following[:half])))
        assert got[i]["near_next"] == pytest.approx(jaccard(mine, brute_signatures(following)))
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, set()).add(got[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    mean = lambda k: sum(r[k] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.25 > 0.05 > mean("near_next")


def test_next_rows_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 3)
    df = spark.range(20).select((F.col("id") * 7).alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    got = {r["doc_id"]: r["next_text"] for r in spotsigs.with_next(df, "doc_id", ["doc_id", "text"]).filter("NOT __halo").collect()}
    assert got == {i * 7: f"t{(i + 1) % 20}" for i in range(20)}
    assert spotsigs.with_next(df.limit(0), "doc_id", ["doc_id", "text"]).count() == 0
    assert spotsigs.with_next(df.limit(1), "doc_id", ["doc_id", "text"]).filter("NOT __halo").first()["next_text"] == "t0"


def spot_classes(rows, threshold):
    """doc_id -> (class, copy, links, text links) from all pairs of signature sets."""
    n = len(rows)
    sets = [brute_signatures(t) for _, t in rows]
    alike = lambda a, b: (sets[a] == sets[b]) if sets[a] or sets[b] else (rows[a][1] or "") == (rows[b][1] or "")
    near = lambda a, b: alike(a, b) or (sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9)
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [[b for b in range(n) if b != a and near(a, b)] for a in range(n)]
    for a in range(n):
        for b in links[a]:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    least = {}
    for i in range(n):
        least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    texts = lambda a: len({frozenset(sets[b]) for b in links[a] if not alike(a, b)})
    return sorted((rows[i][0], least[top(i)], min(rows[b][0] for b in range(n) if alike(i, b)), len(links[i]), texts(i)) for i in range(n))


@pytest.mark.parametrize("block", [512, 9])
def test_spot_classes_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spotsigs, "COMMON", 5)
    rng = random.Random(6)
    base, extra = words(rng, 90).split(), []
    for i in range(40):  # near copies, some near each other only by way of others
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(90)] = words(rng, 1) + "x"
        extra.append((300 + i, " ".join(w) + " the same end of it", "en"))
    docs = documents(spark, extra)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    got = spotsigs.near_classes(docs, threshold=0.6, block=block).collect()
    assert sorted(tuple(r) for r in got) == spot_classes(rows, 0.6)
    assert max(r["n_text_links"] for r in got) > 20


def test_query_spotsigs_classes(spark, duck):
    rows = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert sorted(tuple(r) for r in spotsigs.spotsigs_classes(spark, SF).collect()) == spot_classes(rows, spotsigs.THRESHOLD)
    assert spotsigs.near_classes(documents(spark).limit(0)).count() == 0


def test_spot_buckets_compare_near_copies_once(spark):
    """Copies with small edits share a fifth of their signatures, but meet in a few buckets only."""
    docs = []
    for i in range(12):
        w = [f"{'the ' if j % 3 == 0 else ''}w{i}x{j}" for j in range(240)]
        docs += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:100] + ["edited"] + w[101:]))]
    _, sets = spotsigs.signature_sets(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", spotsigs.ANCHORS, spotsigs.CHAIN)
    members, _ = spotsigs.bucket_members(sets, 0.8, 512)
    assert 24 <= members.count() <= 24 * 8


def test_spot_buckets_grow_with_the_documents(spark):
    """Phrases that many texts share, in any part of the order, bring texts of phrases of their own into no bucket."""
    rng, sizes = random.Random(3), []
    stock = [f"the s{i}a s{i}b" for i in range(60)]
    for n in (100, 400):
        docs = [(i, " ".join(f"the d{i}x{j} y" for j in range(40)) + " " + " ".join(rng.sample(stock, 25))) for i in range(n)]
        docs += [(n + i, docs[i][1].replace(f"d{i}x3 ", f"e{i} ")) for i in range(5)]
        _, sets = spotsigs.signature_sets(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", spotsigs.ANCHORS, spotsigs.CHAIN)
        members, rows = spotsigs.bucket_members(sets, 0.8, 512)
        assert rows.count() == 10  # the five and their copies
        sizes.append(members.count())
    assert 10 <= sizes[1] <= 2 * sizes[0] <= 400
    assert sum(r["n_links"] for r in spotsigs.near_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()) == 10
