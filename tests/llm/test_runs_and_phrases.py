"""Periodic runs and phrase collocations against brute force and SQL."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import periodic_runs, phrases
from tests.conftest import SF, same
from tests.llm.tables import documents


def period_of(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute_runs(w, least=24, times=3):
    found = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q) and period_of(w[i : i + size]) == q:
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_against_all_periods():
    rng = random.Random(3)
    texts = []
    for _ in range(300):
        w = []
        while len(w) < rng.randint(0, 150):
            kind = rng.random()
            seed = [rng.choice([b"a", b"b"]) for _ in range(rng.randint(1, 6))]
            w += seed * rng.randint(1, 12) if kind < 0.5 else [rng.choice([b"a", b"b", b"c", b"x%d" % rng.randint(0, 99)]) for _ in range(rng.randint(1, 20))]
        texts.append(w)
    for least, times in ((24, 3), (6, 3), (1, 4)):
        got = periodic_runs.judged(texts, least, times)
        for w, (runs, left) in zip(texts, got):
            want = brute_runs(w, least, times)
            assert [(r["start"], r["length"], r["period"]) for r in runs] == want
            assert left == collapsed(w, want)


def test_long_texts_and_powers_of_one_word():
    (runs, left), (two, _) = periodic_runs.judged([[b"a"] * 300_000, [b"%d" % (i % 1000) for i in range(200_000)]])
    assert runs == [{"start": 0, "length": 300_000, "period": 1}] and left == b"a"
    assert two == [{"start": 0, "length": 200_000, "period": 1000}]


def test_awkward_rows(spark):
    docs = documents(spark, [(400, "la " * 30 + "end", "en"), (401, "x\ty\nx y  " * 20, "en")])
    docs = docs.withColumnsRenamed({"word": "a.b", "language": "row", "contamination": "runs"})
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(docs, lot=500).collect()}
    assert len(got) == len({r["doc_id"] for r in docs.select("doc_id").collect()}) and got[400]["a.b"] == "clash"
    assert [tuple(r) for r in got[400]["periodic"]["runs"]] == [(0, 30, 1)] and got[400]["periodic"]["collapsed"] == "la end"
    assert [tuple(r) for r in got[401]["periodic"]["runs"]] == [(0, 80, 4)]
    for i in (103, 104, 105):
        assert tuple(got[i]["periodic"]) == (0, [], "")
    assert periodic_runs.find_runs(docs).count() == docs.count() and periodic_runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, times=2)


def test_query_op13(spark, duck):
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    rows = periodic_runs.op13_periodic_runs(spark, SF).collect()
    assert len(rows) == len(texts)
    some = 0
    for r in rows:
        w = (texts[r["doc_id"]] or "").encode().split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        g = h // 10
        n = len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        if n > 4000 and h % 10:
            continue  # the brute force is quadratic
        runs = brute_runs(w)
        some += len(runs)
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert r["n_runs"] == len(runs) and ((r["start"], r["length"], r["period"]) == (best or (None, None, None)))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs)).hexdigest()
    assert some > 10


def test_strongest_run_is_exact(spark):
    big = 10**9
    runs = [(5, 3 * big + 1, big), (0, 3 * big + 1, big), (9, 3 * big + 3, big + 1), (2, 6 * big + 2, 2 * big)]
    df = spark.createDataFrame([(sorted(runs),), ([],)], f"r {periodic_runs.RUNS}").select(periodic_runs.strongest(F.col("r")).alias("b"))
    assert [tuple(x["b"]) if x["b"] else None for x in df.collect()] == [(0, 3 * big + 1, big), None]


def brute_phrases(rows, longest, least, share, top):
    import re

    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    candidates = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    out = []
    for (lang, w), a in candidates.items():
        inside = [c for (g, x), c in candidates.items() if g == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))]
        if any(100 * c >= share * a for c in inside):
            continue
        score, cut = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:cut]], f[lang, w[cut:]], n[lang]))
    out.sort()
    ranks = Counter()
    found = []
    for lang, score, a, phrase, left, right, total in out:
        ranks[lang] += 1
        if top is None or ranks[lang] <= top:
            found.append((lang, ranks[lang], phrase.decode(), -a, left, right, total, -score))
    return found


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 3, 20), (2, 2, 5), (4, 2, None)])
def test_phrases_against_all_ngrams(spark, longest, least, top):
    rng = random.Random(longest)
    rows = [(i, " ".join(rng.choice(["A", "b", "c ", "d,", "e.", "é", "\tf", "g\n", "Ähm", "ÉB", "İX ", "AΣ", "ǅa", "ⅣⒶ", "éÀ"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", None, "und", "fr"])) for i in range(60)]
    docs = documents(spark, [*rows, (900, " . ,; \n", "en"), (901, "b b b b b b b b", "en"), (None, "  x y  ", None)]).withColumnRenamed("word", "grp").withColumnRenamed("language", "w1")
    texts = [(r["text"], r["lang"]) for r in docs.collect()]
    want = sorted(brute_phrases(texts, longest, least, 50, top))
    for head in (phrases.HEAD, 9, 0):  # all words have codes, some, none
        got = phrases.collocations(docs, longest=longest, min_count=least, top=top, head=head).select("grp", "rank", "phrase", "a", "l", "r", "n", "score").collect()
        assert sorted(map(tuple, got)) == want
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_windows_are_padded_and_shuffle_nothing(spark):
    df = spark.createDataFrame([("a b c. d", "en"), (None, None), ("", "en")], "text string, lang string")
    rows = phrases.windows(df)
    assert sorted(map(str, rows.collect())) == sorted(map(str, spark.createDataFrame([("en", "a", "b", "c"), ("en", "b", "c", None), ("en", "c", None, None), ("en", "d", None, None)], rows.schema).collect()))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_scores_beyond_64_bits(spark):
    """1000000 a a / (l r) of counts near 10^12 equals whole-number arithmetic."""
    a, left, right = 10**12 - 3, 10**12 + 7, 3 * 10**12 + 1
    wide = lambda x: F.lit(x).cast("long").cast(phrases.EXACT)
    df = spark.range(1).select((wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)")).cast(phrases.EXACT).alias("over"), (wide(left) * wide(right)).cast(phrases.EXACT).alias("under"))
    assert df.selectExpr("over div under").first()[0] == 1_000_000 * a * a // (left * right)


def test_query_op12(spark, duck):
    same(phrases.op12_collocations(spark, SF), duck.sql(phrases.ORACLE["op12_collocations"]))
