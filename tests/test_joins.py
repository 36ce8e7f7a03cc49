"""Joins on containment and prefixes against brute force, and their plans."""

import math
import random
import re

from pyspark.sql import functions as F

from tallyforge.operators import corpus, runs
from tallyforge.operators.substrings import containing, grams, occurrences
from tallyforge.sources import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def text(rng, most=14):
    return "".join(rng.choice("aAbß .é😀\n") for _ in range(rng.randint(0, most)))


def test_containment(spark):
    rng = random.Random(4)
    hay = [(i, rng.randint(0, 2), text(rng, 40)) for i in range(60)] + [(90, 0, None), (91, 1, "")]
    needles = [(i, rng.randint(0, 2), text(rng, 5)) for i in range(60)] + [(90, 0, None), (91, 1, ""), (92, 1, "ab"), (93, 1, "ab")]
    a, b = spark.createDataFrame(hay, "h long, t long, text string"), spark.createDataFrame(needles, "n long, t long, needle string")
    for on in (("t",), ()):
        got = containing(a if on else a.drop("t"), "text", b if on else b.drop("t"), "needle", on)
        want = sorted((h, n) for h, s, x in hay for n, t, y in needles if x and y and y in x and (not on or s == t))
        assert sorted((r["h"], r["n"]) for r in got.collect()) == want
        assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert containing(a.limit(0), "text", b, "needle", ("t",)).count() == 0


def test_grams_and_occurrences(spark):
    df = spark.createDataFrame([("aaaa\nb", "aa")], "t string, n string").select(grams(F.col("t")).alias("g"), occurrences(F.col("t"), F.col("n")).alias("o"))
    assert df.first().asDict() == {"g": ["aaa", "aa\n", "a\nb"], "o": 2}


def test_search_of_many_queries(spark):
    rng = random.Random(8)
    words = ["alpha", "alp", "Bête", "x_1", "no", "ha-ha", "ALPHA", "lphab"]
    docs = [(f"f{i}", " ".join(rng.choice(words) + rng.choice(["", ".", "alpha", "'s"]) for _ in range(rng.randint(0, 30)))) for i in range(40)] + [("null", None), ("empty", "")]
    asked = [(i, " ".join(rng.choice([*words, "bê", "pha", "missing"]) for _ in range(rng.randint(1, 5)))) for i in range(30)] + [(98, None), (99, "a b ?")]
    got = corpus.search_many(spark.createDataFrame(docs, "filename string, text_content string"), spark.createDataFrame(asked, "query_id long, query string"), 3)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    want = []
    for i, q in asked:
        terms = [t.lower() for t in re.split(r"\W+", q or "") if len(t) > 2]
        scored = []
        for name, body in docs:
            low = (body or "").lower()
            hits = [low.count(t) for t in terms]
            if any(hits):
                at = low.index(first := next(t for t, n in zip(terms, hits) if n))
                snippet = body[max(0, at - 100) : at + len(first) + 100].strip(" ")[:300]
                scored.append((-(sum(n > 0 for n in hits) / len(terms) * (1 + math.log(1 + sum(hits)))), name, sum(hits), snippet))
        want += [(i, k + 1, name, n, s) for k, (_, name, n, s) in enumerate(sorted(scored)[:3])]
    assert sorted((r["query_id"], r["rank"], r["filename"], r["match_count"], r["snippet"]) for r in got.collect()) == want


def test_many_searches_agree_with_single_ones(spark):
    docs = spark.createDataFrame([(f"f{i}", f"the {'tion ' * i} other {i}") for i in range(9)], "filename string, text_content string")
    many = corpus.search_many(docs, spark.createDataFrame([(1, "The tion of the")], "query_id long, query string"))
    one = corpus.search(docs, "The tion of the")
    fields = ("filename", "relevance_score", "snippet")
    assert [tuple(r[f] for f in fields) for r in many.orderBy("rank").collect()] == [tuple(r[f] for f in fields) for r in one.collect()]


def test_prices_by_prefix_both_ways(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab%_") for _ in range(rng.randint(0, n)))
    prices = [(i, word(4), float(i), 1.0) for i in range(1500)] + [(-1, "none", 9.0, 1.0)]
    models = [word(5) for _ in range(80)] + [None, "", "none-x"]
    p = spark.createDataFrame([(i, m) for i, m in enumerate(models)], "i long, model string")
    listed = spark.createDataFrame(prices, "ord int, key string, input_rate double, output_rate double")
    tests = {"exact": lambda m, k: m == k, "prefix": lambda m, k: m.startswith(k), "either": lambda m, k: m.startswith(k) or k.startswith(m)}
    for match, fits in tests.items():
        out = runs.priced(p, listed, match, (7.0, 7.0))
        assert "NestedLoop" not in plan(out) and out.columns == ["i", "model", "price_key", "input_rate", "output_rate"]
        got = {r["i"]: (r["price_key"], r["input_rate"]) for r in out.collect()}
        for i, m in enumerate(models):
            found = min(((o, k, r) for o, k, r, _ in prices if m is not None and fits(m, k)), default=None)
            assert got[i] == (found[1:] if found else (None, 7.0))


def test_citations_of_many_tasks(spark):
    c = "task_id long, citation long, title string, url string"
    cited = spark.createDataFrame([(1, 1, "See A.PDF now", "u1"), (1, 2, "nothing", "http://x/b.Txt"), (1, 3, "other", "u3"), (1, 4, None, None), (2, 1, "a.pdf", "u"), (3, 1, "t", "u"), (4, 1, "zz q", "u9"), (4, 0, "zz", "u8")], c)
    names = spark.createDataFrame([(1, "a.pdf"), (1, "B.txt"), (1, None), (2, "c"), (3, ""), (4, "q")], "task_id long, filename string")
    got = {r["task_id"]: (r["total"], r["external"], r["external_urls"], r["ratio"], r["compliant"]) for r in corpus.audit_citations(cited, names).collect()}
    assert got == {1: (4, 1, ["u3"], 0.75, False), 2: (1, 1, ["u"], 0.0, False), 3: (1, 0, [], 1.0, True), 4: (2, 1, ["u8"], 0.5, False)}


def test_ordered_export(spark, tmp_path):
    rows = spark.range(500).select(*[F.lit("x").alias(c) if c not in ("task_id", "dispatched_at") else (F.concat(F.lit("t"), "id").alias(c) if c == "task_id" else F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 100).cast("string")).alias(c)) for c in sinks.CSV_COLUMNS], F.lit(0).alias("pass_idx")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a small table would be one part
    try:
        sinks.write_ordered_csv(rows, str(tmp_path / "o"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(p for p in (tmp_path / "o").iterdir() if p.name.startswith("part-"))
    assert len(parts) > 2 and "Single" not in plan(rows.orderBy("task_id"))
    sinks.join_parts(str(tmp_path / "o"), str(tmp_path / "one.csv"))
    lines = (tmp_path / "one.csv").read_text().splitlines()
    assert lines[0] == ",".join(sinks.CSV_COLUMNS) and len(lines) == 501
    at, day = sinks.CSV_COLUMNS.index("task_id"), sinks.CSV_COLUMNS.index("dispatched_at")
    keys = [(x.split(",")[day].strip('"'), x.split(",")[at]) for x in lines[1:]]
    assert keys == sorted(keys)


def test_statistics_come_from_the_pass_that_writes(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    run = "struct<model:string,completed:boolean,error:string,total_cost_usd:double,total_duration_sec:double,started_at:string,completed_at:string>"
    rows = spark.createDataFrame([(f"t{i}", i % 2, {"a": [("m1" if i % 3 else "m2", True, None, 1.0, 1.0, None, None)]}, None, None) for i in range(30)], f"task_id string, source_ord int, agent_results map<string,array<{run}>>, dispatched_at string, completed_at string")
    rows = rows.mapInArrow(count, rows.schema)
    for dry in (False, True):
        before = seen.value
        got = sinks.extract_with_stats(rows, "m1", "exact", str(tmp_path / "out"), 2, dry_run=dry).collect()
        assert [tuple(r) for r in got] == [(0, 15, 10, 10), (1, 15, 10, 10)] and seen.value - before == 30
    assert spark.read.text(str(tmp_path / "out")).count() == 20
