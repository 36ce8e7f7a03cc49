"""Small tables with the awkward rows that every operator has to bear."""

import random

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()


def words(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(spark, extra=()):
    """Nulls, empty and blank texts, a very long one, copies, near copies, repeated rows; columns with clashing names."""
    rng = random.Random(11)
    base = words(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [(i, words(rng, 60), "en") for i in range(20)]
    rows += [(100, base, "en"), (101, base, "en"), (102, " ".join(near), "en"), (102, " ".join(near), "en"), (103, None, "en"), (104, "", None), (105, "  \n ", "en"), (106, "!!! ???", "fr"), (107, words(rng, 6000), "en"), (108, "one two", "en"), (109, "x" * 5000, "en"), (None, words(rng, 30), "en"), *extra]
    rows += [(200 + i, " ".join(rng.choice("le la des une est dans pour ouéli aveç réti".split()) for _ in range(50)), "fr") for i in range(20)]
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "clash", "clash", 1, 2) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, word string, language string, contamination int, `__k` int")
