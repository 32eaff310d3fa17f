"""Small tables with the awkward rows every operator must stand."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, version string, hash string, pos int, grp int, rep long"


def docs(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns that clash with inner names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), 7, "v", "h", 1, 2, 3) for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(words)]
    return [rng.choice(pool) for _ in range(n)]


def edited(words, every, seed=0):
    rng = random.Random(seed)
    return [f"x{rng.randrange(10**9)}" if rng.randrange(every) == 0 else w for w in words]
