"""Small tables for the tests of the training-data operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# The same with columns named like names the operators use themselves.
CLASHING = SCHEMA + ", _row string, _id long, _text string, _hash long, _norm string, copy int, n_words long, shard int"

WORDS = "the of and to in that it was for on are with as his they at be this from or had by hot but some what".split()


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))


def awkward_rows(seed=0):
    """Nulls in every column, empty and long texts, copies, near copies, ties and repeated rows."""
    rng = random.Random(seed)
    long_text = prose(rng, 30_000, [f"w{i}" for i in range(4000)])
    base = prose(rng, 80, [f"v{i}" for i in range(300)])
    near = base.split(" ")
    near[-1] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base.replace(" ", "  "), "en", "a", 1), (3, " ".join(near), "en", "b", 1),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \t\n", "de", "b", 3), (7, long_text, "en", "a", 9),
        (8, long_text, "en", "c", 9), (None, "a row without an id", "en", "a", 1), (None, base, "fr", None, 2),
        (9, "one two", "en", "a", 7), (10, "one two", "en", "a", 7), (10, "one two", "en", "a", 7),
        (11, "x y " * 60, "en", "b", 240), (12, "1234 !!! ???", "en", "a", 12),
    ]
    rows += [(100 + i, prose(rng, rng.randint(1, 120)), rng.choice(["en", "de", None]), rng.choice("abc"), i)
             for i in range(40)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def clashing(spark, rows):
    wide = [(*r, "r", 5, "t", 6, "n", 7, 8, 9) for r in rows]
    return spark.createDataFrame(wide, CLASHING).repartition(3)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]
