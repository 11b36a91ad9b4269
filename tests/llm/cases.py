"""Small inputs with the awkward cases every operator must take."""

import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(draw) -> str:
    return "".join(draw.choice(["th", "er", "on", "an", "re", "ing", "st", "é", "ün"], draw.integers(1, 4)))


def prose(seed: int, words: int) -> str:
    draw = np.random.default_rng(seed)
    made = [word(draw) for _ in range(words)]
    for at in range(0, words, 9):
        made[at] = made[at].capitalize()
    return " ".join(made) + "."


def documents(spark, extra=()):
    """Ordinary texts, copies, a null and an empty text, blanks, one very long text, a null
    id, a repeated row and nulls in the other columns."""
    rows = [(n, prose(n, 30 + n), "aa" if n % 2 else "bb", f"s{n % 3}", n) for n in range(12)]
    rows += [
        (20, rows[3][1], "bb", "s0", 1),
        (21, None, None, None, None),
        (22, "", "aa", None, 0),
        (23, " \n\t ", None, "s1", 4),
        (24, prose(99, 20_000), "bb", "s0", 9),
        (None, prose(50, 40), "aa", "s0", 1),
        (25, "One two three", None, "s0", 1),
        (25, "One two three", None, "s0", 1),
        *extra,
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
