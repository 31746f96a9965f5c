"""Small tables with everything that may go wrong in them."""
import random

WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "se", "ti", "vo", "xu") for c in ("", "n", "s")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    """(doc_id, text, and columns whose names operators use inside): nulls, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    same = prose(rng, 60)
    long = prose(rng, 30_000)
    texts = [(1, same), (2, same), (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "one"), (8, "four words are here"),
             (9, long), (10, same + " " + prose(rng, 2)), (11, "Ünïcode ÀB 日本   é" * 9), (None, same), (None, None), (12, prose(rng, 25)), (12, None)]
    texts[-1] = texts[-2]  # a repeated row
    return [(i, t, "x", 1, 2, "y", 3, None, 4.0, "z") for i, t in texts]


COLUMNS = "doc_id long, text string, class string, size int, block int, key string, n int, doc string, score double, row string"


def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
