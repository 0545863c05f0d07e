"""Documents with everything that may be odd about a table."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, ids string, `start.at` int, spans string, place int"


def words(rng: random.Random, n: int, vocabulary: int = 40) -> list[str]:
    return ["".join(rng.choice("abcdeé") for _ in range(1 + k % 5)) for k in (rng.randrange(vocabulary) for _ in range(n))]


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    passage, other = words(rng, 60, 500), words(rng, 45, 500)
    plain = [" ".join(words(rng, rng.randrange(1, 200), 3000)) for _ in range(30)]
    near = plain[3].split(" ")
    return plain + [
        None, "", "   ", "\n\t \r\x0b\x0c", "one", "two words", "A  b\n\n c ", "x y z \x1c\x85 q", "🙂 日本語 123 4５6!?'s don't 'LL",
        plain[3], plain[3], " ".join([*near[:5], "changed", *near[6:]]), plain[3].upper(), "  ".join(near),
        " ".join(words(rng, 20) + passage + words(rng, 30)), " ".join(words(rng, 7) + passage + other), " ".join(passage + other + passage),
        "\n".join(passage), "ab " * 400, "a" * 30_000, " ".join(words(rng, 6_000)), "é" * 70 + " " + "z" * 200,
    ]


def rows(seed: int = 1) -> list[tuple]:
    out = [(k * 3 + 1, t, "en", None, None if t is None else len(t), "key", None, k, "1", k) for k, t in enumerate(texts(seed))]
    return [*out, out[2], out[2], (None, out[4][1], None, None, None, None, None, None, None, None), (None, None, *[None] * 8), (None, out[4][1], *[None] * 8)]


def documents(spark: SparkSession, seed: int = 1) -> DataFrame:
    return spark.createDataFrame(rows(seed), SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def same(found: list, expected: list) -> None:
    """Equal as bags of rows."""
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
