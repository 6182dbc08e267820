import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns that clash with names the operators use inside
CLASH = ("id", "key", "a", "d1", "row", "fp", "block", "epoch", "label", "w", "n", "score_", "start", "file", "u", "v")


def words(rng, n):
    return [f"{rng.choice('bcdfgl')}{rng.choice('aeiou')}{rng.randint(0, 40)}" for _ in range(n)]


def messy_rows():
    """Nulls in any column, empty, blank and very long texts, exact and near copies, repeated rows."""
    rng = random.Random(5)
    base = words(rng, 60)
    near = base[:30] + ["changed"] + base[31:]
    passage = words(rng, 55)
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, "  ".join(base)), (4, " ".join(base)), (4, " ".join(base)),
            (5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "one two"), (10, "ONE two"), (None, " ".join(base)), (None, None),
            (11, " ".join(words(rng, 20) + passage + words(rng, 9))), (12, "\n".join(words(rng, 5) + passage)),
            (13, " ".join(passage * 3)), (14, " ".join(words(rng, 40_000))), (15, "x" * 300_000),
            (-3, " ".join(passage[:20])), (16, "Grüße ÄÖÜ straße naïve façade " * 8), (17, "日本語 テキスト 漢字")]
    rows += [(100 + i, " ".join(words(rng, rng.randint(1, 80)))) for i in range(30)]
    rows += [(200 + i, " ".join(base[:20] + words(rng, 3) + passage[10:40])) for i in range(10)]
    return [(i, t, ("en", "fr", None)[n % 3], ("s0", "s0", "s1", None)[n % 4], None if t is None or n % 5 == 0 else len(t))
            for n, (i, t) in enumerate(rows)]


def clashing(df):
    have = set(df.columns)
    return df.select("*", *[F.lit(f"other {c}").alias(c) for c in CLASH if c not in have])


@pytest.fixture(scope="session")
def messy(spark):
    return clashing(spark.createDataFrame(messy_rows(), SCHEMA)).cache()


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)
