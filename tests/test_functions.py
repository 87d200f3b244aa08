"""Column functions against plain Python on many texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from revlens.functions.similarity import tokens, with_similarity, with_tokens
from revlens.functions.text import (
    fill, is_kept, judge_prompt, parse_score, printed, review_text, strip,
)
from revlens.params import QualityParams

SCALE = QualityParams()
ALPHABET = "abcXYZ éÜß_0129²½ \t\n\r\x0b\x1c\x85\xa0 　.,!?-'日本語кот́٣😀"


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def words(text):
    return re.findall(r"\w+", text.lower())


def likeness(a, b):
    x, y = words(a), words(b)
    if not x and not y:
        return 1.0
    if not x or not y:
        return 0.0
    shared = len(set(x) & set(y)) / len(set(x) | set(y))
    return 0.75 * shared + 0.25 * min(len(x), len(y)) / max(len(x), len(y))


def test_tokens_and_strip_match_python(spark):
    made = texts(400)
    df = spark.createDataFrame([(t,) for t in made], "t string").select(
        "t", tokens(F.col("t")).alias("w"), strip(F.col("t")).alias("s")
    )
    for row in df.collect():
        # A combining mark is no word character in either engine's reading.
        assert row["w"] == words(row["t"]), repr(row["t"])
        assert row["s"] == row["t"].strip(), repr(row["t"])


@pytest.mark.parametrize(
    "a, b, value",
    [
        ("the fabric is soft", "the fabric is soft", 1.0),
        ("", "", 1.0),
        ("something", "", 0.0),
        ("...", "", 1.0),
        (None, "", 1.0),
        ("alpha beta gamma", "delta epsilon zeta", 0.25),
        ("Été Chaud", "été chaud", 1.0),
        ("soft warm fabric", "soft cold fabric", 0.625),
    ],
)
def test_similarity_constants(spark, a, b, value):
    assert similar(spark, [(a, b)]) == [value]


def similar(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    df = with_tokens(with_tokens(df, F.col("a"), "x"), F.col("b"), "y")
    return [r["s"] for r in with_similarity(df, "x", "y", "s").orderBy("i").collect()]


def test_similarity_matches_python(spark):
    rng = random.Random(3)
    bag = "soft warm red blue shirt shoe the a is not very good bad fit été".split()
    pairs = [
        (" ".join(rng.choices(bag, k=rng.randrange(12))), " ".join(rng.choices(bag, k=rng.randrange(12))))
        for _ in range(300)
    ]
    for pair, value in zip(pairs, similar(spark, pairs)):
        assert abs(value - likeness(*pair)) <= 0.5e-4 + 1e-9, pair


REPLIES = {
    "4": 4.0,
    "4.5/5": 4.5,
    "Score: 3.0": 3.0,
    "no number": 1.0,
    "": 1.0,
    None: 1.0,
    "9": 5.0,
    "-2": 1.0,
    "1-5: 4": 1.0,
    "between 3 and 4": 3.0,
    ".5": 5.0,
    "٤": 4.0,
    "9" * 400: 5.0,
}


def test_parse_score(spark):
    df = spark.createDataFrame([(t,) for t in REPLIES], "t string")
    for row in df.select("t", parse_score(F.col("t"), SCALE).alias("s")).collect():
        assert row["s"] == REPLIES[row["t"]], row["t"]


def test_kept_is_inclusive_and_never_undefined(spark):
    df = spark.createDataFrame([(3.0,), (2.999,), (float("nan"),), (None,), (5.0,)], "s double")
    kept = [r[0] for r in df.select(is_kept(F.col("s"), SCALE)).collect()]
    assert kept == [True, False, False, False, True]


def test_review_text(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b "), ("", ""), (" a", None)], "t string, b string")
    made = [r[0] for r in df.select(review_text(F.col("t"), F.col("b"))).collect()]
    assert made == ["a\n\nb", "b", "", "a"]


def test_prompt_holds_texts_and_scale(spark):
    row = spark.range(1).select(
        judge_prompt(F.lit("Bon {x}"), F.lit("Gut"), F.lit("fr"), F.lit("de"), SCALE).alias("p")
    ).first()
    assert "Source language: fr\nTarget language: de\nSource text:\nBon {x}\n\nTranslation:\nGut\n\n" in row["p"]
    assert "from 1 to 5 (where 5 is a flawless translation and 1 is unusable)" in row["p"]


def test_fill_takes_constants_and_columns(spark):
    assert spark.range(1).select(fill("{a}-{b}!", a=3, b=F.col("id"))).first()[0] == "3-0!"


def test_printed_figures(spark):
    df = spark.createDataFrame([(4.0,), (4.483,), (100.0,), (None,), (0.0,)], "x double")
    assert [r[0] for r in df.select(printed(F.col("x"))).collect()] == ["4", "4.483", "100", "–", "0"]
