"""Exact quotas per stratum beside sorting every stratum."""

import hashlib

import pytest
from pyspark.sql import functions as F

from revlens.operators import sample


def draw(seed, key):
    return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:15], 16)


def expected(rows, quotas, seed):
    found = set()
    for stratum in {s for _, s in rows}:
        need = sum(n for s, n in quotas if s == stratum)
        found |= set(sorted((i for i, s in rows if s == stratum), key=lambda i: (draw(seed, i), i))[:need])
    return found


ROWS = [(i, "hot" if i % 4 else ["a", "b", None, "c"][i // 4 % 4]) for i in range(4000)]
QUOTAS = [("hot", 700), ("hot", 33), ("a", 40), ("b", 0), (None, 7), ("c", 5000), ("absent", 9)]


@pytest.mark.parametrize("border_rows", [1, 40, 1 << 16])
@pytest.mark.parametrize("parts", [1, 6])
def test_quotas_are_met(spark, border_rows, parts):
    """One hot stratum, one without quota, one too small, null, and quotas that add up."""
    df = spark.createDataFrame([(i, s, f"t{i}") for i, s in ROWS], "id long, s string, text string")
    quotas = spark.createDataFrame(QUOTAS, "s string, quota long")
    made = sample.stratified(df.repartition(parts, F.rand(3)), "s", quotas, "id", 5, border_rows)
    assert made.columns == df.columns
    rows = [r["id"] for r in made.collect()]
    assert len(rows) == len(set(rows)) == 733 + 40 + 7 + 250
    assert set(rows) == expected(ROWS, QUOTAS, 5)


def test_another_seed_and_no_rows(spark):
    df = spark.createDataFrame(ROWS, "id long, s string")
    quotas = spark.createDataFrame(QUOTAS, "s string, quota long")
    first, second = ({r["id"] for r in sample.stratified(df, "s", quotas, "id", seed).collect()} for seed in (1, 2))
    assert first != second and len(first) == len(second)
    assert sample.stratified(df.limit(0), "s", quotas, "id", 1).count() == 0
    assert sample.stratified(df, "s", quotas.limit(0), "id", 1).count() == 0


def test_no_stratum_is_sorted_whole(spark, monkeypatch):
    """What is ranked is at most the border's rows, however large the stratum."""
    narrowed, seen = sample._narrowed, []

    def watched(draws, border, shift):
        found = narrowed(draws, border, shift)
        seen.append(found.agg(F.max("_rows")).first()[0])
        return found

    monkeypatch.setattr(sample, "_narrowed", watched)
    df = spark.range(50_000).select("id", F.lit("one").alias("s"))
    quotas = spark.createDataFrame([("one", 20_000)], "s string, quota long")
    assert sample.stratified(df, "s", quotas, "id", 1, border_rows=2).count() == 20_000
    assert seen[-1] <= 2
