"""Lexical similarity of two texts from their token sets and lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens import fixed_values as fixed


def tokens(text: Column) -> Column:
    """Lower-case words. Java's own ``\\w`` is ASCII, so the classes are spelled out."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]++"), F.lit(0)
    )


def with_tokens(df: DataFrame, text: Column, prefix: str) -> DataFrame:
    """Adds ``<prefix>_n`` (token count) and ``<prefix>_vocab`` (distinct tokens)."""
    raw = f"{prefix}_tokens"
    return (
        df.withColumn(raw, tokens(text))
        .withColumn(f"{prefix}_n", F.size(raw))
        .withColumn(f"{prefix}_vocab", F.array_distinct(raw))
        .drop(raw)
    )


def with_similarity(df: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """Adds the similarity of two texts prepared by ``with_tokens``.

    Token arrays stay arrays of their own row and are never exploded, so a long
    text costs its own size and no shuffle.
    """
    n_left, n_right = F.col(f"{left}_n"), F.col(f"{right}_n")
    only_left = F.col("_only_left")
    # Both sides are distinct, so one set difference gives overlap and union.
    common = F.size(f"{left}_vocab") - only_left
    union = F.size(f"{right}_vocab") + only_left
    blend = F.lit(fixed.JACCARD_WEIGHT) * (common / union) + F.lit(fixed.LENGTH_WEIGHT) * (
        F.least(n_left, n_right) / F.greatest(n_left, n_right)
    )
    return (
        df.withColumn("_only_left", F.size(F.array_except(f"{left}_vocab", f"{right}_vocab")))
        .withColumn(
            out,
            F.when((n_left == 0) & (n_right == 0), F.lit(1.0))
            .when((n_left == 0) | (n_right == 0), F.lit(0.0))
            .otherwise(F.bround(blend, fixed.SIMILARITY_DECIMALS)),
        )
        .drop("_only_left")
    )
