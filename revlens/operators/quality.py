"""Judging: score each translation, keep those at or above the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.text import is_kept, judge_prompt, parse_score, review_text
from revlens.operators.memory import Memory, call_each_once
from revlens.operators.providers import Judge, call_each
from revlens.params import Params
from revlens.schema import QUALITY

_MODEL_ARGS = ["model_id", "max_tokens", "temperature"]
NUMBER_ARGS = [
    "source_text", "translated_text", "source_language", "target_language", *_MODEL_ARGS,
]
REPLY_ARGS = ["prompt", *_MODEL_ARGS]


def with_judge_texts(long: DataFrame) -> DataFrame:
    """Source and translated text of exploded translations."""
    return long.withColumn("source_text", review_text(F.col("title"), F.col("body"))).withColumn(
        "translated_text", review_text(F.col("translation.title"), F.col("translation.body"))
    )


def score(
    translated: DataFrame, params: Params, judge: Judge, memory: Memory | None = None
) -> DataFrame:
    """Adds ``verdicts``: language, score, kept and error per translation.

    With a ``memory`` only texts that the judge never scored before are sent to it.
    """
    model = params.judge_model
    settings = [
        F.lit(model.model_id).alias("model_id"),
        F.lit(model.max_tokens).alias("max_tokens"),
        F.lit(model.temperature).cast("double").alias("temperature"),
    ]
    source = F.col("_source_text")
    language = F.coalesce("source_language", F.lit(""))

    def call(entry: Column) -> Column:
        text = review_text(entry["value"]["title"], entry["value"]["body"])
        if judge.replies:
            prompt = judge_prompt(source, text, language, entry["key"], params.quality)
            return F.struct(prompt.alias("prompt"), *settings)
        return F.struct(
            source.alias("source_text"),
            text.alias("translated_text"),
            language.alias("source_language"),
            entry["key"].alias("target_language"),
            *settings,
        )

    entries = F.map_entries("translations")
    prepared = translated.withColumn("_source_text", review_text(F.col("title"), F.col("body")))
    asked = (
        prepared,
        judge.provider,
        F.transform(entries, call),
        REPLY_ARGS if judge.replies else NUMBER_ARGS,
        "_results",
        "string" if judge.replies else "double",
    )
    called = call_each(*asked) if memory is None else call_each_once(*asked, ["seq"], memory)

    def verdict(entry: Column, i: Column) -> Column:
        result = F.get("_results", i)
        value = result["value"]
        if judge.replies:
            value = parse_score(value, params.quality)
        # A failed call scores lowest, so its translation is dropped, not served.
        floor = F.lit(float(params.quality.scale_min))
        points = F.when(result["error"].isNotNull(), floor).otherwise(value)
        return F.struct(
            entry["key"].alias("language"), points.alias("score"), result["error"].alias("error")
        )

    scored = F.transform(entries, verdict)
    return called.withColumn(
        "verdicts",
        F.transform(
            scored,
            lambda v: F.struct(
                v["language"],
                v["score"],
                is_kept(v["score"], params.quality).alias("kept"),
                v["error"],
            ),
        ),
    ).drop("_results", "_source_text")


def with_quality(scored: DataFrame) -> DataFrame:
    """Turns ``verdicts`` into the ``quality`` map, empty for a review without any."""
    entries = F.transform(
        "verdicts", lambda v: F.struct(v["language"], F.struct(v["score"], v["kept"]))
    )
    return scored.withColumn("quality", F.map_from_entries(entries).cast(QUALITY)).drop("verdicts")


def score_translations(
    translated: DataFrame, params: Params, judge: Judge, memory: Memory | None = None
) -> DataFrame:
    return with_quality(score(translated, params, judge, memory))


def filter_kept(scored: DataFrame) -> DataFrame:
    """Drops the languages that were not kept from both maps; every review stays."""
    return scored.withColumn(
        "quality", F.map_filter("quality", lambda _, v: F.coalesce(v["kept"], F.lit(False)))
    ).withColumn(
        "translations",
        F.map_filter("translations", lambda k, _: F.map_contains_key(F.col("quality"), k)),
    )


def quality_counts(scored: DataFrame) -> DataFrame:
    """Counters of the stage, from ``score``'s rows."""
    n = F.size("verdicts")
    kept = F.size(F.filter("verdicts", lambda v: v["kept"]))
    errors = F.size(F.filter("verdicts", lambda v: v["error"].isNotNull()))

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x), F.lit(0))

    return scored.agg(
        F.count("*").alias("reviews"),
        total(n).alias("translations"),
        total(kept).alias("kept"),
        total(n - kept).alias("filtered"),
        total(errors).alias("errors"),
    )
