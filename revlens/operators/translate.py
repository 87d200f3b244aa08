"""Translation: route, fan out to every target, drop half-translated languages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.arrays import items
from revlens.operators.memory import Memory, call_each_once
from revlens.operators.providers import Provider, call_each
from revlens.params import Params
from revlens.schema import TRANSLATIONS
from revlens.sources.tables import keep

ATTEMPTS = (
    "array<struct<lang_pos:int,target_language:string,title:string,body:string,error:string>>"
)


def is_passthrough(params: Params) -> Column:
    return F.col("source_language").eqNullSafe(F.lit(params.passthrough_language))


def route_counters(params: Params) -> dict[str, Column]:
    """Aggregates over reviews, by name: in, translated and passed through. A routed review
    counts as translated even if every call for it failed."""
    passed = is_passthrough(params)
    return {
        "reviews_in": F.count("*"),
        "translated_reviews": F.count_if(~passed),
        "passthrough_reviews": F.count_if(passed),
    }


def route_counts(reviews: DataFrame, params: Params) -> DataFrame:
    return reviews.agg(*[c.alias(name) for name, c in route_counters(params).items()])


def fan_out(reviews: DataFrame, params: Params) -> DataFrame:
    """One row per routed review and target, the source's own language included."""
    return reviews.where(~is_passthrough(params)).select(
        "*",
        F.posexplode(_targets(params)).alias("lang_pos", "target_language"),
    )


def attempt(
    reviews: DataFrame,
    params: Params,
    translator: Provider,
    distinct_texts: bool = False,
    memory: Memory | None = None,
) -> DataFrame:
    """Adds ``attempts``: title, body and error per target, in target order.

    With ``distinct_texts`` each (text, source language) is sent once, which pays
    when the translator is pure and texts repeat; it costs shuffles of the text. With a
    ``memory`` that holds over all runs: only calls never answered before are made.
    """
    if distinct_texts and memory is None:
        return _attempt_distinct(reviews, params, translator)
    calls = F.when(
        ~is_passthrough(params),
        F.array(
            *[
                _call(F.col(name), F.lit(lang))
                for lang in params.target_languages
                for name in ("title", "body")
            ]
        ),
    ).otherwise(F.array().cast("array<struct<text:string,source:string,target:string>>"))
    args = ["text", "source", "target"]
    if memory is None:
        called = call_each(reviews, translator, calls, args, "_results", "string")
    else:
        called = call_each_once(
            reviews, translator, calls, args, "_results", "string", ["seq"], memory
        )
    results = F.col("_results")
    pairs = [
        (F.get(results, F.lit(2 * i)), F.get(results, F.lit(2 * i + 1)))
        for i in range(len(params.target_languages))
    ]
    return called.withColumn("attempts", _attempts(params, pairs)).drop("_results")


def _attempt_distinct(reviews: DataFrame, params: Params, translator: Provider) -> DataFrame:
    passed = is_passthrough(params)
    routed = reviews.where(~passed)
    texts = routed.select(
        "source_language", F.explode(F.array("title", "body")).alias("text")
    ).distinct()
    calls = F.array(*[_call(F.col("text"), F.lit(lang)) for lang in params.target_languages])
    # Both joins below read the answers: without a table the calls would run twice.
    answered = keep(
        call_each(texts, translator, calls, ["text", "source", "target"], "results", "string")
    )

    # The answers hold one row per key, so a text that a third of the reviews share
    # is one big partition on the review side only; the adaptive skew join splits
    # it and repeats that single answer.
    joined = routed
    for name in ("title", "body"):
        side = answered.select(
            F.col("source_language").alias("_lang"),
            F.col("text").alias("_text"),
            F.col("results").alias(f"_{name}"),
        )
        same = F.col("source_language").eqNullSafe(F.col("_lang")) & F.col(name).eqNullSafe(
            F.col("_text")
        )
        joined = joined.join(side, same, "left").drop("_lang", "_text")
    pairs = [
        (F.get("_title", F.lit(i)), F.get("_body", F.lit(i)))
        for i in range(len(params.target_languages))
    ]
    joined = joined.withColumn("attempts", _attempts(params, pairs)).drop("_title", "_body")
    untouched = reviews.where(passed).withColumn("attempts", F.array().cast(ATTEMPTS))
    return joined.unionByName(untouched)


def with_translations(attempted: DataFrame, params: Params) -> DataFrame:
    """Turns ``attempts`` into the ``translations`` map and the ``failed`` list.

    A language enters the map only if both fields came back. Passthrough and
    all-failed reviews get an empty map. ``failed`` holds identifiers, no text.
    """

    def came_back(a: Column) -> Column:
        return a["title"].isNotNull() & a["body"].isNotNull()

    entries = F.transform(
        F.filter("attempts", came_back),
        lambda a: F.struct(
            a["target_language"],
            F.struct(
                a["title"].alias("title"),
                a["body"].alias("body"),
                F.lit(params.engine).alias("engine"),
            ),
        ),
    )
    lost = F.transform(
        F.filter("attempts", lambda a: ~came_back(a)),
        lambda a: F.struct(a["lang_pos"], a["target_language"], a["error"]),
    )
    return (
        attempted.withColumn("translations", F.map_from_entries(entries).cast(TRANSLATIONS))
        .withColumn("failed", lost)
        .drop("attempts")
    )


def translate(
    reviews: DataFrame,
    params: Params,
    translator: Provider,
    distinct_texts: bool = False,
    memory: Memory | None = None,
) -> DataFrame:
    """Reviews with a ``translations`` map, one row per review."""
    attempted = attempt(reviews, params, translator, distinct_texts, memory)
    return with_translations(attempted, params).drop("failed")


def failed_translations(translated: DataFrame) -> DataFrame:
    """The languages a review lost."""
    return translated.select(
        "seq", "review_id", "source_language", F.explode(items("failed")).alias("f")
    ).select("seq", "review_id", "source_language", "f.*")


def explode_translations(translated: DataFrame) -> DataFrame:
    """One row per existing translation, in the review's own order of languages."""
    carried = [c for c in translated.columns if c not in ("translations", "quality")]
    return translated.select(
        *carried, F.posexplode(F.map_entries("translations")).alias("entry", "_pair")
    ).select(
        *carried,
        "entry",
        F.col("_pair.key").alias("language"),
        F.col("_pair.value").alias("translation"),
    )


def _targets(params: Params) -> Column:
    return F.array(*map(F.lit, params.target_languages))


def _call(text: Column, target: Column) -> Column:
    return F.struct(
        text.alias("text"),
        F.col("source_language").alias("source"),
        target.alias("target"),
    )


def _attempts(params: Params, pairs: list[tuple[Column, Column]]) -> Column:
    made = F.array(
        *[
            F.struct(
                F.lit(i).alias("lang_pos"),
                F.lit(lang).alias("target_language"),
                title["value"].alias("title"),
                body["value"].alias("body"),
                F.coalesce(title["error"], body["error"]).alias("error"),
            )
            for i, (lang, (title, body)) in enumerate(zip(params.target_languages, pairs))
        ]
    ).cast(ATTEMPTS)
    return F.when(~is_passthrough(params), made).otherwise(F.array().cast(ATTEMPTS))
