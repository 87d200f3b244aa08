"""Evaluation: round trips, similarity, and figures per language and overall."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from revlens import fixed_values as fixed
from revlens.functions.similarity import with_similarity, with_tokens
from revlens.functions.text import printed
from revlens.operators.ingest import check, valid
from revlens.operators.providers import Judge, Provider, call_each
from revlens.operators.quality import score_translations
from revlens.operators.translate import translate
from revlens.params import Params
from revlens.sources.tables import keep


def back_translate(translated: DataFrame, translator: Provider) -> DataFrame:
    """One row per existing translation: its text taken back to the source
    language, and the similarity of that to the original. A failed call gives 0."""
    calls = F.flatten(
        F.transform(
            F.map_entries("translations"),
            lambda e: F.array(
                *[
                    F.struct(
                        F.coalesce(e["value"][name], F.lit("")).alias("text"),
                        e["key"].alias("source"),
                        F.coalesce("source_language", F.lit("")).alias("target"),
                    )
                    for name in ("title", "body")
                ]
            ),
        )
    )
    fields = ["text", "source", "target"]
    called = call_each(translated, translator, calls, fields, "_results", "string", together=2)
    # The original is tokenized before its row is repeated per language, and only if
    # it is: a filter here would be pushed below the steps that made the map.
    text = F.when(F.size("translations") > 0, F.concat_ws("\n\n", "title", "body"))
    original = with_tokens(called, text, "_original")
    long = original.select(
        "seq",
        "review_id",
        "product_id",
        "source_language",
        "_original_n",
        "_original_vocab",
        "_results",
        *([F.col("quality")] if "quality" in translated.columns else []),
        F.posexplode(F.map_keys("translations")).alias("entry", "language"),
    )
    title = F.get("_results", 2 * F.col("entry"))
    body = F.get("_results", 2 * F.col("entry") + 1)
    answered = long.select(
        "*",
        title["value"].alias("back_title"),
        # A column expression answers for the body even if the title has failed.
        F.when(title["error"].isNull(), body["value"]).alias("back_body"),
        F.coalesce(title["error"], body["error"]).alias("error"),
    ).drop("_results")
    compared = with_similarity(
        with_tokens(answered, F.concat_ws("\n\n", "back_title", "back_body"), "_back"),
        "_original",
        "_back",
        "_similarity",
    )
    return compared.withColumn(
        "similarity", F.when(F.col("error").isNotNull(), F.lit(0.0)).otherwise(F.col("_similarity"))
    ).drop(
        "_original_n", "_original_vocab", "_back_n", "_back_vocab", "_similarity"
    )


def judged_round_trips(scored: DataFrame, translator: Provider) -> DataFrame:
    """Scores and round trips of the same translations, in one pass."""
    verdict = F.try_element_at("quality", F.col("language"))
    return (
        back_translate(scored, translator)
        .withColumn("judge_score", F.coalesce(verdict["score"], F.lit(0.0)))
        .withColumn("kept", F.coalesce(verdict["kept"], F.lit(False)))
        .drop("quality")
    )


def details(judged: DataFrame) -> DataFrame:
    """One row per translation. A review id that occurs more than once shows the
    similarity of its last round trip, so similarities are reduced to one per
    (review_id, language) first; a repeated id is then large on the left only,
    which the adaptive skew join splits."""
    key = ["review_id", "language"]
    last = judged.groupBy(*key).agg(F.max_by("similarity", "seq").alias("similarity"))
    return judged.drop("similarity").join(last, key, "left").select(
        "seq", "entry", "review_id", "product_id", "language", "judge_score", "kept", "similarity"
    )


def language_metrics(judged: DataFrame, params: Params) -> DataFrame:
    """Figures per language, configured ones in their order and always there, any
    others after them.

    Rows are first reduced to (review_id, language): the last similarity counts
    once per row of its key, so no join back to the rows is needed and a repeated
    id is combined before the shuffle.
    """
    similarity = F.col("similarity").cast("decimal(9,4)")
    keys = judged.groupBy("review_id", "language").agg(
        F.count("*").alias("n"),
        F.count_if("kept").alias("kept"),
        F.sum("judge_score").alias("scores"),
        F.max_by(similarity, "seq").alias("similarity"),
    )
    found = keys.groupBy("language").agg(
        F.sum("n").alias("translation_count"),
        F.sum("kept").alias("kept_count"),
        F.sum("scores").alias("scores"),
        # Decimal sums do not depend on the order rows arrive in.
        F.sum(F.col("similarity") * F.col("n").cast("decimal(18,0)")).alias("similarities"),
        F.sum(F.when(F.col("similarity").isNotNull(), F.col("n"))).alias("with_similarity"),
    )
    spark = judged.sparkSession
    targets = spark.createDataFrame(
        list(enumerate(params.target_languages)), "lang_pos int, language string"
    )
    count = F.coalesce("translation_count", F.lit(0))
    kept = F.coalesce("kept_count", F.lit(0))
    return (
        targets.join(found, "language", "full")
        .select(
            "lang_pos",
            "language",
            count.alias("translation_count"),
            kept.alias("kept_count"),
            (count - kept).alias("filtered_count"),
            F.bround(F.col("scores") / F.nullif(count, F.lit(0)), fixed.MEAN_DECIMALS).alias(
                "mean_judge_score"
            ),
            F.bround(
                F.col("similarities").cast("double") / F.nullif("with_similarity", F.lit(0)),
                fixed.MEAN_DECIMALS,
            ).alias("mean_similarity"),
            percent(kept, count).alias("kept_pct"),
            percent(count - kept, count).alias("filtered_pct"),
        )
        .orderBy(F.col("lang_pos").asc_nulls_last(), "language")
    )


def overall(scored: DataFrame, params: Params) -> DataFrame:
    """The one-row total, from the reviews with their ``quality`` map."""
    n = F.size("quality")
    kept = F.size(F.filter(F.map_values("quality"), lambda v: v["kept"]))
    sums = scored.agg(
        F.count("*").alias("total_reviews"),
        F.count_if(n > 0).alias("translated_reviews"),
        F.coalesce(F.sum(n), F.lit(0)).alias("total_translations"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("overall_kept"),
    )
    total, good = F.col("total_translations"), F.col("overall_kept")
    return sums.select(
        "*",
        (total - good).alias("overall_filtered"),
        percent(good, total).alias("overall_kept_pct"),
        F.lit(float(params.quality.threshold)).alias("quality_threshold"),
        F.lit(float(params.quality.scale_min)).alias("scale_min"),
        F.lit(float(params.quality.scale_max)).alias("scale_max"),
    )


def report_rows(metrics: DataFrame) -> DataFrame:
    """The report's table: configured languages in order, figures as text."""
    return (
        metrics.where(F.col("lang_pos").isNotNull())
        .select(
            "lang_pos",
            "language",
            F.col("translation_count").cast("string").alias("translations"),
            printed(F.col("mean_judge_score")).alias("mean_judge_score"),
            printed(F.col("mean_similarity")).alias("mean_similarity"),
            F.col("kept_count").cast("string").alias("kept"),
            F.col("filtered_count").cast("string").alias("filtered"),
            F.concat(printed(F.col("kept_pct")), F.lit("%")).alias("kept_share"),
        )
        .orderBy("lang_pos")
    )


@dataclass(frozen=True)
class Evaluation:
    details: DataFrame
    per_language: DataFrame
    overall: DataFrame

    @property
    def report(self) -> DataFrame:
        return report_rows(self.per_language)


def evaluate(
    params: Params,
    translator: Provider,
    judge: Judge,
    source: DataFrame | None = None,
    translated: DataFrame | None = None,
    distinct_texts: bool = False,
) -> Evaluation:
    """Evaluates raw records (``source``) or reviews that are translated already;
    ``distinct_texts`` sends a text that occurs often to the translator once."""
    if translated is None:
        if source is None:
            raise ValueError("evaluate needs source or translated reviews")
        reviews = valid(check(source, params.rules))
        translated = translate(reviews, params, translator, distinct_texts)
    scored = score_translations(translated, params, judge)
    if not (translator.is_native and judge.provider.is_native):
        scored = keep(scored)
    # The figures need no texts, so none are kept.
    judged = judged_round_trips(scored, translator).drop("back_title", "back_body")
    if not translator.is_native:
        judged = keep(judged)
    return Evaluation(details(judged), language_metrics(judged, params), overall(scored, params))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        F.bround(100.0 * part / F.nullif(whole, F.lit(0)), fixed.PERCENT_DECIMALS)
    )
