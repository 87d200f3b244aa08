"""Synthetic reviews: exact language quotas, seeded draws, assembled phrases."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from revlens import fixed_values as fixed
from revlens.operators.positions import with_position
from revlens.sources.tables import keep, read_table, shared_folder

_RANGE = 1 << 32
#: Ranges of reviews that are made one after another at most, and how many reviews one has at least.
PARTS = 24
PART_ROWS = 1_000_000


def quotas(totals: DataFrame, weights: dict[str, float] = fixed.LANGUAGE_WEIGHTS) -> DataFrame:
    """Splits each plan's ``total`` over the weights by largest remainder.

    ``totals`` is ``(plan, total)``. Floors first, then one more for the largest
    fractions until the total is met; equal fractions go by declared order.
    """
    listed = F.array(
        *[
            F.struct(F.lit(i).alias("ord"), F.lit(name).alias("lang"), F.lit(w).alias("weight"))
            for i, (name, w) in enumerate(weights.items())
        ]
    )
    raw = F.col("total") * F.col("w.weight")
    plan = Window.partitionBy("plan")
    return (
        totals.select("plan", "total", F.explode(listed).alias("w"))
        .select("plan", "total", "w.ord", "w.lang", raw.alias("raw"), F.floor(raw).alias("base"))
        .withColumn("left", F.col("total") - F.sum("base").over(plan))
        .withColumn(
            "place",
            F.row_number().over(plan.orderBy((F.col("raw") - F.col("base")).desc(), "ord")),
        )
        .select(
            "plan",
            "ord",
            "lang",
            (F.col("base") + (F.col("place") <= F.col("left")).cast("long")).alias("quota"),
        )
    )


def with_draws(df: DataFrame, seed: int, key: str, salt: str, names: list[str]) -> DataFrame:
    """Adds up to four draws from 0 to 2**32 - 1 that depend on seed and key alone,
    so a row is the same in any partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.lit(salt)))
    # The digest is a column of its own, so it is computed once for all its draws.
    return (
        df.withColumn("_digest", digest)
        .select(
            *df.columns,
            *[
                F.conv(F.substring("_digest", 1 + 8 * i, 8), 16, 10).cast("long").alias(name)
                for i, name in enumerate(names)
            ],
        )
    )


def weighted(draw: Column, weights: dict[int, float]) -> Column:
    """The weighted choice a draw falls on."""
    names, reached, choice = list(weights), 0.0, None
    for name in names[:-1]:
        reached += weights[name]
        hit = draw / F.lit(float(_RANGE)) < F.lit(reached)
        choice = F.when(hit, F.lit(name)) if choice is None else choice.when(hit, F.lit(name))
    return choice.otherwise(F.lit(names[-1]))


def sentiment(rating: Column) -> Column:
    positive, neutral, negative = fixed.SENTIMENTS
    return (
        F.when(rating >= fixed.POSITIVE_FROM, F.lit(positive))
        .when(rating == fixed.NEUTRAL_AT, F.lit(neutral))
        .otherwise(F.lit(negative))
    )


def generate(products: DataFrame, phrases: DataFrame, total: int, seed: int) -> DataFrame:
    """``total`` reviews from a library's ``products`` and ``phrases``.

    Every choice is arithmetic on the row's own hash. Phrases are fetched by their number in
    one equi-join over all places of a review, so its texts are shuffled once.
    """
    return _maker(products, phrases, total, seed)(1, total)


def generate_table(
    products: DataFrame,
    phrases: DataFrame,
    total: int,
    seed: int,
    finish: Callable[[DataFrame], DataFrame],
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """What ``finish`` makes of the reviews of ``generate``, row by row, as a table.

    The texts of all reviews are many times the library. They are made one range of reviews
    after another and their shuffles are removed when a range is written, so the disk
    holds the texts of one range at a time. There are at most ``PARTS`` ranges, as each reads
    the whole library, so the work stays in proportion to library and reviews.
    """
    spark = products.sparkSession
    rows = max(part_rows, -(-total // PARTS))
    if total > rows:
        products, phrases = keep(products), keep(phrases)
    make = _maker(products, phrases, total, seed)
    path = f"{shared_folder(spark)}/revlens-{uuid4().hex}"
    schema = None
    with _shuffles_removed(spark):
        for first in range(1, max(total, 1) + 1, rows):
            made = finish(make(first, min(first + rows - 1, total)))
            made.write.mode("append").parquet(path)
            schema = made.schema
    return read_table(spark, path, schema)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """A query's shuffle files are removed when it ends, not when the driver forgets it."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _maker(products: DataFrame, phrases: DataFrame, total: int, seed: int) -> Callable[[int, int], DataFrame]:
    """Gives the reviews from one number to another, both included, of ``total`` ones."""
    spark = products.sparkSession
    plan = quotas(spark.createDataFrame([(0, total)], "plan int, total long"))
    language, reached = None, 0
    for row in plan.orderBy("ord").collect():  # one row per language
        reached += row["quota"]
        hit, name = F.col("seq") <= reached, F.lit(row["lang"])
        language = F.when(hit, name) if language is None else language.when(hit, name)

    # Numbered here, so a gap in ``idx`` cannot lose a review.
    placed = with_position(products.withColumn("_all", F.lit(0)), "_all", ["idx"])
    numbered = placed.select(
        (F.col("position") - 1).cast("int").alias("_product"), "product_id", "product_name"
    )
    pools = phrases.groupBy("lang", "sentiment").agg(
        F.count_if(F.col("kind") == "titles").alias("_titles"),
        F.count_if(F.col("kind") == "sentences").alias("_sentences"),
    )
    n_products = products.count()
    if total and not n_products:
        raise ValueError("the library has no products")
    # One row per language and sentiment.
    filled = {(r["lang"], r["sentiment"]) for r in pools.where("_titles > 0 and _sentences > 0").collect()}
    wanted = {(r["lang"], s) for r in plan.where("quota > 0").collect() for s in fixed.SENTIMENTS}
    if wanted - filled:
        raise ValueError(f"the library has no titles or sentences for {sorted(wanted - filled)}")

    sides = phrases.select(
        F.col("lang").alias("source_language"),
        F.col("sentiment").alias("_sentiment"),
        F.col("kind").alias("_kind"),
        F.col("idx").cast("long").alias("_place"),
        F.col("phrase").alias("_text"),
    )
    pools = pools.withColumnsRenamed({"lang": "source_language", "sentiment": "_sentiment"})

    def make(first: int, last: int) -> DataFrame:
        drawn = spark.range(first, last + 1).select(F.col("id").alias("seq"))
        drawn = with_draws(drawn, seed, "seq", "a", ["_d_product", "_d_rating", "_d_title", "_d_length"])
        drawn = with_draws(drawn, seed, "seq", "b", ["_d_1", "_d_2", "_d_3"])
        chosen = _places(
            drawn.withColumn("source_language", language)
            .withColumn("_product", (F.col("_d_product") % max(n_products, 1)).cast("int"))
            .withColumn("rating", weighted(F.col("_d_rating"), fixed.RATING_WEIGHTS))
            .withColumn("_sentiment", sentiment(F.col("rating")))
            .join(numbered, "_product")
            .join(pools, ["source_language", "_sentiment"])
        )
        return _assembled(chosen, sides)

    return make


def _places(rows: DataFrame) -> DataFrame:
    """Adds the places of title and sentences in their lists, null beyond the body's length."""
    size = F.col("_sentences")
    length = fixed.BODY_SENTENCES_MIN + F.col("_d_length") % F.least(F.lit(fixed.BODY_SENTENCES_MAX), size)
    # Three different places: each draw is over what is left and steps past the
    # places taken before it.
    second = F.col("_d_2") % F.greatest(size - 1, F.lit(1))
    third = F.col("_d_3") % F.greatest(size - 2, F.lit(1))
    low, high = F.least("_s1", "_s2"), F.greatest("_s1", "_s2")
    return (
        rows.withColumn("_title", F.col("_d_title") % F.col("_titles"))
        .withColumn("_length", length)
        .withColumn("_s1", F.col("_d_1") % size)
        .withColumn("_s2", second + (second >= F.col("_s1")).cast("long"))
        .withColumn("_s3", third + (third >= low).cast("long"))
        .withColumn("_s3", F.col("_s3") + (F.col("_s3") >= high).cast("long"))
        .withColumn("_s2", F.when(F.col("_length") >= 2, F.col("_s2")))
        .withColumn("_s3", F.when(F.col("_length") >= 3, F.col("_s3")))
    )


def _assembled(chosen: DataFrame, sides: DataFrame) -> DataFrame:
    """The reviews with their texts: one row per place meets its phrase, then a review's rows
    meet each other. What else a review has travels with its title."""
    carried = ["product_id", "product_name", "source_language", "rating"]
    places = F.array(
        *[
            F.struct(F.lit(slot).alias("slot"), F.lit(kind).alias("_kind"), F.col(place).alias("_place"))
            for slot, (place, kind) in enumerate(
                [("_title", "titles"), ("_s1", "sentences"), ("_s2", "sentences"), ("_s3", "sentences")]
            )
        ]
    )
    asked = chosen.select(
        "seq", "_sentiment", *carried, F.explode(F.filter(places, lambda p: p["_place"].isNotNull())).alias("_p")
    ).select(
        "seq", "_sentiment", "source_language", "_p.*",
        F.when(F.col("_p.slot") == 0, F.struct(*carried)).alias("_head"),
    )
    found = asked.join(sides, ["source_language", "_sentiment", "_kind", "_place"], "left")

    def named(text: Column) -> Column:
        return F.replace(text, F.lit(fixed.PRODUCT_PLACEHOLDER), F.col("product_name"))

    rows = found.groupBy("seq").agg(
        F.max("_head").alias("_head"),
        *[F.max(F.when(F.col("slot") == slot, F.col("_text"))).alias(f"_text_{slot}") for slot in range(4)],
    ).select("seq", "_head.*", *[f"_text_{slot}" for slot in range(4)])
    return rows.select(
        "seq",
        F.format_string("rev-%04d", "seq").alias("review_id"),
        *carried,
        F.substring(named(F.col("_text_0")), 1, fixed.TITLE_MAX).alias("title"),
        F.substring(named(F.concat_ws(" ", "_text_1", "_text_2", "_text_3")), 1, fixed.BODY_MAX).alias("body"),
    )
