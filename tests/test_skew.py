"""Hot keys: a third of all rows under one key, with joins that may not broadcast."""

import contextlib

import pytest
from pyspark.sql import functions as F

from revlens.operators import evaluate, serving, translate
from revlens.operators.providers import Provider
from revlens.params import Params

PARAMS = Params(target_languages=("de",))
N = 30_000


@contextlib.contextmanager
def small_partitions(spark):
    """Sizes at which these rows look as large as real ones do by default."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def reviews(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(0, N, 1, 16).select(
        F.col("id").alias("seq"),
        F.when(hot, "rev-hot").otherwise(F.concat(F.lit("rev-"), "id")).alias("review_id"),
        F.when(hot, "prod-hot").otherwise(F.concat(F.lit("prod-"), F.col("id") % 700)).alias("product_id"),
        F.lit("Name").alias("product_name"),
        F.lit("fr").alias("source_language"),
        F.lit(3).alias("rating"),
        F.when(hot, "Super").otherwise(F.md5(F.col("id").cast("string"))).alias("title"),
        F.md5(F.concat(F.lit("b"), "id")).alias("body"),
    )


def test_shared_text_is_split(spark, reviews):
    with small_partitions(spark):
        done = translate.attempt(
            reviews, PARAMS, Provider.batch(lambda: lambda t, s, g: t[::-1]), distinct_texts=True
        )
        assert "skew=true" in final_plan(done)
        wrong = done.where(F.get("attempts", F.lit(0))["title"] != F.reverse("title"))
        assert done.count() == N and wrong.count() == 0


def test_requested_product_is_split(spark, reviews):
    with small_partitions(spark):
        headers = spark.range(800).select(
            F.concat(F.lit("prod-"), "id").alias("product_id"), F.lit("s").alias("summary")
        )
        requests = reviews.select("seq", "product_id", "body")
        found = serving.lookup(requests, headers)
        assert "skew=true" in final_plan(found)
        assert found.where("error = 'not_found'").count() == N // 3


def test_repeated_review_id_is_split(spark, reviews):
    with small_partitions(spark):
        judged = reviews.select(
            "seq", F.lit(0).alias("entry"), "review_id", "product_id", F.lit("de").alias("language"),
            F.lit(4.0).alias("judge_score"), F.lit(True).alias("kept"),
            ((F.col("seq") % 10000) / 10000).alias("similarity"),
        )
        rows = evaluate.details(judged)
        assert "skew=true" in final_plan(rows)
        assert rows.where("review_id = 'rev-hot'").select("similarity").distinct().count() == 1
        assert rows.count() == N


def test_hot_product_is_spread_over_pages(spark, reviews):
    """No row holds more than a page, no task more than a block of the product."""
    entries = reviews.select(
        (F.col("seq") * 1000).alias("seq"), F.lit(0).alias("lang_pos"), "product_id", "review_id",
        F.lit("de").alias("language"), "title", "body", "rating",
    )
    params = Params(target_languages=("de",), page_entries=100)
    pages = serving.product_pages(entries, params)
    sizes = pages.where("product_id = 'prod-hot'").select(F.size("reviews")).collect()
    assert [s[0] for s in sizes] == [100] * (N // 300)
    assert pages.agg(F.sum(F.size("reviews"))).first()[0] == N


def test_lookups_of_a_hot_product_by_hot_requests(spark, reviews):
    """Half of all requests ask for the product with a third of all reviews: requests are dealt
    over its pages, and every task gets a share."""
    entries = reviews.select(
        "seq", F.lit(0).alias("lang_pos"), "product_id", "review_id", F.lit("en").alias("language"), "title", "body", "rating"
    )
    params = Params(target_languages=("de",), page_entries=100)
    pages = serving.product_pages(entries, params).cache()
    headers = reviews.groupBy("product_id").agg(F.count("*").alias("reviews")).select(
        "product_id", "reviews", F.lit("Name").alias("product_name"), F.lit(1).alias("review_count"),
        F.lit("s").alias("summary"), F.lit(True).alias("has_summary"),
    )
    ids = F.when(F.col("id") % 2 == 0, "prod-hot").otherwise(F.concat(F.lit("prod-"), F.col("id") % 900))
    requests = spark.range(60).select("id", ids.alias("product_id"))
    with small_partitions(spark):
        found = serving.lookup_pages(requests, headers, pages).select("id", "product_id", "found", "review_id")
        plan = final_plan(found)
        per_task = [n for n in found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert "product_id" in plan and "page_no" in plan
    assert sum(per_task) >= 30 * 10_000 and max(per_task) < 0.3 * sum(per_task)
    asked = {r["id"]: r["product_id"] for r in requests.collect()}
    counts = {r["product_id"]: r["reviews"] for r in headers.collect()}
    got = {r["id"]: (r["found"], r["n"]) for r in found.groupBy("id", "found").agg(F.count("review_id").alias("n")).collect()}
    assert got == {i: (p in counts, counts.get(p, 0)) for i, p in asked.items()}
