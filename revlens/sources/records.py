"""Review records in volume: typed tables, JSON columns, JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.schema import REVIEW_FIELDS


def typed_records(df: DataFrame, order: str) -> DataFrame:
    """Records held in typed columns; ``order`` names a unique integer column that
    gives their order. Files hold no order that survives a distributed read, so it
    is never made up here."""
    return df.select(F.col(order).cast("long").alias("seq"), *REVIEW_FIELDS)


def json_records(df: DataFrame, record: str, order: str) -> DataFrame:
    """Records held as JSON text, one per row; text that is no JSON is a reject."""
    accept_repeated_keys(df.sparkSession)
    return df.select(
        F.col(order).cast("long").alias("seq"),
        F.coalesce(F.try_parse_json(record), F.parse_json(F.lit("null"))).alias("record"),
    )


def read_json_lines(spark: SparkSession, path: str, order: str | None = None) -> DataFrame:
    """Lines of JSON, splittable, for any volume.

    ``order`` names the field of a plain review that holds its unique number; the rest
    of the line is the record. Without it lines are ``{"seq": n, "record": {...}}``. A
    line that is no object is a record that breaks the rules, with a null ``seq``.
    """
    accept_repeated_keys(spark)
    lines = spark.read.text(path).select(F.try_parse_json("value").alias("line"))
    if order is not None:
        fields = F.try_variant_get("line", "$", "map<string,variant>")
        number = F.try_element_at(fields, F.lit(order))
        record = F.to_variant_object(F.map_filter(fields, lambda name, _: name != order))
        return lines.select(
            F.try_variant_get(number, "$", "bigint").alias("seq"),
            F.coalesce(record, "line", F.parse_json(F.lit("null"))).alias("record"),
        )
    return lines.select(
        F.variant_get("line", "$.seq", "bigint").alias("seq"),
        F.variant_get("line", "$.record", "variant").alias("record"),
    )


def write_json_lines(reviews: DataFrame, path: str) -> None:
    """The counterpart of ``read_json_lines``; fields keep their fixed order."""
    reviews.select(
        F.to_json(F.struct("seq", F.struct(*REVIEW_FIELDS).alias("record"))).alias("value")
    ).write.mode("overwrite").text(path)


def accept_repeated_keys(spark: SparkSession) -> None:
    """A key that occurs twice in an object is legal JSON; the last one counts."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
