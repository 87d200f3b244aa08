"""Serving tables: what a product page shows, laid out for lookup by product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens import fixed_values as fixed
from revlens.operators.positions import with_position
from revlens.params import Params

_ENTRY = "struct<lang_pos:int,language:string,title:string,body:string>"


def _is_original(params: Params) -> Column:
    return (F.col("source_language") == params.passthrough_language) & (
        F.coalesce(F.size("translations"), F.lit(0)) <= 0
    )


def _original() -> Column:
    return F.array(
        F.struct(F.lit(0), F.col("source_language"), F.col("title"), F.col("body"))
    ).cast(f"array<{_ENTRY}>")


def _kept() -> Column:
    numbered = F.transform(
        F.map_entries("translations"),
        lambda e, i: F.struct(i.alias("i"), e["key"].alias("lang"), e["value"].alias("text")),
    )
    # A translation without a verdict is not served.
    kept = F.filter(
        numbered,
        lambda e: F.coalesce(F.try_element_at("quality", e["lang"])["kept"], F.lit(False)),
    )
    return F.transform(
        kept, lambda e: F.struct(e["i"], e["lang"], e["text"]["title"], e["text"]["body"])
    ).cast(f"array<{_ENTRY}>")


def _explode(rows: DataFrame, entries: Column) -> DataFrame:
    empty = F.lit("")
    return rows.select(
        "seq", "review_id", "product_id", "rating", F.explode(entries).alias("e")
    ).select(
        "seq",
        "product_id",
        "review_id",
        "e.lang_pos",
        "e.language",
        F.coalesce("e.title", empty).alias("title"),
        F.coalesce("e.body", empty).alias("body"),
        "rating",
    )


def original_entries(scored: DataFrame, params: Params) -> DataFrame:
    """Passthrough reviews, once each, in their own words."""
    return _explode(scored.where(_is_original(params)), _original())


def kept_entries(scored: DataFrame, params: Params) -> DataFrame:
    """Other reviews, once per kept translation."""
    return _explode(scored.where(~F.coalesce(_is_original(params), F.lit(False))), _kept())


def served_entries(scored: DataFrame, params: Params) -> DataFrame:
    """Both kinds in one pass over the reviews."""
    entries = F.when(F.coalesce(_is_original(params), F.lit(False)), _original()).otherwise(_kept())
    return _explode(scored, entries)


def latest_summaries(summaries: DataFrame, order: str = "seq") -> DataFrame:
    """One summary per product, the last one given."""
    last = F.max_by(F.struct("product_name", "review_count", "summary"), order)
    return summaries.groupBy("product_id").agg(last.alias("s")).select("product_id", "s.*")


def product_headers(scored: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every product with a review or a summary. Both sides hold one row per
    product before they meet."""
    reviewed = scored.groupBy("product_id").agg(F.count("*").alias("reviews"))
    return reviewed.join(
        summaries.select(
            "product_id", "product_name", "review_count", "summary", F.lit(True).alias("has_summary")
        ),
        "product_id",
        "full",
    ).select(
        "product_id",
        F.coalesce("reviews", F.lit(0)).alias("reviews"),
        "product_name",
        "review_count",
        F.coalesce("summary", F.lit("")).alias("summary"),
        F.coalesce("has_summary", F.lit(False)).alias("has_summary"),
    )


def numbered_entries(entries: DataFrame) -> DataFrame:
    """Entries with their place on the product's page."""
    return with_position(entries, "product_id", ["seq", "lang_pos"]).drop("group_rows")


def product_pages(entries: DataFrame, params: Params) -> DataFrame:
    """Entries in order, ``page_entries`` to a row, so a product of any size is
    many bounded rows. The header table holds its summary.

    Entries are shuffled straight into the ranges the pages are stored in; the
    grouping needs no shuffle of its own on top.
    """
    keys = ("product_id", "page_no")
    listed = F.array_sort(
        F.collect_list(F.struct("position", "review_id", "language", "title", "body", "rating"))
    )
    return (
        numbered_entries(entries)
        .withColumn("page_no", F.expr(f"(position - 1) div {params.page_entries}"))
        .repartitionByRange(*keys)
        .groupBy(*keys)
        .agg(listed.alias("reviews"))
        .sortWithinPartitions(*keys)
    )


def laid_out(headers: DataFrame) -> DataFrame:
    """Headers in sorted ranges of the product id, as the pages are: a reader's file
    statistics skip all files but those that can hold its product."""
    return headers.repartitionByRange("product_id").sortWithinPartitions("product_id")


#: Writer options of the serving tables: every row group has a Bloom filter of its products, as
#: large as they need, so that an id within its range that it doesn't hold costs no read.
LOOKUP_OPTIONS = {
    "parquet.bloom.filter.enabled#product_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def lookup(requests: DataFrame, headers: DataFrame) -> DataFrame:
    """Page headers for requested ids; unknown ids come back as not found. Headers
    are one row per product; a product many requests name is a big partition on
    the request side only, which the adaptive skew join splits."""
    found = F.coalesce(F.col("_known"), F.lit(False))
    return (
        requests.join(headers.withColumn("_known", F.lit(True)), "product_id", "left")
        .withColumn("found", found)
        .withColumn("error", F.when(~F.col("found"), F.lit(fixed.NOT_FOUND)))
        .drop("_known")
    )


def lookup_pages(requests: DataFrame, headers: DataFrame, pages: DataFrame) -> DataFrame:
    """Requested ids to their headers and entries, one row per entry of a requested
    page; a request without entries is one row whose entry is null.

    A request first learns how many pages its product has, from one row per product, and is
    then dealt over them, so that it meets each page by product and number. A product
    of very many pages is thereby many keys, and a page that very many requests name is
    one row that the adaptive skew join repeats: neither side is a hot key, and both may be.
    """
    counts = pages.groupBy("product_id").agg((F.max("page_no") + 1).alias("_pages"))
    known = headers.select("product_id", "product_name", "review_count", "summary").join(
        counts, "product_id", "left"
    )
    asked = lookup(requests, known)
    columns = [c for c in asked.columns if c != "_pages"]
    numbers = F.when(F.col("_pages") > 0, F.sequence(F.lit(0).cast("long"), F.col("_pages") - 1))
    dealt = asked.select(*columns, F.explode_outer(numbers).alias("page_no"))
    listed = pages.select("product_id", "page_no", "reviews")
    met = dealt.join(listed, ["product_id", "page_no"], "left")
    return met.select(*columns, F.explode_outer("reviews").alias("e")).select(*columns, "e.*")


def lookup_summaries(requests: DataFrame, headers: DataFrame) -> DataFrame:
    """Summaries for requested ids; a product without one is not found here."""
    return lookup(
        requests,
        headers.where("has_summary").select("product_id", "product_name", "review_count", "summary"),
    )
