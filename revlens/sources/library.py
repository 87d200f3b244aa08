"""Content libraries: the products and phrases synthetic reviews are made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens import fixed_values as fixed
from revlens.sources.records import accept_repeated_keys

_PHRASES = "map<string,map<string,map<string,array<variant>>>>"


def _string(value: Column) -> Column:
    """A variant's text, null for any other kind: a cast would accept 5 and true."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _each_value(nested: Column, change: Callable[[Column], Column]) -> Column:
    return F.transform_values(nested, lambda _, value: change(value))


def parse_libraries(texts: DataFrame) -> DataFrame:
    """``(library_id, text)`` to one parsed row per library."""
    accept_repeated_keys(texts.sparkSession)
    doc = texts.select("library_id", F.try_parse_json("text").alias("_doc"))
    products = F.try_variant_get("_doc", "$.products", "array<map<string,variant>>")
    phrases = F.try_variant_get("_doc", "$.phrases", _PHRASES)
    lists = lambda kind: _each_value(kind, lambda texts: F.transform(texts, _string))
    return doc.select(
        "library_id",
        F.map_keys(F.try_variant_get("_doc", "$", "map<string,variant>")).alias("keys"),
        _string(F.try_variant_get("_doc", "$.schema_version", "variant")).alias("schema_version"),
        F.transform(products, lambda product: _each_value(product, _string)).alias("products"),
        _each_value(phrases, lambda bank: _each_value(bank, lists)).alias("phrases"),
    )


def flatten_products(libraries: DataFrame) -> DataFrame:
    return libraries.select(
        "library_id", F.posexplode("products").alias("idx", "p")
    ).select(
        "library_id",
        "idx",
        F.try_element_at("p", F.lit("product_id")).alias("product_id"),
        F.try_element_at("p", F.lit("product_name")).alias("product_name"),
    )


def flatten_phrases(libraries: DataFrame) -> DataFrame:
    """One row per phrase, numbered inside its list."""
    return (
        libraries.select("library_id", F.explode("phrases").alias("lang", "bank"))
        .select("library_id", "lang", F.explode("bank").alias("kind", "lists"))
        .select("library_id", "lang", "kind", F.explode("lists").alias("sentiment", "list"))
        .select("library_id", "lang", "kind", "sentiment", F.posexplode("list").alias("idx", "phrase"))
    )


def phrase_gaps(libraries: DataFrame) -> DataFrame:
    """Phrase lists that are missing or too short, straight from each library row."""
    wanted = F.array(
        *[
            F.struct(
                F.lit(lang).alias("lang"),
                F.lit(kind).alias("kind"),
                F.lit(sentiment).alias("sentiment"),
            )
            for lang in fixed.LANGUAGES
            for kind in fixed.PHRASE_KINDS
            for sentiment in fixed.SENTIMENTS
        ]
    )
    found = F.try_element_at(
        F.try_element_at(F.try_element_at("phrases", F.col("w.lang")), F.col("w.kind")),
        F.col("w.sentiment"),
    )
    return (
        libraries.select("library_id", "phrases", F.explode(wanted).alias("w"))
        .select("library_id", "w.*", F.coalesce(F.size(found), F.lit(0)).alias("found"))
        .withColumn("found", F.greatest("found", F.lit(0)))
        .where(F.col("found") < fixed.PHRASES_MIN)
    )


def library_problems(libraries: DataFrame) -> DataFrame:
    """``(library_id, place, message)``: everything that makes a library unusable."""

    def problem(failed: Column, place: str, message: str) -> Column:
        return F.when(
            F.coalesce(failed, F.lit(True)),
            F.struct(F.lit(place).alias("place"), F.lit(message).alias("message")),
        )

    def unlisted(keys: Column, allowed: tuple[str, ...]) -> Column:
        return F.size(F.array_except(keys, F.array(*map(F.lit, allowed)))) > 0

    banks = F.map_values("phrases")
    lists = F.flatten(F.transform(banks, F.map_values))
    product_ok = lambda p: (
        F.try_element_at(p, F.lit("product_id")).rlike(fixed.PRODUCT_ID_PATTERN)
        & (F.length(F.try_element_at(p, F.lit("product_name"))) > 0)
        & (F.size(p) == 2)
    )
    size = F.size("products")
    rules = F.array(
        problem(F.col("keys").isNull(), "<root>", "is not a JSON object"),
        problem(
            unlisted(F.col("keys"), ("schema_version", "products", "phrases")),
            "<root>",
            "unknown fields are not allowed",
        ),
        problem(
            F.col("schema_version") != fixed.SCHEMA_VERSION,
            "schema_version",
            f"is not {fixed.SCHEMA_VERSION}",
        ),
        problem(
            ~size.between(fixed.PRODUCTS_MIN, fixed.PRODUCTS_MAX),
            "products",
            f"needs {fixed.PRODUCTS_MIN} to {fixed.PRODUCTS_MAX} products",
        ),
        problem(
            ~F.forall("products", lambda p: F.coalesce(product_ok(p), F.lit(False))),
            "products",
            "a product is not a valid id and name",
        ),
        problem(unlisted(F.map_keys("phrases"), fixed.LANGUAGES), "phrases", "unknown language"),
        problem(
            F.exists(banks, lambda b: unlisted(F.map_keys(b), fixed.PHRASE_KINDS)),
            "phrases",
            "unknown kind of phrase",
        ),
        problem(
            F.exists(lists, lambda x: unlisted(F.map_keys(x), fixed.SENTIMENTS)),
            "phrases",
            "unknown sentiment",
        ),
        problem(
            F.exists(
                F.flatten(F.transform(lists, F.map_values)),
                lambda phrases: F.exists(phrases, lambda p: F.coalesce(F.length(p) < 1, F.lit(True))),
            ),
            "phrases",
            "empty phrase",
        ),
    )
    general = libraries.select(
        "library_id", F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("r")
    ).select("library_id", "r.*")
    gaps = phrase_gaps(libraries).select(
        "library_id",
        F.concat_ws("/", F.lit("phrases"), "lang", "kind", "sentiment").alias("place"),
        F.lit(f"needs at least {fixed.PHRASES_MIN} phrases").alias("message"),
    )
    return general.unionByName(gaps)


def read_library(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Products and phrases of one library file, checked; raises with every problem."""
    texts = spark.read.text(path, wholetext=True).select(
        F.lit(0).alias("library_id"), F.col("value").alias("text")
    )
    files = texts.count()
    if files > 1:
        raise ValueError(f"content library {path} is {files} files, not one")
    parsed = parse_libraries(texts)
    problems = library_problems(parsed).collect()  # a library has some fifty rules at most
    if problems or parsed.isEmpty():
        listed = "\n".join(f"  - at {p['place']}: {p['message']}" for p in problems)
        raise ValueError(f"content library {path} has {len(problems)} problems:\n{listed}")
    return flatten_products(parsed).drop("library_id"), flatten_phrases(parsed).drop("library_id")
