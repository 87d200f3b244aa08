"""Reviews, providers and libraries made from the driver tables.

The driver's ``documents`` become reviews of the products that ``part`` names, a third
of them of one product. The providers are stand-ins whose answers and failures follow from the
text they are given, so the same rule holds in plain Python and as a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens import fixed_values as fixed
from revlens.operators.positions import with_position
from revlens.operators.providers import Calls, Judge, Provider
from revlens.params import Params, ReviewRules

#: Document ids outgrow four digits at the larger scale factors.
RULES = ReviewRules(review_id_pattern="^rev-[0-9]{4,}$", product_id_pattern="^prod-[0-9]{3,}$")
PARAMS = Params(target_languages=("fr", "de"), rules=RULES, engine="echo")
HOT_PART = 101
ENVELOPE_DOCS = 16
LIBRARY_DOCS = 144
#: Reviews of a large dataset file, what one task writes.
FILE_RECORDS = 1 << 15


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


def part_count(spark: SparkSession, sf_dir: str) -> int:
    """How many parts there are; their keys run from 0."""
    return parts(spark, sf_dir).count()


def product_id(key: Column) -> Column:
    digits = key.cast("string")
    return F.concat(F.lit("prod-"), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a review. A third of them are of one product, the others are
    dealt over all parts."""
    named = parts(spark, sf_dir)
    key = F.when(F.col("doc_id") % 3 == 0, F.lit(HOT_PART)).otherwise(
        F.col("doc_id") % part_count(spark, sf_dir)
    )
    digits = F.col("doc_id").cast("string")
    return documents(spark, sf_dir).join(named, named["p_partkey"] == key, "left").select(
        F.col("doc_id").alias("seq"),
        F.concat(
            F.lit("rev-"), F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))
        ).alias("review_id"),
        product_id(key).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("lang").alias("source_language"),
        (1 + (F.col("doc_id") * 7 + F.col("n_chars")) % 7).cast("int").alias("rating"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
    )


def repeated_ids(df: DataFrame) -> DataFrame:
    """The same reviews where three in a row share a review id."""
    return df.withColumn(
        "review_id", F.concat(F.lit("rev-"), F.floor(F.col("seq") / 3).cast("string"))
    )


# Translator: tags the text; fails where length and target language say so.
def _fails(text: Column, target: Column) -> Column:
    return (F.length(text) + F.ascii(target)) % 11 == 0


def translator() -> Provider:
    return Provider.native(
        lambda text, source, target: F.when(
            ~_fails(text, target), F.concat(F.lit("["), target, F.lit("] "), text)
        )
    )


def flaky_translator() -> Provider:
    """As ``batch_translator``, but every call that can be answered fails twice before; three
    attempts without waits, four calls of a task at a time."""

    def make():
        from collections import Counter

        tried = Counter()

        def translate(text, source, target):
            call = (text, source, target)
            tried[call] += 1
            if (len(text) + ord(target[0])) % 11 == 0 or tried[call] < 3:
                raise ConnectionError(target)
            del tried[call]
            return f"[{target}] {text}"

        return translate

    return Provider.batch(make, Calls(attempts=3, wait=0.0, in_flight=4))


def batch_translator(version: str | None = None) -> Provider:
    def make():
        def translate(text, source, target):
            if (len(text) + ord(target[0])) % 11 == 0:
                raise ConnectionError(target)
            return f"[{target}] {text}"

        return translate

    return Provider.batch(make, version=version)


# Back-translator: takes the tag off texts of even length, leaves it on others.
def back_translator() -> Provider:
    return Provider.native(
        lambda text, source, target: F.when(
            F.length(text) % 13 != 0,
            F.when(F.length(text) % 2 == 0, F.substr(text, F.lit(6))).otherwise(text),
        )
    )


def batch_back_translator() -> Provider:
    def make():
        def back(text, source, target):
            if len(text) % 13 == 0:
                raise TimeoutError(source)
            return text[5:] if len(text) % 2 == 0 else text

        return back

    return Provider.batch(make)


# Numeric judge: half points from 1 to 5 by the length of the translation.
def judge() -> Judge:
    def score(source_text, translated_text, *_):
        n = F.length(translated_text)
        return F.when(n % 17 != 0, 1.0 + (n % 9) * 0.5)

    return Judge(Provider.native(score))


REPLIES = ["4", "4.5/5", "Score: 3.0", "cannot judge", "9", "-2"]


def reply(text: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, REPLIES)), F.length(text) % len(REPLIES) + 1)


def batch_judge() -> Judge:
    """A judge that answers in words, by the length of its prompt."""
    replies = list(REPLIES)

    def make():
        def answer(prompt, model_id, max_tokens, temperature):
            if len(prompt) % 17 == 0:
                raise RuntimeError("judge")
            return replies[len(prompt) % len(replies)]

        return answer

    return Judge(Provider.batch(make), replies=True)


def summarizer() -> Provider:
    return Provider.native(
        lambda prompt, *_: F.when(F.length(prompt) % 7 != 0, F.md5(prompt))
    )


def batch_summarizer() -> Provider:
    def make():
        import hashlib

        def summarize(prompt, model_id, max_tokens, temperature):
            if len(prompt) % 7 == 0:
                raise RuntimeError("summary")
            return hashlib.md5(prompt.encode()).hexdigest()

        return summarize

    return Provider.batch(make)


def write_documents(documents: DataFrame, path: str) -> None:
    """Dataset documents as files, one each; their names sort as their numbers do."""
    (
        documents.select(F.format_string("%012d", "file_no").alias("file_no"), "text")
        .repartition("file_no")
        .write.partitionBy("file_no")
        .text(path)
    )


def envelopes(df: DataFrame, bare: bool) -> DataFrame:
    """Dataset documents of up to 16 reviews each, as ``(file_no, file, text)``."""
    record = F.struct(
        "review_id", "product_id", "product_name", "source_language", "rating", "title", "body"
    )
    ordered = F.array_sort(F.collect_list(F.struct("seq", record.alias("r"))))
    rows = F.transform("rows", lambda x: x["r"])
    document = rows if bare else F.struct(
        F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
        F.lit("2026-01-01T00:00:00Z").alias("generated_at"),
        rows.alias("reviews"),
    )
    return (
        df.groupBy(F.floor(F.col("seq") / ENVELOPE_DOCS).alias("file_no"))
        .agg(ordered.alias("rows"))
        .select(
            "file_no", F.col("file_no").cast("string").alias("file"), F.to_json(document).alias("text")
        )
    )


def write_dataset(df: DataFrame, path: str) -> None:
    """All reviews in dataset files of ``FILE_RECORDS`` each, in order: a line per record, which the
    one task that writes a file holds one at a time."""
    record = F.to_json(
        F.struct(
            "review_id", "product_id", "product_name", "source_language", "rating", "title", "body"
        )
    )
    opening = f'{{"schema_version":"{fixed.SCHEMA_VERSION}","generated_at":"2026-01-01T00:00:00Z","reviews":['
    count = df.count()
    place = F.col("position") - 1
    last = (F.col("position") % FILE_RECORDS == 0) | (F.col("position") == count)
    lines = with_position(df.withColumn("_all", F.lit(0)), "_all", ["seq"]).select(
        F.format_string("%012d", F.floor(place / FILE_RECORDS)).alias("file_no"),
        "position",
        F.concat(
            F.when(place % FILE_RECORDS == 0, opening).otherwise(""),
            record,
            F.when(last, "]}").otherwise(","),
        ).alias("value"),
    )
    # More partitions than files, so that hardly a task gets several.
    (
        lines.repartition(4 * (1 + count // FILE_RECORDS), "file_no")
        .sortWithinPartitions("file_no", "position")
        .select("file_no", "value")
        .write.partitionBy("file_no")
        .text(path)
    )


def odd_records(df: DataFrame) -> DataFrame:
    """Reviews as JSON text, with a wrong kind of value by the id of the review."""
    fields = {
        name: F.to_json(F.struct(F.col(name).alias("x"))).substr(F.lit(6), F.lit(1 << 30))
        for name in ("review_id", "product_id", "product_name", "source_language", "title", "body")
    }
    # `{"x":value}` cut after the colon leaves `value}`; the brace is cut here.
    fields = {n: F.substr(c, F.lit(1), F.length(c) - 1) for n, c in fields.items()}
    kind = F.col("seq") % 8
    number = F.col("rating").cast("string")
    rating = (
        F.when(kind == 1, F.concat(F.lit('"'), number, F.lit('"')))
        .when(kind == 2, F.lit("true"))
        .when(kind == 3, F.concat(number, F.lit(".5")))
        .when(kind == 4, F.concat(number, F.lit(".0")))
        .otherwise(number)
    )
    language = F.when(kind == 5, F.lit("5")).otherwise(fields["source_language"])
    members = [
        F.concat(F.lit(f'"{name}":'), value)
        for name, value in {**fields, "source_language": language}.items()
    ]
    members.append(F.when(kind != 6, F.concat(F.lit('"rating":'), rating)))
    members.append(F.when(kind == 6, F.lit('"surplus":1')))
    text = F.when(kind == 7, F.lit('"not an object"')).otherwise(
        F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    )
    return df.select("seq", text.alias("text"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases from all lines of the documents, dealt out over the phrase lists of one
    library per 144 documents."""
    def pick(names, place):
        return F.element_at(F.array(*map(F.lit, names)), (place + 1).cast("int"))

    doc, size = F.col("doc_id"), F.col("n_chars")
    lines = F.posexplode(F.split("text", "\n")).alias("line", "words")
    return documents(spark, sf_dir).select("doc_id", "n_chars", lines).select(
        F.floor(doc / LIBRARY_DOCS).alias("library_id"),
        pick(fixed.LANGUAGES, size % 6).alias("lang"),
        pick(fixed.PHRASE_KINDS, doc % 2).alias("kind"),
        pick(fixed.SENTIMENTS, F.floor(doc / 2) % 3).alias("sentiment"),
        "doc_id",
        "line",
        F.concat("words", F.lit(" " + fixed.PRODUCT_PLACEHOLDER)).alias("phrase"),
    )


def libraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same phrases as library documents, ``(library_id, text)``."""
    def nest(df, keys, name, value):
        return df.groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct(name, value))).alias("nested")
        )

    lists = (
        phrases(spark, sf_dir)
        .groupBy("library_id", "lang", "kind", "sentiment")
        .agg(F.array_sort(F.collect_list(F.struct("doc_id", "line", "phrase"))).alias("list"))
        .withColumn("list", F.transform("list", lambda x: x["phrase"]))
    )
    kinds = nest(lists, ["library_id", "lang", "kind"], "sentiment", "list")
    banks = nest(kinds, ["library_id", "lang"], "kind", "nested")
    whole = nest(banks, ["library_id"], "lang", "nested")
    return whole.select(
        "library_id",
        F.to_json(
            F.struct(
                F.lit(fixed.SCHEMA_VERSION).alias("schema_version"), F.col("nested").alias("phrases")
            )
        ).alias("text"),
    )


def library_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All parts as products, and the phrases of all documents as one library."""
    products = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("int").alias("idx"),
        F.concat(F.lit("prod-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
    )
    listed = phrases(spark, sf_dir).select(
        "*", F.concat_ws("/", "lang", "kind", "sentiment").alias("list")
    )
    numbered = with_position(listed, "list", ["doc_id", "line"])
    return products, numbered.withColumn("idx", F.col("position") - 1)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page requests: one per line item; every other one asks for an id a quarter of the parts
    further on, so some are beyond those of the parts, and the hot product is asked for."""
    beyond = part_count(spark, sf_dir) // 4
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    moved = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 2 == 0, 0).otherwise(beyond)
    return items.select(
        F.col("l_orderkey").alias("request_id"),
        F.col("l_linenumber").cast("int").alias("request_line"),
        product_id(F.col("l_partkey") + moved).alias("product_id"),
    )
