"""Dataset files: one JSON document with a ``reviews`` array, or a bare array.

A file up to ``WHOLE_BYTES`` is one row and parsed at once, many side by side; a larger one is
read by many tasks (``sources.splits``). JSON Lines and Parquet remain the plainer sources for
volume.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens import fixed_values as fixed
from revlens.functions.arrays import items
from revlens.operators.ingest import check_typed
from revlens.operators.positions import with_position, with_rank
from revlens.params import ReviewRules
from revlens.schema import REVIEW_FIELDS
from revlens.sources import splits
from revlens.sources.records import accept_repeated_keys
from revlens.sources.tables import keep

#: Room for positions inside one file in ``seq``; file number goes above it.
_FILE_SHIFT = 32
_SHOWN = 100
_NO_JSON = splits.NOT_JSON

#: Larger files are read in byte ranges.
WHOLE_BYTES = 64 << 20


def read_envelopes(
    spark: SparkSession,
    path: str,
    check: bool = True,
    bare_arrays: bool = True,
    whole_bytes: int = WHOLE_BYTES,
) -> DataFrame:
    """Records ``(seq, record)`` of the dataset files at ``path``, in file order;
    ``bare_arrays`` accepts files that are an array of records and nothing else. Files of
    more than ``whole_bytes`` are read by many tasks.

    With ``check`` a file that cannot be used raises ``ValueError`` here, at the
    price of parsing the files twice; without it the job itself fails on it, and
    an empty file counts as one without records. A large file whose array cannot be found
    raises here in both cases.
    """
    if not isinstance(path, str):
        raise ValueError(f"source must be a path or a DataFrame, not {type(path).__name__}")
    accept_repeated_keys(spark)
    try:
        lines = spark.read.option("lineSep", "}").text(path)
        # The listing alone, no content is read. Spark leaves empty files out of it.
        listed = spark.read.format("binaryFile").load(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
        )
    except AnalysisException as failure:
        raise ValueError(f"dataset not found or not readable: {path}") from failure
    files = keep(with_rank(listed, "file", name="file_no"))
    counts = files.agg(F.count("*"), F.count_if(F.col("size") > whole_bytes)).first()
    found = []
    problems = spark.createDataFrame([], "file string, problem string")
    if check and len(named := lines.inputFiles()) > counts[0]:
        problems = _empty(named, files)
    if counts[0] > counts[1] or not counts[0]:
        texts = spark.read.text(path, wholetext=True).where(
            F.col("_metadata.file_size") <= whole_bytes
        ).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
        found.append(envelope_records(texts.join(files, "file"), bare_arrays))
        problems = problems.unionByName(envelope_problems(texts, bare_arrays).where("problem <> ''"))
    if counts[1]:
        elements, broken = _split(lines, whole_bytes, bare_arrays)
        _raise_for(broken)
        found.append(_split_records(elements.join(files, "file")))
        unusable = _value(F.col("text")).isNull()
        problems = problems.unionByName(
            elements.where(unusable).select("file", F.lit(_NO_JSON).alias("problem")).distinct()
        )
    if check:
        _raise_for(problems)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def file_number(seq: str) -> Column:
    """Which file a record is of, from 0 by name."""
    return F.shiftright(seq, _FILE_SHIFT)


def place_in_file(seq: str) -> Column:
    return F.col(seq).bitwiseAND(F.lit((1 << _FILE_SHIFT) - 1))


def _raise_for(problems: DataFrame) -> None:
    shown = problems.orderBy("file").limit(_SHOWN).collect()
    if shown:
        said = "; ".join(f"{row['file']} {row['problem']}" for row in shown)
        more = "" if len(shown) < _SHOWN else f"; {problems.count()} bad files in all"
        raise ValueError(said + more)


def _empty(named: list[str], files: DataFrame) -> DataFrame:
    """The named files that were not listed, as problems; names of a store without hosts are
    spelled in two ways."""
    names = files.sparkSession.createDataFrame([(n.replace(":///", ":/", 1),) for n in named], "file string")
    return names.join(files, "file", "left_anti").select("file", F.lit(_NO_JSON).alias("problem"))


def _split(lines: DataFrame, whole_bytes: int, bare_arrays: bool) -> tuple[DataFrame, DataFrame]:
    """``(file, pos, text)`` of the large files' elements, and ``(file, problem)`` of those
    whose array cannot be found."""
    pieces = lines.where(F.col("_metadata.file_size") > whole_bytes).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.col("value").cast("binary").alias("piece"),
    )
    elements, skeletons = splits.split_records(pieces)
    outside = _parsed(skeletons.select("file", F.col("problem").alias("_broken"), F.col("skeleton").alias("text")))
    problem = F.coalesce("_broken", _problem(bare_arrays))
    return elements, outside.select("file", problem.alias("problem")).where("problem IS NOT NULL")


def _value(text: Column) -> Column:
    """The one JSON value that a text is, null if it is none or more follows: the parser
    alone stops after the first value, so the text is read as the only entry of an array."""
    wrapped = F.concat(F.lit("["), F.when(F.is_valid_utf8(text), text), F.lit("]"))
    listed = F.try_parse_json(wrapped)
    more = F.try_variant_get(listed, "$[1]", "variant")
    return F.when(more.isNull(), F.try_variant_get(listed, "$[0]", "variant"))


def _split_records(elements: DataFrame) -> DataFrame:
    """``(seq, record)`` from ``(file_no, file, pos, text)``; text that is no JSON fails the job."""
    bad = F.raise_error(F.concat_ws(" ", "file", F.lit(_NO_JSON)))
    return elements.withColumn("record", _value(F.col("text"))).select(
        (F.shiftleft(F.col("file_no").cast("long"), _FILE_SHIFT) + F.col("pos")).alias("seq"),
        F.coalesce("record", F.parse_json(bad.cast("string"))).alias("record"),
    )


def envelope_problems(texts: DataFrame, bare_arrays: bool = True) -> DataFrame:
    """``(file, problem)`` per document; the problem is empty if it has its array."""
    return _parsed(texts).select("file", F.coalesce(_problem(bare_arrays), F.lit("")).alias("problem"))


def envelope_records(documents: DataFrame, bare_arrays: bool = True) -> DataFrame:
    """``(seq, record)`` from ``(file_no, file, text)``; a bad document fails the job."""
    problem = _problem(bare_arrays)
    records = F.when(
        problem.isNotNull(), F.raise_error(F.concat_ws(" ", "file", problem))
    ).otherwise(_records(bare_arrays))
    return (
        _parsed(documents)
        .select("file_no", F.posexplode(records).alias("pos", "record"))
        .select(
            (F.shiftleft(F.col("file_no").cast("long"), _FILE_SHIFT) + F.col("pos")).alias("seq"),
            "record",
        )
    )


def _parsed(documents: DataFrame) -> DataFrame:
    accept_repeated_keys(documents.sparkSession)
    return documents.withColumn("_doc", _value(F.col("text")))


def _records(bare_arrays: bool) -> Column:
    inside = F.try_variant_get("_doc", f"$.{fixed.REVIEWS_KEY}", "array<variant>")
    return F.coalesce(F.try_variant_get("_doc", "$", "array<variant>"), inside) if bare_arrays else inside


def _problem(bare_arrays: bool) -> Column:
    return F.when(F.col("_doc").isNull(), F.lit(_NO_JSON)).when(
        _records(bare_arrays).isNull(), F.lit(f"holds no {fixed.REVIEWS_KEY} array")
    )


def dataset_problems(reviews: DataFrame, rules: ReviewRules = ReviewRules()) -> DataFrame:
    """Every rule violation of a dataset about to be written."""
    return check_typed(reviews, rules).select(
        "seq", F.explode(items("violations")).alias("v")
    ).select("seq", "v.path", "v.message")


def write_envelopes(
    reviews: DataFrame,
    path: str,
    generated_at: str,
    rules: ReviewRules = ReviewRules(),
    per_file: int = 10_000,
) -> None:
    """Writes reviews as dataset files of at most ``per_file`` records each, which
    read back in the same order; a document of any size would be one task's work."""
    if reviews.sparkSession.range(1).select(F.try_to_timestamp(F.lit(generated_at))).first()[0] is None:
        raise ValueError(f"generated_at is not a timestamp: {generated_at}")
    problems = dataset_problems(reviews, rules)
    shown = problems.orderBy("seq").limit(_SHOWN).collect()
    if shown:
        listed = "\n".join(f"  - {p['seq']}/{p['path']}: {p['message']}" for p in shown)
        raise ValueError(f"dataset breaks its rules ({problems.count()} violations):\n{listed}")
    if reviews.isEmpty():
        raise ValueError("dataset holds no reviews")
    numbered = with_position(reviews.withColumn("_all", F.lit(0)), "_all", ["seq"])
    place = F.col("position") - 1
    head = F.substring_index(
        F.to_json(
            F.struct(
                F.lit(fixed.SCHEMA_VERSION).alias("schema_version"),
                F.lit(generated_at).alias("generated_at"),
                F.array().cast("array<string>").alias(fixed.REVIEWS_KEY),
            )
        ),
        "]",
        1,
    )
    first, last = place % per_file == 0, (F.col("position") % per_file == 0) | (
        F.col("position") == F.col("group_rows")
    )
    record = F.to_json(F.struct(*REVIEW_FIELDS))
    (
        numbered.select(
            F.format_string("%08d", F.expr(f"(position - 1) div {per_file}")).alias("part"),
            "position",
            F.concat(F.when(first, head).otherwise(""), record, F.when(last, "]}").otherwise(",")).alias("value"),
        )
        # A file's records are one task's, which writes them one by one in order.
        .repartition("part")
        .sortWithinPartitions("part", "position")
        .select("part", "value")
        .write.mode("overwrite")
        .partitionBy("part")
        .text(path)
    )
