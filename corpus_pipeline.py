"""From raw documents to a mixed training corpus, stage by stage.

Each stage takes the session, what its predecessor kept and the folder of tables. All
but the last return the columns of ``documents``; the last adds ``copy``, the number of
the copy, as a document may be taken more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.llm import contamination, jaccard, mixing, pii, quality
from revlens.llm.text import documents, table
from revlens.sources.tables import keep

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_CARRIED = COLUMNS[1:]

#: The stage's own rule for near copies; 4 words and 85 % are those of the op7 query alone.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier predicts to be bad.

    A null text is judged as an empty one, and equal texts alike, so repeated rows stay or
    go together; null ids stay like others. Without usable labels nothing goes. An empty
    table stays empty; other columns than those of documents are left out.
    """
    scored = quality.score(docs, table(spark, sf_dir, "labels"), carried=_CARRIED)
    return scored.where("predicted = 1").select(*COLUMNS)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each component of near duplicates, that with the smallest id.

    Near duplicates share at least 80 % of their 5-word shingles. Null texts and texts
    without words have none and all stay. Of repeated rows one stays; null ids come after
    all others. An empty table stays empty; other columns are left out.
    """
    kept = jaccard.keepers(docs, width=NEAR_WORDS, percent=NEAR_PERCENT, carried=_CARRIED)
    return kept.select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage.

    Null and empty texts hold none and stay; repeated rows stay or go together. Null or
    wordless items hit nothing. An empty table stays empty; other columns are left out.
    """
    found = contamination.scan(docs, table(spark, sf_dir, "benchmark"), carried=_CARRIED)
    return found.where("n_hit = 0").select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; ``n_chars`` follows.

    Every row stays, repeated ones too, and is treated by its text alone. Null texts stay
    null with the ``n_chars`` they came with. Other columns are left out.
    """
    clean = pii.redact(docs.select(*COLUMNS), pii.fit(docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of its source wants it.

    Texts without words, null ones too, add nothing to a source and are not taken. A null
    source is a source of its own, last in order. Repeated rows are documents of their own,
    each taken at most twice. An empty table stays empty; other columns are left out.
    """
    mixed = mixing.mix(docs, extra=("text", "lang", "source", "n_chars")).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.select(*COLUMNS, copies.alias("copy"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
]

#: Trained models and Newton steps are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = keep(docs)
    return docs
