"""The batch run: each stage reads the table before it and writes its own.

Stages with paid calls can write range by range, so that a run that is lost goes on with
the ranges it has not done. Counters are those that were observed while writing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens.operators import ingest, quality, serving, summarize, translate
from revlens.operators.memory import Memory
from revlens.operators.providers import Judge, Provider
from revlens.params import Params
from revlens.schema import RECORDS
from revlens.sources.stages import ROWS, StageTable, append_row, read_log

#: ``summarize.summarize`` or ``summarize.summarize_tree``.
Summaries = Callable[[DataFrame, Params, Provider, Memory | None], DataFrame]

STATUS = "stage string, source_key string, target_key string, count long"


TABLES = ("records", "translated", "summaries", "scored", "serving_headers", "serving_pages")
_PUBLISHED = "run_id string, published_at timestamp, paths map<string,string>"
_STARTED = "run_id string, started_at timestamp, paths map<string,string>"


@dataclass(frozen=True)
class Layout:
    """Where an attempt at a run keeps its tables.

    Every attempt writes into a folder of its own and a written table is never
    replaced, so a rerun that is lost half way leaves the published one whole.
    """

    root: str
    run_id: str
    paths: Mapping[str, str]

    @classmethod
    def fresh(cls, root: str, run_id: str) -> Layout:
        folder = f"{root.rstrip('/')}/runs/{run_id}/{uuid4().hex}"
        return cls(root, run_id, {table: f"{folder}/{table}" for table in TABLES})

    def again(self, *tables: str) -> Layout:
        """A new attempt that writes ``tables`` anew and reads the others where they are."""
        new = Layout.fresh(self.root, self.run_id)
        return replace(self, paths={**self.paths, **{t: new.path(t) for t in tables}})

    def path(self, table: str) -> str:
        return self.paths[table]

    def table(self, spark: SparkSession, table: str) -> StageTable:
        return StageTable(spark, self.path(table))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self.table(spark, table).read(RECORDS if table == "records" else None)


def _log(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _entry(spark: SparkSession, at: Layout, when: str) -> DataFrame:
    paths = F.create_map(*[F.lit(part) for pair in at.paths.items() for part in pair])
    return spark.range(1).select(
        F.lit(at.run_id).alias("run_id"), F.current_timestamp().alias(when), paths.alias("paths")
    )


def start(spark: SparkSession, root: str, run_id: str, resume: bool = False) -> Layout:
    """A new attempt, or with ``resume`` the last one of this run that was not published."""
    if resume:
        log = read_log(spark, _log(root, "started"), _STARTED).where(F.col("run_id") == run_id)
        last = log.agg(F.max_by("paths", "started_at").alias("paths")).first()["paths"]
        done = read_log(spark, _log(root, "published"), _PUBLISHED).where(F.col("run_id") == run_id)
        if last and last not in [r["paths"] for r in done.select("paths").collect()]:
            return Layout(root, run_id, last)
    at = Layout.fresh(root, run_id)
    append_row(_entry(spark, at, "started_at"), _log(root, "started"))
    return at


def ingest_stage(records: DataFrame, at: Layout, params: Params) -> DataFrame:
    """Valid reviews and rejects, checked and written in one pass."""
    spark, checked = records.sparkSession, ingest.check(records, params.rules)
    at.table(spark, "records").write(ingest.split(checked), ingest.counters(), "valid")
    return ingested(spark, at)


def ingested(spark: SparkSession, at: Layout) -> DataFrame:
    return at.read(spark, "records").where("valid").drop("violations", "valid")


def rejected(spark: SparkSession, at: Layout) -> DataFrame:
    return ingest.rejected(at.read(spark, "records").where("not valid"))


def _by_ranges(
    at: Layout,
    table: str,
    source: DataFrame,
    make: Callable[[DataFrame], DataFrame],
    counters: Mapping[str, Column],
    range_rows: int | None,
) -> DataFrame:
    target = at.table(source.sparkSession, table)
    if range_rows is None:
        target.write(make(source), counters)
    else:
        target.write_ranges(source, "seq", range_rows, make, counters)
    return target.read()


def translate_stage(
    spark: SparkSession,
    at: Layout,
    params: Params,
    translator: Provider,
    distinct_texts: bool = False,
    memory: Memory | None = None,
    range_rows: int | None = None,
) -> DataFrame:
    def made(reviews: DataFrame) -> DataFrame:
        attempted = translate.attempt(reviews, params, translator, distinct_texts, memory)
        return translate.with_translations(attempted, params)

    return _by_ranges(
        at, "translated", ingested(spark, at), made, translate.route_counters(params), range_rows
    )


def summarize_stage(
    spark: SparkSession,
    at: Layout,
    params: Params,
    summarizer: Provider,
    summaries: Summaries = summarize.summarize_tree,
    memory: Memory | None = None,
) -> DataFrame:
    """Summaries of all reviews of a product in their original words."""
    table = at.table(spark, "summaries")
    table.write(summaries(at.read(spark, "translated"), params, summarizer, memory))
    return table.read()


def quality_stage(
    spark: SparkSession,
    at: Layout,
    params: Params,
    judge: Judge,
    memory: Memory | None = None,
    range_rows: int | None = None,
) -> DataFrame:
    """Reviews with their kept translations, and how many were judged and failed."""

    def made(reviews: DataFrame) -> DataFrame:
        judged = (
            quality.score(reviews, params, judge, memory)
            .withColumn("judged", F.size("verdicts"))
            .withColumn(
                "judge_errors", F.size(F.filter("verdicts", lambda v: v["error"].isNotNull()))
            )
        )
        return quality.filter_kept(quality.with_quality(judged))

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    judged, kept = F.col("judged"), F.size("quality")
    counters = {
        "translations": total(judged),
        "kept": total(kept),
        "filtered": total(judged - kept),
        "errors": total(F.col("judge_errors")),
    }
    source = at.read(spark, "translated").drop("failed")
    return _by_ranges(at, "scored", source, made, counters, range_rows)


def serving_stage(spark: SparkSession, at: Layout, params: Params) -> DataFrame:
    """Page headers, and pages of entries, each sorted by product."""
    scored, summaries = at.read(spark, "scored"), at.read(spark, "summaries")
    headers, pages = at.table(spark, "serving_headers"), at.table(spark, "serving_pages")
    if pages.finished():
        raise ValueError(f"{pages.path} already exists")
    if not headers.finished():
        headers.write(
            serving.laid_out(serving.product_headers(scored, summaries)), options=serving.LOOKUP_OPTIONS
        )
    pages.write(
        serving.product_pages(serving.served_entries(scored, params), params),
        options=serving.LOOKUP_OPTIONS,
    )
    return pages.read()


def run_batch(
    records: DataFrame,
    root: str,
    run_id: str,
    params: Params,
    translator: Provider,
    judge: Judge,
    summarizer: Provider,
    distinct_texts: bool = False,
    summaries: Summaries = summarize.summarize_tree,
    memory: Memory | None = None,
    range_rows: int | None = None,
    resume: bool = False,
) -> DataFrame:
    """Runs all stages, publishes the result and returns one status row per stage.

    ``summaries`` makes them: ``summarize.summarize_tree`` bounds every prompt;
    ``summarize.summarize`` holds all reviews of a product in one row, for products that are
    known to be small.

    A stage that fails raises, and then nothing is published: readers go on with the run that
    was published last. With ``resume`` the next call goes on where the last attempt at
    this run ended: finished tables stay as they are, the ingested records included, and
    with ``range_rows`` the translated and judged ranges of about so many reviews as well.
    With a ``memory`` calls answered in any earlier run are not made again.
    """
    spark = records.sparkSession
    at = start(spark, root, run_id, resume)
    stages = [
        ("records", lambda: ingest_stage(records, at, params)),
        ("translated", lambda: translate_stage(spark, at, params, translator, distinct_texts, memory, range_rows)),
        ("summaries", lambda: summarize_stage(spark, at, params, summarizer, summaries, memory)),
        ("scored", lambda: quality_stage(spark, at, params, judge, memory, range_rows)),
        ("serving_pages", lambda: serving_stage(spark, at, params)),
    ]
    for table, stage in stages:
        if not (resume and at.table(spark, table).finished()):
            stage()
    status = stage_status(spark, at)
    publish(spark, at)
    return status


def stage_status(spark: SparkSession, at: Layout) -> DataFrame:
    """What each stage read, wrote and counted."""
    stages = [
        ("ingestion", None, "records"),
        ("translation", "records", "translated"),
        ("summarization", "translated", "summaries"),
        ("quality", "translated", "scored"),
        ("serving", "scored", "serving_pages"),
    ]
    rows = []
    for stage, source, target in stages:
        table = at.table(spark, target)
        counters = {r["counter"]: r["value"] for r in table.counters().collect()}
        count = counters["valid"] if target == "records" else counters[ROWS]
        rows.append((stage, source and at.path(source), at.path(target), count))
    return spark.createDataFrame(rows, STATUS)


def stage_counts(spark: SparkSession, at: Layout, params: Params) -> DataFrame:
    """The counters of a run, ``(stage, counter, value)``, as they were observed while its
    tables were written; no table is read again."""
    stages = (("ingestion", "records"), ("translation", "translated"), ("quality", "scored"))
    long = [
        at.table(spark, table).counters().where(F.col("counter") != ROWS).select(
            F.lit(stage).alias("stage"), "counter", "value"
        )
        for stage, table in stages
    ]
    return long[0].unionByName(long[1]).unionByName(long[2])


def publish(spark: SparkSession, at: Layout) -> None:
    """Names the tables of a finished attempt as those to serve: one added row, so a
    reader sees either all of the tables before or all of these."""
    append_row(_entry(spark, at, "published_at"), _log(at.root, "published"))


def published(spark: SparkSession, root: str) -> Layout:
    """The tables published last; each stage of them can be run ``again``."""
    log = read_log(spark, _log(root, "published"), _PUBLISHED)
    last = log.agg(F.max_by(F.struct("run_id", "paths"), "published_at").alias("last")).first()["last"]
    if last is None:
        raise ValueError(f"no run is published under {root}")
    return Layout(root, last["run_id"], last["paths"])


def served(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Headers and pages of the run published last."""
    at = published(spark, root)
    return at.read(spark, "serving_headers"), at.read(spark, "serving_pages")
