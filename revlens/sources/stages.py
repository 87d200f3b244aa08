"""Stage tables: written once, in one piece or range by range, with a row for what is done.

A table is a folder. Every piece is written into a folder of its own, and a commit row
names it and holds the counters that were observed while it was written. A piece without
a commit row does not exist for readers, so a run that is lost leaves nothing to clean
up: a later one writes only the ranges that have no commit, and the rest is not done (or
paid for) again.

Counters are observed on the plan that writes, in its last stage, where Spark counts
every finished task once however often it was tried.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from types import MappingProxyType
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from revlens.sources.tables import exists

_COMMITS = "range int, path string, counters map<string,long>"
_RANGES = "plan string, range int, low long, high long"

#: The counter that every piece has.
ROWS = "rows"


def append_row(row: DataFrame, path: str) -> None:
    """Adds a row to a log, in a folder of its own: writers of the same log at the same
    time never share the files that Spark commits and clears."""
    row.coalesce(1).write.mode("errorifexists").parquet(f"{path}/entry={uuid4().hex}")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a log; none if nothing was added yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class StageTable:
    spark: SparkSession
    path: str

    def commits(self) -> list[Row]:
        """One row per finished piece; the first, should a range have two."""
        return self._log().orderBy("range").collect()

    def counters(self) -> DataFrame:
        """``counter``, ``value``: added up over the committed pieces."""
        listed = self._log().select(F.explode("counters").alias("counter", "n"))
        return listed.groupBy("counter").agg(F.sum("n").alias("value"))

    def rows(self) -> int:
        return sum(c["counters"][ROWS] for c in self.commits())

    def _log(self) -> DataFrame:
        log = read_log(self.spark, f"{self.path}/commits", _COMMITS)
        first = F.min_by(F.struct("path", "counters"), "path").alias("c")
        return log.groupBy("range").agg(first).select("range", "c.*")

    def finished(self) -> bool:
        return len(self.commits()) >= max(1, len(self._ranges()))

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All committed pieces."""
        paths = [c["path"] for c in self.commits()]
        if not paths:
            raise ValueError(f"{self.path} has not been written")
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def write(
        self,
        df: DataFrame,
        counters: Mapping[str, Column] | None = None,
        *partitions: str,
        options: Mapping[str, str] | None = None,
    ) -> None:
        """Writes the whole table as one piece; ``options`` are those of the Parquet writer."""
        if self.commits():
            raise ValueError(f"{self.path} already exists")
        self._write(0, df, counters or {}, partitions, options or {})

    def write_ranges(
        self,
        source: DataFrame,
        key: str,
        rows: int,
        make: Callable[[DataFrame], DataFrame],
        counters: Mapping[str, Column] | None = None,
    ) -> None:
        """Writes ``make`` of the source, in ranges of about ``rows`` rows of an integer key.

        The ranges are settled and written down by the first call; a later one, by
        whatever process, does those that have no commit yet. Null keys belong to the first.
        """
        ranges = self._ranges()
        if not ranges:
            self._plan(source, key, rows)
            ranges = self._ranges()
        done = {c["range"] for c in self.commits()}
        if len(done) == len(ranges):
            raise ValueError(f"{self.path} already exists")
        for number, low, high in ranges:
            if number not in done:
                self._write(number, make(source.where(_inside(key, low, high))), counters or {})

    def _write(
        self,
        number: int,
        df: DataFrame,
        counters: Mapping[str, Column],
        partitions: tuple[str, ...] = (),
        options: Mapping[str, str] = MappingProxyType({}),
    ) -> None:
        seen, path = Observation(), f"{self.path}/pieces/{number}-{uuid4().hex}"
        counted = df.observe(seen, F.count("*").alias(ROWS), *[c.alias(n) for n, c in counters.items()])
        writer = counted.write.mode("errorifexists").options(**options)
        writer.partitionBy(*partitions).parquet(path)
        values = {name: int(value or 0) for name, value in seen.get.items()}
        append_row(self.spark.createDataFrame([(number, path, values)], _COMMITS), f"{self.path}/commits")

    def _plan(self, source: DataFrame, key: str, rows: int) -> None:
        total = source.count()
        pieces = max(1, -(-total // rows))
        bounds: list[int] = []
        if pieces > 1:
            # Any bounds cut the table right; approximate ones cut it about evenly.
            shares = [i / pieces for i in range(1, pieces)]
            found = source.agg(F.percentile_approx(key, shares, max(10_000, 10 * pieces))).first()[0]
            bounds = sorted(set(found or []))
        plan = uuid4().hex
        ranges = [(plan, i, low, high) for i, (low, high) in enumerate(zip([None, *bounds], [*bounds, None]))]
        append_row(self.spark.createDataFrame(ranges, _RANGES), f"{self.path}/ranges")

    def _ranges(self) -> list[tuple[int, int | None, int | None]]:
        rows = read_log(self.spark, f"{self.path}/ranges", _RANGES).collect()
        first = min((r["plan"] for r in rows), default=None)
        return sorted((r["range"], r["low"], r["high"]) for r in rows if r["plan"] == first)


def _inside(key: str, low: int | None, high: int | None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(key) >= low)
    if high is not None:
        inside = inside & (F.col(key) < high)
    return inside if low is not None else inside | F.col(key).isNull()

