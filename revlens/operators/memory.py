"""Answers that were paid for once, kept between runs.

A ledger is a folder of Parquet files that are only ever added: one row per call that
was answered, under the hash of the provider's version and the call's arguments. A run
takes the known answers out of it, asks for the others, and adds what came back. Failed
calls are not kept, so the next run asks again.

Every addition is a folder of its own, so two runs at once never touch each other's
files; a call that both made has two rows, and readers take the one written first. Files
appear whole, and a run that is lost leaves at most answers that are right.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens.operators.providers import Provider, call_each
from revlens.sources.tables import exists, keep

_ROWS = "call string, text string, number double, answered_at timestamp"
#: Additions by version, so that a reader opens the files of its own version only.
_SCHEMA = f"{_ROWS}, version string, addition string"


@dataclass(frozen=True)
class Memory:
    """A ledger at ``path``, a folder that every executor reaches."""

    path: str

    def known(self, spark: SparkSession, version: str) -> DataFrame:
        """``call``, ``text``, ``number``: one row per call that the version has answered."""
        if exists(spark, self.path):
            rows = spark.read.schema(_SCHEMA).parquet(self.path)
        else:
            rows = spark.createDataFrame([], _SCHEMA)
        first = F.min_by(F.struct("text", "number"), F.struct("answered_at", "addition"))
        return (
            rows.where(F.col("version") == _folder(version))
            .groupBy("call")
            .agg(first.alias("_first"))
            .select("call", "_first.*")
        )

    def add(self, answers: DataFrame, version: str) -> None:
        """Adds ``(call, text, number)`` rows, each call once."""
        folder = f"{self.path.rstrip('/')}/version={_folder(version)}/addition={uuid4().hex}"
        stamped = answers.withColumn("answered_at", F.current_timestamp())
        stamped.select("call", "text", "number", "answered_at").write.mode("errorifexists").parquet(folder)


def answer_once(
    calls: DataFrame, provider: Provider, args: list[str], kind: str, memory: Memory
) -> DataFrame:
    """One answer for every distinct call of a table with the columns ``args``.

    Adds ``call`` (its hash), ``value``, ``error``, and ``remembered``: whether the answer
    was known before. Only the other calls are made, and the provider must name its
    ``version``, as answers of another one are another's. The result is a table, so
    reading it again asks nobody.
    """
    if not provider.version:
        raise ValueError("a provider whose answers are kept needs a version")
    # A call and its known answer meet on 64 digits; both sides have one row per call, so
    # no key is hot however often a text occurs.
    distinct = calls.select(*args, call_hash(args).alias("call")).distinct()
    column = "text" if kind == "string" else "number"
    known = memory.known(calls.sparkSession, provider.version).select(
        "call", F.col(column).alias("value"), F.lit(True).alias("remembered")
    )
    met = keep(distinct.join(known, "call", "left"))
    old = met.where("remembered").select(
        *args, "call", "value", F.lit(None).cast("string").alias("error"), "remembered"
    )
    call = F.array(F.struct(*[F.col(a) for a in args]))
    unknown = met.where("remembered IS NULL").select(*args, "call")
    asked = call_each(unknown, provider, call, args, "_results", kind)
    result = F.get("_results", F.lit(0))
    new = keep(
        asked.select(
            *args, "call", result["value"].alias("value"), result["error"].alias("error"),
            F.lit(False).alias("remembered"),
        )
    )
    columns = {"text": F.lit(None).cast("string"), "number": F.lit(None).cast("double"), column: F.col("value")}
    memory.add(
        new.where(F.col("error").isNull()).select("call", *[c.alias(n) for n, c in columns.items()]),
        provider.version,
    )
    return old.unionByName(new)


def call_each_once(
    df: DataFrame,
    provider: Provider,
    calls: Column,
    args: list[str],
    out: str,
    kind: str,
    key: list[str],
    memory: Memory,
) -> DataFrame:
    """As ``call_each``, but equal calls are made once, over all rows and all runs.

    ``key`` names columns that are unique and not null in every row. ``df`` is read
    twice, so it is a table or a plan that gives the same rows again.
    """
    asked = df.select(*key, F.posexplode(calls).alias("_pos", "_args")).select(*key, "_pos", "_args.*")
    answers = answer_once(asked, provider, args, kind, memory)
    # One row per call on this side: a text that very many rows share is split on theirs.
    found = asked.select(*key, "_pos", call_hash(args).alias("call")).join(
        answers.select("call", F.struct("value", "error").alias("_result")), "call"
    )
    in_order = F.array_sort(F.collect_list(F.struct("_pos", "_result")))
    results = found.groupBy(*key).agg(F.transform(in_order, lambda x: x["_result"]).alias(out))
    none = F.array().cast(results.schema[out].dataType)
    return df.join(results, key, "left").withColumn(out, F.coalesce(out, none))


def call_hash(args: list[str]) -> Column:
    """SHA-256 of the arguments with their names; null and empty values differ."""
    fields = F.struct(*[F.col(a) for a in args])
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}).cast("binary"), 256)


def _folder(version: str) -> str:
    """A version as the name of a folder: readable, and different for different versions."""
    readable = re.sub(r"[^A-Za-z0-9.-]", "-", version)[:40]
    return f"{readable}-{hashlib.sha256(version.encode()).hexdigest()[:16]}"
