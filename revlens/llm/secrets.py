"""Secret scans over an incremental ledger of blobs.

Every historical version of every path is addressed by the SHA-256 of its text. A
ledger holds one row per scanned (blob, rule version); a run scans only the pairs
that are not in it, appends them, and joins the findings back to all paths.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from revlens.llm.text import text_of
from revlens.sources.tables import keep

SPAN = "array<struct<kind:string,start:long,end:long>>"
_MATCHES = "array<struct<before:long,size:long,value:long>>"
LEDGER = f"blob string, rule string, findings {SPAN}"


@dataclass(frozen=True)
class Rule:
    """A regular expression (Java syntax) whose matches, leftmost and not overlapping, are
    findings if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        said = f"{self.kind}\x00{self.pattern}\x00{self.group}\x00{self.least}"
        return f"{self.kind}:{hashlib.sha256(said.encode()).hexdigest()[:16]}"


# The base rules. The lower bounds inside the last two patterns find the
# same matches as a bound applied afterwards, as both take whole runs.
BASE = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)""",
        group=1,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}+"),
    Rule("hex", r"[0-9a-f]{24,}+"),
)
# Bounded repeats and anchored starts keep these linear, and their groups off the stack.
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("prefixed", r"(?:gh[pousr]_|github_pat_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,9}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{6,256}@"),
)
RULES = BASE + ADDED


def blob_id(text_col: str) -> Column:
    return F.sha2(text_of(text_col).cast("binary"), 256)


def _matches(rule: Rule, text: Column) -> Column:
    """A rule's matches in a text, in order: characters since the one before, own, of the value.

    Spark gives matches without offsets. The pieces between them, from splitting at the
    same expression, give the lengths that add up to each offset.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.pattern, -1)

    def length(x: Column) -> Column:
        return F.length(x).cast("long")

    # Each list is made once a text; the pieces are one more than the matches.
    zipped = F.filter(F.arrays_zip(found, value, between), lambda x: x["0"].isNotNull())
    matches = F.transform(
        zipped,
        lambda x: F.struct(length(x["2"]).alias("before"), length(x["0"]).alias("size"), length(x["1"]).alias("value")),
    )
    return F.when(text.rlike(rule.pattern), matches).otherwise(F.array().cast(_MATCHES))


def _findings(matches: DataFrame) -> DataFrame:
    """(blob, rule, ``findings``) from a row per match; offsets count code points.

    The rows of a blob lie in one partition already, so the running sum of lengths only
    sorts them, and its time is linear in the matches.
    """
    so_far = Window.partitionBy("blob", "rule").orderBy("at")
    last = F.sum(F.col("m.before") + F.col("m.size")).over(so_far)
    placed = matches.withColumn("end", last).withColumn("start", F.col("end") - F.col("m.size"))
    here = F.when(F.col("m.value") >= F.col("least"), F.struct("kind", "start", "end"))
    return placed.groupBy("blob", "rule").agg(F.sort_array(F.collect_list(here)).cast(SPAN).alias("findings"))


def scan(
    history: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Scans what the ledger lacks: (findings of every input row, new ledger rows).

    ``history`` has one row per version of a path, with any columns beside the text.
    The first result repeats them without the text, in any order, with ``blob`` and
    ``findings``, an array of (kind, start, end) sorted by start, then by the order of
    the rules; names that clash with these two give way to them. The second is to be
    appended to the ledger; scanning the same history again with it scans nothing.

    A null text is the empty blob. Equal texts are scanned once, however often they
    occur. Rule order and every limit belong to the rules; no text is cut. An empty
    history gives two empty tables.
    """
    names = [c for c in history.columns if c not in (text_col, "blob", "findings")]
    paths = keep(history.select(*names, blob_id(text_col).alias("blob")))
    versions = F.array(*[F.lit(r.version) for r in rules])
    blobs = paths.select("blob").distinct().withColumn("rule", F.explode(versions))
    if ledger is not None:
        blobs = blobs.join(ledger.select("blob", "rule"), ["blob", "rule"], "left_anti")
    # One row per blob with at most one entry per rule.
    pending = blobs.groupBy("blob").agg(F.collect_set("rule").alias("_todo"))
    texts = history.select(blob_id(text_col).alias("blob"), text_of(text_col).alias("_text"))
    # Copies meet here as (blob, text), combined in each task before the shuffle.
    texts = texts.groupBy("blob").agg(F.first("_text").alias("_text"))
    scanned = texts.join(pending, "blob").select(
        "blob",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(r.version).alias("rule"),
                        F.lit(r.kind).alias("kind"),
                        F.lit(r.least).alias("least"),
                        F.when(F.array_contains("_todo", r.version), _matches(r, F.col("_text"))).alias("found"),
                    )
                    for r in rules
                ]
            )
        ).alias("_r"),
    )
    # A pair without a match keeps one row, as the ledger has to name it.
    matches = scanned.where(F.col("_r.found").isNotNull()).select(
        "blob", "_r.rule", "_r.kind", "_r.least", F.posexplode_outer("_r.found").alias("at", "m")
    )
    new = keep(_findings(matches))
    known = new if ledger is None else new.unionByName(ledger.select("blob", "rule", "findings"))
    order = F.map_from_arrays(
        F.array(*[F.lit(r.kind) for r in rules]), F.array(*[F.lit(i) for i in range(len(rules))])
    )
    found = (
        known.where(F.col("rule").isin([r.version for r in rules]) & (F.size("findings") > 0))
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("findings")).alias("findings"))
    )
    ranked = F.transform(
        "findings",
        lambda s: F.struct(s["start"].alias("s"), F.element_at(order, s["kind"]).alias("o"), s.alias("f")),
    )
    found = found.withColumn("findings", F.transform(F.array_sort(ranked), lambda x: x["f"]))
    joined = paths.join(found, "blob", "left")
    return (
        joined.withColumn("findings", F.coalesce("findings", F.array().cast(SPAN))).select(
            *names, "blob", "findings"
        ),
        new,
    )


def spans_text(findings: Column) -> Column:
    said = F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", said)
