"""Quality rules as learned decision lists.

Sequential covering: a rule is grown, threshold by threshold, on two thirds of the
labelled rows until it covers almost only rejected texts, pruned on the last third,
and the rows it covers are set aside before the next rule. The list becomes one ordered
conditional expression. All counts are aggregations; the driver sees a table of
(feature, bin) counts per step. Statistics of a text are column expressions as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from revlens.llm.text import SPACED, text_of
from revlens.sources.tables import keep

_WINDOW = 5
_BINS = 16
_MOST_RULES, _MOST_CONDITIONS = 8, 3
_PURE, _ACCEPTED, _LEAST_COVERED = 0.98, 0.85, 5
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"

FEATURES = (
    "n_words word_length symbol_share line_repeats word_repeats upper_share digit_share bang_share "
    "bar_share mark_share distinct_share words_per_line"
).split()


def statistics(docs: DataFrame, text_col: str, carried: list[str]) -> DataFrame:
    """Counts and shares of every text, in one pass without a shuffle."""
    text = F.col("_text")

    def characters(which: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, which, ""))).cast("double")

    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(SPACED))
    rows = docs.select(*carried, text_of(text_col).alias("_text")).select(
        *carried,
        F.regexp_extract_all(text, F.lit(SPACED), F.lit(0)).alias("_words"),
        lines.alias("_lines"),
        F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
        characters(_SYMBOLS).cast("long").alias("n_symbols"),
        F.length(text).cast("double").alias("_chars"),
        characters("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("_upper"),
        characters("0123456789").alias("_digits"),
        characters("!").alias("_bang"),
        characters("|").alias("_bar"),
        characters(".,;:?").alias("_marks"),
    )
    n = F.col("n_words")
    rows = rows.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.size(F.array_distinct("_words")).alias("_distinct"),
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    ).drop("_words", "_lines")
    windows = F.when(
        n >= _WINDOW,
        F.transform(
            F.sequence(F.lit(0), (n - _WINDOW).cast("int")),
            lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(_WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_windows", windows)
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn(
        "_sorted",
        F.when(
            repeated,
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    # Windows that equal a neighbour in sorted order occur twice or more.
    twice = F.filter(
        "_sorted",
        lambda x, k: (F.get("_sorted", k - 1)["h"] == x["h"]).eqNullSafe(True)
        | (F.get("_sorted", k + 1)["h"] == x["h"]).eqNullSafe(True),
    )
    rows = rows.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda i, k: F.least(F.coalesce(F.get("_starts", k + 1) - i, F.lit(_WINDOW)), F.lit(_WINDOW)),
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    chars = F.col("_chars")
    return rows.select(
        *carried,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        share(F.col("word_chars"), n).alias("word_length"),
        share(F.col("n_symbols"), chars).alias("symbol_share"),
        share(F.col("n_dup_lines"), F.col("_n_lines")).alias("line_repeats"),
        share(F.col("n_repeat_words"), n).alias("word_repeats"),
        share(F.col("_upper"), chars).alias("upper_share"),
        share(F.col("_digits"), chars).alias("digit_share"),
        share(F.col("_bang"), chars).alias("bang_share"),
        share(F.col("_bar"), chars).alias("bar_share"),
        share(F.col("_marks"), chars).alias("mark_share"),
        share(F.col("_distinct"), n).alias("distinct_share"),
        share(n, F.col("_n_lines")).alias("words_per_line"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.bound if self.above else value <= self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule) -> Column:
    whole = F.lit(True)
    for condition in rule:
        whole = whole & condition.column()
    return whole


def learn(examples: DataFrame) -> list[Rule]:
    """Rules that reject, in order, from rows of ``FEATURES``, ``_bad`` (1 or 0) and ``_prunes``.

    Without examples of both kinds there are no rules, and nothing is rejected.
    """
    total, bad = examples.agg(F.count("*"), F.sum("_bad")).first()
    if not bad or bad == total:
        return []
    shares = [k / _BINS for k in range(1, _BINS)]
    found = examples.agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES]).first()
    bounds = {f: sorted(set(found[f])) for f in FEATURES}
    rules: list[Rule] = []
    open_rows = examples
    while len(rules) < _MOST_RULES:
        rule = _pruned(open_rows.where("_prunes"), _grown(open_rows.where("not _prunes"), bounds))
        if not rule:
            break
        rules.append(rule)
        open_rows = open_rows.where(~_holds(rule))
    return rules


def _grown(rows: DataFrame, bounds: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < _MOST_CONDITIONS:
        counts = _counts(rows.where(_holds(rule)), bounds)
        best = None
        for feature, bins in counts.items():
            n, bad = sum(b[0] for b in bins), sum(b[1] for b in bins)
            if not bad or bad / n >= _PURE:
                return rule
            below_n = below_bad = 0
            for bound, (bin_n, bin_bad) in zip(bounds[feature], bins):
                below_n, below_bad = below_n + bin_n, below_bad + bin_bad
                for above, covered, hit in ((False, below_n, below_bad), (True, n - below_n, bad - below_bad)):
                    if hit >= _LEAST_COVERED and covered < n:
                        # Precision counts most; among equals, coverage.
                        worth = (round((hit + 1) / (covered + 2), 2), hit)
                        if best is None or worth > best[0]:
                            best = (worth, Condition(feature, above, bound), (bad + 1) / (n + 2))
        if best is None or best[0][0] <= best[2]:
            return rule
        rule += (best[1],)
    return rule


def _counts(rows: DataFrame, bounds: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """Rows and bad rows per feature and bin."""

    def bin_of(feature: str) -> Column:
        cuts = F.array(*[F.lit(float(b)) for b in bounds[feature]])
        return F.size(F.filter(cuts, lambda b: F.col(feature) > b))

    entries = [F.struct(F.lit(f).alias("f"), bin_of(f).alias("b")) for f in FEATURES]
    found = (
        rows.select("_bad", F.explode(F.array(*entries)).alias("e"))
        .groupBy("e.f", "e.b")
        .agg(F.count("*").alias("n"), F.sum("_bad").alias("bad"))
        .collect()
    )
    table = {f: [(0, 0)] * (len(bounds[f]) + 1) for f in FEATURES}
    for row in found:
        table[row["f"]][row["b"]] = (row["n"], row["bad"])
    return table if found else {}


def _pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of the rule that does best on rows it was not grown on, if good enough."""
    if not rule:
        return ()
    prefixes = [rule[: k + 1] for k in range(len(rule))]
    sums = rows.agg(
        *[F.sum(F.when(_holds(p), 1).otherwise(0)).alias(f"n{k}") for k, p in enumerate(prefixes)],
        *[F.sum(F.when(_holds(p), F.col("_bad")).otherwise(0)).alias(f"b{k}") for k, p in enumerate(prefixes)],
    ).first()
    worth = []
    for k, prefix in enumerate(prefixes):
        n, bad = sums[f"n{k}"] or 0, sums[f"b{k}"] or 0
        if bad >= _LEAST_COVERED and bad / n >= _ACCEPTED:
            worth.append(((2 * bad - n) / n, bad, prefix))
    return max(worth, key=lambda w: w[:2])[2] if worth else ()


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional: false from the first rule that holds, else true."""
    decided = F.lit(True)
    for rule in reversed(rules):
        decided = F.when(_holds(rule), F.lit(False)).otherwise(decided)
    return decided


def judge(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    least_words: int = 10,
    most_repeated: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Statistics and verdict of every text, one row per input row.

    Columns: the id, the counts and shares of ``statistics``, ``base_failed`` (fewer than
    ``least_words`` words, or more than ``most_repeated`` % of them in repeated windows of
    five) and ``kept`` (the base rules and the learned list agree to keep). Null texts
    are as empty: no words, so they fail. Words are compared by 64-bit hashes inside
    one text. Ids with several labels or texts give an example for each; unknown ids
    and other labels are passed over. Without labels only the base rules decide.
    """
    stats = keep(statistics(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), "_t", ["_id"]))
    usable = labels.where(F.col(label).isin(0, 1)).select(
        F.col(id_col).alias("_id"), (1 - F.col(label)).cast("long").alias("_bad")
    )
    prunes = (F.crc32(F.col("_id").cast("string").cast("binary")) % 3 == 0).alias("_prunes")
    examples = keep(stats.join(usable, "_id").select(*FEATURES, "_bad", prunes))
    words = F.col("n_words")
    failed = (words < least_words) | (100 * F.col("n_repeat_words") > most_repeated * words)
    return stats.withColumn("base_failed", failed).select(
        F.col("_id").alias(id_col),
        *[c for c in stats.columns if c != "_id"],
        "base_failed",
        (~F.col("base_failed") & verdict(learn(examples))).alias("kept"),
    )
