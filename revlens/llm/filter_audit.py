"""What each filter of a chain removes, in every order of the filters.

The states of a run are the subsets of filters applied so far, a lattice; applying one
more filter is an edge, and an order is a path from the empty set to the full one. A
document leaves on the edge whose filter it fails while it failed none before, so what an
edge removes depends on the state alone, not on the order that led there. Counting paths
forward (orders that reach a state) and backward (orders that leave it) gives the number
of orders that use an edge, the weight of its removals in the Shapley sum; the steps of
one order are its edges, read from the same table.

Documents are reduced to counts by part and set of failed filters before anything is
combined, so the work beyond one pass over the texts follows the number of parts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

from revlens.llm.text import SPACED, text_of
from revlens.sources.tables import keep

#: Filters of the query, in the order of their letters.
FILTERS = ("A", "B", "C", "D", "E")
#: The orders of more filters than these are not written out as rows.
MOST_FILTERS = 7


def lattice(n: int) -> list[tuple[int, int, int]]:
    """Edges ``(state, filter, orders)``: ``orders`` of the n! orders apply ``filter`` in
    ``state``, a bit per filter applied before. Paths are counted forward and backward."""
    states = sorted(range(1 << n), key=int.bit_count)
    reaching, leaving = [0] * (1 << n), [0] * (1 << n)
    reaching[0] = leaving[-1] = 1
    edges = [(s, f) for s in states for f in range(n) if not s >> f & 1]
    for state, f in edges:
        reaching[state | 1 << f] += reaching[state]
    for state, f in reversed(edges):
        leaving[state] += leaving[state | 1 << f]
    return [(state, f, reaching[state] * leaving[state | 1 << f]) for state, f in edges]


def failures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: Sequence[str] = ()
) -> DataFrame:
    """The ``carried`` columns and ``failed``, a bit for each of ``FILTERS``, for every row.

    A: under 200 words; B: fewer distinct words than half the words; C: over 3 % of the
    code points are A-Z; D: holds one of #$%&*|; E: a row with a smaller id has the same
    text. A null text is an empty one, equal to other empty ones; an id that is null is
    larger than all others; rows that share text and id do not fail E by each other.
    Texts are compared by their SHA-256.
    """
    text, words = F.col("_text"), F.col("_words")
    n_words = F.size(words)
    bits = [
        n_words < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * n_words.cast("long"),
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 3 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    rows = docs.select(
        *[F.col(c).alias(f"_carried_{c}") for c in carried],
        F.col(id_col).alias("_id"),
        text_of(text_col).alias("_text"),
    ).withColumn("_words", F.regexp_extract_all(text, F.lit(SPACED), F.lit(0)))
    judged = keep(
        rows.select(
            *[f"_carried_{c}" for c in carried],
            "_id",
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("_digest"),
            _mask(bits).alias("_failed"),
        )
    )
    # The smallest id of every text that several rows have: one row per text, so that the
    # join below splits the rows of a text that very many share.
    first = (
        judged.groupBy(F.col("_digest").alias("_same"))
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
        .where("_rows > 1")
    )
    later = F.col("_first").isNotNull() & (F.col("_id").isNull() | (F.col("_id") > F.col("_first")))
    return judged.join(first, judged["_digest"] == first["_same"], "left").select(
        *[F.col(f"_carried_{c}").alias(c) for c in carried],
        F.col("_id").alias(id_col),
        (F.col("_failed") + F.when(later, 1 << 4).otherwise(0)).alias("failed"),
    )


def marked(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``good`` and ``toxic`` (0 or 1) from ``labels(doc_id, quality, toxic)``. An id
    that is labelled several times has a mark if any of its labels says so; ids without a
    label, and null ids, have none."""
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
    )
    joined = rows.join(known, F.col(id_col) == F.col("_labelled"), "left").drop("_labelled")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def audit(rows: DataFrame, part_col: str, filters: Sequence[str] = FILTERS) -> DataFrame:
    """The steps of every order of the filters, per part.

    ``rows`` holds the part, ``failed`` (bit i for ``filters[i]``), ``good`` and ``toxic``.
    One row per part, ``filter_order`` and ``step``, zeros included, with ``kept`` and
    ``removed`` (after and in this step), ``redundant`` (fail the step's filter, but were
    removed before), ``unique_fails`` (fail this filter alone), ``good_lost``,
    ``toxic_lost`` (of the removed) and ``shapley`` (removed by this filter, added up over
    all orders). A null part is the empty string. No rows, no parts, no result.
    """
    if not 0 < len(filters) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters, not {len(filters)}")
    edges = lattice(len(filters))
    sets = rows.groupBy(F.coalesce(part_col, F.lit("")).alias("part"), "failed").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    parts = sets.groupBy("part").agg(
        F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("_sets")
    )
    drawn = F.array(
        *[
            F.struct(
                F.lit(at).alias("edge"), F.lit(state).alias("state"), F.lit(1 << f).alias("bit"),
                F.lit(orders).cast("long").alias("orders"),
            )
            for at, (state, f, orders) in enumerate(edges)
        ]
    )
    walked = parts.select("part", "_sets", F.explode(drawn).alias("e")).select("part", "_sets", "e.*")

    def total(which: Callable[[Column], Column], value: str = "n") -> Column:
        return F.aggregate(
            F.filter("_sets", lambda x: which(x["failed"])),
            F.lit(0).cast("long"),
            lambda so_far, x: so_far + x[value],
        )

    def fails(x: Column) -> Column:
        return x.bitwiseAND(F.col("bit")) != 0

    def leaves(x: Column) -> Column:
        return fails(x) & (x.bitwiseAND(F.col("state")) == 0)

    measured = walked.select(
        "part",
        "edge",
        "bit",
        "orders",
        total(lambda x: x.bitwiseAND(F.col("state") + F.col("bit")) == 0).alias("kept"),
        total(leaves).alias("removed"),
        total(fails).alias("_fails"),
        total(lambda x: x == F.col("bit")).alias("unique_fails"),
        total(leaves, "good").alias("good_lost"),
        total(leaves, "toxic").alias("toxic_lost"),
    )
    shares = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "bit"))
    measured = measured.withColumn("shapley", shares)
    # The steps are fixed by the filters alone, so this side never grows with the data.
    steps = rows.sparkSession.createDataFrame(
        _steps(edges, filters), "edge int, filter_order string, step int"
    )
    return measured.join(F.broadcast(steps), "edge").select(
        "part", "filter_order", "step", "kept", "removed",
        (F.col("_fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def _steps(edges: list[tuple[int, int, int]], filters: Sequence[str]) -> list[tuple[int, str, int]]:
    """The edge that every order takes in every step."""
    number = {(state, f): at for at, (state, f, _) in enumerate(edges)}
    steps = []
    for order in permutations(range(len(filters))):
        state = 0
        for step, f in enumerate(order, 1):
            steps.append((number[state, f], "".join(filters[g] for g in order), step))
            state |= 1 << f
    return steps


def _mask(bits: list[Column]) -> Column:
    return sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))
