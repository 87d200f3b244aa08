"""Mixing sources to target weights by entropy balancing.

Each source has a target in words. Among all document rates that meet the targets
the one nearest to taking every document once (in relative entropy, no rate above
``max_copies``) is ``rate = min(max_copies, exp(lambda * size / mean size))``, with one
multiplier per source. The multipliers solve a convex dual problem, found here by
Newton steps inside a shrinking bracket. The rates are then rounded into copies.

Everything is DataFrame aggregation: the Newton steps read counts by (source, size)
instead of documents, sources stay rows of a table, and the driver only sees sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from revlens.llm.text import count_words, text_of
from revlens.sources.tables import keep

#: Buckets that one pass of the rounding divides a range into.
_BUCKETS = 4096
_NARROWINGS = 3
_NEWTON_STEPS = 60
_GAP = 1e-7


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    max_copies: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Size, target and copies of every document, one row per input row.

    Sources in code point order (null last, a source of its own) get the weights in
    turn and share ``share`` times all words. A target stops at ``max_copies`` times
    its source's words; the excess goes to the others by weight.

    Columns: the id, ``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``taken``
    and the ``extra`` columns, named as they were (an extra column that clashes with these
    names is not for this call to carry). Null and empty texts have size 0 and no copies. Rows
    that agree in id and size are treated alike. An empty table gives no rows. A rerun
    gives the same copies: the only chance in it is a hash of the id.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("~"))
    # The hash keeps repeated ids of different sizes apart.
    chance = F.xxhash64(F.col(id_col), F.lit(20)) % 1_000_003
    rows = keep(
        docs.select(
            F.col(id_col).alias("_id"),
            key.alias("_key"),
            count_words(text_of(text_col)).alias("_size"),
            ((chance + 1_000_003) % 1_000_003 / 1_000_003).alias("_u"),
            *[F.col(c).alias(f"_extra_{c}") for c in extra],
        )
    )
    sizes = keep(rows.groupBy("_key", "_size").agg(F.count("*").alias("_n")))
    state = _solve(sizes, _targets(sizes, weights, share, max_copies), max_copies)
    rated = rows.join(state.select("_key", "_source_size", "_target", "_lambda", "_mean"), "_key")
    rated = rated.withColumn("_rate", _rate(max_copies))
    events = rated.where("_size > 0").select(
        "_key", "_size", F.explode(_events(max_copies)).alias("_at")
    )
    cuts = keep(_cuts(events, state.select("_key", "_target")))
    taken = [
        F.when((at < F.col("_cut")) | ((at == F.col("_cut")) & ~F.col("_strict")), 1).otherwise(0)
        for at in (_events(max_copies)[k] for k in range(max_copies))
    ]
    copies = F.when(F.col("_size") > 0, F.coalesce(sum(taken, F.lit(0)), F.lit(0))).otherwise(0)
    return (
        rated.join(cuts, "_key", "left")
        .withColumn("_copies", copies)
        .select(
            F.col("_id").alias(id_col),
            F.col("_size").alias("size"),
            F.col("_source_size").alias("source_size"),
            F.col("_target").alias("target"),
            F.col("_rate").alias("rate"),
            F.col("_copies").alias("copies"),
            (F.col("_copies") * F.col("_size")).cast("long").alias("taken"),
            *[F.col(f"_extra_{c}").alias(c) for c in extra],
        )
    )


def _numbered(df: DataFrame, order: str) -> DataFrame:
    """Adds ``_place`` from 0 in the order of a unique column, without one sorting task."""
    ranged = keep(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return (
        ranged.withColumn("_inside", inside)
        .join(starts, "_part")
        .withColumn("_place", F.col("_start") + F.col("_inside") - 1)
        .drop("_part", "_start", "_inside")
    )


def _targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, max_copies: int
) -> DataFrame:
    """Per source its words, its mean size and its target."""
    sums = sizes.groupBy("_key").agg(
        F.sum(F.col("_n") * F.col("_size")).cast("long").alias("_source_size"),
        (F.sum(F.col("_n") * F.col("_size")) / F.sum("_n")).alias("_mean"),
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("_place") % len(weights) + 1).cast("int"),
    )
    sources = keep(
        _numbered(sums, "_key")
        .withColumn("_weight", weight)
        .withColumn("_cap", (F.col("_source_size") * max_copies).cast("double"))
    )
    whole, each = sources.agg(F.sum("_source_size"), F.sum("_weight")).first()
    total, level = share * (whole or 0), 0.0
    following = total / each if each else 0.0
    # Resharing the excess is Newton's method on the level; it ends after finitely many steps.
    while following > level:
        level = following
        full = F.col("_cap") <= F.col("_weight") * level
        capped, free = sources.agg(
            F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        following = (total - (capped or 0.0)) / free if free else level
    return sources.withColumn("_target", F.least("_cap", F.col("_weight") * level)).select(
        "_key", "_source_size", "_mean", "_target", "_cap"
    )


def _rate(max_copies: int) -> Column:
    tilt = F.exp(F.least(F.col("_lambda") * F.col("_size") / F.col("_mean"), F.lit(50.0)))
    return F.when(F.col("_size") == 0, 0.0).otherwise(F.least(F.lit(float(max_copies)), tilt))


def _solve(sizes: DataFrame, sources: DataFrame, max_copies: int) -> DataFrame:
    """One multiplier per source. Those whose target is their cap take everything."""
    full = F.col("_target") >= F.col("_cap") * (1 - 1e-12)
    state = keep(
        sources.withColumn("_lambda", F.when(full, F.lit(1e12)).otherwise(F.lit(0.0)))
        .withColumn("_lo", F.lit(None).cast("double"))
        .withColumn("_hi", F.lit(None).cast("double"))
        .withColumn("_open", ~full & (F.col("_target") > 0))
    )
    for _ in range(_NEWTON_STEPS):
        if state.where("_open").isEmpty():
            break
        state = keep(_newton(sizes, state, max_copies))
    return state


def _newton(sizes: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    rated = sizes.join(state.where("_open").select("_key", "_mean", "_lambda"), "_key")
    words = F.col("_n") * F.col("_size") * F.col("_rate")
    slope = F.when(F.col("_rate") < max_copies, words * F.col("_size") / F.col("_mean"))
    sums = (
        rated.withColumn("_rate", _rate(max_copies))
        .groupBy("_key")
        .agg(F.sum(words).alias("_words"), F.coalesce(F.sum(slope), F.lit(0.0)).alias("_slope"))
    )
    now, gap = F.col("_lambda"), F.col("_words") - F.col("_target")
    lo = F.when(gap < 0, now).otherwise(F.col("_lo"))
    hi = F.when(gap > 0, now).otherwise(F.col("_hi"))
    step = F.when(F.col("_slope") > 0, now - gap / F.col("_slope"))
    # Outside the bracket, or where every rate is at its cap: halve, or reach further out.
    middle = (
        F.when(F.col("_lo").isNotNull() & F.col("_hi").isNotNull(), (F.col("_lo") + F.col("_hi")) / 2)
        .when(F.col("_lo").isNull(), F.col("_hi") * 2 - 1)
        .otherwise(F.col("_lo") * 2 + 1)
    )
    inside = step.isNotNull() & (F.col("_lo").isNull() | (step > F.col("_lo"))) & (
        F.col("_hi").isNull() | (step < F.col("_hi"))
    )
    done = (F.abs(gap) <= F.col("_target") * _GAP) | (
        F.col("_lo").isNotNull()
        & F.col("_hi").isNotNull()
        & (F.col("_hi") - F.col("_lo") <= F.abs(F.col("_hi")) * 1e-14)
    )
    return (
        state.join(sums, "_key", "left")
        .withColumns({"_lo": F.when(F.col("_open"), lo), "_hi": F.when(F.col("_open"), hi)})
        .withColumn("_next", F.when(inside, step).otherwise(middle))
        .withColumn("_done", F.coalesce(done, F.lit(True)))
        .withColumn("_lambda", F.when(F.col("_open") & ~F.col("_done"), F.col("_next")).otherwise(now))
        .withColumn("_open", F.col("_open") & ~F.col("_done"))
        .drop("_words", "_slope", "_next", "_done")
    )


def _events(max_copies: int) -> Column:
    """Where in the rounding order of its source a document takes its first, second, … copy.

    At 0 that is plain random rounding. Weighing by size lets long documents keep that
    choice, while short ones, close together around the cut, make up the difference.
    """
    return F.array(
        *[
            (F.lit(float(k)) - F.col("_rate") - F.col("_u")) * F.col("_size")
            for k in range(1, max_copies + 1)
        ]
    )


def _cuts(events: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the place in the rounding order up to which copies are taken.

    A running sum over a source's documents would be one task's work. The range is
    cut into buckets instead, and the one that holds the target is cut again; the last
    bucket's few places are then summed one by one.
    """
    bounds = (
        events.groupBy("_key")
        .agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"))
        .join(targets, "_key")
        .withColumn("_below", F.lit(0).cast("long"))
    )
    for _ in range(_NARROWINGS):
        wide = F.col("_to") > F.col("_from")
        bucket = F.least(
            F.floor((F.col("_at") - F.col("_from")) / (F.col("_to") - F.col("_from")) * _BUCKETS),
            F.lit(_BUCKETS - 1),
        )
        sums = (
            _within(events, bounds)
            .withColumn("_bucket", F.when(wide, bucket).otherwise(F.lit(0)))
            .groupBy("_key", "_bucket")
            .agg(
                F.sum("_size").alias("_words"),
                F.min("_at").alias("_from"),
                F.max("_at").alias("_to"),
                F.first("_below").alias("_below"),
                F.first("_target").alias("_target"),
            )
        )
        bounds = keep(_crossing(sums, "_bucket").select("_key", "_from", "_to", "_below", "_target"))
    places = (
        _within(events, bounds)
        .groupBy("_key", "_at")
        .agg(
            F.sum("_size").alias("_words"),
            F.first("_below").alias("_below"),
            F.first("_target").alias("_target"),
        )
    )
    over = F.col("_below") + F.col("_words") - F.col("_target")
    return _crossing(places, "_at").select(
        "_key",
        F.col("_at").alias("_cut"),
        (over > F.col("_target") - F.col("_below")).alias("_strict"),
    )


def _within(events: DataFrame, bounds: DataFrame) -> DataFrame:
    return events.join(bounds, "_key").where(F.col("_at").between(F.col("_from"), F.col("_to")))


def _crossing(sums: DataFrame, order: str) -> DataFrame:
    """Per source the first row at which the running sum reaches the target, or the last."""
    running = Window.partitionBy("_key").orderBy(order)
    reached = sums.withColumn("_end", F.col("_below") + F.sum("_words").over(running))
    last = F.lead(order).over(running).isNull()
    starts = F.col("_end") - F.col("_words")
    return (
        reached.withColumn("_last", last)
        .where((starts < F.col("_target")) & ((F.col("_end") >= F.col("_target")) | F.col("_last")))
        .withColumn("_below", starts)
    )
