"""N-gram Jaccard join by filters under several global token orders.

Two sets that overlap enough share tokens among their first ones under any order of
all tokens. The first order puts tokens that a sample found frequent last; its prefixes
are joined, and pairs must share as many prefix tokens as the bound asks. What remains
must also share a prefix token under a second order, and is then verified on the
whole sets.

Documents with equal sets are one class and are joined once. A large group of similar
classes is not compared pair by pair: its members are verified against one of them
first, and only classes that are still in different components are paired at all, so
no link between components is missed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from revlens.llm.bitmaps import bitmap, passes, without
from revlens.llm.components import connected
from revlens.llm.text import (
    long_lists, piecewise, separate_operators, slices, small_batches, spaced_words, utf8,
)
from revlens.sources.tables import keep

#: Frequent tokens that the orders know; they come from one text in ``_SAMPLED``. Both
#: only decide the order of tokens, never a result.
_FREQUENT = 100_000
_SAMPLED = 16
_LEAST_SEEN = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; all words if fewer."""
    words = spaced_words(text)
    if not words:
        return np.empty(0, np.uint64)
    size = min(width, len(words))
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = (total ^ each[k : k + n]) * _ODD
        total ^= total >> np.uint64(29)
    return np.unique(total)


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


class Orders:
    """Global orders: by frequency as sampled, then by a hash of the token."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        at = np.argsort(tokens)
        self.tokens, self.counts = tokens[at], counts[at]

    def prefix(self, tokens: np.ndarray, percent: int, second: bool = False) -> np.ndarray:
        """The first tokens of a set under one of the orders, in that order."""
        seen = np.zeros(len(tokens), np.int64)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            seen = np.where(self.tokens[at] == tokens, self.counts[at], 0)
        mixed = tokens * _SECOND if second else tokens
        mixed = mixed ^ (mixed >> np.uint64(32)) if second else mixed
        first = np.lexsort((mixed, seen))[: prefix_length(len(tokens), percent)]
        return tokens[first]


def orders(rows: DataFrame, width: int) -> Orders:
    """Token frequencies among a hash sample of the texts, the most frequent ones only."""

    def tokens(batches):
        for batch in batches:
            for part in slices(batch):
                found = [shingles(t, width) for t in utf8(part.column("_text"))]
                values = pa.array(np.concatenate(found).view(np.int64))
                yield pa.RecordBatch.from_arrays([values], names=["t"])

    sample = rows.where(F.pmod(F.xxhash64("_text", F.lit(1)), F.lit(_SAMPLED)) == 0).select("_text")
    found = (
        sample.mapInArrow(tokens, "t long")
        .groupBy("t")
        .count()
        .where(F.col("count") >= _LEAST_SEEN)
        .orderBy(F.col("count").desc(), "t")
        .limit(_FREQUENT)
        .toPandas()
    )
    return Orders(found["t"].to_numpy(np.int64).view(np.uint64), found["count"].to_numpy(np.int64))


def _prefix_length(n: Column, percent: int) -> Column:
    return n - F.ceil(percent * n / 100) + 1


def _needed(n: Column, m: Column, percent: int) -> Column:
    """The overlap that a link needs: the smallest whole number that reaches the share."""
    return F.floor((percent * (n + m) + (99 + percent)) / (100 + percent)).cast("long")


def _shared_needed(n: Column, m: Column, percent: int) -> Column:
    """How many tokens the two prefixes of a linked pair share at least."""

    spare = F.least(_prefix_length(n, percent) - n, _prefix_length(m, percent) - m)
    return (spare + _needed(n, m, percent)).cast("long")


def _possible(x: str, y: str, percent: int) -> Column:
    """Sizes near enough, the token early enough in both sets, and both sets with enough
    tokens that any other set has in its prefix."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    need, shared = _needed(n, m, percent), _shared_needed(n, m, percent)
    near = (100 * n >= percent * m) & (100 * m >= percent * n)
    early = (F.col(f"{x}.pos") < n - need + shared) & (F.col(f"{y}.pos") < m - need + shared)
    return near & early & (F.least(F.col(f"{x}.met"), F.col(f"{y}.met")) >= shared)


def _sharing_enough(meetings: DataFrame, percent: int) -> DataFrame:
    """Pairs (``c``, ``d``) with their sizes that meet in as many tokens as a link needs.

    A pair may meet in either order; it is counted as one.
    """
    one, other = F.struct("x.c", "x.n"), F.struct("y.c", "y.n")
    return (
        meetings.select(F.least(one, other).alias("one"), F.greatest(one, other).alias("other"))
        .groupBy("one", "other")
        .agg(F.count("*").alias("shared"))
        .select("one.c", "one.n", F.col("other.c").alias("d"), F.col("other.n").alias("m"), "shared")
        .where(F.col("shared") >= _shared_needed(F.col("n"), F.col("m"), percent))
    )


def join(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Components of near duplicates, one row per input row.

    Columns: the id, ``n_shingles`` (size of the set), ``component_id`` (the smallest id that
    links reach, the row's own included), ``keeper`` (true for one row of each component, one
    with that id) and the ``carried`` columns. Two texts are linked if their sets of ``width``-word
    shingles have ``100 * intersection >= percent * union``. A text with fewer words is one
    shingle; a null or empty one has none, is linked with nothing and is its own
    component. Null ids count for links, but name a component only if it has no other
    id. Shingles are compared by 64-bit hashes.
    """
    names = [f"_carried_{c}" for c in carried]
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
        *[F.col(c).alias(n) for c, n in zip(carried, names)],
    ).withColumn("_row", F.xxhash64(F.col("_id"), F.xxhash64("_text")))
    with small_batches(docs.sparkSession), separate_operators(docs.sparkSession):
        members, labels = _labelled(rows, names, width, percent)
    return members.join(labels, "class", "left").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("_id")).otherwise(F.col("component")).alias("component_id"),
        _keeper().alias("keeper"),
        *[F.col(n).alias(c) for c, n in zip(carried, names)],
    )


def keepers(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """The rows that ``join`` marks as keepers, as the id, the text and the ``carried`` columns.

    No text is written; the texts are read again and joined with what goes. Rows are told apart by
    64-bit hashes of these columns; of rows equal in all of them that have words, one stays at most.
    """
    given = [id_col, text_col, *(c for c in carried if c not in (id_col, text_col))]
    rows = docs.select(
        F.xxhash64(*[F.xxhash64(c) for c in given]).alias("_row"),
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
        *[F.col(c).alias(f"_carried_{c}") for c in given[2:]],
    )
    with small_batches(docs.sparkSession), separate_operators(docs.sparkSession):
        members, labels = _labelled(rows, [], width, percent)
    marked = members.select("_row", "_m", "class").join(labels, "class", "left")
    counts = marked.groupBy("_row").agg(F.count_if(_keeper()).alias("stay"), F.count("*").alias("rows"))
    going = keep(counts.where("stay < rows").select("_row", "stay"))
    # Of a keeper that is repeated only one row stays; Spark shuffles the rows once for both joins.
    one = rows.join(going.where("stay > 0"), "_row", "left_semi").dropDuplicates(["_row"])
    return rows.join(going, "_row", "left_anti").unionByName(one).select(
        F.col("_id").alias(id_col), F.col("_text").alias(text_col),
        *[F.col(f"_carried_{c}").alias(c) for c in given[2:]],
    )


def _keeper() -> Column:
    return F.col("class").isNull() | (F.col("_m") == F.col("_first"))


def _looked(texts: pa.Array, known: Orders, width: int, percent: int) -> pa.Array:
    """Per text the size of its set, a digest of it and its prefix."""
    sizes, same, prefixes = [], [], []
    for text in utf8(texts):
        tokens = shingles(text, width)
        sizes.append(len(tokens))
        same.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
        prefixes.append(known.prefix(tokens, percent) if len(tokens) else tokens)
    columns = [pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), long_lists(prefixes)]
    return pa.StructArray.from_arrays(columns, names=["n", "class", "prefix"])


def _labelled(
    rows: DataFrame, names: list[str], width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Every row, without its text but with the columns ``names``, its number ``_m`` and its
    class; and per class its component's id and the number of the row to keep."""
    known = rows.sparkSession.sparkContext.broadcast(orders(rows, width))

    def look(texts: pa.Array) -> pa.Array:
        return _looked(texts, known.value, width, percent)

    look = F.arrow_udf(piecewise(look), "n long, class binary, prefix array<long>")
    looked = rows.select("_id", "_row", *names, look("_text").alias("_l"))
    # The number of a kept row stays what it is and tells repeated rows apart.
    members = keep(looked.select("_id", "_row", *names, F.monotonically_increasing_id().alias("_m"), "_l.*"))
    classes = keep(
        members.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("_id").alias("first_id"),
            F.min(F.struct(F.col("_id").isNull(), "_id", "_m")).alias("head"),
            F.min("_row").alias("row"),
            F.first("n").alias("n"),
        )
        .withColumn("c", F.col("head._m"))
    )
    entries, hubs = _entries(members, classes, percent)
    # Every class against the hub of its group.
    stars = entries.join(hubs, "t").select(F.struct("c", "n", "pos", "met").alias("x"), F.col("hub").alias("y"))
    stars = stars.where((F.col("x.c") != F.col("y.c")) & _possible("x", "y", percent))
    pairs = keep(_sharing_enough(stars, percent))
    roots = connected(_verified(pairs, classes, rows, known, width, percent))

    # Then what is in other components than those of their groups, against the groups.
    rooted = _rooted(entries, hubs, roots)
    strangers = keep(rooted.where("root != hub_root"))
    group = rooted.join(strangers.select("t").distinct(), "t", "left_semi")
    rest = (
        strangers.alias("x")
        .join(group.alias("y"), "t")
        .where(
            (F.col("x.root") != F.col("y.root"))
            & ((F.col("y.root") == F.col("y.hub_root")) | (F.col("x.c") < F.col("y.c")))
            & _possible("x", "y", percent)
        )
    )
    pairs = keep(_sharing_enough(rest, percent))
    # These links are between components, which are the nodes from here on.
    root_of = {e: roots.select(F.col("node").alias(e), F.col("root").alias(f"root_{e}")) for e in "ab"}
    links = _verified(pairs, classes, rows, known, width, percent)
    links = links.join(root_of["a"], "a", "left").join(root_of["b"], "b", "left")
    joined = connected(
        links.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    )
    named = classes.select("class", "first_id", "head", "c").join(roots, F.col("c") == F.col("node"), "left")
    named = named.withColumn("part", F.coalesce("root", "c")).drop("node", "root")
    named = named.join(joined, F.col("part") == F.col("node"), "left")
    named = named.withColumn("root", F.coalesce("root", "part"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component"), F.min("head").alias("first"))
    labels = keep(named.drop("head").join(least, "root").select("class", "component", "first._m"))
    return members, labels.withColumnRenamed("_m", "_first")


def _entries(members: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Prefix tokens that two classes or more have: token, class, size, place and ``met``, how many
    such tokens the class has; and per token the hub of its group.

    The hub is the class with the fewest prefix tokens of its own: what the others are
    copies of, if anything is. Only what is read again is written, and each of it once.
    A class goes by the number of its head, so no prefix is shuffled but those of copies.
    """
    others = members.select("class", "_m").join(classes.select("class", "c"), "class").where("_m != c")
    heads = without(members.select("_m", "n", "prefix"), "_m", keep(others.select("_m")))
    rows = heads.select(F.col("_m").alias("c"), "n", F.posexplode("prefix").alias("pos", "t"))
    groups = rows.groupBy("t").agg(F.count("*").alias("size")).where("size > 1").select("t")
    # A class has as many entries as its prefix has tokens, so no window is large.
    met = F.count("*").over(Window.partitionBy("c"))
    entries = keep(rows.join(groups, "t").withColumn("met", met))
    alone = (_prefix_length(F.col("n"), percent) - F.col("met")).alias("alone")
    hub = F.min(F.struct(alone, "c", "n", "pos", "met")).alias("hub")
    return entries, keep(entries.groupBy("t").agg(hub))


def _rooted(entries: DataFrame, hubs: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries with the component of their class and of their group's hub."""
    own = roots.select(F.col("node").alias("c"), "root")
    of_hub = roots.select(F.col("node").alias("h"), F.col("root").alias("hub_root"))
    groups = hubs.select("t", F.col("hub.c").alias("h")).join(of_hub, "h", "left")
    groups = groups.select("t", F.coalesce("hub_root", "h").alias("hub_root"))
    return (
        entries.join(own, "c", "left")
        .withColumn("root", F.coalesce("root", "c"))
        .join(groups, "t")
        .select("t", "c", "n", "pos", "met", "root", "hub_root")
    )


def _verified(
    pairs: DataFrame, classes: DataFrame, rows: DataFrame, known, width: int, percent: int
) -> DataFrame:
    """Links (``a``, ``b``) among pairs (``c``, ``d``) that share a prefix token under the second
    order and whose sets overlap enough. Only the sets of paired classes are made."""
    nodes = pairs.select("c").unionByName(pairs.select(F.col("d").alias("c"))).distinct()
    wanted = keep(classes.select("c", "row").join(nodes, "c", "left_semi"))
    words = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, "row"))

    def sets(batches):
        for batch in batches:
            for part in slices(batch):
                hashes = part.column("_row").to_numpy().view(np.uint64)
                part = part.filter(pa.array(passes(words.value, hashes)))
                if not len(part):
                    continue
                found = [shingles(t, width) for t in utf8(part.column("_text"))]
                prefixes = [known.value.prefix(s, percent, second=True) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), long_lists(found), long_lists(prefixes)],
                    names=["row", "tokens", "prefix"],
                )

    made = rows.select("_row", "_text").mapInArrow(
        sets, "row long, tokens array<long>, prefix array<long>"
    )
    # A repeated row makes its set repeatedly; one is enough.
    made = keep(
        made.join(wanted, "row")
        .groupBy("row", "c")
        .agg(F.first("tokens").alias("tokens"), F.first("prefix").alias("prefix"))
        .drop("row")
    )
    candidates = (
        pairs.join(made.select("c", F.col("prefix").alias("p")), "c")
        .join(made.select(F.col("c").alias("d"), F.col("prefix").alias("q")), "d")
        .where(F.arrays_overlap("p", "q"))
        .select("c", "d", "n", "m")
    )
    both = F.size(F.array_intersect("s", "u"))
    return (
        candidates.join(made.select("c", F.col("tokens").alias("s")), "c")
        .join(made.select(F.col("c").alias("d"), F.col("tokens").alias("u")), "d")
        .where(both >= _needed(F.col("n"), F.col("m"), percent))
        .select(F.col("c").alias("a"), F.col("d").alias("b"))
    )
