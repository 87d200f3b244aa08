"""Repeated passages by sparse suffix arrays.

Of all suffixes of all texts only those at minimiser positions are kept: the position
whose words hash lowest in every window, which depends on the words alone, so equal
passages keep equal suffixes. Sorted by content, equal passages are neighbours; each
suffix is compared with its neighbours and the match extended to both sides.

The sort is a range partitioning, with ties dealt out over as many tasks as needed.
Suffixes that begin alike are resolved inside their partition, a large group of them
piece by piece; groups at the edges of partitions and pieces are finished by window
hashes across all of them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from revlens.llm.bitmaps import bitmap, passes
from revlens.llm.text import alnum_words, long_lists, piecewise, slices, small_batches, utf8
from revlens.sources.tables import keep

#: Words that a minimiser hashes, and that the suffixes of one group have in common.
GRAM = 8
#: Suffixes of one group that a task compares at once, with at most as many more.
_PIECE = 4096
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def word_hashes(text: str | bytes | None) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in alnum_words(text)], np.uint64)


def _mixed(total: np.ndarray, following: np.ndarray) -> np.ndarray:
    total = (total ^ following) * _ODD
    return total ^ (total >> _SHIFT)


def grams(words: np.ndarray) -> np.ndarray:
    n = len(words) - GRAM + 1
    total = np.zeros(max(0, n), np.uint64)
    for k in range(GRAM if n > 0 else 0):
        total = _mixed(total, words[k : k + n])
    return total


def anchors(keys: np.ndarray, least: int) -> np.ndarray:
    """Positions with the lowest hash (the first of equals) of any window of ``least`` words."""
    window = least - GRAM + 1
    if len(keys) < window:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(keys, window)
    return np.unique(views.argmin(1) + np.arange(len(views)))


def _bytes(rows: list[np.ndarray]) -> list[bytes]:
    """Word hashes as 32 bits each, in an order that sorts as bytes."""
    return [(r >> np.uint64(32)).astype(">u4").tobytes() for r in rows]


def find(
    docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Passages of ``least`` words or more that occur twice or more, one row per input row.

    Columns: the id, ``n_words``, ``n_repeated`` (words inside any repeated stretch of
    ``least`` words) and ``spans`` (such stretches merged, in words, end exclusive).
    Words are lower-cased runs of letters and digits. The second place may be in the
    same text, in another or in a copy; null, empty and shorter texts have none. Copies
    of a text count as places but are searched once. Words are compared by 64-bit
    hashes, beyond the first eight of a suffix by 32 bits of them.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).withColumn(
        "_row", F.xxhash64(F.col("_id"), F.xxhash64("_text"))
    )

    with small_batches(docs.sparkSession):
        members, marked = _searched(rows, least)
    none = F.array().cast("array<struct<start:int,stop:int>>")
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return (
        members.join(marked, "class", "left")
        .withColumn("spans", F.coalesce("spans", none))
        .select(F.col("_id").alias(id_col), F.col("n").alias("n_words"), total.alias("n_repeated"), "spans")
    )


def _looked(texts: pa.Array, least: int) -> pa.Array:
    """Per text how many words it has, a digest of them and its keys."""
    sizes, same, found = [], [], []
    for text in utf8(texts):
        words = word_hashes(text)
        keys = grams(words)
        sizes.append(len(words))
        same.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest() if len(words) else None)
        found.append(keys[anchors(keys, least)])
    columns = [pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), long_lists(found)]
    return pa.StructArray.from_arrays(columns, names=["n", "class", "keys"])


def _searched(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Every row with its number of words and its class, and the classes with repeated words
    with their spans."""

    def look(texts: pa.Array) -> pa.Array:
        return _looked(texts, least)

    look = F.arrow_udf(piecewise(look), "n long, class binary, keys array<long>")
    members = keep(rows.select("_id", "_row", look("_text").alias("_l")).select("_id", "_row", "_l.*"))
    classes = keep(
        members.where(F.col("n") >= least)
        .groupBy("class")
        .agg(
            F.min("_row").alias("row"),
            F.count("*").alias("copies"),
            F.first("n").alias("n"),
            F.first("keys").alias("keys"),
        )
    )
    keyed = classes.select("row", F.explode("keys").alias("key"))
    twice = keep(keyed.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key"))
    searched = keyed.join(twice, "key", "left_semi").select("row").distinct()
    suffixes = keep(_suffixes(rows, searched, twice, least))
    # Equal suffixes are told apart by their place, so a passage found everywhere is still
    # dealt out evenly.
    order = ["key", "right", "left", "row", "pos"]
    ranged = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = keep(ranged.mapInPandas(_matcher(least), "row long, start int, stop int, hash long"))
    at_edges = found.where("hash is not null")
    again = (
        at_edges.groupBy("hash")
        .agg(F.sum(F.when(F.col("row").isNull(), 2).otherwise(1)).alias("times"))
        .where("times > 1")
        .select("hash")
    )
    stretches = (
        found.where("hash is null")
        .select("row", "start", "stop")
        .unionByName(
            at_edges.where("row is not null").join(again, "hash", "left_semi").select("row", "start", "stop")
        )
    )
    # At most one entry per anchor and side, so bounded by the length of one text.
    merged = stretches.groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("all"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("stop")))
    searched = classes.select("class", "row", "copies", F.col("n").alias("size")).join(merged, "row", "left")
    marked = (
        searched.withColumn("n", F.col("size"))
        .withColumn("all", F.when(F.col("copies") > 1, whole).otherwise(F.col("all")))
        .where("all is not null")
        .select("class", _unions("all").alias("spans"))
    )
    return members, keep(marked)


def _unions(stretches: str) -> Column:
    """Stretches with those that touch or overlap made one, in order."""
    union = F.arrow_udf(piecewise(_merged), "array<struct<start:int,stop:int>>")
    return union(F.array_sort(stretches))


def _merged(rows: pa.Array) -> pa.Array:
    """The same for rows of sorted stretches."""
    ends = np.cumsum([0, *rows.value_lengths().to_pylist()])
    all_ = rows.flatten()
    start, stop = (all_.field(name).to_numpy().astype(np.int64) for name in ("start", "stop"))
    # Each row has numbers of its own, so its first stretch begins beyond all before it.
    row = np.repeat(np.arange(len(rows), dtype=np.int64) << 32, np.diff(ends))
    reach = np.maximum.accumulate(row + stop)
    new = np.concatenate(([True], (row + start)[1:] > reach[:-1])) if len(row) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1 if len(first) else first
    stop = (reach - row)[last].astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(start[first].astype(np.int32)), pa.array(stop)], names=["start", "stop"]
    )
    counts = np.concatenate(([0], np.cumsum(new)))[ends].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(counts), spans)


def _suffixes(rows: DataFrame, searched: DataFrame, twice: DataFrame, least: int) -> DataFrame:
    """The kept suffixes whose first words occur elsewhere, with the words on both sides.

    ``right`` has the words after the first eight, ``left`` those before, nearest first.
    """
    context = rows.sparkSession.sparkContext
    wanted = context.broadcast((bitmap(keep(searched), "row"), bitmap(twice, "key")))
    side = least - GRAM

    def cut(batches):
        in_rows, in_keys = wanted.value
        for batch in batches:
            for part in slices(batch):
                numbers = part.column("_row").to_numpy()
                part = part.filter(pa.array(passes(in_rows, numbers.view(np.uint64))))
                rows, places, found, right, left = [], [], [], [], []
                for row, text in zip(part.column("_row").to_pylist(), utf8(part.column("_text"))):
                    words = word_hashes(text)
                    keys = grams(words)
                    at = anchors(keys, least)
                    at = at[passes(in_keys, keys[at])]
                    rows.append(np.full(len(at), row, np.int64))
                    places.append(at)
                    found.append(keys[at])
                    right += _bytes([words[p + GRAM : p + least] for p in at])
                    left += _bytes([words[max(0, p - side) : p][::-1] for p in at])
                if right:
                    columns = [
                        pa.array(np.concatenate(rows)),
                        pa.array(np.concatenate(places).astype(np.int32)),
                        pa.array(np.concatenate(found).view(np.int64)),
                        pa.array(right, pa.binary()),
                        pa.array(left, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "pos", "key", "right", "left"])

    return rows.select("_row", "_text").mapInArrow(
        cut, "row long, pos int, key long, right binary, left binary"
    )


class _Group:
    """Suffixes that begin with the same eight words, in sorted order."""

    def __init__(self, frame: pd.DataFrame, least: int):
        self.least, side = least, least - GRAM
        self.row = frame["row"].to_numpy()
        self.pos = frame["pos"].to_numpy(np.int64)
        self.right, self.n_right = self._words(frame["right"], side)
        self.left, self.n_left = self._words(frame["left"], side)

    @staticmethod
    def _words(sides: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray]:
        length = sides.map(len).to_numpy() // 4
        padded = b"".join(s.ljust(4 * width, b"\0") for s in sides)
        return np.frombuffer(padded, ">u4").reshape(len(sides), width), length

    @staticmethod
    def _common(words: np.ndarray, length: np.ndarray) -> np.ndarray:
        """How many words neighbours have in common."""
        same = np.logical_and.accumulate(words[1:] == words[:-1], axis=1).sum(1)
        return np.minimum(same, np.minimum(length[1:], length[:-1]))

    def matches(self, same_key: np.ndarray):
        """Stretches found by comparing neighbours; per suffix the longest match to the right
        and the largest left reach among the neighbours that have that longest match."""
        right = GRAM + self._common(self.right, self.n_right)
        left = self._common(self.left, self.n_left)
        good = same_key & (left + right >= self.least)
        n = len(self.row)
        longest, reach = np.zeros(n, np.int64), np.full(n, -1)
        row, start, stop = [], [], []
        sides = (slice(0, n - 1), slice(1, n))
        for mine in sides:
            longest[mine] = np.maximum(longest[mine], np.where(same_key, right, 0))
            row.append(self.row[mine][good])
            start.append((self.pos[mine] - left)[good])
            stop.append((self.pos[mine] + right)[good])
        for mine in sides:
            # A neighbour with less to the right says nothing about the words beyond.
            reach[mine] = np.maximum(reach[mine], np.where(good & (right == longest[mine]), left, -1))
        return np.concatenate(row), np.concatenate(start), np.concatenate(stop), longest, reach

    def windows(self, at: np.ndarray, longest: np.ndarray, key: int):
        """(suffix, words to the left, hash) of the windows that may occur twice."""
        left, right = self._sums(self.left[at]), self._sums(self.right[at])
        side = self.least - GRAM
        reach = np.arange(side + 1)
        possible = (reach <= self.n_left[at][:, None]) & (
            self.least - reach <= np.minimum(longest, GRAM + self.n_right[at])[:, None]
        )
        hashes = _mixed(_mixed(left, right[:, ::-1]), np.uint64(key & 0xFFFFFFFFFFFFFFFF) + reach.astype(np.uint64))
        which, reached = np.nonzero(possible)
        return at[which], reached, hashes[which, reached]

    @staticmethod
    def _sums(words: np.ndarray) -> np.ndarray:
        """Hashes of the first 0, 1, … words."""
        total = np.ones((len(words), words.shape[1] + 1), np.uint64)
        for k in range(words.shape[1]):
            total[:, k + 1] = _mixed(total[:, k], words[:, k].astype(np.uint64))
        return total


def _matcher(least: int, piece: int = _PIECE):
    """For one sorted partition: repeated stretches, and at its edges hashes to be counted.

    A group of more than ``piece`` rows is cut; a cut is an edge like those of the partition.
    """

    def match(frames):
        held, first = None, True
        for frame in (f.iloc[at : at + piece] for f in frames for at in range(0, len(f), piece)):
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            keys = held["key"].to_numpy()
            if keys[0] != keys[-1]:
                begins = np.flatnonzero(keys[1:] != keys[:-1])[-1] + 1
                yield _matched(held.iloc[:begins], least, first, False)
                held, first = held.iloc[begins:], False
            if len(held) >= piece:
                yield _matched(held, least, first, True)
                held, first = None, True
        if held is not None:
            yield _matched(held, least, first, True)

    return match


def _matched(frame: pd.DataFrame, least: int, first: bool, last: bool) -> pd.DataFrame:
    """Stretches, then window hashes, of sorted suffixes; ``first`` and ``last`` tell whether
    the first and last group may go on beyond them."""
    group = _Group(frame, least)
    keys = frame["key"].to_numpy(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    stops = np.append(starts[1:], len(keys))
    row, start, stop, longest, reach = group.matches(keys[1:] == keys[:-1])
    stretches, singles, known = [(row, start, stop)], [], []
    # Nothing is known of the neighbours that the outermost suffixes have elsewhere; all others have
    # theirs here, and nobody shares more to the right with them.
    if first:
        longest[0] = least
    if last:
        longest[-1] = least
    # Fully confirmed: one neighbour has as much to the left as a window takes, and nobody more to
    # the right.
    side = least - GRAM
    for a, b in zip(starts.tolist(), stops.tolist()):
        edge = (first and a == 0) or (last and b == len(keys))
        open_ = reach[a:b] < np.minimum(group.n_left[a:b], side)
        if not edge and (b - a < 3 or not open_.any()):
            continue
        at = np.arange(a, b)
        which, reached, hashes = group.windows(at, longest[a:b], int(keys[a]))
        _, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
        again = times[back] > 1
        # All windows hold the first words, so those met again are one stretch per suffix.
        met, inverse = np.unique(which[again], return_inverse=True)
        nearest, farthest = np.full(len(met), least), np.zeros(len(met), np.int64)
        np.minimum.at(nearest, inverse, reached[again])
        np.maximum.at(farthest, inverse, reached[again])
        place = group.pos[met]
        stretches.append((group.row[met], place - farthest, place - nearest + least))
        if edge:
            # Others may hold what is met once here; what is met twice stands for itself.
            begin = (group.pos[which] - reached)[~again]
            singles.append((group.row[which[~again]], begin, begin + least, hashes[~again].view(np.int64)))
            known.append(np.unique(hashes[again]).view(np.int64))
    return _found(stretches, singles, known)


def _found(stretches: list[tuple], singles: list[tuple], known: list[np.ndarray]) -> pd.DataFrame:
    """One frame: stretches, which have no hash, windows met once, and hashes of others alone."""
    counts = [sum(len(x[0]) for x in part) for part in (stretches, singles)]
    counts.append(sum(map(len, known)))
    kind = np.repeat([0, 1, 2], counts)

    def column(at: int, dtype: type) -> pd.arrays.IntegerArray:
        parts = [np.zeros(counts[0], dtype)] if at == 3 else [x[at] for x in stretches]
        parts += [x[at] for x in singles]
        parts += known if at == 3 else [np.zeros(counts[2], dtype)]
        return pd.arrays.IntegerArray(np.concatenate(parts).astype(dtype), kind == (0 if at == 3 else 2))

    return pd.DataFrame(
        {"row": column(0, np.int64), "start": column(1, np.int32), "stop": column(2, np.int32),
         "hash": column(3, np.int64)}
    )
