"""Byte-level BPE: encoding with a hierarchical-bitmap rank queue, and decoding.

Every pre-token is a linked list of byte pieces. A queue holds the pairs that may merge:
one bucket of list positions per merge rank, and above the buckets a bitmap in two
levels, so that find-first-set on the upper level and then on one lower word gives the
next rank without a heap over all pairs. A merge leaves entries of its neighbours behind
in their old buckets; an entry counts only if its position still has that bucket's rank.
A pre-token of any length takes time in proportion to its length (times the logarithm of
the entries of one bucket), as a run of one character needs.

The vocabulary is read on the driver from a file that the caller names, and broadcast;
its size is checked against ``MOST_BYTES``.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens.llm.text import utf8

#: Largest vocabulary file that is broadcast.
MOST_BYTES = 64 << 20
#: Pre-tokens in a generation of what a worker remembers, and the longest of them. A full generation
#: becomes the older of two, and what is asked for again moves into the new one.
_REMEMBERED, _REMEMBERED_LENGTH = 1 << 19, 32
_WORD_BITS = 8
_WORD = 1 << _WORD_BITS
_LAST = _WORD - 1


class Vocabulary:
    """Ranks of byte strings (which are their ids) and the pattern that cuts pre-tokens."""

    def __init__(self, rank_file: bytes, pattern: str):
        lines = (line.split() for line in rank_file.splitlines())
        self.ranks = {base64.b64decode(piece): int(rank) for piece, rank in lines}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary has no rank for {len(missing)} of the 256 bytes")
        size = max(self.ranks.values()) + 1
        pieces = [b""] * size
        for piece, rank in self.ranks.items():
            pieces[rank] = piece
        # All pieces in one run of bytes, by rank, and where each begins and how long it is.
        self._bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._sizes = np.array([len(p) for p in pieces], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self.cut = regex.compile(pattern).findall
        # The queue: a bucket per rank, a bitmap of the buckets in use, and above it, held by
        # the merge itself, a bitmap of the words that have a bit.
        self._buckets: list[list[int] | None] = [None] * size
        self._words = [0] * ((size >> _WORD_BITS) + 1)
        self._bit = [1 << i for i in range(max(_WORD, len(self._words)))]
        # Plain dictionaries of strings and bytes, which Python's garbage collector does not walk.
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def merge(self, said: bytes) -> list[int]:
        """Ids of one pre-token: lowest rank first, the leftmost of equal ranks.

        Pushing is written out in its three places, as calls would take most of the time.
        """
        get = self.ranks.get
        whole = get(said)
        if whole is not None:
            return [whole]
        buckets, words, bit = self._buckets, self._words, self._bit
        size, top = len(said), 0
        # Piece i starts at byte i; positions `size` and beyond stand for the end.
        after = list(range(1, size + 2))
        before = list(range(-1, size + 1))
        rank_at = [get(said[i : i + 2]) for i in range(size - 1)]
        rank_at += (None, None)
        for i, rank in enumerate(rank_at):
            if rank is not None:
                bucket = buckets[rank]
                if bucket is None:
                    buckets[rank] = [i]
                    word = rank >> _WORD_BITS
                    words[word] |= bit[rank & _LAST]
                    top |= bit[word]
                else:
                    bucket.append(i)  # from left to right, so already a heap
        while top:
            # Find-first-set on the upper level, then on the word it names.
            word = (top & -top).bit_length() - 1
            bits = words[word]
            others = bits & (bits - 1)
            rank = (word << _WORD_BITS) + (bits ^ others).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) == 1:
                i = bucket[0]
                buckets[rank] = None
                words[word] = others
                if not others:
                    top &= top - 1
            else:
                i = heapq.heappop(bucket)
            if rank_at[i] != rank:
                continue  # stale: that pair is gone
            gone = after[i]
            right = after[gone]
            after[i] = right
            before[right] = i
            rank_at[gone] = None
            rank_at[i] = rank = get(said[i : after[right]]) if right < size else None
            if rank is not None:
                bucket = buckets[rank]
                if bucket is None:
                    buckets[rank] = [i]
                    word = rank >> _WORD_BITS
                    words[word] |= bit[rank & _LAST]
                    top |= bit[word]
                else:
                    heapq.heappush(bucket, i)
            left = before[i]
            if left >= 0:
                rank_at[left] = rank = get(said[left:right])
                if rank is not None:
                    bucket = buckets[rank]
                    if bucket is None:
                        buckets[rank] = [left]
                        word = rank >> _WORD_BITS
                        words[word] |= bit[rank & _LAST]
                        top |= bit[word]
                    else:
                        heapq.heappush(bucket, left)
        ids, i = [], 0
        while i < size:
            end = after[i]
            ids.append(get(said[i:end]))
            i = end
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        cut = self.cut(text)
        found = list(map(self._known.get, cut))
        if None in found:
            found = [self._remembered(said) if ids is None else ids for said, ids in zip(cut, found)]
        return np.frombuffer(b"".join(found), np.int32)

    def _remembered(self, said: str) -> bytes:
        """Ids of a pre-token, as bytes; those of short ones are remembered for two generations."""
        ids = self._known.get(said) or self._older.get(said)
        if ids is None:
            ids = array("i", self.merge(said.encode("utf-8", "replace"))).tobytes()
        if len(said) <= _REMEMBERED_LENGTH:
            if len(self._known) >= _REMEMBERED:
                self._older, self._known = self._known, {}
            self._known[said] = ids
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the pieces, one after the other."""
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0)
        return self._bytes[places + np.repeat(self._starts[ids] - (ends - sizes), sizes)].tobytes()


class Codec:
    """Encoding and decoding of columns with one vocabulary.

    ``path`` is read here, on the driver; tasks get the broadcast file and parse it once
    per Python worker.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            held = file.read(MOST_BYTES + 1)
        if len(held) > MOST_BYTES:
            raise ValueError(f"{path} is larger than {MOST_BYTES} bytes, the most that is broadcast")
        Vocabulary(held, pattern)  # a file that can't be used fails here, not in a task
        self._shared = spark.sparkContext.broadcast((held, pattern))

    def encode(self, text: Column) -> Column:
        """Ids of a text, an array; a null text is an empty one."""
        return self._mapped(text, "array<int>", _ids)

    def round_trip(self, text: Column) -> Column:
        """``struct<ids, decoded>``: the ids of a text, and the bytes that these ids stand for,
        in one crossing to Python."""

        def both(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
            ids = _ids(vocabulary, texts)
            return pa.StructArray.from_arrays([ids, _bytes(vocabulary, ids)], names=["ids", "decoded"])

        return self._mapped(text, "struct<ids:array<int>,decoded:binary>", both)

    def decode(self, ids: Column) -> Column:
        """The bytes that an array of ids stands for; none for a null array. An id outside
        the vocabulary, or a null one, fails the job."""
        listed = F.coalesce(ids, F.array().cast("array<int>"))
        return self._mapped(listed, "binary", _bytes)

    def _mapped(self, column: Column, ddl: str, function: Callable[[Vocabulary, pa.Array], pa.Array]) -> Column:
        shared = self._shared

        def mapped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = _vocabulary(shared)
            for batch in batches:
                yield function(vocabulary, batch)

        # The hints are set here, as the module's own are text.
        mapped.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(mapped, ddl)(column)


_parsed: dict[tuple[bytes, str], Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """The worker's own copy, parsed once."""
    if shared.value not in _parsed:
        _parsed.clear()
        _parsed[shared.value] = Vocabulary(*shared.value)
    return _parsed[shared.value]


def _ids(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    rows = [vocabulary.encode((t or b"").decode("utf-8", "replace")) for t in utf8(texts)]
    ends = np.cumsum([0, *map(len, rows)])
    ids = np.concatenate([np.empty(0, np.int32), *rows])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))


def _bytes(vocabulary: Vocabulary, lists: pa.Array) -> pa.Array:
    """Text by text, so that only one is spread out over places at a time."""
    ids, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    texts = [vocabulary.decode(ids[start:end]) for start, end in zip(ends, ends[1:])]
    return pa.array(texts, pa.binary())


def encoded(
    docs: DataFrame,
    codec: Codec,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: tuple[str, ...] = (),
    decoded: bool = False,
) -> DataFrame:
    """The id, the ``carried`` columns and ``ids``, the tokens of the whole text, for every row.

    With ``decoded`` also the bytes that the ids stand for, which are the text's UTF-8.
    One narrow pass, no shuffle. A null or empty text has no tokens; repeated rows stay;
    other columns are left out, whatever their names.
    """
    text = F.col(text_col)
    found = codec.round_trip(text) if decoded else F.struct(codec.encode(text).alias("ids"))
    rows = docs.select(
        F.col(id_col).alias("_id"), *[F.col(c).alias(f"_carried_{c}") for c in carried], found.alias("_found")
    )
    return rows.select(
        F.col("_id").alias(id_col), *[F.col(f"_carried_{c}").alias(c) for c in carried], "_found.*"
    )


def decoded(tokens: DataFrame, codec: Codec, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids of a token table stand for; null ids stand for none."""
    return tokens.withColumn(out, codec.decode(F.col(ids_col)))
