"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

The benchmark's word windows are dealt into blocks of at most ``block_windows``; each
block is one broadcast, so its size is bounded whatever the benchmark's size. Documents
are scanned in place: word windows are hashed and looked up, hits are verified word
by word, and the words inside any hit are marked.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from revlens.llm.text import alnum_words
from revlens.sources.tables import keep

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FOUND = "items array<string>, spans array<struct<start:long,end:long>>"


def windows(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(``window``, ``item``) pairs: the windows of every item, words joined by spaces."""

    def cut(frames):
        for frame in frames:
            out = []
            for item, text in zip(frame["item"], frame["text"]):
                words = alnum_words(text)
                size = min(width, len(words))
                for at in range(len(words) - size + 1 if size else 0):
                    out.append((b" ".join(words[at : at + size]).decode("utf-8", "replace"), item))
            yield pd.DataFrame(out, columns=["window", "item"])

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInPandas(cut, "window string, item string").distinct()


class Index:
    """One block of windows: word numbers, hashes by length, and the items of each window."""

    def __init__(self, pairs):
        self.items: dict[bytes, list[str]] = {}
        for window, item in pairs:
            named = self.items.setdefault(window.encode(), [])
            if item is not None:
                named.append(item)
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, list[int]] = {}
        for window in self.items:
            words = window.split(b" ")
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            by_length.setdefault(len(ids), []).append(ids)
        self.hashes = {
            size: np.unique(self._hash(np.array(rows, dtype=np.uint64).T))
            for size, rows in by_length.items()
        }

    @staticmethod
    def _hash(columns) -> np.ndarray:
        total = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            total = (total ^ column) * _ODD
            total ^= total >> np.uint64(31)
        return total

    def find(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are inside a window of this block, and the items they come from."""
        number = self.numbers.get
        ids = np.fromiter((number(w, 0) for w in words), np.uint64, len(words))
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        edges, found = np.zeros(len(words) + 1, np.int64), set()
        for size, hashes in self.hashes.items():
            if len(words) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            at = at[np.isin(self._hash([ids[at + k] for k in range(size)]), hashes)]
            for start in at.tolist():
                named = self.items.get(b" ".join(words[start : start + size]))
                if named is not None:
                    found.update(named)
                    edges[start] += 1
                    edges[start + size] -= 1
        return np.cumsum(edges[:-1]) > 0, found


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    turns = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def scan(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    block_windows: int = 200_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Marks the benchmark's passages in every document, one row per input row.

    An item's windows are its ``width`` consecutive words, or all its words if it has
    fewer. Columns: the id, ``n_words``, ``n_hit`` (words inside any occurrence),
    ``items`` (sorted ids, as strings), ``spans`` (runs of hit words, end exclusive)
    and the ``carried`` columns. Null and empty texts have no words and no hits; an
    item without words has no windows; items that share an id are one item, and an
    item without an id marks words but names nothing. Without items nothing is hit.

    A benchmark of more than ``block_windows`` (window, item) pairs is scanned block
    by block; the marks of all blocks add up.
    """
    pairs = keep(windows(items, width, item_id_col, item_text_col))
    blocks = max(1, math.ceil(pairs.count() / block_windows))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    state = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        *[F.col(c).alias(f"_carried_{c}") for c in carried],
    )
    for block in range(blocks):
        rows = pairs.where(F.col("block") == block).select("window", "item").collect()
        state = _with_block(state, Index([tuple(r) for r in rows]))
        if block + 1 < blocks:
            state = keep(state)  # so that one task holds one block
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return state.select(
        F.col("_id").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.array_sort("items").alias("items"),
        "spans",
        *[F.col(f"_carried_{c}").alias(c) for c in carried],
    )


def _with_block(state: DataFrame, index: Index) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf(f"n_words long, {_FOUND}")
    def look(text: pd.Series, items: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for said, named, marked in zip(text, items, spans):
            words = alnum_words(said)
            hit, found = shared.value.find(words)
            for span in marked:
                hit[span["start"] : span["end"]] = True
            runs = [{"start": a, "end": b} for a, b in _runs(hit)]
            out.append((len(words), sorted(found.union(named)), runs))
        return pd.DataFrame(out, columns=["n_words", "items", "spans"])

    others = [c for c in state.columns if c not in ("n_words", "items", "spans")]
    looked = state.withColumn("_look", look("_text", "items", "spans"))
    return looked.select(*others, "_look.*")
