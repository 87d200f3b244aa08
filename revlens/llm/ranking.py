"""Ranked lexical search by NRA: sorted reads only, a score interval per document.

Documents are cut into shards that one task holds at a time, each with an impact-sorted
list per term of the items. For one item the lists are read from the largest impacts
down, never by document. What has been read of a document is its lower bound; the next
unread impact of every list it was not seen in bounds the rest. Documents whose upper
bound is below the item's tenth lower bound fall out, and reading goes on until the
interval of every document left is a point, so membership, ties and scores are exact. A
task carries the item's best documents from shard to shard, whose lowest score prunes
the later ones; the best of all tasks are merged by one window per item.

Terms of the items are collected in blocks of bounded size, each broadcast once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from revlens.llm.text import alnum_words, long_lists, lower_ascii, slices, utf8
from revlens.sources.tables import keep

#: Bytes of terms, with 16 more for each, that one block of items may hold; an item with
#: more has a block of its own.
BLOCK_BYTES = 8 << 20
#: Rows and postings of one shard, and cells of its table of unseen (term, document) pairs.
SHARD_ROWS, SHARD_POSTINGS, SHARD_CELLS = 1 << 15, 1 << 21, 1 << 22
_SLICE = 256

#: Terms of a text whose A-Z are lower-cased.
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Impacts are below 10**6.
_IMPACT_BITS = 20


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``most`` best documents for every item: item id, ``rank``, the id, ``score``.

    Terms are runs of digits, letters and non-ASCII characters with A-Z lower-cased;
    the score of a document adds up weight times impact over the item's distinct terms,
    all in integers. Rows of items that share an id (or have none) are one item with the
    terms of all; items without terms, and items that no document scores above 0 for,
    have no rows. Null and empty texts have no terms. Every row of ``docs`` is a document
    of its own, so repeated rows rank side by side. Equal scores rank by id, a null id
    last. Other columns are left out. If either table is empty there are no rows.
    """
    listed = keep(_in_blocks(items, item_id_col, item_text_col, block_bytes))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = listed.select("block").distinct().collect()
    # A table without a term still has the result's columns.
    found = [_search_block(rows, listed, b, most) for b in sorted(r["block"] for r in blocks) or [0]]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    in_item = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(in_item)).where(F.col("rank") <= most)
    names = listed.select("block", "item", F.col("item_id").alias("_item_id"))
    return ranked.join(names, ["block", "item"]).select(
        F.col("_item_id").alias(item_id_col), "rank", F.col("id").alias(id_col), "score"
    )


def _in_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """``block``, ``item`` (its number in the block), ``item_id`` and its distinct ``terms``."""
    words = F.regexp_extract_all(lower_ascii(F.col(text_col)), F.lit(_TERM), F.lit(0))
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t) + 16)
    listed = keep(
        items.select(F.col(id_col).alias("item_id"), F.explode(words).alias("term"))
        .groupBy("item_id")
        .agg(F.array_sort(F.collect_set("term")).alias("terms"))
        .withColumn("size", size)
    )
    blocks = max(1, math.ceil((listed.agg(F.sum("size")).first()[0] or 0) / block_bytes))
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block")
        sizes = listed.groupBy(block).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        if not sizes.where(f"size > {2 * block_bytes} AND n > 1").count():
            break
        blocks *= 2  # hashes dealt too much to one block
    in_block = Window.partitionBy("block").orderBy("item_id")
    return listed.select(block, "item_id", "terms").select(
        "block", (F.row_number().over(in_block) - 1).cast("long").alias("item"), "item_id", "terms"
    )


@dataclass
class Corpus:
    """What scores take from all documents: how many have terms, and how many terms."""

    n_docs: int
    n_terms: int


def _search_block(rows: DataFrame, listed: DataFrame, block: int, most: int) -> DataFrame:
    """The best documents of every task, by item of one block."""
    spark = rows.sparkSession
    items = listed.where(F.col("block") == block).select("item", "terms").orderBy("item").collect()
    numbers: dict[bytes, int] = {}
    terms = [
        np.array([numbers.setdefault(t.encode(), len(numbers)) for t in r["terms"]], np.int64)
        for r in items
    ]
    postings = keep(_postings(rows, spark.sparkContext.broadcast(numbers)))
    totals = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    corpus = Corpus(totals[0], totals[1] or 0)
    weights = np.zeros(len(numbers), np.int64)
    # At most one row for every term of the block.
    for term, df in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weights[term] = math.floor(1000 * math.log((2 * corpus.n_docs + 2) / (2 * df + 1)))
    shared = spark.sparkContext.broadcast((terms, weights, corpus))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _best(batches, *shared.value, most)

    kind = rows.schema["id"].dataType.simpleString()
    return postings.mapInArrow(rank, f"item long, id {kind}, score long").withColumn("block", F.lit(block))


def _postings(rows: DataFrame, shared) -> DataFrame:
    """Per document: the id, ``n`` terms in all, and number and count of each known term."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for whole in batches:
            for batch in slices(whole):
                sizes, terms, tfs = [], [], []
                for text in utf8(batch["text"]):
                    words = alnum_words(text)
                    counts = Counter(words)
                    known = [w for w in counts if w in numbers]
                    sizes.append(len(words))
                    terms.append(np.array([numbers[w] for w in known], np.int64))
                    tfs.append(np.array([counts[w] for w in known], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch["id"], pa.array(sizes, pa.int64()), long_lists(terms), long_lists(tfs)],
                    names=["id", "n", "terms", "tfs"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tally, f"id {kind}, n long, terms array<long>, tfs array<long>")


class Shard:
    """Some documents, with the postings of every term sorted by falling impact."""

    def __init__(self, batches: list[pa.RecordBatch], n_weights: int, corpus: Corpus):
        table = pa.Table.from_batches(batches)
        self.ids = table["id"].combine_chunks()
        self.size = table.num_rows
        # Places in the order of ids, null last: ties are settled by comparing numbers.
        self.id_order = np.empty(self.size, np.int64)
        self.id_order[pc.sort_indices(self.ids).to_numpy()] = np.arange(self.size)
        per_doc = pc.list_value_length(table["terms"]).to_numpy()
        docs = np.repeat(np.arange(self.size), per_doc)
        terms = pc.list_flatten(table["terms"]).to_numpy()
        tfs = pc.list_flatten(table["tfs"]).to_numpy()
        # Python's integers, as the product can pass 64 bits in a very large corpus.
        lengths = np.array(
            [10 + 90 * n * corpus.n_docs // max(1, corpus.n_terms) for n in table["n"].to_pylist()],
            np.int64,
        )
        impacts = (10**9 * tfs) // (1000 * tfs + 8 * lengths[docs])
        order = np.argsort((terms << _IMPACT_BITS) - impacts, kind="stable")
        self.docs, self.falling = docs[order], -impacts[order]
        self.starts = np.searchsorted(terms[order], np.arange(n_weights + 1))

    def best(self, terms: np.ndarray, weights: np.ndarray, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and exact scores of at least ``least``: the ``most`` best of the shard,
        in order."""
        starts, stops = self.starts[terms], self.starts[terms + 1]
        useful = (weights[terms] > 0) & (stops > starts)
        depth, stops, weight = starts[useful], stops[useful], weights[terms[useful]]
        if not len(weight):
            return np.empty(0, np.int64), np.empty(0, np.int64)

        # The most that the next unread posting of a list can add.
        bound = -weight * self.falling[depth]
        lower = np.zeros(self.size, np.int64)
        unseen = np.ones((len(weight), self.size))
        alive, place = np.arange(self.size), None
        while True:
            level = max(1, int(bound.max()) // 2)
            for t in np.flatnonzero(bound >= level):
                start = depth[t]
                list_ = self.falling[start : stops[t]]
                end = start + np.searchsorted(list_, -(-(-level // weight[t])), side="right")
                docs, adds = self.docs[start:end], -weight[t] * self.falling[start:end]
                if place is not None:
                    docs = place[docs]
                    held = docs >= 0
                    docs, adds = docs[held], adds[held]
                lower[docs] += adds  # a document is in a list once
                unseen[t, docs] = 0
                depth[t] = end
                bound[t] = -weight[t] * self.falling[end] if end < stops[t] else 0
            open_ = bound @ unseen
            if len(lower) >= most:
                least = max(least, int(np.partition(lower, -most)[-most]))
            # A margin for the sum of floating-point bounds: only ever too many stay.
            candidate = (lower + open_) * (1 + 1e-9) >= least
            if not (open_[candidate] > 0).any():
                break
            if 2 * np.count_nonzero(candidate) < len(lower):
                lower, unseen, alive = lower[candidate], unseen[:, candidate], alive[candidate]
                place = np.full(self.size, -1)
                place[alive] = np.arange(len(alive))
        won = np.flatnonzero(lower >= least)
        won = won[np.lexsort((self.id_order[alive[won]], -lower[won]))[:most]]
        return alive[won], lower[won]


def _best(batches, items: list[np.ndarray], weights: np.ndarray, corpus: Corpus, most: int):
    """The best documents of all shards of a task, by item."""
    longest = max(map(len, items), default=1)
    rows = min(SHARD_ROWS, max(64, SHARD_CELLS // longest))
    best: list[list[tuple]] = [[] for _ in items]
    kind = None
    for batches_ in _shards(batches, rows):
        kind = batches_[0].schema.field("id").type
        shard = Shard(batches_, len(weights), corpus)
        for item, terms in enumerate(items):
            held = best[item]
            least = held[-1][0] if len(held) == most else 1
            docs, scores = shard.best(terms, weights, most, least)
            ids = shard.ids.take(pa.array(docs)).to_pylist()
            if ids:
                held = sorted([*held, *zip(scores.tolist(), ids)], key=_rank)[:most]
                best[item] = held
    if kind is not None:
        found = [(item, i, score) for item, held in enumerate(best) for score, i in held]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([x[1] for x in found], kind),
                pa.array([x[2] for x in found], pa.int64()),
            ],
            names=["item", "id", "score"],
        )


def _rank(entry: tuple) -> tuple:
    score, i = entry
    return (-score, i is None, 0 if i is None else i)


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches put together up to the bounds of a shard."""
    held, n_rows, n_postings, step = [], 0, 0, min(_SLICE, rows)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            n_rows += part.num_rows
            n_postings += pc.sum(pc.list_value_length(part["terms"])).as_py() or 0
            if n_rows >= rows or n_postings >= SHARD_POSTINGS:
                yield held
                held, n_rows, n_postings = [], 0, 0
    if held:
        yield held
