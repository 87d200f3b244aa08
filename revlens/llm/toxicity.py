"""Toxicity from the nearest labelled examples by TF-IDF cosine.

A bounded bank of labelled examples is fitted: document frequencies are those of the bank,
and a word that no example has weighs as one of frequency 0, so a text's vector, its
length and its neighbours depend on the bank and the text alone. Every word of the bank
is indexed. Words with long lists, whose bounds would pass over no block, are rows of a
dense table and multiplied for many texts at once; all others have postings in blocks of
examples with their largest weight per block. What a block can still reach is its best
sum so far and the maxima of the postings to come; only blocks that can reach the k-th
neighbour of their label are completed, so the neighbours are exact. Their similarities,
by label and as distance-weighted votes, and what the words and word beginnings shared with
them tell of the label, are calibrated to a score, and the neighbours themselves are the
evidence. The calibration is cross-fitted: it sees every example as a text whose whole fold,
neighbours and counts alike, is missing, so no label is part of what it is learned from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from revlens.llm.boosting import fit_additive, sigmoid
from revlens.llm.quality import labelled
from revlens.llm.text import alnum_words, held_out, lowest, utf8
from revlens.sources.tables import keep

#: Labelled examples per label in the bank at most, taken in the order of a hash.
BANK = 3_000
#: Words whose lists are held as dense rows, the most frequent ones.
DENSE = 512
_BLOCK = 64
#: Texts that are multiplied with the dense rows at once.
_TOGETHER = 64
#: Bounds and products are summed in different orders; no block is lost to rounding.
_SLACK = 1 + 1e-9
#: Digits of a similarity, so that the order of a sum never shows.
_DIGITS = 12
_NEAREST = 5
#: Parts of the bank for the calibration; an example belongs to one, whatever its label.
FOLDS = 10
#: Bytes of the beginnings of words that tell as words do.
_BEGINNINGS = (3, 4, 5, 6, 7)
#: How many examples must have a word or beginning, and the deviation that it must have.
_LEAST, _TELLS = 5, 0.06

Near = list[tuple[float, int]]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def _deviations(having: np.ndarray, total: np.ndarray) -> np.ndarray:
    """How far the shares of both labels that have a word differ from equal ones: the signed root
    of the mean likelihood ratio, above 0 where label 1 has it more often."""
    if not total.all():
        return np.zeros(having.shape[1])

    def entropy(p):
        return -sum(x * np.log(np.where(x > 0, x, 1)) for x in (p, 1 - p))

    share, weight = having / total[:, None], total / total.sum()
    gain = entropy(weight @ share) - weight @ entropy(share)
    return np.sign(share[1] - share[0]) * np.sqrt(np.maximum(gain, 0))


@dataclass
class Index:
    """The bank's vectors, of length 1, by word; columns are places of examples.

    The examples of a label fill blocks of their own, the last one up with empty places
    (``example`` is -1). Words are numbered by falling frequency; the first have rows in
    ``dense``. Entry ``e`` stands for another word in a block, ``first_entry[t]`` to
    ``first_entry[t + 1]`` for word t; its postings are ``first_posting[e]`` to
    ``first_posting[e + 1]``.
    """

    y: np.ndarray
    numbers: dict[bytes, int]
    idf: np.ndarray
    unknown: float
    example: np.ndarray
    place: np.ndarray
    parts: list[tuple[int, int]]
    dense: np.ndarray
    first_entry: np.ndarray
    block: np.ndarray
    highest: np.ndarray
    first_posting: np.ndarray
    places: np.ndarray
    weights: np.ndarray
    #: By their first bytes and their length, 0 for whole words, the words and beginnings that tell.
    #: Then those of every example, and by fold, the last for none, what they tell if the fold
    #: is missing.
    tellers: dict[bytes, dict[int, dict[bytes, int]]]
    own: list[np.ndarray]
    deviations: np.ndarray
    marks: np.ndarray
    mark: int = 0

    @classmethod
    def build(cls, texts: Sequence[bytes | None], y: np.ndarray, dense: int = DENSE) -> Index:
        # Texts are cut into words twice, as all their counts at once would be far larger than they.
        df = Counter()
        for text in texts:
            df.update(set(alnum_words(text)))
        numbers = {w: i for i, (w, _) in enumerate(sorted(df.items(), key=lambda x: (-x[1], x[0])))}
        counts = np.array([df[w] for w in numbers], float)
        idf = np.log((len(texts) + 1) / (counts + 1))
        rows = []
        for text in texts:
            words = Counter(alnum_words(text))
            terms = np.array([numbers[w] for w in words], np.int32)
            weights = (1 + np.log(np.array(list(words.values()), float))) * idf[terms]
            rows.append((terms, weights / (np.linalg.norm(weights) or 1.0)))

        tellers, own, deviations = _tellers(numbers, [t for t, _ in rows], y)

        # Examples of a label with the same heaviest word lie together, which keeps bounds tight.
        heaviest = np.array([t[w.argmax()] if len(t) else -1 for t, w in rows], np.int64)
        example, parts = np.empty(0, np.int64), []
        for label in (0, 1):
            of = np.flatnonzero(y == label)
            of = of[np.argsort(heaviest[of], kind="stable")]
            parts.append((len(example), len(example) + len(of)))
            filled = np.full(-(-len(of) // _BLOCK) * _BLOCK, -1)
            filled[: len(of)] = of
            example = np.concatenate([example, filled])
        place = np.full(len(texts), -1)
        place[example[example >= 0]] = np.flatnonzero(example >= 0)

        table = np.zeros((min(dense, len(numbers)), len(example)))
        sizes = np.array([len(t) for t, _ in rows], np.int64)
        places = np.repeat(place, sizes)
        terms = np.concatenate([np.empty(0, np.int32), *[t for t, _ in rows]])
        weights = np.concatenate([np.empty(0), *[w for _, w in rows]])
        frequent = terms < len(table)
        table[terms[frequent], places[frequent]] = weights[frequent]
        terms, places, weights = terms[~frequent], places[~frequent], weights[~frequent]
        order = np.lexsort((places, terms))
        terms, places, weights = terms[order], places[order], weights[order]
        blocks = places // _BLOCK
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])
        starts = np.flatnonzero(new)
        return cls(
            y, numbers, idf, float(np.log(len(texts) + 1)), example, place, parts, table,
            np.searchsorted(terms[starts], np.arange(len(idf) + 1)),
            blocks[starts],
            np.maximum.reduceat(weights, starts) if len(starts) else np.empty(0),
            np.append(starts, len(terms)),
            places, weights, tellers, own, deviations,
            np.zeros(deviations.shape[1], np.int64),
        )

    def vector(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """The bank's words in a text, and their weights in its vector of length 1."""
        return self._vector(Counter(alnum_words(text)))

    def _vector(self, words: Counter) -> tuple[np.ndarray, np.ndarray]:
        get = self.numbers.get
        terms = np.array([get(w, -1) for w in words], np.int64)
        weights = 1 + np.log(np.fromiter(words.values(), float, len(words)))
        known = terms >= 0
        outside = weights[~known] * self.unknown
        terms, weights = terms[known], weights[known] * self.idf[terms[known]]
        # In the order of the words' numbers, so that equal texts and sums agree in every bit.
        order = np.argsort(terms)
        terms, weights = terms[order], weights[order]
        square = np.square(weights).sum() + np.square(np.sort(outside)).sum()
        return terms, weights / (np.sqrt(square) or 1.0)

    def nearest(
        self, texts: list[bytes | None], k: int, without: list[int] | None = None, folds: list[int] | None = None
    ) -> list[tuple[Near, list]]:
        """Per text, for each label, (similarity, example) of its k nearest with a similarity above 0,
        nearest first, and what the words shared with them tell (``_telling``); ``without``
        names an example per text that is passed over, ``folds`` a fold."""
        words = [Counter(alnum_words(t)) for t in texts]
        vectors = [self._vector(w) for w in words]
        queries = np.zeros((len(texts), len(self.dense)))
        for query, (terms, weights) in zip(queries, vectors):
            frequent = terms < len(self.dense)
            query[terms[frequent]] = weights[frequent]
        sums = queries @ self.dense
        found = []
        for i, (terms, weights) in enumerate(vectors):
            fold = -1 if folds is None else folds[i]
            gone = self.place[fold::FOLDS] if fold >= 0 else self.place[[] if without is None else [without[i]]]
            near = self._completed(sums[i], terms, weights, k, gone)
            told = self._told(words[i])
            found.append((near, [self._telling(told, side, fold) for side in near]))
        return found

    def _telling(self, told: np.ndarray, near: Near, fold: int) -> np.ndarray:
        """How strongly the words and beginnings that a text shares with its neighbours tell the
        labels apart in the bank without the fold, the strongest for label 1 first."""
        # Marks of earlier texts differ, so the words are marked without clearing them.
        self.mark += 1
        for _, at in near:
            self.marks[self.own[at]] = self.mark
        return np.sort(self.deviations[fold][told[self.marks[told] == self.mark]])[::-1]

    def _told(self, words: Counter) -> np.ndarray:
        """The words and beginnings of a text that tell."""
        found, get = set(), self.tellers.get
        for word in words:
            for length, listed in get(word[: _BEGINNINGS[0]], _NONE).items():
                at = listed.get(word[:length] if length else word)
                if at is not None and length < len(word):
                    found.add(at)
        return np.array(sorted(found), np.int64)

    def _completed(self, sims: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, gone: np.ndarray) -> tuple[Near, Near]:
        if not len(terms):
            return [], []
        if len(gone):
            sims = sims.copy()
            sims[gone] = 0
        rare = terms >= len(self.dense)
        terms, weights = terms[rare], weights[rare]
        sizes = self.first_entry[terms + 1] - self.first_entry[terms]
        entries, weights = _ranges(self.first_entry[terms], sizes), np.repeat(weights, sizes)
        blocks = self.block[entries]
        to_come = np.bincount(blocks, weights * self.highest[entries], len(sims) // _BLOCK)
        bounds = sims.reshape(-1, _BLOCK).max(1) + to_come
        # What the k-th of a label has at least; places that are passed over count as 0.
        wanted = to_come > 0
        for start, stop in self.parts:
            if stop - start > k:
                least = np.partition(sims[start:stop], stop - start - k)[stop - start - k]
                part = slice(start // _BLOCK, -(-stop // _BLOCK))
                wanted[part] &= bounds[part] * _SLACK >= least
        own = wanted[blocks]
        first, n = self.first_posting[entries[own]], self.first_posting[entries[own] + 1] - self.first_posting[entries[own]]
        postings = _ranges(first, n)
        sims = sims + np.bincount(self.places[postings], self.weights[postings] * np.repeat(weights[own], n), len(sims))
        sims[gone] = 0
        near = []
        for start, stop in self.parts:
            part = np.round(sims[start:stop], _DIGITS)
            at = np.flatnonzero(part > 0)
            if len(at) > k:
                at = at[part[at] >= np.partition(part[at], len(at) - k)[len(at) - k]]
            examples = self.example[start + at]
            order = np.lexsort((examples, -part[at]))[:k]
            near.append(list(zip(part[at][order].tolist(), examples[order].tolist())))
        return near[0], near[1]


_NONE: dict[int, dict[bytes, int]] = {}


def _tellers(numbers: dict[bytes, int], rows: list[np.ndarray], y: np.ndarray) -> tuple[dict, list, np.ndarray]:
    """``tellers``, ``own`` and ``deviations`` of the index from the words of every example."""
    df = np.bincount(np.concatenate([np.empty(0, np.int64), *rows]), minlength=len(numbers))
    named: list[tuple[bytes, int]] = []
    columns = []
    for n in (0, *_BEGINNINGS):
        heads: dict[bytes, int] = {}
        ids = [heads.setdefault(w[:n] if n else w, len(heads)) if n < len(w) else -1 for w in numbers]
        ids = np.array(ids, np.int64)
        # The examples that have one are at most as many as have its words.
        enough = np.bincount(ids[ids >= 0], df[ids >= 0], len(heads)) >= _LEAST
        column = np.append(np.where(enough, len(named) + np.cumsum(enough) - 1, -1), -1)
        columns.append(column[ids].astype(np.int32))
        named += [(text, n) for text, i in heads.items() if enough[i]]
    of_word = np.stack(columns, 1)
    held = [np.unique(of_word[terms]) for terms in rows]
    held = [terms[terms >= 0] for terms in held]
    having, total = np.zeros((FOLDS, 2, len(named))), np.zeros((FOLDS, 2))
    for i, (terms, label) in enumerate(zip(held, y)):
        having[i % FOLDS, int(label), terms] += 1
        total[i % FOLDS, int(label)] += 1
    whole, n = having.sum(0), total.sum(0)
    parts = [(whole - h, n - t) for h, t in zip(having, total)] + [(whole, n)]
    deviations = np.array([np.where(h.sum(0) >= _LEAST, _deviations(h, t), 0) for h, t in parts])
    deviations[np.abs(deviations) < _TELLS] = 0
    kept = np.flatnonzero(deviations.any(0))
    number = np.full(len(named), -1)
    number[kept] = np.arange(len(kept))
    tellers: dict[bytes, dict[int, dict[bytes, int]]] = {}
    for at, (text, length) in enumerate(named):
        if number[at] >= 0:
            tellers.setdefault(text[: _BEGINNINGS[0]], {}).setdefault(length, {})[text] = int(number[at])
    return tellers, [number[terms][number[terms] >= 0] for terms in held], deviations[:, kept]


def features(near: tuple[Near, Near], telling: list[np.ndarray], k: int) -> list[float]:
    """What the calibration sees: the distance-weighted share of label 1 among the k nearest and how
    many there are; the highest similarity per label, the mean of the first ones, and margins; and
    what the words and beginnings shared with the neighbours of each label tell."""
    both = sorted([(sim, y) for y, side in enumerate(near) for sim, _ in side], reverse=True)[:k]
    weight = [1 / (1.0001 - min(sim, 1.0)) for sim, _ in both]
    share = sum(w * y for w, (_, y) in zip(weight, both)) / sum(weight) if both else -1.0
    top = [side[0][0] if side else 0.0 for side in near]
    mean = [sum(sim for sim, _ in side[:_NEAREST]) / _NEAREST for side in near]
    clean, toxic = telling
    said = [float(toxic[0]) if len(toxic) else 0.0, float(toxic[:3].sum()), float(clean[-3:].sum())]
    return [share, float(len(both)), *top, top[1] - top[0], *mean, mean[1] - mean[0], *said]


_FEATURES = 11


def score(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    modulus: int = 4,
    remainder: int = 2,
    threshold: float = 0.3,
    neighbours: int = 15,
    bank: int = BANK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``score``, ``predicted``, ``evidence``.

    ``evidence`` lists the nearest examples as (example, similarity, label). Examples are
    taken from ids whose CRC-32 modulo ``modulus`` is not ``remainder``, at most ``bank``
    per label; of ids with several texts or labels each pair is an example, up to twice
    the bank in all, by hash. Similarities are cosines of whole texts under weights fitted on the bank. The score follows from
    the text alone: equal texts score equally under any id, and an example is its own
    neighbour; the calibration sees no example of its own fold. A text without
    any word of an example, such as a null or empty one, gets the score of texts without
    neighbours. Without labels every score is 0.5. Repeated rows stay; other columns are left
    out.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    usable = [
        labelled(labels.where(F.col(label) == y), label, id_col, modulus, remainder, bank) for y in (1, 0)
    ]
    # At most twice the bank's rows of two numbers: a bounded broadcast.
    chosen = keep(usable[0].unionByName(usable[1]))
    named = rows.join(F.broadcast(chosen), "_id").withColumn("_hash", F.xxhash64("_id", "_text", "_y"))
    examples = keep(lowest(named.select("_hash", "_id", "_text", "_y"), "_hash", 2 * bank))
    held = examples.orderBy("_hash").toArrow()
    y, hashes = held["_y"].to_numpy(), held["_hash"].to_numpy()
    ids = [str(i) for i in held["_id"].to_pylist()]
    index = spark.sparkContext.broadcast(Index.build(_Texts(held["_text"]), y))
    del held

    @F.arrow_udf("array<double>")
    def left_out(own: pa.Array, texts: pa.Array) -> pa.Array:
        places = np.searchsorted(hashes, own.to_numpy()).tolist()
        near = _in_batches(index.value, list(utf8(texts)), neighbours, [at % FOLDS for at in places])
        return pa.array([features(*n, neighbours) for n in near], pa.list_(pa.float64()))

    found = examples.repartition(8).select("_hash", left_out("_hash", "_text").alias("x")).toArrow()
    found = found.sort_by("_hash")["x"].to_pylist()
    x = np.array(found, float).reshape(len(y), _FEATURES)
    calibration = fit_additive(x, y, bins=32, rounds=80, pairs=0)
    shift = _prior(labels, label, id_col, modulus, remainder) - _log_odds(y.sum(), len(y))
    scored = _scorer(index, spark.sparkContext.broadcast((calibration, ids)), shift, neighbours)
    return rows.select("_id", scored("_text").alias("_s")).select(
        F.col("_id").alias(id_col),
        held_out("_id", modulus, remainder).alias("held_out"),
        F.col("_s.score").alias("score"),
        (F.col("_s.score") >= threshold).cast("int").alias("predicted"),
        F.col("_s.evidence").alias("evidence"),
    )


class _Texts(Sequence):
    """A column of texts as UTF-8, one Python object at a time."""

    def __init__(self, column: pa.ChunkedArray):
        self._column = column

    def __len__(self) -> int:
        return len(self._column)

    def __getitem__(self, at: int) -> bytes | None:
        return self._column[at].as_buffer().to_pybytes() if self._column[at].is_valid else None

    def __iter__(self):
        for chunk in self._column.chunks:
            yield from utf8(chunk)


def _in_batches(index: Index, texts: list[bytes | None], k: int, folds: list[int] | None = None):
    for at in range(0, len(texts), _TOGETHER):
        own = None if folds is None else folds[at : at + _TOGETHER]
        yield from index.nearest(texts[at : at + _TOGETHER], k, folds=own)


def _scorer(index, fitted, shift: float, k: int):
    @F.arrow_udf("score double, evidence array<struct<example:string,similarity:double,label:int>>")
    def scored(texts: pa.Array) -> pa.Array:
        calibration, ids = fitted.value
        x, evidence, held = [], [], []

        def add() -> None:
            for near, telling in index.value.nearest(held, k):
                x.append(features(near, telling, k))
                both = sorted(((-sim, at, y) for y, side in enumerate(near) for sim, at in side))[:_NEAREST]
                evidence.append([{"example": ids[at], "similarity": -sim, "label": y} for sim, at, y in both])
            held.clear()

        for text in utf8(texts):
            held.append(text)
            if len(held) == _TOGETHER:
                add()
        if held:
            add()
        raw = np.clip(calibration.score(np.array(x).reshape(len(x), _FEATURES)), 1e-9, 1 - 1e-9)
        scores = sigmoid(np.log(raw / (1 - raw)) + shift)
        said = pa.struct([("example", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())])
        columns = [pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(said))]
        return pa.StructArray.from_arrays(columns, names=["score", "evidence"])

    # Neither repeated nor moved by the optimizer.
    return scored.asNondeterministic()


def _log_odds(ones: float, n: float) -> float:
    return float(np.log((ones + 1) / (n - ones + 1)))


def _prior(labels: DataFrame, label: str, id_col: str, modulus: int, remainder: int) -> float:
    """Log odds among all labels that may be learned from; the bank has as many of each."""
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out(id_col, modulus, remainder))
    ones, n = usable.agg(F.sum(label), F.count("*")).first()
    return _log_odds(ones or 0, n)
