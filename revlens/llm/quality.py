"""A quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are computed where a document is scored. Cyclic boosting of
shallow trees turns labelled examples into one lookup table per feature and per chosen
pair; a score is a sum of table entries, added up for whole batches at once.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from revlens.llm.boosting import Additive, fit_additive
from revlens.llm.text import SPACED_BYTES, held_out, lowest

#: Labelled ids, and examples, that the model is fitted on at most, taken in the order of a hash.
SAMPLE = 20_000

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS, _MARKS, _SYMBOLS = b"0123456789", b".,;:?", b"#*$%&|<>=_~^@{}[]\\"

FEATURES = (
    "log_words word_length upper_share digit_share mark_share symbol_share bang_share bar_share "
    "other_share distinct_words top_word repeated_runs repeated_lines words_per_line longest_word "
    "one_letter_words"
).split()


def features(text: str | None) -> list[float]:
    """``FEATURES`` of one text; null is as empty."""
    data = (text or "").encode("utf-8", "replace")
    words = SPACED_BYTES.findall(data)
    n, size = max(1, len(words)), max(1, len(data))

    def share(characters: bytes) -> float:
        return (len(data) - len(data.translate(None, characters))) / size

    counts = Counter(words)
    runs = max(0, len(words) - 4)
    distinct = len(set(zip(words, words[1:], words[2:], words[3:], words[4:])))
    lines = [line for line in data.split(b"\n") if line.strip()]
    ascii_size = len(data.decode("ascii", "ignore"))
    return [
        math.log1p(len(words)), sum(map(len, words)) / n, share(_UPPER), share(_DIGITS), share(_MARKS),
        share(_SYMBOLS), share(b"!"), share(b"|"), 1 - ascii_size / size, len(counts) / n,
        max(counts.values(), default=0) / n, 1 - distinct / runs if runs else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0, n / max(1, len(lines)),
        math.log1p(max(map(len, words), default=0)), sum(c for w, c in counts.items() if len(w) == 1) / n,
    ]


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))


def _features(text_col: str) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(texts)), dtype=object)

    return of(text_col)


def labelled(labels: DataFrame, label: str, id_col: str, modulus: int, remainder: int, sample: int) -> DataFrame:
    """At most ``sample`` labelled ids that may be learned from, in the order of a hash."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    usable = usable.where(~held_out(id_col, modulus, remainder))
    rows = usable.select(
        F.xxhash64(id_col).alias("_hash"), F.col(id_col).alias("_id"), F.col(label).cast("double").alias("_y")
    )
    return lowest(rows, "_hash", sample).drop("_hash")


def score(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    modulus: int = 5,
    remainder: int = 0,
    threshold: float = 0.3,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``score``, ``predicted``, ``carried`` columns.

    The model learns from ids whose CRC-32 modulo ``modulus`` is not ``remainder``, from
    at most ``sample`` labelled ids and from at most ``sample`` examples of them, both in
    the order of a hash, so that reruns agree; nothing but the text enters a score. Null
    texts score as empty ones. Labels of other values and of unknown ids are passed over;
    an id with several labels or several texts gives an example for each, repeated rows
    give one. Without labels the score is 0.5; with one label only, it is that label's share.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        *[F.col(c).alias(f"_carried_{c}") for c in carried],
    )
    # A bounded broadcast; the other texts are looked at once, when they are scored.
    chosen = F.broadcast(labelled(labels, label, id_col, modulus, remainder, sample))
    hashed = F.xxhash64("_id", "_text").alias("_hash")
    examples = rows.join(chosen, "_id").select(hashed, "_y", _features("_text").alias("x"))
    seen = lowest(examples, "_hash", sample).toPandas()
    x = np.array(seen["x"].tolist(), float).reshape(len(seen), len(FEATURES))
    scores = _scorer(fit_additive(x, seen["_y"].to_numpy(float)))
    return rows.withColumn("score", scores("_text")).select(
        F.col("_id").alias(id_col),
        held_out("_id", modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *[F.col(f"_carried_{c}").alias(c) for c in carried],
    )


def _scorer(model: Additive):
    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)))

    # Neither repeated nor moved by the optimizer.
    return scores.asNondeterministic()
