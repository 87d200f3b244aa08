"""Personal data by candidate gradient boosting.

Generators with high recall propose spans, which may overlap. Boosted trees score each
from its format and its context; a calibrated threshold selects what is redacted.
Spans that the base rules accept are always selected.

No labels exist for spans, so the trees learn from the checks of all kinds: a candidate
that passes its kind's check is an example of personal data, one that fails it is not.
What a check looks at is none of the features, so a score says how far format and context
speak for data that passes. A number that is nobody's can pass by chance; how often is
known for each kind, and from the failures beside it follows what share of the passing
candidates above a score is there by chance. That share sets the threshold of a kind.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from revlens.llm.boosting import BINS, Trees, borders_of_counts, fit_trees
from revlens.llm.text import held_out
from revlens.sources.tables import keep

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("email_spelled", "ip6", "card_like", "phone_local", "ssn", "iban")
KINDS = BASE_KINDS + ADDED_KINDS

_PRECISION = 0.95
#: With fewer candidates of a kind to calibrate on, its check alone decides.
_LEAST = 20
#: The chance that a candidate which is no personal data passes its kind's check: one Luhn
#: digit, the remainder of 97, the numbers that are never given out. 0 where the form itself
#: is the evidence.
CHANCE = {"card_like": 1 / 10, "iban": 1 / 97, "ssn": 0.89, "email_spelled": 0.0, "ip6": 0.0, "phone_local": 0.0}

# Characters of the base rules. Every expression is anchored so that its
# time is linear in the text.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(
    r"\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z0-9-]{1,63})+"
)
_IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])")
_CALLS = re.compile(r"phone|tel|call|mobile|fax|contact", re.IGNORECASE)
_WORDS = re.compile(
    r"card|visa|credit|account|phone|tel|call|mobile|fax|mail|contact|address|server|host|social|ssn|iban|bank",
    re.IGNORECASE,
)


#: Characters before a candidate that are its context.
_CONTEXT = 32


def digits_of(said: str) -> str:
    return "".join(c for c in said if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _mod97(said: str) -> bool:
    letters = said.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in letters[4:] + letters[:4])) % 97 == 1


def _emails(text: str):
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def candidates(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, passes its check), ordered by kind as listed, then start."""
    if not text:
        return []
    found = [("email", a, b, True) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        found.append(("ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))))
    likely = []
    for m in _DIGITS.finditer(text):
        digits = digits_of(m[0])
        if 16 <= len(digits) <= 19:
            found.append(("card", m.start(), m.end(), luhn(digits)))
        elif 13 <= len(digits) <= 15:
            likely.append(("card_like", m.start(), m.end(), luhn(digits)))
    for m in _PHONE.finditer(text):
        found.append(("phone", m.start(), m.end(), 8 <= len(digits_of(m[0])) <= 15))
    for m in _SPELLED.finditer(text):
        start = m.start()
        while start and m.start() - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        found.append(("email_spelled", start, m.end(), start < m.start()))
    if ":" in text:
        found += [("ip6", m.start(), m.end(), True) for m in _IP6.finditer(text)]
    found += likely
    for m in _LOCAL_PHONE.finditer(text):
        # Three groups of digits are a telephone number only if something says so.
        said = "(" in m[0] or bool(_CALLS.search(text, max(0, m.start() - _CONTEXT), m.start()))
        found.append(("phone_local", m.start(), m.end(), said))
    for m in _SSN.finditer(text):
        a, b, c = m[0].split("-")
        found.append(("ssn", m.start(), m.end(), a not in ("000", "666") and a < "900" and b != "00" and c != "0000"))
    found += [("iban", m.start(), m.end(), _mod97(m[0])) for m in _IBAN.finditer(text)]
    return found


FEATURES = (
    "kind length digits digit_share separators spaces dots plus parens letters upper kinds_of_separator "
    "at_sign touches_word_before touches_word_after context_words context_digits overlaps "
    "groups longest_group"
).split()


def features(text: str, found: list[tuple[str, int, int, bool]]) -> list[list[float]]:
    """Kind, format and context of each candidate, one row of ``FEATURES`` each; no check."""
    rows = []
    spans = sorted((a, b) for _, a, b, _ in found)
    starts = np.array([a for a, _ in spans])
    ends = np.maximum.accumulate(np.array([b for _, b in spans])) if spans else np.array([])
    for kind, a, b, _ in found:
        said, before = text[a:b], text[max(0, a - _CONTEXT) : a]
        digits = digits_of(said)
        other = [c for c in said if not c.isalnum()]
        groups = re.findall("[0-9]+", said)
        # Candidates that start before this one's end, less those that end before its start.
        crossing = np.searchsorted(starts, b) - np.searchsorted(ends, a, side="right")
        rows.append(
            [
                KINDS.index(kind), b - a, len(digits), len(digits) / (b - a), len(other), said.count(" "), said.count("."),
                said[0] == "+", said.count("(") + said.count(")"), sum(c.isalpha() for c in said),
                sum(c.isupper() for c in said), len(set(other)), "@" in said, a > 0 and text[a - 1].isalnum(), b < len(text) and text[b].isalnum(),
                len(_WORDS.findall(before)), sum(c.isdigit() for c in before), crossing, len(groups),
                max(map(len, groups), default=0),
            ]
        )
    return [[float(v) for v in row] for row in rows]


@dataclass(frozen=True)
class Model:
    trees: Trees
    #: By added kind, the score from which on a candidate that passes its check is selected.
    thresholds: dict[str, float]

    def select(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(kind, start, end, score) of the spans to redact: every base span, and the added
        ones that reach their kind's threshold. A candidate that fails its check is never
        selected."""
        found = candidates(text)
        if not found:
            return []
        scores = self.trees.score(np.array(features(text, found)))
        return [
            (kind, a, b, float(score))
            for (kind, a, b, passes), score in zip(found, scores)
            if passes and (kind in BASE_KINDS or score >= self.thresholds[kind])
        ]


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Trees and thresholds from all different candidates of all kinds in all texts.

    One that occurs again with the same format and context counts once. The trees see a
    feature by its bins alone, so candidates in the same bins are one row with their
    number: the driver gets the values of each feature and the rows of bins with their
    counts, never the candidates. Four fifths of them are for the trees. The others set the threshold of each added kind: the lowest score from
    which on no more than 5 % of what passes does so by chance (``CHANCE``). A kind with
    fewer than 20 of them is decided by its check alone, all kinds if there are no
    candidates; one that never gets below 5 % is not selected. ``phone_local`` is checked
    by a word of its context, which is among the features, so nothing is learned from it.
    """

    def examples(frames):
        for frame in frames:
            rows = []
            for text in frame["_text"]:
                found = candidates(text)
                rows += [
                    (text[a:b][:200], kind, passes, row)
                    for (kind, a, b, passes), row in zip(found, features(text or "", found))
                    if kind != "phone_local"
                ]
            yield pd.DataFrame(rows, columns=["said", "kind", "passes", "x"])

    rows = docs.select(F.col(text_col).alias("_text"))
    found = rows.mapInPandas(examples, "said string, kind string, passes boolean, x array<double>").select(
        F.xxhash64("said", "x").alias("hash"), "kind", "passes", "x", held_out("said", 5, 0).alias("calibrates")
    )
    # Written, as it is read for the borders of the bins and for the counts.
    different = keep(found.distinct())
    values = different.select(F.posexplode("x").alias("feature", "value")).groupBy("feature", "value").count().toPandas()
    cuts = []
    for j in range(len(FEATURES)):
        own = values[values["feature"] == j]
        cuts.append(borders_of_counts(own["value"].to_numpy(float), own["count"].to_numpy(float), BINS))

    @F.pandas_udf("array<double>")
    def binned(rows: pd.Series) -> pd.Series:
        x = np.array(rows.tolist(), float).reshape(len(rows), len(FEATURES))
        # A bin stands as its lower border.
        x = [np.append(-1.0, c)[np.searchsorted(c, x[:, j], side="right")] for j, c in enumerate(cuts)]
        return pd.Series(list(np.stack(x, 1)))

    counted = different.select("kind", "passes", "calibrates", binned("x").alias("x"))
    drawn = counted.groupBy("kind", "passes", "calibrates", "x").count().toPandas()
    drawn = drawn.assign(_x=drawn["x"].map(tuple)).sort_values(["kind", "passes", "calibrates", "_x"])
    x = np.array(drawn["x"].tolist(), dtype=float).reshape(len(drawn), len(FEATURES))
    y, calibrates = drawn["passes"].to_numpy(float), drawn["calibrates"].to_numpy(bool)
    n = drawn["count"].to_numpy(float)
    trees = fit_trees(x[~calibrates], y[~calibrates], weight=n[~calibrates], cuts=cuts)
    scores = trees.score(x)
    own = {k: calibrates & (drawn["kind"] == k).to_numpy(bool) for k in ADDED_KINDS}
    return Model(trees, {k: _threshold(scores[at], y[at], CHANCE[k], n[at]) for k, at in own.items()})


def _threshold(scores: np.ndarray, y: np.ndarray, chance: float, n: np.ndarray | None = None) -> float:
    """From rows that stand for ``n`` candidates each, one by default."""
    n = np.ones(len(y)) if n is None else n
    if n.sum() < _LEAST:
        return 0.0
    order = np.argsort(-scores, kind="stable")
    scores, passed, reached = scores[order], np.cumsum((n * y)[order]), np.cumsum(n[order])
    by_chance = (reached - passed) * chance / (1 - chance)
    last_of_equals = np.append(scores[1:] != scores[:-1], True)
    good = np.flatnonzero(last_of_equals & (passed > 0) & (by_chance <= (1 - _PRECISION) * passed))
    return float(scores[good[-1]]) if len(good) else 2.0


_SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``spans``) of every row: personal data by kind as listed, then start.

    Offsets count code points. Null and empty texts have no spans; repeated rows give
    repeated rows; whole texts are read. Other columns are left out.
    """

    @F.pandas_udf(_SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[dict(zip(("kind", "start", "end", "score"), s)) for s in model.select(t)] for t in texts]
        )

    return docs.select(F.col(id_col), spans(text_col).alias("spans"))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with each selected span replaced by its kind in brackets; where spans overlap,
    the first, and of those that start together the longest, names the replacement.

    Null texts stay null; every other column is left as it is.
    """

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([_replaced(t, model.select(t)) for t in texts], dtype=object)

    return docs.withColumn(text_col, clean(text_col))


def _replaced(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    if not spans:
        return text
    parts, done = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            parts += [text[done:a], f"[{kind.upper()}]"]
        elif b <= done:
            continue
        done = b
    return "".join([*parts, text[done:]])
