"""Text columns: trimming, prompts, judge replies, printed figures."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

from revlens import fixed_values as fixed
from revlens.params import QualityParams

#: Every character Python's ``str.strip`` removes; the last one is U+3000.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

_DIGITS = [c for c in map(chr, range(0x80, 0x20000)) if unicodedata.category(c) == "Nd"]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def review_text(title: Column, body: Column) -> Column:
    """Title and body as one text, as the judge and the round trip see it."""
    empty = F.lit("")
    return strip(F.concat(F.coalesce(title, empty), F.lit("\n\n"), F.coalesce(body, empty)))


def fill(template: str, **values: Column | str | int) -> Column:
    """``template`` with each ``{name}`` replaced by a column or a constant."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = []
    for i, piece in enumerate(pieces):
        if i % 2 == 0:
            parts.append(F.lit(piece))
        else:
            value = values[piece]
            parts.append(value.cast("string") if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*parts)


def judge_prompt(
    source_text: Column,
    translated_text: Column,
    source_language: Column,
    target_language: Column,
    quality: QualityParams,
) -> Column:
    return fill(
        fixed.JUDGE_PROMPT,
        source_text=source_text,
        translated_text=translated_text,
        source_language=F.coalesce(source_language, F.lit("")),
        target_language=target_language,
        scale_min=quality.scale_min,
        scale_max=quality.scale_max,
    )


def parse_score(reply: Column, quality: QualityParams) -> Column:
    """First number of a reply, held inside the scale; no number scores lowest."""
    # Digits of other scripts count as digits, so they are made ASCII first.
    ascii_reply = F.translate(
        F.coalesce(reply, F.lit("")),
        "".join(_DIGITS),
        "".join(str(unicodedata.digit(c)) for c in _DIGITS),
    )
    number = F.nullif(
        F.regexp_extract(ascii_reply, fixed.NUMBER_PATTERN, 0), F.lit("")
    ).try_cast("double")
    low, high = (F.lit(float(x)) for x in (quality.scale_min, quality.scale_max))
    # least and greatest skip nulls, so a missing number becomes the lowest first.
    return F.greatest(low, F.least(high, F.coalesce(number, low)))


def is_kept(score: Column, quality: QualityParams) -> Column:
    """Inclusive threshold. Spark orders NaN above every number; it is not kept."""
    return F.coalesce(
        (score >= F.lit(float(quality.threshold))) & ~F.isnan(score), F.lit(False)
    )


def printed(value: Column) -> Column:
    """A figure as the report prints it: no trailing ``.0``, a dash when missing."""
    return F.coalesce(
        F.regexp_replace(value.cast("string"), r"\.0$", ""), F.lit(fixed.MISSING_FIGURE)
    )
