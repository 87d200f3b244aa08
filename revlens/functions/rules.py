"""Review record rules, as SQL conditions over typed or JSON records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from revlens.params import ReviewRules
from revlens.schema import REVIEW_FIELDS, VIOLATION


@dataclass(frozen=True)
class Field:
    """One field of a record, as three SQL expressions: is it there, its value if
    that is a string, its value if that is a number (never a boolean)."""

    present: str
    text: str
    number: str


def typed_field(name: str) -> Field:
    """A field held in a typed column; null means the record lacks the field."""
    if name == "rating":
        return Field(f"{name} IS NOT NULL", "CAST(NULL AS STRING)", f"CAST({name} AS DOUBLE)")
    return Field(f"{name} IS NOT NULL", name, "CAST(NULL AS DOUBLE)")


def json_field(name: str) -> Field:
    """A field of a parsed JSON object, from its columns ``<name>_present``,
    ``<name>_value`` (a variant) and ``<name>_kind`` (the variant's own type).

    The kind is asked before any cast: a cast would turn "5" and true into numbers.
    """
    value, kind = f"{name}_value", f"{name}_kind"
    return Field(
        f"coalesce({name}_present, false)",
        f"CASE WHEN {kind} = 'STRING' THEN try_variant_get({value}, '$', 'string') END",
        f"CASE WHEN {kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL%'"
        f" THEN try_variant_get({value}, '$', 'double') END",
    )


@dataclass(frozen=True)
class Check:
    path: str
    message: str
    failed: str   # a condition, null where the rule does not apply


def checks(
    fields: dict[str, Field], rules: ReviewRules, has_extra: str | None = None
) -> list[Check]:
    """All rules of a record, smallest path first.

    Paths are known up front, so the rules are listed in their final order (root,
    then fields by name) and no row has to sort what it violates.
    """
    listed = [
        Check("<root>", f"{name} is required", f"NOT ({fields[name].present})")
        for name in REVIEW_FIELDS
    ]
    if has_extra is not None:
        listed.append(Check("<root>", "unknown fields are not allowed", has_extra))

    def string_rules(name: str, *rest: tuple[str, str]) -> list[Check]:
        field = fields[name]
        wrong = Check(name, "is not a string", f"({field.present}) AND ({field.text}) IS NULL")
        return [wrong, *[Check(name, message, failed) for message, failed in rest]]

    def length_rules(name: str, longest: int | None) -> list[tuple[str, str]]:
        size = f"length({fields[name].text})"
        rest = [("is shorter than 1 character", f"{size} < 1")]
        if longest is not None:
            rest.append((f"is longer than {longest} characters", f"{size} > {longest}"))
        return rest

    def pattern_rule(name: str, pattern: str) -> tuple[str, str]:
        return (
            f"does not match {pattern}",
            f"NOT rlike({fields[name].text}, {_literal(_pattern(pattern))})",
        )

    listed += string_rules("body", *length_rules("body", rules.body_max))
    listed += string_rules("product_id", pattern_rule("product_id", rules.product_id_pattern))
    listed += string_rules("product_name", *length_rules("product_name", None))

    rating = fields["rating"]
    listed += [
        # Whole numbers written with a fraction, such as 5.0, are integers.
        Check(
            "rating",
            "is not an integer",
            f"({rating.present}) AND NOT coalesce({rating.number} % 1 = 0, false)",
        ),
        Check("rating", f"is below {rules.rating_min}", f"{rating.number} < {rules.rating_min}"),
        Check("rating", f"is above {rules.rating_max}", f"{rating.number} > {rules.rating_max}"),
    ]

    listed += string_rules("review_id", pattern_rule("review_id", rules.review_id_pattern))
    language = fields["source_language"]
    known = ", ".join(map(_literal, rules.languages))
    # A value that is no string is none of the listed ones either.
    unlisted = f"({language.present}) AND NOT coalesce({language.text} IN ({known}), false)"
    listed += string_rules(
        "source_language", ("is not one of " + ", ".join(rules.languages), unlisted)
    )
    listed += string_rules("title", *length_rules("title", rules.title_max))
    return listed


def violations(rules: list[Check], is_object: str = "true") -> Column:
    """The violated rules of a record as an array of path and message."""
    found = ", ".join(
        f"CASE WHEN {r.failed} THEN struct({_literal(r.path)} AS path,"
        f" {_literal(r.message)} AS message) END"
        for r in rules
    )
    return F.expr(
        f"CAST(CASE WHEN {is_object} THEN filter(array({found}), v -> v IS NOT NULL)"
        " ELSE array(struct('<root>' AS path, 'is not an object' AS message)) END"
        f" AS array<{VIOLATION}>)"
    )


def passes(rules: list[Check], is_object: str = "true") -> Column:
    """Whether a record violates nothing: plain conditions, so that a filter on it
    is split up, pushed down and never builds the array of violations."""
    clean = " AND ".join(f"NOT coalesce({r.failed}, false)" for r in rules)
    return F.expr(f"{is_object} AND {clean}")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pattern(pattern: str) -> str:
    # In the rule's own dialect `$` also stands before one final line feed.
    return pattern[:-1] + r"\n?\z" if pattern.endswith("$") else pattern
