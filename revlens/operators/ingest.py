"""Validation: the violations of each record, the valid reviews, the rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.rules import Field, checks, json_field, passes, typed_field, violations
from revlens.params import ReviewRules
from revlens.schema import REVIEW, REVIEW_FIELDS


def check_typed(df: DataFrame, rules: ReviewRules) -> DataFrame:
    """Adds ``violations`` and ``valid`` to records in typed columns beside ``seq``."""
    fields = {name: typed_field(name) for name in REVIEW_FIELDS}
    listed = checks(fields, rules)
    return df.select(
        "seq",
        *REVIEW_FIELDS,
        violations(listed).alias("violations"),
        passes(listed).alias("valid"),
    )


def check_json(df: DataFrame, rules: ReviewRules) -> DataFrame:
    """Adds ``violations`` and ``valid`` to JSON records in a variant column ``record``.

    A later filter on the violations would be pushed below these steps, with each
    use of a record or a field replaced by the parsing behind it. Filters stop at
    a generator's output, so one-element arrays keep both to one evaluation.
    """
    names = REVIEW_FIELDS
    known = ", ".join(f"'{n}'" for n in names)
    opened = df.select("seq", F.explode(F.array("record")).alias("record")).selectExpr(
        "seq",
        "CASE WHEN startswith(schema_of_variant(record), 'OBJECT')"
        " THEN CAST(record AS map<string, variant>) END AS _members",
    )
    taken = opened.selectExpr(
        "seq",
        "_members IS NOT NULL AS _is_object",
        f"size(array_except(map_keys(_members), array({known}))) > 0 AS _has_extra",
        *[f"map_contains_key(_members, '{n}') AS {n}_present" for n in names],
        *[f"try_element_at(_members, '{n}') AS {n}_value" for n in names],
    )
    kinds = taken.selectExpr("*", *[f"schema_of_variant({n}_value) AS {n}_kind" for n in names])
    parts = ["_is_object", "_has_extra"]
    for n in names:
        field = json_field(n)
        parts += [f"{field.present} AS {n}_present", f"{field.text} AS {n}_text"]
        parts.append(f"{field.number} AS {n}_number")
    plain = kinds.selectExpr("seq", f"inline(array(struct({', '.join(parts)})))")

    fields = {n: Field(f"{n}_present", f"{n}_text", f"{n}_number") for n in names}
    listed = checks(fields, rules, "_has_extra")
    return plain.select(
        "seq",
        *[F.col(f"{n}_number" if n == "rating" else f"{n}_text").alias(n) for n in names],
        violations(listed, "_is_object").alias("violations"),
        passes(listed, "_is_object").alias("valid"),
    )


def check(df: DataFrame, rules: ReviewRules) -> DataFrame:
    """``check_json`` if the records come as JSON, else ``check_typed``."""
    return check_json(df, rules) if "record" in df.columns else check_typed(df, rules)


def valid(checked: DataFrame) -> DataFrame:
    """The records without a violation, as typed reviews."""
    return checked.where("valid").select(*_typed())


def rejected(checked: DataFrame) -> DataFrame:
    """The dropped records: id, first violation, number of violations.

    Messages name the rule and never quote the record, which holds customer text.
    """
    first = F.get("violations", F.lit(0))
    return checked.where(~F.col("valid")).select(
        "seq",
        "review_id",
        F.concat(first["path"], F.lit(": "), first["message"]).alias("first_error"),
        F.size("violations").alias("error_count"),
    )


def split(checked: DataFrame) -> DataFrame:
    """Every record once, marked ``valid`` or not: typed if valid, stripped to its id
    and violations if not. Written by that mark it is both tables in one pass."""
    keep_id = ("seq", "review_id")
    return checked.select(
        *[
            c if name in keep_id else F.when(F.col("valid"), c).alias(name)
            for name, c in zip(checked.columns, _typed())
        ],
        "violations",
        "valid",
    )


def counters() -> dict[str, Column]:
    """Aggregates over checked records, by name."""
    return {
        "loaded": F.count("*"),
        "valid": F.count_if("valid"),
        "dropped": F.count_if(~F.col("valid")),
    }


def counts(checked: DataFrame) -> DataFrame:
    return checked.agg(*[c.alias(name) for name, c in counters().items()])


def _typed() -> list[Column]:
    # A rating that is no integer must not reach a cast that raises.
    return [
        (F.col(f.name).try_cast(f.dataType) if f.name == "rating" else F.col(f.name)).alias(f.name)
        for f in REVIEW.fields
    ]
