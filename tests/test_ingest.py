import json

import pytest
from samples import review

from revlens.operators import ingest
from revlens.params import ReviewRules
from revlens.sources import records

RULES = ReviewRules()
EMOJI = "\U0001F600"

CASES = [
    ("base", review(), 0, None),
    ("missing field", {k: v for k, v in review().items() if k != "rating"}, 1, "<root>"),
    ("rating above", review(rating=6), 1, "rating"),
    ("rating below", review(rating=0), 1, "rating"),
    ("rating word", review(rating="five"), 1, "rating"),
    ("rating digits", review(rating="5"), 1, "rating"),
    ("rating whole", review(rating=5.0), 0, None),
    ("rating true", review(rating=True), 1, "rating"),
    ("rating null", review(rating=None), 1, "rating"),
    ("rating fraction", review(rating=3.5), 1, "rating"),
    ("rating fraction above", review(rating=5.5), 2, "rating"),
    ("rating huge", review(rating=1e30), 1, "rating"),
    ("rating list", review(rating=[5]), 1, "rating"),
    ("id pattern", review(review_id="review-1"), 1, "review_id"),
    ("id digits", review(review_id="rev-00001"), 1, "review_id"),
    ("id final line feed", review(review_id="rev-0001\n"), 0, None),
    ("id two line feeds", review(review_id="rev-0001\n\n"), 1, "review_id"),
    ("product pattern", review(product_id="prod-1"), 1, "product_id"),
    ("product name", review(product_name=""), 1, "product_name"),
    ("language", review(source_language="zz"), 1, "source_language"),
    ("language number", review(source_language=5), 2, "source_language"),
    ("language null", review(source_language=None), 2, "source_language"),
    ("extra", review(unexpected="boom"), 1, "<root>"),
    ("two extras", review(unexpected="boom", more=1), 1, "<root>"),
    ("string", "not-a-dict", 1, "<root>"),
    ("number", 42, 1, "<root>"),
    ("null", None, 1, "<root>"),
    ("array", [review()], 1, "<root>"),
    ("empty object", {}, 7, "<root>"),
    ("title 120", review(title=EMOJI * 120), 0, None),
    ("title 121", review(title=EMOJI * 121), 1, "title"),
    ("body 2000", review(body="é" * 2000), 0, None),
    ("body 2001", review(body="é" * 2001), 1, "body"),
    ("title empty", review(title=""), 1, "title"),
    ("body object", review(body={"a": 1}), 1, "body"),
    ("first is smallest", review(title="", body="", rating=9), 3, "body"),
]


@pytest.fixture(scope="module")
def checked(spark):
    rows = [(i, json.dumps(case[1])) for i, case in enumerate(CASES)]
    raw = spark.createDataFrame(rows, "n int, text string")
    return ingest.check_json(records.json_records(raw, "text", "n"), RULES)


def test_violations(checked):
    found = {r["seq"]: r["violations"] for r in checked.collect()}
    for i, (name, _, count, first) in enumerate(CASES):
        assert len(found[i]) == count, name
        if first:
            assert found[i][0]["path"] == first, name


def test_valid_and_rejected(checked):
    good = [i for i, case in enumerate(CASES) if case[2] == 0]
    assert [r["seq"] for r in ingest.valid(checked).orderBy("seq").collect()] == good
    rejects = {r["seq"]: r for r in ingest.rejected(checked).collect()}
    assert set(rejects) == set(range(len(CASES))) - set(good)
    for i, (name, record, count, first) in enumerate(CASES):
        if count:
            assert rejects[i]["error_count"] == count, name
            assert rejects[i]["first_error"].startswith(f"{first}: "), name
            wanted = record.get("review_id") if isinstance(record, dict) else None
            assert rejects[i]["review_id"] == wanted, name


def test_counts_and_typed_result(checked):
    row = ingest.counts(checked).first()
    good = sum(1 for case in CASES if case[2] == 0)
    assert (row["loaded"], row["valid"], row["dropped"]) == (len(CASES), good, len(CASES) - good)
    assert ingest.valid(checked).schema["rating"].dataType.simpleString() == "int"


def test_text_that_is_no_json_is_a_reject(spark):
    raw = spark.createDataFrame([(0, "{oops"), (1, json.dumps(review()))], "n int, text string")
    checked = ingest.check_json(records.json_records(raw, "text", "n"), RULES)
    assert [r["seq"] for r in ingest.valid(checked).collect()] == [1]
    assert ingest.rejected(checked).first()["first_error"] == "<root>: is not an object"


def test_last_of_repeated_keys_counts(spark):
    text = json.dumps(review())[:-1] + ', "rating": 2}'
    raw = spark.createDataFrame([(0, text)], "n int, text string")
    checked = ingest.check_json(records.json_records(raw, "text", "n"), RULES)
    assert ingest.valid(checked).first()["rating"] == 2


def test_typed_records(make_reviews):
    df = make_reviews({}, {"rating": 6}, {"title": ""}, {"body": None}, {"source_language": "zz"}, {})
    checked = ingest.check_typed(df, RULES)
    assert [r["seq"] for r in ingest.valid(checked).orderBy("seq").collect()] == [0, 5]
    first = {r["seq"]: r["first_error"] for r in ingest.rejected(checked).collect()}
    assert first[3] == "<root>: body is required"
    assert "boom" not in str(first)


def test_empty_input(make_reviews):
    checked = ingest.check_typed(make_reviews(), RULES)
    assert ingest.counts(checked).first().asDict() == {"loaded": 0, "valid": 0, "dropped": 0}


def test_split_keeps_no_text_of_rejects(make_reviews):
    rows = ingest.split(ingest.check_typed(make_reviews({}, {"rating": 9}), RULES)).orderBy("seq").collect()
    assert rows[0]["valid"] and rows[0]["body"]
    assert not rows[1]["valid"] and rows[1]["body"] is None and rows[1]["review_id"] == "rev-0001"
