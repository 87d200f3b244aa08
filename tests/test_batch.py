import re
from dataclasses import replace

import pytest

from revlens.operators import summarize
from revlens.operators.providers import Provider, echo_translator, fixed_judge
from revlens.params import Params
from revlens.plans import batch, queries

PARAMS = Params(target_languages=("fr", "de"), page_entries=2)
ROWS = [
    {"review_id": "rev-0001", "product_id": "prod-001"},
    {"review_id": "rev-0002", "product_id": "prod-001", "source_language": "es"},
    {"review_id": "rev-0003", "product_id": "prod-002", "source_language": "fr"},
    {"review_id": "rev-0004", "product_id": "prod-002", "rating": 9},
]


def echo_summary():
    return Provider.batch(lambda: lambda prompt, *_: f"{len(prompt)} characters")


def run(df, root, run_id, judge=None):
    return batch.run_batch(
        df, root, run_id, PARAMS, echo_translator(), judge or fixed_judge(4.0), echo_summary()
    )


def entries(spark, root):
    _, pages = batch.served(spark, root)
    return [
        (r["product_id"], e["review_id"], e["language"])
        for r in pages.orderBy("product_id", "page_no").collect()
        for e in r["reviews"]
    ]


def test_run(spark, make_reviews, tmp_path):
    root = str(tmp_path / "out")
    status = run(make_reviews(*ROWS), root, "one").collect()
    assert [(r["stage"], r["count"]) for r in status] == [
        ("ingestion", 3), ("translation", 3), ("summarization", 2), ("quality", 3), ("serving", 3),
    ]
    target = status[1]["target_key"]
    assert "/runs/one/" in target and target.endswith("/translated")
    assert entries(spark, root) == [
        ("prod-001", "rev-0001", "en"), ("prod-001", "rev-0002", "fr"), ("prod-001", "rev-0002", "de"),
        ("prod-002", "rev-0003", "fr"), ("prod-002", "rev-0003", "de"),
    ]
    at = batch.published(spark, root)
    assert [r["review_id"] for r in batch.rejected(spark, at).collect()] == ["rev-0004"]
    counts = {r["counter"]: r["value"] for r in batch.stage_counts(spark, at, PARAMS).collect()}
    assert counts == {
        "loaded": 4, "valid": 3, "dropped": 1, "reviews_in": 3, "translated_reviews": 2,
        "passthrough_reviews": 1, "translations": 4, "kept": 4, "filtered": 0, "errors": 0,
    }
    headers, _ = batch.served(spark, root)
    assert headers.where("summary like '% characters'").count() == 2


def test_failed_run_is_not_published(spark, make_reviews, tmp_path):
    root = str(tmp_path / "out")
    run(make_reviews(*ROWS[:1]), root, "one")

    def broken():
        raise RuntimeError("no client")

    from revlens.operators.providers import Judge

    with pytest.raises(Exception, match="no client"):
        run(make_reviews(*ROWS), root, "two", Judge(Provider.batch(broken)))
    assert entries(spark, root) == [("prod-001", "rev-0001", "en")]


def test_one_stage_again(spark, make_reviews, tmp_path):
    root = str(tmp_path / "out")
    run(make_reviews(*ROWS), root, "one")
    before = entries(spark, root)
    at = batch.published(spark, root).again("scored", "serving_headers", "serving_pages")
    batch.quality_stage(spark, at, PARAMS, fixed_judge(1.0))
    batch.serving_stage(spark, at, PARAMS)
    assert entries(spark, root) == before
    batch.publish(spark, at)
    assert entries(spark, root) == [("prod-001", "rev-0001", "en")]


def test_written_table_is_never_replaced(spark, make_reviews, tmp_path):
    root = str(tmp_path / "out")
    run(make_reviews(*ROWS), root, "one")
    with pytest.raises(Exception, match="already exists"):
        batch.serving_stage(spark, batch.published(spark, root), PARAMS)


@pytest.mark.parametrize("stage", ["ingest", "translate", "summarize", "quality", "serving"])
def test_rerun_lost_in_a_stage(spark, make_reviews, tmp_path, monkeypatch, stage):
    root = str(tmp_path / "out")
    run(make_reviews(*ROWS[:2]), root, "one")
    before = entries(spark, root), sorted(batch.served(spark, root)[0].collect())
    whole = getattr(batch, f"{stage}_stage")

    def lost(*args):
        whole(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, f"{stage}_stage", lost)
    with pytest.raises(RuntimeError, match="lost"):
        run(make_reviews(*ROWS), root, "one")
    assert (entries(spark, root), sorted(batch.served(spark, root)[0].collect())) == before


def test_run_without_records(spark, make_reviews, tmp_path):
    root = str(tmp_path / "out")
    assert {r["count"] for r in run(make_reviews(), root, "one").collect()} == {0}
    assert entries(spark, root) == []


def test_run_with_bounded_prompts(spark, make_reviews, tmp_path):
    """Every review reaches a prompt, and none holds more than ``prompt_reviews`` of them."""
    root, params = str(tmp_path / "out"), replace(PARAMS, prompt_reviews=2)
    rows = [{"review_id": f"rev-{i:04}", "product_id": "prod-001", "title": f"<{i}>"} for i in range(7)]

    def call(prompt, *_):
        lines = prompt.split("Reviews:\n")[1].splitlines()
        return "+".join(re.findall(r"<\w+>", prompt)) if len(lines) <= 2 else "too long"

    batch.run_batch(
        make_reviews(*rows), root, "one", params, echo_translator(), fixed_judge(4.0),
        Provider.batch(lambda: call), summaries=summarize.summarize_tree,
    )
    headers, _ = batch.served(spark, root)
    assert [r["summary"] for r in headers.collect()] == ["+".join(f"<{i}>" for i in range(7))]


@pytest.mark.parametrize("name", ["summarize_batch_udf", "staged_run_counts"])
def test_queries_hold_no_whole_product(spark, monkeypatch, name):
    """The queries over the hot product never use the form with one prompt per product."""
    monkeypatch.setattr(queries, "PARAMS", replace(queries.PARAMS, prompt_reviews=20))
    made, prompts = [], summarize._prompts
    monkeypatch.setattr(summarize, "_prompts", lambda lines, width: made.append(width) or prompts(lines, width))
    assert queries.REGISTERED[name](spark, "/root/testdata/sf0.001").count()
    assert set(made) == {20}
