import re
from dataclasses import replace

import pytest

from revlens.operators import summarize
from revlens.operators.providers import Provider
from revlens.params import ModelParams, Params

PARAMS = Params(target_languages=("fr",), summary_model=ModelParams("s", 9))
ORDER = ["prod-002", "prod-001", "prod-002", "prod-001", "prod-001"]


def reviews(make_reviews):
    return make_reviews(
        *[{"product_id": p, "product_name": f"Name {p} {i}", "title": f"t{i}", "body": f"b{i}"} for i, p in enumerate(ORDER)]
    )


def batch(function):
    return Provider.batch(lambda: function)


def test_groups(make_reviews):
    rows = summarize.product_groups(reviews(make_reviews)).collect()
    assert [tuple(r) for r in rows] == [
        ("prod-001", "Name prod-001 1", 3), ("prod-002", "Name prod-002 0", 2),
    ]


def test_first_review_names_the_product(make_reviews):
    df = make_reviews(
        {"product_id": "a", "product_name": None}, {"product_id": "a", "product_name": "late"},
        {"product_id": "b", "product_name": ""}, {"product_id": "c", "product_name": "x"},
        {"product_id": "", "product_name": "none"}, {"product_id": None},
    )
    assert [tuple(r)[:2] for r in summarize.product_groups(df).collect()] == [
        ("a", "a"), ("b", "b"), ("c", "x"),
    ]
    assert {r["product_name"] for r in summarize.prompts(df, PARAMS).collect()} == {"a", "b", "x"}


def test_prompt_text(make_reviews):
    df = make_reviews(
        {"seq": 9, "rating": None, "title": "last", "body": "one  \t"},
        {"seq": 2, "title": "first", "body": None},
    )
    row = summarize.prompts(df, PARAMS).first()
    assert row["prompt"].endswith(
        "Respond with only the summary text, no preamble.\n\nProduct: Tin Kettle\n"
        "Number of reviews: 2\n\nReviews:\n1. (rating: 5) first:\n2. (rating: N/A) last: one"
    )


def test_summaries_are_sorted_and_called_once_each(make_reviews):
    def call(prompt, model_id, max_tokens, temperature):
        assert (model_id, max_tokens, temperature) == ("s", 9, None)
        return re.search("Product: (.*)", prompt)[1]

    rows = summarize.with_length(
        summarize.summarize(reviews(make_reviews), PARAMS, batch(call))
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("prod-001", "Name prod-001 1", 3, "Name prod-001 1", 15),
        ("prod-002", "Name prod-002 0", 2, "Name prod-002 0", 15),
    ]


def test_failure_is_an_empty_summary(make_reviews):
    def call(prompt, *_):
        if "prod-001" in prompt:
            raise TimeoutError
        return "fine"

    rows = summarize.summarize(reviews(make_reviews), PARAMS, batch(call)).collect()
    assert [r["summary"] for r in rows] == ["", "fine"]


def test_no_reviews(make_reviews):
    assert summarize.summarize(make_reviews(), PARAMS, batch(lambda *_: "x")).collect() == []


@pytest.mark.parametrize("count", [4, 5, 17, 64, 65])
def test_large_product_in_rounds(make_reviews, count):
    """Every review reaches a call once; rounds end in one summary per product."""
    params = Params(target_languages=("fr",), prompt_reviews=4)
    rows = [{"product_id": "big", "title": f"<{i}>", "seq": i * 30_000} for i in range(count)]
    df = make_reviews(*rows, {"product_id": "small", "title": "<s>", "seq": 5})

    def call(prompt, *_):
        lines = prompt.split("Reviews:\n")[1].splitlines()
        assert len(lines) <= 4
        return "+".join(re.findall(r"<\w+>", prompt))

    got = {r["product_id"]: r for r in summarize.summarize_tree(df, params, batch(call)).collect()}
    assert got["big"]["summary"] == "+".join(f"<{i}>" for i in range(count))
    assert got["big"]["review_count"] == count
    assert got["small"]["summary"] == "<s>"


def test_failed_part_fails_the_product(make_reviews):
    params = Params(target_languages=("fr",), prompt_reviews=2)
    df = make_reviews(*[{"title": f"<{i}>"} for i in range(7)])

    def call(prompt, *_):
        if "<3>" in prompt:
            raise TimeoutError
        return "ok"

    assert [r["summary"] for r in summarize.summarize_tree(df, params, batch(call)).collect()] == [""]


def packed(make_reviews, lengths, chars=2000, name="Tin Kettle"):
    rows = [
        {"review_id": f"rev-{i:04}", "product_name": name, "title": f"<{i}>", "body": chr(97 + i % 26) * n}
        for i, n in enumerate(lengths)
    ]
    params = replace(PARAMS, prompt_chars=chars)
    return make_reviews(*rows), params


@pytest.mark.parametrize("name", ["Tin Kettle", "K" * 5000])
def test_no_prompt_is_longer_than_stated_and_no_review_is_lost(make_reviews, name):
    lengths = [0, 5, 30_000, 400, 249, 250, 251, 10, 10, 1999, *[60] * 100]
    df, params = packed(make_reviews, lengths, name=name)
    found = summarize.prompts(df, params).orderBy("part").collect()
    assert [r["part"] for r in found] == list(range(len(found))) and len(found) > 10
    assert all(len(r["prompt"]) <= 2000 and r["parts"] == 2 for r in found)
    # A prompt is at least as full as one piece less than its room.
    assert all(len(r["prompt"]) >= 2000 - 2 * 250 for r in found[:-1])
    said = {}
    for r in found:
        for line in r["prompt"].split("Reviews:\n")[1].split("\n"):
            number, rest = line.split(". ", 1)
            said[int(number)] = said.get(int(number), "") + rest.removeprefix("(continued) ")
    for i, n in enumerate(lengths):
        assert said[i + 1] == f"(rating: 5) <{i}>: {chr(97 + i % 26) * n}".rstrip()


def test_one_prompt_if_it_fits(make_reviews):
    df, params = packed(make_reviews, [10, 20], 4000)
    plain = summarize.prompts(df, PARAMS).collect()
    fitting = summarize.prompts(df, params).collect()
    assert [(r["prompt"], r["parts"]) for r in fitting] == [(r["prompt"], 1) for r in plain]
    with pytest.raises(ValueError, match="prompt_chars"):
        replace(PARAMS, prompt_chars=10)


def test_rounds_by_length(make_reviews):
    df, params = packed(make_reviews, [300] * 60)
    calls = Provider.batch(lambda: lambda prompt, *_: "+".join(re.findall(r"<\d+>", prompt)))
    (row,) = summarize.summarize_tree(df, params, calls).collect()
    assert row["summary"] == "+".join(f"<{i}>" for i in range(60)) and row["review_count"] == 60
    long = Provider.batch(lambda: lambda prompt, *_: prompt)
    with pytest.raises(ValueError, match="too long"):
        summarize.summarize_tree(df, params, long)
