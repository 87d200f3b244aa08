import pytest
from pyspark.sql import functions as F

from revlens.operators import translate
from revlens.operators.providers import Provider, call_each, echo_translator
from revlens.params import Params

PARAMS = Params(target_languages=("fr", "de"), engine="test")
MIXED = [
    {"source_language": "en"},
    {"source_language": "fr", "title": "Bon", "body": "Bien"},
    {"source_language": "es", "title": "Bon", "body": "Bien"},
    {"source_language": "de", "title": "Gut", "body": "Gut"},
]


def batch(function):
    return Provider.batch(lambda: function)


def by_seq(df):
    return {r["seq"]: r for r in df.collect()}


def test_routes_and_languages(make_reviews):
    df = make_reviews(*MIXED)
    rows = by_seq(translate.translate(df, PARAMS, echo_translator()))
    assert rows[0]["translations"] == {}
    for seq in (1, 2, 3):
        # The source's own language is a target like any other.
        assert list(rows[seq]["translations"]) == ["fr", "de"]
    assert rows[1]["translations"]["de"].asDict() == {
        "title": "[de] Bon", "body": "[de] Bien", "engine": "test",
    }
    assert translate.route_counts(df, PARAMS).first().asDict() == {
        "reviews_in": 4, "translated_reviews": 3, "passthrough_reviews": 1,
    }


def test_other_passthrough_language(make_reviews):
    params = Params(target_languages=("en",), passthrough_language="fr")
    rows = by_seq(translate.translate(make_reviews(*MIXED), params, echo_translator()))
    assert [len(rows[i]["translations"]) for i in range(4)] == [1, 0, 1, 1]


def test_fan_out(make_reviews):
    rows = translate.fan_out(make_reviews(*MIXED), PARAMS).orderBy("seq", "lang_pos").collect()
    assert [(r["seq"], r["lang_pos"], r["target_language"]) for r in rows] == [
        (s, i, lang) for s in (1, 2, 3) for i, lang in enumerate(("fr", "de"))
    ]


@pytest.mark.parametrize("distinct", [False, True])
def test_one_failed_field_loses_the_language(make_reviews, distinct):
    def fail_body(text, source, target):
        if target == "fr" and text == "Bien":
            raise ConnectionError("customer text")
        return f"{source}>{target}:{text}"

    attempted = translate.attempt(make_reviews(*MIXED), PARAMS, batch(fail_body), distinct)
    done = translate.with_translations(attempted, PARAMS).cache()
    rows = by_seq(done)
    assert list(rows[1]["translations"]) == ["de"]
    assert rows[1]["translations"]["de"]["title"] == "fr>de:Bon"
    assert rows[2]["translations"]["de"]["title"] == "es>de:Bon"
    assert list(rows[3]["translations"]) == ["fr", "de"]
    lost = translate.failed_translations(done).orderBy("seq").collect()
    assert [(r["seq"], r["lang_pos"], r["target_language"], r["error"]) for r in lost] == [
        (1, 0, "fr", "ConnectionError"), (2, 0, "fr", "ConnectionError"),
    ]


def test_all_failed_is_an_empty_map(make_reviews):
    def fail(*_):
        raise RuntimeError

    rows = by_seq(translate.translate(make_reviews(*MIXED), PARAMS, batch(fail)))
    assert len(rows) == 4
    assert all(r["translations"] == {} for r in rows.values())


def test_no_reply_is_a_failure(make_reviews):
    rows = by_seq(translate.translate(make_reviews(*MIXED), PARAMS, batch(lambda *_: None)))
    assert rows[1]["translations"] == {}


def test_answer_of_another_kind_is_a_failure(make_reviews):
    attempted = translate.attempt(make_reviews(MIXED[1]), PARAMS, batch(lambda *_: 5))
    assert attempted.first()["attempts"][0]["error"] == "TypeError"


def test_no_client_without_work(make_reviews):
    def make():
        raise AssertionError("built for passthrough reviews")

    df = make_reviews({}, {}).coalesce(1)
    assert translate.translate(df, PARAMS, Provider.batch(make)).count() == 2


def test_null_text_is_passed_on(make_reviews):
    df = make_reviews({"source_language": "fr", "title": None})
    for distinct in (False, True):
        made = translate.translate(df, PARAMS, batch(lambda t, s, g: t.upper()), distinct)
        assert made.first()["translations"] == {}


def test_three_ways_agree_on_hot_texts(spark, make_reviews):
    """A title that a third of the reviews share, in one and in eight partitions."""
    rows = [
        {
            "source_language": ["en", "fr", "es"][i % 3],
            "title": "Super" if i % 3 == 1 else f"t{i}",
            "body": f"b{i % 5}",
        }
        for i in range(60)
    ]
    df = make_reviews(*rows)

    def tag(text, source, target):
        return f"[{target}] {text}"

    def flat(made):
        return sorted(
            (r["seq"], {k: v.asDict() for k, v in r["translations"].items()}) for r in made.collect()
        )

    native = flat(translate.translate(df, PARAMS, echo_translator()))
    for parts in (1, 8):
        spread = df.repartition(parts, F.rand(parts))
        for distinct in (False, True):
            assert flat(translate.translate(spread, PARAMS, batch(tag), distinct)) == native


def test_distinct_texts_are_sent_once(spark, make_reviews):
    calls = spark.sparkContext.accumulator(0)

    def count(text, source, target):
        calls.add(1)
        return text

    df = make_reviews(*[{"source_language": "fr", "title": "same", "body": f"b{i % 2}"} for i in range(40)])
    made = translate.translate(df, PARAMS, batch(count), distinct_texts=True)
    made.collect(), made.collect()
    assert calls.value == 3 * len(PARAMS.target_languages)


def test_calls_that_belong_together(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()
    folder = str(log)

    def make():
        from pathlib import Path
        from uuid import uuid4

        def call(text):
            (Path(folder) / f"{text}-{uuid4().hex}").touch()
            if text.startswith("bad"):
                raise ValueError(text)
            return text.upper()

        return call

    rows = [(0, ["bad0", "b0"]), (1, ["a1", "b1", "bad1", "d1"]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "seq long, texts array<string>").repartition(3)
    calls = F.transform("texts", lambda t: F.struct(t.alias("text")))
    done = call_each(df, Provider.batch(make), calls, ["text"], "out", "string", together=2)
    found = {r["seq"]: [tuple(o) for o in r["out"] or []] for r in done.where("seq >= 0").collect()}
    assert found == {
        0: [(None, "ValueError"), (None, "NotAsked")],
        1: [("A1", None), ("B1", None), (None, "ValueError"), (None, "NotAsked")],
        2: [],
        3: [],
    }
    # Once per item, and not at all behind a failure.
    assert sorted(p.name.split("-")[0] for p in log.iterdir()) == ["a1", "b1", "bad0", "bad1"]
