from pyspark.sql import functions as F

from revlens.operators import quality, translate
from revlens.operators.providers import Judge, Provider, echo_translator, fixed_judge
from revlens.params import ModelParams, Params

PARAMS = Params(target_languages=("fr", "de"), judge_model=ModelParams("m", 7, 0.5))
ROWS = [
    {"source_language": "en"},
    {"source_language": "fr", "title": "Bon", "body": "Bien"},
    {"source_language": "es", "title": "Malo", "body": "Mal"},
]


def translated(make_reviews):
    return translate.translate(make_reviews(*ROWS), PARAMS, echo_translator())


def batch(function, replies=False):
    return Judge(Provider.batch(lambda: function), replies)


def qualities(scored):
    return {
        r["seq"]: {k: (v["score"], v["kept"]) for k, v in r["quality"].items()}
        for r in scored.collect()
    }


def test_numeric_scores_are_taken_raw(make_reviews):
    def score(source_text, translated_text, source, target, model_id, max_tokens, temperature):
        assert (model_id, max_tokens, temperature) == ("m", 7, 0.5)
        assert translated_text == f"[{target}] " + source_text.replace("\n\n", f"\n\n[{target}] ")
        return {"fr": 3, "de": 9.5}[target]

    got = qualities(quality.score_translations(translated(make_reviews), PARAMS, batch(score)))
    assert got == {0: {}, 1: {"fr": (3.0, True), "de": (9.5, True)}, 2: {"fr": (3.0, True), "de": (9.5, True)}}


def test_replies_are_parsed_and_clamped(make_reviews):
    def reply(prompt, *_):
        return "9 of 5" if "Target language: fr" in prompt else "hm"

    got = qualities(quality.score_translations(translated(make_reviews), PARAMS, batch(reply, True)))
    assert got[1] == {"fr": (5.0, True), "de": (1.0, False)}


def test_failed_call_scores_lowest(make_reviews):
    def fail(source_text, translated_text, source, target, *_):
        if target == "fr":
            raise TimeoutError
        return 4.0

    scored = quality.score(translated(make_reviews), PARAMS, batch(fail)).cache()
    assert qualities(quality.with_quality(scored))[2] == {"fr": (1.0, False), "de": (4.0, True)}
    assert quality.quality_counts(scored).first().asDict() == {
        "reviews": 3, "translations": 4, "kept": 2, "filtered": 2, "errors": 2,
    }


def test_scores_that_are_no_numbers(make_reviews):
    scored = quality.score_translations(
        translated(make_reviews), PARAMS, batch(lambda *_: float("nan"))
    )
    assert all(not kept for q in qualities(scored).values() for _, kept in q.values())
    worded = quality.score_translations(translated(make_reviews), PARAMS, batch(lambda *_: "good"))
    assert qualities(worded)[1]["fr"] == (1.0, False)


def test_filter_keeps_every_review(make_reviews):
    judge = Judge(Provider.native(lambda s, t, source, target, *_: F.when(target == "de", 4.0).otherwise(2.0)))
    kept = quality.filter_kept(quality.score_translations(translated(make_reviews), PARAMS, judge))
    rows = {r["seq"]: r for r in kept.collect()}
    assert [list(rows[i]["translations"]) for i in range(3)] == [[], ["de"], ["de"]]
    assert [list(rows[i]["quality"]) for i in range(3)] == [[], ["de"], ["de"]]


def test_nothing_kept_and_nothing_to_judge(make_reviews):
    none = quality.filter_kept(
        quality.score_translations(translated(make_reviews), PARAMS, fixed_judge(1.0))
    )
    assert [r["translations"] for r in none.collect()] == [{}, {}, {}]
    empty = quality.score(translated(make_reviews).limit(0), PARAMS, fixed_judge(5.0))
    assert quality.quality_counts(empty).first().asDict() == {
        "reviews": 0, "translations": 0, "kept": 0, "filtered": 0, "errors": 0,
    }
