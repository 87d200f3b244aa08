import pytest
from pyspark.sql import functions as F

from revlens.operators import evaluate, quality, translate
from revlens.operators.providers import Judge, Provider, echo_translator, fixed_judge
from revlens.params import Params

PARAMS = Params(target_languages=("fr", "de"))
TEXTS = {
    "fr": {"Joli": "Joli", "Solide.": "Solide.", "Kaputt": "Casse", "Rau.": "Rugueux."},
    "de": {"Joli": "Hübsch", "Solide.": "Stabil.", "Kaputt": "Kaputt", "Rau.": "Rau."},
}
ROWS = [
    {"review_id": "rev-1", "product_id": "prod-1", "source_language": "fr", "title": "Joli", "body": "Solide."},
    {"review_id": "rev-2", "product_id": "prod-2", "source_language": "de", "title": "Kaputt", "body": "Rau."},
    {"review_id": "rev-3", "product_id": "prod-3", "source_language": "en", "title": "Nice", "body": "Works."},
]


def batch(function):
    return Provider.batch(lambda: function)


def forward():
    return batch(lambda text, source, target: TEXTS[target][text])


def back(text, source, target):
    return {v: k for k, v in TEXTS[source].items()}[text]


def judge():
    def score(source_text, translated_text, *_):
        return 1.0 if translated_text == "Casse\n\nRugueux." else 5.0

    return Judge(batch(score))


@pytest.fixture()
def translated(make_reviews):
    return translate.translate(make_reviews(*ROWS), PARAMS, forward())


def test_figures(translated):
    result = evaluate.evaluate(PARAMS, batch(back), judge(), translated=translated)
    per = {r["language"]: r for r in result.per_language.collect()}
    assert list(per) == ["fr", "de"]
    assert (per["fr"]["kept_count"], per["fr"]["filtered_count"], per["fr"]["kept_pct"]) == (1, 1, 50.0)
    assert (per["de"]["kept_count"], per["de"]["filtered_count"]) == (2, 0)
    assert per["fr"]["mean_judge_score"] == 3.0 and per["fr"]["mean_similarity"] == 1.0
    total = result.overall.first()
    assert (total["total_reviews"], total["translated_reviews"], total["total_translations"]) == (3, 2, 4)
    assert (total["overall_kept"], total["overall_filtered"], total["overall_kept_pct"]) == (3, 1, 75.0)
    assert (total["quality_threshold"], total["scale_min"], total["scale_max"]) == (3.0, 1.0, 5.0)
    details = result.details.orderBy("seq", "entry").collect()
    assert [(r["review_id"], r["language"], r["judge_score"], r["kept"], r["similarity"]) for r in details] == [
        ("rev-1", "fr", 5.0, True, 1.0), ("rev-1", "de", 5.0, True, 1.0),
        ("rev-2", "fr", 1.0, False, 1.0), ("rev-2", "de", 5.0, True, 1.0),
    ]


def test_from_raw_records(make_reviews):
    df = make_reviews(
        {"source_language": "fr"}, {"rating": 9, "source_language": "fr"}, {"source_language": "en"}
    )
    result = evaluate.evaluate(PARAMS, echo_translator(), fixed_judge(5.0), source=df)
    assert result.overall.first()["total_reviews"] == 2
    assert [r["translation_count"] for r in result.per_language.collect()] == [1, 1]
    with pytest.raises(ValueError):
        evaluate.evaluate(PARAMS, echo_translator(), fixed_judge(5.0))


def test_calls_are_made_once(spark, make_reviews):
    calls = spark.sparkContext.accumulator(0)

    def count(text, source, target):
        calls.add(1)
        return text

    result = evaluate.evaluate(
        PARAMS, batch(count), judge(), translated=translate.translate(make_reviews(*ROWS), PARAMS, echo_translator())
    )
    result.details.collect(), result.per_language.collect(), result.overall.collect()
    assert calls.value == 8


def test_failed_back_translation(translated):
    def fail(text, source, target):
        if source == "fr" and text in ("Joli", "Rugueux."):
            raise KeyError(text)
        return back(text, source, target)

    rows = {
        (r["review_id"], r["language"]): r
        for r in evaluate.back_translate(translated, batch(fail)).collect()
    }
    assert len(rows) == 4
    title_failed = rows["rev-1", "fr"]
    assert (title_failed["similarity"], title_failed["error"]) == (0.0, "KeyError")
    assert title_failed["back_title"] is None and title_failed["back_body"] is None
    body_failed = rows["rev-2", "fr"]
    assert (body_failed["back_title"], body_failed["back_body"], body_failed["similarity"]) == ("Kaputt", None, 0.0)
    assert rows["rev-2", "de"]["error"] is None


def judged(spark, *rows):
    return spark.createDataFrame(
        rows, "seq long, entry int, review_id string, product_id string, language string,"
        " judge_score double, kept boolean, similarity double",
    )


def test_repeated_ids_take_the_last_similarity(spark):
    df = judged(
        spark,
        (0, 0, "r", "p", "fr", 4.0, True, 0.1),
        (5, 0, "r", "p", "fr", 2.0, False, 0.5),
        (3, 0, "r", "p", "fr", 4.0, True, 0.9),
        (4, 0, "s", "p", "fr", 4.0, True, 0.1),
    )
    assert sorted(r["similarity"] for r in evaluate.details(df).collect()) == [0.1, 0.5, 0.5, 0.5]
    row = evaluate.language_metrics(df, PARAMS).where("language = 'fr'").first()
    assert (row["translation_count"], row["kept_count"], row["mean_judge_score"], row["mean_similarity"]) == (4, 3, 3.5, 0.4)


def test_languages_without_rows_and_not_configured(spark):
    rows = evaluate.language_metrics(judged(spark, (0, 0, "r", "p", "it", 4.0, True, 0.5)), PARAMS).collect()
    assert [(r["lang_pos"], r["language"], r["translation_count"]) for r in rows] == [
        (0, "fr", 0), (1, "de", 0), (None, "it", 1),
    ]
    assert rows[0]["mean_judge_score"] is None and rows[0]["kept_pct"] == 0.0


def test_nothing_to_evaluate(make_reviews):
    result = evaluate.evaluate(PARAMS, echo_translator(), fixed_judge(5.0), source=make_reviews())
    total = result.overall.first()
    assert (total["total_translations"], total["overall_kept_pct"]) == (0, 0.0)
    assert [r["translation_count"] for r in result.per_language.collect()] == [0, 0]


def test_report(spark):
    rows = spark.createDataFrame(
        [(0, "fr", 60, 57, 3, 4.6, 0.88, 95.0, 5.0), (1, "de", 60, 60, 0, 4.8, 0.9, 100.0, 0.0),
         (2, "it", 0, 0, 0, None, None, 0.0, 0.0), (None, "pt", 1, 1, 0, 5.0, 1.0, 100.0, 0.0)],
        "lang_pos int, language string, translation_count long, kept_count long, filtered_count long,"
        " mean_judge_score double, mean_similarity double, kept_pct double, filtered_pct double",
    )
    assert [tuple(r)[1:] for r in evaluate.report_rows(rows).collect()] == [
        ("fr", "60", "4.6", "0.88", "57", "3", "95%"),
        ("de", "60", "4.8", "0.9", "60", "0", "100%"),
        ("it", "0", "–", "–", "0", "0", "0%"),
    ]


def test_partitions_do_not_matter(spark, make_reviews):
    rows = [
        {"source_language": ["en", "fr", "es"][i % 3], "review_id": f"rev-{i // 4}", "title": f"t {i}", "body": "b " * (i % 7)}
        for i in range(60)
    ]
    df = make_reviews(*rows)
    score = Judge(Provider.native(lambda s, t, *_: 1.0 + F.length(t) % 5))

    def figures(source):
        made = quality.score_translations(
            translate.translate(source, PARAMS, echo_translator()), PARAMS, score
        )
        pairs = evaluate.judged_round_trips(made, echo_translator())
        return evaluate.language_metrics(pairs, PARAMS).collect()

    once = figures(df.coalesce(1))
    assert once == figures(df.repartition(8, F.rand(3)))
