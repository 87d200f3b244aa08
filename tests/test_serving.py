import pytest
from pyspark.sql import functions as F

from revlens.operators import serving
from revlens.params import Params
from revlens.schema import QUALITY, TRANSLATIONS

PARAMS = Params(target_languages=("fr", "de"))
COLUMNS = (
    "seq long, review_id string, product_id string, source_language string, rating int,"
    f" title string, body string, translations {TRANSLATIONS}, quality {QUALITY}"
)


def text(lang):
    return (f"title-{lang}", f"body-{lang}", "e")


@pytest.fixture()
def scored(spark):
    return spark.createDataFrame(
        [
            (0, "rev-0001", "prod-001", "en", 5, "Fine", "Okay", {}, {}),
            (1, "rev-0002", "prod-001", "es", 4, "Bien", "Vale",
             {"fr": text("fr"), "de": text("de")}, {"fr": (4.6, True), "de": (1.9, False)}),
            (2, "rev-0003", "prod-002", "fr", 2, "Bof", "Bof",
             {"fr": text("fr"), "de": text("de")}, {"fr": (1.0, False)}),
            (3, "rev-0004", "prod-003", "fr", 2, "Bof", "Bof", {}, {}),
            (4, "rev-0005", "prod-004", "en", 3, "Odd", "Odd", {"de": text("de")}, {"de": (5.0, True)}),
        ],
        COLUMNS,
    )


@pytest.fixture()
def summaries(spark):
    return spark.createDataFrame(
        [("prod-001", "One", 2, "good"), ("prod-009", "Nine", 0, "only a summary")],
        "product_id string, product_name string, review_count long, summary string",
    )


def test_entries(scored):
    rows = serving.served_entries(scored, PARAMS).orderBy("seq").collect()
    assert [(r["review_id"], r["language"], r["title"], r["rating"]) for r in rows] == [
        ("rev-0001", "en", "Fine", 5),
        ("rev-0002", "fr", "title-fr", 4),
        ("rev-0005", "de", "title-de", 3),
    ]
    both = serving.original_entries(scored, PARAMS).unionByName(serving.kept_entries(scored, PARAMS))
    assert sorted(both.collect()) == sorted(rows)


def test_headers_and_lookups(spark, scored, summaries):
    headers = serving.product_headers(scored, summaries)
    ids = ["prod-001", "prod-002", "prod-009", "prod-999"]
    asked = spark.createDataFrame([(i,) for i in ids * 2], "product_id string")
    pages = serving.lookup(asked, headers).distinct().orderBy("product_id").collect()
    assert [(r["product_id"], r["found"], r["error"], r["summary"]) for r in pages] == [
        ("prod-001", True, None, "good"),
        ("prod-002", True, None, ""),
        ("prod-009", True, None, "only a summary"),
        ("prod-999", False, "not_found", None),
    ]
    found = serving.lookup_summaries(asked, headers).distinct().orderBy("product_id").collect()
    assert [(r["found"], r["error"]) for r in found] == [
        (True, None), (False, "not_found"), (True, None), (False, "not_found"),
    ]


def test_last_summary_wins(spark):
    df = spark.createDataFrame(
        [("p", "a", 1, "old", 1), ("p", "b", 2, "new", 3), ("p", "c", 3, "mid", 2)],
        "product_id string, product_name string, review_count long, summary string, seq long",
    )
    assert tuple(serving.latest_summaries(df).first()) == ("p", "b", 2, "new")


def test_pages_are_bounded_and_whole(spark):
    rows = [(i * 40_000, f"r{i}", "hot" if i % 3 else f"p{i % 2}", "en", 1, "t", f"b{i}", {}, {}) for i in range(50)]
    scored = spark.createDataFrame(rows, COLUMNS).repartition(5)
    params = Params(target_languages=("fr",), page_entries=4)
    pages = serving.product_pages(serving.served_entries(scored, params), params)
    got = {}
    for row in pages.orderBy("product_id", "page_no").collect():
        assert len(row["reviews"]) <= 4
        got.setdefault(row["product_id"], []).extend(row["reviews"])
    for product, entries in got.items():
        assert [e["position"] for e in entries] == list(range(1, len(entries) + 1))
        assert [e["review_id"] for e in entries] == [r[1] for r in rows if r[2] == product]


def test_lookup_reads_few_files(spark, scored, tmp_path):
    """Ranges of the lookup key: a product's rows lie in one file here."""
    rows = [(i, f"r{i}", f"prod-{i:03d}", "en", 1, "t", "b", {}, {}) for i in range(200)]
    entries = serving.served_entries(spark.createDataFrame(rows, COLUMNS), PARAMS)
    table = serving.product_pages(entries, PARAMS)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning(product_id" not in plan.split("Exchange rangepartitioning")[0]
    table.write.parquet(str(tmp_path / "pages"))
    got = spark.read.parquet(str(tmp_path / "pages")).where("product_id = 'prod-042'")
    assert [r["reviews"][0]["review_id"] for r in got.collect()] == ["r42"]


def test_an_unknown_id_reads_no_row_group(spark, tmp_path):
    """Ids within the range of every row group, too many for a dictionary: only the Bloom
    filters tell that an id is absent."""
    from revlens.sources.stages import StageTable

    ids = F.format_string("prod-%012d", F.col("id") * 2)
    headers = spark.range(300_000).select(ids.alias("product_id"), F.col("id").alias("reviews"))

    def rows_read(df):
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().apply("numOutputRows").value()

    for options in (serving.LOOKUP_OPTIONS, {}):
        table = StageTable(spark, str(tmp_path / str(len(options))))
        table.write(headers.coalesce(1).sortWithinPartitions("product_id"), options=options)
        # Without the filters at least a page of the column is read.
        assert (rows_read(table.read().where(F.col("product_id") == "prod-000000000101")) == 0) == bool(options)
        assert table.read().where(F.col("product_id") == "prod-000000000102").count() == 1
