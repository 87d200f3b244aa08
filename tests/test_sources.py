import json

import pytest
from samples import review

from revlens.operators import ingest, synth
from revlens.params import ReviewRules
from revlens.sources import envelopes, library, records, tables

RULES = ReviewRules()


def envelope(rows):
    return json.dumps(
        {"schema_version": "1.0.0", "generated_at": "2026-01-01T00:00:00Z", "reviews": rows}
    )


def test_envelope_and_bare_array(spark, tmp_path):
    folder = tmp_path / "two files"
    folder.mkdir()
    (folder / "a.json").write_text(envelope([review(title="1"), "bad", review(title="2")]))
    (folder / "b.json").write_text(json.dumps([review(title="3")]))
    rows = envelopes.read_envelopes(spark, str(folder))
    assert rows.count() == 4
    good = ingest.valid(ingest.check(rows, RULES)).orderBy("seq").collect()
    assert [r["title"] for r in good] == ["1", "2", "3"]
    assert [r["seq"] for r in good] == [0, 2, 1 << 32]


def test_bare_arrays_can_be_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([review()]))
    with pytest.raises(ValueError, match="holds no reviews array"):
        envelopes.read_envelopes(spark, str(tmp_path), bare_arrays=False)


def test_empty_array_gives_no_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    assert envelopes.read_envelopes(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize(
    "text", ["{bad", "", "5", '"text"', "null", '{"a": 1}', '{"reviews": {}}', '{"reviews": null}']
)
def test_unusable_files(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(ValueError, match="a.json"):
        envelopes.read_envelopes(spark, str(tmp_path))
    if text:
        with pytest.raises(Exception, match="a.json"):
            envelopes.read_envelopes(spark, str(tmp_path), check=False).collect()


def test_bytes_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'["\xff\xfe"]')
    with pytest.raises(ValueError, match="not valid JSON"):
        envelopes.read_envelopes(spark, str(tmp_path))


def test_missing_path_and_wrong_type(spark, tmp_path):
    with pytest.raises(ValueError):
        envelopes.read_envelopes(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        envelopes.read_envelopes(spark, 42)


def test_plain_json_lines(spark, make_reviews, tmp_path):
    path = tmp_path / "plain.jsonl"
    row = {"n": 7, **make_reviews({}).drop("seq").first().asDict()}
    path.write_text("\n".join([json.dumps(row), "[1]", "no json"]))
    read = records.read_json_lines(spark, str(path), order="n")
    checked = ingest.check(read, RULES)
    assert [r["review_id"] for r in ingest.valid(checked).collect()] == ["rev-0001"]
    assert sorted(str(r["seq"]) for r in read.collect()) == ["7", "None", "None"]


def test_json_lines_round_trip(spark, make_reviews, tmp_path):
    df = make_reviews({"title": "é\n\"x\""}, {"rating": 1}, {"source_language": "fr"})
    records.write_json_lines(df, str(tmp_path / "lines"))
    back = ingest.valid(ingest.check(records.read_json_lines(spark, str(tmp_path / "lines")), RULES))
    assert back.orderBy("seq").collect() == df.collect()
    line = spark.read.text(str(tmp_path / "lines")).orderBy("value").first()[0]
    assert list(json.loads(line)["record"]) == list(review())


def test_envelopes_round_trip_in_bounded_files(spark, make_reviews, tmp_path):
    df = make_reviews(*[{"review_id": f"rev-{i:04d}", "seq": i * 70_000} for i in range(7)])
    path = str(tmp_path / "out")
    envelopes.write_envelopes(df, path, "2026-01-01T00:00:00Z", per_file=3)
    files = sorted((tmp_path / "out").glob("part=*/*.txt"))
    sizes = [len(json.loads(f.read_text())["reviews"]) for f in files]
    assert sizes == [3, 3, 1]
    assert list(json.loads(files[0].read_text())) == ["schema_version", "generated_at", "reviews"]
    back = ingest.valid(ingest.check(envelopes.read_envelopes(spark, path), RULES)).orderBy("seq")
    assert [r["review_id"] for r in back.collect()] == [f"rev-{i:04d}" for i in range(7)]


def test_envelopes_are_checked_before_writing(make_reviews, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(ValueError, match="2 violations"):
        envelopes.write_envelopes(
            make_reviews({"rating": 9, "title": ""}), path, "2026-01-01T00:00:00Z"
        )
    with pytest.raises(ValueError, match="no reviews"):
        envelopes.write_envelopes(make_reviews(), path, "2026-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="timestamp"):
        envelopes.write_envelopes(make_reviews({}), path, "some day")


def test_table_round_trip(spark, make_reviews, tmp_path):
    df = make_reviews({}, {})
    back = tables.write_table(df, str(tmp_path / "t"))
    assert back.orderBy("seq").collect() == df.collect()
    again = tables.write_table(make_reviews({}), str(tmp_path / "t"))
    assert again.count() == 1


def test_shared_folder_is_the_named_one(spark):
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def content(**changes):
    lists = {
        kind: {
            mood: [f"{kind} {mood} {i} of {{product}}" for i in range(4)]
            for mood in ("positive", "neutral", "negative")
        }
        for kind in ("titles", "sentences")
    }
    made = {
        "schema_version": "1.0.0",
        "products": [
            {"product_id": f"prod-{i:03d}", "product_name": f"Product {i}"} for i in range(10)
        ],
        "phrases": {lang: json.loads(json.dumps(lists)) for lang in ("en", "fr", "de", "es", "it", "pt")},
    }
    return {**made, **changes}


@pytest.fixture()
def load(spark, tmp_path):
    def load(raw):
        (tmp_path / "library.json").write_text(json.dumps(raw))
        return library.read_library(spark, str(tmp_path / "library.json"))

    return load


def test_library(load):
    products, phrases = load(content())
    assert products.count() == 10
    assert phrases.count() == 6 * 2 * 3 * 4
    assert phrases.where("lang = 'fr' and kind = 'titles' and sentiment = 'neutral' and idx = 2").first()[
        "phrase"
    ] == "titles neutral 2 of {product}"


def broken():
    short = content()
    short["phrases"]["it"]["titles"]["neutral"] = ["a", "b"]
    yield short, "phrases/it/titles/neutral"
    lost = content()
    del lost["phrases"]["pt"]
    yield lost, "phrases/pt/sentences/negative"
    yield content(products=content()["products"][:9]), "products"
    yield content(products=content()["products"] * 2), "products"
    yield content(products=[{"product_id": "x", "product_name": "y"}] * 10), "products"
    yield content(schema_version="2"), "schema_version"
    yield content(schema_version=1), "schema_version"
    numbered = content()
    numbered["products"][3]["product_name"] = 5
    yield numbered, "products"
    typed = content()
    typed["phrases"]["en"]["titles"]["neutral"][1] = True
    yield typed, "phrases"
    yield content(extra=1), "<root>"
    empty = content()
    empty["phrases"]["en"]["titles"]["neutral"][0] = ""
    yield empty, "empty phrase"
    foreign = content()
    foreign["phrases"]["nl"] = foreign["phrases"]["en"]
    yield foreign, "unknown language"
    yield {}, "schema_version"


@pytest.mark.parametrize("raw, place", list(broken()))
def test_broken_libraries(load, raw, place):
    with pytest.raises(ValueError, match=place):
        load(raw)


def test_generated_reviews(load, spark):
    products, phrases = load(content())
    made = synth.generate(products, phrases, total=137, seed=7)
    rows = made.orderBy("seq").collect()
    assert [r["review_id"] for r in rows] == [f"rev-{i:04d}" for i in range(1, 138)]
    counts = {}
    for row in rows:
        counts[row["source_language"]] = counts.get(row["source_language"], 0) + 1
    assert list(counts.items()) == [("en", 55), ("fr", 21), ("de", 20), ("es", 20), ("it", 11), ("pt", 10)]
    assert ingest.counts(ingest.check(made, RULES)).first()["valid"] == 137
    moods = {5: "positive", 4: "positive", 3: "neutral", 2: "negative", 1: "negative"}
    for row in rows:
        assert "{product}" not in row["title"] + row["body"]
        assert f"titles {moods[row['rating']]} " in row["title"]
        sentences = row["body"].split("sentences ")[1:]
        assert 1 <= len(sentences) <= 3
        assert len({s.strip() for s in sentences}) == len(sentences)
        assert all(s.startswith(moods[row["rating"]]) for s in sentences)
    assert synth.generate(products, phrases, 137, 7).orderBy("seq").collect() == rows
    assert synth.generate(products, phrases, 137, 8).orderBy("seq").collect() != rows


def test_reviews_made_range_by_range(load, spark):
    """The same reviews, and no shuffle of an earlier range is left when the next one is made."""
    products, phrases = load(content())
    left = []

    def shuffles():
        folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(f.getName().startswith("shuffle_") for f in _listed(folder.getAllFiles()))

    def finish(made):
        left.append(shuffles())
        return made

    whole = synth.generate(products, phrases, 137, 7).orderBy("seq").collect()
    table = synth.generate_table(products, phrases, 137, 7, finish, part_rows=20)
    assert table.orderBy("seq").collect() == whole
    assert len(left) == 7 and left[-1] <= left[1]
    assert synth.generate_table(products, phrases, 0, 7, lambda made: made).count() == 0


def _listed(files):
    return [files.apply(i) for i in range(files.length())]


def test_large_dataset_is_several_files_in_order(spark, make_reviews, tmp_path, monkeypatch):
    """No task writes or reads all records; ``seq`` goes on from file to file."""
    from revlens.plans import driver_tables as driver, queries

    monkeypatch.setattr(driver, "FILE_RECORDS", 4)
    reviews = make_reviews(*[{"seq": 3 * i, "body": f"text {i} }} {{"} for i in range(11)]).repartition(3)
    driver.write_dataset(reviews, str(tmp_path / "files"))
    assert len(list((tmp_path / "files").glob("file_no=*/*.txt"))) == 3
    monkeypatch.setattr(driver, "reviews", lambda *_: reviews)
    rows = queries.read_envelope(spark, "unused").orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(11))
    expected = [r[0] for r in reviews.orderBy("seq").selectExpr("md5(body)").collect()]
    assert [r["body_md5"] for r in rows] == expected


@pytest.mark.parametrize("total", [1, 50, 97, 100, 123, 250])
def test_quotas(spark, total):
    rows = synth.quotas(spark.createDataFrame([(0, total)], "plan int, total long")).orderBy("ord").collect()
    assert sum(r["quota"] for r in rows) == total
    if total == 100:
        assert [r["quota"] for r in rows] == [40, 15, 15, 15, 8, 7]
