"""One file read in byte ranges: the same records as one parser gives, wherever it is cut."""

import json
import random

import pytest
from samples import review
from test_sources import envelope

from revlens.sources import envelopes, splits


def read(spark, folder, chunk_bytes, monkeypatch, **more):
    monkeypatch.setattr(splits.split_records, "__defaults__", (chunk_bytes,))
    rows = envelopes.read_envelopes(spark, str(folder), whole_bytes=0, **more)
    return [(r["seq"], json.loads(str(r["record"]))) for r in rows.selectExpr("seq", "to_json(record) AS record").collect()]


ODD = [
    review(title='a "quoted" } brace { and ] , [ \\'), review(body="\\\\\" }{ \\u007d é\U0001f600"), "text, with } and \"",
    42, None, True, [1, {"reviews": [2]}, "x}"], {}, {"deep": {"er": [{"reviews": [1, 2]}, "}"]}}, "", review(title="last"),
]


@pytest.mark.parametrize("chunk_bytes", [1, 40, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_odd_values(spark, tmp_path, monkeypatch, chunk_bytes, indent):
    """Braces and brackets in strings, nested arrays of the same name, scalars, white space."""
    document = {"meta": {"reviews": [0], "x": "}"}, "n": [1, {"a": 2}], "reviews": ODD, "after": {"b": [3]}}
    (tmp_path / "a.json").write_text(json.dumps(document, indent=indent))
    (tmp_path / "b.json").write_text(json.dumps(ODD[::-1], indent=indent, ensure_ascii=False))
    expected = list(enumerate(ODD)) + [((1 << 32) + i, x) for i, x in enumerate(ODD[::-1])]
    assert sorted(read(spark, tmp_path, chunk_bytes, monkeypatch), key=lambda r: r[0]) == expected


def test_byte_ranges_of_one_file(spark, tmp_path, monkeypatch):
    """Ranges that begin in strings, in nested objects, between elements."""
    rng = random.Random(5)
    rows = [
        rng.choice([
            review(title="}" * rng.randrange(9), body='\\"' * rng.randrange(40) + "},{" * rng.randrange(60)),
            {"n": {"m": [{"k": i}, {"l": "]"}]}}, i, f"s{i}}}",
        ])
        for i in range(600)
    ]
    (tmp_path / "a.json").write_text(envelope(rows))
    size = (tmp_path / "a.json").stat().st_size
    settings = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert lines.rdd.getNumPartitions() > 10 and size > 30_000  # more than one busy task
        found = read(spark, tmp_path, 700, monkeypatch)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(found, key=lambda r: r[0]) == list(enumerate(rows))


@pytest.mark.parametrize("text", ["[]", " [ ]\n", '{"reviews": []}', '{"reviews":[1],"reviews":[ ]}'])
def test_no_records(spark, tmp_path, monkeypatch, text):
    (tmp_path / "a.json").write_text(text)
    assert read(spark, tmp_path, 5, monkeypatch) == []


def test_the_last_array_counts(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text('{"reviews":[{"a":1},{"a":2}],"x":"}","re\\u0076iews":[{"a":3}, 4]}')
    for chunk_bytes in (1, 1000):
        assert sorted(read(spark, tmp_path, chunk_bytes, monkeypatch), key=str) == [(0, {"a": 3}), (1, 4)]


@pytest.mark.parametrize(
    "text",
    ["{bad", "5", '"text"', "null", '{"a": 1}', '{"reviews": {}}', '{"reviews": null}', '{"reviews": [1, 2', '[{"a": 1}',
     '{"reviews": [1]} {}', '{"reviews": [1]} }', "[1] 2", "[1 2]", '[{"a": 1}{"b": 2}]', '{"reviews": [1]', "[1,,2]", "[1,]", '[{"a": "x]', '{"reviews": [1}]', "[1]]", '{"reviews": [{"a" 1}]}'],
)
def test_unusable_files(spark, tmp_path, monkeypatch, text):
    (tmp_path / "good.json").write_text(envelope([review()]))
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(ValueError, match=r"a\.json (is not valid JSON|holds no reviews array)$"):
        read(spark, tmp_path, 7, monkeypatch)
    with pytest.raises(Exception, match="a.json"):
        read(spark, tmp_path, 7, monkeypatch, check=False)


def test_small_and_large_files_side_by_side(spark, tmp_path):
    for name, n in (("a", 1), ("b", 200), ("c", 2)):
        (tmp_path / f"{name}.json").write_text(envelope([review(title=f"{name}{i}") for i in range(n)]))
    rows = envelopes.read_envelopes(spark, str(tmp_path), whole_bytes=5000)
    titles = rows.selectExpr("seq", "variant_get(record, '$.title', 'string') AS t").orderBy("seq").collect()
    assert [r["t"] for r in titles] == ["a0", *[f"b{i}" for i in range(200)], "c0", "c1"]
    assert [r["seq"] >> 32 for r in titles] == [0] + [1] * 200 + [2] * 2
