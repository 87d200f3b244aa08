"""The pipeline's stages against their definitions, on the driver's smallest tables and odd rows."""

from pathlib import Path

import brute
import duckdb
import pytest
from odd_rows import ODD, SCHEMA

import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "pii", "mixing"]
    rows = {r.doc_id: r for r in docs.collect()}

    single = {r.doc_id for r in stages["near_duplicates"](spark, docs, SF).collect()}
    ids = sorted(rows)
    components = brute.jaccard([rows[i].text for i in ids], width=5, percent=80)
    assert single == {ids[top] for _, top in components}

    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    clean = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    hits = brute.contamination([rows[i].text for i in ids], items)
    assert clean == {i for i, (_, hit, _) in zip(ids, hits) if not hit}

    for r in stages["pii"](spark, docs, SF).collect():
        assert brute.pii(r.text)[0] == [0, 0, 0, 0]
        assert r.n_chars == len(r.text)
        if brute.pii(rows[r.doc_id].text)[0] == [0, 0, 0, 0] and "[" not in r.text:
            assert r.text == rows[r.doc_id].text

    kept = {r.doc_id for r in stages["quality"](spark, docs, SF).collect()}
    good = duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE quality = 1").fetchall()
    assert sum(i in kept for (i,) in good) >= 0.9 * len(good)


def test_near_copies_of_five_words_and_80_percent(spark):
    """Pairs on both sides of the rule, which 4 words and 85 % would all leave in."""
    rows = {}
    for name, places in (("a", (30, 70)), ("b", (20, 50, 80))):  # 86 of 106 and 81 of 111 shingles
        words = [f"{name}{i}" for i in range(100)]
        changed = [f"new{w}" if i in places else w for i, w in enumerate(words)]
        rows |= {len(rows): " ".join(words), len(rows) + 1: " ".join(changed)}
    expected = brute.jaccard(list(rows.values()), width=5, percent=80)
    assert [top for _, top in expected] == [0, 0, 2, 3]
    assert [top for _, top in brute.jaccard(list(rows.values()))] == [0, 1, 2, 3]
    docs = spark.createDataFrame(
        [(i, text, "en", "a", len(text)) for i, text in rows.items()],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    found = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()
    assert {r.doc_id for r in found} == {0, 2, 3}


def test_near_duplicates_on_driver_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    expected = brute.jaccard([text for _, text in rows], width=5, percent=80)
    found = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()
    assert {r.doc_id for r in found} == {rows[top][0] for _, top in expected}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*corpus_pipeline.COLUMNS, "copy"]
    copies = out.groupBy("doc_id").count().collect()
    assert copies and max(r["count"] for r in copies) <= 2


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, name):
    odd = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in ODD], SCHEMA + ", n_chars long")
    stage = dict(corpus_pipeline.STAGES)[name]
    assert set(corpus_pipeline.COLUMNS) <= set(stage(spark, odd, SF).columns)
    assert stage(spark, odd, SF).count() > 0
    assert stage(spark, odd.limit(0), SF).count() == 0


def test_near_duplicates_leaves_one_of_repeated_rows(spark):
    """Rows equal in all, in id and text or in text alone, null ids, wordless texts, other texts."""
    text = " ".join(f"w{i}" for i in range(40))
    near, other = f"{text} more", " ".join(f"v{i}" for i in range(40))
    rows = [
        *[(5, text, "en", "a", 1)] * 3, (5, text, "de", "a", 1), (5, text, None, "de", 1), (5, near, "en", "a", 1),
        (6, text, "en", "a", 1), (None, near, "en", "a", 1), *[(7, other, "en", None, 2)] * 40,
        *[(None, "one two", None, None, None)] * 2, *[(8, " ", "en", "a", 3)] * 2, *[(None, None, "en", "a", 4)] * 2,
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs.repartition(5), SF).collect()
    linked = [tuple(r) for r in found if r.doc_id == 5]
    assert len(linked) == 1 and linked[0] in rows
    rest = sorted(map(repr, (tuple(r) for r in found if r.doc_id != 5)))
    assert rest == sorted(map(repr, [rows[8], rows[48], *rows[50:]]))


def test_near_duplicates_writes_no_texts(spark):
    """What the stage keeps is smaller than the texts, which are neither kept nor sorted."""
    word = spark.range(400).selectExpr("id AS doc_id", "id % 7 AS k").selectExpr(
        "doc_id", "concat_ws(' ', transform(sequence(1, 20), i -> repeat(sha2(concat(doc_id, '-', i), 512), 9))) AS text",
        "'en' AS lang", "'a' AS source", "1L AS n_chars",
    )
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    docs = spark.read.schema(word.schema).parquet(written(word, folder / "texts_near"))
    before = set(folder.glob("revlens-*"))
    assert dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).count() == 400
    kept = [f for d in set(folder.glob("revlens-*")) - before for f in d.glob("*.parquet")]
    texts = [f for f in (folder / "texts_near").glob("*.parquet")]
    assert 4 * sum(f.stat().st_size for f in kept) < sum(f.stat().st_size for f in texts)


def written(df, path):
    df.write.mode("overwrite").parquet(str(path))
    return str(path)
