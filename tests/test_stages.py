"""Tables written by ranges, and runs that go on where the last attempt was lost."""

from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from revlens.operators.memory import Memory
from revlens.operators.providers import Judge, Provider, fixed_judge
from revlens.params import Params
from revlens.plans import batch
from revlens.sources.stages import StageTable

PARAMS = Params(target_languages=("fr",))


def test_ranges_hold_every_row_once(spark, tmp_path):
    rows = [(i * 10_000_000_000 if i % 9 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "seq long, x int").repartition(5)
    table = StageTable(spark, str(tmp_path / "t"))
    assert not table.finished()
    sizes = []

    def made(part):
        sizes.append(part.count())
        return part.withColumn("y", F.col("x") * 2)

    table.write_ranges(df, "seq", 30, made, {"total": F.sum("x"), "none": F.sum(F.lit(None).cast("int"))})
    assert sorted(tuple(r) for r in table.read().select("x", "y").collect()) == [(i, 2 * i) for i in range(200)]
    assert len(sizes) == 7 and table.finished()
    assert {r["counter"]: r["value"] for r in table.counters().collect()} == {
        "rows": 200, "total": sum(range(200)), "none": 0,
    }
    with pytest.raises(ValueError, match="already exists"):
        table.write_ranges(df, "seq", 30, made)


def test_no_rows_and_equal_keys(spark, tmp_path):
    for n, name in ((0, "none"), (50, "equal")):
        table = StageTable(spark, str(tmp_path / name))
        table.write_ranges(spark.range(n).select(F.lit(7).cast("long").alias("seq")), "seq", 10, lambda x: x)
        assert table.finished() and table.read().count() == table.rows() == n


def test_a_lost_range_is_written_again(spark, tmp_path):
    df, tried = spark.range(100).withColumnRenamed("id", "seq"), []

    def made(part):
        tried.append(part.agg(F.min("seq")).first()[0])
        if len(tried) == 3:
            # The piece is written in part, its commit row never.
            part.write.parquet(str(tmp_path / "t" / "pieces" / "2-lost"))
            raise RuntimeError("lost")
        return part

    table = StageTable(spark, str(tmp_path / "t"))
    with pytest.raises(RuntimeError, match="lost"):
        table.write_ranges(df, "seq", 20, made)
    assert not table.finished() and table.read().count() < 100
    other = StageTable(spark, str(tmp_path / "t"))
    other.write_ranges(df, "seq", 77, made)  # the ranges are those settled first
    assert Counter(tried).most_common(1)[0] == (tried[2], 2) and len(tried) == 6
    assert sorted(r[0] for r in other.read().collect()) == list(range(100))


def test_two_writers_of_one_range_count_once(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "seq")
    table = StageTable(spark, str(tmp_path / "t"))
    for _ in range(2):  # as two resumed runs at the same time would
        table._write(0, df, {"n": F.count("*")})
    assert table.read().count() == table.rows() == 10
    assert {r["counter"]: r["value"] for r in table.counters().collect()} == {"rows": 10, "n": 10}


def logged(folder, answer, broken=None):
    """Logs every call in a file; while ``broken`` exists the job fails at that text."""
    folder.mkdir(exist_ok=True)
    where, stop = str(folder), str(broken)

    def make():
        from pathlib import Path
        from uuid import uuid4

        def call(text, *_):
            if Path(stop).exists() and Path(stop).read_text() in text:
                raise SystemExit("executor lost")
            (Path(where) / uuid4().hex).write_text(text)
            return answer(text)

        return call

    return Provider.batch(make, version="v1")


def asked(folder):
    return Counter(p.read_text() for p in Path(folder).iterdir())


def rows(n):
    return [
        {"review_id": f"rev-{i:04}", "product_id": f"prod-{i % 3:03}", "source_language": "es", "title": f"t{i}.", "body": f"b{i}."}
        for i in range(n)
    ]


def run(df, root, folder, broken=None, **more):
    return batch.run_batch(
        df, str(root), "one", PARAMS, logged(folder / "translate", str.upper, broken),
        Judge(logged(folder / "judge", lambda prompt: "4", broken), replies=True),
        logged(folder / "summary", lambda prompt: "short"), range_rows=5, **more,
    )


def test_a_lost_stage_goes_on(spark, make_reviews, tmp_path):
    """Lost in translation, then in judging; no range that was done is paid for again."""
    df, root, broken = make_reviews(*rows(20)), tmp_path / "out", tmp_path / "broken"
    calls = tmp_path / "calls"
    calls.mkdir()
    broken.write_text("t13.")
    with pytest.raises(Exception, match="executor lost|SystemExit|PYTHON"):
        run(df, root, calls, broken)
    before = asked(calls / "translate")
    assert 0 < len(before) < 40 and "t0." in before and "t19." not in before
    done = {t for t in before if int(t[1:-1]) < 8}  # ranges end about at 5, 10 and 15

    broken.write_text("T7.")  # the judge's prompt holds the translation
    with pytest.raises(Exception, match="executor lost|SystemExit|PYTHON"):
        run(df, root, calls, broken, resume=True)
    translated = asked(calls / "translate")
    assert set(translated) == {f"{k}{i}." for k in "tb" for i in range(20)}
    assert all(translated[t] == 1 for t in done) and all(translated[f"t{i}."] == 1 for i in range(15, 20))
    summaries = asked(calls / "summary")

    broken.unlink()
    status = run(df, root, calls, broken, resume=True).collect()
    assert asked(calls / "translate") == translated and asked(calls / "summary") == summaries
    assert {r["stage"]: r["count"] for r in status}["quality"] == 20
    _, pages = batch.served(spark, str(root))
    assert pages.select(F.explode("reviews")).count() == 20
    at = batch.published(spark, str(root))
    counts = {r["counter"]: r["value"] for r in batch.stage_counts(spark, at, PARAMS).collect()}
    assert counts["translations"] == counts["kept"] == counts["translated_reviews"] == 20

    # A published run is not resumed: the same id starts anew.
    assert batch.start(spark, str(root), "one", resume=True).paths != at.paths


def test_a_memory_spares_the_calls_of_a_lost_range(spark, make_reviews, tmp_path):
    df, calls = make_reviews(*rows(20)), tmp_path / "calls"
    calls.mkdir()
    memory = Memory(str(tmp_path / "answers"))
    first = run(df, tmp_path / "a", calls, memory=memory).collect()
    paid = {name: asked(calls / name) for name in ("translate", "judge", "summary")}
    again = run(df, tmp_path / "b", calls, memory=memory).collect()
    assert [(r["stage"], r["count"]) for r in first] == [(r["stage"], r["count"]) for r in again]
    assert {name: asked(calls / name) for name in paid} == paid
    assert paid["translate"].total() == 40


def test_resume_without_a_start_is_a_first_run(spark, make_reviews, tmp_path):
    at = batch.start(spark, str(tmp_path), "new", resume=True)
    assert batch.start(spark, str(tmp_path), "new", resume=True).paths == at.paths
    assert batch.start(spark, str(tmp_path), "new").paths != at.paths
    with pytest.raises(ValueError, match="no run is published"):
        batch.published(spark, str(tmp_path))
