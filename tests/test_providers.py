"""Retries, deadlines and calls in flight, and answers in the order of their rows."""

import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from revlens.operators.providers import Calls, Provider, call_each


def texts(spark, rows, parts):
    df = spark.createDataFrame(list(enumerate(rows)), "seq long, texts array<string>")
    return df.repartition(parts)


def called(df, provider, together=1):
    calls = F.transform("texts", lambda t: F.struct(t.alias("text")))
    done = call_each(df, provider, calls, ["text"], "out", "string", together)
    return {r["seq"]: [tuple(o) for o in r["out"] or []] for r in done.collect()}


def logged(folder, failures=2, pause=0.0, error=ConnectionError):
    """A provider that logs the span of every attempt and fails before it answers."""

    def make():
        from time import sleep, time
        from uuid import uuid4

        tried = {}

        def call(text):
            tried[text] = tried.get(text, 0) + 1
            began = time()
            sleep(pause)
            (Path(folder) / f"{text}~{began}~{time()}~{uuid4().hex}").touch()
            if text.startswith("never") or tried[text] <= failures:
                raise error(text)
            return text.upper()

        return call

    return make


def attempts(folder):
    return Counter(p.name.split("~")[0] for p in Path(folder).iterdir())


def most_at_once(folder):
    spans = [tuple(map(float, p.name.split("~")[1:3])) for p in Path(folder).iterdir()]
    return max(sum(a <= at < b for a, b in spans) for at, _ in spans)


@pytest.mark.parametrize("in_flight", [1, 5])
def test_attempts_and_order(spark, tmp_path, in_flight):
    rows = [[f"a{i}", f"b{i}"] for i in range(20)] + [["never1"], [], None]
    policy = Calls(attempts=3, wait=0.0, in_flight=in_flight)
    found = called(texts(spark, rows, 3), Provider.batch(logged(str(tmp_path)), policy))
    assert found == {
        i: [(t.upper(), None) if t[0] != "n" else (None, "ConnectionError") for t in row or []]
        for i, row in enumerate(rows)
    }
    assert attempts(tmp_path) == {t: 3 for row in rows for t in row or []}


def test_too_few_attempts(spark, tmp_path):
    policy = Calls(attempts=2, wait=0.0)
    found = called(texts(spark, [["x"]], 1), Provider.batch(logged(str(tmp_path)), policy))
    assert found == {0: [(None, "ConnectionError")]} and attempts(tmp_path) == {"x": 2}


def test_errors_that_are_not_tried_again(spark, tmp_path):
    policy = Calls(attempts=5, wait=0.0, retry_on=(TimeoutError,))
    found = called(texts(spark, [["x"]], 1), Provider.batch(logged(str(tmp_path)), policy))
    assert found == {0: [(None, "ConnectionError")]} and attempts(tmp_path) == {"x": 1}


@pytest.mark.parametrize("in_flight", [1, 4])
def test_calls_in_flight(spark, tmp_path, in_flight):
    """One task has no more than its share at once, and does use it."""
    rows = [[f"t{i}"] for i in range(16)]
    policy = Calls(in_flight=in_flight, tasks=1)
    provider = Provider.batch(logged(str(tmp_path), failures=0, pause=0.1), policy)
    assert called(texts(spark, rows, 4), provider) == {i: [(f"T{i}", None)] for i in range(16)}
    assert most_at_once(tmp_path) == in_flight


def test_calls_that_belong_together_follow_each_other(spark, tmp_path):
    rows = [["never0", "b0"], ["a1", "b1", "never1", "d1"]]
    policy = Calls(attempts=2, wait=0.0, in_flight=4)
    provider = Provider.batch(logged(str(tmp_path), failures=0), policy)
    assert called(texts(spark, rows, 1), provider, together=2) == {
        0: [(None, "ConnectionError"), (None, "NotAsked")],
        1: [("A1", None), ("B1", None), (None, "ConnectionError"), (None, "NotAsked")],
    }
    assert attempts(tmp_path) == {"never0": 2, "a1": 1, "b1": 1, "never1": 2}


def test_waits_grow_until_the_deadline(monkeypatch):
    waits, now = [], [0.0]
    monkeypatch.setattr(time, "monotonic", lambda: now[0])
    monkeypatch.setattr(time, "sleep", lambda s: (waits.append(s), now.__setitem__(0, now[0] + s)))

    def fail():
        raise ConnectionError

    assert Calls(attempts=4).again(fail, ()) == (None, "ConnectionError")
    assert waits == [2.0, 4.0, 8.0]
    waits.clear()
    assert Calls(attempts=9, wait=1.0, deadline=10.0).again(fail, ()) == (None, "ConnectionError")
    assert waits == [1.0, 2.0, 4.0]  # the next attempt would begin after 15 seconds


def test_a_client_that_can_not_be_made_fails_the_job(spark):
    def make():
        raise RuntimeError("no client")

    with pytest.raises(Exception, match="no client"):
        called(texts(spark, [["x"]], 1), Provider.batch(make, Calls(in_flight=3)))


@pytest.mark.parametrize(
    "wrong", [{"attempts": 0}, {"in_flight": 0}, {"tasks": 0}, {"wait": -1}, {"backoff": 0.5}, {"deadline": -1}]
)
def test_unusable_settings(wrong):
    with pytest.raises(ValueError):
        Calls(**wrong)


def test_a_batch_of_long_answers_is_not_held_at_once(spark):
    """2,000 answers of 20 KB in one batch; what Python holds of them stays far below 40 MB."""

    def make():
        import tracemalloc

        tracemalloc.start()
        return lambda text: f"{tracemalloc.get_traced_memory()[0]:012d}".ljust(20_000, ".")

    calls = F.array(F.struct(F.col("id").cast("string").alias("text")))
    df = spark.range(0, 2_000, 1, 1)
    held = call_each(df, Provider.batch(make), calls, ["text"], "_r", "string").select(
        F.max(F.get("_r", F.lit(0))["value"].substr(1, 12).cast("long")), F.count("*")
    )
    most, rows = held.first()
    assert rows == 2_000 and most < 10_000_000
