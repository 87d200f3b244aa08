"""Answers kept between runs: what is asked again, and what never is."""

import threading
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pytest

from revlens.operators import quality, summarize, translate
from revlens.operators.memory import Memory, answer_once
from revlens.operators.providers import Judge, Provider
from revlens.params import Params

PARAMS = Params(target_languages=("fr",), engine="test")


def logged(folder, answer=str.upper, version="v1"):
    """A provider that logs every call in a file of its own."""
    folder.mkdir(exist_ok=True)
    where = str(folder)

    def make():
        from pathlib import Path
        from uuid import uuid4

        def call(text, *rest):
            (Path(where) / uuid4().hex).write_text(str(text))
            if "bad" in text:
                raise ConnectionError(text)
            return answer(text)

        return call

    return Provider.batch(make, version=version)


def asked(folder):
    """The calls since the last look."""
    files = list(Path(folder).iterdir())
    found = Counter(p.read_text() for p in files)
    for p in files:
        p.rename(p.parent.parent / f"seen-{p.name}")
    return found


def rows(*texts):
    return [{"source_language": "es", "title": t, "body": b} for t, b in texts]


def flat(df):
    return sorted((r["seq"], {k: (v["title"], v["body"]) for k, v in r["translations"].items()}) for r in df.collect())


def test_a_second_run_asks_only_for_what_is_new(make_reviews, tmp_path):
    memory, log = Memory(str(tmp_path / "ledger")), tmp_path / "log"
    first = make_reviews(*rows(("uno", "same"), ("dos", "same"), ("bad", "tres")), {"source_language": "en"})
    plain = flat(translate.translate(first, PARAMS, logged(log)))
    asked(log)
    made = translate.translate(first, PARAMS, logged(log), memory=memory)
    assert flat(made) == plain and flat(made) == plain
    assert asked(log) == {"uno": 1, "dos": 1, "same": 1, "bad": 1, "tres": 1}

    # Again: only the call that failed. A changed text: exactly one more.
    assert flat(translate.translate(first, PARAMS, logged(log), memory=memory)) == plain
    assert asked(log) == {"bad": 1}
    changed = make_reviews(*rows(("uno", "same"), ("dos!", "same")))
    assert flat(translate.translate(changed, PARAMS, logged(log), memory=memory)) == [
        (0, {"fr": ("UNO", "SAME")}), (1, {"fr": ("DOS!", "SAME")}),
    ]
    assert asked(log) == {"dos!": 1}


def test_another_version_or_target_is_another_call(make_reviews, tmp_path):
    memory, log = Memory(str(tmp_path / "ledger")), tmp_path / "log"
    df = make_reviews(*rows(("uno", "dos")))
    translate.translate(df, PARAMS, logged(log), memory=memory).collect()
    asked(log)
    made = translate.translate(df, PARAMS, logged(log, str.title, "v2"), memory=memory)
    assert flat(made) == [(0, {"fr": ("Uno", "Dos")})] and asked(log) == {"uno": 1, "dos": 1}
    two = replace(PARAMS, target_languages=("fr", "de"))
    translate.translate(df, two, logged(log), memory=memory).collect()
    assert asked(log) == {"uno": 1, "dos": 1}
    with pytest.raises(ValueError, match="version"):
        translate.translate(df, PARAMS, logged(log, version=None), memory=memory)


def test_two_runs_at_once(spark, tmp_path):
    """Both add what they asked for; readers see one answer per call and no file is lost."""
    memory, log = Memory(str(tmp_path / "ledger")), tmp_path / "log"
    frames = [
        spark.createDataFrame([(f"t{i}",) for i in range(start, start + 30)], "text string") for start in (0, 20)
    ]
    results, errors = [None, None], []

    def run(k):
        try:
            results[k] = answer_once(frames[k], logged(log, version="v"), ["text"], "string", memory).collect()
        except Exception as failure:
            errors.append(failure)

    threads = [threading.Thread(target=run, args=(k,)) for k in (0, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    for k, start in enumerate((0, 20)):
        assert {r["text"]: r["value"] for r in results[k]} == {f"t{i}": f"T{i}" for i in range(start, start + 30)}
    known = memory.known(spark, "v").collect()
    assert sorted(r["text"] for r in known) == sorted(f"T{i}" for i in range(50))
    asked(log)
    again = answer_once(frames[0].union(frames[1]), logged(log, version="v"), ["text"], "string", memory)
    assert again.where("remembered").count() == 50 and not asked(log)


def test_scores_and_summaries_are_kept_too(make_reviews, tmp_path):
    memory, log = Memory(str(tmp_path / "ledger")), tmp_path / "log"
    df = make_reviews(*rows(("uno", "dos"), ("uno", "dos"), ("tres", "x")))
    translated = translate.translate(df, PARAMS, logged(log), memory=memory).cache()
    translated.count(), asked(log)
    judge = Judge(logged(log, lambda prompt: 4.0, "judge"))
    plain = sorted(map(str, quality.score_translations(translated, PARAMS, judge).collect()))
    asked(log)
    for expected in (2, 0):
        scored = quality.score_translations(translated, PARAMS, judge, memory)
        assert sorted(map(str, scored.select(*[c for c in df.columns], "translations", "quality").collect())) == sorted(
            map(str, quality.score_translations(translated, PARAMS, judge).select(*df.columns, "translations", "quality").collect())
        )
        assert asked(log).total() - 3 == expected  # three by the judge without a memory
    assert len(plain) == 3

    summarizer = logged(log, lambda prompt: f"{len(prompt)}", "summary")
    small = replace(PARAMS, prompt_reviews=2)
    expected = summarize.summarize_tree(df, small, summarizer).collect()
    asked(log)
    for calls in (3, 0):  # two parts, and their summaries
        assert summarize.summarize_tree(df, small, summarizer, memory).collect() == expected
        assert asked(log).total() == calls
    assert summarize.summarize(df, PARAMS, summarizer, memory).collect() == summarize.summarize(df, PARAMS, summarizer).collect()
