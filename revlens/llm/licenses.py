"""License scans by template-markup matching.

A template is license wording with two kinds of marked regions: ``[[ … ]]`` may be left
out, ``{{a..b}}`` stands for a to b words of any kind. Each template is compiled once
into an automaton over words; a text carries the license if some stretch of its words
takes the automaton from start to end, so its mandatory wording matches exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from revlens.llm.text import alnum_words

# Base phrases with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices and references as their licenses word them, without punctuation, with
# markup for titles, copyright lines, holders, list bullets and what else may vary.
_BSD_START = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met [[{{1..1}}]] redistributions of source code must "
    "retain the above copyright notice this list of conditions and the following disclaimer "
    "[[{{1..1}}]] redistributions in binary form must reproduce the above copyright notice this list "
    "of conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution"
)
_GNU_START = (
    "free software [[{{1..1}}]] you can redistribute it and or modify it under the terms of the gnu"
)
TEMPLATES = (
    ("mit", "spdx license identifier mit"),
    ("mit", "[[this {{1..4}} is]] released under the [[terms of the]] mit license"),
    ("mit", "licensed under the [[terms of the]] mit license"),
    (
        "mit",
        "[[mit license]] [[copyright {{1..12}}]] permission is hereby granted free of charge to any "
        "person obtaining a copy of this {{1..8}} to deal in the {{1..4}} without restriction "
        "including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the {{1..4}} and to permit persons to whom the {{1..4}} is "
        "furnished to do so subject to the following conditions",
    ),
    (
        "mit",
        "provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement in no "
        "event shall the {{1..8}} or copyright holders be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software",
    ),
    ("apache-2", "spdx license identifier apache 2 0"),
    ("apache-2", "[[this {{1..4}} is]] licensed under the apache license version 2 [[0]]"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license [[you may obtain a copy "
        "of the license at {{1..12}}]]",
    ),
    (
        "apache-2",
        "unless required by applicable law or agreed to in writing software distributed under the "
        "license is distributed on an as is basis without warranties or conditions of any kind either "
        "express or implied [[see the license for the specific language governing permissions and "
        "limitations under the license]]",
    ),
    ("bsd", "[[bsd {{1..1}} clause license]] [[copyright {{1..12}}]] redistribution and use in source and "
            "binary forms with or without modification are permitted provided that the following "
            "conditions are met"),
    ("bsd-2-clause", "spdx license identifier bsd 2 clause"),
    ("bsd-2-clause", _BSD_START + " this software is provided by {{1..12}} as is and any express or implied "
                     "warranties"),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause"),
    ("bsd-3-clause", _BSD_START + " [[{{1..1}}]] neither the name of {{1..12}} nor the names of [[its]] "
                     "[[the]] contributors may be used to endorse or promote products derived from this "
                     "software without specific prior written permission"),
    ("isc", "spdx license identifier isc"),
    (
        "isc",
        "[[isc license]] [[copyright {{1..12}}]] permission to use copy modify and [[or]] distribute this "
        "software for any purpose with or without fee is hereby granted [[provided that the above "
        "copyright notice and this permission notice appear in all copies]]",
    ),
    ("gpl", "spdx license identifier gpl {{2..4}}"),
    (
        "gpl",
        "[[this {{1..4}} is]] licensed under the gnu general public license [[as published by "
        "the free software foundation]] [[version {{1..2}}]]",
    ),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", _GNU_START + " general public license as published by the free software foundation"),
    ("gpl", "gnu general public license version {{1..2}} {{2..3}}"),
    ("lgpl", "spdx license identifier lgpl {{2..4}}"),
    ("lgpl", "gnu lesser general public license version {{1..2}} {{2..3}}"),
    ("lgpl", "licensed under the gnu lesser general public license [[version {{1..2}}]]"),
    ("lgpl", "licensed under the gnu library general public license [[version {{1..2}}]]"),
    (
        "lgpl",
        "under the terms of the gnu lesser general public license as published by the free software "
        "foundation",
    ),
    ("agpl", "spdx license identifier agpl {{2..4}}"),
    ("agpl", "licensed under the gnu affero general public license [[version {{1..2}}]]"),
    (
        "agpl",
        "under the terms of the gnu affero general public license as published by the free software "
        "foundation",
    ),
    ("agpl", "gnu affero general public license version {{1..2}} {{2..3}}"),
    ("mpl-2", "spdx license identifier mpl 2 0"),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 [[if a copy "
        "of the mpl was not distributed with this file you can obtain one at {{1..8}}]]",
    ),
    ("epl-2", "spdx license identifier epl 2 0"),
    (
        "epl-2",
        "accompanying materials are made available under the terms of the eclipse public license [[v]] "
        "[[version]] 2 0",
    ),
    ("boost", "spdx license identifier bsl 1 0"),
    ("boost", "distributed under the boost software license version 1 0 [[see {{1..12}}]]"),
    (
        "boost",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of "
        "the software and accompanying documentation covered by this license",
    ),
    ("unlicense", "spdx license identifier unlicense"),
    (
        "unlicense",
        "free and unencumbered software released into the public domain anyone is free to copy modify "
        "publish use compile sell or distribute this software either in source code form or as a "
        "compiled binary for any purpose commercial or non commercial and by any means",
    ),
    ("zlib", "spdx license identifier zlib"),
    (
        "zlib",
        "[[zlib license]] [[copyright {{1..12}}]] provided as is without any express or implied warranty in "
        "no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely subject to the following restrictions",
    ),
    ("wtfpl", "spdx license identifier wtfpl"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("cc0", "spdx license identifier cc0 1 0"),
    ("cc0", "waived all copyright and related or neighboring rights to {{1..8}}"),
    ("cc-by-nc", "[[this {{1..4}} is]] licensed under [[a]] cc by nc [[sa]] [[nd]] [[{{1..2}}]]"),
    (
        "cc-by-nc",
        "licensed under [[a]] [[the]] creative commons attribution non commercial [[share alike]] "
        "[[no derivatives]] [[{{1..2}}]] [[international]] license",
    ),
    (
        "cc-by-nc",
        "licensed under [[a]] [[the]] creative commons attribution noncommercial [[sharealike]] "
        "[[noderivatives]] [[{{1..2}}]] [[international]] license",
    ),
    (
        "cc-by-sa",
        "licensed under [[a]] [[the]] creative commons attribution share alike [[{{1..2}}]] "
        "[[international]] license",
    ),
    (
        "cc-by-sa",
        "licensed under [[a]] [[the]] creative commons attribution sharealike [[{{1..2}}]] "
        "[[international]] license",
    ),
    (
        "cc-by",
        "licensed under [[a]] [[the]] creative commons attribution [[{{1..2}}]] [[international]] license",
    ),
)


@dataclass
class Automaton:
    """States 0 … n; ``words`` and ``any`` consume a word, ``skips`` consume none.

    ``done[s]`` counts the mandatory words passed when state ``s`` is reached.
    """

    label: str
    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    any: list[int | None] = field(default_factory=lambda: [None])
    skips: list[list[int]] = field(default_factory=lambda: [[]])
    done: list[int] = field(default_factory=lambda: [0])

    def _state(self, mandatory: int) -> int:
        self.words.append({})
        self.any.append(None)
        self.skips.append([])
        self.done.append(mandatory)
        return len(self.done) - 1

    def reach(self, states: Iterable[int]) -> set[int]:
        """The states and all that lie behind skips."""
        found, todo = set(), list(states)
        while todo:
            state = todo.pop()
            if state not in found:
                found.add(state)
                todo.extend(self.skips[state])
        return found

    @property
    def end(self) -> int:
        return len(self.done) - 1

    def first_words(self) -> set[bytes]:
        return {w for s in self.reach([0]) for w in self.words[s]}

    def run(self, words: list[bytes], at: int) -> float:
        """1 if the automaton ends on words from ``at`` on, else the share of its mandatory
        words that were matched before it stopped."""
        states, best = self.reach([0]), 0
        for i in range(at, len(words)):
            following = set()
            for s in states:
                step = self.words[s].get(words[i])
                if step is not None:
                    following.add(step)
                if self.any[s] is not None:
                    following.add(self.any[s])
            if not following:
                break
            states = self.reach(following)
            best = max(best, max(self.done[s] for s in states))
            if self.end in states:
                return 1.0
        return best / (self.done[self.end] + 1)


def compile_template(label: str, markup: str) -> Automaton:
    """An automaton that starts at a mandatory or optional word, never at a free region."""
    made = Automaton(label)
    last, mandatory, opened = 0, 0, []
    for part in re.findall(r"\[\[|\]\]|\{\{\d+\.\.\d+\}\}|[^\s\[\]{}]+", markup):
        if part == "[[":
            opened.append(last)
        elif part == "]]":
            before, after = opened.pop(), made._state(mandatory)
            made.skips[last].append(after)
            made.skips[before].append(after)
            last = after
        elif part.startswith("{{"):
            least, most = map(int, part[2:-2].split(".."))
            after_least = []
            for n in range(most):
                if n >= least:
                    after_least.append(last)
                new = made._state(mandatory)
                made.any[last] = new
                last = new
            for state in after_least:
                made.skips[state].append(last)
        else:
            mandatory += not opened
            new = made._state(mandatory)
            made.words[last][part.encode()] = new
            last = new
    return made


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where the phrase's words stand one after the other, overlaps included."""
    found, at = [], -1
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at : at + len(phrase)] == phrase:
                found.append(at)
    except ValueError:
        return found


class Scanner:
    def __init__(self, templates, phrases):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        # The rarest word decides whether a phrase is looked for at all.
        self.rare = [max(p, key=len) for p, _ in self.phrases]
        self.starts: dict[bytes, list[Automaton]] = {}
        for label, markup in templates:
            automaton = compile_template(label, markup)
            for word in automaton.first_words():
                self.starts.setdefault(word, []).append(automaton)

    def __call__(self, text: str | None) -> tuple:
        words = alnum_words(text)
        present = set(words)
        base = [
            (at, label)
            for (phrase, label), rare in zip(self.phrases, self.rare)
            if rare in present
            for at in _places(words, phrase)
        ]
        labels, score = {label for _, label in base}, 0.9 if base else 0.0
        for word in self.starts.keys() & present:
            for at in _places(words, [word]):
                for automaton in self.starts[word]:
                    share = automaton.run(words, at)
                    score = max(score, share if share == 1.0 else 0.85 * share)
                    if share == 1.0:
                        labels.add(automaton.label)
        starts = [at for at, _ in base]
        return (
            len(words),
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            sorted({label for _, label in base}),
            sorted(labels),
            score,
        )


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: dict[str, str] = BASE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Labels of every text, one row per input row, in one pass without a shuffle.

    Columns: the id, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start, null without one), ``base_labels``
    and ``labels`` (sorted arrays, the second with the templates' labels as well) and
    ``score``: 1 for an accepted template, 0.9 for a base phrase alone, else in
    proportion to the best partial match. A null or empty text has no words, no labels
    and score 0. Other columns are left out.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = (
        "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
        "labels array<string>, score double"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    @F.pandas_udf(schema)
    def found(texts: pd.Series) -> pd.DataFrame:
        scanner = Scanner(templates, phrases)
        frame = pd.DataFrame([scanner(t) for t in texts], columns=names)
        return frame.astype({"first_word": "Int64", "last_word": "Int64"})

    return rows.select("_id", found("_text").alias("_found")).select(
        F.col("_id").alias(id_col), "_found.*"
    )
