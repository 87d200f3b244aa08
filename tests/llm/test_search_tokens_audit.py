"""Ranked search, byte pairs and the filter audit beside brute force."""

import base64
import math
import random
from collections import Counter
from itertools import permutations
from pathlib import Path

import brute
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from odd_rows import ODD

from revlens.llm import byte_pairs, filter_audit, queries, ranking

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


# Ranked search.


def brute_search(docs, items, most=10):
    """(item, rank, doc, score) from the definition, every document scored in full."""
    counts = [(i, Counter(brute.lowered(t, brute.ALNUM))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(brute.lowered(t, brute.ALNUM))
    rows = []
    for item, terms in wanted.items():
        scores = []
        for i, c in counts:
            n = sum(c.values())
            score = 0
            for t in terms & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        scores.sort(key=lambda x: x[:3])
        rows += [(item, at, x[3], -x[0]) for at, x in enumerate(scores[:most], 1)]
    return rows


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@needs_data
def test_op11(spark):
    docs, items = (
        duckdb.sql(f"SELECT {c}, text FROM '{SF}/{t}.parquet'").fetchall()
        for t, c in (("documents", "doc_id"), ("benchmark", "item_id"))
    )
    assert found(queries.REGISTERED["op11_ranked_search"](spark, SF)) == sorted(brute_search(docs, items), key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_search_odd(spark, odd, none, block_bytes):
    items = [
        (1, "word3 word7 word59 one"), (2, "ONE two"), (2, "three"), (3, None), (4, " ,;"), (None, "mail start"),
        (5, "nowhere at all x9"), (6, "x" * 200_000), (7, " ".join(f"word{i % 60}" for i in range(500)) + " password one"),
        (1, "word3 word7 word59 one"),
    ]
    table = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, rank int, block string")
    expected = brute_search([r[:2] for r in ODD], items)
    got = ranking.search(odd, table, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == sorted(expected, key=str)
    assert ranking.search(none, table).count() == ranking.search(odd, table.limit(0)).count() == 0


def test_many_equal_scores(spark):
    """One text a thousand times: the smallest ids stay, in any partitioning."""
    docs = [(i, "alpha beta gamma") for i in range(1000, 0, -1)] + [(5000 + i, f"alpha other{i}") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    items = [(0, "beta"), (1, "other7 alpha"), (2, "alpha gamma beta")]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert found(ranking.search(df, table)) == sorted(brute_search(docs, items), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_shards_agree_with_full_scores(monkeypatch, seed):
    """Random postings, many ties, read in shards of several sizes."""
    rng = random.Random(seed)
    n_docs, n_terms = 300, 25
    docs = [(rng.randrange(1, 60), {t: rng.randrange(1, 4) for t in range(n_terms) if rng.random() < 0.3}) for _ in range(n_docs)]
    weights = np.array([rng.choice([0, 1, 300, 300, 9000]) for _ in range(n_terms)], np.int64)
    items = [np.array(sorted(rng.sample(range(n_terms), k)), np.int64) for k in (0, 1, 3, 12, 25)]
    corpus = ranking.Corpus(n_docs, sum(n for n, _ in docs))

    def score(item, n, tfs):
        length = 10 + 90 * n * corpus.n_docs // corpus.n_terms
        return sum(int(weights[t]) * (10**9 * tfs[t] // (1000 * tfs[t] + 8 * length)) for t in item.tolist() if t in tfs)

    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(n_docs), pa.int64()),
            pa.array([n for n, _ in docs], pa.int64()),
            pa.array([list(tfs) for _, tfs in docs], pa.list_(pa.int64())),
            pa.array([list(tfs.values()) for _, tfs in docs], pa.list_(pa.int64())),
        ],
        names=["id", "n", "terms", "tfs"],
    )
    for rows in (1 << 15, 64, 7):
        monkeypatch.setattr(ranking, "SHARD_ROWS", rows)
        monkeypatch.setattr(ranking, "_SLICE", min(rows, 256))
        (result,) = ranking._best([batch], items, weights, corpus, 10)
        got = {}
        for item, i, s in zip(*(c.to_pylist() for c in result.columns)):
            got.setdefault(item, []).append((-s, i))
        for at, item in enumerate(items):
            full = sorted((-s, i) for i, (n, tfs) in enumerate(docs) if (s := score(item, n, tfs)) > 0)
            assert sorted(got.get(at, [])) == full[:10]


def test_low_impacts_are_left_unread():
    """Reading stops where nothing below can reach the best: pruning, not only sorting."""
    n = 2000
    rare = list(range(20))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(range(n), pa.int64()),
            pa.array([5] * n, pa.int64()),
            pa.array([[0, 1] if i in rare else [1] for i in range(n)], pa.list_(pa.int64())),
            pa.array([[3, 1 + i % 3] if i in rare else [1 + i % 50] for i in range(n)], pa.list_(pa.int64())),
        ],
        names=["id", "n", "terms", "tfs"],
    )
    weights = np.array([9000, 40], np.int64)
    shard = ranking.Shard([batch], 2, ranking.Corpus(n, 5 * n))
    whole = shard.best(np.array([0, 1]), weights, 10, 1)
    limited = shard.best(np.array([0, 1]), weights, 10, int(whole[1][-1]))
    assert [x.tolist() for x in whole] == [x.tolist() for x in limited]
    none = shard.best(np.array([1]), weights, 10, 10**12)
    assert len(none[0]) == 0


# Byte pairs.


@pytest.fixture(scope="module")
def rank_file():
    return Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()


@pytest.fixture(scope="module")
def vocabulary(rank_file):
    return byte_pairs.Vocabulary(rank_file, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(rank_file):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def codec(spark):
    return byte_pairs.Codec(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@needs_data
def test_op12(spark, library):
    got = {r.doc_id: r for r in queries.REGISTERED["op12_byte_pairs"](spark, SF).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        r = got[i]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(text or "")


def test_byte_pairs_odd(spark, odd, none, library):
    tokens = byte_pairs.encoded(odd, codec(spark), carried=("size", "lang"))
    rows = byte_pairs.decoded(tokens, codec(spark)).collect()
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded), r.size) for r in rows) == sorted(
        (str(i), library.encode_ordinary(t or ""), (t or "").encode(), 1) for i, t, *_ in ODD
    )
    both = byte_pairs.encoded(odd, codec(spark), decoded=True)
    assert sorted(map(str, both.collect())) == sorted(map(str, byte_pairs.decoded(byte_pairs.encoded(odd, codec(spark)), codec(spark)).collect()))
    assert byte_pairs.encoded(none, codec(spark)).count() == 0


def test_splits_and_merges_of_every_character(vocabulary, library):
    for low in range(0, 0x110000, 97):  # a step that meets every block of characters
        if not 0xD800 <= low < 0xE000:
            c = chr(low)
            text = f"a{c}b {c}1{c}{c} {c}! {c} \n{c}"
            assert vocabulary.encode(text).tolist() == library.encode_ordinary(text), hex(low)


@pytest.mark.parametrize("seed", range(5))
def test_random_texts(vocabulary, library, seed):
    rng = random.Random(seed)
    kinds = ["ab", "aA ", "éè\n  ", "x", "\U0001f600中文", "́   1²Ⅷ", "'s'll", "=-_#"]
    for _ in range(200):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([1, 5, 40, 700])))
        ids = vocabulary.encode(text)
        assert ids.tolist() == library.encode_ordinary(text) and vocabulary.decode(ids) == text.encode()


def test_very_long_pre_tokens(vocabulary, library):
    """Time in proportion to the length; a merge that starts at the left wins."""
    for text in ("x" * 300_000, "ab" * 100_000, "aab" * 50_000, "=" * 100_001):
        ids = vocabulary.encode(text)
        assert vocabulary.decode(ids) == text.encode()
        assert vocabulary.encode(text[:20_000]).tolist() == library.encode_ordinary(text[:20_000])


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_pairs_of_a_small_vocabulary(seed):
    """Every two-letter piece merges in some rank: stale entries and equal ranks abound."""
    rng = random.Random(seed)
    pieces = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(2, 6))) for _ in range(25)})
    rng.shuffle(pieces)
    ranks = {bytes([b]): b for b in range(256)} | {p.encode(): 256 + i for i, p in enumerate(pieces)}
    lines = b"\n".join(base64.b64encode(p) + b" %d" % r for p, r in ranks.items())
    own = byte_pairs.Vocabulary(lines, r"[ab]+")
    for _ in range(300):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 40)))
        assert own.merge(text.encode()) == plain_merge(text.encode(), ranks)


def plain_merge(said, ranks):
    """The lowest rank of all neighbours, the leftmost of equals, again and again."""
    if said in ranks:
        return [ranks[said]]
    parts = [said[i : i + 1] for i in range(len(said))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_pre_tokens_in_use_are_not_merged_again(rank_file, library, monkeypatch):
    """A full memory keeps what is asked for again; long pre-tokens are not remembered."""
    monkeypatch.setattr(byte_pairs, "_REMEMBERED", 8)
    merged, merge = [], byte_pairs.Vocabulary.merge
    monkeypatch.setattr(byte_pairs.Vocabulary, "merge", lambda v, said: merged.append(said) or merge(v, said))
    own = byte_pairs.Vocabulary(rank_file, public_tokenizers.PATTERN)
    for i in range(40):
        text = f" oftenagain {'y' * 40}{chr(0x4E00 + i)} {'b' * (i % 20)}z oftenagain"
        assert own.encode(text).tolist() == library.encode_ordinary(text)
    assert merged.count(b" oftenagain") == 1
    assert len(own._known) <= 8 and len(own._older) <= 8
    assert own.encode("").tolist() == []


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="255 of the 256"):
        byte_pairs.Vocabulary(base64.b64encode(b"a") + b" 0", ".")


# Filter audit.


def brute_audit(rows, labels):
    """Every order run over every row."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    judged = []
    for i, text, lang in rows:
        text = text or ""
        words = brute.SPACED.findall(text.encode())
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": text in least and (i is None or i > least[text]),
        }
        judged.append((lang or "", {f for f, bad in fails.items() if bad}, i is not None and i in good, i is not None and i in toxic))
    out, shapley = {}, Counter()
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in j[1] for j in own) - len(gone), sum(j[1] == {f} for j in own),
                    sum(j[2] for j in gone), sum(j[3] for j in gone),
                )
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(df):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


@needs_data
def test_op13(spark):
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SF}/labels.parquet'").fetchall()
    assert audited(queries.REGISTERED["op13_filter_audit"](spark, SF)) == brute_audit(rows, labels)


def test_audit_odd(odd, none, labels):
    failed = filter_audit.failures(odd, carried=("lang",))
    got = audited(filter_audit.audit(filter_audit.marked(failed, labels), "lang"))
    expected = brute_audit([r[:3] for r in ODD], [tuple(r) for r in labels.collect()])
    assert got == expected and len(got) == 600 * len({r[2] or "" for r in ODD})
    empty = filter_audit.marked(filter_audit.failures(none, carried=("lang",)), labels)
    assert filter_audit.audit(empty, "lang").count() == 0


def test_paths_of_the_lattice():
    for n in (1, 3, 5):
        edges = filter_audit.lattice(n)
        assert len(edges) == n * 2 ** (n - 1)
        for f in range(n):  # every order applies every filter once
            assert sum(orders for _, g, orders in edges if g == f) == math.factorial(n)
        taken = Counter()
        for order in permutations(range(n)):
            state = 0
            for f in order:
                taken[state, f] += 1
                state |= 1 << f
        assert {(s, f): orders for s, f, orders in edges} == taken
