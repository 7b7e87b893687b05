"""Periodic runs against a plain search of every period; the grammar derives its documents."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mlframe.llm import periodic_runs as pr
from mlframe.llm.queries import op13_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs) -> str:
    drop = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


stretch = st.builds(lambda unit, n: (unit * (n // max(len(unit), 1) + 1))[:n] if unit else [], st.lists(st.integers(0, 3), max_size=12), st.integers(0, 90))
document = st.builds(lambda parts, copies: [w for p in parts for w in p] * copies, st.lists(stretch, max_size=4), st.sampled_from([1, 1, 2, 3, 4]))


def numbered(docs):
    ids = np.array([w + 10 * d for d, own in enumerate(docs) for w in own], np.int64)
    return ids, np.array([d for d, own in enumerate(docs) for _ in own], np.int64)


@settings(max_examples=400, deadline=None)
@given(st.lists(document, min_size=1, max_size=4))
def test_runs_equal_brute_force(docs):
    found = pr.find_runs(*numbered(docs))
    first = np.cumsum([0, *map(len, docs)])
    assert [(a, e - a, q) for a, e, q in found.tolist()] == [(a + first[d], n, q) for d, own in enumerate(docs) for a, n, q in brute(own)]


@settings(max_examples=100, deadline=None)
@given(st.lists(document, min_size=1, max_size=4))
def test_rules_occur_where_they_say(docs):
    ids, doc = numbered(docs)
    grammar = pr.Grammar(ids, doc, 2)
    before = np.cumsum(grammar.counts) - grammar.counts
    assert grammar.counts.sum() == len(grammar.places)
    for (at, left, size), a, n in zip(grammar.rules.tolist(), before, grammar.counts):
        assert 0 < left < size
        for place in grammar.places[a:a + n]:
            assert (ids[place:place + size] == ids[at:at + size]).all() and len(set(doc[place:place + size])) == 1
    # in what is left no pair repeats, overlapping ones aside
    edges = [*grammar.joints.tolist()]
    starts = sorted({*edges, *np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])).tolist()}) if len(ids) else []
    symbols = [tuple(ids[a:b].tolist()) for a, b in zip(starts, [*starts[1:], len(ids)])]
    owner = [int(doc[a]) for a in starts]
    seen = {}
    for i, (x, y) in enumerate(zip(symbols, symbols[1:])):
        if owner[i] == owner[i + 1]:
            j = seen.setdefault((x, y), i)
            assert i - j <= 1


def test_fewer_boundaries_where_text_repeats():
    ids = np.tile(np.arange(50), 2000)
    grammar = pr.Grammar(ids, np.zeros(len(ids), np.int64), 24)
    assert len(grammar.rules) + len(grammar.joints) < 60
    assert pr.find_runs(ids, np.zeros(len(ids), np.int64)).tolist() == [[0, 100_000, 50]]


def test_equal_hashes_of_unequal_words(monkeypatch):
    docs = [[0, 1, 2] * 20 + [3, 3, 1] + [2, 0] * 14, [1, 1, 1, 0] * 9]
    monkeypatch.setattr(pr._Extender, "equal", lambda self, a, b, n: np.ones(len(a), bool))
    found = pr.find_runs(*numbered(docs))
    assert [(a, e - a, q) for a, e, q in found.tolist()] == brute(docs[0]) + [(a + len(docs[0]), n, q) for a, n, q in brute(docs[1])]


def test_word_ids_tell_words_apart(monkeypatch):
    monkeypatch.setattr(pr, "xxh64", lambda buf, start, length, seed: np.zeros(len(start), np.uint64))
    buf = np.frombuffer(b"ab cd ab ab c ", np.uint8)
    start, end = np.array([0, 3, 6, 9, 12]), np.array([2, 5, 8, 11, 13])
    ids = pr._word_ids(buf, start, end, np.array([0, 0, 0, 1, 1])).tolist()
    assert ids[0] == ids[2] and len(set(ids)) == 4


def test_limits():
    with pytest.raises(ValueError):
        pr.find_runs(np.zeros(0, np.int64), np.zeros(0, np.int64), least=10)
    with pytest.raises(ValueError):
        pr.find_runs(np.zeros(0, np.int64), np.zeros(0, np.int64), exponent=2)


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(collapsed(words, runs)))


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {d for d, t in docs if len(WORD.findall(t or "")) <= 1500}
    got = {r["doc_id"]: tuple(r) for r in op13_periodic_runs(spark, sf_dir).collect()}
    assert len(got) == len(docs) and len(short) > 150
    for d, t in docs:
        if d in short:
            assert got[d] == expected(d, t)
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_query_on_planted_rows(spark, tmp_dir):
    texts = [None, "", " \n\t", "one", "a " * 24, "a " * 23, "x\x0by\x0c" * 40, ("é ü " * 10 + "z ") * 5, "\xa0 " * 50, "w" * 5000 + " b" * 30]
    rows = [(k, t) for k in range(0, 400, 40) for t in [texts[k // 40]]] + [(k, " ".join(f"w{i * i % 17}" for i in range(k))) for k in range(1, 300, 7) if k % 40]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted(tuple(r) for r in op13_periodic_runs(spark, tmp_dir).collect())
    assert got == sorted(expected(d, t) for d, t in rows)


def test_edges(spark):
    long = "go " * 100_000 + "end"
    rows = [(1, None, "x", 1), (1, "", "y", 2), (None, long, "z", 3), (None, long, "z", 3), (2, "a b c d " * 9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, own string, runs int").withColumn("n_words", F.lit("x")).withColumn("start", F.lit(7))
    got = sorted(((r["doc_id"], r["own"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.periodic_runs(docs).collect()), key=str)
    assert got == sorted([(1, "x", 0, [], ""), (1, "y", 0, [], ""), (None, "z", 100_001, [(0, 100_000, 1)], "go end"),
                          (None, "z", 100_001, [(0, 100_000, 1)], "go end"), (2, None, 36, [(0, 36, 4)], "a b c d")], key=str)
    assert pr.periodic_runs(docs.filter(F.lit(False))).collect() == []
    assert [r["collapsed"] for r in pr.periodic_runs(docs.select("text").filter("text = ''")).collect()] == [""]
