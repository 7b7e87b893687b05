"""The prefix trie against a plain dictionary of prefixes, for several block widths."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mlframe.llm import conversation_trie
from mlframe.llm.conversation_trie import prefix_trie, sequences
from mlframe.llm.queries import op12_prefix_trie

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(convs: dict[int, list[tuple[str, str]]]) -> set:
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(convs):
        path = tuple(convs[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[:d - 1]].add(path[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        gain = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += gain
            leaves[path[:d]] += path not in children
    out = set()
    for path, own in members.items():
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(path))
        out.add((own[0], len(path), members[path[:-1]][0] if path else None, len(own), len(children[path]) if path in children else 0,
                 leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def by_order(rows) -> dict[int, list[tuple[str, str]]]:
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(own)] for c, own in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def got(df) -> list:
    return [tuple(r) for r in df.select(*NAMES).collect()]


def random_rows(seed: int, n: int, alphabet: int, longest: int):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(n * 3), n):
        for turn in range(rnd.choice([1, 2, 3, longest])):
            rows.append((c, turn, rnd.choice(["user", "bot"]), "é" * rnd.randrange(alphabet)))
    return rows


@pytest.mark.parametrize("width", [1, 2, 3, 8])
def test_any_width_equals_brute_force(spark, width):
    rows = random_rows(width, 120, 2, 17)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = got(prefix_trie(sequences(turns), width))
    assert len(found) == len(set(found)) and set(found) == brute(by_order(rows))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = got(op12_prefix_trie(spark, sf_dir))
    assert len(found) == len(set(found)) and set(found) == brute(rebuilt(by_order(rows)))


def test_query_on_planted_rows(spark, tmp_dir):
    rows = random_rows(7, 260, 3, 40)
    rows = [r for r in rows if r[0] != 200]  # a hundred without its first conversation
    rows += [(0, None, None, None), (1, None, "user", "hi"), (1, 5, None, "x"), (None, 1, "user", "lost")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    found = got(op12_prefix_trie(spark, tmp_dir))
    assert len(found) == len(set(found)) and set(found) == brute(rebuilt(by_order([r for r in rows if r[0] is not None])))


def test_turnless_conversations_and_copies(spark):
    convs = {5: [], 3: [], 9: [("u", "abc")] * 30, 10: [("u", "abc")] * 30, 11: [("u", "abc")] * 16}
    rows = spark.createDataFrame([(c, [(hashlib.sha256(repr(t).encode()).digest()[:16], len(t[1])) for t in own]) for c, own in convs.items()],
                                 "conv_id long, turns array<struct<h:binary,n:bigint>>")
    assert set(got(prefix_trie(rows))) == brute(convs)
    assert set(got(prefix_trie(rows.withColumn("turns", F.when(F.size("turns") > 0, F.col("turns")))))) == brute(convs)


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 50)
    rows = spark.range(3000).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "if(id % 3 = 0, 'other', 'hello') AS text")
    convs = {i: [("user", "other" if i % 3 == 0 else "hello")] for i in range(3000)}
    assert set(got(prefix_trie(sequences(rows)))) == brute(convs)


def test_role_and_text_are_told_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "abc", None), (4, 0, None, "abc"), (5, 0, "1:a", "x"), (6, 0, "1", ":ax")]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("t1", F.lit(1)).withColumn("node", F.lit("x"))
    assert set(got(prefix_trie(sequences(turns)))) == brute(by_order(rows))


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert set(got(prefix_trie(sequences(turns)))) == brute(by_order(rows))
    assert got(prefix_trie(sequences(turns.filter(F.lit(False))))) == []


def test_the_plan_rolls_up(spark):
    rows = spark.createDataFrame(random_rows(1, 5, 2, 9), "conv_id long, turn long, role string, text string")
    laid = conversation_trie._laid_out(sequences(rows), 4)
    rolled = conversation_trie._rolled(conversation_trie._blocks(laid, 4), 4, "count(*) AS n_convs")
    assert "Expand" in rolled._jdf.queryExecution().optimizedPlan().toString()
