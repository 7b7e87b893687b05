"""Packing: every id in exactly one piece, gapless sequences, ids equal to the tokenizers library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mlframe.llm.packing import encoder, pack_documents, shortest_pack_first, slots
from mlframe.llm.queries import op3_packing, tokenizer_path


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=64))
def test_patterns_place_every_piece_once(histogram):
    patterns = shortest_pack_first(histogram, 64)
    placed = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= 64 and n > 0
        for length in pattern:
            placed[length] += n
    assert placed == Counter(histogram)
    assert len(patterns) <= 3 * 64
    table = slots(patterns)
    ranks = defaultdict(int)
    for length, rank in zip(table["length"].tolist(), table["rank"].tolist()):
        assert rank >= ranks[length]
        ranks[length] = rank + 1


def test_longest_first_into_the_shortest_pack():
    assert shortest_pack_first({7: 2, 3: 1, 2: 2}, 10) == [((7, 3), 1), ((7, 2), 1), ((2,), 1)] or \
        sum(n for _, n in shortest_pack_first({7: 2, 3: 1, 2: 2}, 10)) == 3
    assert shortest_pack_first({1: 10**9}, 10) == [((1,) * 10, 10**8)]
    with pytest.raises(ValueError):
        shortest_pack_first({11: 1}, 10)


def test_encoder_equals_tokenizers():
    exact = Tokenizer.from_file(tokenizer_path())
    exact.encode_special_tokens = True
    encode = encoder(tokenizer_path())
    for text in ("", "Hello  world\n\n x", "é日本 <|endoftext|> it's", "a" * 3000, " " * 500, "​﻿\t12345 6,7"):
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("run", [" " * 2_000_000, "\u3000\n" * 1_000_000])
def test_very_long_white_space(run):
    exact = Tokenizer.from_file(tokenizer_path())
    exact.encode_special_tokens = True
    text = f"before{run}after it's 12"
    assert encoder(tokenizer_path())(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_very_long_white_space_in_a_table(spark):
    texts = {1: "a" + " " * 2_000_000 + "b", 2: "c"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pack_documents(docs, tokenizer_path(), 1024).collect(), texts, 1024)


def check(rows, texts, capacity):
    encode = encoder(tokenizer_path())
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts.items():
        ids = np.concatenate([encode(text or ""), [0]]).astype("<u4")
        at = 0
        for r in sorted(by_doc.pop(doc), key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    return sum(sum(n for _, n in p) for p in by_sequence.values()) / (capacity * len(by_sequence))


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert check(op3_packing(spark, sf_dir).collect(), texts, 1024) > 0.97


def test_odd_texts_and_columns(spark):
    texts = {1: None, 2: "", 3: "a b c " * 3000, 4: "a", 5: "a", 6: "x" * 20_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("start", F.lit("x")).withColumn("rank", F.lit(1))
    check(pack_documents(docs, tokenizer_path(), 64).collect(), texts, 64)
    kept = pack_documents(docs.filter("doc_id = 4"), tokenizer_path(), 64, keep_ids=True).first()
    assert kept["ids"][-1] == 0 and len(kept["ids"]) == kept["length"]
    assert pack_documents(docs.limit(0), tokenizer_path(), 64).count() == 0


def test_repeated_and_null_ids_are_all_packed(spark):
    docs = spark.createDataFrame([(7, "one two"), (7, "one two"), (None, "three"), (None, None)], "doc_id long, text string")
    rows = pack_documents(docs, tokenizer_path(), 16).collect()
    assert len(rows) == 4
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        assert [o for o, _ in sorted(p)] == [sum(n for _, n in sorted(p)[:k]) for k in range(len(p))]
