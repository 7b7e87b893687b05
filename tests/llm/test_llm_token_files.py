"""Token files: blocks and files round trip, ids equal to the tokenizers library, rows equal to a plain loop."""

import io
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mlframe.llm import pfor
from mlframe.llm.queries import op11_token_files, tokenizer_path
from mlframe.llm.token_files import PieceEncoder, piece_encoder, read_token_files, write_token_files

PATH = tokenizer_path("word_bpe_49k.json")


def starts(blocks):
    return np.cumsum([0, *map(len, blocks)])[:-1].astype(np.int64)


@pytest.mark.parametrize("high", [1, 2, 300, 1 << 16, 1 << 31, 1 << 32])
@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_blocks_round_trip(n, high):
    rng = np.random.Generator(np.random.PCG64([n, high]))
    ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
    ids[rng.random(n) < 0.02] = high - 1  # outliers
    blocks = pfor.encode_blocks(ids)
    assert len(blocks) == -(-n // pfor.BLOCK)
    assert pfor.decode_blocks(b"".join(blocks), starts(blocks)).tolist() == ids.tolist()


def test_outliers_are_exceptions():
    ids = np.arange(1024, dtype=np.uint32) % 8 + 1000
    ids[[5, 900]] = 49_000
    block = pfor.encode_blocks(ids)[0]
    head = np.frombuffer(block, pfor._HEAD, 1)[0]
    assert (head["least"], head["width"], head["exceptions"], head["count"]) == (1000, 3, 2, 1024)
    assert len(block) == pfor._HEAD.itemsize + 3 * 128 + 2 * 6


class Stream(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def test_any_range_by_the_index():
    rng = np.random.Generator(np.random.PCG64(1))
    out, all_ids = Stream(), []
    writer = pfor.Writer(out, pa.string(), chunk=2048)
    for k in range(40):
        count = rng.integers(0, 300, 7)
        ids = rng.integers(0, 50_000, count.sum()).astype(np.uint32)
        writer.add(ids, pa.array([f"{k}-{i}" for i in range(7)]), count)
        all_ids.append(ids)
    assert writer.finish() == out.size()
    all_ids = np.concatenate(all_ids)
    reader = pfor.Reader(out)
    assert reader.n_ids == len(all_ids) and reader.documents().num_rows == reader.n_docs == 280
    for a, b in [(0, len(all_ids)), (1, 2), (1000, 1030), (1024, 2048), (len(all_ids) - 1, len(all_ids) + 5), (7, 7)]:
        assert reader.ids(a, b).tolist() == all_ids[a:b].tolist()


def test_broken_files_are_refused():
    for data in (b"", b"x" * 200):
        with pytest.raises(ValueError):
            pfor.Reader(Stream(data))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aAbJKIsStT.,;:!?)'’ \t\n\r\x0b\x0c\x1c\x85\xa0　́̌̇İKſßéÉ日1²½🙂<|>"),
                                           st.characters(exclude_categories=("Cs",))), max_size=40), max_size=5))
def test_encoder_equals_tokenizers(texts):
    encoder = piece_encoder(PATH)
    ids, count = encoder.encode(pa.array(texts, pa.string()))
    want = [encoder.exact.encode(t, add_special_tokens=False).ids for t in texts]
    assert count.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_letters_are_the_tokenizers_own():
    """Characters that newer Unicode tables count as letters and the tokenizer does not."""
    encoder = piece_encoder(PATH)
    texts = ["A\U0003d000", "a\u0558b \u058b", "x\U00011ddbz\U0003fc3f", "\U0001e6c0"]
    ids, count = encoder.encode(pa.array(texts, pa.string()))
    want = [encoder.exact.encode(t, add_special_tokens=False).ids for t in texts]
    assert count.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_other_tokenizers_take_whole_texts():
    encoder = PieceEncoder(tokenizer_path("byte_bpe_50k.json"))
    assert not encoder.breaks_at_space
    texts = ["Hello  world\n", "", "it's 12"]
    ids, count = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in encoder.exact.encode(t, add_special_tokens=False).ids] and count[1] == 0


def expected(rows):
    """(doc_id, start, n_tokens, ids_crc32, ids) of (id, text) rows in file order."""
    exact = Tokenizer.from_file(PATH)
    exact.encode_special_tokens = True
    out, at = [], 0
    for i, text in rows:
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


def test_query_equals_plain_loop(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    assert [tuple(r) for r in op11_token_files(spark, sf_dir).orderBy("doc_id").collect()] == [r[:4] for r in expected(docs)]


def test_edges(spark):
    long = "<|endoftext|> Word, " * 120_000
    texts = {3: None, 1: "", 2: long, -5: "a" * 200_000, 7: " \n ", 9: "Ünï 日本"}
    docs = spark.createDataFrame([(i, t, "x", 5, "s") for i, t in texts.items()], "doc_id long, text string, start string, _text int, _id string")
    path = write_token_files(docs.repartition(3), PATH, part_bytes=1000, file_ids=2000)
    got = [(*r[:4], list(r[4])) for r in read_token_files(spark, path, keep_ids=True, chunk=1024).orderBy("doc_id").collect()]
    assert got == expected(sorted(texts.items()))


def test_repeated_and_null_ids(spark):
    rows = [(1, "b"), (1, "a"), (1, "a"), (None, "n"), (None, None), (0, "z")]
    path = write_token_files(spark.createDataFrame(rows, "doc_id int, text string"), PATH)
    got = read_token_files(spark, path, id_type="int").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [0, 1, 1, 1, None, None]
    assert sorted(r["ids_crc32"] for r in got) == sorted(r[3] for r in expected(rows))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()


def test_text_ids_and_empty_table(spark):
    docs = spark.createDataFrame([("b", "x"), ("a", "y z")], "name string, text string")
    got = read_token_files(spark, write_token_files(docs, PATH, id_col="name"), "name", "string").orderBy("start").collect()
    assert [(r["name"], r["start"]) for r in got] == [("a", 0), ("b", 3)]
    empty = write_token_files(docs.filter(F.lit(False)), PATH, id_col="name")
    assert read_token_files(spark, empty, "name", "string").collect() == []


def test_a_task_that_runs_again_changes_nothing(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('some words ', 1 + CAST(id % 7 AS int)) AS text")
    path = write_token_files(docs, PATH, file_ids=100)
    before = {f: open(f"{path}/{f}", "rb").read() for f in os.listdir(path) if f.endswith(".pfor")}
    again = write_token_files(docs, PATH, file_ids=100)
    assert {f: open(f"{again}/{f}", "rb").read() for f in os.listdir(again) if f.endswith(".pfor")} == before and len(before) == 8
    assert not [f for f in os.listdir(path) if f.startswith(".passing") and not f.endswith(".crc")]
