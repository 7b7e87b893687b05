"""The rule ledger against plain Python; policies and ablations; no Python in the plan."""

import re

import pytest
from pyspark.sql import functions as F

from mlframe.llm.quality import BASE, FULL, RULES, Policy, ablations, apply_policies, ledger, measurements
from mlframe.llm.queries import op10_quality

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, places = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            places.update(p + k for p in at for k in range(3))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places)


TEXTS = [None, "", " \t\n", "one", "a b c a b c", "a a a a a", "x y\nx y\n x y\n\nx y", "é ü # * | <b> 日本 語 z", "a b c d a b c x b c d",
         "\x0bq\x0cr\x1cs", "w " * 5000, " ".join(map(str, range(9000))), "\n".join(["same line here"] * 50)]


def test_measurements_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").withColumn("n_words", F.lit("mine"))
    got = {r["doc_id"]: tuple(r[c] for c in NAMES) for r in measurements(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_query_equals_brute_force(spark, sf_dir):
    docs = {r["doc_id"]: brute(r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op10_quality(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r[c] for c in NAMES) for r in rows} == docs
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["failed_bits"] == 0) and not (r["kept"] and r["base_failed"])


def test_plan_is_native(spark, sf_dir):
    plan = op10_quality(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_policies_and_ablations(spark):
    book = ledger(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").withColumn("failed_bits", F.lit("x")))
    policies = (BASE, FULL, Policy("symbols-1", ("symbols",)))
    rows = apply_policies(book, policies).collect()
    table = {(r["policy"], r["rule"]): (r["n_failed"], r["n_only"]) for r in ablations(book, policies).collect()}
    bit = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    for p in policies:
        assert table[p.version, ""][0] == sum(r[f"kept_{p.version}"] for r in rows)
        for name in p.rules:
            masked = [r["failed_bits"] & p.mask for r in rows]
            assert table[p.version, name] == (sum(bool(m & bit[name]) for m in masked), sum(m == bit[name] for m in masked))


def test_empty_table(spark):
    book = ledger(spark.createDataFrame([], "doc_id int, text string"))
    assert book.count() == 0
    assert all(r["n_failed"] == 0 for r in ablations(book, (BASE,)).collect())


@pytest.mark.parametrize("n", [49, 50])
def test_word_limit(spark, n):
    text = " ".join(f"word{i}" for i in range(n))
    row = apply_policies(ledger(spark.createDataFrame([(1, text)], "doc_id int, text string")), (BASE,)).first()
    assert row["kept_base-1"] == (n >= 50)
