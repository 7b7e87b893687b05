"""Extra columns of the caller: every name that an operator uses inside, and no other column at all."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from mlframe.llm import html_content, language, toxicity
from mlframe.llm.decontamination import contamination
from mlframe.llm.periodic_runs import periodic_runs
from mlframe.llm.quality import ledger
from mlframe.llm.sharding import shard_records
from mlframe.llm.suffix_dedup import remove_repeats

INSIDE = sorted({m for f in glob.glob(language.__file__.replace("language.py", "*.py")) for m in re.findall(r'"(_[a-z]+)"', open(f).read())}
                | {"own", "id", "doc", "h", "w", "a", "b", "grp", "place", "part", "t", "p", "block", "node", "level", "window"})


def table(spark, text="text"):
    df = spark.createDataFrame([(1, "some words here " * 20), (2, None), (3, "")], f"doc_id long, {text} string")
    return df.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in INSIDE if c != text])


def fitted(spark, kind):
    docs = spark.createDataFrame([(i, f"wort {i} der die das und", "de") for i in range(30)] + [(100 + i, f"word {i} the and of", "en") for i in range(30)],
                                 "doc_id long, text string, lang string")
    if kind == "language":
        return language.fit(docs)
    return toxicity.fit(docs.select("doc_id", "text"), docs.filter("doc_id < 10").select("doc_id"), 0.2)


RUNS = {
    "language": lambda spark, d: language.identify(d, fitted(spark, "language"), keep_text=True),
    "toxicity": lambda spark, d: toxicity.score(d, fitted(spark, "toxicity")),
    "sharding": lambda spark, d: shard_records(d, 4, seed=1),
    "html": lambda spark, d: html_content.main_text(d.withColumnRenamed("text", "html"), html_content.ContentModel()),
    "suffix": lambda spark, d: remove_repeats(d, 100),
    "contamination": lambda spark, d: contamination(d, spark.createDataFrame([("i", "some words here some words")], "item_id string, text string"), keep_text=True),
    "quality": lambda spark, d: ledger(d),
    "runs": lambda spark, d: periodic_runs(d),
}


@pytest.mark.parametrize("name", RUNS)
def test_names_used_inside(spark, name):
    rows = {r["doc_id"]: r for r in RUNS[name](spark, table(spark)).collect()}
    assert sorted(rows) == [1, 2, 3] and len(INSIDE) > 20
    for i, r in rows.items():
        assert all(r[c] == f"{c}{i}" for c in INSIDE)


@pytest.mark.parametrize("name", ["language", "toxicity", "html", "contamination", "quality", "runs"])
def test_text_alone(spark, name):
    assert RUNS[name](spark, table(spark).select("text")).count() == 3
