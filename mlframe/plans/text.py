"""Text queries: document enrichment and vectorised UDFs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from mlframe import bindings as B
from mlframe.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS, SENTENCE_SQL, lexicon_array, sentences
from mlframe.operators import text as TX
from mlframe.plans import query
from mlframe.plans.sql import R
from mlframe.sources.tables import read

_POS = "[" + ", ".join(f"'{w}'" for w in POSITIVE_WORDS) + "]"
_NEG = "[" + ", ".join(f"'{w}'" for w in NEGATIVE_WORDS) + "]"
_TOK = "list_transform(string_split_regex(x, '\\s+'), lambda w: trim(w, '.,;:!?()\"'''))"
_ENT = "(contains(w, '@') OR regexp_full_match(w, '[A-Z]{2,}') OR regexp_full_match(w, '[0-9]{3,}'))"
_TYPE = "CASE WHEN contains(w, '@') THEN 'EMAIL' WHEN regexp_full_match(w, '[A-Z]{2,}') THEN 'ORG' ELSE 'NUM' END"

SUMMARY_SQL = f"""
WITH s AS (SELECT doc_id, {SENTENCE_SQL} AS sents FROM documents),
t AS (SELECT doc_id, list_transform(sents, lambda x: {_TOK}) AS toks FROM s),
a AS (SELECT doc_id,
  flatten(list_transform(toks, lambda ts: list_transform(list_filter(ts, lambda w: {_ENT}), lambda w: {_TYPE}))) AS types,
  list_transform(toks, lambda ts: len(list_filter(ts, lambda w: list_contains({_POS}, lower(w))))
                                 - len(list_filter(ts, lambda w: list_contains({_NEG}, lower(w))))) AS d
  FROM t)
SELECT doc_id, CAST(len(types) AS INTEGER) AS n_entities, CAST(len(d) AS INTEGER) AS n_sentences,
  CAST(len(list_filter(d, lambda v: v > 0)) AS INTEGER) AS n_positive,
  {R("CASE WHEN len(d) > 0 THEN list_sum(list_transform(d, lambda v: least(0.99, greatest(0.01, 0.5 + 0.1 * v)))) / len(d) ELSE 0.0 END")} AS mean_score,
  coalesce(list_sort(list_transform(list_distinct(types), lambda ty: {{'n': -len(list_filter(types, lambda q: q = ty)), 't': ty}}))[1].t, '') AS top_entity_type
FROM a
"""


@query("nlp_enrich", sql=SUMMARY_SQL)
def nlp_enrich(spark, d):
    """Sentences -> per-sentence model in mapInPandas (built once per
    partition) -> per-document summary. Every document, whole text."""
    return TX.enrich_docs(read(spark, d, "documents", ["doc_id", "text"]))


@query("doc_summary", sql=SUMMARY_SQL)
def doc_summary(spark, d):
    """The same summary with the sentence model written as array
    expressions (JVM only), rolled up with size / filter / aggregate."""
    docs = read(spark, d, "documents", ["doc_id", "text"]).select("doc_id", sentences("text").alias("s"))
    found = docs.select("doc_id", lexicon_array("s").alias("m")).select("doc_id", F.flatten("m.types").alias("types"), F.col("m.bal").alias("bal"))
    arr = found.select(
        "doc_id",
        F.transform("types", lambda t: F.struct(F.lit("").alias("text"), t.alias("type"))).alias("entities"),
        F.transform("bal", lambda v: F.when(v > 0, "POSITIVE").otherwise("NEGATIVE")).alias("labels"),
        F.transform("bal", lambda v: F.least(F.lit(0.99), F.greatest(F.lit(0.01), F.lit(0.5) + F.lit(0.1) * v))).alias("scores"))
    return TX.doc_summary(arr)


ITER_SQL = f"""
WITH s AS (SELECT doc_id, {SENTENCE_SQL} AS sents FROM documents),
t AS (SELECT doc_id, list_transform(sents, lambda x: {_TOK}) AS toks FROM s),
a AS (SELECT doc_id,
  flatten(list_transform(toks, lambda ts: list_filter(ts, lambda w: {_ENT}))) AS entity_texts,
  flatten(list_transform(toks, lambda ts: list_transform(list_filter(ts, lambda w: {_ENT}), lambda w: {_TYPE}))) AS entity_types,
  list_transform(toks, lambda ts: len(list_filter(ts, lambda w: list_contains({_POS}, lower(w))))
                                 - len(list_filter(ts, lambda w: list_contains({_NEG}, lower(w))))) AS d
  FROM t)
SELECT doc_id, entity_texts, entity_types,
       list_transform(d, lambda v: CASE WHEN v > 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END) AS labels,
       list_transform(d, lambda v: CAST(least(0.99, greatest(0.01, 0.5 + 0.1 * v)) AS DOUBLE)) AS scores
FROM a
"""


@query("iterator_map", sql=ITER_SQL)
def iterator_map(spark, d):
    """The iterator-of-batches stage on its own (model built once per
    partition inside mapInArrow), arrays per document."""
    docs = read(spark, d, "documents", ["doc_id", "text"]).select("doc_id", sentences("text").alias("sentences"))
    out = TX.infer_sentences_arrow(docs)
    return out.select("doc_id", F.transform("entities", lambda e: e["text"]).alias("entity_texts"),
                      F.transform("entities", lambda e: e["type"]).alias("entity_types"), "labels", "scores")


@pandas_udf(T.DoubleType())
def _risk(amount: pd.Series, hour: pd.Series) -> pd.Series:
    import numpy as np
    return 1.0 / (1.0 + np.exp(-(0.02 * amount.fillna(0.0) + 0.1 * hour.fillna(0) - 2.0)))


@query("vector_udf", sql=B.cte(payments=B.PAYMENTS_SQL) + f"""
SELECT event_id, {R('1.0 / (1.0 + exp(-(0.02 * coalesce(amount, 0) + 0.1 * hour(event_ts) - 2.0)))')} AS risk FROM payments
""")
def vector_udf(spark, d):
    """Series -> Series scoring over two columns (Arrow batches)."""
    p = B.payments(spark, d)
    return p.select("event_id", F.round(_risk("amount", F.hour("event_ts")), 6).alias("risk"))
