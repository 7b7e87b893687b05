"""Document enrichment (M28, N3, U5, U6): sentences (P21) -> per-sentence
model inside ``mapInPandas`` (model built once per partition) -> per-document
roll-up with array higher-order functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.functions.text import lexicon_model, sentences

ENRICH_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("entities", T.ArrayType(T.StructType([T.StructField("text", T.StringType()),
                                                         T.StructField("type", T.StringType())]))),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
])


PIECE_BYTES = 2 << 20  # text that the vectorised model takes at once; its tokens and masks are several times as large


def infer_sentences(df: DataFrame, model_factory=lexicon_model) -> DataFrame:
    """U6 / M28 stage 2: iterator-of-frames map; the model is created once
    per partition and applied to every Arrow batch."""
    def run(batches):
        model = model_factory()
        for pdf in batches:
            ents, labs, scs = [], [], []
            for sents in pdf["sentences"]:
                e, l_, s_ = [], [], []
                for s in sents:
                    ee, lab, sc = model(s)
                    e.extend(ee)
                    l_.append(lab)
                    s_.append(sc)
                ents.append(e)
                labs.append(l_)
                scs.append(s_)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "entities": ents, "labels": labs, "scores": scs})

    return df.select("doc_id", "sentences").mapInPandas(run, ENRICH_SCHEMA)


def top_type(entities) -> Column:
    """Most frequent entity type, ties -> smallest name, "" when none."""
    e = F.col(entities) if isinstance(entities, str) else entities
    types = F.array_sort(F.array_distinct(F.transform(e, lambda x: x["type"])))
    counts = F.transform(types, lambda t: F.struct(
        F.size(F.filter(e, lambda x: x["type"] == t)).alias("n"), t.alias("t")))
    best = F.aggregate(counts, F.struct(F.lit(0).alias("n"), F.lit("").alias("t")),
                       lambda acc, c: F.when(c["n"] > acc["n"], c).otherwise(acc))
    return best["t"]


def doc_summary(df: DataFrame) -> DataFrame:
    """Per-document roll-up of the sentence arrays."""
    n_s = F.size("scores")
    mean = F.when(n_s > 0, F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) / n_s).otherwise(F.lit(0.0))
    return df.select("doc_id", F.size("entities").alias("n_entities"), F.size("labels").alias("n_sentences"),
                     F.size(F.filter("labels", lambda x: x == "POSITIVE")).alias("n_positive"),
                     F.round(mean, 6).alias("mean_score"), top_type("entities").alias("top_entity_type"))


def enrich_docs(docs: DataFrame, text: str = "text", model_factory=None) -> DataFrame:
    """The three stages, no repartition(1): parallelism follows the
    input. The built-in lexicon model runs vectorised on Arrow batches; any
    other per-sentence model (``model_factory``) runs in ``mapInPandas``."""
    s = docs.select("doc_id", sentences(text).alias("sentences"))
    inferred = infer_sentences_arrow(s) if model_factory is None else infer_sentences(s, model_factory)
    return doc_summary(inferred)


def infer_sentences_arrow(df: DataFrame) -> DataFrame:
    """The lexicon model vectorised with Arrow compute kernels inside
    ``mapInArrow``: sentences and tokens are flattened once per record batch,
    tokens are matched column-wise, and per-sentence / per-document results
    are rebuilt from the list offsets. Same answers as :func:`infer_sentences`
    with :func:`lexicon_model`, without a Python loop per token."""
    from mlframe.functions.text import ENTITY_RULES, NEGATIVE_WORDS, POSITIVE_WORDS, STRIP_CHARS

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def pieces(batch):  # of about PIECE_BYTES of text, however long the documents of a batch are
            sents = batch.column("sentences")
            size = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(sents.flatten()).fill_null(0), dtype=np.int64))])
            ends = size[np.asarray(sents.offsets)[1:] - sents.offsets[0].as_py()]
            at = np.flatnonzero(np.diff(ends // PIECE_BYTES, prepend=0)).tolist()
            for i, j in zip([0, *at], [*at, len(batch)]):
                if i < j:
                    yield batch.slice(i, j - i)

        pos_set, neg_set = pa.array(POSITIVE_WORDS), pa.array(NEGATIVE_WORDS)
        ent_t = pa.struct([("text", pa.string()), ("type", pa.string())])
        for b in (p for batch in batches for p in pieces(batch)):
            sents = b.column("sentences")
            offs = np.asarray(sents.offsets) - sents.offsets[0].as_py()
            flat = sents.flatten()
            n_sent = len(flat)
            toks_l = pc.utf8_split_whitespace(flat)
            toks = pc.utf8_trim(toks_l.flatten(), characters=STRIP_CHARS)
            tok_sent = np.asarray(toks_l.value_parent_indices()) if len(toks) else np.zeros(0, dtype=np.int64)
            email = pc.match_substring(toks, "@")
            typ = pc.if_else(email, "EMAIL", None)
            is_ent = email
            for name, pat in ENTITY_RULES:
                m = pc.and_not(pc.match_substring_regex(toks, f"^{pat}$"), is_ent)
                typ = pc.if_else(m, name, typ)
                is_ent = pc.or_(is_ent, m)
            low = pc.utf8_lower(toks)
            bal = (np.bincount(tok_sent, weights=np.asarray(pc.is_in(low, value_set=pos_set)), minlength=n_sent)
                   - np.bincount(tok_sent, weights=np.asarray(pc.is_in(low, value_set=neg_set)), minlength=n_sent))
            labels = pa.array(np.where(bal > 0, "POSITIVE", "NEGATIVE").tolist() if n_sent else [], pa.string())
            scores = pa.array(np.minimum(0.99, np.maximum(0.01, 0.5 + 0.1 * bal)), pa.float64())
            # entities keep token order; their document is the sentence's document
            sent_doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
            ent_mask = np.asarray(is_ent.fill_null(False))
            ent_doc = sent_doc[tok_sent[ent_mask]] if ent_mask.any() else np.zeros(0, dtype=np.int64)
            ent_offs = np.concatenate([[0], np.cumsum(np.bincount(ent_doc, minlength=len(offs) - 1))]).astype(np.int32)
            ents = pa.StructArray.from_arrays([toks.filter(pa.array(ent_mask)), typ.filter(pa.array(ent_mask))],
                                              fields=list(ent_t))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ent_offs, pa.int32()), ents),
                 pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), labels),
                 pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), scores)],
                schema=pa.schema([("doc_id", pa.int64()), ("entities", pa.list_(ent_t)),
                                  ("labels", pa.list_(pa.string())), ("scores", pa.list_(pa.float64()))]))

    return df.select("doc_id", "sentences").mapInArrow(run, ENRICH_SCHEMA)
