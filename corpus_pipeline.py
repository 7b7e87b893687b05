"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Every stage works on all rows its predecessor kept. All but the last return
the columns of documents (doc_id, text, lang, source, n_chars).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mlframe.llm import language
from mlframe.llm.decontamination import contamination, is_contaminated
from mlframe.llm.packing import pack_documents
from mlframe.llm.queries import SEQUENCE, tokenizer_path
from mlframe.llm.simhash import simhash_components
from mlframe.llm.suffix_dedup import remove_repeats
from mlframe.llm.tables import in_corpus_order, materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: null texts and texts without a letter (``und``). A null lang becomes the prediction.

    Learns from the rows that have a lang. Every text with a letter has a
    language, so short and mixed documents stay; without any label all texts
    with a letter stay, too.
    """
    model = language.fit(docs.select("doc_id", "text", "lang"))
    found = language.identify(docs.select(*COLUMNS), model, keep_text=True)
    known = F.col("lang_pred") != language.UNKNOWN if model.languages else F.col("text").rlike(r"\p{L}")
    lang = F.coalesce("lang", F.nullif("lang_pred", F.lit(language.UNKNOWN))).alias("lang")
    return found.filter(known).select("doc_id", "text", lang, "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each component of SimHash fingerprints at most 2 bits apart (3-word shingles).

    First means the smallest id; rows with equal ids come in the order of
    their texts, null ids last, so of a repeated row one stays.
    """
    numbered, _ = in_corpus_order(docs.select(*COLUMNS), "doc_id", "text")
    found = simhash_components(numbered, shingle=3, radius=2, id_col="_doc")
    heads = found.filter("_doc = component_id").select("_doc")
    return numbered.join(heads, "_doc", "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every byte of a 100-byte string that also starts earlier out of the texts; n_chars follows.

    A character that is cut in part goes as a whole. A document of which
    nothing but white space is left goes; one that loses nothing stays
    unchanged, null and empty ones too.
    """
    cut = remove_repeats(docs.select(*COLUMNS), length=100, as_text=True).withColumnRenamed("kept", "text")
    changed = F.col("n_removed") > 0
    n_chars = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return cut.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", "text", "lang", "source", n_chars)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least a twentieth of the words lies in 13-word windows of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs.select(*COLUMNS), items, n=13, keep_text=True).filter(~is_contaminated()).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 1024 tokens: one row per piece."""
    return pack_documents(docs.select("doc_id", "text"), tokenizer_path(), SEQUENCE)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: SQL has neither XXH64 fingerprints, expectation-maximisation nor byte-pair encoding; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
