"""The registered queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mlframe.llm import html_content, language, oracles, toxicity
from mlframe.llm.conversation_trie import prefix_trie, sequences
from mlframe.llm.decontamination import contamination, is_contaminated
from mlframe.llm.packing import pack_documents
from mlframe.llm.paragraph_dedup import paragraph_classes
from mlframe.llm.periodic_runs import periodic_runs
from mlframe.llm.quality import BASE, FULL, ledger
from mlframe.llm.sharding import shard_records
from mlframe.llm.simhash import simhash_components
from mlframe.llm.suffix_dedup import remove_repeats
from mlframe.llm.token_files import read_token_files, write_token_files

SEQUENCE = 1024
SHARDS = 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's vocabulary file as installed on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the folds that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold("doc_id", 5) == 0, F.lit(False))
    model = language.fit(docs.filter(language.fold("doc_id", 5) != 0))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the folds that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learn = language.fold("doc_id", 4) != 2
    known = labels.filter(learn & F.col("toxic").isNotNull())
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    model = toxicity.fit(docs.filter(learn).select("doc_id", "text"), known.filter("toxic = 1"), prior)
    held_out = F.coalesce(language.fold("doc_id", 4) == 2, F.lit(False))
    found = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(), SEQUENCE)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 16 written shards whose row counts are at most one apart."""
    written = shard_records(_table(spark, sf_dir, "documents"), SHARDS, seed=4)
    text = F.coalesce("text", F.lit(""))
    return written.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                          F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    return html_content.main_text(pages.select("page_id", "url", "html"), html_content.fit(pages.select("page_id", "html")))


def op6_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all lines and their pieces: five-word shingles, Jaccard of 0.8 or more."""
    return paragraph_classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of any 100-byte string that also starts earlier."""
    cut = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, at most 2 differing bits."""
    found = simhash_components(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all 13-word windows of the benchmark."""
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=13)
    ids = F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), is_contaminated().alias("contaminated"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents and the full policy's verdict."""
    book = ledger(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~BASE.keeps()).alias("base_failed"), FULL.keeps().alias("kept"), "failed_bits")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as files of patched frame-of-reference blocks and read back."""
    path = write_token_files(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt to begin with up to five turns of its hundred's first conversation."""
    own = sequences(_table(spark, sf_dir, "conversations"))
    base = own.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 5).alias("_first"))
    none = F.array().cast("array<struct<h:binary,n:bigint>>")
    taken = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 6).cast("int")
    rebuilt = F.concat(F.slice(F.coalesce("_first", none), F.lit(1), taken), F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1))))
    joined = own.join(base, F.col("conv_id") - F.col("conv_id") % 100 == F.col("_base"), "left")
    return prefix_trie(joined.select("conv_id", rebuilt.alias("turns")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all documents; a tenth of them repeat a stretch of their own words from some word on."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    parts = docs.withColumns({"h": h, "w": F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))})
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = F.when(n > 0, g % n).cast("int")
    p = F.when(n > 0, 1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = parts.withColumns({"a": a, "p": p}).withColumn(
        "again", F.transform(F.slice("w", F.col("a") + 1, F.size("w")), lambda x, i: F.get("w", F.col("a") + i % F.col("p"))))
    text = F.when(F.size("w") > 0, F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), "again"), " ")).otherwise(F.col("text"))
    found = periodic_runs(repeated.select("doc_id", text.alias("text")))
    best = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda acc, x: F.when(
        acc.isNull() | (x["length"] * acc["period"] > acc["length"] * x["period"]), x).otherwise(acc))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_language": op1_language,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_html": op5_html,
    "op6_paragraph_dedup": op6_paragraph_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_token_files": op11_token_files,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op5_html": oracles.OP5_SQL,
    "op6_paragraph_dedup": oracles.OP6_SQL,
    "op7_suffix_dedup": oracles.OP7_SQL,
    "op9_decontamination": oracles.OP9_SQL,
    "op10_quality": oracles.OP10_SQL,
}
