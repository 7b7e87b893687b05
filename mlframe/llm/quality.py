"""Rule bitmask ledger: every quality rule is evaluated once per document.

:func:`ledger` keeps what was measured and one bit per failed rule;
versioned policies and their ablations are then bit operations on that
ledger and never read a text again. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mlframe.llm.tables import boxed, unboxed

WHITE = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"

#: Rule i fails with bit 1 << i. Conditions are on the ledger's measurements.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A document is kept if none of the policy's rules failed."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)

    def keeps(self, bits: str | Column = "failed_bits") -> Column:
        return (F.col(bits) if isinstance(bits, str) else bits).bitwiseAND(F.lit(self.mask)) == 0


BASE = Policy("base-1", ("few_words", "repeated_windows"))
FULL = Policy("full-1", tuple(name for name, _ in RULES))


def measurements(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long).

    Null counts as empty. Words lie between white space (space, tab to
    carriage return); lines are split at \\n and counted if they hold a word;
    n_repeat_words are the words in any 3-word window that the text has twice
    or more. Input columns with a measurement's name are replaced.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    names = [c for c in docs.columns if c not in (text_col, *new)]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = [F.col("_own")]
    # each array is a column of its own, so that no lambda computes it again per element
    d = docs.select(boxed(names), text.alias("_text"))
    d = d.select(
        *own,
        F.array_remove(F.split("_text", WHITE), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(NOT_WHITE)).alias("_lines"),
        (F.char_length("_text") - F.char_length(F.regexp_replace("_text", NOT_WHITE + "+", ""))).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", NOT_SYMBOL, "")).cast("long").alias("n_symbols"))
    own += [F.col("word_chars"), F.col("n_symbols")]
    windows = F.when(F.size("_words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_words") - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))))
    d = d.select(*own, F.size("_words").cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                 F.coalesce(windows, F.array().cast("array<long>")).alias("_windows"))
    own += [F.col(c) for c in ("n_words", "n_lines", "n_dup_lines")]
    d = d.select(*own, "_windows", F.sort_array("_windows").alias("_sorted"))
    d = d.select(*own, "_windows", F.exists(
        F.sequence(F.lit(0), F.size("_sorted")), lambda i: F.coalesce(F.get("_sorted", i) == F.get("_sorted", i + 1), F.lit(False))).alias("_any"))
    # only texts that repeat a window need its places: sort (hash, place) and look at the neighbours
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select(*own, F.when(F.col("_any"), placed).alias("_placed"))
    same = lambda x, j: F.coalesce(F.get("_placed", j)["h"] == x["h"], F.lit(False))
    d = d.select(*own, F.sort_array(F.transform(
        F.filter("_placed", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"])).alias("_at"))
    covered = F.aggregate(F.transform("_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3)))),
                          F.lit(0).cast("long"), lambda s, x: s + x)
    d = d.select("_own", *new[:-1], F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))
    return d.select(*unboxed(names), *new)


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """:func:`measurements` and failed_bits (long): bit i is set if RULES[i] failed."""
    m = measurements(docs.drop("failed_bits"), text_col)
    bits = F.lit(0).cast("long")
    for i, (_, broken) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(broken), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return m.withColumn("failed_bits", bits)


def apply_policies(book: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """The ledger with one boolean ``kept_<version>`` per policy."""
    return book.select("*", *[p.keeps().alias(f"kept_{p.version}") for p in policies])


def ablations(book: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """Per policy and rule: documents that fail it, and documents that only this rule removes.

    The ledger shrinks to its distinct bit patterns (at most 2 ** rules rows)
    before any policy is looked at. A policy's empty rule '' counts what it
    keeps. An empty ledger gives zeros.
    """
    patterns = book.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    sums, keys = [], []
    for p in policies:
        for name in ("", *p.rules):
            bit = BITS.get(name, 0)
            seen = F.col("failed_bits").bitwiseAND(F.lit(p.mask))
            fails = (seen.bitwiseAND(F.lit(bit)) != 0) if name else (seen == 0)
            for what, when in (("failed", fails), ("only", seen == bit)):
                sums.append(F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias(f"{what}_{len(keys)}"))
            keys.append((p.version, name))
    one = patterns.agg(*sums)
    rows = F.array(*[F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.col(f"failed_{i}").alias("n_failed"),
                              F.col(f"only_{i}").alias("n_only")) for i, (v, r) in enumerate(keys)])
    return one.select(F.explode(rows).alias("r")).select("r.*")
