"""Multilingual mixture inference.

Each language is a smoothed distribution over hashed byte n-grams. A text is
a mixture: each of its segments (a run of n-grams) was written in one
language, and expectation-maximisation estimates the languages' proportions.
The language set grows greedily from the best single language; a further one
stays only if the likelihood gains more than its penalty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.llm._text import SPACE, slices, squeezed
from mlframe.llm.tables import boxed, unboxed

UNKNOWN = "und"

#: everything but a-z (A-Z is lowered first) and the bytes of non-ASCII characters
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[97:123] = NOT_LETTER[128:] = False


@dataclass
class LanguageModel:
    """log p(n-gram | language) by hash bucket: at most buckets x languages numbers."""

    languages: list[str]
    table: np.ndarray  # float32 [buckets, languages]
    gram: int
    segment: int
    penalty: float


def gram_codes(column: pa.Array, gram: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram of the lower-case words of each text (a space around each), and the n-grams before each text (n + 1)."""
    text, start, end, first = squeezed(column, NOT_LETTER)
    text = np.concatenate([[SPACE], text, np.full(gram, SPACE)]).astype(np.uint32)
    code = np.zeros(len(text) - gram + 1, np.uint32)
    for k in range(gram):
        code = code * np.uint32(0x01000193) + text[k:k + len(code)] * np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code = (code * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    has = first[1:] > first[:-1]
    n = np.zeros(len(first) - 1, np.int64)
    a = np.zeros(len(n), np.int64)
    a[has] = start[first[:-1][has]]
    # n-grams that begin at the space before the first word up to the one that ends at the space after the last
    n[has] = np.maximum(end[first[1:][has] - 1] - a[has] + 3 - gram, 1)
    before = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(a - before[:-1], n) + np.arange(before[-1])
    return (code[at] & np.uint32(buckets - 1)).astype(np.int64), before


def fit(docs: DataFrame, per_language: int = 2_000, gram: int = 3, buckets: int = 1 << 16, segment: int = 32,
        penalty: float = 2.0, smooth: float = 0.05, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> LanguageModel:
    """Learn n-gram distributions from about ``per_language`` rows of each non-null language.

    The sample is a hash of the id against each language's share, so it is
    the same on every run; more labelled rows than that are not needed. What
    reaches the driver is at most buckets x languages counts.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[lang_col]: r["count"] for r in labelled.groupBy(lang_col).count().collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), gram, segment, penalty)
    rate = F.lit(0.0)
    for name in languages:
        rate = F.when(F.col(lang_col) == name, min(1.0, per_language / counts[name])).otherwise(rate)
    sample = labelled.filter(F.pmod(F.xxhash64(F.lit("language"), id_col), F.lit(1_000_000)) < rate * 1_000_000)
    number = {name: i for i, name in enumerate(languages)}

    def run(batches):
        total = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            for part in slices(batch, text_col):
                code, before = gram_codes(part.column(text_col), gram, buckets)
                own = np.array([number[x] for x in part.column(lang_col).to_pylist()], np.int64)
                key = np.repeat(own, np.diff(before)) * buckets + code
                total += np.bincount(key, minlength=total.size).reshape(total.shape)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["cell", "n"])

    rows = sample.select(lang_col, text_col).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(len(languages) * buckets)
    seen[rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
    seen = seen.reshape(len(languages), buckets).T + smooth
    return LanguageModel(languages, np.log(seen / seen.sum(axis=0)).astype(np.float32), gram, segment, penalty)


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of each text; every text has at least one row."""
    return np.add.reduceat(values, first, axis=0)


def expectation_maximisation(loglik: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int = 15):
    """Proportions [texts, languages] and the mixture log likelihood of each segment, given each text's allowed languages."""
    n = np.diff(np.concatenate([first, [len(loglik)]]))
    text = np.repeat(np.arange(len(first)), n)
    masked = np.where(allowed[text], loglik, -np.inf)
    top = masked.max(axis=1, keepdims=True)
    p = np.exp(masked - top)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        r = p * share[text]
        r /= r.sum(axis=1, keepdims=True)
        share = _per_text(r, first) / n[:, None]
    return share, np.log((p * share[text]).sum(axis=1)) + top[:, 0]


def infer(model: LanguageModel, code: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions [texts, languages], and how sure the leading language is against the others taken alone.

    Overlapping n-grams count as 1 / gram of a sample each. Texts without
    n-grams have zeros.
    """
    n = np.diff(before)
    share, sure = np.zeros((len(n), len(model.languages))), np.zeros(len(n))
    used = np.flatnonzero(n)
    if not len(used) or not model.languages:
        return share, sure
    pieces = -(-n[used] // model.segment)
    first = np.cumsum(pieces) - pieces
    nth = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
    seg = np.add.reduceat(model.table[code], np.repeat(before[:-1][used], pieces) + nth * model.segment, axis=0).astype(np.float64)
    seg /= model.gram
    alone = _per_text(seg, first)
    best = alone.argmax(axis=1)
    allowed = np.zeros(alone.shape, bool)
    allowed[np.arange(len(used)), best] = True
    result = allowed.astype(float)
    now = seg[np.arange(len(seg)), np.repeat(best, pieces)]  # log likelihood per segment of the set so far
    price = model.penalty + 0.5 * np.log(pieces)
    open_ = np.arange(len(used))
    for _ in range(len(model.languages) - 1):
        mine = np.repeat(np.isin(np.arange(len(used)), open_), pieces)
        starts = np.cumsum(pieces[open_]) - pieces[open_]
        gain = _per_text(np.maximum(seg[mine] - now[mine][:, None], 0.0), starts)  # no mixture can gain more
        gain[allowed[open_]] = -1.0
        add = gain.argmax(axis=1)
        hope = gain[np.arange(len(open_)), add] > price[open_]
        open_, add = open_[hope], add[hope]
        if not len(open_):
            break
        mine = np.repeat(np.isin(np.arange(len(used)), open_), pieces)
        starts = np.cumsum(pieces[open_]) - pieces[open_]
        trial = allowed[open_].copy()
        trial[np.arange(len(open_)), add] = True
        pi, each = expectation_maximisation(seg[mine], starts, trial)
        stays = _per_text(each - now[mine], starts) > price[open_]
        new = now[mine].copy()
        taken = np.repeat(stays, pieces[open_])
        new[taken] = each[taken]
        now[mine] = new
        allowed[open_[stays]], result[open_[stays]] = trial[stays], pi[stays]
        open_ = open_[stays]
        if not len(open_):
            break
    share[used] = result
    odds = np.exp(alone - alone.max(axis=1, keepdims=True))
    sure[used] = 1.0 / odds.sum(axis=1)
    return share, sure


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` without the text (or with it), with lang_pred, score (leading share times its certainty, 0 to 1) and lang_shares.

    ``und`` with score 0 if the text is null or has no letter; otherwise the
    language with the largest share (of equal ones the first by name).
    lang_shares maps each language of the chosen set to its share. Columns
    with the result's names are replaced. With an empty model every text is
    ``und``.
    """
    new = ("lang_pred", "score", "lang_shares")
    own = [c for c in docs.columns if c not in (text_col, *new)]
    work = docs.select(boxed(own), F.col(f"`{text_col}`").alias("_text"),
                       F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    passed = ["_text"] if keep_text else []
    shared = docs.sparkSession.sparkContext.broadcast(model)
    limit = max(1 << 16, (4 << 20) // max(4, len(model.languages)))

    def run(batches):
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, "_text", limit):
                code, before = gram_codes(part.column("_text"), m.gram, len(m.table))
                share, sure = infer(m, code, before)
                known = part.column("_letters").to_numpy(zero_copy_only=False) & (share.sum(axis=1) > 0)
                top = share.argmax(axis=1) if len(m.languages) else np.zeros(len(known), np.int64)
                score = np.where(known, share[np.arange(len(top)), top] * sure if len(m.languages) else 0.0, 0.0)
                pred = names[np.where(known, top, len(m.languages))]
                shares = [[(m.languages[j], float(row[j])) for j in np.flatnonzero(row)] if k else [] for row, k in zip(share, known)]
                text = [part.column("_text")] if keep_text else []
                yield pa.RecordBatch.from_arrays(
                    [part.column("_own"), *text, pa.array(pred, pa.string()), pa.array(np.clip(score, 0.0, 1.0)),
                     pa.array(shares, pa.map_(pa.string(), pa.float64()))], names=["_own", *passed, *new])

    schema = work.select("_own", *passed, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"),
                         F.create_map(F.lit(""), F.lit(0.0)).alias("lang_shares")).schema
    return work.mapInArrow(run, schema).select(*unboxed(own), *[F.col("_text").alias(text_col) for _ in passed], *new)


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(folds))
