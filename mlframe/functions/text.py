"""Text helpers as higher-order array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's --------------------------
# Sentence boundary: whitespace after . ! or ?
SENTENCE_BOUNDARY = r"(?<=[.!?])\s+"
# -----------------------------------------------------------------------------


def sentences(text) -> Column:
    """Split, strip, drop empties; an empty or null text gives [""]. Whole
    sentences: the sentence models here take any length.

    Each split point consumes the whole whitespace run after the punctuation,
    so only the first and the last piece can carry edge whitespace: stripping
    the text once is the same as stripping every sentence, and cheaper."""
    t = F.col(text) if isinstance(text, str) else text
    body = F.regexp_replace(F.coalesce(t, F.lit("")), r"^\s+|\s+$", "")
    parts = F.filter(F.split(body, SENTENCE_BOUNDARY), lambda s: F.length(s) > 0)
    return _once(parts, lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(F.lit(""))))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


# DuckDB twin (RE2 has no look-behind: mark the boundary, then split on the mark).
_SENTENCES = r"""list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(31), 'g'), chr(31)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: length(x) > 0)"""
SENTENCE_SQL = f"(CASE WHEN len({_SENTENCES}) > 0 THEN {_SENTENCES} ELSE [''] END)"


# ---- lexicon model (our stand-in for per-sentence entity + sentiment models) --
# Positive / negative cue words across the four corpus languages (our own list).
POSITIVE_WORDS = ["good", "great", "excellent", "happy", "bon", "bonne", "super", "gut", "toll", "bueno", "buena"]
NEGATIVE_WORDS = ["bad", "poor", "terrible", "sad", "mauvais", "mauvaise", "schlecht", "malo", "mala"]
STRIP_CHARS = ".,;:!?()\"'"
ENTITY_RULES = [("ORG", r"[A-Z]{2,}"), ("NUM", r"[0-9]{3,}")]  # full-token matches; '@' in a token -> EMAIL


def lexicon_model():
    """Per-sentence model as a plain Python object, built once per partition
    by the iterator map (the analogue of loading a model once per worker)."""
    import re

    pos, neg = set(POSITIVE_WORDS), set(NEGATIVE_WORDS)
    rules = [(t, re.compile(p)) for t, p in ENTITY_RULES]

    def entity_type(tok):
        if "@" in tok:
            return "EMAIL"
        for t, rx in rules:
            if rx.fullmatch(tok):
                return t
        return None

    def run(sentence: str):
        toks = [t.strip(STRIP_CHARS) for t in sentence.split()]
        ents = [{"text": t, "type": ty} for t in toks if (ty := entity_type(t))]
        low = [t.lower() for t in toks]
        d = sum(t in pos for t in low) - sum(t in neg for t in low)
        label = "POSITIVE" if d > 0 else "NEGATIVE"
        score = min(0.99, max(0.01, 0.5 + 0.1 * d))
        return ents, label, score

    return run


def _tokens(s):
    return F.transform(F.split(s, r"\s+"), lambda w: F.trim(w, F.lit(STRIP_CHARS)))


def _entity_type(w):
    return (F.when(F.instr(w, "@") > 0, F.lit("EMAIL"))
            .when(w.rlike("^[A-Z]{2,}$"), F.lit("ORG"))
            .when(w.rlike("^[0-9]{3,}$"), F.lit("NUM")))


def lexicon_array(sents) -> Column:
    """The lexicon model as pure array expressions (no Python): per sentence
    the entity types and the cue balance, as (types, bal)."""
    s = F.col(sents) if isinstance(sents, str) else sents
    def sentence(x):  # tokens are cut once; few of them are cues
        return _once(_tokens(x), lambda ts: F.struct(
            F.filter(F.transform(ts, _entity_type), lambda t: t.isNotNull()).alias("types"),
            F.aggregate(F.filter(F.transform(ts, lambda w: F.lower(w)), lambda w: w.isin(POSITIVE_WORDS + NEGATIVE_WORDS)), F.lit(0),
                        lambda d, w: d + F.when(w.isin(POSITIVE_WORDS), 1).otherwise(-1)).alias("bal")))
    return F.transform(s, sentence)
