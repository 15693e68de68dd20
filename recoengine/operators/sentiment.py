"""Lexicon sentiment (SEN-1, SEN-2, SEN-3).

The lexicon is a caller-supplied table ``(token, valence)``.  Plan:

1. tokenise each text once (array column, JVM expressions);
2. ``inline`` one row per token together with its three previous tokens
   (narrow: a document's tokens stay in its partition);
3. hash-join the tokens to the lexicon (inner: only hits survive).  The
   lexicon side is aggregated to one row per token first, so AQE sees its
   real size and broadcasts it; a very large lexicon falls back to a
   shuffle join whose hot tokens AQE splits;
4. apply the booster and negation rules on the hit rows (constant-size
   ``IN`` lists, hashed by Spark);
5. sum per row key.  The partial aggregate runs before the shuffle and, since
   a document's hits are contiguous in one task, ships one row per document;
6. left-join the scores back on the key, so rows without hits get 0.0 and
   every other column and type is kept.

A per-row map lookup would avoid the join-back but Spark's map lookup is a
linear scan of the keys, i.e. O(lexicon) per token; the hash join is O(1).

Rules (Hutto & Gilbert, ICWSM 2014, as parameters; we claim conformance to
these rules, not equality with any library's scores):

* a booster 1, 2 or 3 tokens before a lexicon word adds ``±0.293`` times a
  decay of 1.0 / 0.95 / 0.9, in the direction of the word's valence;
* a negator among the three previous tokens multiplies the word by ``-0.74``;
* the document score is ``s / sqrt(s² + 15)`` of the summed valences;
* NULL or empty text scores 0.0, as does text without lexicon words;
* with ``emphasis=True`` also: a lexicon word in capitals, in a text not all in
  capitals, gains 0.733 in its direction; words before the first contrastive
  conjunction ("but") count half and those after it one and a half times;
  up to four exclamation marks add 0.292 each, and two or three question marks
  0.18 each (more: 0.96), to the sum in its direction.
* with ``phrases`` (a table) words that form a phrase are one token to all rules above:
  it may stand in the lexicon ("kiss of death"), among the boosters ("kind of",
  "never so") or the negators, or in none of them, so that its words count for
  nothing ("without doubt" does not negate; nor does "at least" where "least"
  is a negator).  :mod:`recoengine.operators.phrases` has the matching rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoengine.functions.constants import (
    BOOSTER_DECAY,
    BOOSTER_INCREMENT,
    BOOSTERS_DOWN,
    BOOSTERS_UP,
    CAPS_INCREMENT,
    CONTRAST_AFTER,
    CONTRAST_BEFORE,
    CONTRAST_WORDS,
    EXCLAMATION_INCREMENT,
    EXCLAMATION_MOST,
    NEGATION_SCALAR,
    NEGATORS,
    NORMALIZATION_ALPHA,
    QUESTION_FEW,
    QUESTION_INCREMENT,
    QUESTION_MANY,
)
from recoengine.functions.text import word_tokens
from recoengine.operators.phrases import merge_phrases
from recoengine.operators.skew import split_join
from recoengine.session import reused

LOOKBACK = len(BOOSTER_DECAY)


def prepared_lexicon(lexicon: DataFrame, token_col: str = "token", valence_col: str = "valence") -> DataFrame:
    """One row per lower-cased token (duplicates averaged)."""
    return lexicon.groupBy(F.lower(F.col(token_col)).alias("_tok")).agg(
        F.avg(F.col(valence_col).cast("double")).alias("_val")
    )


def token_emphasis(df: DataFrame, keys: Sequence[str], text_col: str, contrast: Sequence[str] = CONTRAST_WORDS, lookback: int = LOOKBACK, phrases: DataFrame | None = None) -> DataFrame:
    """:func:`token_rows` with two more columns: ``__caps`` (in capitals, in a
    text that has other words too) and ``__weight`` (of the contrast rule)."""
    is_caps = lambda t: (t == F.upper(t)) & (t != F.lower(t))
    raw = _raw_tokens(df, keys, text_col, phrases)
    facts = raw.select(
        *keys,
        F.transform("__raw", lambda t: F.lower(t)).alias("__tokens"),
        F.transform("__raw", is_caps).alias("__is_caps"),
    )
    mixed = F.exists("__is_caps", lambda c: c) & F.exists("__is_caps", lambda c: ~c)
    places = [F.array_position("__tokens", w) for w in contrast]
    first = F.array_min(F.filter(F.array(*places), lambda p: p > 0))
    facts = facts.withColumns({"__mixed": mixed, "__contrast": first})
    arr, n = F.col("__tokens"), F.size("__tokens")
    shifted = [F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), j), arr), 1, n) for j in range(1, lookback + 1)]
    numbers = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    names = ["tok", "__is_cap", "__pos"] + [f"p{j}" for j in range(1, lookback + 1)]
    rows = facts.select(*keys, "__mixed", "__contrast", F.inline(F.arrays_zip(arr, "__is_caps", numbers, *shifted)).alias(*names))
    weight = F.when(F.col("__pos") < F.col("__contrast"), CONTRAST_BEFORE).when(F.col("__pos") > F.col("__contrast"), CONTRAST_AFTER).otherwise(1.0)
    return rows.withColumns({"__caps": F.col("__mixed") & F.col("__is_cap"), "__weight": weight}).drop("__mixed", "__is_cap", "__pos", "__contrast")


def punctuation_emphasis(text: Column) -> Column:
    """What a text's exclamation and question marks add to its sum."""
    count = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    loud = F.least(count("!"), F.lit(EXCLAMATION_MOST)) * F.lit(EXCLAMATION_INCREMENT)
    asked = count("?")
    doubt = F.when(asked > QUESTION_FEW, QUESTION_MANY).when(asked > 1, asked * F.lit(QUESTION_INCREMENT)).otherwise(0.0)
    return F.coalesce(loud + doubt, F.lit(0.0))


def _raw_tokens(df: DataFrame, keys: Sequence[str], text_col: str, phrases: DataFrame | None) -> DataFrame:
    if phrases is not None:
        return merge_phrases(df, keys, text_col, phrases)
    return df.select(*keys, word_tokens(F.col(text_col), lower=False).alias("__raw"))


def token_rows(df: DataFrame, keys: Sequence[str], text_col: str, lookback: int = LOOKBACK, phrases: DataFrame | None = None) -> DataFrame:
    """``(keys..., tok, p1..pN)``: every token with its ``lookback`` predecessors.

    The predecessor columns are the token array shifted right by ``j``
    (``slice(concat(j NULLs, toks), 1, n)``) and zipped with it: plain array
    expressions, no per-token lambda.
    """
    toks = "__tokens"
    if phrases is None:
        with_toks = df.select(*keys, word_tokens(F.col(text_col)).alias(toks))
    else:
        with_toks = _raw_tokens(df, keys, text_col, phrases).select(*keys, F.transform("__raw", lambda t: F.lower(t)).alias(toks))
    arr = F.col(toks)
    n = F.size(arr)
    shifted = [
        F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), j), arr), 1, n) for j in range(1, lookback + 1)
    ]
    zipped = F.arrays_zip(arr, *shifted)
    names = ["tok"] + [f"p{j}" for j in range(1, lookback + 1)]
    return with_toks.select(*keys, F.inline(zipped).alias(*names))


def _in(col: Column, words: Sequence[str]) -> Column:
    return F.coalesce(col.isin(list(words)), F.lit(False)) if words else F.lit(False)


def score_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    text_col: str = "review_text",
    keys: Sequence[str] | None = ("id",),
    out: str = "sentiment_score",
    negators: Sequence[str] = NEGATORS,
    boosters_up: Sequence[str] = BOOSTERS_UP,
    boosters_down: Sequence[str] = BOOSTERS_DOWN,
    negation_scalar: float = NEGATION_SCALAR,
    booster_increment: float = BOOSTER_INCREMENT,
    booster_decay: Sequence[float] = BOOSTER_DECAY,
    alpha: float = NORMALIZATION_ALPHA,
    reuse_input: bool = False,
    emphasis: bool = False,
    contrast: Sequence[str] = CONTRAST_WORDS,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """SEN-1/2/3: append ``out`` (double in [-1, 1]) to ``df``.

    ``keys`` must identify rows uniquely (e.g. a review id, or
    ``(user_id, book_title)`` after WIN-1).  ``keys=None`` scores each
    distinct text once, keyed by ``md5(text)`` (a compact key, so token rows
    do not carry the text; two different texts share a 128-bit digest with
    negligible probability), and joins the scores back on that digest: for
    frames without a row key, or with many repeated texts.  ``df`` is read
    twice (tokens and join-back); ``reuse_input=True`` persists it, worth it
    when its upstream is expensive and its rows are not text-heavy.
    """
    from recoengine.operators.columns import require_columns

    require_columns(df, [text_col] + ([] if keys is None else list(keys)))
    if reuse_input:
        df = reused(df)  # read twice: tokens, and the join-back
    digest = None
    if keys is None:
        digest = "__text_md5"
        df = df.withColumn(digest, F.md5(F.col(text_col)))
        keys = [digest]
        per_text = (
            df.filter(F.col(digest).isNotNull())
            .groupBy(digest)
            .agg(F.first(text_col).alias(text_col))
        )
        source = per_text.select(digest, text_col)
    else:
        keys = list(keys)
        source = df
    toks = token_emphasis(source, keys, text_col, contrast, len(booster_decay), phrases) if emphasis else token_rows(source, keys, text_col, len(booster_decay), phrases)
    lex = prepared_lexicon(lexicon)
    hits = toks.join(lex, toks.tok == lex._tok)
    v = F.col("_val")
    if emphasis:
        v = v + F.when(F.col("__caps"), F.signum(v) * F.lit(CAPS_INCREMENT)).otherwise(0.0)
    inc = F.lit(0.0)
    negated = F.lit(False)
    for j, decay in enumerate(booster_decay, start=1):
        p = F.col(f"p{j}")
        b = F.when(_in(p, boosters_up), F.lit(booster_increment)).when(_in(p, boosters_down), F.lit(-booster_increment))
        inc = inc + F.coalesce(b, F.lit(0.0)) * F.lit(float(decay))
        negated = negated | _in(p, negators)
    adjusted = v + F.signum(v) * inc
    word = F.when(negated, adjusted * F.lit(negation_scalar)).otherwise(adjusted)
    sums = hits.groupBy(*keys).agg(F.sum(word * F.col("__weight") if emphasis else word).alias("__s"))
    s = F.col("__s")
    if emphasis:
        s = s + F.signum(s) * punctuation_emphasis(F.col(text_col))
    # A text (also an empty or NULL one) may stand on a large share of the
    # rows; row keys cannot, and their join shares the input's partitioning.
    scored = split_join(df, sums, [digest], "left") if digest else df.join(sums, keys, "left")
    scored = scored.withColumn(out, F.coalesce(s / F.sqrt(s * s + F.lit(alpha)), F.lit(0.0))).drop("__s")
    return scored.drop(digest) if digest else scored
