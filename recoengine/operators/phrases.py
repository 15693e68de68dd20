"""Phrases of several words as single tokens (SEN-2).

Phrases come as a table.  Every token is exploded with its successors and
equi-joined on its first two words (AQE broadcasts the phrase side when it has
measured it as small, and splits a hot pair of words otherwise); further words are
compared in the join condition.  An occurrence is *taken* unless a longer
occurrence shares a word with it, or one of the same length that begins earlier.
That needs only occurrences beginning close by, so it is a window over a
document's occurrences with a frame as wide as the longest phrase.  The taken
ones are written into the token array in time linear in its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoengine.functions.text import word_tokens


def prepared_phrases(phrases: DataFrame, phrase_col: str = "phrase") -> DataFrame:
    """``(__two, __words)``: the distinct phrases of two words or more, in
    lower case; NULL, empty and one-word rows are none."""
    words = phrases.select(word_tokens(F.col(phrase_col)).alias("__words")).filter(F.size("__words") >= 2).distinct()
    return words.select(F.concat_ws(" ", F.col("__words")[0], F.col("__words")[1]).alias("__two"), "__words")


def phrase_occurrences(tokens: DataFrame, keys: Sequence[str], phrases: DataFrame, longest: int, token_col: str = "__raw") -> DataFrame:
    """``(keys..., start, len)``: every occurrence, places counted from 1."""
    low = tokens.select(*keys, F.transform(token_col, lambda t: F.lower(t)).alias("__low"))
    arr, n = F.col("__low"), F.size("__low")
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    following = [F.slice(arr, 1 + j, n) for j in range(1, longest)]
    names = ["__tok", "start"] + [f"__n{j}" for j in range(1, longest)]
    rows = low.select(*keys, F.inline(F.arrays_zip(arr, places, *following)).alias(*names)).filter(F.col("__n1").isNotNull())
    fits = F.concat_ws(" ", "__tok", "__n1") == F.col("__two")
    for j in range(2, longest):
        fits = fits & ((F.size("__words") <= j) | (F.col(f"__n{j}") == F.get("__words", j)))
    return rows.join(phrases, fits).select(*keys, "start", F.size("__words").alias("len"))


def taken_occurrences(found: DataFrame, keys: Sequence[str], longest: int) -> DataFrame:
    """The occurrences that stand (see the module's rule)."""
    near = Window.partitionBy(*keys).orderBy("start").rangeBetween(1 - longest, longest - 1)

    def beaten(other: Column) -> Column:
        start, size = F.col("start"), F.col("len")
        shares = (other["start"] < start + size) & (start < other["start"] + other["len"])
        return shares & ((other["len"] > size) | ((other["len"] == size) & (other["start"] < start)))

    seen = found.withColumn("__near", F.collect_list(F.struct("start", "len")).over(near))
    return seen.filter(~F.exists("__near", beaten)).drop("__near")


def merge_phrases(df: DataFrame, keys: Sequence[str], text_col: str, phrases: DataFrame, phrase_col: str = "phrase", out: str = "__raw") -> DataFrame:
    """``(keys..., out)``: each text's tokens in their own case, the words of a taken
    phrase as one token with single spaces.  ``keys`` identify rows.

    The length of the longest phrase is read when this is called (one number).
    Without phrases the tokens stay as they are.
    """
    tokens = df.select(*keys, word_tokens(F.col(text_col), lower=False).alias(out))
    table = prepared_phrases(phrases, phrase_col)
    longest = table.agg(F.max(F.size("__words"))).first()[0]
    if longest is None:
        return tokens
    taken = taken_occurrences(phrase_occurrences(tokens, keys, table, longest, out), keys, longest)
    taken = taken.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("__taken"))
    arr, hits = F.col(out), F.col("__taken")

    def piece(j: Column) -> Column:
        """The words between the phrase before and the j-th, and that phrase."""
        before, own = F.get(hits, j - 1), F.get(hits, j)
        begin = F.when(j == 0, F.lit(1)).otherwise(before["start"] + before["len"])
        end = F.coalesce(own["start"], F.size(arr) + 1)
        phrase = F.when(own.isNotNull(), F.array(F.concat_ws(" ", F.slice(arr, own["start"], own["len"])))).otherwise(F.array().cast("array<string>"))
        return F.concat(F.slice(arr, begin, end - begin), phrase)

    merged = F.when(hits.isNull(), arr).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), F.size(hits)), piece)))
    return tokens.join(taken, list(keys), "left").select(*keys, merged.alias(out))
