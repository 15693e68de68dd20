"""Column expressions for titles and free text (PRJ-6, PRJ-7, PRJ-8, CON-2).

All of them are built-in JVM expressions and stay inside whole-stage codegen
(or, for the array functions, in the interpreted JVM path); none is a UDF.
Java's ``\\w`` is ASCII unless ``(?U)`` is given, which matches DuckDB's RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recoengine.functions.constants import TITLE_KEY_DROP, TITLE_KEY_STRICT_DROP


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title_key(col: str | Column, unicode: bool = False) -> Column:
    """PRJ-6: drop ``[^\\w\\s]``, trim spaces, lower-case.

    ``trim`` strips spaces only, so tabs and newlines survive (parity).
    """
    pattern = ("(?U)" if unicode else "") + TITLE_KEY_DROP
    return F.lower(F.trim(F.regexp_replace(_c(col), pattern, "")))


def title_key_strict(col: str | Column) -> Column:
    """PRJ-7: keep ``[a-zA-Z0-9\\s]``, lower-case, collapse ``\\s+``, trim."""
    cleaned = F.lower(F.regexp_replace(_c(col), TITLE_KEY_STRICT_DROP, ""))
    return F.trim(F.regexp_replace(cleaned, "\\s+", " "))


def similarity_text(description: str | Column, title: str | Column) -> Column:
    """PRJ-8: ``concat_ws(' ', description, title)``, lower, non ``[a-z0-9\\s]`` to space, collapse, trim."""
    text = F.lower(F.concat_ws(" ", _c(description), _c(title)))
    text = F.regexp_replace(text, "[^a-z0-9\\s]", " ")
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def whitespace_tokens(col: str | Column) -> Column:
    """CON-2: lower-case and split on single whitespace characters.

    Same contract as ``pyspark.ml.feature.Tokenizer``: an empty string gives
    ``['']``.
    """
    return F.split(F.lower(_c(col)), "\\s")


def word_tokens(col: str | Column, lower: bool = True) -> Column:
    """Sentiment tokens: lower-case (unless ``lower=False``), split on whitespace runs, strip non-word
    characters (other than ``'``) from both ends of each token, drop empty
    tokens.

    Written as one split whose separator also swallows the edge characters of
    its neighbours (``[^\\w']*\\s+[^\\w']*``), after stripping both ends of the
    whole text: one regex pass per text instead of one per token.
    """
    text = F.coalesce(_c(col), F.lit(""))
    text = F.lower(text) if lower else text
    text = F.regexp_replace(text, "^[^\\w']+|[^\\w']+$", "")
    return F.filter(F.split(text, "[^\\w']*\\s+[^\\w']*"), lambda t: t != F.lit(""))
