"""Label construction (PRJ-13, PRJ-14): blend stars with sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.functions.numeric import scale_sentiment, to_float


def blend_rating(
    df: DataFrame,
    rating_col: str = "rating",
    sentiment_col: str = "sentiment_score",
    out: str = "final_rating",
    w_rating: float = 0.7,
    w_sent: float = 0.3,
    lo: float = 1.0,
    hi: float = 5.0,
) -> DataFrame:
    """PRJ-14: ``w_rating * rating + w_sent * scaled_sentiment``; the rating alone
    when there is no sentiment; clamped to [lo, hi] with an explicit ``when``
    chain (``greatest``/``least`` skip NULLs); cast to float.

    Inputs are read as float first, as the label stage stores them.
    """
    r = to_float(rating_col)
    s = to_float(sentiment_col)
    scaled = F.when(s.isNotNull(), scale_sentiment(s))
    blended = F.when(scaled.isNotNull(), r * F.lit(w_rating) + scaled * F.lit(w_sent)).otherwise(r)
    clamped = F.when(blended < lo, F.lit(lo)).when(blended > hi, F.lit(hi)).otherwise(blended)
    return df.withColumn(out, clamped.cast("float"))
