"""The row-wise operators apply unchanged to a streaming DataFrame."""

from recoengine.operators import columns as C
from recoengine.operators import filters
from recoengine.operators.label import blend_rating


def test_rowwise_operators_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("u1", "5", 1.0, "N/A"), ("u2", "abc", 0.0, "x"), ("u3", "2", None, "y"), ("u4", "0", 0.5, "z")]
    spark.createDataFrame(rows, "user_id string, score string, sentiment_score double, authors string").write.parquet(src)
    stream = spark.readStream.schema("user_id string, score string, sentiment_score double, authors string").parquet(src)
    out = blend_rating(filters.valid_ratings(C.coerce_float(C.null_sentinels(stream, ["authors"]), "score"), "score"), rating_col="score")
    assert out.isStreaming
    q = out.writeStream.format("memory").queryName("rowwise_out").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.user_id: (r.final_rating, r.authors) for r in spark.sql("SELECT * FROM rowwise_out").collect()}
    assert got == {"u1": (5.0, None), "u3": (2.0, "y")}
