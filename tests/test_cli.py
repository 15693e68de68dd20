import json
import os

from recoengine import cli
from recoengine.plans import roles as R

SF = "/root/testdata/sf0.001"


def test_cli_stage_chain(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    R.reviews_raw(spark, SF).write.parquet(p("reviews"))
    R.books_raw(spark, SF).write.parquet(p("books"))
    R.fixture_lexicon(spark).write.parquet(p("lexicon"))
    R.catalog(spark, SF).write.parquet(p("catalog"))
    cli.run(["merge", "--reviews", p("reviews"), "--books", p("books"), "--out", p("merged")], spark)
    cli.run(["preprocess", "--input", p("merged"), "--out", p("pre"), "--min-user", "1", "--min-item", "1"], spark)
    cli.run(["sentiment", "--input", p("pre"), "--lexicon", p("lexicon"), "--out", p("scored")], spark)
    cli.run(["label", "--input", p("scored"), "--out", p("ratings")], spark)
    ratings = spark.read.parquet(p("ratings"))
    assert "final_rating" in ratings.columns and ratings.count() > 0
    cli.run(["--out-format", "csv", "enrich", "--input", p("ratings"), "--catalog", p("catalog"), "--out", p("enriched")], spark)
    from recoengine.sources import io

    titles = [r.book_title for r in io.read_csv_strings(spark, p("enriched")).orderBy("book_title").limit(2).collect()]
    cli.run(["--in-format", "csv", "similar", "--books", p("enriched"), "--titles", *titles, "--out", p("json")], spark)
    lines = [json.loads(x) for f in os.listdir(p("json")) if f.endswith(".json") for x in open(os.path.join(p("json"), f))]
    assert sorted(x["query"] for x in lines) == sorted(titles)
    assert all(len(x["recommendations"]) == 20 for x in lines)


def test_cli_from_csv_with_junk_numbers(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    rows = ["user_id,book_title,rating,sentiment_score,authors,categories"]
    rows += [f'u{u},"Book, {b}",{1 + (u * b) % 5},{0.1 if b % 2 else "n/a"},"[\'A {b % 3}\']","[\'C\']"' for u in range(12) for b in range(15) if (u + b) % 3]
    rows += ['u1,"Book, 99",abc,0.5,,', 'u2,"Book, 98",,x,,']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.csv").write_text("\n".join(rows) + "\n")
    fmt = ["--in-format", "csv", "--out-format", "csv", "--single-line-csv"]
    cli.run([*fmt, "--files", "2", "label", "--input", p("in"), "--out", p("ratings"), "--metrics-out", p("histogram")], spark)
    assert len([f for f in os.listdir(p("ratings")) if f.endswith(".csv")]) == 2
    from recoengine.sources import io

    back = {(r.user_id, r.book_title): r.final_rating for r in io.read_csv_strings(spark, p("ratings")).collect()}
    assert back["u1", "Book, 99"] is None and len(back) == len(rows) - 1
    assert sum(int(r.n) for r in io.read_csv_strings(spark, p("histogram")).collect()) == len(rows) - 1
    cli.run([*fmt, "recommend", "--input", p("ratings"), "--out", p("recs"), "--n", "3", "--pick-user", "--history-out", p("history")], spark)
    recs = io.read_csv_strings(spark, p("recs")).collect()
    assert len(recs) == 3 and len({r.user_id for r in recs}) == 1
    assert {r.user_id for r in io.read_csv_strings(spark, p("history")).collect()} == {recs[0].user_id}
    cli.run([*fmt, "train", "--input", p("ratings"), "--model", p("model"), "--metrics-out", p("errors")], spark)
    cli.run([*fmt, "recommend", "--model", p("model"), "--out", p("served"), "--n", "3", "--pick-user", "--history-out", p("history2")], spark)
    served = io.read_csv_strings(spark, p("served")).collect()
    assert sorted(map(str, served)) == sorted(map(str, recs))
    assert {r.user_id for r in io.read_csv_strings(spark, p("history2")).collect()} == {recs[0].user_id}


def test_corrupt_csv_records_are_kept_and_counted(spark, tmp_path):
    from recoengine.sources import io

    (tmp_path / "x.csv").write_text("id,v\n1,2.5\nx,3\n2,abc\n3,4\n")
    df = io.read_csv(spark, str(tmp_path / "x.csv"), "id int, v double", multi_line=False, keep_corrupt=True).cache()
    assert [tuple(r) for r in io.corrupt_count(df).collect()] == [(4, 2)]
    assert df.filter("id = 3 and v = 4.0").count() == 1
    df.unpersist()
