"""Run one stage as a Spark job: ``spark-submit --py-files recoengine.zip recoengine/cli.py <stage> ...``
(or ``python -m recoengine.cli`` with a local master).

Stages mirror the original application's steps; each reads its inputs from
Parquet or header CSV and writes its output (Parquet by default):

  merge       reviews + books           -> merged          (PIP-1)
  preprocess  merged                    -> preprocessed    (PIP-2)
  sentiment   preprocessed + lexicon    -> scored          (SEN-1..3)
  label       scored                    -> ratings         (PIP-3)
  enrich      ratings + catalog         -> books_enriched  (ENR-1..3)
  recommend   ratings [+ users]         -> top-n per user  (CF-10)
  similar     books_enriched + titles   -> JSON per title  (CON-1..7, SNK-4)
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from recoengine.session import apply_runtime_defaults, ensure_checkpoint_dir
from recoengine.sources import io


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="recoengine", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--in-format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--out-format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--files", type=int, default=0, help="number of output files (0: left to Spark)")
    p.add_argument("--single-line-csv", action="store_true", help="CSV input without line breaks in fields (can be split)")
    sub = p.add_subparsers(dest="stage", required=True)

    s = sub.add_parser("merge")
    s.add_argument("--reviews", required=True)
    s.add_argument("--books", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--dedupe", default="longest", choices=["longest", "none"])
    s.add_argument("--cap", type=int, default=0)

    s = sub.add_parser("preprocess")
    s.add_argument("--input", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--min-user", type=int, default=3)
    s.add_argument("--min-item", type=int, default=3)
    s.add_argument("--metrics-out", help="where to write the rows in and out of every step (AGG-7)")

    s = sub.add_parser("sentiment")
    s.add_argument("--input", required=True)
    s.add_argument("--lexicon", required=True, help="table with columns token, valence")
    s.add_argument("--out", required=True)
    s.add_argument("--keys", default="user_id,book_title")

    s = sub.add_parser("label")
    s.add_argument("--input", required=True)
    s.add_argument("--out", required=True)

    s.add_argument("--metrics-out", help="where to write the rows per rating (AGG-3)")

    s = sub.add_parser("enrich")
    s.add_argument("--input", required=True)
    s.add_argument("--catalog", required=True, help="table with columns title, description")
    s.add_argument("--out", required=True)
    s.add_argument("--top", type=int, default=0, help="only the most popular titles (0: all)")

    s = sub.add_parser("train")
    s.add_argument("--input", required=True)
    s.add_argument("--model", required=True, help="folder of stored models; a new version is added")
    s.add_argument("--metrics-out", help="where to write the hold-out RMSE/MAE")

    s = sub.add_parser("recommend")
    source = s.add_mutually_exclusive_group(required=True)
    source.add_argument("--input")
    source.add_argument("--model", help="folder of stored models: serve from the newest, without a fit")
    s.add_argument("--out", required=True)
    s.add_argument("--users", help="table with a user_id column; all users if omitted")
    s.add_argument("--k", type=int, default=100)
    s.add_argument("--n", type=int, default=20)
    s.add_argument("--metrics-out", help="where to write the hold-out RMSE/MAE")
    s.add_argument("--pick-user", action="store_true", help="one active user instead of all (TOP-5)")
    s.add_argument("--cap", type=int, default=0, help="only the first rows by user and title (SRC-4)")
    s.add_argument("--history-out", help="where to write the users' best-rated books (TOP-2)")

    s = sub.add_parser("similar")
    s.add_argument("--books", required=True, help="table with book_title and description (or final_description)")
    s.add_argument("--titles", nargs="+", required=True)
    s.add_argument("--out", required=True, help="JSON output folder")
    s.add_argument("--k", type=int, default=20)
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"recoengine-{args.stage}").getOrCreate()
    ensure_checkpoint_dir(spark)
    apply_runtime_defaults(spark)

    def read(path):
        return io.read_table(spark, path, args.in_format, multi_line=not args.single_line_csv)

    def write(df, path):
        io.write_table(df, path, args.out_format, files=args.files or None)

    if args.stage == "merge":
        from recoengine.plans.stages import merge_stage

        write(merge_stage(read(args.reviews), read(args.books), dedupe=args.dedupe, cap=args.cap or None), args.out)
    elif args.stage == "preprocess":
        from recoengine.plans.stages import preprocess_stage, stage_funnel

        write(preprocess_stage(read(args.input), args.min_user, args.min_item), args.out)
        if args.metrics_out:
            write(stage_funnel(read(args.input), args.min_user, args.min_item), args.metrics_out)
    elif args.stage == "sentiment":
        from recoengine.operators.sentiment import score_sentiment

        write(score_sentiment(read(args.input), read(args.lexicon), keys=args.keys.split(",")), args.out)
    elif args.stage == "label":
        from recoengine.plans.stages import label_stage

        write(label_stage(read(args.input)), args.out)
        if args.metrics_out:
            from recoengine.operators.profile import rating_histogram

            write(rating_histogram(read(args.out) if args.in_format == args.out_format else label_stage(read(args.input)), "rating"), args.metrics_out)
    elif args.stage == "enrich":
        from recoengine.operators.enrich import enrich_books

        write(enrich_books(read(args.input), read(args.catalog), args.top or None), args.out)
    elif args.stage == "train":
        from recoengine.operators.cf import fit_model

        model, errors = fit_model(read(args.input))
        model.save(args.model)
        if args.metrics_out:
            write(errors, args.metrics_out)
    elif args.stage == "recommend" and args.model:
        from recoengine.operators.cf import FactorModel, pick_user, recommend, user_history

        model = FactorModel.load(spark, args.model)
        users = read(args.users).select("user_id") if args.users else None
        if args.pick_user or args.history_out:
            named = model.ratings.join(model.users, "user_index").join(model.items, "book_index")
        if args.pick_user:
            users = pick_user(named).select("user_id")
        write(recommend(model, users, args.k, args.n), args.out)
        if args.history_out:
            write(user_history(named, users), args.history_out)
    elif args.stage == "recommend":
        from recoengine.operators.cf import pick_user, prepare_labels, recommend_for_users, user_history

        ratings = prepare_labels(read(args.input))
        ratings = io.cap_rows(ratings, args.cap, ["user_id", "book_title", "label_rating"])
        users = read(args.users).select("user_id") if args.users else None
        if args.pick_user:
            users = pick_user(ratings).select("user_id")
        recs, errors = recommend_for_users(ratings, users, k=args.k, n=args.n)
        write(recs, args.out)
        if args.history_out:
            write(user_history(ratings, users), args.history_out)
        if args.metrics_out:
            write(errors, args.metrics_out)
    elif args.stage == "similar":
        from recoengine.operators import content

        books = read(args.books)
        if "final_description" in books.columns and "description" not in books.columns:
            books = books.withColumnRenamed("final_description", "description")
        from recoengine.session import literal_rows

        queries = literal_rows(spark, [(t,) for t in args.titles], ["query"])
        content.write_recommendations_json(content.similar_items(content.item_texts(books), queries, k=args.k), args.out)


if __name__ == "__main__":
    run(sys.argv[1:])
