"""Command-line jobs, for ``spark-submit`` or ``python -m ratewise``.

    ratewise ingest   --users U --ratings R --items I --store ROOT [--buckets N]
    ratewise ratings-report   --store ROOT [--top 10] [--min-count 0]
    ratewise favourite-genre  --store ROOT [--min-ratings 50]
    ratewise user-filters     --store ROOT [--max-age 20] [--occupation scientist]
                              [--min-age 30] [--age-limit 40]
    ratewise profile  --users U --ratings R --items I
    ratewise preview  --path P [-n 5]
    ratewise sample   --store ROOT --table T [-n 5]
    ratewise rejects  --path P --kind users|ratings|movies [--by-file]
    ratewise user-ratings --store ROOT --user U [--first-movie M] [--last-movie M]
    ratewise vacuum   --store ROOT [--keep 1] [--idle-seconds 86400]
    ratewise ddl      --store ROOT [--table-format parquet] [--table-prefix P]

The session comes from ``SparkSession.builder.getOrCreate()``, so the master
and every setting are whatever ``spark-submit`` (or the environment) gives.
Each job prints its whole report (one row per table or metric), ``preview`` and
``sample`` exactly the rows asked for; ``rejects`` prints the number of lines that
lenient parsing rejects and writes them to ``--out`` if given.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .operators import clean_movies, clean_ratings, clean_users, record_counts
from .plans.jobs import (
    Store,
    favourite_genre_report,
    ingest_clean_store,
    profile_raw,
    ratings_report,
    user_filter_report,
)
from .sinks import result_tables_ddl, vacuum
from .sources import (
    parse_item_wide,
    parse_pipe_users,
    parse_ws_ratings,
    rejected_lines,
    scan_text_lines,
    select_all_limit,
    write_text_lines,
)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ratewise", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="job", required=True)

    def raw(sp: argparse.ArgumentParser) -> None:
        sp.add_argument("--users", required=True)
        sp.add_argument("--ratings", required=True)
        sp.add_argument("--items", required=True)
        sp.add_argument("--genres", default=",".join(schemas.DEFAULT_GENRES),
                        help="category vocabulary, in flag order, comma-separated")
        sp.add_argument("--lenient", action="store_true",
                        help="reject unreadable lines instead of failing")

    def store(sp: argparse.ArgumentParser) -> None:
        sp.add_argument("--store", required=True)
        sp.add_argument("--table-format", default="parquet")
        sp.add_argument("--document-format", default="json")
        sp.add_argument("--table-prefix", default=None,
                        help="read tables registered in the catalog under this prefix")

    ing = sub.add_parser("ingest", help="parse, clean and store users, ratings, movies")
    raw(ing)
    store(ing)
    ing.add_argument("--buckets", type=int, default=0,
                     help="store ratings bucketed by user into N buckets")

    rr = sub.add_parser("ratings-report", help="Tasks 1 and 2")
    store(rr)
    rr.add_argument("--top", type=int, default=10)
    rr.add_argument("--min-count", type=int, default=0)

    fg = sub.add_parser("favourite-genre", help="Task 3")
    store(fg)
    fg.add_argument("--min-ratings", type=int, default=50)

    uf = sub.add_parser("user-filters", help="Tasks 4 and 5")
    store(uf)
    uf.add_argument("--max-age", type=int, default=20)
    uf.add_argument("--occupation", default="scientist")
    uf.add_argument("--min-age", type=int, default=30)
    uf.add_argument("--age-limit", type=int, default=40)

    pr = sub.add_parser("profile", help="missing values and duplicates of the raw files")
    raw(pr)

    dd = sub.add_parser("ddl", help="print the DDL of the base and result tables")
    dd.add_argument("--store", required=True)
    dd.add_argument("--table-format", default="parquet")
    dd.add_argument("--table-prefix", default="")

    pv = sub.add_parser("preview", help="first lines of a text file")
    pv.add_argument("--path", required=True)
    pv.add_argument("-n", type=int, default=5)

    sm = sub.add_parser("sample", help="first rows of a stored table, by its key")
    store(sm)
    sm.add_argument("--table", required=True, choices=[*schemas.TABLES, "movies"])
    sm.add_argument("-n", type=int, default=5)

    rj = sub.add_parser("rejects", help="lines that lenient parsing rejects")
    rj.add_argument("--path", required=True)
    rj.add_argument("--kind", required=True, choices=["users", "ratings", "movies"])
    rj.add_argument("--genres", default=",".join(schemas.DEFAULT_GENRES))
    rj.add_argument("--out", default=None, help="folder to write the raw lines to")
    rj.add_argument("--by-file", action="store_true", help="count the rejects of every file")

    ur = sub.add_parser("user-ratings", help="one user's stored ratings, by key")
    store(ur)
    ur.add_argument("--user", type=int, required=True)
    ur.add_argument("--first-movie", type=int, default=None)
    ur.add_argument("--last-movie", type=int, default=None)

    vc = sub.add_parser("vacuum", help="remove files that no recent commit names")
    vc.add_argument("--store", required=True)
    vc.add_argument("--keep", type=int, default=1, help="commits to keep")
    vc.add_argument("--idle-seconds", type=float, default=86_400,
                    help="leave alone what is younger (writes under way, readers)")
    return p


def _store(args: argparse.Namespace) -> Store:
    return Store(args.store, args.table_format, args.document_format, args.table_prefix)


def run(argv: Sequence[str], spark: SparkSession | None = None) -> DataFrame:
    """Run one job; returns its report DataFrame (already computed jobs have
    written their tables)."""
    args = _parser().parse_args(list(argv))
    spark = spark or SparkSession.builder.appName(f"ratewise-{args.job}").getOrCreate()
    if args.job == "ingest":
        return ingest_clean_store(spark, args.users, args.ratings, args.items, _store(args),
                                  tuple(args.genres.split(",")), args.lenient,
                                  args.buckets or None)
    if args.job == "ratings-report":
        return ratings_report(spark, _store(args), args.top, args.min_count)
    if args.job == "favourite-genre":
        return favourite_genre_report(spark, _store(args), args.min_ratings)
    if args.job == "user-filters":
        return user_filter_report(spark, _store(args), args.max_age, args.occupation,
                                  args.min_age, args.age_limit)
    if args.job == "profile":
        vocab = tuple(args.genres.split(","))
        users = parse_pipe_users(scan_text_lines(spark, args.users), lenient=args.lenient)
        ratings = parse_ws_ratings(scan_text_lines(spark, args.ratings), lenient=args.lenient)
        movies = parse_item_wide(scan_text_lines(spark, args.items), vocab, lenient=args.lenient)
        return profile_raw({"users": users, "ratings": ratings, "movies": movies,
                            "users_clean": clean_users(users),
                            "ratings_clean": clean_ratings(ratings),
                            "movies_clean": clean_movies(movies)})
    if args.job == "preview":
        return select_all_limit(scan_text_lines(spark, args.path), args.n)
    if args.job == "sample":
        store = _store(args)
        table = store.read_movies(spark) if args.table == "movies" else store.read(spark, args.table)
        return select_all_limit(table, args.n, schemas.KEYS.get(args.table))
    if args.job == "rejects":
        bad = rejected_lines(scan_text_lines(spark, args.path, origin=True), args.kind,
                             vocabulary=tuple(args.genres.split(",")))
        if args.by_file:
            return bad.groupBy("file").count().withColumnRenamed("count", "row_count").orderBy("file")
        if args.out:
            write_text_lines(bad, args.out)
            bad = scan_text_lines(spark, args.out)
        return record_counts({f"rejected_{args.kind}": bad})
    if args.job == "user-ratings":
        return _store(args).ratings_of_user(spark, args.user, args.first_movie, args.last_movie)
    if args.job == "vacuum":
        gone = vacuum(spark, args.store.rstrip("/"), args.keep, args.idle_seconds)
        return spark.createDataFrame([(g,) for g in gone], "removed string")
    raise SystemExit(f"unknown job {args.job}")


def main(argv: Sequence[str] | None = None) -> None:
    import sys
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv[:1] == ["ddl"]:  # plain text, no session needed
        args = _parser().parse_args(argv)
        print(result_tables_ddl(args.store, fmt=args.table_format, prefix=args.table_prefix))
        return
    report = run(argv)
    print("\t".join(report.columns))
    for row in report.toLocalIterator():  # all rows, a partition at a time
        print("\t".join("" if v is None else str(v) for v in row))
