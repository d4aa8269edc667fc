"""Jobs to submit: land day files, rebuild the models, run the data tests, read the digest.

    python -m trendloom.jobs land --kind posts --files raw/posts --table tables/posts --start 2025-05-31
    python -m trendloom.jobs stream --kind posts --files raw/posts --table tables/streamed --progress progress/posts
    python -m trendloom.jobs rebuild --posts tables/posts --comments tables/comments --models models
    python -m trendloom.jobs digest --models models

The salt of the pseudonyms is read from ``TRENDLOOM_SALT``, so that it is in no command line.
"""

from __future__ import annotations

import argparse
import os
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.plans import rebuild, serving
from trendloom.session import configure
from trendloom.sources.captures import scan_captured
from trendloom.sources.landing import land_comments, land_posts
from trendloom.sources.raw_files import scan_raw
from trendloom.sources.tables import append_raw, read_versions
from trendloom.sources.terms import read_terms, shipped_terms, term_list
from trendloom.streaming.day_files import stream_captures, stream_day_files

LANDERS = {"posts": land_posts, "comments": land_comments}


class FailedTestsError(RuntimeError):
    """Data tests of severity error found violations."""


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    """Append every day file, one day, or a range of days to a raw table."""
    scan = scan_captured if args.captured else scan_raw
    append_raw(LANDERS[args.kind](scan(spark, args.files, args.start, args.end)), args.table)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Append the day files that arrived since the last run, or were captured again."""
    start = stream_captures if args.captured else stream_day_files
    start(spark, args.files, args.table, args.progress, LANDERS[args.kind]).awaitTermination()


def rebuild_models(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Gate on freshness, rebuild all models, run all data tests, publish the build if they pass."""
    terms = term_list(read_terms(spark, args.terms)) if args.terms else shipped_terms()
    build = rebuild.new_build()
    folder = rebuild.build_folder(args.models, build)
    row_counts: dict[str, dict[str, int]] = {}
    models = rebuild.rebuild(
        spark,
        read_versions(spark, *args.posts),
        read_versions(spark, *args.comments),
        terms,
        folder,
        os.environ["TRENDLOOM_SALT"],
        args.now,
        args.window_months,
        args.matched,
        row_counts,
    )
    report = rebuild.tested(models, folder, row_counts, window_months=args.window_months)
    rows = report.collect()  # one row per test
    failed = sorted(r.test for r in rows if r.status == "error")
    if failed:
        raise FailedTestsError("; ".join(failed))
    rebuild.publish(spark, args.models, build)
    return spark.createDataFrame(rows, report.schema)


def digest(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """What the weekly digest tells."""
    models = rebuild.open_models(spark, args.models)
    return [
        serving.window_labels(models["dim_comparison_windows"]),
        serving.headline(models["mart_ai_share_change"]),
        serving.latest_two_months(models["mart_ai_share_by_month"], args.now[:10]),
        serving.digest_movers(models["mart_tool_share_change"]),
    ]


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    now = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")

    for name in ("land", "stream"):
        job = jobs.add_parser(name)
        job.add_argument("--kind", choices=LANDERS, default="posts")
        job.add_argument("--files", required=True, help="folder of day files")
        job.add_argument("--table", required=True)
        job.add_argument("--captured", action="store_true", help="keep objects byte for byte, in bounded memory; a stream lands a replaced file again")
        if name == "land":
            job.add_argument("--start", help="first day to land; all files without it")
            job.add_argument("--end", help="last day to land; only the first without it")
        else:
            job.add_argument("--progress", required=True, help="checkpoint folder of the stream")

    job = jobs.add_parser("rebuild")
    job.add_argument("--posts", nargs="+", required=True, help="raw tables")
    job.add_argument("--comments", nargs="+", required=True, help="raw tables")
    job.add_argument("--models", required=True, help="folder for the models")
    job.add_argument("--matched", help="folder that keeps matched versions, so that only new loads are matched")
    job.add_argument("--terms", help="dictionary CSV; the shipped one if omitted")
    job.add_argument("--window-months", type=int, default=fv.WINDOW_MONTHS)
    job.add_argument("--now", default=now, help="UTC time the freshness is measured at")

    job = jobs.add_parser("digest")
    job.add_argument("--models", required=True)
    job.add_argument("--now", default=now)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    args = parse(arguments)
    spark = configure(SparkSession.builder.appName(f"trendloom {args.job}").getOrCreate())
    if args.job == "land":
        land(spark, args)
    elif args.job == "stream":
        stream(spark, args)
    elif args.job == "rebuild":
        rebuild_models(spark, args).orderBy(F.col("status") == "pass", "test").show(100, truncate=False)
    else:
        for part in digest(spark, args):
            for row in serving.json_rows(part).collect():
                print(row.row)


if __name__ == "__main__":
    main()
