"""Command line: ``python -m skyledger.jobs.cli <job> [options]``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import curate, quality, sampling
from skyledger.operators.analytics import table_summary
from skyledger.operators.cleaning import clean_flights, clean_flights_dedup
from skyledger.operators.dimensions import DIMENSIONS
from skyledger.plans import history, ledger, report, star_schema
from skyledger.schemas import RAW_FLIGHTS
from skyledger.session import build_session
from skyledger.sinks import files as sinks
from skyledger.sources import files as sources
from skyledger.sources import messages
from skyledger.streaming import parse
from skyledger.streaming import sinks as stream_sinks

log = logging.getLogger(__name__)


def _names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def convert(spark: SparkSession, args: argparse.Namespace) -> None:
    sinks.convert_csv(spark, args.input, args.output, RAW_FLIGHTS if args.types == "flights" else None,
                      infer=args.types == "infer", partition_by=args.partition_by, files=args.files,
                      dry_run=args.dry_run, header=args.header)


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.ledger:
        found = (f"{args.input.rstrip('/')}/*.csv" if args.start_year is None else sources.monthly_pattern(
            args.input, args.start_year, args.end_year or args.start_year, args.start_month,
            args.end_month))
        run = ledger.load_batches(spark, found, args.output, args.ledger, args.batch_files)
        run.groupBy("outcome").agg(F.count("*").alias("files"), F.sum("output_rows").alias("rows"),
                                   F.sum("bad_rows").alias("bad_rows")).show(truncate=False)
        return
    if args.start_year is None:
        result = history.load_all(spark, args.input, args.output, args.mode)
    else:
        result = history.load_years(spark, args.input, args.output, args.start_year,
                                    args.end_year or args.start_year, args.start_month,
                                    args.end_month, args.mode)
    history.load_totals(result).show(truncate=False)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = spark.read.parquet(args.input)
    cleaned = clean_flights_dedup(raw) if args.dedup else clean_flights(raw)
    if args.dry_run:
        log.info("quality: %s", quality.data_quality_report(cleaned))
        return
    counted, seen = quality.counted(cleaned, "cleaned")
    if args.partition_by:
        sinks.write_partitioned(counted, args.output, args.partition_by)
    else:
        sinks.write_parquet(counted, args.output, files=args.files)
    log.info("%d rows written to %s", seen.get["rows"], args.output)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.output:
        sinks.compact_parquet(spark, args.input, args.output, args.files)
    else:
        sinks.compact_in_place(spark, args.input, args.files)


def dims(spark: SparkSession, args: argparse.Namespace) -> None:
    star_schema.write_dims(spark.read.parquet(args.input), args.output, args.dims)


def fact(spark: SparkSession, args: argparse.Namespace) -> None:
    star_schema.write_fact(spark.read.parquet(args.input), args.dims_folder, args.output,
                           args.build, args.files)


def bi(spark: SparkSession, args: argparse.Namespace) -> None:
    sinks.write_parquet(curate.bi_flights(spark.read.parquet(args.input)), args.output)


def mart(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = curate.daily_mart(spark.read.parquet(args.input))
    sinks.write_layout(rows, "flights_analytics", args.output)


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    log.info("%s", report.write_report(spark.read.parquet(args.input), args.output))


def _sampled(flights: DataFrame, args: argparse.Namespace) -> DataFrame:
    if args.type == "routes":
        return sampling.specific_routes(flights, args.origins, args.destinations, args.rows)
    if args.type == "airlines":
        return sampling.airlines_sample(flights, args.airlines, args.rows, args.seed)
    if args.type == "recent":
        return sampling.recent_data(flights, args.days, args.rows)
    if args.year is None:
        return sampling.table_sample(flights, rows=args.rows, seed=args.seed)
    return sampling.random_sample(flights, args.rows, args.year, args.seed)


def sample(spark: SparkSession, args: argparse.Namespace) -> None:
    flights = spark.read.parquet(args.input)
    table_summary(flights).show(vertical=True)
    # Stored first: the exports, figures and preview below all show the same drawn rows.
    drawn = f"{args.output}/sample.parquet"
    sinks.export_parquet(_sampled(flights, args), drawn)
    stored = sources.read_parquet(spark, drawn)
    for name in args.format:
        if name != "parquet":
            sinks.EXPORTS[name](stored, f"{args.output}/sample.{name}")
    sampling.sample_stats(stored).show(vertical=True)
    quality.preview(stored).show(vertical=True)


def summary(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = dict(pair.split("=", 1) for pair in args.tables)
    sinks.table_inventory(spark, tables).show(truncate=False)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    incoming = messages.topic_stream(spark, args.servers, args.topic)
    out, log_dir = args.output.rstrip("/"), args.checkpoint.rstrip("/")
    if args.variant == "wide":
        rows = parse.parse_wide_messages(incoming)
        write = stream_sinks.replayable_batch_writer(f"{out}/wide")
        stream_sinks.batch_sink(rows, write, f"{log_dir}/wide").start().awaitTermination()
    elif args.variant == "text":
        text = messages.decode_text(incoming)
        stream_sinks.console_sink(text, f"{log_dir}/text").start().awaitTermination()
    else:
        stream_sinks.start_dual_sink(parse.flight_stream(incoming), f"{out}/files",
                                     f"{log_dir}/files", f"{out}/copy", f"{log_dir}/copy",
                                     args.trigger)
        spark.streams.awaitAnyTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyledger")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *paths):
        command = jobs.add_parser(name)
        command.set_defaults(run=run)
        for path in paths:
            command.add_argument(f"--{path}", required=True)
        return command

    command = job("convert", convert, "input", "output")
    # Types are inferred by default; the flights' own need no pass over the files to find them.
    command.add_argument("--types", choices=("infer", "flights", "text"), default="infer")
    command.add_argument("--infer-schema", action="store_const", const="infer", dest="types")
    command.add_argument("--header", action=argparse.BooleanOptionalAction, default=True)
    command.add_argument("--partition-by", type=_names)
    command.add_argument("--files", type=int)
    command.add_argument("--dry-run", action="store_true")

    command = job("load", load, "input", "output")
    command.add_argument("--ledger")
    command.add_argument("--batch-files", type=int, default=ledger.BATCH_FILES)
    command.add_argument("--mode", choices=["append", "overwrite", "replace_months"],
                         default="replace_months")
    for bound in ("start-year", "end-year", "start-month", "end-month"):
        command.add_argument(f"--{bound}", type=int)

    command = job("clean", clean, "input", "output")
    command.add_argument("--dedup", action="store_true")
    command.add_argument("--partition-by", type=_names)
    command.add_argument("--files", type=int)
    command.add_argument("--dry-run", action="store_true")

    command = job("compact", compact, "input")
    command.add_argument("--output", help="without it the directory is compacted in place")
    command.add_argument("--files", type=int)

    command = job("dims", dims, "input", "output")
    command.add_argument("--dims", nargs="+", choices=[*DIMENSIONS, "all"], default=["all"])

    command = job("fact", fact, "input", "output", "dims-folder")
    command.add_argument("--build", choices=list(star_schema.FACT_BUILDS), default="default")
    command.add_argument("--files", type=int)

    job("bi", bi, "input", "output")
    job("mart", mart, "input", "output")
    job("report", run_report, "input", "output")

    command = job("sample", sample, "input", "output")
    command.add_argument("--type", choices=["random", "recent", "routes", "airlines"],
                         default="random")
    command.add_argument("--rows", type=int, default=sampling.SAMPLE_ROWS)
    command.add_argument("--year", type=int)
    command.add_argument("--days", type=int, default=sampling.RECENT_DAYS)
    command.add_argument("--seed", type=int)
    for listed in ("origins", "destinations", "airlines"):
        command.add_argument(f"--{listed}", type=_names, default=[])
    command.add_argument("--format", nargs="+", choices=list(sinks.EXPORTS), default=["csv"])

    command = job("summary", summary)
    command.add_argument("tables", nargs="+", help="name=path")

    command = job("stream", stream, "servers", "topic", "output", "checkpoint")
    command.add_argument("--variant", choices=["flat", "wide", "text"], default="flat")
    command.add_argument("--trigger", default=stream_sinks.TRIGGER)
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(arguments)
    args.run(spark or build_session(f"skyledger {args.job}"), args)


if __name__ == "__main__":
    main()
