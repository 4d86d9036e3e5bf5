"""Command line: build the layers, check them, export reports.

Submit with ``spark-submit`` or run ``python -m tilldeck <command> --help``.
"""

from __future__ import annotations

import argparse

from tilldeck.context import RunContext
from tilldeck.operators import quality, reporting
from tilldeck.operators.behavior import TOP as BEHAVIOR_TOP
from tilldeck.plans import behavior, dashboard, retail
from tilldeck.session import build_session
from tilldeck.sources.files import dataset_profile
from tilldeck.sources.reports import write_markdown, write_payload

RETAIL_STAGES = ("ods", "dwd", "dim", "dws", "ads")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tilldeck")
    parser.add_argument("--master", help="Spark master, if spark-submit does not set it")
    parser.add_argument("--time-zone", default="Asia/Shanghai", help="zone of the calendar day of zoned times")
    parser.add_argument("--shuffle-partitions", type=int)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, dated: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        if dated:
            sub.add_argument("--dt", help="processing day")
            sub.add_argument("--start-date")
            sub.add_argument("--end-date")
        return sub

    sub = command("retail", "build the retail layers")
    sub.add_argument("--input", required=True, help="folder of the nine raw CSV files")
    sub.add_argument("--output", required=True, help="root of the layers")
    sub.add_argument("--stages", default=",".join(RETAIL_STAGES))
    sub.add_argument("--backfill", action="store_true", help="new tables over many days, few files")

    sub = command("behavior", "build the behaviour layers")
    sub.add_argument("--input", help="folder of the six raw Parquet files")
    sub.add_argument("--output", required=True, help="root of the layers")
    sub.add_argument("--tables", default="all")
    sub.add_argument("--sample-fraction", type=float, default=0.0)
    sub.add_argument("--limit-per-table", type=int, default=0)
    sub.add_argument("--output-partitions", type=int)
    sub.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    sub.add_argument("--deduplicate", action="store_true")
    sub.add_argument("--broadcast-products", action="store_true")
    sub.add_argument("--exact", action="store_true", help="exact distinct counts instead of sketches")
    sub.add_argument("--topn", type=int, default=BEHAVIOR_TOP)
    for stage in behavior.STAGES:
        sub.add_argument(f"--skip-{stage}", action="store_true")

    sub = command("quality", "check the written retail layers")
    sub.add_argument("--input", required=True, help="root of the layers")
    sub.add_argument("--output", required=True, help="folder of the Markdown report")

    sub = command("dashboard", "export the metric tables as JSON lines", dated=False)
    sub.add_argument("--input", required=True, help="root of the layers")
    sub.add_argument("--output", required=True)
    sub.add_argument("--topn", type=int, default=reporting.TOP)
    sub.add_argument("--external-root", nargs="*", default=[], help="Parquet files whose profile is added")

    sub = command("profile", "rows, size and columns of Parquet files", dated=False)
    sub.add_argument("--output", required=True)
    sub.add_argument("paths", nargs="+")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("tilldeck", args.master, args.time_zone, args.shuffle_partitions)
    if args.command in ("retail", "behavior", "quality"):
        run = RunContext(args.start_date, args.end_date, args.dt, getattr(args, "backfill", False))
    if args.command == "retail":
        stages = args.stages.split(",")
        if "ods" in stages:
            retail.build_landed(retail.raw_csv_tables(spark, args.input), args.output, run)
        if "dwd" in stages:
            retail.build_facts(spark, args.output, run)
        if "dim" in stages:
            retail.build_dimensions(spark, args.output, run)
        if "dws" in stages:
            retail.build_summaries(spark, args.output, run)
        if "ads" in stages:
            retail.build_metrics(spark, args.output, run)
    elif args.command == "behavior":
        skip = [stage for stage in behavior.STAGES if getattr(args, f"skip_{stage}")]
        raw = None
        if "ods" not in skip:
            raw = behavior.raw_parquet_tables(spark, args.input, args.tables)
        behavior.build_behavior(
            spark,
            raw,
            args.output,
            run,
            skip,
            args.tables,
            args.sample_fraction,
            args.limit_per_table,
            args.mode,
            args.deduplicate,
            args.broadcast_products,
            not args.exact,
            args.topn,
            args.output_partitions,
        )
    elif args.command == "quality":
        checks = retail.layer_quality(spark, args.input, run)
        write_markdown(quality.quality_report(checks), args.output)
    elif args.command == "dashboard":
        sections = dashboard.retail_sections(spark, args.input, args.topn)
        sections |= dashboard.behavior_sections(spark, args.input, args.topn)
        if args.external_root:
            profile = dataset_profile(spark, args.external_root)
            sections["public_dataset"] = reporting.Section(profile, ("file_name",))
        write_payload(reporting.payload(sections), args.output)
    else:
        dataset_profile(spark, args.paths).coalesce(1).write.mode("overwrite").json(args.output)


if __name__ == "__main__":
    main()
