"""Command line for the two jobs, and for compacting a target of deltas.

    python -m tidewater.jobs stream --source-format kafka \\
        --source-option kafka.bootstrap.servers=host:9092 --source-option subscribe=changes \\
        --target-path s3://bucket/cdc/t --checkpoint s3://bucket/cdc/_ckpt/t [--lookup-path ...]
    python -m tidewater.jobs bulk --export-path s3://bucket/export/1 --table-name t \\
        --keys pk,sk --run-id run-1 --target-path s3://bucket/cdc/t
    python -m tidewater.jobs compact --target-path s3://bucket/cdc/t

The original jobs' parameter names are accepted too (``--S3DynamoDbExportPath``,
``--DynamoDbTableName``, ``--DynamoDbTableKeys``, ``--S3JoinPath``,
``--S3OutputPath``, ``--OutputMode``, ``--TempDir``, ``--JOB_NAME``,
``--JOB_RUN_ID``). The checkpoint of a named
stream is ``<TempDir>/<JOB_NAME>/checkpoint``, so streams can share a TempDir.
"""

from __future__ import annotations

import argparse
import sys

from tidewater.config import BulkConfig, DecodeOptions, LookupConfig, StreamConfig, TargetConfig


OUTPUT_MODES = ("target", "files", "both")
OUTPUT_ALIASES = {"warehouse": "target", "s3": "files"}


def _outputs(args: argparse.Namespace) -> tuple[bool, bool]:
    """Whether the job writes its target and its change log."""
    mode = OUTPUT_ALIASES.get(args.output_mode, args.output_mode)
    log = mode in ("files", "both") or mode is None and args.change_log is not None
    if log and not args.change_log:
        raise ValueError(f"output mode {mode} needs --change-log")
    return mode in ("target", "both") or mode is None and bool(args.target_path or not log), log


def _options(pairs: list[str]) -> dict:
    out = {}
    for pair in pairs or []:
        key, sep, value = pair.partition("=")
        if not sep:
            raise ValueError(f"source option must be key=value: {pair}")
        out[key] = value
    return out


def _common(p: argparse.ArgumentParser) -> None:
    p.add_argument("--target-path")
    p.add_argument("--buckets", type=int, default=64)
    p.add_argument("--order-guard", action="store_true")
    p.add_argument("--layout", default="buckets", choices=("buckets", "deltas"))
    p.add_argument("--compact-ratio", type=float)
    p.add_argument("--change-log", "--S3OutputPath", dest="change_log", help="folder that all decoded changes are added to")
    p.add_argument(
        "--output-mode",
        "--OutputMode",
        dest="output_mode",
        type=str.lower,
        choices=(*OUTPUT_MODES, *OUTPUT_ALIASES),
        help="which outputs to write; by default those that have a path",
    )
    p.add_argument("--lookup-path", "--S3JoinPath", dest="lookup_path")
    p.add_argument("--lookup-follow", help="folder of JSON files to add to the partitioned lookup at --lookup-path")
    p.add_argument("--lookup-parts", type=int, default=256)
    p.add_argument("--lookup-format", default="json", choices=("json", "parquet", "partitioned"))
    p.add_argument("--lookup-multi", default="rows", choices=("rows", "array"))
    p.add_argument("--max-depth", type=int, default=8)
    p.add_argument("--strict-types", action="store_true")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidewater.jobs")
    sub = root.add_subparsers(dest="job", required=True)
    s = sub.add_parser("stream", help="change stream -> latest per key -> upsert")
    s.add_argument("--source-format", required=True)
    s.add_argument("--source-option", action="append", default=[])
    s.add_argument("--source-path")
    s.add_argument("--checkpoint", "--TempDir", dest="checkpoint", required=True)
    s.add_argument("--job-name", "--JOB_NAME", dest="job_name")
    s.add_argument("--trigger", default="100 seconds")
    s.add_argument("--available-now", action="store_true")
    _common(s)
    b = sub.add_parser("bulk", help="table export -> upsert")
    b.add_argument("--export-path", "--S3DynamoDbExportPath", dest="export_path", required=True)
    b.add_argument("--table-name", "--DynamoDbTableName", dest="table_name", required=True)
    b.add_argument("--keys", "--DynamoDbTableKeys", dest="keys", required=True)
    b.add_argument("--run-id", "--JOB_RUN_ID", dest="run_id", required=True)
    _common(b)
    c = sub.add_parser("compact", help="fold a target's deltas into a new base")
    c.add_argument("--with-lookup", action="store_true", help="the target has the lookup columns")
    _common(c)
    return root


def configs(argv: list[str]):
    args = parser().parse_args(argv)
    lookup = (
        LookupConfig(
            path=args.lookup_path,
            format="partitioned" if args.lookup_follow else args.lookup_format,
            multi=args.lookup_multi,
            follow=args.lookup_follow,
            parts=args.lookup_parts,
        )
        if args.lookup_path
        else None
    )
    to_target, to_log = _outputs(args)
    target = to_target and TargetConfig(
        path=args.target_path,
        buckets=args.buckets,
        order_guard=args.order_guard,
        layout="deltas" if args.job == "compact" else args.layout,
        compact_ratio=args.compact_ratio,
        with_lookup=lookup is not None or args.job == "compact" and args.with_lookup,
    )
    if args.job == "compact":
        return args.job, target
    target, change_log = target or None, args.change_log if to_log else None
    lookup = lookup if target else None
    decode = DecodeOptions(max_depth=args.max_depth, strict_types=args.strict_types)
    if args.job == "stream":
        checkpoint = args.checkpoint.rstrip("/")
        if args.job_name:
            checkpoint = f"{checkpoint}/{args.job_name}/checkpoint"
        return args.job, StreamConfig(
            source_format=args.source_format,
            source_options=_options(args.source_option),
            source_path=args.source_path,
            target=target,
            checkpoint_location=checkpoint if checkpoint.endswith("checkpoint") else f"{checkpoint}/checkpoint",
            trigger_interval=None if args.available_now else args.trigger,
            available_now=args.available_now,
            query_name=args.job_name,
            lookup=lookup,
            decode=decode,
            change_log=change_log,
        )
    return args.job, BulkConfig(
        export_path=args.export_path,
        table_name=args.table_name,
        key_names=args.keys,
        target=target,
        run_id=args.run_id,
        lookup=lookup,
        decode=decode,
        change_log=change_log,
    )


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    from tidewater.operators.deltas import compact
    from tidewater.plans.bulk import run_bulk
    from tidewater.streaming.job import run_stream

    job, cfg = configs(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"tidewater-{job}").getOrCreate()
    if job == "compact":
        compact(spark, cfg)
    elif job == "stream":
        run_stream(spark, cfg).awaitTermination()
    else:
        run_bulk(spark, cfg)


if __name__ == "__main__":
    main()
