"""Run a job and write its result as parquet.

    python -m carebook list
    python -m carebook run JOB INPUT_DIR OUTPUT_PATH [--set NAME=VALUE ...]
    python -m carebook stream TRANSFORM INPUT_DIR OUTPUT_PATH CHECKPOINT_PATH
        [--trigger "1 minute" | --available-now] [--max-files N | --max-bytes N]

``stream`` appends a Structured Streaming query's output to parquet; restart
it with the same checkpoint to resume where it stopped.

The session comes from the environment (``spark-submit`` or
``spark-defaults.conf``), so the same command runs locally and on a cluster.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from carebook.registry import JOBS


def parameters(job: str, values: list[str]) -> dict:
    """``NAME=VALUE`` pairs as arguments of ``job``, read as the type of the parameter's default."""
    known = dict(list(inspect.signature(JOBS[job]).parameters.items())[2:])
    out = {}
    for pair in values:
        name, _, text = pair.partition("=")
        if name not in known:
            raise SystemExit(f"{job} has no parameter {name!r}; it has: {', '.join(known) or 'none'}")
        default = known[name].default
        kind = type(default)
        out[name] = text if default is None else kind.fromisoformat(text) if hasattr(kind, "fromisoformat") else kind(text)
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="carebook")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the jobs")
    run = sub.add_parser("run", help="run a job and write its result")
    run.add_argument("job", choices=sorted(JOBS))
    run.add_argument("input_dir", help="folder holding events.parquet, customer.parquet, ...")
    run.add_argument("output_path", help="new parquet output path (must not exist)")
    run.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", dest="values",
                     help="a parameter of the job: a date or time in ISO form, a number or a text")
    from carebook.streaming.jobs import TRANSFORMS, start_enrich
    stream = sub.add_parser("stream", help="run a streaming transformation into parquet")
    stream.add_argument("transform", choices=sorted([*TRANSFORMS, "enrich"]))
    stream.add_argument("input_dir", help="folder holding events.parquet (a file or a folder of arriving files)")
    stream.add_argument("output_path")
    stream.add_argument("checkpoint_path")
    stream.add_argument("--trigger", default="1 minute", help="processing-time trigger interval")
    stream.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    stream.add_argument("--max-files", type=int, default=None, help="files per micro-batch")
    stream.add_argument("--max-bytes", type=int, default=None,
                        help="bytes per micro-batch; files that arrive out of time order can then come late")
    args = parser.parse_args(argv)

    if args.cmd == "list":
        for name, job in JOBS.items():
            doc = (job.__doc__ or "").strip().splitlines()
            print(f"{name:28s} {doc[0] if doc else ''}")
        return 0

    from pyspark.sql import SparkSession
    name = args.job if args.cmd == "run" else args.transform
    spark = SparkSession.builder.appName(f"carebook-{name}").getOrCreate()
    if args.cmd == "run":
        JOBS[args.job](spark, args.input_dir, **parameters(args.job, args.values)).write.mode("errorifexists").parquet(args.output_path)
        return 0

    from carebook.streaming.sink import start_to_parquet
    from carebook.streaming.source import read_entries_table_stream
    entries = read_entries_table_stream(spark, args.input_dir, max_files_per_trigger=args.max_files,
                                        max_bytes_per_trigger=args.max_bytes)
    how = {"processing_time": args.trigger, "available_now": args.available_now, "query_name": f"carebook_{args.transform}"}
    if args.transform == "enrich":
        q = start_enrich(spark, args.input_dir, entries, args.output_path, args.checkpoint_path, **how)
    else:
        out = TRANSFORMS[args.transform](spark, args.input_dir, entries)
        q = start_to_parquet(out, args.output_path, args.checkpoint_path, **how)
    q.awaitTermination()
    return 0 if q.exception() is None else 1


if __name__ == "__main__":
    sys.exit(main())
