"""Command-line entry points, for ``spark-submit rectext/cli.py <job> ...``.

Jobs run on the session spark-submit provides (``getOrCreate``); paths are
URIs (local, HDFS, ``s3a://``). Each prints one JSON line of counts.

    featurize   <input> <output> [--format csv|table] [--audit <path>]
    import      <folder> <collections> [--insert-ignore]
    line-count  <path>
    load        <collections> <table>
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):   # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rectext.plans import jobs  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rectext")
    sub = p.add_subparsers(dest="job", required=True)
    f = sub.add_parser("featurize", help="JSON files -> features per source file (J1)")
    f.add_argument("input")
    f.add_argument("output")
    f.add_argument("--format", choices=["csv", "table"], default="csv")
    f.add_argument("--audit", help="also write the per-file audit (a second pass) as Parquet here")
    f.add_argument("--ignore-corrupt-files", action="store_true")
    i = sub.add_parser("import", help="*.json files of a folder -> collections (J2)")
    i.add_argument("folder")
    i.add_argument("collections")
    i.add_argument("--insert-ignore", action="store_true", help="keep existing documents (default: reload)")
    c = sub.add_parser("line-count", help="lines of a text file or folder (J3)")
    c.add_argument("path")
    load = sub.add_parser("load", help="collections -> feature table by source file (J4)")
    load.add_argument("collections")
    load.add_argument("table")
    return p


def run(spark: SparkSession, argv: list[str]) -> dict:
    args = _parser().parse_args(argv)
    if args.job == "featurize":
        _, audit, metrics = jobs.featurize_files(spark, args.input, args.output, fmt=args.format,
                                                 ignore_corrupt_files=args.ignore_corrupt_files)
        result = dict(metrics.get)
        if args.audit:
            audit.write.mode("overwrite").parquet(args.audit)
        return result
    if args.job == "import":
        summary = jobs.import_documents(spark, args.folder, args.collections,
                                        drop_existing=not args.insert_ignore)
        return {"files": [r.asDict() for r in summary.collect()]}   # one row per input file
    if args.job == "line-count":
        return {"n_lines": jobs.count_lines(spark, args.path).first()["n_lines"]}
    table = jobs.extract_featurize_load(spark, args.collections, args.table)
    return {"n_rows": table.agg(F.count(F.lit(1))).first()[0]}


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("rectext").getOrCreate()
    print(json.dumps(run(spark, sys.argv[1:] if argv is None else argv), default=str))


if __name__ == "__main__":
    main()
