"""Command line: python -m tidemark.cli COMMAND ..."""

from __future__ import annotations

import argparse
import datetime
import logging
from pathlib import Path

from tidemark.plans import pipelines
from tidemark.session import get_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    put = commands.add_parser("upload", help="copy a file into the landing area")
    put.add_argument("file", type=Path)
    put.add_argument("prefix")
    for name, text in (("ingest-files", "append new and changed files of a source"), ("ingest-api", "append the payload of a window"), ("build-reference", "rebuild a reference table")):
        commands.add_parser(name, help=text).add_argument("source")
    commands.add_parser("build-gold", help="run the models")
    for name in ("ingest-api", "build-gold"):
        commands.choices[name].add_argument("--as-of", type=datetime.date.fromisoformat, default=datetime.datetime.now(datetime.UTC).date())
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    settings, now = pipelines.Settings.load(), datetime.datetime.now(datetime.UTC)
    spark = get_session(**settings.store_conf())
    if args.command == "upload":
        print(pipelines.upload(spark, args.file, args.prefix, settings))
    elif args.command == "build-gold":
        for name, rows in pipelines.build_gold(spark, settings, args.as_of).items():
            print(f"gold.{name}: {rows} rows")
    else:
        source = pipelines.declared(Path(settings.sources).read_text())[args.source]
        steps = {"ingest-files": lambda: pipelines.ingest_files(spark, source, settings, now), "ingest-api": lambda: pipelines.ingest_api(spark, source, settings, args.as_of, now), "build-reference": lambda: pipelines.build_reference(spark, source, settings)}
        print(f"{source.name}: {steps[args.command]()}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
