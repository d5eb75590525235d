"""python -m playmart build|create: the jobs from the command line."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from playmart.operators import versions
from playmart.operators.layout import create_tables
from playmart.plans import warehouse
from playmart.schemas import ALL_TABLES


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="playmart")
    commands = parser.add_subparsers(dest="command", required=True)
    create = commands.add_parser("create", help="create the tables that do not exist yet")
    build = commands.add_parser("build", help="load the JSON objects and build all tables")
    for command in (create, build):
        command.add_argument("--out", required=True, help="folder of the tables")
    build.add_argument("--events", required=True, help="prefix of the play-log objects")
    build.add_argument("--songs", required=True, help="prefix of the song objects")
    build.add_argument("--on-error", choices=("fail", "skip"), default="fail")
    build.add_argument("--working", action="store_true", help="also keep the artist steps")
    build.add_argument("--dense-keys", action="store_true", help="number plays without gaps")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("playmart").getOrCreate()
    if chosen.command == "create":
        create_tables(spark, versions.current(spark, chosen.out), list(ALL_TABLES.values()))
    else:
        sources = warehouse.Sources(chosen.events, chosen.songs, on_error=chosen.on_error)
        warehouse.build(spark, sources, chosen.out, chosen.working, chosen.dense_keys)


if __name__ == "__main__":
    main()
