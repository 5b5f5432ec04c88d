"""A small SQL shell: python -m tallystone [--root FOLDER] [--data FOLDER] [-e STATEMENT]."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .errors import EngineError
from .session import EngineConfig, Session
from .tables import open_folder


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tallystone")
    p.add_argument("--root", help="folder of stored tables")
    p.add_argument("--data", help="folder of Parquet tables to register")
    p.add_argument("-e", dest="statement", action="append", help="run this statement and end")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tallystone").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    session = Session(spark, a.root, EngineConfig(enable_inserts=True))
    if a.data:
        open_folder(session, a.data)

    def run(statement: str) -> bool:
        if statement.strip().lower() == "!tables":
            print("\n".join(f"{n}  {k}" for n, k, _ in session.tables()))
            return True
        try:
            out = session.sql(statement)
            if out is not None:
                out.show(100, truncate=False)
        except EngineError as e:
            print(f"error: {e}", file=sys.stderr)
            return False
        return True

    if a.statement:
        return int(not all([run(s) for s in a.statement]))
    held = ""
    while True:
        try:
            line = input("> " if not held else ". ")
        except EOFError:
            return 0
        if not held and line.strip().lower() in ("!quit", "quit", "exit"):
            return 0
        held += line + "\n"
        if line.strip().startswith("!") or line.rstrip().endswith(";"):
            run(held.strip().rstrip(";"))
            held = ""


if __name__ == "__main__":
    sys.exit(main())
