"""Command line: ``python -m starloom <export_base> <raw_root> [options]``.

Runs ingest, bronze, silver and gold on the session spark-submit provides
(or a local one) and prints a JSON summary.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from starloom.plans.medallion import run_all
from starloom.session import build_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="starloom")
    ap.add_argument("export_base", help="folder holding <Folder>/<Folder>.manifest.cdm.json")
    ap.add_argument("raw_root", help="where raw tables are written")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--catalog", default=None)
    ap.add_argument("--no-header", action="store_true")
    ap.add_argument("--calendar-start", type=dt.date.fromisoformat, default=None, help="first day of dimdate, yyyy-mm-dd")
    ap.add_argument("--calendar-end", type=dt.date.fromisoformat, default=None, help="last day of dimdate")
    ap.add_argument("--allow-schema-change", action="store_true", help="let tables take on a changed schema")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    a = ap.parse_args(argv)
    spark = build_session(a.master, app="starloom")
    out = run_all(spark, a.export_base, a.raw_root, fmt=a.format, catalog=a.catalog,
                  header=not a.no_header, calendar_start=a.calendar_start, calendar_end=a.calendar_end,
                  allow_schema_change=a.allow_schema_change)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
