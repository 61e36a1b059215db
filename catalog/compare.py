"""Run queries beside their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from catalog.registry import ORACLES, QUERIES


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(names: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(_cell(r[i]) for i in order)) for r in rows)


def oracle_rows(name: str, sf_dir: str) -> tuple[list[str], list[str]]:
    with duckdb.connect() as con:
        for path in glob.glob(f"{sf_dir}/*.parquet"):
            view = os.path.basename(path).removesuffix(".parquet")
            con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
        found = con.execute(ORACLES[name])
        names = [c[0] for c in found.description]
        return sorted(names), _rows(names, found.fetchall())


def spark_rows(spark, name: str, sf_dir: str) -> tuple[list[str], list[str]]:
    df = QUERIES[name](spark, sf_dir)
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def differences(spark, name: str, sf_dir: str) -> str | None:
    """Why a query and its SQL disagree, or None."""
    ours, theirs = spark_rows(spark, name, sf_dir), oracle_rows(name, sf_dir)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}"
    if ours[1] == theirs[1]:
        return None
    a, b = set(ours[1]), set(theirs[1])
    return f"{len(ours[1])} and {len(theirs[1])} rows; only ours {list(a - b)[:2]}; only SQL {list(b - a)[:2]}"


def main(names: list[str], sf_dir: str) -> int:
    from gradeloom.session import local_session
    import catalog.all  # noqa: F401

    spark, failed = local_session(), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            if name in ORACLES:
                problem = differences(spark, name, sf_dir)
                note = "ok" if problem is None else problem
            else:
                note = f"rows only: {len(spark_rows(spark, name, sf_dir)[1])}"
        except Exception as error:  # report and go on with the next query
            note = f"{type(error).__name__}: {str(error)[:600]}"
        bad = note != "ok" and not note.startswith("rows only")
        failed += bad
        print(f"{'FAIL' if bad else '    '} {name:28} {time.time() - start:6.1f}s {note[:1500]}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[2:], sys.argv[1]))
