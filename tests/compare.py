"""Run queries and their SQL side by side: ``python tests/compare.py [sf] [names...]``."""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

TESTDATA = pathlib.Path("/root/testdata")


KINDS = {"bigint": "int64", "double": "double", "string": "string", "boolean": "bool", "int": "int32"}


def connect(sf_dir: pathlib.Path) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(sf_dir.glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def normal(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if pd.isna(v) else float(v) if isinstance(v, (int, float)) else v
    rows = [tuple(plain(v) for v in row) for row in frame.astype(object).itertuples(index=False)]
    return list(frame.columns), sorted(rows, key=repr)


def difference(spark, db, name: str, sf_dir) -> str | None:
    """None if the rows are equal, else a short text."""
    mine, other = contract.queries()[name](spark, str(sf_dir)), db.sql(contract.oracle_sql()[name]).to_arrow_table()
    types = {f.name: KINDS.get(f.dataType.simpleString()) for f in mine.schema}
    wanted = {f.name: str(f.type) for f in other.schema}
    if types != wanted:
        return f"types {types} / {wanted}"
    ours, theirs = normal(mine.toPandas()), normal(other.to_pandas())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(bad)} of {len(ours[1])} rows differ: {bad[:2]}" if bad else None


if __name__ == "__main__":
    from conftest import local_session

    sf_dir = TESTDATA / f"sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(contract.queries())
    session, db = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(session, db, name, sf_dir)
        except Exception as error:  # report all of them
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
