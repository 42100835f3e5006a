"""Compare every registered query with its DuckDB counterpart: ``python -m checks.verify [sf] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.oracle import oracle_sql  # noqa: E402
from checks.registry import queries  # noqa: E402
from fleetmeter.session import build_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        return "nan" if isinstance(x, float) and math.isnan(x) else x

    picked = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty when equal, else what differs. Values must be identical, doubles included."""
    df = queries()[name](spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    types = {d[0]: str(d[1]).split("(")[0].lower() for d in result.description}
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    a, b = _rows(df.columns, ours), _rows(columns, theirs)
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    if differing:
        return f"{len(differing)} of {len(a)} rows differ, first {differing[0]}; columns {sorted(columns)}"
    expected = {"bigint": "bigint", "int": "integer", "double": "double", "boolean": "boolean", "string": "varchar",
                "date": "date", "timestamp_ntz": "timestamp"}
    wrong = {c: (t, types[c]) for c, t in df.dtypes if expected.get(t, t) != types[c]}
    return f"types {wrong}" if wrong else ""


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    missing = set(queries()) ^ set(oracle_sql())
    if missing:
        print("unpaired:", sorted(missing))
    for name in wanted or queries():
        started = time.time()
        try:
            verdict = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(verdict)
        print(f"{'ok  ' if not verdict else 'FAIL'} {name} {time.time() - started:.1f}s {verdict}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
