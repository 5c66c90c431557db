"""Run registered queries and their SQL side by side: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as registry  # noqa: E402

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(table: pa.Table) -> tuple[list[str], list[tuple]]:
    """Column names in order, and the rows as sorted text."""
    names = sorted(table.column_names)
    columns = [[_text(v) for v in table.column(name).to_pylist()] for name in names]
    return names, sorted(zip(*columns, strict=True))


def _text(value) -> str:
    return "NULL" if value is None or value != value else repr(value)


def compare(spark, con, name: str, folder: str) -> str:
    """Empty if both sides agree."""
    got_names, got = canonical(registry.queries()[name](spark, folder).toArrow())
    want_names, want = canonical(con.execute(registry.oracle_sql()[name]).to_arrow_table())
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    different = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(different)} rows differ, first\n{different[0][0]}\n{different[0][1]}" if different else ""


def main() -> None:
    from loanlens.session import local_session

    sf, *names = sys.argv[1:] or ["0.01"]
    folder = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    for name in names or list(registry.oracle_sql()):
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)


if __name__ == "__main__":
    main()
