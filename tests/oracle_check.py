"""Compare registered queries with their SQL oracles.

    python tests/oracle_check.py [sf] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(table) -> tuple[dict[str, str], int, list[int]]:
    """Types, row count, and sorted row hashes with the columns in name order."""
    types = {f.name: str(f.type).replace("large_string", "string") for f in table.schema}
    frame = table.select(sorted(table.column_names)).to_pandas()
    hashes = pd.util.hash_pandas_object(frame.astype("string").fillna("<null>"), index=False)
    return types, len(frame), sorted(hashes.tolist())


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when Spark and SQL agree, else what differs."""
    ours = canonical(entry.queries()[name](spark, sf_dir).toArrow())
    wanted = canonical(con.sql(entry.oracle_sql()[name]).to_arrow_table())
    for what, left, right in zip(("types", "rows", "values"), ours, wanted):
        if left != right:
            if what == "types":
                left, right = sorted(left.items()), sorted(right.items())
                left, right = set(left) - set(right), set(right) - set(left)
            return f"{what}: {left if what != 'values' else ''} / {right if what != 'values' else ''}"
    return None


def main() -> int:
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    sf_dir = f"{TESTDATA}/sf{sf}"
    spark, con, failed = make_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        problem = compare(spark, con, sf_dir, name)
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
