"""Compare a registered query with its SQL, run by DuckDB on the same files."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def expected(sql: str, sf_dir: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return names, types, cursor.fetchall()


def bag(names, rows) -> Counter:
    """Rows as a multiset, with the columns sorted by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value
