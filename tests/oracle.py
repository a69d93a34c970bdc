"""Side-by-side run of a registered query and its SQL, compared as row multisets."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    if hasattr(value, "__float__") and not isinstance(value, int):
        return plain(float(value))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    left_names, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    right_names, right = rows_of([c[0] for c in found.description], found.fetchall())
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        extra = [r for r in left if r not in right][:2] if len(left) < 3000 else left[:2]
        return f"rows {len(left)} != {len(right)}; spark {extra}; sql {right[:2]}"
    for a, b in zip(left, right):
        if a != b:
            return f"first difference {list(zip(left_names, a, b))}"
    return f"ok {len(left)}"
