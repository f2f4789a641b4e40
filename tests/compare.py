"""Compare a query with its SQL on the same tables, cell by cell."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def difference(df, con, sql):
    """None when equal, else a description."""
    left = df.toArrow()
    right = con.sql(sql).to_arrow_table()
    ln, lr = _rows(left)
    rn, rr = _rows(right)
    if ln != rn:
        return f"columns {ln} != {rn}"
    kinds = {n: (str(left.schema.field(n).type), str(right.schema.field(n).type)) for n in ln}
    same = {"large_string": "string"}
    odd = {
        n: (a, b)
        for n, (a, b) in kinds.items()
        if same.get(a, a) != same.get(b, b) and not a.startswith("timestamp")
    }
    if odd:
        return f"types {odd}"
    if lr != rr:
        extra = [r for r in lr if r not in set(rr)][:3]
        missing = [r for r in rr if r not in set(lr)][:3]
        return f"rows {len(lr)} vs {len(rr)}; extra {extra}; missing {missing}"
    return None
