"""Result comparison used by tests and the oracle check script: run the SQL
oracle in DuckDB over the same Parquet files and compare order-insensitively."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run_oracle(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    cur = _connect(sf_dir).execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


_SPARK_TYPES = {"int": "int32", "bigint": "int64", "string": "string", "date": "date", "boolean": "bool",
                "timestamp_ntz": "timestamp", "double": "float64"}
_DUCK_TYPES = {"INTEGER": "int32", "BIGINT": "int64", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "bool",
               "TIMESTAMP": "timestamp", "DOUBLE": "float64"}


def spark_types(df) -> dict[str, str]:
    return {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}


def oracle_types(sql: str, sf_dir: str) -> dict[str, str]:
    rel = _connect(sf_dir).sql(sql)
    return {c: _DUCK_TYPES.get(str(t), str(t).lower()) for c, t in zip(rel.columns, rel.types)}


STRICT = False


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return str(v) if STRICT else format(v.normalize(), "f")
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return format(decimal.Decimal(repr(v)).normalize(), "f")
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def normalize(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare_rows(cols, rows, ocols, orows) -> tuple[bool, str]:
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: {sorted(cols)} vs {sorted(ocols)}"
    if len(rows) != len(orows):
        return False, "row counts differ"
    a, b = normalize(cols, rows), normalize(ocols, orows)
    for x, y in zip(a, b):
        if x != y:
            names = sorted(cols)
            diff = {n: (p, q) for n, p, q in zip(names, x, y) if p != q}
            return False, f"first diff: {diff}"
    return True, ""
