"""Compare a Spark result with a DuckDB result: column names, types,
row count and the multiset of rows (order-insensitive, floats to 6
decimals). Used by the oracle test and ``scripts/check_oracle.py``."""

from __future__ import annotations

import math
import os

SPARK2DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
              "StringType": "VARCHAR", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP",
              "BooleanType": "BOOLEAN", "FloatType": "FLOAT", "ShortType": "SMALLINT",
              "ByteType": "TINYINT", "TimestampType": "TIMESTAMP WITH TIME ZONE"}


def spark_type(dt) -> str:
    name = type(dt).__name__
    if name == "DecimalType":
        return f"DECIMAL({dt.precision},{dt.scale})"
    if name == "ArrayType":
        return spark_type(dt.elementType) + "[]"
    return SPARK2DUCK.get(name, name)


STRICT = bool(os.environ.get("PL_STRICT_COMPARE"))


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (v if STRICT else round(v, 6))
    if hasattr(v, "as_tuple"):  # Decimal
        return str(v) if STRICT else round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def register_tables(con, sf_dir: str, names) -> None:
    for t in names:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")


def compare(sdf, con, sql: str) -> list[str]:
    """Problems found (empty list = match)."""
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    scols = sorted(sdf.columns)
    stypes = {f.name: spark_type(f.dataType) for f in sdf.schema.fields}
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    dtypes = dict(zip(dcols, [str(d[1]) for d in rel.description]))
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    if scols != sorted(dcols):
        return [f"columns spark-only={sorted(set(scols) - set(dcols))} "
                f"duck-only={sorted(set(dcols) - set(scols))}"]
    problems = []
    tdiff = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    if tdiff:
        problems.append(f"types {tdiff}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
        return problems
    sa = sorted((tuple(norm(r[c]) for c in scols) for r in srows), key=repr)
    da = sorted((tuple(norm(r[c]) for c in scols) for r in drows), key=repr)
    diffs = [(a, b) for a, b in zip(sa, da) if a != b]
    if diffs:
        problems.append(f"{len(diffs)} value diffs; first spark={diffs[0][0]} duck={diffs[0][1]} "
                        f"cols={scols}")
    return problems
