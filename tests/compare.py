"""Run a registered query in Spark and its SQL twin in DuckDB on the same
parquet tables, and compare columns, types, row counts and values.

A development and test aid (DuckDB is imported lazily)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from typing import Any

from pyspark.sql import SparkSession

from tessera.sources.tables import TABLE_NAMES, table_path

# Spark simple type name -> DuckDB type names it corresponds to.
_TYPE_MATCH = {
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "float": {"FLOAT"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "timestamp": {"TIMESTAMP WITH TIME ZONE"},
    "boolean": {"BOOLEAN"},
    "smallint": {"SMALLINT"},
    "tinyint": {"TINYINT"},
}


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    return con


def _norm(value: Any, digits: int | None) -> Any:
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, digits) if digits is not None else value
    if isinstance(value, decimal.Decimal):
        return _norm(float(value), digits)
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v, digits) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(rows: list[tuple], order: list[int], digits: int | None) -> list[tuple]:
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark: SparkSession, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    """Compare one query with its oracle; returns a report dict."""
    con = con or duckdb_connection(sf_dir)
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()

    report: dict[str, Any] = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    report["columns_match"] = sorted(s_cols) == sorted(d_cols)
    type_issues = []
    if report["columns_match"]:
        for c in s_cols:
            st, dtp = s_types[c], d_types[c]
            ok = dtp in _TYPE_MATCH.get(st, set()) or (st.startswith("decimal") and dtp.startswith("DECIMAL")) or (
                st.startswith("array") and dtp.endswith("[]")
            )
            if not ok:
                type_issues.append(f"{c}: spark {st} vs duckdb {dtp}")
    report["type_issues"] = type_issues
    if report["columns_match"]:
        names = sorted(s_cols)
        s_order = [s_cols.index(c) for c in names]
        d_order = [d_cols.index(c) for c in names]
        report["exact_match"] = _rows(s_rows, s_order, None) == _rows(d_rows, d_order, None)
        report["rounded_match"] = _rows(s_rows, s_order, 6) == _rows(d_rows, d_order, 6)
        if not report["rounded_match"]:
            a, b = _rows(s_rows, s_order, 6), _rows(d_rows, d_order, 6)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            report["first_diffs"] = diff
    else:
        report["spark_columns"] = s_cols
        report["oracle_columns"] = d_cols
    if report["columns_match"]:
        # pandas view (what a DataFrame-based hash would see): dtype kinds
        s_pd = sdf.toPandas()
        d_pd = con.sql(sql).df()
        kinds = {c: (s_pd[c].dtype.kind, d_pd[c].dtype.kind) for c in s_cols}
        report["pandas_kind_issues"] = [f"{c}: {a} vs {b}" for c, (a, b) in kinds.items() if a != b]
    report["ok"] = bool(
        report["columns_match"]
        and not type_issues
        and report.get("exact_match")
        and report["spark_rows"] == report["oracle_rows"]
    )
    return report
