"""Schema conformance for drifting periodic files.

``conform_schema`` replaces a chain of guarded renames/casts with ONE projection:
every target field is looked up by exact name, then by an alias map, then
case-insensitively; it is cast to the declared type, or back-filled as a typed NULL
when the file lacks it. Strict mode keeps Spark's ANSI casts (bad values raise);
tolerant mode uses ``try_cast`` (bad values become NULL).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _resolve(columns: list[str], name: str, aliases: Mapping[str, str]) -> str | None:
    if name in columns:
        return name
    for src, dst in aliases.items():
        if dst == name and src in columns:
            return src
    lowered = {c.lower(): c for c in columns}
    hit = lowered.get(name.lower())
    if hit is not None:
        return hit
    for src, dst in aliases.items():
        if dst == name and src.lower() in lowered:
            return lowered[src.lower()]
    return None


def _cast(c: Column, src_type: T.DataType, dst: T.DataType, tolerant: bool) -> Column:
    if src_type == dst:
        return c
    if tolerant:
        return c.try_cast(dst)
    return c.cast(dst)


def conform_schema(df: DataFrame, target: T.StructType, aliases: Mapping[str, str] | None = None,
                   tolerant: bool = False, keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``target``: rename, cast, back-fill missing fields, fix the order."""
    aliases = dict(aliases or {})
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(types)
    out, used = [], set()
    for field in target.fields:
        src = _resolve(cols, field.name, aliases)
        if src is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            used.add(src)
            out.append(_cast(F.col(f"`{src}`"), types[src], field.dataType, tolerant).alias(field.name))
    if keep_extra:
        out += [F.col(f"`{c}`") for c in cols if c not in used and c not in target.fieldNames()]
    return df.select(*out)


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required names absent from ``df`` (case-insensitive, like Spark's resolver)."""
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def require_columns(df: DataFrame, required) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df


def normalize_headers(df: DataFrame) -> DataFrame:
    """Lower-case every header and turn blanks into underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def utc_now() -> Column:
    """Current UTC wall-clock time as TIMESTAMP_NTZ, whatever the session time zone."""
    return F.expr("CAST(to_utc_timestamp(current_timestamp(), current_timezone()) AS TIMESTAMP_NTZ)")


def add_metadata(df: DataFrame, year: int | Column, month: int | Column, run_tag: str,
                 ingested_at: Column | None = None, service: str | None = None) -> DataFrame:
    """Lineage columns run_tag, source_year, source_month, ingested_at_utc (+ service_type)."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    cols = {
        "run_tag": F.lit(run_tag),
        "source_year": lit(year).cast("int"),
        "source_month": lit(month).cast("int"),
        "ingested_at_utc": ingested_at if ingested_at is not None else utc_now(),
    }
    if service is not None:
        cols["service_type"] = F.lit(service)
    return df.withColumns(cols)
