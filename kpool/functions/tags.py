"""Deterministic per-row tags.

Every sampling decision in kpool comes from a seeded hash of a row's identity
instead of engine randomness (`rand()` depends on partitioning and is
recomputed differently after a task retry).  Two tags are used:

* ``priority(seed, ids...)`` -- an md5 hex string.  A sample of size k is the
  k rows with the smallest priorities; a merge of samples is the k smallest of
  the union.  The hex text orders like the 128-bit number it spells, so text
  comparison is numeric comparison.
* ``draw(seed, purpose, parts..., bound=b)`` -- a uniform integer in ``[0, b)`` made
  from the first 60 bits of an md5.  Used where an algorithm asks for a random
  index (reservoir slots, weighted merge, random strings).

Both are plain Column expressions: they stay inside whole-stage codegen and
have an exact twin in DuckDB (see ``sql_priority`` / ``sql_draw``), which is
what makes every sample checkable against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed text forms shared with the SQL twins below.
NULL_TEXT = "-"            # stands for a null identity part (a length never reads so)
LENGTH_MARK = "#"          # between a part's length and its text
SEP = ":"                  # separator between seed, purpose and parts
HEX_DIGITS_FOR_DRAW = 15   # 15 hex digits = 60 bits, always a positive bigint


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def id_text(c, dtype: T.DataType | None = None) -> Column:
    """Text form of one identity part, equal in Spark and DuckDB.

    The text is preceded by its length, so different tuples of parts never
    spell the same text.  Integers and strings cast as is; timestamps go
    through a fixed format to the microsecond (the parquet timestamps here are
    zone-less).  Doubles are rejected by :func:`identity_parts` because engines
    print them differently.
    """
    col = _as_col(c)
    if isinstance(dtype, T.TimestampNTZType):
        # zone-free: wall-clock text, never through a session zone
        text = col.cast("string")
        col = F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
    elif isinstance(dtype, T.TimestampType):
        col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(dtype, T.DateType):
        col = F.date_format(col, "yyyy-MM-dd")
    else:
        col = col.cast("string")
    return _part(col)


def _part(col: Column) -> Column:
    return F.coalesce(F.concat(F.length(col).cast("string"), F.lit(LENGTH_MARK), col), F.lit(NULL_TEXT))


def identity_parts(df, id_cols: Sequence) -> list[Column]:
    """Text parts for the identity columns of ``df`` (names or Columns)."""
    parts = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in id_cols:
        if isinstance(c, str):
            dt = types.get(c)
            if isinstance(dt, (T.FloatType, T.DoubleType)):
                raise ValueError(f"identity column {c!r} is floating point; use an integer or text key")
            parts.append(id_text(c, dt))
        else:
            parts.append(_part(c.cast("string")))
    return parts


def priority(seed: int | Column, *parts: Column) -> Column:
    """md5 hex of ``seed:part1:part2...`` (parts already text)."""
    seed_col = seed if isinstance(seed, Column) else F.lit(str(int(seed)))
    return F.md5(F.concat_ws(SEP, seed_col.cast("string"), *parts))


def row_priority(df, seed: int, id_cols: Sequence) -> Column:
    """Priority of each row of ``df`` from its identity columns."""
    if not id_cols:
        raise ValueError("id_cols must name at least one identity column")
    return priority(seed, *identity_parts(df, id_cols))


def draw(seed: int | Column, purpose: str, *parts, bound) -> Column:
    """Uniform integer in ``[0, bound)`` from ``md5(seed:purpose:parts...)``.

    ``purpose`` names the decision (a slot, a merge step, ...): decisions of
    different purposes never share a hash, nor do draws and priorities.
    ``bound`` may be a Column (e.g. the ordinal ``n``).  Modulo bias is at
    most bound / 2**60.
    """
    seed_col = seed if isinstance(seed, Column) else F.lit(str(int(seed)))
    txt = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    h = F.md5(F.concat_ws(SEP, seed_col.cast("string"), F.lit(purpose), *txt))
    u60 = F.conv(F.substring(h, 1, HEX_DIGITS_FOR_DRAW), 16, 10).cast("bigint")
    b = bound if isinstance(bound, Column) else F.lit(int(bound))
    return F.pmod(u60, b.cast("bigint"))


def hex_threshold(fraction: float) -> str:
    """Smallest 32-digit hex string h with P(md5 < h) >= fraction.

    Used to prune rows whose priority cannot reach a top-k before any shuffle.
    """
    if fraction >= 1.0:
        return "g"  # above every hex digit: keeps all rows
    v = int(fraction * (1 << 128)) + 1
    return format(min(v, (1 << 128) - 1), "032x")


# ---------------------------------------------------------------------------
# SQL twins (DuckDB dialect) used by the oracle queries.
# ---------------------------------------------------------------------------

def sql_id_text(expr: str, kind: str = "int") -> str:
    if kind == "ts":
        expr = f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"
    else:
        expr = f"CAST({expr} AS VARCHAR)"
    return f"coalesce(length({expr}) || '{LENGTH_MARK}' || {expr}, '{NULL_TEXT}')"


def sql_priority(seed, *parts: str) -> str:
    """``parts`` are SQL expressions already in text form (see sql_id_text)."""
    return f"md5(concat_ws('{SEP}', '{int(seed)}', {', '.join(parts)}))"


def sql_draw(seed, purpose: str, *parts: str, bound: str) -> str:
    txt = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    h = f"md5(concat_ws('{SEP}', '{int(seed)}', '{purpose}', {txt}))"
    return f"(CAST(('0x' || substr({h}, 1, {HEX_DIGITS_FOR_DRAW})) AS BIGINT) % ({bound}))"
