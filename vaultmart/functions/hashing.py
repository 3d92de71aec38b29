"""Hash keys and hashdiffs (the vault's identity contract).

Contract (identical in every engine that must agree with us):

* ``norm(c) = nullif(upper(trim(cast(c as string))), '')``; dates are
  rendered ``yyyy-MM-dd`` and timestamps ``yyyy-MM-dd HH:mm:ss`` (UTC).
* ``hash_key(a) = md5(norm(a))``; a composite key joins the normalised
  parts with ``||`` and is NULL when any part is NULL.
* ``hashdiff(cols)`` hashes the descriptive columns in sorted name order,
  NULL parts rendered as ``^^``; it is never NULL.
* Keys are 32-character lower-case hex strings; while a query moves them they
  may be their 16 bytes (``as_bytes``), and are shown as text (``as_text``).

Everything here is a built-in column expression, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the contract.
KEY_SEPARATOR = "||"
NULL_MARKER = "^^"

HOME = "_home"            # staged column: where a key's rows are gathered (see ``home``)
JOIN_HOME = "_join_home"  # the same for the key that a transactional link is joined on
FIRST, LAST = 1, -1       # the part of the table keys that a home is made of


def _as_text(col: Column, dtype: T.DataType | None) -> Column:
    if isinstance(dtype, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        raise TypeError("floating-point columns must not be hashed; cast to decimal first")
    return col.cast("string")


def norm(col: str | Column, dtype: T.DataType | None = None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(F.upper(F.trim(_as_text(c, dtype))), F.lit(""))


def _types(df: DataFrame | None, cols: Sequence[str]) -> list[T.DataType | None]:
    if df is None:
        return [None] * len(cols)
    fields = {f.name: f.dataType for f in df.schema.fields}
    return [fields.get(c) for c in cols]


def hash_key(*cols: str, df: DataFrame | None = None) -> Column:
    """MD5 key over one or several business-key columns (NULL if any is NULL)."""
    parts = [norm(c, t) for c, t in zip(cols, _types(df, cols))]
    expr = parts[0]
    for p in parts[1:]:
        # concat (not concat_ws) so that a NULL part makes the key NULL
        expr = F.concat(expr, F.lit(KEY_SEPARATOR), p)
    return F.md5(expr)


def home(key: str, part: int = FIRST) -> Column:
    """Where the rows of a business key are gathered: a hash of its normalised text before the first ``|`` (after the last
    one, for ``LAST``).  It is the same for all keys that begin (end) with ``key``, even if a part holds the separator, so rows
    gathered by it hold every row of these table keys and can be grouped and joined where they are."""
    return F.xxhash64(F.substring_index(F.upper(F.trim(F.col(key).cast("string"))), "|", part))


def hashdiff(cols: Sequence[str], df: DataFrame | None = None) -> Column:
    """Change-detection hash over descriptive columns; never NULL."""
    ordered = sorted(cols)
    parts = [F.coalesce(norm(c, t), F.lit(NULL_MARKER)) for c, t in zip(ordered, _types(df, ordered))]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def as_bytes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash columns as their 16 bytes: same order and equality as the 32 characters, half of their size in
    shuffles and files.  Only for columns made by ``hash_key`` and ``hashdiff``."""
    return df.withColumns({k: F.unhex(k) for k in keys}) if keys else df


def as_text(key: str, df: DataFrame) -> Column:
    """A hash column as its 32 characters, whichever form ``df`` holds it in."""
    return F.lower(F.hex(key)) if isinstance(df.schema[key].dataType, T.BinaryType) else F.col(key)


def sha_surrogate(*cols: str, df: DataFrame | None = None) -> Column:
    """SHA-256 surrogate over already-hashed keys, joined with ``|``; ``df`` tells which of them are bytes."""
    return F.sha2(F.concat_ws("|", *[F.col(c) if df is None else as_text(c, df) for c in cols]), 256)


def stage(df: DataFrame, hashed: dict[str, Sequence[str]] | None = None,
          hashdiffs: dict[str, Sequence[str]] | None = None,
          derived: dict[str, str | Column] | None = None) -> DataFrame:
    """Hashed staging (C3): keep source columns, add keys, hashdiffs, derived columns.

    ``derived`` values are a column name or a Column expression.
    """
    new_cols: dict[str, Column] = {}
    for name, src in (hashed or {}).items():
        new_cols[name] = hash_key(*src, df=df)
    for name, src in (hashdiffs or {}).items():
        new_cols[name] = hashdiff(src, df=df)
    for name, src in (derived or {}).items():
        new_cols[name] = F.col(src) if isinstance(src, str) else src
    return df.withColumns(new_cols) if new_cols else df
