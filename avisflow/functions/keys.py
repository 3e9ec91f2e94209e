"""Surrogate keys (KEY-1) and the content-hash review id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the null placeholder used by the surrogate-key convention the models follow,
# so keys stay equal to those a SQL warehouse produces for the same rows.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"
NULL_FIELD = "~"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 over the fields cast to text, nulls replaced by a placeholder, joined by '-'."""
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


REVIEW_ID_COLUMNS = ("bank", "agency", "author", "review_date", "review_text")


def review_id() -> Column:
    """Stable content hash of a staging row (replaces the renumbering ROW_NUMBER id).

    Each field enters with its length in front and nulls as a marker that no length can be, so
    different rows never spell the same input; SHA-256, since texts are user-supplied."""
    fields = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit(NULL_FIELD))
              for c in REVIEW_ID_COLUMNS]
    return F.sha2(F.concat(*fields), 256)


def surrogate_key_sql(*cols: str) -> str:
    """The same key as SQL text (used by oracles and SQL-form queries)."""
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_PLACEHOLDER}')" for c in cols)
    return f"md5(concat_ws('{SEPARATOR}', {parts}))"


def review_id_sql() -> str:
    fields = [f"coalesce(CAST(length({c}) AS VARCHAR) || ':' || {c}, '{NULL_FIELD}')" for c in REVIEW_ID_COLUMNS]
    return f"sha256({' || '.join(fields)})"
