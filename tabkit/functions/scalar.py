"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 4294967296  # 2**32: eight hex digits of md5


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hash_bucket(id_col, seed: int) -> Column:
    """Deterministic per-row integer in [0, 2**32) from the row key and a seed.

    ``md5(id || '-' || seed)``, first eight hex digits read as an unsigned
    integer.  Row-local (no shuffle, no sort) and independent of partitioning,
    so a split is identical on every re-run, on every cluster size and in the
    SQL oracle: ``('0x' || substr(md5(cast(id as varchar) || '-' || seed), 1, 8))::BIGINT``.
    A null key gets the last bucket, 2**32 - 1, so rows without key take part
    in every split (always on the training side) and in one fold.
    """
    key = F.concat(_c(id_col).cast("string"), F.lit(f"-{seed}"))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(bucket, F.lit(HASH_SPACE - 1))


def clip_col(col, lo=None, hi=None) -> Column:
    """Clip into [lo, hi]; a null stays null (bare greatest/least skip nulls)."""
    c = _c(col)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def log1p_col(col) -> Column:
    """log(1 + x)."""
    return F.log1p(_c(col))


def name_from_value(col) -> Column:
    """Normalise a category value into a column-name fragment:
    lower case, blanks and slashes become underscores."""
    return F.translate(F.lower(_c(col)), " /", "__")


def label_from_name(col, prefix: str = "") -> Column:
    """Turn a column name back into a title-case label: strip ``prefix``,
    underscores become blanks, each word capitalised (:func:`title_case`)."""
    c = _c(col)
    if prefix:
        c = F.when(F.startswith(c, F.lit(prefix)), F.substring(c, F.lit(len(prefix) + 1), F.length(c))).otherwise(c)
    return title_case(F.translate(c, "_", " "))


def title_case(col) -> Column:
    """Upper case for every letter that does not follow a letter, lower case
    for the others (``F.initcap`` starts words after blanks only)."""
    chars = F.split(F.lower(_c(col)), "")
    first = lambda i: (i == 0) | ~F.rlike(F.get(chars, i - 1), F.lit(r"\p{L}"))
    return F.array_join(F.transform(chars, lambda x, i: F.when(first(i), F.upper(x)).otherwise(x)), "")


def run_id_col(ts_col) -> Column:
    """Run tag ``%Y%m%d-%H%M%S`` from a timestamp column."""
    return F.date_format(_c(ts_col), "yyyyMMdd-HHmmss")


def name_from_value_py(value: str) -> str:
    """Driver-side twin of :func:`name_from_value` for fitted level lists."""
    return value.lower().replace(" ", "_").replace("/", "_")


# Fixed value: the whitespace characters of the regular-expression class \s.
WHITESPACE = " \t\n\x0b\f\r"


def strip_ws(col) -> Column:
    """Remove leading and trailing whitespace (blank, tab, line feed,
    vertical tab, form feed, carriage return); ``F.trim`` removes blanks
    only.  ``btrim`` with the character set avoids a regex per value."""
    return F.btrim(_c(col), F.lit(WHITESPACE))
