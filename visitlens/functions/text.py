"""Text helpers as Column expressions: emptiness, comma trimming, padding and
``name=value|name=value`` record access with the predicates built on it.

All run inside whole-stage codegen (built-in functions and higher-order
functions only).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c: Column | str) -> Column:
    """NULL or ``""``."""
    return F.coalesce(_c(c), F.lit("")) == F.lit("")


def is_not_empty(c: Column | str) -> Column:
    return ~is_empty(c)


def trim_comma(c: Column | str) -> Column:
    """Drop at most one leading and one trailing comma."""
    return F.regexp_replace(_c(c), r"^,|,$", "")


def pad2(c: Column | str) -> Column:
    """Left-pad a one- or two-character text to two characters with ``0``."""
    c = _c(c)
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def java_split(c: Column | str, sep_regex: str) -> Column:
    """Split like Java ``String.split``: trailing empty parts are dropped.

    ``""`` gives ``[""]``; a text made of separators only gives ``[]``.
    """
    c = _c(c)
    stripped = F.regexp_replace(c, f"(?:{sep_regex})+$", "")
    return (
        F.when(c == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, sep_regex))
    )


def _field_pattern(name: str) -> str:
    # name, '=', a non-empty value without '=', then any trailing '=' (these
    # vanish under Java's split, so the part still has exactly two pieces).
    return "^" + re.escape(name) + "=([^=]+)=*$"


def kv_field(record: Column | str, name: str) -> Column:
    """Value of field ``name`` in a ``a=1|b=2`` record, else NULL.

    The first ``|``-part that splits on ``=`` into exactly two pieces (Java
    split rules) with the matching name wins; ``str_to_map`` is not used
    because it fails on duplicate names and keeps malformed parts.
    """
    pattern = _field_pattern(name)
    parts = F.split(_c(record), r"\|")
    hit = F.get(F.filter(parts, lambda p: p.rlike(pattern)), 0)
    return F.regexp_extract(hit, pattern, 1)


def kv_between(record: Column | str, field: str, param: Column | str, start_field: str, end_field: str) -> Column:
    """``start <= record[field] <= end`` with start/end read from ``param``.

    A missing bound in the parameter record -> TRUE; a missing field in the
    data record -> FALSE.  Non-integer text counts as missing data (FALSE).
    """
    start_txt = kv_field(param, start_field)
    end_txt = kv_field(param, end_field)
    value = kv_field(record, field).try_cast("int")
    inside = (value >= start_txt.try_cast("int")) & (value <= end_txt.try_cast("int"))
    return F.when(start_txt.isNull() | end_txt.isNull(), F.lit(True)).otherwise(F.coalesce(inside, F.lit(False)))


def kv_in(record: Column | str, field: str, param: Column | str, param_field: str) -> Column:
    """Any comma item of ``record[field]`` equals a comma item of ``param[param_field]``."""
    wanted = kv_field(param, param_field)
    value = kv_field(record, field)
    overlap = F.arrays_overlap(java_split(value, ","), java_split(wanted, ","))
    return F.when(wanted.isNull(), F.lit(True)).otherwise(F.coalesce(overlap, F.lit(False)))


def kv_equal(record: Column | str, field: str, param: Column | str, param_field: str) -> Column:
    wanted = kv_field(param, param_field)
    value = kv_field(record, field)
    return F.when(wanted.isNull(), F.lit(True)).otherwise(F.coalesce(value == wanted, F.lit(False)))


def kv_record(**fields: Column) -> Column:
    """Build a ``name=value|...`` record; NULL values are left out."""
    parts = [F.concat(F.lit(f"{name}="), v.cast("string")) for name, v in fields.items()]
    return F.concat_ws("|", *parts)
