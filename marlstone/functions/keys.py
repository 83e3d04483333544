"""Keys and classes used by the mart models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a null field contributes to a surrogate key.
NULL_FIELD = "_dbt_utils_surrogate_key_null_"

# Upper bounds (excluded) of the coverage classes, in percent.
RATIO_CLASSES = ((100, "underfunded"), (110, "at_risk"), (125, "healthy"))
TOP_RATIO_CLASS = "well_funded"


def surrogate_key(*fields: Column | str) -> Column:
    """md5 of the fields as text, joined by ``-``."""
    parts = [
        F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit(NULL_FIELD))
        for f in fields
    ]
    return F.md5(F.concat_ws("-", *parts))


def ratio_class(ratio: Column, null_class: str | None = None) -> Column:
    """Coverage class of a ratio in percent; null counts as the top class unless ``null_class``."""
    out = F.when(ratio.isNull(), F.lit(null_class)) if null_class else None
    for bound, name in RATIO_CLASSES:
        out = (F if out is None else out).when(ratio < bound, F.lit(name))
    return out.otherwise(F.lit(TOP_RATIO_CLASS))


def pseudonym(col: Column, salt: str = "") -> Column:
    """md5 of a personal value; the salt goes in front."""
    return F.md5(F.concat(F.lit(salt), col) if salt else col)


def lookup(key: Column, table: dict[str, str], default: Column | str) -> Column:
    """Value of a small fixed table by upper-cased key."""
    pairs = [F.lit(x) for k, v in table.items() for x in (k.upper(), v)]
    found = F.try_element_at(F.create_map(*pairs), F.upper(key))
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))
