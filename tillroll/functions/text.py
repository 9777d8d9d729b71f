"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_id(c) -> Column:
    """P3 id as text: trimmed, trailing ``.0`` removed, text ``nan``/empty → null."""
    s = F.regexp_replace(F.trim(_c(c).cast("string")), r"\.0$", "")
    return F.when(s.isNull() | s.isin("nan", "NaN", "None", ""), F.lit(None).cast("string")).otherwise(s)


def clean_categorical(c) -> Column:
    """P12 trim + title case; ``Nan``/``None``/empty → null."""
    s = F.initcap(F.trim(_c(c).cast("string")))
    return F.when(s.isNull() | s.isin("Nan", "None", ""), F.lit(None).cast("string")).otherwise(s)


def label_map(c, mapping: dict, default=None) -> Column:
    """F17 value map with fallback (``default=None`` keeps the original)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    looked = m[_c(c)]
    return F.coalesce(looked, _c(c).cast("string") if default is None else F.lit(default))


def cluster_label(c, prefix: str = "Cluster ") -> Column:
    """F20 ``Cluster n`` label."""
    return F.concat(F.lit(prefix), _c(c).cast("string"))
