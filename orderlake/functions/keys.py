"""Surrogate keys: a digest of the natural key, so no key table and no join is needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that stands for a null part, and the separator between parts.
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*parts: str | Column) -> Column:
    """Lower-case hex md5 of the parts. A null part has its own text, so it differs from ''."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_PART)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *texts) if len(texts) > 1 else texts[0])
