"""Personal-data masking of ingested orders.

Both masks are idempotent: a masked value no longer matches the pattern.
Nulls propagate instead of failing the batch.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: masking patterns ----------------------------------------
PHONE_PATTERN = r"(\d{3})\d{4}(\d{4})"
PHONE_REPLACEMENT = "$1****$2"
NAME_SUFFIX = "**"


def mask_name(c) -> Column:
    """First character plus '**' (e.g. a consignee name)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.substring(c, 1, 1), F.lit(NAME_SUFFIX))


def mask_phone(c) -> Column:
    """Every run of 11 digits keeps its first 3 and last 4 (unanchored,
    all matches replaced): '13812345678' -> '138****5678'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, PHONE_PATTERN, PHONE_REPLACEMENT)
