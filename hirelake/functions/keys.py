"""Hash keys and date keys of the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null marker and separator of the md5 surrogate key used by the
# dimension tables (dbt_utils generate_surrogate_key); keys must equal the ones the
# original warehouse produced.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the text form of the columns, NULL as a fixed marker, '-' between."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                        F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts) if len(parts) > 1 else parts[0])


def date_key(ts: Column | str) -> Column:
    """Timestamp -> yyyymmdd integer in the session zone."""
    return F.date_format(ts, "yyyyMMdd").cast("int")
