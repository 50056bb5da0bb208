"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyboard.functions.calendar import as_column

def slugify(c: Column | str) -> Column:
    """Lower case, blanks and underscores to hyphens, then only a-z, 0-9 and hyphens."""
    hyphened = F.lower(as_column(c))
    for gap in (" ", "_"):
        hyphened = F.replace(hyphened, F.lit(gap), F.lit("-"))
    return F.regexp_replace(hyphened, "[^a-z0-9-]", "")
