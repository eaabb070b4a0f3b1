"""Which rows models may learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of all documents that no model learns from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
