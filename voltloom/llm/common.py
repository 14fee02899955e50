"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.scratch import discard, materialise

__all__ = ["blocks_for", "discard", "materialise", "utf8_bytes"]


def utf8_bytes(text: Column) -> Column:
    """Length in UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def blocks_for(rows: int, per_block: int) -> int:
    """How many blocks of about ``per_block`` rows hold ``rows`` rows."""
    return max(1, -(-rows // per_block))
