"""Stable hashes of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(payload: Column) -> Column:
    """Compact JSON of a struct whose fields stand in alphabetical order; nulls are written out, text beyond ASCII as it is."""
    return F.to_json(payload, {"ignoreNullFields": "false"})


def content_hash(payload: Column) -> Column:
    return F.sha2(canonical_json(payload), 256)
