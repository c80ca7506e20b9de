"""Points in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

#: The ISO 8601 forms that are read; Spark alone would read more.
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?([+-]\d{2}(:?\d{2})?)?)?$"


def normalize_datetime(value: Column) -> Column:
    """ISO 8601 text in UTC at whole seconds, `YYYY-MM-DDTHH:MM:SSZ`; without an offset it is UTC already; null if it can't be read.

    Week dates (`2026-W15-1`) are not read. The session's time zone must be UTC.
    """
    text = F.replace(strip(value), F.lit("Z"), F.lit("+00:00"))
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})($|[T ])", "$1-$2-$3$4")
    known = F.when(text.rlike(ISO), F.translate(text, ",", "."))
    known = F.regexp_replace(known, r"(:\d{2}(?:\.\d+)?|[T ]\d{2})([+-]\d{2})$", "$1$2:00")
    known = F.regexp_replace(known, r"([T ]\d{2})($|[+-])", "$1:00$2")
    known = F.regexp_replace(known, r"(\.\d{6})\d+", "$1")
    return F.date_format(F.try_to_timestamp(known), "yyyy-MM-dd'T'HH:mm:ss'Z'")
