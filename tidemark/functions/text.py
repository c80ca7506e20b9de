"""Cleaning of free text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The zero-width characters and the control characters that cleaning deletes.
ZERO_WIDTH = "​‌‍⁠﻿‎‏"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


@F.pandas_udf(StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFC")


def nfc(text: Column) -> Column:
    """Unicode NFC. Spark has no built-in, so texts beyond ASCII, and only those, go through Arrow."""
    return F.coalesce(_nfc(F.when(F.octet_length(text) != F.length(text), text)), text)


def none_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def visible(text: Column) -> Column:
    """Without zero-width and control characters; no-break spaces are spaces and line ends line feeds."""
    text = F.regexp_replace(F.translate(text, ZERO_WIDTH, ""), CONTROL, "")
    return F.regexp_replace(F.replace(text, F.lit(" "), F.lit(" ")), "\r\n|\r", "\n")


def clean_text(text: Column, keep_newlines: bool = False, normalise: bool = True) -> Column:
    """Tidy text; null if nothing is left. normalise=False leaves out NFC, for columns known to be in it."""
    text = visible(nfc(text) if normalise else text)
    if keep_newlines:
        text = F.regexp_replace(text, "[ \t]+", " ")
        text = F.regexp_replace(text, r"(?dmU)^[\s&&[^\n]]+|[\s&&[^\n]]+$", "")
        text = F.regexp_replace(text, "\n{3,}", "\n\n")
    else:
        text = F.regexp_replace(text, r"(?U)\s+", " ")
    return none_if_empty(strip(text))
