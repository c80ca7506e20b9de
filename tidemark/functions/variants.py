"""Values of any JSON type, held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let
from tidemark.functions.text import clean_text


def kind(value: Column) -> Column:
    """STRING, ARRAY<...>, OBJECT<...>, VOID and so on; null for SQL null."""
    return F.schema_of_variant(value)


def is_text(value: Column) -> Column:
    return kind(value) == "STRING"


def is_list(value: Column) -> Column:
    return F.startswith(kind(value), F.lit("ARRAY"))


def text_of(value: Column) -> Column:
    """The string of a string; null for every other type."""
    return F.when(is_text(value), F.try_variant_get(value, "$", "string"))


def list_of(value: Column) -> Column:
    return F.when(is_list(value), F.try_variant_get(value, "$", "array<variant>"))


def is_blank(value: Column) -> Column:
    """Null, an empty string or an empty list."""
    none = value.isNull() | F.coalesce(kind(value) == "VOID", F.lit(True))
    return none | F.coalesce(text_of(value) == "", F.lit(False)) | F.coalesce(F.size(list_of(value)) == 0, F.lit(False))


def is_falsy(value: Column) -> Column:
    """Blank, an empty object, zero or false."""
    # texts are told first: the cast of one that is no number costs an exception
    zero = ~is_text(value) & F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False))
    off = F.coalesce(kind(value) == "BOOLEAN", F.lit(False)) & ~F.coalesce(F.try_variant_get(value, "$", "boolean"), F.lit(False))
    return is_blank(value) | F.coalesce(kind(value) == "OBJECT<>", F.lit(False)) | zero | off


def as_variant(value: Column) -> Column:
    return F.to_variant_object(value)


def single(value: Column) -> Column:
    """The member of a list of one; other values as they are."""
    members = list_of(value)
    return F.when(F.coalesce(F.size(members) == 1, F.lit(False)), F.get(members, F.lit(0))).otherwise(value)


def clean_scalar(value: Column) -> Column:
    """A string cleaned, null if nothing is left; values of other types as they are, null for JSON null. NFC is the caller's part."""
    cleaned = clean_text(text_of(value), normalise=False)
    return F.when(is_text(value), cleaned.cast("variant")).when(kind(value) != "VOID", value)


def clean_value(value: Column) -> Column:
    """A string cleaned; of a list the cleaned members without nulls, a single one in place of the list, null for none."""
    members = F.filter(F.transform(list_of(value), lambda v: clean_scalar(v)), lambda v: v.isNotNull())
    several = let(members, lambda m: F.when(F.size(m) == 1, F.get(m, F.lit(0))).when(F.size(m) > 1, as_variant(m)))
    return F.when(is_list(value), several).otherwise(clean_scalar(value))
