"""Amounts written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.binding import let
from tidemark.functions.text import ZERO_WIDTH, strip

# What the amount units multiply by, and the currency that each spelling means.
UNIT_MULTIPLIERS = {"million": 10000.0, "millions": 10000.0, "milliard": 10000000.0, "milliards": 10000000.0, "billion": 10000000.0, "billions": 10000000.0}
CURRENCIES = {"da": "DZD", "dzd": "DZD", "dinar": "DZD", "dinars": "DZD", "دج": "DZD", "د.ج": "DZD", "دينار": "DZD"}
CURRENCY = "DZD"

# What a price text looks like: digits with separators, then a unit, then a currency.
_NUMBER = r"(\d[\d\s\x{a0}\x{202f}.,]*)"
_UNIT = r"(millions?|milliards?|billions?)?"
_CURRENCY = r"(da|dzd|dinars?|د\.?ج|دينار)?"
PRICE = rf"(?iU){_NUMBER}\s*{_UNIT}\s*{_CURRENCY}"
_ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"


def _lookup(table: dict, key: Column) -> Column:
    entries = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*entries), key)


def parse_number(text: Column) -> Column:
    """A number with spaces, dots and commas as a double; null if it is none.

    Of two kinds of separators the last is the decimal one. One kind parts thousands if it stands more than once, or once
    before exactly three digits after anything but a lone zero; else it is the decimal separator.
    """
    bare = F.regexp_replace(F.translate(text, _ARABIC_DIGITS, "0123456789"), r"(?U)[\s\x{a0}\x{202f}]", "")
    return let(F.regexp_replace(bare, r"^[.,]+|[.,]+$", ""), _number)


def _number(bare: Column) -> Column:
    comma, dot = bare.contains(","), bare.contains(".")
    last_is_comma = F.instr(F.reverse(bare), ",") < F.instr(F.reverse(bare), ".")
    both = F.when(last_is_comma, F.translate(F.translate(bare, ".", ""), ",", ".")).otherwise(F.translate(bare, ",", ""))
    parts = F.split(bare, "[.,]", -1)
    thousands = (F.size(parts) > 2) | ((F.length(F.get(parts, F.lit(1))) == 3) & (F.get(parts, F.lit(0)) != "0"))
    single = F.when(thousands, F.array_join(parts, "")).otherwise(F.array_join(parts, "."))
    plain = F.when(comma & dot, both).when(comma | dot, single).otherwise(bare)
    return let(plain, lambda p: F.when(p.rlike(r"^\d*\.?\d*$") & p.rlike(r"\d"), p.try_cast("double")))


def parse_price(raw: Column) -> Column:
    """struct<amount, currency, raw, unit> of a price text: its first number, the unit behind it and a stated currency."""
    return let(raw, lambda raw: let(_read(F.translate(raw, ZERO_WIDTH, "")), lambda r: _price(raw, r)))


def _read(text: Column) -> Column:
    """The number, unit and currency as they stand in the text."""
    found = [F.nullif(F.regexp_extract(text, PRICE, n), F.lit("")) for n in (1, 2, 3)]
    return F.struct(parse_number(found[0]).alias("number"), F.lower(found[1]).alias("unit"), F.lower(found[2]).alias("currency"))


def _price(raw: Column, read: Column) -> Column:
    known = read["number"].isNotNull()
    amount = read["number"] * F.when(read["unit"].isNotNull(), _lookup(UNIT_MULTIPLIERS, read["unit"])).otherwise(F.lit(1.0))
    return F.struct(
        amount.alias("amount"),
        F.when(known, _lookup(CURRENCIES, read["currency"])).alias("currency"),
        F.when(strip(raw) != "", raw).alias("raw"),
        F.when(known, F.upper(read["unit"])).alias("unit"),
    )


def number_text(number: Column) -> Column:
    """A double as JSON shows it, whole numbers without a fraction."""
    return F.when(number == F.floor(number), number.cast("decimal(38,0)").cast("string")).otherwise(number.cast("string"))
