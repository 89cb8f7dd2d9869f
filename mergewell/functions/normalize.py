"""Normalisation of names, addresses, countries and postal codes. A null counts as empty; results are never null."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values, as results need them: names of countries and their codes.
COUNTRIES = {
    "us": "US", "usa": "US", "u.s.": "US", "united states": "US", "america": "US",
    "in": "IN", "ind": "IN", "india": "IN", "bharat": "IN",
    "fr": "FR", "fra": "FR", "france": "FR",
    "uk": "GB", "gb": "GB", "united kingdom": "GB",
    "ca": "CA", "can": "CA", "canada": "CA",
    "de": "DE", "deu": "DE", "germany": "DE",
    "au": "AU", "aus": "AU", "australia": "AU",
    "sg": "SG", "singapore": "SG",
    "jp": "JP", "japan": "JP",
}
# Legal forms that end a name.
SUFFIXES = [
    "inc", "incorporated", "corp", "corporation", "llc", "llp", "ltd", "limited",
    "co", "company", "pvt", "private", "gmbh", "sarl", "sa", "bhd", "plc",
]
# Address words and what they stand for.
ADDRESS_WORDS = {
    "st": "street", "str": "street",
    "rd": "road",
    "ave": "avenue", "av": "avenue",
    "blvd": "boulevard",
    "dr": "drive",
    "ln": "lane",
    "pkwy": "parkway",
    "ct": "court",
    "pl": "place",
    "ste": "suite",
    "apt": "apartment",
    "bldg": "building",
    "fl": "floor",
    "n": "north", "s": "south", "e": "east", "w": "west",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest",
}

_ASCII = r"^[\x00-\x7F]*$"


@F.pandas_udf(StringType())
def _decomposed(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))


def blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def stripped(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(blank(c), r"(?U)^\s+|\s+$", "")


def strip_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks. ASCII text doesn't leave the JVM."""
    c = blank(c)
    return F.coalesce(_decomposed(F.when(~c.rlike(_ASCII), c)), c)


def normalize_text(c: Column) -> Column:
    """Lower case without accents; & is "and"; other signs are spaces; words are one space apart."""
    text = F.replace(strip_accents(F.lower(blank(c))), F.lit("&"), F.lit(" and "))
    text = F.regexp_replace(text, r"(?U)[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def without_suffixes(norm: Column) -> Column:
    """A normalised name without the legal forms at its end; a name of nothing else stays."""
    forms = "|".join(SUFFIXES)
    return F.when(norm.rlike(f"^({forms})( ({forms}))*$"), norm).otherwise(F.regexp_replace(norm, f"(?: (?:{forms}))+$", ""))


def normalize_name(c: Column) -> Column:
    return without_suffixes(normalize_text(c))


def tokens(norm: Column) -> Column:
    """Words of a normalised text; none of an empty one."""
    return F.filter(F.split(norm, " "), lambda t: t != "")


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def expand_address(norm: Column) -> Column:
    words = _lookup(ADDRESS_WORDS)
    return F.array_join(F.transform(tokens(norm), lambda t: F.coalesce(F.try_element_at(words, t), t)), " ")


def normalize_address(c: Column) -> Column:
    return expand_address(normalize_text(c))


def normalize_country(c: Column) -> Column:
    """Code of a known country by its name or code, else the text in upper case. Signs are deleted, not spaced."""
    text = strip_accents(stripped(F.lower(blank(c))))
    text = stripped(F.regexp_replace(text, r"(?U)[^\p{L}\p{N}_\s]", ""))
    return F.coalesce(F.try_element_at(_lookup(COUNTRIES), text), F.upper(text))


def normalize_zip(c: Column) -> Column:
    return F.regexp_replace(F.upper(stripped(c)), r"(?U)[^\p{L}\p{N}_]", "")


def extract_numbers(norm: Column) -> Column:
    """Words that are digits only."""
    return F.regexp_extract_all(norm, F.lit(r"(?U)\b\d+\b"), F.lit(0))


def with_normalised(entities: DataFrame) -> DataFrame:
    """Standard entities with norm_ columns, token lists, address numbers and the full text."""
    c = F.col
    first = entities.withColumns(
        {
            "norm_name": normalize_name(c("name")),
            "norm_address": normalize_address(c("address")),
            "norm_city": normalize_text(c("city")),
            "norm_state": normalize_text(c("state")),
            "norm_country": normalize_country(c("country")),
            "norm_zip": normalize_zip(c("zip")),
        }
    )
    return first.withColumns(
        {
            "name_tokens": tokens(c("norm_name")),
            "addr_tokens": tokens(c("norm_address")),
            "addr_numbers": extract_numbers(c("norm_address")),
            "full_text": F.trim(F.concat_ws(" ", "norm_name", "norm_address", "norm_city", F.upper("norm_country"))),
        }
    )
