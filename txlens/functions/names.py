"""Place-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words removed from the end of a city name.
CITY_NOISE = [
    "INDIA", "MAHARASHTRA", "TELANGANA", "KARNATAKA", "TAMIL NADU", "PUNE", "HYDERABAD",
    "BENGALURU",
]


def normalize_city(city: Column) -> Column:
    """Strip one trailing noise word, cut at the first '-' and ',', upper-case and trim."""
    bare = F.regexp_replace(city, f"(?i) ({'|'.join(CITY_NOISE)})$", "")
    bare = F.substring_index(F.substring_index(bare, "-", 1), ",", 1)
    return F.trim(F.upper(bare))


def clean_pincode(postcode: Column) -> Column:
    """Digits only."""
    return F.regexp_replace(postcode, "[^0-9]", "")


def title_words(text: Column) -> Column:
    """Upper-case each word's first letter, keep the rest, collapse white space."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))),
        " ",
    )


def location_type(city: Column, given: Column, metro_cities: list[str]) -> Column:
    """Metro for a listed city, Urban for any other named city, else the given type."""
    name = F.coalesce(city, F.lit(""))
    return (
        F.when(F.lower(name).isin([m.lower() for m in metro_cities]), F.lit("Metro"))
        .when(name != "", F.lit("Urban"))
        .otherwise(given)
    )


def address_line(house: Column, street: Column, city: Column, state: Column, pin: Column) -> Column:
    """'No. <house>, <street>, <city or state Region>[ - <pin>]'."""
    place = F.coalesce(city, F.concat(state, F.lit(" Region")))
    tail = F.coalesce(F.concat(F.lit(" - "), pin), F.lit(""))
    return F.concat(F.lit("No. "), house, F.lit(", "), street, F.lit(", "), place, tail)
