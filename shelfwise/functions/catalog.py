"""Column expressions for the product catalogue."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from shelfwise import lexicon
from shelfwise.functions.numeric import coerce_double

# How names state memory, and what product lines imply.
PAIR = r"([0-9]+)\s*g[b]?\s*[-/]\s*([0-9]+)\s*(g[b]?|t[b]?)"
GIGABYTES = r"([0-9]+)\s*g(?:\s*[^\s/]|\s*$)"
TERABYTES = r"([0-9]+)\s*t"
BASIC_PHONES = ["nokia 105", "izi", "fami", "masstel", "nokia 110"]
BASIC_SPECS = {"RAM": 0.048, "ROM": 0.128, "Battery": 1000.0, "Camera_MP": 0.3}
DEFAULT_ROM = 128.0
RAM_BY_ROM = [(512, 12.0), (256, 8.0), (128, 6.0), (64, 4.0)]
LEAST_RAM = 2.0


def _has(text: Column, *words: str) -> Column:
    return text.rlike("|".join(words))


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("double")


def spec_text(name: Column) -> Column:
    return F.lower(F.coalesce(name.cast("string"), F.lit("nan")))


def single_rom(text: Column) -> Column:
    """Storage where the name states one size only; terabytes come first."""
    return F.coalesce(
        _number(text, TERABYTES, 1) * 1024, _number(text, GIGABYTES, 1), F.lit(DEFAULT_ROM)
    )


def extract_specs(text: Column, rom_alone: Column, price: Column) -> dict[str, Column]:
    """RAM, ROM, battery and camera as the product name implies them."""
    is_pair = text.rlike(PAIR)
    unit = F.when(F.regexp_extract(text, PAIR, 3).startswith("t"), 1024.0).otherwise(1.0)
    implied_ram = F.lit(LEAST_RAM)
    for floor, ram in reversed(RAM_BY_ROM):
        implied_ram = F.when(rom_alone >= floor, ram).otherwise(implied_ram)

    iphone = text.contains("iphone")
    iphone_ram = (
        F.when(_has(text, "17", "16"), 8.0)
        .when(text.contains("15") & text.contains("pro"), 8.0)
        .when(_has(text, "15", "14"), 6.0)
        .otherwise(4.0)
    )
    ram = (
        F.when(iphone, iphone_ram)
        .when(is_pair, _number(text, PAIR, 1))
        .otherwise(implied_ram)
    )
    rom = F.when(is_pair, _number(text, PAIR, 2) * unit).otherwise(rom_alone)
    battery = (
        F.when(_has(text, "power", "neo"), 6000.0)
        .when(iphone & _has(text, "max", "plus"), 4400.0)
        .when(iphone, 3200.0)
        .otherwise(5000.0)
    )
    flagship = _has(text, "pro", "ultra")
    camera = (
        F.when(flagship & text.contains("samsung"), 108.0)
        .when(flagship, 50.0)
        .when(iphone, 48.0)
        .when(price > 7_000_000, 50.0)
        .otherwise(13.0)
    )
    basic = _has(text, *BASIC_PHONES)
    values = {"RAM": ram, "ROM": rom, "Battery": battery, "Camera_MP": camera}
    return {
        key: F.when(basic, BASIC_SPECS[key]).otherwise(value) for key, value in values.items()
    }


def calendar(date: Column, holidays: Iterable[str] = tuple(lexicon.HOLIDAYS)) -> dict[str, Column]:
    """Weekday (Monday 0), weekend and holiday; 0 for an unreadable date."""
    weekday = F.coalesce(F.weekday(date), F.lit(0))
    holiday = F.coalesce(F.date_format(date, "MM-dd").isin(list(holidays)), F.lit(False))
    return {
        "Day_of_Week": weekday.cast("int"),
        "Is_Weekend": (weekday >= 5).cast("int"),
        "Is_Holiday": holiday.cast("int"),
    }


def read_date(col: Column) -> Column:
    return F.to_date(col.try_cast("timestamp"))


def label_binary(stars: Column) -> Column:
    value = coerce_double(stars)
    return F.when(value >= 4, 1).when(value <= 2, 0)


def label_three(stars: Column) -> Column:
    value = coerce_double(stars)
    return (
        F.when(value.isNull(), None).when(value <= 2, 0).when(value == 3, 1).otherwise(2)
    ).cast("int")


def label_name(label: Column, names: Mapping[int, str] = lexicon.LABEL_NAMES) -> Column:
    chosen = F.lit(None).cast("string")
    for value, name in names.items():
        chosen = F.when(label == value, name).otherwise(chosen)
    return chosen


def segment(
    price: Column, ram: Column, names: Mapping[str, str] = lexicon.SEGMENTS
) -> Column:
    """Six market segments; an unknown price falls through to the top one."""
    return (
        F.when(price < 1_500_000, names["basic"])
        .when((price < 6_000_000) & (ram >= 6), names["mid_strong"])
        .when(price < 6_000_000, names["mid_saver"])
        .when((price < 15_000_000) & (ram >= 8), names["upper_power"])
        .when(price < 15_000_000, names["upper_design"])
        .otherwise(names["premium"])
    )


def review_weight(helpful: Column) -> Column:
    return F.coalesce(coerce_double(helpful).cast("bigint"), F.lit(0)) + 1


def absolute_url(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def url_slug(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def brand_or_first_word(brand: Column, name: Column) -> Column:
    stated = F.nullif(F.coalesce(brand, F.lit("")), F.lit(""))
    return F.coalesce(stated, F.initcap(F.regexp_extract(name, r"^\s*(\S+)", 1)))


def id_from_name(name: Column) -> Column:
    return F.regexp_replace(
        F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", ""
    )
