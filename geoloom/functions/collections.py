"""Array, map and JSON expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_of_largest(values: Column, ids: Column) -> Column:
    """The id at the place of the largest value, the first of equals."""
    return F.element_at(ids, F.array_position(values, F.array_max(values)).cast("int"))


def without_adjacent_repeats(values: Column) -> Column:
    """An array without elements that equal the one before them."""
    return F.filter(values, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(values, i - 1)))


def lookup(table: Mapping, key: Column) -> Column:
    """A small fixed table as an expression; null for unknown keys."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def merged_tags(*maps: Column) -> Column:
    """Maps of strings as one: the last value of a key counts, null values are dropped, null maps are empty."""
    empty = F.create_map().cast("map<string,string>")
    entries = F.concat(*[F.map_entries(F.coalesce(m, empty)) for m in maps])
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    pairs = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))


def first_of_json_array(text: Column) -> Column:
    """First element of a JSON array of strings; null for an empty array, an empty string and what is no array."""
    return F.nullif(F.trim(F.get(F.from_json(text, "array<string>"), F.lit(0))), F.lit(""))


def json_keys(text: Column) -> Column:
    """Keys of a JSON object in their order; null for what is no object."""
    return F.json_object_keys(text)


def json_ints(text: Column) -> Column:
    """A JSON array as array<int>."""
    return F.from_json(text, "array<int>")


def json_kind(text: Column) -> Column:
    """object, array, string, number, boolean or null, as the JSON text says; null for what is no JSON."""
    first = F.substring(F.ltrim(text), 1, 1)
    kind = F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null").otherwise("number")
    return F.when(F.try_parse_json(text).isNotNull(), kind)


def at_time(text: Column, time: str) -> Column:
    """The whole number that a JSON object of times of day holds for "08:00" under h08_00."""
    return F.get_json_object(text, "$.h" + time.replace(":", "_")).try_cast("int")


def without_nul(text: Column) -> Column:
    """JSON text without escaped NUL characters, which some stores reject."""
    return F.replace(text, F.lit("\\u0000"), F.lit(""))


def sorted_join(values: Column, by: str = ", ") -> Column:
    """Distinct values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(values)), by)


def tag_flag(tags: Column, key: str, value: str = "yes") -> Column:
    """Whether a map of tags has a value for a key."""
    return F.coalesce(tags[key] == value, F.lit(False))
