"""Column functions on 'key:value, key:value' lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from runweave.functions.text import strip_ws


def _entries(col: Column) -> Column:
    return F.transform(F.split(col, ","), lambda e: F.split(strip_ws(e), ":"))


def kv_list_valid(col: Column) -> Column:
    """True when every entry holds exactly one colon; null for null or empty text."""
    return F.when(col != "", F.forall(_entries(col), lambda e: F.size(e) == 2))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once, also when body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kv_list(col: Column, rename: dict[str, str] | None = None) -> Column:
    """map of the list, the last entry of a key winning; null for null, empty or malformed text.

    A renamed key takes its new name from the old key only: an entry that already has the new
    name is dropped.
    """
    rename = rename or {}

    def key(entry: Column) -> Column:
        return F.get(entry, F.lit(0))

    def shown(entry: Column) -> Column:
        name = key(entry)
        for old, new in rename.items():
            name = F.when(key(entry) == old, new).otherwise(name)
        return F.struct(name, F.get(entry, F.lit(1)))

    def last_of_each(entries: Column) -> Column:
        def kept(keys: Column) -> Column:
            last = F.filter(entries, lambda e, i: F.array_position(keys, key(e)) == F.size(keys) - i)
            return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(last)

        return let(F.reverse(F.transform(entries, key)), kept)

    def to_map(entries: Column) -> Column:
        return F.map_from_entries(F.transform(last_of_each(entries), shown))

    def checked(entries: Column) -> Column:
        kept = F.filter(entries, lambda e: ~key(e).isin(*rename.values())) if rename else entries
        return F.when(F.forall(entries, lambda e: F.size(e) == 2), let(kept, to_map))

    return let(F.when(col != "", _entries(col)), checked)
