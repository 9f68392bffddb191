"""Column helpers for text: regex access, trimming, joining, map lookups."""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as ``str.strip`` sees it; without a list Spark's trim removes spaces only.
WHITESPACE = "".join(
    map(
        chr,
        [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def rx(pattern: str, ignore_case: bool = False) -> str:
    """Pattern with Unicode classes on, optionally ignoring case."""
    return ("(?iU)" if ignore_case else "(?U)") + pattern


def all_matches(c: Column, pattern: str, group: int = 1, ignore_case: bool = False) -> Column:
    """Every match, repeats kept, in text order; NULL text gives NULL."""
    return F.regexp_extract_all(c, F.lit(rx(pattern, ignore_case)), F.lit(group))


def first_match(c: Column, pattern: str, group: int = 1, ignore_case: bool = False) -> Column:
    """First match or NULL (``regexp_extract`` alone returns an empty string)."""
    return F.nullif(F.regexp_extract(c, rx(pattern, ignore_case), group), F.lit(""))


def has_match(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Whether the pattern occurs; NULL text counts as no."""
    return F.coalesce(c.rlike(rx(pattern, ignore_case)), F.lit(False))


def strip_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """NULL, empty or whitespace only."""
    return F.coalesce(strip_ws(c), F.lit("")) == ""


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def join_list(items: Column, sep: str = "; ") -> Column:
    """Non-blank items joined by ``sep``; an empty list gives ``''``."""
    return F.array_join(F.filter(items, lambda x: ~is_blank(x)), sep)


def join_or_null(items: Column, sep: str = ",") -> Column:
    """Items joined by ``sep``; an empty list gives NULL."""
    return F.when(F.size(items) > 0, F.array_join(items, sep))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of each run of letters (``on-hold`` -> ``On-Hold``)."""
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.initcap(p)), "")


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value of ``key`` in a small constant table, NULL when absent."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def large_lookup(key: Column, table: Mapping[str, str], bucket: int = 16) -> Column:
    """As :func:`lookup` for a table of any length: a map is searched from its start, so there is one per few keys."""
    if len(table) <= 4 * bucket:
        return lookup(key, table)
    count = len(table) // bucket
    parts: list[dict[str, str]] = [{} for _ in range(count)]
    for name, value in table.items():
        parts[zlib.crc32(name.encode()) % count][name] = value
    maps = F.from_json(F.lit(json.dumps(parts)), "array<map<string,string>>")
    number = (F.crc32(key.cast("binary")) % count).cast("int")
    return F.try_element_at(F.get(maps, number), key)


def pool_text(*cols: Column) -> Column:
    """Non-blank texts joined by one space (``''`` when all are blank)."""
    return F.concat_ws(" ", *[F.when(~is_blank(c), c) for c in cols])


def prefer_text(first: Column, second: Column) -> Column:
    """``first`` unless it is blank, else ``second``."""
    return F.when(~is_blank(first), first).otherwise(second)


def to_long(c: Column) -> Column:
    """Digits as bigint; empty or beyond 64 bits gives NULL."""
    return F.nullif(c, F.lit("")).try_cast("bigint")
