"""Derived keys and attributes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Keys with a shard of their own.
RESERVED_SHARDS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def shard(value: Column, shards: int = 128) -> Column:
    """Four-digit shard number from the last three hex digits of the md5."""
    tail = F.right(F.md5(value.cast("string")), F.lit(3))
    return F.lpad((F.conv(tail, 16, 10).cast("int") % shards).cast("string"), 4, "0")


def shard_with_reserved(value: Column, shards: int = 128,
                        reserved: Mapping[str, str] = RESERVED_SHARDS) -> Column:
    fixed = F.create_map(*[F.lit(x) for kv in reserved.items() for x in kv])
    return F.coalesce(F.try_element_at(fixed, F.lower(value.cast("string"))), shard(value, shards))


def row_key(value: Column) -> Column:
    """Key of the dimension store: md5 spreads neighbouring ids."""
    return F.md5(value.cast("string"))


def first_word(text: Column) -> Column:
    return F.element_at(F.split(text, " "), 1)


def last_item(text: Column, separator: str = ",") -> Column:
    return F.element_at(F.split(text, separator), -1)


def pick_by_modulo(number: Column, rules: list[tuple[int, str]], default: str) -> Column:
    """First rule whose modulus divides the number."""
    out = F.lit(default)
    for modulus, value in reversed(rules):
        out = F.when(number % modulus == 0, value).otherwise(out)
    return out


def pick_by_remainder(number: Column, modulus: int, bounds: list[tuple[int, str]],
                      default: str) -> Column:
    """First bound above `number % modulus`."""
    out = F.lit(default)
    for bound, value in reversed(bounds):
        out = F.when(number % modulus < bound, value).otherwise(out)
    return out


def json_paths(log: Column, paths: Mapping[str, str]) -> list[Column]:
    """Ad-hoc extraction of single paths; use `from_json` when many are needed."""
    return [F.get_json_object(log, path).alias(name) for name, path in paths.items()]


def parsed_once(record: Column, keep) -> Column:
    """Generator of the record if `keep(record)` holds, else of no row.

    Use it as `df.select(F.inline(parsed_once(...)))`. A filter on a parsed column would be
    pushed below the projection and parse the text a second time; a generator is not.
    """
    return F.filter(F.array(record), keep)
