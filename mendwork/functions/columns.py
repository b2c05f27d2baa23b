"""Small column expressions: identifiers, times, bands, strata."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mendwork.constants import BAND_LIMITS, BANDS, STRATA, STRATUM_LIMITS, Urns

Moment = Column | str | dt.datetime


def moment(value: Moment) -> Column:
    """A point in time given as a column, ISO text or datetime. Text and naive values carry no zone."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return F.lit(value)
    return F.lit(str(value)).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def uuid7(ts: Column, *key: Column) -> Column:
    """Version-7 identifier text: millisecond time, then bits hashed from ``key``.

    The same time and key always give the same id, so a retried task or a repeated run writes the same row.
    """
    stamp = F.lpad(F.lower(F.hex(F.unix_millis(ts.cast("timestamp")))), 12, "0")
    bits = F.sha2(F.concat_ws("\u001f", *[k.cast("string") for k in key]), 256)
    variant = F.translate(F.substring(bits, 4, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(stamp, 1, 8), F.lit("-"), F.substring(stamp, 9, 4),
        F.lit("-7"), F.substring(bits, 1, 3),
        F.lit("-"), variant, F.substring(bits, 5, 3),
        F.lit("-"), F.substring(bits, 8, 12),
    )


def urn_parts(urn: Column, n: int) -> Column:
    """The first ``n`` colon-separated parts; missing parts count as empty."""
    return F.concat_ws(":", *[F.split_part(urn, F.lit(":"), F.lit(i + 1)) for i in range(n)])


def has_prefix(urn: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [urn.startswith(p) for p in prefixes])


def canonical_organization(urn: Column, urns: Urns) -> Column:
    """Legacy organisation identifiers rewritten to the canonical scheme; others unchanged."""
    return F.when(
        urn.startswith(urns.legacy_organization),
        F.concat(F.lit(urns.organization), F.split_part(urn, F.lit(":"), F.lit(4))),
    ).otherwise(urn)


def reorder_name(name: Column) -> Column:
    """``LAST FIRST MIDDLE`` to ``FIRST MIDDLE LAST``: trim, then move the first word to the end."""
    trimmed = F.trim(name)
    space = F.locate(" ", trimmed)
    rest = F.substring(trimmed, space + 1, F.length(trimmed))
    first = F.substring(trimmed, F.lit(1), space - 1)
    return F.when(space > 0, F.concat(rest, F.lit(" "), first)).otherwise(trimmed)


def party_key(urn: Column) -> Column:
    """Struct of the unprefixed identifier and its short prefix ('p' or 'o'); null for any other scheme."""
    prefix = F.when(urn.contains(":person:identifier-no:"), F.lit("p")).when(
        urn.contains(":organization:identifier-no:"), F.lit("o")
    )
    return F.when(
        prefix.isNotNull(),
        F.struct(F.substring_index(urn, ":", -1).alias("unprefixed"), prefix.alias("short_prefix")),
    )


def _chain(value: Column, limits: tuple[tuple[str, float], ...], strict: bool, last: str) -> Column:
    label = F.when(F.lit(False), F.lit(last))
    for name, limit in limits:
        label = label.when(value < limit if strict else value <= limit, F.lit(name))
    return label.otherwise(F.lit(last))


def band_of(fraction: Column, strict: bool) -> Column:
    """Hotness band of a rank fraction; ``strict`` compares with ``<``, else with ``<=``."""
    return _chain(fraction, BAND_LIMITS, strict, BANDS[-1])


def band_index(band: Column) -> Column:
    index = F.when(F.lit(False), F.lit(0))
    for i, name in enumerate(BANDS):
        index = index.when(band == name, F.lit(i))
    return index


def stratum(count: Column) -> Column:
    return _chain(count, STRATUM_LIMITS, False, STRATA[-1])
