"""Deterministic surrogate keys.

A dimension key is the md5 (128 bits, as 32 hex digits) of an unambiguous
text of the natural key. It depends only on the natural key, so a dimension
table and its fact agree however the data is partitioned, re-run or
recomputed after an executor loss, and the fact can compute its foreign
keys row by row instead of joining a dimension that grows with the data.

Key text rules: a text part is its length, ``':'`` and the text, so no text
can imitate a separator; a null part is ``'n'``. A coordinate part holds the
double's exact value as two integers (units of 2**-20 degrees, and the rest
in units of 2**-82): plain IEEE arithmetic that every engine computes alike,
with 0.0 and -0.0 equal. ``coordinate`` is the normal form that dimensions
group by: values below 2**-30 degrees (a tenth of a millimetre), whose last
bits the text would not hold, count as 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_PART = "n"
COARSE = float(1 << 20)
FINE = float(1 << 62)
SMALLEST = 2.0**-30


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_part(col: Column | str) -> Column:
    c = _col(col).cast("string")
    return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit(NULL_PART))


def coordinate(col: Column | str) -> Column:
    """Normal form of a coordinate: what keys and dimensions agree on."""
    c = _col(col)
    return F.when(F.abs(c) < SMALLEST, F.lit(0.0)).otherwise(c)


def coordinate_part(col: Column | str) -> Column:
    scaled = coordinate(col) * COARSE
    whole = F.floor(scaled)
    rest = F.floor((scaled - whole.cast("double")) * FINE)
    exact = F.concat(whole.cast("string"), F.lit("."), rest.cast("string"))
    return F.coalesce(F.when(F.isnan(scaled), F.lit("nan")).otherwise(exact), F.lit(NULL_PART))


def key_text(*parts: Column) -> Column:
    return F.concat_ws("|", *parts)


def hash_key(text: Column) -> Column:
    """128-bit key: the md5 of the key text as hex digits."""
    return F.md5(text)


def location_key(lat="latitude", lon="longitude", place="place") -> Column:
    return hash_key(key_text(coordinate_part(lat), coordinate_part(lon), text_part(place)))


def event_type_key(event_type="event_type", mag_type="magType") -> Column:
    return hash_key(key_text(text_part(event_type), text_part(mag_type)))


def magnitude_key(category="MagnitudeCategory") -> Column:
    return hash_key(key_text(text_part(category)))
