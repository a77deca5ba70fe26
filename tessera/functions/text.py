"""Small string rules shared by several operators (all JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name escapes (space, open and close parenthesis) and the URL escape (space only).
FILE_ESCAPES = [(" ", "%20"), ("(", "%28"), (")", "%29")]
URL_ESCAPES = [(" ", "%20")]


def _escape(c: Column, pairs) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def name_to_file(c: Column) -> Column:
    """Article name -> stored file name (space, parentheses escaped); not ``url_encode``."""
    return _escape(c, FILE_ESCAPES)


def name_to_url(c: Column) -> Column:
    """Article name -> URL path segment (only spaces escaped)."""
    return _escape(c, URL_ESCAPES)


# Bar widths (px) of the rating grid and their ratings; any other width rates 7.
WIDTH_RATINGS = [("21", 1), ("42", 2), ("63", 3), ("84", 4), ("105", 5), ("126", 6)]
OTHER_WIDTH_RATING = 7
WIDTH_RE = r"width:([0-9]{1,})px;"


def rating_bucket(style: Column) -> Column:
    """``width:Npx;`` -> rating 1..6 for the six grid widths, 7 for any other width, NULL otherwise."""
    px = F.regexp_extract(style, WIDTH_RE, 1)
    lookup = F.create_map(*[x for k, v in WIDTH_RATINGS for x in (F.lit(k), F.lit(v))])
    return F.when(px == "", F.lit(None).cast("int")).otherwise(F.coalesce(lookup[px], F.lit(OTHER_WIDTH_RATING)))


def split_trim(value: Column, sep: str = ",") -> Column:
    """Split on ``sep`` and trim every part."""
    return F.transform(F.split(value, sep, -1), lambda x: F.trim(x))
