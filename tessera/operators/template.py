"""Page templates with ``|{field}`` markers filled from records.

Fixed values: a marker is ``|{name}`` where the name holds no brace and no space; a marker preceded by
a backslash is not a marker; the template's table name sits in ``<tableName value="..."/>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKER = r"(?<!\\)\|\{([^{} ]*)\}"
TABLE_NAME = r'<tableName\s+value="([^"]*)"'


def markers(template: Column) -> Column:
    """Array of marker names in template order (escaped markers skipped)."""
    return F.regexp_extract_all(template, F.lit(MARKER), 1)


def table_name(template: Column) -> Column:
    return F.regexp_extract(template, TABLE_NAME, 1)


def fill(template: Column, fields: Column, strict: bool = True) -> Column:
    """Replace every marker by ``fields[name]`` (a map column of the record).

    The template is cut into literal parts around the markers and re-joined with the values, so no
    offsets move. A marker naming a field the record lacks raises (``strict``) or becomes ''.
    """
    parts = F.split(template, MARKER, -1)
    names = markers(template)

    def value(n: Column) -> Column:
        v = fields[n]
        if strict:
            return F.coalesce(v, F.raise_error(F.concat(F.lit("missing field for marker: "), n)))
        return F.coalesce(v, F.lit(""))

    tail = F.zip_with(F.transform(names, value), F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
                      lambda v, lit: F.concat(v, F.coalesce(lit, F.lit(""))))
    return F.concat(F.element_at(parts, 1), F.array_join(tail, ""))
