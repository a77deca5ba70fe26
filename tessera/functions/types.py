"""Declared field types and their storage conversions (all as Column expressions).

A declared schema names every field with one of the type names below; the type decides the storage
column type, the two-way conversion, and whether the field lives in a side table as ordered pieces.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's behaviour:
#   maximum length of one stored text piece: 255 characters
#   storage truth tokens for Bool: 1, '1', 't', 'T'   (anything else, 'true' included, is 0)
#   storage truth tokens when reading Bool back: 1, '1'
#   search-form date: YYYY-MM-DDTHH:MM:SSZ     storage-form date: YYYY-MM-DD HH:MM:SS
PIECE_LEN = 255
BOOL_TRUE_TOKENS = ["1", "t", "T"]
BOOL_BACK_TRUE_TOKENS = ["1"]


def bool_to_storage(c: Column) -> Column:
    """Bool -> TINYINT: 1 iff a text is one of the truth tokens (not ``cast(boolean)``), a boolean is
    true, or a number equals 1; anything else, null included, is 0."""
    kind, text = F.typeof(c), c.cast("string")
    true = (F.when(kind == "boolean", text == "true").when(kind == "string", text.isin(BOOL_TRUE_TOKENS))
            .otherwise(text.try_cast("double") == 1))
    return F.when(true, F.lit(1)).otherwise(F.lit(0)).cast("tinyint")


def bool_from_storage(c: Column) -> Column:
    return F.when(c.cast("string").isin(BOOL_BACK_TRUE_TOKENS), F.lit(1)).otherwise(F.lit(0)).cast("tinyint")


def date_to_storage(c: Column) -> Column:
    """'YYYY-MM-DDTHH:MM:SSZ' -> 'YYYY-MM-DD HH:MM:SS'; a value without 'T' passes through."""
    s = c.cast("string")
    converted = F.concat(F.substring(s, 1, 10), F.lit(" "),
                         F.substring(s, F.lit(12), F.greatest(F.length(s) - 12, F.lit(0))))
    return F.when(F.instr(s, "T") == 0, s).otherwise(converted)


def date_from_storage(c: Column) -> Column:
    """'YYYY-MM-DD HH:MM:SS' -> 'YYYY-MM-DDTHH:MM:SSZ'; a value already holding 'T' passes through."""
    s = c.cast("string")
    converted = F.concat(F.substring(s, 1, 10), F.lit("T"),
                         F.substring(s, F.lit(12), F.greatest(F.length(s) - 11, F.lit(0))), F.lit("Z"))
    return F.when(F.instr(s, "T") > 0, s).otherwise(converted)


def date_to_timestamp(c: Column) -> Column:
    """Typed form of the storage date (UTC session): NULL when the text is not a date."""
    return F.try_to_timestamp(date_to_storage(c), F.lit("yyyy-MM-dd HH:mm:ss"))


def piece_count(text: Column) -> Column:
    """max(1, ceil(n / 255)): the empty text is still one (empty) piece."""
    return F.greatest(F.ceil(F.length(text) / F.lit(PIECE_LEN)), F.lit(1)).cast("int")


def break_text(text: Column) -> Column:
    """Text -> array of 255-character pieces in order, in one pass over the text. The empty text is
    one empty piece, a null text has none (so it comes back as null)."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE_LEN}}}"), F.lit(0)))


def combine_pieces(position: Column, piece: Column) -> Column:
    """Aggregate: concatenate pieces ordered by position (one group = one stored text)."""
    ordered = F.array_sort(F.collect_list(F.struct(position.alias("p"), piece.alias("v"))))
    return F.array_join(F.transform(ordered, lambda x: x["v"]), "")


@dataclass(frozen=True)
class TypeSpec:
    """One declared type: storage type, conversions, and whether it is kept as side-table pieces."""

    name: str
    storage: str
    spark_type: T.DataType
    to_storage: Callable[[Column], Column]
    from_storage: Callable[[Column], Column]
    pieces: bool = False
    can_be_key: bool = True


def _ident(c: Column) -> Column:
    return c


def _cast(t: str) -> Callable[[Column], Column]:
    return lambda c: c.cast(t)


# Declared type name -> storage type name (search-schema names on the left).
TYPES: dict[str, TypeSpec] = {
    "Bool": TypeSpec("Bool", "TINYINT", T.ByteType(), bool_to_storage, bool_from_storage),
    "DateRange": TypeSpec("DateRange", "DATE", T.StringType(), date_to_storage, date_from_storage),
    "Str": TypeSpec("Str", "VARCHAR", T.StringType(), _cast("string"), _ident),
    "Text": TypeSpec("Text", "VARCHAR", T.StringType(), _cast("string"), _ident, pieces=True,
                     can_be_key=False),
    "TrieDouble": TypeSpec("TrieDouble", "DOUBLE", T.DoubleType(), _cast("double"), _ident),
    "TrieInt": TypeSpec("TrieInt", "INTEGER", T.IntegerType(), _cast("int"), _ident),
    "TrieFloat": TypeSpec("TrieFloat", "FLOAT", T.FloatType(), _cast("float"), _ident),
    "TrieLong": TypeSpec("TrieLong", "BIGINT", T.LongType(), _cast("bigint"), _ident),
    "GenericType": TypeSpec("GenericType", "GenericType", T.StringType(), _cast("string"), _ident),
}


def type_of(name: str) -> TypeSpec:
    try:
        return TYPES[name]
    except KeyError:
        raise ValueError(f"unknown type name {name!r}") from None


def register_type(spec: TypeSpec) -> None:
    """Pluggable types: add a TypeSpec under its declared name."""
    TYPES[spec.name] = spec
