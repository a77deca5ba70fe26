"""Typed tables whose long text fields live in side tables as ordered 255-character pieces.

A :class:`TableSpec` declares fields, types and one primary key. :func:`split` turns a wide frame into
the stored form: a main frame (key + scalar fields in storage form) and, per Text field, a side frame
``(key, position, piece)`` with logical key ``(key, position)``. Reads recombine the pieces with a
keyed aggregate joined back to the main rows; upserts and deletes rewrite main and side frames
together, keyed on the primary key.

Scale notes: every multi-frame step is keyed on the primary key, so stored main/side tables that are
bucketed (or written hash-partitioned) by the key join and aggregate without a shuffle. A side group
is the pieces of one stored value, so it is bounded by the size of that one input row.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.predicate import not_true, where as where_tree
from tessera.functions.types import break_text, combine_pieces, type_of
from tessera.session import spread


@dataclass(frozen=True)
class TableSpec:
    """Declared table: name, ordered (field, type name) pairs and the primary-key field."""

    name: str
    fields: tuple[tuple[str, str], ...]
    pk: str

    def __post_init__(self) -> None:
        if not self.name:
            raise ValueError("a table needs a name")
        if not self.fields:
            raise ValueError("a table needs at least one field")
        names = [f for f, _ in self.fields]
        dup = {n for n in names if names.count(n) > 1}
        if dup:
            raise ValueError(f"duplicate field names: {sorted(dup)}")
        if self.pk not in names:
            raise ValueError(f"primary key {self.pk!r} is not a field")
        for _, t in self.fields:
            type_of(t)
        if not type_of(self.type_of(self.pk)).can_be_key:
            raise ValueError(f"a {self.type_of(self.pk)} field cannot be a key")

    def type_of(self, name: str) -> str:
        for f, t in self.fields:
            if f == name:
                return t
        raise KeyError(f"unknown field {name!r} in table {self.name!r}")

    @property
    def text_fields(self) -> list[str]:
        return [f for f, t in self.fields if type_of(t).pieces]

    @property
    def main_fields(self) -> list[str]:
        return [f for f, t in self.fields if not type_of(t).pieces]

    def side_name(self, fld: str) -> str:
        return f"{self.name}__{fld}"

    def side_tables(self) -> dict[str, dict]:
        """Declared child table per Text field: columns (key, position, piece), key (key, position)."""
        pk_type = type_of(self.type_of(self.pk)).storage
        return {f: {"name": self.side_name(f),
                    "columns": [(self.pk, pk_type), ("position", "INTEGER"), ("piece", "VARCHAR")],
                    "key": [self.pk, "position"]}
                for f in self.text_fields}

    @classmethod
    def from_schema_xml(cls, text: str, name: str) -> "TableSpec":
        """Declared schema from a search-schema XML document.

        ``<fieldType name=N class="solr.XField"/>`` maps a type alias to declared type X;
        ``<field name=F type=N/>`` declares a column; ``<uniqueKey>F</uniqueKey>`` is the key.
        """
        root = ET.fromstring(text)
        aliases = {}
        for ft in root.iter("fieldType"):
            m = re.search(r"solr\.(\S*)Field", ft.get("class", ""))
            if not m:
                raise ValueError(f"unknown field type class {ft.get('class')!r}")
            aliases[ft.get("name")] = m.group(1)
        fields = []
        for f in root.iter("field"):
            if f.get("type") not in aliases:
                raise ValueError(f"field {f.get('name')!r} has undeclared type {f.get('type')!r}")
            fields.append((f.get("name"), aliases[f.get("type")]))
        key = root.find(".//uniqueKey")
        if key is None or not (key.text or "").strip():
            raise ValueError("schema has no uniqueKey")
        return cls(name, tuple(fields), key.text.strip())


@dataclass
class SplitTable:
    """Stored form of a typed table: the main frame and one side frame per Text field."""

    spec: TableSpec
    main: DataFrame
    sides: dict[str, DataFrame] = field(default_factory=dict)


def typed_projection(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select every declared field converted to its storage form (unknown field -> AnalysisException)."""
    return df.select(*[type_of(t).to_storage(F.col(f)).alias(f) for f, t in spec.fields])


def side_frame(df: DataFrame, pk: str, text_col: str) -> DataFrame:
    """(pk, position, piece) rows for one Text column."""
    return df.select(F.col(pk), F.posexplode(break_text(F.col(text_col))).alias("position", "piece"))


def split(df: DataFrame, spec: TableSpec) -> SplitTable:
    """Wide typed frame -> main frame + one side frame per Text field (main first)."""
    stored = typed_projection(df, spec)
    if spec.text_fields:
        stored = spread(stored, spec.pk)
    main = stored.select(*spec.main_fields)
    sides = {f: side_frame(stored, spec.pk, f) for f in spec.text_fields}
    return SplitTable(spec, main, sides)


def combine(side: DataFrame, pk: str, name: str) -> DataFrame:
    """Recombine one side frame: one row per key with the pieces concatenated in position order."""
    return side.groupBy(pk).agg(combine_pieces(F.col("position"), F.col("piece")).alias(name),
                                F.count(F.lit(1)).cast("bigint").alias(f"{name}_pieces"))


def side_select(table: SplitTable, fld: str, where: Column | Sequence | None = None) -> DataFrame:
    """Side rows of the keys selected on the main frame (``pk IN (SELECT pk ... WHERE cond)``)."""
    keys = table.main.filter(where_tree(where) if not isinstance(where, Column) else where)
    keys = keys.select(table.spec.pk)
    return table.sides[fld].join(keys, table.spec.pk, "left_semi")


def select_recombined(table: SplitTable, fields: Iterable[str] | None = None,
                      where: Column | Sequence | None = None, text_where: Column | None = None,
                      with_piece_counts: bool = False, order: bool = True) -> DataFrame:
    """Typed select through main and side frames.

    Only the requested fields are read (side frames of unselected Text fields are never touched).
    ``where`` filters main fields and is transferred to the side frames as a key semi-join;
    ``text_where`` filters on recombined Text values. Rows come ordered by the primary key.
    """
    spec = table.spec
    pk = spec.pk
    wanted = list(fields) if fields is not None else [f for f, _ in spec.fields]
    for f in wanted:
        spec.type_of(f)
    main_cols = [pk] + [f for f in wanted if f in spec.main_fields and f != pk]
    if where is None:
        main = table.main.select(*main_cols)
        keys = None                      # every key: no key transfer into the side frames
    else:
        pred = where if isinstance(where, Column) else where_tree(where)
        main = table.main.filter(pred).select(*main_cols)
        keys = main.select(pk)
    out = main
    for f in wanted:
        if f in spec.text_fields:
            pieces = table.sides[f] if keys is None else table.sides[f].join(keys, pk, "left_semi")
            agg = combine(pieces, pk, f)
            if not with_piece_counts:
                agg = agg.drop(f"{f}_pieces")
            out = out.join(agg, pk, "left")
    if text_where is not None:
        out = out.filter(text_where)
    ordered = [pk]                      # requested order, key first, piece counts after their text
    for f in wanted:
        if f != pk:
            ordered.append(f)
            if with_piece_counts and f in spec.text_fields:
                ordered.append(f"{f}_pieces")
    out = out.select(*ordered)
    return out.orderBy(pk) if order else out


def upsert(table: SplitTable, src: DataFrame, order_col: str | None = None) -> SplitTable:
    """Insert-or-replace rows by primary key, cascading to every side frame.

    Every declared field must be present in ``src``. Several source rows with one key: the one with
    the greatest ``order_col`` wins; without ``order_col`` they are an error raised in the job. The
    side frames lose *all* pieces of each touched key before the new pieces are added, so a shorter
    new text leaves no stale tail.
    """
    spec = table.spec
    pk = spec.pk
    missing = [f for f, _ in spec.fields if f not in src.columns]
    if missing:
        raise ValueError(f"upsert needs every field; missing {missing}")
    if order_col is not None:
        cols = [f for f, _ in spec.fields]
        latest = src.groupBy(pk).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col)).alias("r"))
        src = latest.select("r.*")
    new = split(src, spec)
    twice = F.raise_error(F.concat(F.lit(f"several source rows with one {pk}: "), F.col(pk).cast("string")))
    touched = new.main.groupBy(pk).agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") > 1, twice.cast(new.main.schema[pk].dataType)).otherwise(F.col(pk)).alias(pk))
    main = table.main.join(touched, pk, "left_anti").unionByName(new.main)
    sides = {f: table.sides[f].join(touched, pk, "left_anti").unionByName(new.sides[f])
             for f in spec.text_fields}
    return SplitTable(spec, main, sides)


def delete(table: SplitTable, where: Column | Sequence | None = None) -> SplitTable:
    """Delete by where-tree (``None`` deletes all), cascading to side frames by key.

    The doomed keys are computed from the main frame *before* anything is removed.
    """
    spec = table.spec
    pred = where if isinstance(where, Column) else where_tree(where)
    doomed = table.main.filter(pred).select(spec.pk)
    main = table.main.filter(not_true(pred))
    sides = {f: s.join(doomed, spec.pk, "left_anti") for f, s in table.sides.items()}
    return SplitTable(spec, main, sides)


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Constraint report: key values held by more than one row, with their row count."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, cols: Sequence[str]) -> None:
    """Strict mode: raise when a PRIMARY KEY / UNIQUE constraint is violated."""
    bad = check_unique(df, cols).limit(1).collect()
    if bad:
        raise ValueError(f"constraint violated on {list(cols)}: {bad[0].asDict()}")


def write_split(table: SplitTable, path: str, mode: str = "errorifexists",
                buckets: int | None = None) -> None:
    """Write main and side frames under ``path`` (never the path being read: DML writes a new one).

    Each frame is hash-partitioned by the key before writing (``buckets`` files), so every file
    holds whole keys and a later key-wise recombination reads each key from one file.
    """
    def _w(df: DataFrame, sub: str, sort_cols: list[str]) -> None:
        out = df.repartition(buckets, table.spec.pk) if buckets else df.repartition(table.spec.pk)
        out.sortWithinPartitions(*sort_cols).write.mode(mode).parquet(f"{path}/{sub}")

    _w(table.main, "main", [table.spec.pk])
    for f, s in table.sides.items():
        _w(s, f"side_{f}", [table.spec.pk, "position"])


def save_bucketed(table: SplitTable, name: str, buckets: int, mode: str = "errorifexists") -> None:
    """Save main and side frames as catalog tables bucketed (and sorted) by the primary key.

    With the same bucket count on every frame, key-wise recombination and the main/side join read
    co-located buckets and need no shuffle at all; only the final ORDER BY moves data.
    """
    pk = table.spec.pk
    table.main.write.mode(mode).bucketBy(buckets, pk).sortBy(pk).saveAsTable(name)
    for f, side_df in table.sides.items():
        (side_df.write.mode(mode).bucketBy(buckets, pk).sortBy(pk, "position")
         .saveAsTable(f"{name}__{f}"))


def load_bucketed(spark, spec: TableSpec, name: str) -> SplitTable:
    return SplitTable(spec, spark.table(name), {f: spark.table(f"{name}__{f}") for f in spec.text_fields})


def read_split(spark, spec: TableSpec, path: str) -> SplitTable:
    main = spark.read.parquet(f"{path}/main")
    sides = {f: spark.read.parquet(f"{path}/side_{f}") for f in spec.text_fields}
    return SplitTable(spec, main, sides)
