"""Markup document sources and sinks (field documents, tag documents, tolerant scans).

Field document: ``<add><doc><field name="k">v</field>...</doc></add>``, many ``doc`` per file; fields may
lie at any depth of their ``doc``. Tag document: one record per document, ``<k>v</k><k2>v2</k2>`` with no
root element.

Records are cut by Spark's line reader, so a large file is many tasks. Inside a record, elements are
found by one pass over its tags with a stack of the open ones (:func:`elements`, or the strict XML parser of
the standard library): the content of an element is its text up to its first child.
"""

from __future__ import annotations

import re
from typing import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ship_package, spread

# record separator used between tag documents in one text file
TAG_DOC_SEP = "\u001e"
TAG_RE = r"(?s)<([A-Za-z_][\w.-]*)>(.*?)</\1>"
# what the tag sink writes for characters that would end an element or a record
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), (TAG_DOC_SEP, "&#30;"))

_TAG = re.compile(r"<(/)?([^\s<>/]+)((?:\s[^<>]*?)?)\s*(/)?>")
_ATTRIBUTE = re.compile(r"""([^\s=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"']+)""")
# elements that are no elements (fixed values): comments and the XML declaration
_SKIPPED = ("!--", "?xml")


def elements(text: str) -> Iterator[tuple[int, str, str, str]]:
    """(depth, name, attributes as written, raw content) of the elements of ``text``, in the order of their start.

    A closing tag that does not close the innermost open element ends the reading: elements that were
    closed by then, or had a child by then, are kept. Comments stay in the content around them.
    """
    found: list[list] = []
    open_: list[int] = []
    at = 0
    for m in _TAG.finditer(text):
        closing, name, attributes, complete = m.groups()
        if name.startswith(_SKIPPED):
            continue
        if open_ and found[open_[-1]][3] is None and (not closing or found[open_[-1]][1] == name):
            found[open_[-1]][3] = text[at:m.start()]
        if closing:
            if not open_ or found[open_[-1]][1] != name:
                break
            open_.pop()
        else:
            found.append([len(open_), name, attributes, "" if complete else None])
            if not complete:
                open_.append(len(found) - 1)
        at = m.end()
    return ((d, n, a, c) for d, n, a, c in found if c is not None)


def attribute(attributes: str, name: str) -> str | None:
    """Value of an attribute: in double, single or no quotes, whatever stands around it."""
    return next((v[1:-1] if v[0] in "\"'" else v for k, v in _ATTRIBUTE.findall(attributes) if k == name), None)


def raw_fields(record: str) -> dict[str, str] | None:
    """name -> raw content of the ``field`` elements of one record (text up to and without ``</doc>``), at any
    depth; a repeated name keeps its last value. None if no ``doc`` begins there."""
    begin = re.search(r"<doc[\s>]", record)
    if begin is None:
        return None
    named = ((attribute(a, "name"), c) for _, n, a, c in elements(record[begin.start():]) if n == "field")
    return {k: c for k, c in named if k is not None}


def strict_fields(record: str) -> tuple[dict[str, str] | None, str | None]:
    """(fields with entities decoded, None) of one well-formed record, else (None, the record)."""
    from xml.parsers import expat

    begin = re.search(r"<doc[\s>]", record)
    if begin is None:
        return None, None
    record = record[begin.start():] + "</doc>"
    fields: dict[str, str] = {}
    open_: list[list] = []                                   # [name or None, text pieces, has a child]

    def start(tag, attributes):
        if open_:
            open_[-1][2] = True
        open_.append([attributes.get("name") if tag == "field" else None, [], False])
        if open_[-1][0] is not None:
            fields.pop(open_[-1][0], None)
            fields[open_[-1][0]] = open_[-1][1]

    def text(data):
        if open_ and not open_[-1][2]:
            open_[-1][1].append(data)

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.CharacterDataHandler = start, text
    parser.EndElementHandler = lambda tag: open_.pop()
    try:
        parser.Parse(record.encode("utf-8", "replace"), True)
    except expat.ExpatError:
        return None, record
    return {k: "".join(v) for k, v in fields.items()}, None


def top_fields(text: str) -> dict[str, str]:
    """name -> raw content of the top-level elements of a tag document; the last of a name counts."""
    return {n: c for d, n, _, c in elements(text) if d == 0}


def _map_records(raw: DataFrame, parse: Callable, corrupt: bool = False) -> DataFrame:
    """(file, fields[, _corrupt_record]) of text records (file, value); ``parse`` gives None for no record."""
    ship_package(raw.sparkSession)

    def run(batches):
        import pyarrow as pa

        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            keep, fields, bad = [], [], []
            for i, value in enumerate(batch.column("value").to_pylist()):
                got = parse(value)
                found, broken = got if corrupt else (got, None)
                if found is None and broken is None:
                    continue
                keep.append(i)
                fields.append(None if found is None else list(found.items()))
                bad.append(broken)
            out = [batch.column("file").take(pa.array(keep, pa.int64())), pa.array(fields, kind)]
            yield pa.RecordBatch.from_arrays([*out, *[pa.array(bad, pa.string())] * corrupt],
                                             names=["file", "fields", *["_corrupt_record"] * corrupt])

    return raw.mapInArrow(run, "file string, fields map<string,string>" + ", _corrupt_record string" * corrupt)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, value): text records that end at ``</doc>``."""
    return spark.read.option("lineSep", "</doc>").text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def xml_text(c: Column) -> Column:
    """Text as XML 1.0 can hold it: a character that it has no way to write becomes U+FFFD."""
    return F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFE\\uFFFF]", "\ufffd")


def to_fields(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Wide rows -> one ``field`` array of (name, value) per document (column order kept)."""
    cols = list(cols or df.columns)
    return df.select(F.array(*[F.struct(F.lit(c).alias("_name"), xml_text(F.col(c).cast("string")).alias("_VALUE"))
                               for c in cols]).alias("field"))


def write_field_docs(df: DataFrame, path: str, cols: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """Sink: ``<add><doc><field name=...>`` XML files (entities escaped by the writer)."""
    (spread(to_fields(df, cols)).write.mode(mode).format("xml").option("rootTag", "add").option("rowTag", "doc")
     .save(path))


def last_wins(fields: Column) -> Column:
    """name -> value map from an array of (name, value); a repeated name keeps its last value.

    Element i is kept when the last occurrence of its name is at i; positions are found on the
    (small) array of names, so the (large) values are copied once. Pass a column reference (not a
    computed expression): expressions inside lambdas are evaluated again for every element.
    """
    names = F.transform(fields, lambda x: x["_name"])
    kept = F.filter(fields, lambda x, i: F.size(names) - F.array_position(F.reverse(names), x["_name"]) == i)
    return F.map_from_entries(F.transform(kept, lambda x: F.struct(x["_name"], F.coalesce(x["_VALUE"], F.lit("")))))


def read_field_docs(spark: SparkSession, path: str) -> DataFrame:
    """Source: one row per ``doc`` with ``fields map<string,string>`` (entities decoded); a field without
    content is ''.

    Documents that are not well-formed XML are returned with a NULL map and their text in
    ``_corrupt_record``; :func:`scan_tolerant` reads those too.
    """
    return _map_records(_records(spark, path), strict_fields, corrupt=True).select("fields", "_corrupt_record")


def scan_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Text scan of field documents: content kept raw (no entity decoding); of a document that is not well formed
    the fields before its first bad closing tag are read. (file, fields), one row per document."""
    return _map_records(_records(spark, path), raw_fields)


def write_tag_docs(df: DataFrame, path: str, cols: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """Sink: tag documents, one per record, separated by a record-separator character. Characters that would
    end an element or a record are escaped."""
    cols = list(cols or df.columns)

    def content(c):
        v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        for char, written in ESCAPES:
            v = F.replace(v, F.lit(char), F.lit(written))
        return v

    body = F.concat(*[F.concat(F.lit(f"<{c}>"), content(c), F.lit(f"</{c}>")) for c in cols])
    spread(df.select(body.alias("value"))).write.mode(mode).option("lineSep", TAG_DOC_SEP).text(path)


def read_tag_docs(spark: SparkSession, path: str) -> DataFrame:
    """Source: tag documents as :func:`write_tag_docs` writes them -> ``fields map<string,string>`` (top-level tag
    name = field name)."""
    raw = spark.read.option("lineSep", TAG_DOC_SEP).text(path).filter(F.length("value") > 0)
    raw = raw.select(_tag_pairs(F.col("value")).alias("__pairs"))
    fields = raw.select(last_wins(F.col("__pairs")).alias("fields"))

    def decoded(_, v):
        for char, written in reversed(ESCAPES):
            v = F.replace(v, F.lit(written), F.lit(char))
        return v

    return fields.select(F.transform_values("fields", decoded).alias("fields"))


def read_tag_files(spark: SparkSession, path: str) -> DataFrame:
    """Source: one tag document per file (no root element, contents raw) -> (file, fields map)."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return _map_records(raw, top_fields)


def _tag_pairs(text: Column) -> Column:
    names = F.regexp_extract_all(text, F.lit(TAG_RE), 1)
    values = F.regexp_extract_all(text, F.lit(TAG_RE), 2)
    return F.zip_with(names, values, lambda n, v: F.struct(n.alias("_name"), v.alias("_VALUE")))


def convert_to_fields(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write records with a ``fields`` map as field documents: every entry becomes a ``field`` with its name."""
    entries = F.transform(F.map_entries("fields"), lambda e: F.struct(e["key"].alias("_name"), xml_text(e["value"]).alias("_VALUE")))
    (docs.select(entries.alias("field")).write.mode(mode).format("xml").option("rootTag", "add").option("rowTag", "doc").save(path))


def convert_directory(spark: SparkSession, source: str, target: str, mode: str = "errorifexists") -> None:
    """All tag documents of a directory (one per file, or many as :func:`write_tag_docs` writes them) as field
    documents in another."""
    first = spark.read.text(source, wholetext=True).select(F.contains("value", F.lit(TAG_DOC_SEP)).alias("many")).where("many").limit(1)
    convert_to_fields(read_tag_docs(spark, source) if first.count() else read_tag_files(spark, source), target, mode)


def unpivot_fields(df: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Wide -> long ``(key, name, value)``: a field per row, values as strings."""
    cols = [c for c in (cols or df.columns) if c != key]
    casted = df.select(key, *[F.col(c).cast("string").alias(c) for c in cols])
    return casted.unpivot([key], cols, "name", "value")


def pivot_fields(long: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Long ``(key, name, value)`` -> wide, one column per listed name (explicit list: no extra pass)."""
    return long.groupBy(key).pivot("name", list(names)).agg(F.first("value"))


def write_lines(df: DataFrame, col: str, path: str, mode: str = "append") -> None:
    """Line-list sink (append by default): one value per line."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-list source; blank lines skipped."""
    return spark.read.text(path).filter(F.length(F.trim("value")) > 0)


def write_csv_rows(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV sink without a header line."""
    df.write.mode(mode).option("header", "false").csv(path)
