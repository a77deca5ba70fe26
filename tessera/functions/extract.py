"""Extraction functions applied to matched nodes (name -> builder), pluggable.

A builder is either a Column over node-table columns, a frame function
``(tags, nodes) -> (page_id, node_id, value)`` for values that need other nodes, or a vectorised function over
Arrow arrays (:func:`register_vector`) for what no built-in expression says.
"""

from __future__ import annotations

from typing import Callable, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Extractor = Union[Callable[[], Column], Callable[[DataFrame, DataFrame], DataFrame]]


def _bold(tags: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stripped text of the first <b> inside each tag (document order)."""
    b = nodes.filter(F.col("tag") == "b").select("page_id", F.col("node_id").alias("b_id"), "text",
                                                 F.explode("path.node_id").alias("node_id"))
    b = b.join(tags.select("page_id", "node_id"), ["page_id", "node_id"], "left_semi")
    return b.groupBy("page_id", "node_id").agg(F.trim(F.min_by("text", "b_id")).alias("value"))


EXTRACTORS: dict[str, tuple[str, Extractor]] = {
    # text of the tag, surrounding white space removed
    "text": ("col", lambda: F.trim(F.col("text"))),
    "raw_text": ("col", lambda: F.col("text")),
    "own_text": ("col", lambda: F.col("own_text")),
    # the style attribute (width bars)
    "width": ("col", lambda: F.col("attrs")["style"]),
    "style": ("col", lambda: F.col("attrs")["style"]),
    # a constant key
    "content": ("col", lambda: F.lit("Content")),
    # text of every child piece after the second one
    "unmarkedtext": ("col", lambda: F.array_join(F.transform(
        F.slice("children", 3, F.greatest(F.size("children") - 2, F.lit(0))), lambda x: x["text"]), "")),
    "bold": ("frame", _bold),
}


def register(name: str, fn: Extractor, frame: bool = False) -> None:
    EXTRACTORS[name] = ("frame" if frame else "col", fn)


#: Rows that a vectorised function sees at once, whatever the session's batch size.
VECTOR_ROWS = 2048


def vectorised(fn: Callable, returns: str) -> Callable[..., Column]:
    """A Column function from ``fn``, which takes Arrow arrays and returns one of the same length and the type
    ``returns``. ``fn`` sees at most ``VECTOR_ROWS`` rows at once; its result must not depend on how rows are
    grouped. Nulls reach it as nulls."""
    import pyarrow as pa

    rows = VECTOR_ROWS

    def run(*arrays: pa.Array) -> pa.Array:
        parts = []
        for lo in range(0, max(len(arrays[0]), 1), rows):
            part = fn(*[a.slice(lo, rows) for a in arrays])
            parts += part.chunks if isinstance(part, pa.ChunkedArray) else [part]
        return pa.concat_arrays(parts)

    run.__annotations__ = {"arrays": pa.Array, "return": pa.Array}   # real types: postponed ones are not seen by Spark
    return F.arrow_udf(run, returnType=returns)


def register_vector(name: str, fn: Callable, columns: Sequence[str] = ("text",), returns: str = "string") -> None:
    """Register a vectorised extractor over node-table columns."""
    EXTRACTORS[name] = ("col", lambda: vectorised(fn, returns)(*[F.col(c) for c in columns]))


def slug(texts):
    """Lower-case words joined by hyphens, without accents and other characters."""
    import pyarrow.compute as pc

    plain = pc.replace_substring_regex(pc.utf8_normalize(texts, form="NFKD"), r"\p{Mn}+", "")
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(plain), r"[^a-z0-9]+", "-"), "-")


register_vector("slug", slug)


def constant(value: str) -> str:
    """Register (idempotently) and return the name of a constant extractor."""
    name = f"const:{value}"
    EXTRACTORS.setdefault(name, ("col", lambda v=value: F.lit(v)))
    return name


def kind(name: str) -> str:
    """``col`` (a Column over the node itself) or ``frame`` (needs other nodes)."""
    try:
        return EXTRACTORS[name][0]
    except KeyError:
        raise ValueError(f"unknown extraction function {name!r}") from None


def column(name: str) -> Column:
    """The Column of a ``col`` extractor."""
    return EXTRACTORS[name][1]()


def apply(name: str, tags: DataFrame, nodes: DataFrame, out: str) -> DataFrame:
    """``tags`` with a new column ``out`` holding the extracted value."""
    if kind(name) == "col":
        return tags.withColumn(out, column(name))
    vals = EXTRACTORS[name][1](tags, nodes).withColumnRenamed("value", out)
    return tags.join(vals, ["page_id", "node_id"], "left")
