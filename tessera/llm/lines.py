"""Line de-duplication: lines found in several documents stay in the document with the smallest id.

A line's key is the line without surrounding ASCII white space and with A-Z lower-cased. Keys of at
least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines except
in the smallest id holding them. Lines are exploded and hashed (128 bits), documents are counted for
each hash with partial aggregation, and the lines to drop come back to their document as positions.

Cases: a null or empty text is one empty line; a null id counts as the largest id, and rows with one
id are one document; repeated rows are reassembled each by itself; empty tables give empty results.
Columns named ``__ld_*`` are reserved; all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import query, read_table, written

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = (1 << 63) - 1


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` does just that where all characters are ASCII)."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def mark_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_chars: int = 10,  # noqa: A002
               min_docs: int = 2) -> DataFrame:
    """``docs`` with the text without its dropped lines, ``__ld_lines`` (lines before) and ``__ld_dropped``."""
    given = docs.withColumns({"__ld_text": F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")),
                              "__ld_id": F.coalesce(F.col(f"`{id}`").cast("bigint"), F.lit(_LAST))})
    given = given.withColumn("__ld_hash", F.xxhash64("__ld_text"))
    lines = given.select("__ld_id", "__ld_hash", F.posexplode(F.split("__ld_text", "\n")).alias("__ld_pos", "line"))
    lines = lines.withColumn("key", ascii_lower(F.btrim("line", F.lit(SPACE))))
    lines = written(lines.where(F.char_length("key") >= min_chars)
                    .select("__ld_id", "__ld_hash", "__ld_pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2")), "lines")
    if min_docs <= 2:
        found = lines.groupBy("k1", "k2").agg(F.min("__ld_id").alias("first"), F.max("__ld_id").alias("last")).where("first < last")
    else:
        found = (lines.select("k1", "k2", "__ld_id").distinct().groupBy("k1", "k2")
                 .agg(F.min("__ld_id").alias("first"), F.count("*").alias("n")).where(F.col("n") >= min_docs))
    found = written(found.select("k1", "k2", "first"), "shared_lines")
    dropped = (lines.join(found, ["k1", "k2"]).where("__ld_id <> first")
               .groupBy("__ld_id", "__ld_hash").agg(F.collect_set("__ld_pos").alias("__ld_gone")))
    out = given.join(dropped, ["__ld_id", "__ld_hash"], "left").withColumn("__ld_split", F.split("__ld_text", "\n"))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(__ld_split) - 1), __ld_gone), i -> __ld_split[i]), '\n')")
    return out.select(
        *[F.when(F.col("__ld_gone").isNull(), F.col(f"`{text}`").cast("string")).otherwise(kept).alias(text) if c == text else F.col(f"`{c}`")
          for c in docs.columns],
        F.size("__ld_split").cast("bigint").alias("__ld_lines"),
        F.coalesce(F.size("__ld_gone"), F.lit(0)).cast("bigint").alias("__ld_dropped"))


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its repeated lines dropped (a document that loses all lines stays with an empty text)."""
    return mark_lines(docs, **options).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) p
  FROM documents),
k AS (SELECT doc_id, p, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') key FROM l),
shared AS (SELECT key, min(doc_id) f FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, p, line, shared.f IS NOT NULL AND k.doc_id <> shared.f gone FROM k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) kept_sha256
FROM m GROUP BY doc_id
"""


@query("op4_line_dedup", ORACLE)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of all documents held against all others."""
    found = mark_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("__ld_lines").alias("n_lines"), F.col("__ld_dropped").alias("n_dropped"),
                        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
