"""Quotation linking: messages that quote each other, to reply-ordered conversations without quotes.

A line's quote level is the number of ``>`` it begins with. Lines of one level that follow each
other form a passage. Passages and the messages' own texts are normalised (ASCII lower case, white
space runs to one space) and hashed; a passage belongs to the last earlier message of its thread
whose own text has the same hash. A passage that is nobody's whole text (a trimmed or interleaved
quote) is looked up among the parts of earlier messages: their own runs between quotes, paragraphs
and lines. The whole passage comes first, then its paragraphs, then its lines; each goes to the last
earlier message that holds it, and the passage to the message with most of its characters (of
several, the latest). The parent of a message is the message behind its shallowest linked passages:
the latest whose whole text is quoted, else the one with most quoted characters. Lines such as
"On ..., ... wrote:" directly before a quote are attributions and go with it. Parents give each
message its root and its depth, by doubling the distance jumped in each round.

Cases: a null or empty text is a message without quotes; identical rows are one message; passages
without a word link to nothing; messages without thread or order are kept, without a parent; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.asof import last_fact
from tessera.llm.common import query, read_table, written
from tessera.llm.lines import LOWER, SPACE, UPPER

_MARKS = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"^\s*(?:On .+ wrote|Am .+ schrieb|Le .+ a écrit|El .+ escribió) ?:\s*$"
ORDER_BUCKET = 1024
_BLANK = r"\n(?:[ \x09\x0B-\x0D]*\n)+"


def _normal(c):
    return F.btrim(F.regexp_replace(F.translate(c, UPPER, LOWER), "[ \\x09-\\x0D]+", " "), F.lit(" "))


def _hash(c):
    return F.sha2(c, 256)


def _key(c):
    """Half of the hash of a normalised text, as bytes."""
    return F.unhex(F.substring(_hash(c), 1, 32))


def _pieces(body):
    """Paragraphs (grain 1) and lines (grain 0) of a text that has several, as array<struct<grain, chars, key>>."""
    def cut(by, grain):
        texts = F.filter(F.transform(F.split(body, by), _normal), lambda t: t != "")
        whole = F.expr("cast(array() as array<struct<grain: int, chars: int, key: binary>>)")
        return F.when(F.size(F.split(body, by)) > 1, F.transform(
            texts, lambda t: F.struct(F.lit(grain).alias("grain"), F.length(t).alias("chars"), _key(t).alias("key")))).otherwise(whole)
    return F.concat(cut(_BLANK, 1), cut("\n", 0))


def _parts(own, runs):
    """Keys of a message's own text, its runs between quotes, their paragraphs and their lines."""
    texts = F.concat(F.array(own), F.coalesce(runs, F.expr("cast(array() as array<string>)")))
    cut = F.flatten(F.transform(texts, lambda t: F.concat(F.array(t), F.split(t, _BLANK), F.split(t, "\n"))))
    return F.transform(F.filter(F.array_distinct(F.transform(cut, _normal)), lambda t: t != ""), _key)


def parse_quotes(messages: DataFrame, *, thread: str = "conv_id", order: str = "turn", text: str = "text") -> DataFrame:
    """(thread, order, mark, own, runs, passages): a row for each message; ``own`` is its text without
    quotes and attributions, ``runs`` its runs where quotes stand between them, ``passages`` an array
    of (run, level, hash, chars, pieces)."""
    rows = messages.select(F.col(f"`{thread}`").alias("thread"), F.col(f"`{order}`").cast("bigint").alias("order"),
                           F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("mark", F.xxhash64("text"))
    lines = rows.select("thread", "order", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("level", F.length(F.regexp_replace(F.regexp_extract("line", _MARKS, 0), "[^>]", "")))
    # one message's lines are one window, never more
    message = Window.partitionBy("thread", "order", "mark").orderBy("pos")
    body = F.when(F.col("level") > 0, F.regexp_replace(F.regexp_replace("line", _MARKS, ""), "^ ", "")).otherwise(F.col("line"))
    lines = lines.withColumns({"body": body, "above": F.lag("level", 1, -1).over(message), "below": F.lead("level", 1, 0).over(message)})
    lines = lines.where(~(F.col("body").rlike(ATTRIBUTION) & (F.col("below") > F.col("level"))))
    lines = lines.withColumn("run", F.sum(F.when(F.col("level") != F.coalesce(F.lag("level").over(message), F.lit(-1)), 1).otherwise(0)).over(message))
    runs = lines.groupBy("thread", "order", "mark", "run", "level").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"]), "\n").alias("body"))
    runs = runs.withColumns({"normal": F.when(F.col("level") > 0, _normal(F.col("body"))), "pieces": F.when(F.col("level") > 0, _pieces(F.col("body")))})
    passage = F.struct("run", "level", _hash(F.col("normal")).alias("hash"), F.length("normal").alias("chars"), "pieces")
    parts = runs.groupBy("thread", "order", "mark").agg(
        F.transform(F.sort_array(F.collect_list(F.when(F.col("level") == 0, F.struct("run", "body")))), lambda x: x["body"]).alias("runs"),
        F.sort_array(F.collect_list(F.when(F.col("level") > 0, passage))).alias("passages"))
    parts = parts.withColumns({"own": F.array_join("runs", "\n"), "runs": F.when(F.size("runs") > 1, F.col("runs"))})
    # a message that consists of an attribution alone has lost all its lines
    return (rows.select("thread", "order", "mark").join(parts.withColumnsRenamed({"thread": "t", "order": "o", "mark": "m"}),
            F.expr("thread <=> t and order <=> o and mark = m"), "left")
            .select("thread", "order", "mark", F.btrim(F.coalesce("own", F.lit("")), F.lit(SPACE)).alias("own"), "runs",
                    F.coalesce("passages", F.array().cast(parts.schema["passages"].dataType)).alias("passages")))


def link_quotes(messages: DataFrame, **columns) -> DataFrame:
    """(thread, order, own, n_quotes, n_linked, parent, root, depth) of each message; ``own`` in
    (root, depth, order) is the conversation without quotes."""
    parsed = written(parse_quotes(messages, **columns), "parsed")
    nothing = F.sha2(F.lit(""), 256)
    originals = parsed.select("thread", _hash(_normal(F.col("own"))).alias("hash"), "order").where(F.col("hash") != nothing)
    quoted = parsed.select("thread", "order", "mark", F.explode("passages").alias("q")).select("thread", "order", "mark", "q.*")
    found = last_fact(quoted.where((F.col("hash") != nothing) & F.col("thread").isNotNull() & F.col("order").isNotNull()),
                      originals, ["thread", "hash"], "order", ORDER_BUCKET, strict=True)
    missed = F.col("fact").isNull()
    found = written(found.select("thread", "order", "mark", "run", "level", F.col("fact.order").alias("parent"),
                                 F.when(missed, F.concat(F.array(F.struct(F.lit(2).alias("grain"), F.col("chars"), F.unhex(F.substring("hash", 1, 32)).alias("key"))),
                                                         F.col("pieces"))).alias("pieces")), "found")
    linked = found.where("parent is not null").select("thread", "order", "mark", "level", "parent", F.lit(True).alias("whole"), F.lit(0).alias("chars"))
    missed = found.where("parent is null")
    if missed.limit(1).count():
        pieces = missed.select("thread", "order", "mark", "run", "level", F.explode("pieces").alias("p")).select("thread", "order", "mark", "run", "level", "p.*")
        parts = parsed.select("thread", F.explode(_parts(F.col("own"), F.col("runs"))).alias("key"), "order")
        held = last_fact(pieces, parts, ["thread", "key"], "order", ORDER_BUCKET, strict=True).where("fact is not null")
        passage = ["thread", "order", "mark", "run", "level"]
        held = held.groupBy(*passage, "grain", F.col("fact.order").alias("parent")).agg(F.sum("chars").cast("int").alias("chars"))
        held = held.groupBy(*passage).agg(F.max(F.struct("grain", "chars", "parent")).alias("best"))
        linked = linked.unionByName(held.select("thread", "order", "mark", "level", "best.parent", F.lit(False).alias("whole"), "best.chars"))
    linked = linked.groupBy("thread", "order", "mark", "level", "parent").agg(
        F.count("*").alias("n"), F.max("whole").alias("whole"), F.sum("chars").alias("chars"))
    linked = linked.groupBy("thread", "order", "mark").agg(
        F.sum("n").alias("n_linked"),
        F.max(F.struct((-F.col("level")).alias("near"), "whole", F.when(~F.col("whole"), F.col("chars")).otherwise(0).alias("chars"), "parent"))["parent"].alias("parent"))
    named = linked.withColumnsRenamed({"thread": "t", "order": "o", "mark": "m"})
    state = parsed.join(named, F.expr("thread = t and order = o and mark = m"), "left").select(
        "thread", "order", "own", F.size("passages").cast("bigint").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "parent")
    state = written(state, "replies")
    # ancestor reached so far and its distance; messages of one place in a thread share their parent
    reach = written(state.groupBy("thread", "order").agg(F.max("parent").alias("anc")).withColumn("dist", F.when(F.col("anc").isNotNull(), 1).otherwise(0)), "reach")
    reach = reach.withColumn("open", F.col("anc").isNotNull())
    while reach.where("open").limit(1).count():
        # only messages whose ancestor is not yet known to be a root go on
        up = reach.select(F.col("thread").alias("t"), F.col("order").alias("o"), F.col("anc").alias("up"), F.col("dist").alias("more"))
        jumped = reach.where("open").drop("open").join(up, F.expr("thread = t and anc = o"), "left").select(
            "thread", "order", F.coalesce("up", "anc").alias("anc"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"),
            F.col("up").isNotNull().alias("open"))
        reach = written(reach.where("not open").unionByName(jumped), "reach")
    roots = reach.select(F.col("thread").alias("t"), F.col("order").alias("o"), "anc", "dist")
    return state.join(roots, F.expr("thread <=> t and order <=> o"), "left").select(
        "thread", "order", "own", "n_quotes", "n_linked", "parent", F.coalesce("anc", "order").alias("root"), F.col("dist").cast("bigint").alias("depth"))


def quoted_messages(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` as mail: each quotes the turn before it, and that turn's own quote
    of the turn before at the second level; even turns answer below the quotes, odd turns above."""
    c = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    one = c.select(F.col("conv_id").alias("c1"), (F.col("turn") + 1).alias("t1"), F.col("text").alias("x1"), F.col("role").alias("r1"))
    two = c.select(F.col("conv_id").alias("c2"), (F.col("turn") + 2).alias("t2"), F.col("text").alias("x2"), F.col("role").alias("r2"))
    j = (c.join(one, F.expr("conv_id = c1 and turn = t1"), "left").join(two, F.expr("conv_id = c2 and turn = t2"), "left"))
    quote = lambda x, mark: F.concat(F.lit(mark), F.replace(x, F.lit("\n"), F.lit("\n" + mark)))
    nested = F.when(F.col("x1").isNotNull() & F.col("x2").isNotNull(), F.concat(F.lit("> On turn "), F.col("turn") - 2, F.lit(", the "), "r2", F.lit(" wrote:\n"), quote(F.col("x2"), ">> "), F.lit("\n"))).otherwise("")
    head = F.concat(F.lit("On turn "), F.col("turn") - 1, F.lit(", the "), "r1", F.lit(" wrote:\n"))
    body = F.concat(head, nested, quote(F.col("x1"), "> "))
    text = (F.when(F.col("x1").isNull(), F.col("text")).when(F.col("turn") % 2 == 0, F.concat(body, F.lit("\n\n"), "text"))
            .otherwise(F.concat("text", F.lit("\n\n"), body)))
    return j.select("conv_id", "turn", text.alias("text"))


_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = rf"""
WITH RECURSIVE c AS (
  SELECT DISTINCT conv_id, turn, trim(coalesce(text, ''), {_TRIM}) own FROM conversations),
p AS (
  SELECT c.conv_id, c.turn, c.own, CASE WHEN a.own <> '' THEN a.turn WHEN a.turn IS NOT NULL AND b.own <> '' THEN b.turn END parent,
    CASE WHEN a.turn IS NULL THEN 0 WHEN b.turn IS NULL THEN 1 ELSE 2 END n_quotes,
    CASE WHEN a.turn IS NULL THEN 0 ELSE CAST(a.own <> '' AS INT) + CAST(coalesce(b.own, '') <> '' AS INT) END n_linked
  FROM c LEFT JOIN c a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1 LEFT JOIN c b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2),
r AS (
  SELECT conv_id, turn, turn root, 0 depth FROM p WHERE parent IS NULL
  UNION ALL SELECT p.conv_id, p.turn, r.root, r.depth + 1 FROM p JOIN r ON p.conv_id = r.conv_id AND p.parent = r.turn)
SELECT p.conv_id, p.turn, CAST(p.parent AS BIGINT) parent_turn, CAST(root AS BIGINT) root_turn, CAST(depth AS BIGINT) depth,
  CAST(n_quotes AS BIGINT) n_quotes, CAST(n_linked AS BIGINT) n_linked, sha256(own) own_sha256
FROM p JOIN r USING (conv_id, turn)
"""


@query("op5_quotation_linking", ORACLE)
def op5_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of ``conversations``, written as mail with nested quotes, linked and freed of them."""
    mail = quoted_messages(read_table(spark, sf_dir, "conversations"))
    found = link_quotes(mail)
    return found.select(F.col("thread").alias("conv_id"), F.col("order").alias("turn"), F.col("parent").alias("parent_turn"),
                        F.col("root").alias("root_turn"), "depth", "n_quotes", "n_linked", F.sha2("own", 256).alias("own_sha256"))
