"""URL filters that change over time: dated list entries, evaluated at each capture's fetch time.

An entry adds a key to a list or takes it off at a moment. A key is a host (it covers its subdomains)
or a host with a path prefix of whole segments, read as captures are: the host in lower case without
a dot at its end, the path without empty segments. Entries become validity intervals, from each moment
to the next one of their list and key; moments at which a key is both added and taken off take it
off. A capture asks for its host, the host's parent domains down to one label and its path prefixes; for each an as-of
join finds the interval at the fetch time. Of the active entries the longest key decides, and an
``allow`` entry before any other of the same key.

Keys asked by more than one capture in ``SHARES`` are counted first (there are fewer than ``SHARES`` times the keys of a
capture of them, whatever the input). Those that no list names, such as most top-level domains, are not asked at all;
the others are dealt out, their entries copied to as many parts as they have shares, so that no window holds more
than a share of the questions. All other questions meet the entries' keys before the as-of join.

Cases: captures without URL or time, and URLs without a host, match nothing and are kept unblocked;
URLs may lack the scheme, and the slashes too where the host has a dot; repeated captures are
evaluated each by itself; entries with a null part or without a host are ignored; empty lists block
nothing. Columns named ``__u_*`` are reserved; other columns of the captures are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.asof import last_fact, with_next
from tessera.llm.common import query, read_table, written
from tessera.llm.lines import LOWER, UPPER

HOUR = 3_600_000_000
DAY = 24 * HOUR                                              # microseconds

SHARES = 1000

#: Host of a URL: scheme, user part and port left out.
HOST = (r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?|(?=(?:[^/?#:@\s.]+\.)+[^/?#:@\s.]*(?::[0-9]*)?(?:[/?#]|$)))"
        r"([^/?#:]+)")
PATH = r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?+[^/?#]*/([^?#]*)"


def _host(h):
    return F.regexp_replace(F.translate(h, UPPER, LOWER), "[.]+$", "")


def url_host(url):
    return _host(F.regexp_extract(url, HOST, 1))


# Keys under which a list may name a URL, from its host ``h`` and path ``p``: the host, its parent
# domains down to the last label, and the host with each of its path prefixes.
_DOMAINS = "transform(sequence(0, size(split(h, '[.]')) - 1), i -> array_join(slice(split(h, '[.]'), i + 1, size(split(h, '[.]'))), '.'))"
_PARTS = "filter(split(p, '/'), x -> x <> '')"
_PATHS = (f"case when size({_PARTS}) = 0 then cast(array() as array<string>) "
          f"else transform(sequence(1, size({_PARTS})), i -> concat(h, '/', array_join(slice({_PARTS}, 1, i), '/'))) end")


def validity(entries: DataFrame, width: int = DAY) -> DataFrame:
    """(list, key, since, until) from entries (list, key, action 'add' or 'remove', at in microseconds)."""
    parts = F.split("key", "/")
    path = F.filter(F.slice(parts, 2, F.size(parts)), lambda x: x != "")
    named = entries.withColumn("key", F.array_join(F.concat(F.array(_host(parts[0])), path), "/"))
    moments = (named.dropna(subset=["list", "key", "action", "at"]).where("key <> '' and key not like '/%'")
               .groupBy("list", "key", "at").agg(F.max(F.col("action") == "remove").alias("off")))
    return (with_next(moments, ["list", "key"], "at", width, "until").where(~F.col("off"))
            .select("list", "key", F.col("at").alias("since"), "until"))


def evaluate(captures: DataFrame, entries: DataFrame, *, id: str = "page_id", url: str = "url",  # noqa: A002
             at: str = "fetched", lists: list[str] | None = None) -> DataFrame:
    """(id, host, n_active, list, key, blocked) of each capture; ``at`` is in microseconds.

    ``lists`` names the lists to ask; without it their names are read from the entries (there are as
    many as there are lists, however many entries they hold).
    """
    if lists is None:
        lists = sorted(r[0] for r in entries.select("list").where("list is not null").distinct().collect())
    rows = captures.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("id"), F.col(f"`{at}`").cast("bigint").alias("at"),
                           F.coalesce(url_host(F.col(f"`{url}`")), F.lit("")).alias("h"),
                           F.coalesce(F.regexp_extract(F.col(f"`{url}`"), PATH, 1), F.lit("")).alias("p"))
    rows = written(rows, "captures")
    asked = rows.where("h <> '' and at is not null").select("row", "at", F.explode(F.expr(f"array_distinct(concat({_DOMAINS}, {_PATHS}))")).alias("key"))
    # a bucket of the as-of joins is a share of the whole time, so a key with a third of all rows is many windows
    times = rows.select("at").unionByName(entries.select(F.col("at").cast("bigint").alias("at"))).agg(F.min("at"), F.max("at")).first()
    width = 1 + (times[1] - times[0]) // SHARES if times[0] is not None else DAY
    spans = written(validity(entries, width).withColumnRenamed("since", "at"), "spans")
    parts = _hot_parts(asked, spans)
    unknown = [k for k, n in parts.items() if not n]
    if unknown:
        asked = asked.where(~F.col("key").isin(unknown))
    asked = asked.withColumn("list", F.explode(F.array(*map(F.lit, lists)).cast("array<string>")))
    asked = asked.join(spans.select("list", "key").distinct(), ["list", "key"], "left_semi")
    split = F.lit(1)
    if held := {k: n for k, n in parts.items() if n}:
        split = F.coalesce(F.create_map(*[F.lit(x) for kv in held.items() for x in kv])[F.col("key")], F.lit(1))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("row"), split).cast("int"))
    spans = spans.withColumn("part", F.explode(F.sequence(F.lit(0), split - 1)))
    found = last_fact(asked, spans, ["list", "key", "part"], "at", width)
    active = found.where(F.col("fact").isNotNull() & (F.col("fact.until").isNull() | (F.col("at") < F.col("fact.until"))))
    best = active.groupBy("row").agg(F.count("*").alias("n"), F.max(F.struct(
        F.length("key").alias("size"), (F.col("list") == "allow").alias("allow"), "list", "key")).alias("best"))
    return rows.join(best, "row", "left").select(
        F.col("id").alias(id), F.col("h").alias("host"), F.coalesce("n", F.lit(0)).alias("n_active"), F.col("best.list").alias("list"),
        F.col("best.key").alias("key"), F.coalesce(~F.col("best.allow"), F.lit(False)).alias("blocked"))


def _hot_parts(asked: DataFrame, spans: DataFrame) -> dict[str, int]:
    """Parts of each key that more than one question in ``SHARES`` asks; 0 for one that no list names."""
    counts = written(asked.groupBy("key").agg(F.count("*").alias("n")), "asked")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * SHARES > total)
    named = spans.select("key").distinct().withColumn("named", F.lit(True))
    return {r.key: -(-r.n * SHARES // total) if r.named else 0 for r in hot.join(named, "key", "left").collect()}


def dated_captures(pages: DataFrame, events: DataFrame) -> DataFrame:
    """``pages`` with the time of the event of the same number as their fetch time, and its type."""
    e = events.select(F.col("event_id").alias("page_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("fetched"), "event_type")
    return pages.select("page_id", "url").join(e, "page_id", "left")


def dated_entries(captures: DataFrame) -> DataFrame:
    """List entries from dated captures, in force an hour after the capture: errors put the host on the
    block list and clicks take it off, sign-ups allow the host's first path segment and views end
    that, purchases put the host on the grey list. Without a first path segment there is no key."""
    segment = F.element_at(F.split(F.regexp_extract("url", PATH, 1), "/"), 1)
    first = F.when(segment != "", F.concat(url_host(F.col("url")), F.lit("/"), segment))
    kind = F.col("event_type")
    return captures.where("event_type is not null").select(
        F.when(kind.isin("error", "click"), "block").when(kind == "purchase", "grey").otherwise("allow").alias("list"),
        F.when(kind.isin("signup", "view"), first).otherwise(url_host(F.col("url"))).alias("key"),
        F.when(kind.isin("click", "view"), "remove").otherwise("add").alias("action"), (F.col("fetched") + HOUR).alias("at"))


_HOST_SQL = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
_PATH_SQL = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1)"
ORACLE = f"""
WITH c AS (
  SELECT page_id, {_HOST_SQL} h, {_PATH_SQL} p, epoch_us(ts) fetched, event_type FROM pages LEFT JOIN events ON event_id = page_id),
e AS (
  SELECT CASE WHEN event_type IN ('error', 'click') THEN 'block' WHEN event_type = 'purchase' THEN 'grey' ELSE 'allow' END list,
    CASE WHEN event_type IN ('signup', 'view') THEN h || '/' || string_split(p, '/')[1] ELSE h END AS key,
    fetched + {HOUR} AS since, bool_or(event_type IN ('click', 'view')) off
  FROM c WHERE event_type IS NOT NULL GROUP BY 1, 2, 3),
parts AS (SELECT page_id, h, fetched, string_split(h, '.') d, list_filter(string_split(p, '/'), lambda x: x <> '') s FROM c WHERE fetched IS NOT NULL AND h <> ''),
k AS (
  SELECT page_id, fetched, array_to_string(d[i + 1:len(d)], '.') AS key FROM (SELECT *, unnest(range(0, greatest(len(d) - 2, 0) + 1)) i FROM parts)
  UNION SELECT page_id, fetched, h || '/' || array_to_string(s[1:i], '/') FROM (SELECT *, unnest(range(1, len(s) + 1)) i FROM parts)),
a AS (
  SELECT k.page_id, k.key, k.list, e.off FROM (SELECT * FROM k, (SELECT DISTINCT list AS list FROM e)) k
  ASOF JOIN e ON k.key = e.key AND k.list = e.list AND k.fetched >= e.since WHERE NOT e.off),
b AS (
  SELECT page_id, count(*) n, arg_max(struct_pack(list := list, key := key), (length(key), list = 'allow', list, key)) best FROM a GROUP BY 1)
SELECT c.page_id, c.h AS host, coalesce(b.n, 0) n_active, best.list AS list, best.key AS key, coalesce(best.list <> 'allow', false) blocked
FROM c LEFT JOIN b USING (page_id)
"""


@query("op7_temporal_url_lists", ORACLE)
def op7_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, fetched at the time of their event, against lists that the same events keep changing."""
    captures = dated_captures(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "events"))
    return evaluate(captures, dated_entries(captures))
