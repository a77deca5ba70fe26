"""Adaptive quality rules: thresholds from mergeable quantile sketches per language and source.

Fixed base rules fail a document of fewer than ``MIN_WORDS`` words, or one in which more than a fifth
of the words lie in five-word windows found twice or more. For the other rules nothing is fixed: each
measure of a document is held against the fence of its own language and source, which lies ``REACH`` spreads
beyond an upper quantile (and, for word length, below a lower one). A spread is the distance of that quantile
from the median; where a group's documents are all alike it is the least step that the measure can make there: one
symbol or a quarter of a line in a document of the group's median length, or the width of a sketch bucket. No
document fails a share for ``REACH`` symbols or repeated lines or fewer.

The sketch of a measure is a table of counts over logarithmic buckets (exact to 64, then 32 buckets
for each power of two, a relative error of 3 %), of the documents that pass the base rules. Sketches merge by
adding counts, so partial aggregation builds them, and the sketches of a language's sources added up are
the language's own. A source's quantiles come from its own sketch with the language's added to it at the
weight of ``PULL`` documents for each document of the source that fails the base rules, and for each that it
lacks to ``MIN_GROUP``: a small source is judged like its language, and a source full of junk cannot lift its own
fences. A language with fewer than ``MIN_GROUP`` documents lends the sum of all instead.

Cases: a null or empty text has no words and fails; null languages and sources are groups of their
own; repeated rows are judged each by itself; very long texts are measured whole; an empty table gives an
empty result. Columns named ``__q_*`` are reserved; all others pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import query, read_table, written
from tessera.llm.lines import SPACE

MIN_WORDS = 10
MIN_GROUP = 100
REACH = 6
PULL = 10

#: measure: (SQL over the base columns, upper quantile, fence below as well, least spread, count that a share is of).
#: ``median``, ``words`` and ``lines`` are the group's medians of the measure and of the documents' lengths.
MEASURES = {
    "symbols": ("1000 * n_symbols div n_words", 0.9, False, "1000 div greatest(words, 1)", "n_symbols"),
    "word_length": ("100 * word_chars div n_words", 0.9, True, "median div 32", None),
    "dup_lines": ("1000 * n_dup_lines div n_lines", 0.95, False, "250 div greatest(lines, 1)", "n_dup_lines"),
}
#: Sketched too, for their medians.
SIZES = {"words": "n_words", "lines": "n_lines"}

# count of words in windows found twice or more, from the array of window hashes; only evaluated
# where a hash repeats. transform(array(x), v -> f(v))[0] binds x to v once.
_REPEATED = """
transform(array(sort_array(transform(__q_win, (h, i) -> struct(h, i)))), z ->
  transform(array(sort_array(transform(
      filter(z, (x, i) -> (i > 0 and z[i - 1].h = x.h) or (i + 1 < size(z) and z[i + 1].h = x.h)), x -> x.i))), p ->
    aggregate(sequence(0, size(p) - 2), 5, (n, i) -> n + least(5, p[i + 1] - p[i])))[0])[0]
"""


def base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words as ``__q_*`` columns."""
    t = docs.withColumn("__q_text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    t = t.withColumn("__q_trim", F.btrim("__q_text", F.lit(SPACE)))
    t = t.withColumn("__q_list", F.when(F.col("__q_trim") == "", F.expr("cast(array() as array<string>)"))
                     .otherwise(F.split("__q_trim", "[ \\x09-\\x0D]+")))
    t = t.withColumns({
        "__q_words": F.size("__q_list").cast("bigint"),
        "__q_chars": F.char_length(F.array_join("__q_list", "")).cast("bigint"),
        "__q_hash": F.expr("transform(__q_list, w -> xxhash64(w))"),
        "__q_symbols": (F.char_length("__q_text") - F.char_length(F.regexp_replace("__q_text", "[#*$%&|<>]", ""))).cast("bigint"),
        "__q_full": F.filter(F.split("__q_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
    })
    t = t.withColumns({
        "__q_win": F.expr("case when size(__q_hash) < 5 then cast(array() as array<bigint>) else transform(sequence(0, size(__q_hash) - 5), "
                          "i -> xxhash64(__q_hash[i], __q_hash[i + 1], __q_hash[i + 2], __q_hash[i + 3], __q_hash[i + 4])) end"),
        "__q_lines": F.size("__q_full").cast("bigint"),
        "__q_dups": (F.size("__q_full") - F.size(F.array_distinct("__q_full"))).cast("bigint"),
    })
    t = t.withColumn("__q_repeat", F.expr(f"case when size(array_distinct(__q_win)) < size(__q_win) then {_REPEATED} else 0 end").cast("bigint"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return t.select(*keep, "__q_words", "__q_chars", "__q_symbols", "__q_lines", "__q_dups", "__q_repeat")


def bucket(x: str) -> str:
    """SQL for the sketch bucket of a non-negative integer."""
    return f"greatest(length(bin({x})) - 6, 0) * 32 + shiftright({x}, cast(greatest(length(bin({x})) - 6, 0) as int))"


def lower_end(b: str) -> str:
    """SQL for the smallest value of a bucket."""
    return f"case when {b} < 64 then {b} else shiftleft({b} - ({b} div 32 - 1) * 32, cast({b} div 32 - 1 as int)) end"


def sketches(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """Bucket counts (lang, source, measure, bucket, n) of the documents that pass the base rules."""
    per = ", ".join(f"struct('{m}' as measure, {bucket(f'__q_m_{m}')} as bucket)" for m in (*MEASURES, *SIZES))
    return (measured.where("not __q_failed")
            .select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.explode(F.expr(f"array({per})")).alias("m"))
            .groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n")))


def fences(sketch: DataFrame, failed: DataFrame) -> DataFrame:
    """(lang, source, measure, low, high) from the sketches of the groups; ``failed`` (lang, source, failed, passed)
    counts their documents that fail and pass the base rules, for all groups."""
    merged = lambda *keys: sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    total = lambda df, *keys: df.withColumn("total", F.sum("n").over(Window.partitionBy(*keys, "measure")))
    langs = total(merged("lang"), "lang")
    every = total(merged())
    # what a language lends: its own sketch, or the sum of all
    small = langs.groupBy("lang", "measure").agg(F.max("total").alias("held"))
    names = F.explode(F.array(*[F.lit(m) for m in (*MEASURES, *SIZES)])).alias("measure")
    wanted = failed.select("lang").distinct().select("lang", names)
    wanted = wanted.alias("k").join(small.alias("s"), F.expr("k.lang <=> s.lang and k.measure = s.measure"), "left").select("k.lang", "k.measure", "held")
    own_lang = wanted.where(f"held >= {MIN_GROUP}").alias("w").join(langs.alias("l"), F.expr("w.lang <=> l.lang and w.measure = l.measure"))
    no_lang = wanted.where(f"held is null or held < {MIN_GROUP}").alias("w").join(every.alias("l"), F.expr("w.measure = l.measure"))
    lent = own_lang.select("w.lang", "w.measure", "l.bucket", "l.n", "l.total").unionByName(no_lang.select("w.lang", "w.measure", "l.bucket", "l.n", "l.total"))
    own = total(sketch, "lang", "source")
    base = failed.alias("f").join(lent.alias("l"), F.expr("f.lang <=> l.lang")).select(
        "f.lang", "f.source", "l.measure", "l.bucket", (F.lit(float(PULL)) * (F.col("f.failed") + F.greatest(MIN_GROUP - F.col("f.passed"), F.lit(0)))).alias("weight"),
        F.col("l.n").alias("lent"), F.col("l.total").alias("lent_of"))
    both = base.alias("b").join(own.alias("o"), F.expr("b.lang <=> o.lang and b.source <=> o.source and b.measure = o.measure and b.bucket = o.bucket"), "full").select(
        *[F.coalesce(F.col(f"b.{c}"), F.col(f"o.{c}")).alias(c) for c in ("lang", "source", "measure", "bucket")], "weight",
        F.coalesce("lent", F.lit(0)).alias("lent"), "lent_of", F.coalesce("n", F.lit(0)).alias("n"))
    group = Window.partitionBy("lang", "source", "measure")
    run = group.orderBy("bucket")
    both = both.withColumns({"weight": F.max("weight").over(group), "lent_of": F.max("lent_of").over(group), "of": F.sum("n").over(group),
                             "lent_cum": F.sum("lent").over(run), "cum": F.sum("n").over(run)})
    share = (F.col("cum") + F.col("weight") * (F.col("lent_cum") / F.col("lent_of"))) / (F.col("of") + F.col("weight"))
    upper = F.expr("case measure " + " ".join(f"when '{m}' then {u}D" for m, (_, u, *_) in MEASURES.items()) + " else 0.5D end")
    # shares are sums of two roundings: a millionth is less than any document's weight in a group that decides
    at = lambda q: F.min(F.when(F.col("share") >= q - F.lit(1e-6), F.col("bucket")))
    q = both.withColumn("share", share).groupBy("lang", "source", "measure").agg(at(F.lit(0.5)).alias("b5"), at(upper).alias("bu"), at(F.lit(1.0) - upper).alias("bl"))
    q = q.select("lang", "source", "measure", *[F.expr(lower_end(b)).alias(c) for b, c in (("b5", "median"), ("bu", "above"), ("bl", "below"))])
    sizes = q.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m, F.col("median"))).alias(m) for m in SIZES])
    q = q.where(F.col("measure").isin(*MEASURES)).alias("q").join(sizes.alias("z"), F.expr("q.lang <=> z.lang and q.source <=> z.source")).select("q.*", *SIZES)
    step = F.expr("case measure " + " ".join(f"when '{m}' then {g}" for m, (_, _, _, g, _) in MEASURES.items()) + " end")
    two = F.col("measure").isin([m for m, (_, _, both_, _, _) in MEASURES.items() if both_])
    return q.select("lang", "source", "measure", F.when(two, F.col("below") - REACH * F.greatest(F.col("median") - F.col("below"), step)).alias("low"),
                    (F.col("above") + REACH * F.greatest(F.col("above") - F.col("median"), step)).alias("high"))


def judge(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` without its text, with the base columns, ``__q_failed`` (base rules) and ``__q_kept``."""
    t = base_measures(docs, text)
    failed = (F.col("__q_words") < MIN_WORDS) | (100 * F.col("__q_repeat") > 20 * F.col("__q_words"))
    names = {"n_words": "__q_words", "word_chars": "__q_chars", "n_symbols": "__q_symbols", "n_lines": "__q_lines", "n_dup_lines": "__q_dups"}
    t = t.withColumn("__q_failed", failed)
    for m, sql in {**{m: sql for m, (sql, *_) in MEASURES.items()}, **SIZES}.items():
        for name, column in names.items():
            sql = sql.replace(name, column)
        t = t.withColumn(f"__q_m_{m}", F.when(F.col("__q_words") > 0, F.expr(sql)))
    t = written(t, "measures")
    counts = written(t.groupBy(F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source")).agg(
        F.sum(F.col("__q_failed").cast("bigint")).alias("failed"), F.sum((~F.col("__q_failed")).cast("bigint")).alias("passed")), "groups")
    marks = fences(written(sketches(t, lang, source), "sketches"), counts)
    wide = marks.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m, F.col(s))).alias(f"__q_{m}_{s}")
                                                 for m in MEASURES for s in ("low", "high")])
    wide = written(wide.withColumnsRenamed({"lang": "__q_lang", "source": "__q_source"}), "fences")
    j = t.join(wide, F.col(f"`{lang}`").eqNullSafe(F.col("__q_lang")) & F.col(f"`{source}`").eqNullSafe(F.col("__q_source")), "left")
    inside = F.lit(True)
    for m, (_, _, _, _, count) in MEASURES.items():
        over = F.col(f"__q_m_{m}") > F.col(f"__q_{m}_high")
        if count:
            over = over & (F.col(names[count]) > REACH)
        inside = inside & ~F.coalesce(over, F.lit(False)) & F.coalesce(F.col(f"__q_m_{m}") >= F.col(f"__q_{m}_low"), F.lit(True))
    return j.withColumn("__q_kept", ~F.col("__q_failed") & inside)


def keep_good(docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang",  # noqa: A002
              source: str = "source") -> DataFrame:
    """``docs`` without the rows that the rules reject (matched by id, text, language and source)."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in (id, text, lang, source)])
    judged = judge(docs.select(F.col(f"`{id}`").alias("__q_id"), mark.alias("__q_mark"), F.col(f"`{text}`"), F.col(f"`{lang}`"), F.col(f"`{source}`")),
                   text=text, lang=lang, source=source)
    gone = written(judged.where(~F.col("__q_kept")).select(F.col("__q_id").alias("__q_gone"), F.col("__q_mark").alias("__q_gone_mark")).distinct(), "rejected")
    rows = docs.withColumn("__q_mark", mark)
    # planned as a shuffle at every size, as the rejected rows grow with the input
    return rows.join(gone.hint("merge"), (F.col("__q_mark") == F.col("__q_gone_mark")) & F.col(f"`{id}`").eqNullSafe(F.col("__q_gone")), "left_anti").drop("__q_mark")


def _cases(values: dict) -> str:
    return "CASE measure " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in values.items())


_LONG = " UNION ALL ".join(f"SELECT lang, source, '{m}' measure, {sql.replace('div', '//')} x FROM ok"
                           for m, sql in {**{m: sql for m, (sql, *_) in MEASURES.items()}, **SIZES}.items())
_UPPER = _cases({m: f"CAST({u} AS DOUBLE)" for m, (_, u, *_) in MEASURES.items()}) + " ELSE CAST(0.5 AS DOUBLE) END"
_STEP = _cases({m: g.replace("div", "//") for m, (_, _, _, g, _) in MEASURES.items()}) + " END"
_OVER = " OR ".join(f"(x_{m} > high_{m}{f' AND {c} > {REACH}' if c else ''})" for m, (_, _, _, _, c) in MEASURES.items())
_UNDER = " OR ".join(f"x_{m} < low_{m}" for m, (_, _, both, _, _) in MEASURES.items() if both)
_NAMES = "SELECT unnest([" + ", ".join(f"'{m}'" for m in (*MEASURES, *SIZES)) + "]) measure"


def _low(b: str) -> str:
    return f"CASE WHEN {b} < 64 THEN {b} ELSE ({b} - ({b} // 32 - 1) * 32) << ({b} // 32 - 1) END"


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
u AS (SELECT doc_id, unnest(w) x, generate_subscripts(w, 1) i FROM d),
v AS (
  SELECT doc_id, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o k
  FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i FROM v WHERE k IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(*) n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) p FROM g) GROUP BY 1),
ln AS (
  SELECT doc_id, count(*) n, count(DISTINCT l) u FROM (SELECT doc_id, unnest(string_split(t, chr(10))) l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
b AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) n_words, CAST(length(array_to_string(w, '')) AS BIGINT) word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) n_symbols, coalesce(ln.n, 0) n_lines,
    coalesce(ln.n - ln.u, 0) n_dup_lines, coalesce(rep.n, 0) n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)),
j AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words failed FROM b),
ok AS (SELECT * FROM j WHERE NOT failed),
grp AS (SELECT lang, source, CAST(sum(CAST(failed AS BIGINT)) AS BIGINT) failed, CAST(sum(CAST(NOT failed AS BIGINT)) AS BIGINT) passed FROM j GROUP BY lang, source),
s AS (SELECT lang, source, measure, greatest(length(bin(x)) - 6, 0) * 32 + (x >> greatest(length(bin(x)) - 6, 0)) bucket, CAST(count(*) AS BIGINT) n
      FROM ({_LONG}) GROUP BY ALL),
own AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure) total FROM s),
lg AS (SELECT *, sum(n) OVER (PARTITION BY lang, measure) total FROM (SELECT lang, measure, bucket, sum(n) n FROM s GROUP BY ALL)),
al AS (SELECT *, sum(n) OVER (PARTITION BY measure) total FROM (SELECT measure, bucket, sum(n) n FROM s GROUP BY ALL)),
want AS (
  SELECT k.lang, k.measure, max(lg.total) held FROM (SELECT * FROM (SELECT DISTINCT lang FROM grp), ({_NAMES})) k
  LEFT JOIN lg ON lg.lang IS NOT DISTINCT FROM k.lang AND lg.measure = k.measure GROUP BY k.lang, k.measure),
lent AS (
  SELECT w.lang, w.measure, lg.bucket, lg.n, lg.total FROM want w JOIN lg ON w.lang IS NOT DISTINCT FROM lg.lang AND w.measure = lg.measure WHERE held >= {MIN_GROUP}
  UNION ALL SELECT w.lang, w.measure, al.bucket, al.n, al.total FROM want w JOIN al ON w.measure = al.measure WHERE held IS NULL OR held < {MIN_GROUP}),
base AS (
  SELECT g.lang, g.source, l.measure, l.bucket, CAST({PULL} AS DOUBLE) * (g.failed + greatest({MIN_GROUP} - g.passed, 0)) weight, l.n lent, l.total lent_of
  FROM grp g JOIN lent l ON g.lang IS NOT DISTINCT FROM l.lang),
pairs AS (
  SELECT coalesce(b.lang, o.lang) lang, coalesce(b.source, o.source) source, coalesce(b.measure, o.measure) measure, coalesce(b.bucket, o.bucket) bucket,
    weight, coalesce(lent, 0) lent, lent_of, coalesce(o.n, 0) n
  FROM base b FULL JOIN own o ON b.lang IS NOT DISTINCT FROM o.lang AND b.source IS NOT DISTINCT FROM o.source AND b.measure = o.measure AND b.bucket = o.bucket),
cum AS (
  SELECT lang, source, measure, bucket, {_UPPER} u,
    (sum(n) OVER r + max(weight) OVER g * (CAST(sum(lent) OVER r AS DOUBLE) / max(lent_of) OVER g)) / (sum(n) OVER g + max(weight) OVER g) share
  FROM pairs WINDOW g AS (PARTITION BY lang, source, measure), r AS (PARTITION BY lang, source, measure ORDER BY bucket)),
qb AS (
  SELECT lang, source, measure, min(bucket) FILTER (share >= 0.5 - 1e-6) b5, min(bucket) FILTER (share >= u - 1e-6) bu, min(bucket) FILTER (share >= 1 - u - 1e-6) bl
  FROM cum GROUP BY lang, source, measure),
qv AS (SELECT lang, source, measure, {_low("b5")} median, {_low("bu")} above, {_low("bl")} below FROM qb),
sz AS (SELECT lang, source, {", ".join(f"max(median) FILTER (measure = '{m}') {m}" for m in SIZES)} FROM qv GROUP BY lang, source),
f AS (
  SELECT lang, source, measure, below - {REACH} * greatest(median - below, step) low, above + {REACH} * greatest(above - median, step) high
  FROM (SELECT qv.*, {_STEP} step FROM qv JOIN sz ON qv.lang IS NOT DISTINCT FROM sz.lang AND qv.source IS NOT DISTINCT FROM sz.source)),
fw AS (SELECT lang, source, {", ".join(f"max({c}) FILTER (measure = '{m}') {c}_{m}" for m in MEASURES for c in ("low", "high"))} FROM f GROUP BY lang, source),
x AS (SELECT *, {", ".join(f"CASE WHEN n_words > 0 THEN {sql.replace('div', '//')} END x_{m}" for m, (sql, *_) in MEASURES.items())} FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed base_failed, NOT failed AND NOT coalesce({_OVER}, false) AND NOT coalesce({_UNDER}, false) kept
FROM x LEFT JOIN fw ON x.lang IS NOT DISTINCT FROM fw.lang AND x.source IS NOT DISTINCT FROM fw.source
"""


@query("op9_adaptive_quality", ORACLE)
def op9_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the base rules and the fences of their language and source."""
    found = judge(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", F.col("__q_words").alias("n_words"), F.col("__q_chars").alias("word_chars"),
                        F.col("__q_symbols").alias("n_symbols"), F.col("__q_dups").alias("n_dup_lines"),
                        F.col("__q_repeat").alias("n_repeat_words"), F.col("__q_failed").alias("base_failed"),
                        F.col("__q_kept").alias("kept"))
