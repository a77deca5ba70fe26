"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs
the votes, and a span classifier trained on the result decides.

Base spans (email, ip, card, phone) follow fixed patterns and always stay. Wider patterns propose
further candidates (``secret``: long runs of letters and digits; ``number``: complete shapes of
phone numbers, social security numbers and dates, else groups of 7 to 19 digits that stop before
such a shape) that no base span overlaps. Five labelers vote +, - or 0 (no opinion) on every candidate:

* pattern: a strict pattern of the kind fits, or its check fails;
* gazetteer: top-level domains, card issuer prefixes, country calling codes, reserved networks;
* context: words for or against the kind shortly before the span;
* edges: against spans that are glued to other characters at an end;
* variety: against spans of very few different characters.

EM estimates one reliability for each labeler and one prior for each kind from the counts of vote
patterns (at most kinds x 3**5 rows, the only thing that reaches the driver). The posteriors are soft
labels for a logistic regression over categorical span features (again a bounded table of counts),
and its score, as an expression in the row, accepts the added spans.

The main path is DataFrame expressions only. Offsets are code points, ends exclusive.

Cases: a null or empty text has no spans; repeated rows are searched each by itself; the work on a very long text
or one of very many matches grows about as these do; an empty table gives an empty result, with untrained weights. Columns named ``__p_*`` are reserved.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import query, read_table, written

KINDS = ("email", "ip", "card", "phone", "secret", "number")
LABELERS = ("pattern", "gazetteer", "context", "edges", "variety")

# The same matches as the plain patterns, written without backtracking: a local part starts behind a
# character that cannot belong to one, or where the match before it ended.
_LOCAL = "A-Za-z0-9._%+-"
# Shapes of complete numbers. Those with signs inside stand for themselves; those of spaces or digits
# alone may be the head of a longer number, so no lone short group of digits may follow them.
_END = r"(?![0-9A-Za-z])(?![.-]{1,2}[0-9])"
_SIGNED = "(?:" + "|".join([
    r"(?:1[.-])?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}", r"\([0-9]{3}\) ?[0-9]{3} [0-9]{4}", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]", "[0-3][0-9][.-][01][0-9][.-](?:19|20)[0-9]{2}",
    r"(?:\(0[0-9]{1,4}\)[ -]?|0[0-9]{1,4}-)[0-9]{5,9}", "0[0-9](?:[.-][0-9]{2}){4}"]) + ")" + _END
_SPACED = "(?:" + "|".join([
    "[0-9]{3} [0-9]{3} [0-9]{4}", "0[0-9]{1,4} [0-9]{5,9}", "0[0-9](?: [0-9]{2}){4}", "02[0-9] [0-9]{4} [0-9]{4}", "0[0-9]{3,4} [0-9]{3} [0-9]{3,4}",
    "[6-9][0-9]{2}(?: [0-9]{3}){2}", "[6-9][0-9]{2}(?: [0-9]{2}){3}", "[0-9]{3}[.-][0-9]{4}", "[0-9]{7,15}"]) + ")" + _END
_ALONE = rf"(?:(?= (?:{_SIGNED}|{_SPACED}))|(?! {{1,2}}[0-9]{{1,4}}(?![0-9.-])))"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
    "number": (rf"(?<![0-9A-Za-z])(?:{_SIGNED}|{_SPACED}{_ALONE}|"
               rf"\(?[0-9](?:(?![ ().-]? {_SIGNED})[ ().-]{{0,2}}[0-9]){{6,18}}(?![0-9A-Za-z]))"),
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_LUHN = ("aggregate(sequence(1, length(d)), 0L, (a, j) -> a + case when j % 2 = 1 then cast(substr(d, -j, 1) as int) "
         "else (2 * cast(substr(d, -j, 1) as int)) div 10 + (2 * cast(substr(d, -j, 1) as int)) % 10 end) % 10 = 0")
#: Which matches count, as SQL over the match ``m`` and its digits ``d``.
VALID = {
    "email": "true",
    "ip": rf"m rlike r'^{_PART}\.{_PART}\.{_PART}\.{_PART}$'",
    "card": f"length(d) between 12 and 19 and {_LUHN}",
    "phone": "length(d) between 9 and 15",
    "secret": "m rlike '[0-9]' and m rlike '[A-Za-z]'",
    "number": "length(d) between 7 and 19",
}
#: A cheap condition on the text without which there is no match.
NEEDS = {"email": "contains(__p_text, '@')", "ip": "__p_digits", "card": "__p_digits", "phone": "contains(__p_text, '+') and __p_digits",
         "secret": "__p_digits", "number": "__p_digits"}

# Fixed lists of the labelers.
DOMAINS = "com|org|net|edu|gov|int|io|info|de|fr|es|uk|it|nl|eu|ch|at|be|pt|pl|us|ca|au|jp|cn|in|br|mx|ar"
ISSUERS = "^(4|5[1-5]|2[2-7]|3[47]|35|6011|62|64|65)"
CALLING = r"^\+(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = r"^(0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CONTEXT = {
    "email": "mail|contact|write|reply|correo|courriel|kontakt",
    "ip": r"\bip\b|host|server|address|login|client|adresse|direcci",
    "card": "card|visa|mastercard|credit|debit|tarjeta|carte|karte",
    "phone": "phone|tel|call|mobile|fax|anruf|appel|llam",
    "secret": "token|secret|key|passw|credential|bearer|auth|api",
    "number": "phone|tel|call|mobile|fax|ssn|passport|account|iban|card|konto|compte|cuenta",
}
AGAINST = r"page|isbn|version|figure|chapter|table|section|volume|license|hash|commit|checksum|\$|€|£"


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


_BLOCK = 64


def _running(values: str, zero: str, op: str) -> str:
    """SQL for the running results (first, first op second, ...) of an array. ``op`` joins ``a`` and ``v``.

    Sums are taken inside blocks of ``_BLOCK`` and over whole blocks, so the work is about n * 64 + (n / 64) ** 2, where
    growing an array inside a fold would copy it n times.
    """
    fold = lambda part: f"aggregate({part}, {zero}, (a, v) -> {op})"
    inside = f"transform(sequence(1, least({_BLOCK}, size(w) - b * {_BLOCK})), i -> aggregate(slice(w, b * {_BLOCK} + 1, i), h[b], (a, v) -> {op}))"
    blocks = f"transform(sequence(0, (size(w) - 1) div {_BLOCK}), b -> {fold(f'slice(w, b * {_BLOCK} + 1, {_BLOCK})')})"
    heads = f"transform(k, (z, b) -> {fold('slice(k, 1, b)')})"
    body = _let("k", blocks, _let("h", heads, f"flatten(transform(h, (z, b) -> {inside}))"))
    return _let("w", values, f"case when size(w) = 0 then cast(array() as array<int>) else {body} end")


def _spans(kind: str) -> str:
    """SQL for the valid matches of a kind in __p_text as array<struct<s, e, m, l, r>>.

    Positions are running lengths of the text between the matches (``split``) and of the matches. ``l`` is what
    stands before a match: up to 32 characters of the text between it and the match before the last; ``r`` is
    the character behind it. Both come from the pieces, as a substring of a long text is found by walking it.
    """
    regex = f"r\"{PATTERNS[kind]}\""
    valid = _let("m", "x[i]", _let("d", _DIGITS, VALID[kind]))
    before = "lower(right(concat(case when i > 0 then concat(right(p[i - 1], 32), right(x[i - 1], 32)) else '' end, right(p[i], 32)), 32))"
    after = "case when p[i + 1] <> '' then left(p[i + 1], 1) when i + 1 < size(x) then left(x[i + 1], 1) else '' end"
    empty = "cast(array() as array<struct<s: int, e: int, m: string, l: string, r: string>>)"
    ends = _running("transform(x, (m, i) -> length(p[i]) + length(m))", "0", "a + v")
    body = (f"case when size(x) = 0 then {empty} else " + _let("c", ends, (
        f"transform(filter(sequence(0, size(x) - 1), i -> {valid}), i -> struct(c[i] - length(x[i]) as s, c[i] as e, x[i] as m, {before} as l, {after} as r))")) + " end")
    found = _let("x", f"regexp_extract_all(__p_text, {regex}, 0)", _let("p", f"split(__p_text, {regex})", body))
    return f"case when {NEEDS[kind]} then {found} else {empty} end"


def _clear(kind: str) -> str:
    """SQL for the spans of a kind that no base span overlaps, by one sorted pass over both: the furthest end of the
    base spans that begin no later, and the first begin of one that begins later."""
    both = (f"sort_array(concat(transform(__p_all, b -> struct(b.s as at, 0 as own, b.e as e, -1 as i)), "
            f"transform(__p_{kind}, (x, i) -> struct(x.s as at, 1 as own, x.e as e, i as i))))")
    ends = _running("transform(z, y -> case when y.own = 0 then y.e else 0 end)", "0", "greatest(a, v)")
    begins = _running("reverse(transform(z, y -> case when y.own = 0 then y.at else 2147483647 end))", "2147483647", "least(a, v)")
    kept = _let("z", both, _let("f", ends, _let("g", f"reverse({begins})", (
        "transform(filter(sequence(0, size(z) - 1), j -> z[j].own = 1 and f[j] <= z[j].at and g[j] >= z[j].e), j -> z[j].i)"))))
    return f"case when size(__p_{kind}) = 0 or size(__p_all) = 0 then __p_{kind} else {_let('o', kept, f'transform(o, i -> __p_{kind}[i])')} end"


def _vote(plus: str, minus: str) -> str:
    return f"case when {plus} then '+' when {minus} then '-' else '0' end"


def _votes(kind: str) -> str:
    """SQL for the five votes on a candidate with match ``m``, digits ``d``, text before ``l`` and after ``r``."""
    pattern = {
        "secret": _vote("m rlike '^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$' or (m rlike '[0-9].*[0-9].*[0-9]' and m rlike '[a-z]' and m rlike '[A-Z]')", "m rlike '[/_-].*[/_-].*[/_-]'"),
        "number": _vote(r"m rlike r'^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$' or m rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'", "length(d) >= 12"),
    }.get(kind, "'+'")
    gazetteer = {
        "email": _vote(rf"lower(m) rlike r'\.({DOMAINS})$'", "true"),
        "ip": _vote("false", f"m rlike r'{RESERVED}'"),
        "card": _vote(f"d rlike '{ISSUERS}'", "true"),
        "phone": _vote(f"m rlike r'{CALLING}'", "true"),
        "secret": "'0'",
        "number": _vote("false", "length(d) >= 13"),
    }[kind]
    context = _vote(f"l rlike r'{CONTEXT[kind]}'", f"l rlike r'{AGAINST}'")
    edges = _vote("false", r"not ((l = '' or l rlike r'[\s\"(\[<:=,;|]$') and (r = '' or r rlike r'^[\s\")\]>,;.!?*#%&$|]'))")
    variety = _let("n", "size(array_distinct(split(lower(m), '')))", _vote("false", f"n <= {'6' if kind == 'secret' else '2'}"))
    return f"concat({pattern}, {gazetteer}, {context}, {edges}, {variety})"


def _features(kind: str) -> str:
    """SQL for the categorical features of a candidate, each a short string."""
    return ("array("
            f"'{kind}', concat('{kind}:length', least(length(m) div 6, 8)), "
            f"concat('{kind}:set', case when m rlike '^[0-9]+$' then 'digits' when m rlike '^[0-9a-f]+$' then 'hex' when m rlike '^[0-9A-Za-z]+$' then 'alnum' else 'mixed' end), "
            f"concat('{kind}:before', case when l = '' then 'none' when l rlike '[0-9A-Za-z]$' then 'word' when l rlike '[ ]$' then 'space' else 'mark' end), "
            f"concat('{kind}:after', case when r = '' then 'none' when r rlike '^[0-9A-Za-z]' then 'word' when r rlike '^[ ]' then 'space' else 'mark' end), "
            f"concat('{kind}:context', {_vote(f'l rlike r{chr(39)}{CONTEXT[kind]}{chr(39)}', f'l rlike r{chr(39)}{AGAINST}{chr(39)}')}))")


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``__p_base`` (base spans) and ``__p_found`` (all candidates)."""
    t = docs.withColumn("__p_text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    t = t.withColumn("__p_digits", F.expr("__p_text rlike '[0-9]'"))
    for kind in KINDS:
        t = t.withColumn(f"__p_{kind}", F.expr(_spans(kind)))
    base = ", ".join(f"__p_{k}" for k in KINDS[:4])
    t = t.withColumn("__p_all", F.expr(f"transform(concat({base}), x -> struct(x.s, x.e))"))
    for kind in KINDS[4:]:
        t = t.withColumn(f"__p_{kind}", F.expr(_clear(kind)))
    found = []
    for n, kind in enumerate(KINDS):
        body = f"struct({n} as kind, x.s as s, x.e as e, {_votes(kind)} as votes, {_features(kind)} as features)"
        window = _let("m", "x.m", _let("d", _DIGITS, _let("l", "x.l", _let("r", "x.r", body))))
        found.append(f"transform(__p_{kind}, x -> {window})")
    t = t.withColumn("__p_found", F.expr(f"concat({', '.join(found)})"))
    return t.select(*[F.col(f"`{c}`") for c in docs.columns if c != text],
                    *[F.size(f"__p_{k}").cast("bigint").alias(f"__p_n_{k}") for k in KINDS[:4]], "__p_found")


def vote_model(counts: list[tuple[int, str, int]], rounds: int = 100) -> tuple[dict, list[float], dict]:
    """EM over counts of (kind, votes): (posterior of each pattern, labeler reliabilities, kind priors)."""
    trust = [0.8] * len(LABELERS)
    prior = {k: 0.5 for k, _, _ in counts}
    posterior: dict = {}
    for _ in range(rounds):
        for k, votes, _ in counts:
            yes, no = math.log(prior[k]), math.log(1 - prior[k])
            for t, v in zip(trust, votes):
                if v != "0":
                    yes += math.log(t if v == "+" else 1 - t)
                    no += math.log(1 - t if v == "+" else t)
            posterior[k, votes] = 1 / (1 + math.exp(max(-500.0, min(500.0, no - yes))))
        for i in range(len(LABELERS)):
            cast = [(n, posterior[k, v] if v[i] == "+" else 1 - posterior[k, v]) for k, v, n in counts if v[i] != "0"]
            right, total = sum(n * p for n, p in cast), sum(n for n, _ in cast)
            trust[i] = min(0.98, max(0.55, (right + 4) / (total + 5)))       # a labeler is never trusted blindly
        for k in prior:
            mine = [(n, posterior[k, v]) for q, v, n in counts if q == k]
            prior[k] = min(0.95, max(0.05, (sum(n * p for n, p in mine) + 1) / (sum(n for n, _ in mine) + 2)))
    return posterior, trust, prior


def span_model(table: list[tuple[tuple[str, ...], float, int]], rounds: int = 300, decay: float = 1e-3) -> dict[str, float]:
    """Logistic regression weights from (features, sum of soft labels, count), by gradient ascent."""
    weights = {"": 0.0} | {f: 0.0 for fs, _, _ in table for f in fs}
    total = sum(n for _, _, n in table) or 1
    share = {f: sum(n for fs, _, n in table if f in fs) / total for f in weights if f}
    for _ in range(rounds):
        step = dict.fromkeys(weights, 0.0)
        for fs, yes, n in table:
            z = weights[""] + sum(weights[f] for f in fs)
            miss = (yes - n / (1 + math.exp(max(-500.0, min(500.0, -z))))) / total
            step[""] += miss
            for f in fs:
                step[f] += miss
        for f in weights:                                    # a feature's own rate makes up for its rarity
            weights[f] += step[f] / (0.25 * (share.get(f, 1.0) * 7 + 1e-4)) - decay * weights[f]
    return weights


def find_personal_data(docs: DataFrame, *, text: str = "text", cutoff: float = 0.5) -> DataFrame:
    """``docs`` without its text, with ``__p_n_email`` .. ``__p_n_phone`` (base spans of each kind),
    ``__p_base`` and ``__p_spans`` (array<struct<s, kind, e>>, by start, then kind)."""
    found = written(candidates(docs, text), "candidates")
    each = found.select(F.explode("__p_found").alias("c"))
    counts = [tuple(r) for r in each.groupBy("c.kind", "c.votes").count().orderBy("kind", "votes").collect()]
    posterior, _, _ = vote_model(counts)
    label = F.expr("0.0D")
    if posterior:
        pairs = ", ".join(f"'{k}{v}', {p!r}D" for (k, v), p in posterior.items())
        label = F.expr(f"map({pairs})[concat(c.kind, c.votes)]")
    # soft labels as whole millionths, so that sums do not depend on the order of addition
    rows = each.groupBy("c.features").agg(F.sum(F.round(label * 1e6).cast("bigint")).alias("yes"), F.count("*").alias("n")).orderBy("features").collect()
    weights = span_model([(tuple(r.features), r.yes / 1e6, r.n) for r in rows])
    known = ", ".join(f"'{f}', {w!r}D" for f, w in weights.items() if f) or "'', 0.0D"
    score = f"aggregate(x.features, {weights['']!r}D, (a, f) -> a + coalesce(map({known})[f], 0.0D))"
    least = math.log(cutoff / (1 - cutoff))
    order = lambda keep: F.expr(f"sort_array(transform(filter(__p_found, x -> {keep}), x -> struct(x.s, x.kind, x.e)))")
    return found.withColumns({"__p_base": order("x.kind < 4"), "__p_spans": order(f"x.kind < 4 or {score} >= {least!r}D")}).drop("__p_found")


def span_text(column: str):
    """kind:start:end of each span, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({column}, x -> concat_ws(':', {names}[x.kind], x.s, x.e)), ',')")


def redact(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` with every span replaced by <KIND> (of overlapping spans, the first and longest)."""
    kept = docs.withColumn("__p_whole", F.col(f"`{text}`"))
    found = find_personal_data(kept, text=text, **options)
    names = "array(" + ", ".join(f"'<{k.upper()}>'" for k in KINDS) + ")"
    step = (f"case when x.s < a.at then a else struct(x.e as at, concat(a.out, array(substr(__p_whole, a.at + 1, x.s - a.at), {names}[x.kind])) as out) end")
    body = f"aggregate(__p_spans, struct(0 as at, cast(array() as array<string>) as out), (a, x) -> {step}, a -> concat(array_join(a.out, ''), substr(__p_whole, a.at + 1)))"
    return found.select(*[F.expr(body).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


@query("op10_pii_weak_supervision")
def op10_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents searched for personal data."""
    found = find_personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.col(f"__p_n_{k}").alias(f"n_{k}") for k in KINDS[:4]],
                        F.sha2(span_text("__p_base"), 256).alias("base_sha256"), span_text("__p_spans").alias("spans"))
