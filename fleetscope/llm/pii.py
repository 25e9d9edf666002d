r"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

**Seeds** are what the four base rules find (leftmost, non-overlapping, for each kind): e-mail
addresses, IP addresses, card numbers that pass Luhn, telephone numbers.  Spans are in code points, the end exclusive.

**Mentions** are the seeds and the tokens that look like identifiers (without blanks, with a digit or ``@``, 4 to 64
code points without the signs around them) and touch no seed.  A mention's contexts are the last word and the last two
words before it, where a word is a run of letters; they don't reach behind the former match of the same rule, nor further
back than 200 code points.

**Patterns** are contexts of ``SUPPORT`` or more different mentions.  How often a pattern's words occur in the
whole corpus, before whatever, is counted in one pass over all texts.  The graph of patterns and mentioned
values is then scored in rounds, for each kind of seed:

* a pattern's confidence is the number of sure mentions of the kind behind it, by one more than its words' occurrences
  anywhere: what mostly stands before ordinary words is no evidence, however many seeds it precedes;
* a value is taken for the kind if at least half of its occurrences stand behind a pattern whose confidence reaches
  ``THRESHOLD`` (of several kinds the one with most such occurrences, then the first), and is a sure mention of it from the
  next round on, also for other patterns.

Confidences only grow, so values stay taken.  Rounds end when no further value is taken, at most after ``ROUNDS``.  All mentions of a taken value are added as spans of the
kind ``<kind>_like``; base spans always stay.

Regular expressions are possessive and start only where a match can, so long texts without blanks cost linear
time.  Spans of a document are put in order by windows over that document's matches alone; counts are
combined before every shuffle.  The pattern table is broadcast only up to ``BROADCAST_ROWS`` rows, which are
counted; beyond, the texts' words are joined to it by shuffle.

Null and empty texts hold nothing; each row is a document, also if ids are null or repeat (rows are told apart by a number of
their own); an empty table gives an empty result.  Copies count as often as they occur in pattern and word counts alike, but
``SUPPORT`` asks for different values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 5
THRESHOLD = 0.8
ROUNDS = 5
BROADCAST_ROWS = 100_000
_TOKEN = len(KINDS)
_BLANK = r"\x20\x09-\x0D"
#: The base rules; possessive, and starting only where an earlier start could not have taken the same text.
_RULES = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    rf"(?<![^{_BLANK}])[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+",   # tokens that may be identifiers
)
#: What a text must contain for a rule to be tried.
_NEEDS = ("@", ".", "", "+", "")


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(kind: int) -> str:
    """SQL: (kind, i, gap, value, before) of the rule's matches, in order; gap: code points since the former match."""
    rule, need = _sql(_RULES[kind]), _NEEDS[kind]
    matches = f"regexp_extract_all(text, {rule}, 0)"
    rows = (f"transform(arrays_zip(split(text, {rule}, -1), {matches}), (z, i) -> named_struct('kind', {kind}, 'i', i, "
            "'gap', char_length(z['0']), 'value', z['1'], 'before', right(z['0'], 200)))")
    rows = f"filter({rows}, x -> x.value IS NOT NULL)"
    has = f"contains(text, '{need}') AND " if need else ""
    return f"CASE WHEN {has}text RLIKE '[0-9@]' THEN {rows} ELSE array() END"


def _luhn(digits: str) -> str:
    """SQL: whether the last digit checks the others."""
    doubled = "translate(d, '0123456789', '0246813579')"  # twice the digit, its digits added up
    odd = f"transform(split(reverse({digits}), ''), (d, i) -> int(if(i % 2 = 1, {doubled}, d)))"
    return f"aggregate({odd}, 0, (a, x) -> a + x) % 10 = 0"


def _valid() -> Column:
    digits = "regexp_replace(value, '[^0-9]', '')"
    ip = "value RLIKE '^(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])([.]|$)){4}$'"
    card = f"length({digits}) BETWEEN 12 AND 19 AND CASE WHEN length({digits}) BETWEEN 12 AND 19 THEN {_luhn(digits)} ELSE false END"
    phone = f"length({digits}) BETWEEN 9 AND 15"
    token = "char_length(value) BETWEEN 4 AND 64"
    return F.expr(f"CASE kind WHEN 0 THEN true WHEN 1 THEN {ip} WHEN 2 THEN {card} WHEN 3 THEN {phone} ELSE {token} END")


def mentions(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of all rows, and row, kind (index of ``KINDS``, or beyond for tokens), value, start, end, l1, l2 of all mentions."""
    found = F.expr("concat(" + ", ".join(_found(k) for k in range(len(_RULES))) + ")")
    rows = materialize(docs.select("doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("found")),
                       "pii-rows")
    each = rows.select("row", F.inline("found")).repartition("row")
    until = "OVER (PARTITION BY row, kind ORDER BY i ROWS UNBOUNDED PRECEDING)"
    each = each.selectExpr("*", f"sum(gap + char_length(value)) {until} AS end")
    each = each.selectExpr("row", "kind", "before", "end - char_length(value) AS start", "end", "value")
    # a token without the signs around it
    junk = r"[^\\p{L}\\p{N}@+]"
    each = each.selectExpr("*", f"if(kind = {_TOKEN}, char_length(value) - char_length(regexp_replace(value, '^{junk}++', '')), 0) AS cut")
    each = each.selectExpr("row", "kind", "before", "start + cut AS start",
                           f"if(kind = {_TOKEN}, regexp_replace(substring(value, cut + 1), '(?<!{junk}){junk}++$', ''), value) AS value")
    each = each.where(_valid()).selectExpr("*", "start + char_length(value) AS end")
    base = f"kind < {_TOKEN}"
    order = "OVER (PARTITION BY row ORDER BY start, kind ROWS BETWEEN"
    each = each.selectExpr("*", f"max(if({base}, end, 0)) {order} UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach",
                           f"min(if({base}, start, null)) {order} 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next")
    each = each.where(f"{base} OR (coalesce(reach, 0) <= start AND coalesce(next, end) >= end)")
    words = r"slice(array(null, null) || regexp_extract_all(lower(before), '\\p{L}+', 0), -2, 2)"
    each = each.selectExpr("row", "kind", "value", "start", "end", f"{words} AS w")
    each = each.selectExpr("row", "kind", "value", "start", "end", "w[1] AS l1", "w[0] || ' ' || w[1] AS l2")
    return rows.select("row", "doc_id"), materialize(each, "pii-mentions")


def _bounded(patterns: DataFrame) -> DataFrame:
    """The table with a broadcast hint if its counted rows allow."""
    return F.broadcast(patterns) if patterns.count() <= BROADCAST_ROWS else patterns


def _occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(p, total): how often the words of each pattern stand in the texts."""
    last = _bounded(materialize(patterns.select(F.substring_index("p", " ", -1).alias("w")).distinct(), "pii-words"))
    words = r"split(lower(text), '[^\\p{L}]+')"
    each = docs.where("text IS NOT NULL").select(F.expr(f"inline(arrays_zip({words}, concat(array(''), {words})))").alias("w", "v"))
    # words that end no pattern go before any string is built; what is left meets the patterns before it is counted
    each = each.join(last, "w").select(F.expr("explode(array(w, v || ' ' || w)) AS p"))
    return each.join(_bounded(patterns), "p").groupBy("p").agg(F.count("*").alias("total"))


def taken(docs: DataFrame, found: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind): identifier-like tokens that reliable patterns show to be of a kind of seeds."""
    spark = docs.sparkSession
    by = found.groupBy("kind", "value", "l1", "l2").count().where("l1 IS NOT NULL")
    by = materialize(by, "pii-contexts")
    edges = by.select("kind", "value", "count", F.explode(F.array("l1", "l2")).alias("p")).where("p IS NOT NULL")
    patterns = (edges.select("p", "value").distinct().groupBy("p").count().where(F.col("count") >= support).select("p"))
    patterns = materialize(patterns, "pii-patterns")
    totals = materialize(_occurrences(docs, patterns), "pii-totals")
    seeds = edges.where(F.col("kind") < _TOKEN)
    token = edges.where(F.col("kind") == _TOKEN).drop("kind")
    at = by.where(F.col("kind") == _TOKEN).select("value", "l1", "l2", "count")
    size = at.groupBy("value").agg(F.sum("count").alias("size"))
    got, before = spark.createDataFrame([], "value string, kind int"), 0
    for _ in range(rounds):
        sure = seeds.select("p", "kind", "count").union(token.join(got, "value").select("p", "kind", "count"))
        strong = (sure.groupBy("p", "kind").agg(F.sum("count").alias("have")).join(totals, "p")
                  .where(F.col("have") >= threshold * (F.col("total") + 1)).select("p", "kind"))
        strong = materialize(strong, "pii-strong")
        behind = (at.select("value", "l1", "l2", "count", F.explode(F.array("l1", "l2")).alias("p")).join(strong, "p")
                  .select("value", "l1", "l2", "count", "kind").distinct().groupBy("value", "kind").agg(F.sum("count").alias("have")))
        best = behind.groupBy("value").agg(F.max(F.struct("have", (-F.col("kind")).alias("k"))).alias("b")).join(size, "value")
        got = materialize(best.where(2 * F.col("b.have") >= F.col("size")).select("value", (-F.col("b.k")).alias("kind")), "pii-taken")
        now = got.count()
        if now == before:
            break
        before = now
    return got


def personal_data(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, spans: array of (start, end, kind, value) in order of start, then kind; one row per row of ``docs``."""
    rows, found = mentions(docs)
    names = F.array(*[F.lit(k) for k in KINDS])
    base = found.where(F.col("kind") < _TOKEN).select("row", "start", "end", F.col("kind").alias("nr"), F.get(names, "kind").alias("kind"), "value")
    like = taken(docs, found, support, threshold, rounds).select("value", F.col("kind").alias("of"))
    more = (found.where(F.col("kind") == _TOKEN).join(like, "value")
            .select("row", "start", "end", (F.col("of") + _TOKEN).alias("nr"), F.concat(F.get(names, "of"), F.lit("_like")).alias("kind"), "value"))
    spans = base.union(more).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "nr", "end", "kind", "value"))).alias("s"))
    none = F.expr("cast(array() AS array<struct<start:bigint,end:bigint,kind:string,value:string>>)")
    listed = F.transform("s", lambda x: F.struct(x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"),
                                                 x["kind"].alias("kind"), x["value"].alias("value")))
    return rows.join(spans, "row", "left").select("doc_id", F.coalesce(listed, none).alias("spans"))
