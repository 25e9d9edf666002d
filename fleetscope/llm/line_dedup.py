"""Line dedup by a log-template tree, in DataFrame functions only.

A line's words are its runs of non-blanks; a word that holds a digit is a field, ``<*>``.  The tree
has a fixed depth: the first level is the number of words, the next ``DEPTH`` levels are the leading words;
its leaves hold the lines that may share a template.  Within a leaf a word is
constant at its place if lines with at least ``MIN_TEXTS`` votes have it there, and varies otherwise:
a line's template is its words with fields and varying words as ``<*>``.  A template with ``MIN_TEXTS`` votes
is boilerplate, and its lines are dropped from all documents, if

* all its words are constant, so that its lines are equal; or
* none varies, so that they differ in fields only, and at least ``MIN_SHARE`` of its words are constant; or
* at least ``MIN_SHARE`` of its words behind the leading ones are constant and stand at their place in
  ``LEAF_SHARE`` of the leaf's lines: what the leaf is keyed by is no evidence, nor is a word that
  merely many lines of a large leaf have.

In the shares bare signs (no letter, no digit) do not count and fields count as not constant.
A line of ``VERBATIM_WORDS`` words or more that recurs word by word, fields included, is dropped from ``MIN_VERBATIM`` votes on.

**Votes.**  Copies must not vote content out of the corpus.  Equal texts are one text.  Each of a text's lines is
seen in three surroundings: the smallest of the *other* lines' checksums, by three orders.  A line's votes are the different
surroundings that its texts give it, in the order that gives most.  Boilerplate recurs in ever other surroundings; the lines of near
copies recur in mostly the same ones.  Votes below ``UNLIKE`` of the texts do not count.

**How it runs.**  Documents are read once for the lines' checksums, which are written.
Which checksums recur, which stand in two texts, and which leaves in ``MIN_TEXTS``, becomes a bitmap of at
most 2^26 bits (a Bloom filter of one hash): a broadcast table of bounded size that nearly all other lines fail
before any further exchange; exact joins behind it remove what slips through.  A line that doesn't recur has one vote, so its text
needs no exchange.  Lines of wide leaves are read again to find the rich leaves, in which a word behind the leading ones
stands in ``LEAF_SHARE`` of the lines: their words are counted as hashes.  Only there can different
lines share a template, so only rich leaves' words are put side by side; elsewhere a line must have the votes itself.
In the end only texts that lose a line meet the lost places in a join; the others pass by.

Nulls and ties: a null text stays null.  Lines end at U+000A; blank lines stay and have no
template.  Each row is a document, also if ids are null or repeat.  A text that only repeats itself in exact
copies keeps its lines in every copy; near copies of few lines may lose some of those that they share (in the test
of 40 near copies of ten lines 3 or 4 each).  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import materialize

DEPTH = 2
MIN_TEXTS = 20
MIN_SHARE = 0.5
LEAF_SHARE = 0.5
MIN_VERBATIM = 3
VERBATIM_WORDS = 4
UNLIKE = 0.5
BITMAP_WORDS = 1 << 20                 # of 64 bits
_ORDERS = (1, 5, 9)                    # first byte of a checksum's eight by which surroundings are ordered
_BLANKS = ("\t", "\x0b", "\f", "\r")   # besides the space
_SIGN = r"(?:^| )[^\p{L}0-9 ]+(?: |$)"


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def _spaced(line: Column) -> Column:
    """The line's words with one space between them; the expensive form only where it is needed."""
    odd = reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in ("  ", *_BLANKS)])
    return F.trim(F.when(odd, F.regexp_replace(line, "[ \t\\x0B\f\r]+", " ")).otherwise(line))


def _count(text: Column | str, mark: str) -> Column:
    """How often the one-byte mark stands in the text."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _bind(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _has_digit(text: Column) -> Column:
    return F.rlike(text, F.lit("[0-9]"))


def _general(word: Column) -> Column:
    """A word, or <*> if it holds a digit."""
    return F.when(_has_digit(word), F.lit("<*>")).otherwise(word)


def _leaf(line: Column | str, depth: int) -> Column:
    return F.xxhash64(_count(line, " ") + 1, _norm(F.substring_index(line, " ", depth)))


def _norm(line: Column) -> Column:
    """The words generalised; most lines hold no digit and stay as they are."""
    return F.when(_has_digit(line), F.array_join(F.transform(F.split(line, " "), _general), " ")).otherwise(line)


def _checksum(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _surroundings(ids: Column) -> Column:
    """For each of three orders the smallest and the second smallest different checksum."""
    def two(at: int) -> Column:
        own = F.transform(ids, lambda x: F.substring(x, at, 8))
        return _bind(F.array_min(own), lambda low: F.struct(low.alias("low"), F.array_min(F.filter(own, lambda x: x != low)).alias("next")))
    return F.array(*[two(at) for at in _ORDERS])


def line_hashes(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """th, place, words, leaf, signs, vid, nid, s0, s1, s2 of every line that is not blank.

    signs: whether a word may be a bare sign; vid and nid are the checksums of the line and of the line with fields; s0 to s2
    its surroundings.
    """
    lines = F.transform(_lines("text"), _spaced)
    both = _bind(lines, lambda all_: F.struct(all_.alias("line"), F.transform(all_, lambda x: F.when(x != "", _checksum(x))).alias("vid")))
    text = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("th"), F.explode(F.array(both)).alias("b"))
    text = text.select("th", "b", F.explode(F.array(_surroundings(F.col("b.vid")))).alias("around"))
    line = (text.select("th", "around", F.posexplode(F.arrays_zip("b.line", "b.vid")).alias("place", "z"))
            .select("th", "around", "place", F.col("z.line").alias("line"), F.col("z.vid").alias("vid")).where("line <> ''"))
    field = _has_digit(F.col("line"))
    own = [F.substring("vid", at, 8) for at in _ORDERS]
    seen = [F.when(F.get("around", k)["low"] == own[k], F.coalesce(F.get("around", k)["next"], own[k])).otherwise(F.get("around", k)["low"])
            .alias(f"s{k}") for k in range(len(_ORDERS))]
    return line.select("th", "place", (_count("line", " ") + 1).alias("words"), _leaf("line", depth).alias("leaf"),
                       F.rlike("line", F.lit(_SIGN)).alias("signs"), "vid",
                       F.when(field, _checksum(_norm(F.col("line")))).otherwise(F.col("vid")).alias("nid"), *seen)


def _bit(key: str) -> tuple[Column, str]:
    """Where the key's hash has its bit: the word, and SQL of the place in it."""
    return F.pmod(F.xxhash64(key), F.lit(BITMAP_WORDS)), f"cast(pmod(shiftright(xxhash64({key}), 32), 64) AS int)"


def _bitmap(key: str, rows: DataFrame) -> DataFrame:
    """A bit for each key's hash: at most BITMAP_WORDS rows (at, bits)."""
    word, place = _bit(key)
    return rows.select(word.alias("at"), F.expr(f"shiftleft(1L, {place})").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))


def _marked(rows: DataFrame, key: str, bitmap: DataFrame, name: str) -> DataFrame:
    """Add whether the key's bit is set; the bitmap's rows are bounded, so it is broadcast."""
    word, place = _bit(key)
    bits = bitmap.select(F.col("at").alias(f"{name}_at"), F.col("bits").alias(f"{name}_bits"))
    return (rows.join(F.broadcast(bits), word == F.col(f"{name}_at"), "left")
            .withColumn(name, F.expr(f"coalesce(shiftright({name}_bits, {place}) & 1 = 1, false)"))
            .drop(f"{name}_at", f"{name}_bits"))


def _votes(rows: DataFrame, key: str) -> DataFrame:
    """(key, votes, texts): different surroundings in the best order, and different texts, for each key."""
    one = rows.select(key, "th", "s0", "s1", "s2").distinct()
    return (one.groupBy(key).agg(*[F.count_distinct(c).alias(c) for c in ("s0", "s1", "s2")], F.count_distinct("th").alias("texts"))
            .select(key, F.greatest("s0", "s1", "s2").alias("votes"), "texts"))


def _norms(docs: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """leaf, norm of the lines whose leaf has its bit, as often as they occur."""
    line = docs.where("text IS NOT NULL").select(F.explode(_lines("text")).alias("raw")).select(_spaced(F.col("raw")).alias("line"))
    line = line.where("line <> ''").select("line", _leaf("line", depth).alias("leaf"))
    return _marked(line, "leaf", leaves, "wide").where("wide").select("leaf", _norm(F.col("line")).alias("norm"))


def _rich(once: DataFrame, words: DataFrame, odd: DataFrame, wide: DataFrame, depth: int, min_texts: int, leaf_share: float) -> DataFrame:
    """(leaf) of the wide leaves in which a line may have enough common words behind the leading ones.

    Such a line has them at half of its places (bare signs aside), so one of them stands in any larger half: only the first
    half and one more are counted, or all where a line of the leaf has bare signs.  Words travel as hashes; key 0 counts the lines.
    """
    each = once.select("leaf", "norm", F.lit(1).cast("long").alias("n")).union(words.select("leaf", "norm", "n"))
    each = _marked(each, "leaf", odd, "odd").select("leaf", "n", "odd", F.split("norm", " ").alias("w")).where(F.size("w") > depth)
    behind = F.size("w") - depth
    last = depth + F.when(F.col("odd"), behind).otherwise(F.floor(behind / 2).cast("int") + 1)
    word = each.select("leaf", "n", last.alias("last"), F.posexplode("w").alias("at", "word"))
    word = word.where((F.col("at") == 0) | (F.col("at") >= depth) & (F.col("at") < F.col("last")) & (F.col("word") != "<*>"))
    key = F.when(F.col("at") == 0, F.lit(0)).otherwise(F.xxhash64("at", "word"))
    count = word.groupBy("leaf", key.alias("key")).agg(F.sum("n").alias("n")).where(F.col("n") >= min_texts)
    count = materialize(count, "line-common")
    total = count.where("key = 0").select("leaf", F.col("n").alias("total"))
    rich = count.where("key <> 0").groupBy("leaf").agg(F.max("n").alias("n")).join(total, "leaf")
    return rich.where(F.col("n") >= leaf_share * F.col("total")).join(wide, "leaf").select("leaf")


def _equal(words: DataFrame, rich: DataFrame, min_texts: int, min_share: float) -> DataFrame:
    """(nid) of the boilerplate in the other leaves: lines equal but for fields that enough unlike texts share.

    With ``min_texts`` votes of its own, each of the line's words is constant.
    """
    strong = words.where((F.col("n") >= min_texts) & (F.col("n") >= UNLIKE * F.col("texts"))).join(rich, "leaf", "left_anti")
    parts = F.split("norm", " ")
    fields = F.size(F.filter(parts, lambda x: x == "<*>"))
    have = F.size(F.filter(parts, lambda x: (x != "<*>") & F.rlike(x, F.lit(r"\p{L}"))))
    strong = strong.select("nid", fields.alias("fields"), have.alias("have"))
    return strong.where((F.col("fields") == 0) | (F.col("have") >= min_share * (F.col("have") + F.col("fields")))).select("nid")


def _templates(text: DataFrame, met: DataFrame, depth: int, min_texts: int, min_share: float, leaf_share: float) -> DataFrame:
    """(nid) of the lines of rich leaves whose template is boilerplate; text: leaf, nid, norm, n."""
    # words that are constant at their place
    word = text.select("leaf", "nid", "n", F.posexplode(F.split("norm", " ")).alias("at", "word"))
    known = word.groupBy("leaf", "at", "word").agg(F.sum("n").alias("n")).where((F.col("n") >= min_texts) & (F.col("word") != "<*>"))
    total = text.groupBy("leaf").agg(F.sum("n").alias("total"))
    known = known.join(total, "leaf").select("leaf", "at", "word", F.lit(True).alias("fixed"),
                                             (F.col("n") >= leaf_share * F.col("total")).alias("common"))
    part = word.join(known, ["leaf", "at", "word"], "left")
    times = lambda c: F.count(F.when(c, 1))
    field, letter, fixed, behind = F.col("word") == "<*>", F.rlike("word", F.lit(r"\p{L}")), F.col("fixed"), F.col("at") >= depth
    shape = F.array_sort(F.collect_list(F.struct("at", F.when(fixed, F.col("word")).otherwise("<*>").alias("word"))))
    tmpl = part.groupBy("leaf", "nid").agg(
        shape.alias("t"), times(fixed.isNull()).alias("open"), times(fixed.isNull() & ~field).alias("vary"),
        times(field | letter).alias("of"), times(fixed & letter).alias("have"),
        times(behind & (field | letter)).alias("b_of"), times(behind & F.col("common") & letter).alias("b_have"))
    enough = lambda have, of: (F.col(of) > 0) & (F.col(have) >= min_share * F.col(of))
    drops = (F.col("open") == 0) | (F.col("vary") == 0) & enough("have", "of") | enough("b_have", "b_of")
    tmpl = tmpl.where(drops).select("nid", F.md5(F.concat_ws(" ", "leaf", F.array_join("t.word", " "))).alias("template"))
    tmpl = materialize(tmpl, "line-templates")
    # templates that enough unlike texts share
    many = _votes(met.join(tmpl, "nid"), "template").where((F.col("votes") >= min_texts) & (F.col("votes") >= UNLIKE * F.col("texts")))
    return tmpl.join(many.select("template"), "template").select("nid")


def lost_places(docs: DataFrame, depth: int = DEPTH, min_texts: int = MIN_TEXTS, min_share: float = MIN_SHARE,
                leaf_share: float = LEAF_SHARE, min_verbatim: int = MIN_VERBATIM) -> DataFrame:
    """(th, gone): the places of the lines to drop, for each text that has any."""
    lines = materialize(line_hashes(docs, depth), "line-hashes")
    again = (lines.groupBy("nid").agg(F.count("*").alias("rows"), F.min("th").alias("a"), F.max("th").alias("b"))
             .where(F.col("rows") > 1).select("nid", (F.col("a") != F.col("b")).alias("two")))
    again = materialize(again, "line-again")
    more = materialize(_bitmap("nid", again), "line-more")
    two = materialize(_bitmap("nid", again.where("two")), "line-twice")
    wide = materialize(lines.groupBy("leaf", "th").agg(F.max("signs").alias("signs")).groupBy("leaf")
                       .agg(F.count("*").alias("texts"), F.max("signs").alias("signs")).where(F.col("texts") >= min_texts)
                       .select("leaf", "signs"), "line-leaves")
    leaves = materialize(_bitmap("leaf", wide), "line-wide")
    odd = materialize(_bitmap("leaf", wide.where("signs")), "line-odd")
    wide = wide.select("leaf")
    marked = _marked(_marked(lines, "nid", two, "twice").where("twice"), "leaf", leaves, "wide")
    marked = materialize(marked.where((F.col("words") >= VERBATIM_WORDS) | F.col("wide")), "line-marked")
    same = (_votes(marked.where(F.col("words") >= VERBATIM_WORDS), "vid")
            .where((F.col("votes") >= min_verbatim) & (F.col("votes") >= UNLIKE * F.col("texts"))).select("vid"))
    # lines that recur, once each with their votes; of the others each has one vote
    votes = materialize(_votes(marked.where("wide"), "nid"), "line-votes")
    norms = _marked(_norms(docs, leaves, depth).withColumn("nid", _checksum(F.col("norm"))), "nid", more, "more")
    words = (norms.where("more").select("leaf", "norm").distinct().withColumn("nid", _checksum(F.col("norm"))).join(votes, "nid", "left")
             .select("leaf", "nid", "norm", F.coalesce("votes", F.lit(1)).alias("n"), F.coalesce("texts", F.lit(1)).alias("texts")))
    words = materialize(words.join(wide, "leaf"), "line-words")
    rich = materialize(_rich(norms.where("NOT more"), words, odd, wide, depth, min_texts, leaf_share), "line-rich")
    equal = _equal(words, rich, min_texts, min_share)
    # the lines of rich leaves: their words are read from the texts that have such lines
    deep = materialize(_bitmap("leaf", rich), "line-deep")
    met = materialize(_marked(lines, "leaf", deep, "deep").where("deep").join(rich, "leaf")
                      .select("th", "place", "leaf", "nid", "s0", "s1", "s2"), "line-candidates")
    holders = materialize(_bitmap("th", met), "line-holders")
    held = _marked(docs.select("text", F.xxhash64("text").alias("th")), "th", holders, "holds").where("holds").select("text")
    single = _marked(_norms(held, deep, depth).withColumn("nid", _checksum(F.col("norm"))), "nid", more, "more").where("NOT more")
    text = words.select("leaf", "nid", "norm", "n").union(single.select("leaf", "nid", "norm", F.lit(1).cast("long").alias("n")))
    text = materialize(text.join(rich, "leaf"), "line-texts")
    alike = _templates(text, met, depth, min_texts, min_share, leaf_share)
    same = materialize(same, "line-same")
    gone = [_marked(marked, "vid", _bitmap("vid", same), "same").where("same").join(same, "vid"), marked.where("wide").join(equal, "nid"), met.join(alike, "nid")]
    gone = reduce(DataFrame.union, [g.select("th", "place") for g in gone])
    return gone.groupBy("th").agg(F.collect_set("place").alias("gone"))


def dedup_lines(docs: DataFrame, depth: int = DEPTH, min_texts: int = MIN_TEXTS, min_share: float = MIN_SHARE,
                leaf_share: float = LEAF_SHARE, min_verbatim: int = MIN_VERBATIM) -> DataFrame:
    """doc_id, n_lines, n_dropped, text: one row per row of ``docs``, text without the dropped lines."""
    gone = materialize(lost_places(docs, depth, min_texts, min_share, leaf_share, min_verbatim), "line-gone")
    losers = materialize(_bitmap("th", gone), "line-losers")
    full = _marked(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), "th", losers, "loses")
    n_lines = F.coalesce(_count("text", "\n") + 1, F.lit(0)).cast("long").alias("n_lines")
    stay = full.where("text IS NULL OR NOT loses").select("doc_id", n_lines, F.lit(0).cast("long").alias("n_dropped"), "text")
    cut = full.where("text IS NOT NULL AND loses").join(gone.hint("merge"), "th", "left")  # grows with the texts: never broadcast
    left = _bind(_lines("text"), lambda all_: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), "gone"), lambda i: F.get(all_, i)), "\n"))
    cut = cut.select("doc_id", n_lines, F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                     F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))
    return stay.union(cut)
