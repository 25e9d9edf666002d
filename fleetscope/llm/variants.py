"""Spelling variants: words one edit apart, found by asymmetric q-chunks, grouped under the most frequent form.

``near_pairs`` finds all pairs of words that differ by exactly one inserted, deleted or replaced code point.
The shorter word of a pair (either, if they are equally long) gives two disjoint *chunks*, its code points ``[0, q)`` and
``[q, 2q)`` for ``q`` half its length; the other gives its positional grams of that ``q``.  One edit can
touch only one of two disjoint chunks, so the other one stands in the longer word, shifted by at
most one: the first where it was, the second where it was or one further.  Only grams at these places can meet a
chunk, so only they are made, and the length, the chunk's number and its letters are the key of an
equality join.  Met pairs are verified by their edit distance inside the join, so the join gives links and not
candidates.  A pair that agrees in both chunks is taken at the first only: no pair comes twice.

A chunk that more than ``GROUP`` words share is salted: its words are dealt to as many parts
as it has ``GROUP``s, and grams go to every part, so no key is larger than a part.

``variants`` gives every word its near words' count, its form (the most frequent near word, if that is
``factor`` times as frequent) and its root (the end of the chain of forms; chains are
short, as frequencies grow by the factor, and are followed by pointer doubling).

Words that contain a null, or null counts, take no part.  An empty table gives an empty result.
Repeated rows of a word are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import materialize

MIN_LENGTH = 6
MIN_COUNT = 5
FACTOR = 5
GROUP = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               thin: int | None = None) -> DataFrame:
    """(word, n): Latin words of the whole texts, A-Z in lower case, with how often they occur.

    Words shorter than ``min_length`` code points or rarer than ``min_count`` are left out.  With ``thin`` a word of a
    document loses one code point where the checksum of ``<doc_id>:<word>`` is a multiple of it, as misspelt test
    data (the checksum modulo the length tells which; a null id changes nothing).
    Null texts have no words; each row is a document, also if ids repeat.
    """
    runs = F.split(F.translate("text", _UPPER, _LOWER), "[^a-zÀ-ÿ]+", -1)
    word = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(runs).alias("word"))
    word = word.where(F.char_length("word") >= min_length)
    if thin:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = "cast(h % char_length(word) AS int)"
        word = (word.select("word", h.alias("h"))
                .select(F.when(F.coalesce(F.col("h") % thin == 0, F.lit(False)),
                               F.expr(f"concat(substring(word, 1, {at}), substring(word, {at} + 2))"))
                        .otherwise(F.col("word")).alias("word"))
                .where(F.char_length("word") >= min_length))
    return word.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _key(length: str, k: int, start: str) -> Column:
    """Length and number of a chunk, and the letters that stand there."""
    return F.expr(f"struct({length} AS len, {k} AS k, substring(word, {start} + 1, ({length}) div 2) AS chunk)")


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b, n_a, n_b): every unordered pair of words at edit distance one, once; a is not longer than b."""
    words = words.select("word", "n", F.char_length("word").alias("l"))
    chunks = words.select("word", "n", "l", F.inline(F.array(_key("l", 0, "0"), _key("l", 1, "l div 2"))))
    grams = words.select("word", "n", "l", F.inline(F.array(
        _key("l", 0, "0"), _key("l", 1, "l div 2"),                               # equally long
        _key("l - 1", 0, "0"), _key("l - 1", 1, "(l - 1) div 2 + 1"))))           # one longer
    key = ["len", "k", "chunk"]
    large = (chunks.groupBy(*key).count().where(F.col("count") > group)
             .select(*key, F.ceil(F.col("count") / group).cast("int").alias("parts")))
    large = materialize(large, "variant-groups")
    a = (chunks.join(large, key, "left")
         .select(*key, F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"),
                 F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("l").alias("l_a")))
    b = (grams.join(large, key, "left")
         .select(*key, F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
                 F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("l").alias("l_b")))
    q = F.expr("l_a div 2")
    one = (((F.col("l_a") < F.col("l_b")) | (F.col("a") < F.col("b")))
           & ((F.col("k") == 0) | (F.substring("a", F.lit(1), q) != F.substring("b", F.lit(1), q)))
           & (F.levenshtein("a", "b", 1) == 1))
    # comparing costs far more than the rows' bytes tell: as many tasks as a shuffle has, not as few as their size needs
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = (x.repartition(tasks, *key, "part") for x in (a, b))
    return a.join(b, [*key, "part"]).where(one).select("a", "b", "n_a", "n_b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, doubling the step each round."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")), "variant-roots")
        if not after.where("moved").limit(1).count():
            return now
        now = after.drop("moved")


def variants(words: DataFrame, factor: int = FACTOR, group: int = GROUP) -> DataFrame:
    """word, n, form, form_n, root, n_near: one row for each word of ``words`` (word, n)."""
    words = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = materialize(words, "variant-words")
    pairs = materialize(near_pairs(words, group), "variant-pairs")
    near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).union(
        pairs.select("b", "a", "n_a"))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("w"))).alias("b"))
    best = best.select("word", "n_near", F.col("b.w").alias("w"), (-F.col("b.less")).alias("m"))
    found = words.join(best, "word", "left")
    is_form = F.col("m") >= factor * F.col("n")
    found = materialize(found.select("word", "n", F.when(is_form, F.col("w")).alias("form"), F.when(is_form, F.col("m")).alias("form_n"),
                                     F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), "variant-forms")
    roots = _roots(found.where("form IS NOT NULL"))
    return (found.join(roots, "word", "left")
            .select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near"))
