"""Spelling variants: words one edit apart, found through asymmetric q-chunks."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import saved, whole_text

#: A run of letters: ASCII and the code points U+00C0 to U+00FF.
RUN = f"[A-Za-z{chr(0xC0)}-{chr(0xFF)}]+"
#: One of so many (document, run) pairs, by checksum, loses a code point.
DELETE_ONE_IN = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form is so many times as frequent as its variant, at least.
FORM_TIMES = 5
#: Candidate pairs of one chunk that are verified without looking at a further chunk.
MOST_PAIRS = 1_000_000


def altered_runs(docs: DataFrame) -> DataFrame:
    """(word) of every run of letters: lower-cased A-Z, some with one code point deleted.

    Where DELETE_ONE_IN divides the crc32 of ``<doc_id>:<run>``, code point crc32 % length
    goes. A null doc_id counts as empty, a null text has no runs. Runs too short to stay
    words are left out early.
    """
    text = F.translate(whole_text(), ascii_uppercase, ascii_lowercase)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("own_id"),
        F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.char_length("run") >= LEAST_LENGTH)
    code = F.crc32(F.concat("own_id", F.lit(":"), "run"))
    place = F.expr("CAST(code % char_length(run) AS INT)")
    return runs.withColumn("code", code).select(
        F.when(F.col("code") % DELETE_ONE_IN != 0, F.col("run"))
        .otherwise(F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run"))))
        .alias("word"))


def frequent_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words long and frequent enough, counted over all documents."""
    words = altered_runs(docs).filter(F.char_length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _chunk(rest: Column, length: Column, size: Column, left: bool) -> tuple[Column, Column]:
    """A chunk or gram of ``size`` at one end of a text, and what is left of the text."""
    if left:
        return F.substring(rest, F.lit(1), size), F.substring(rest, size + 1, length)
    return F.substring(rest, length - size + 1, size), F.substring(rest, F.lit(1), length - size)


def _signed(rows: DataFrame, longer: bool) -> DataFrame:
    """Signatures (key, word, rest, more) of rows (key, word, rest, more).

    The shorter word of a pair gives two disjoint chunks, the two ends of its text, each
    half of it. The longer one (``more`` is the difference of lengths, 0 or 1) gives the
    positional grams of that size that a chunk can meet. One edit preserves a chunk: the
    left one stays in place, the right one is shifted by ``more``. A left chunk that is
    preserved with a shift is so because of an insertion before it, so the right one finds
    that pair too.
    """
    length = F.char_length("rest")
    least = length - F.col("more") if longer else length
    size = F.floor(least / 2).cast("int")
    sides = []
    for left in (True, False):
        gram, rest = _chunk(F.col("rest"), length, size, left)
        sides.append(F.struct(F.xxhash64("key", "more", least, F.lit(left), gram).alias("key"), rest.alias("rest")))
    return rows.withColumn("side", F.explode(F.array(*sides))).select(
        F.col("side.key").alias("key"), "word", F.col("side.rest").alias("rest"), "more")


def near_pairs(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(a, b) of the distinct ``word`` values that differ by one insertion, deletion or replacement; each pair once.

    A pair is looked for where the words share a chunk, and then verified. Chunks that
    would give more than ``most_pairs`` pairs are refined first: the texts beside the
    chunk are one edit apart too, so they share one of two chunks in turn. A text of one
    code point ends that, and then few words can share all the rest.
    """
    start = words.select(
        F.lit(0).cast("long").alias("key"), "word", F.col("word").alias("rest"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("more"))
    short, long = _signed(start, False), _signed(start, True)
    found = None
    while True:
        short, long = saved(short, "chunks"), saved(long, "grams")
        pairs = short.groupBy("key").agg(F.count("*").alias("shorts"), F.max(F.char_length("rest")).alias("width")).join(
            long.groupBy("key").agg(F.count("*").alias("longs")), "key")
        heavy = saved(pairs.filter(
            (F.col("shorts") * F.col("longs") > most_pairs) & (F.col("width") > 1)).select("key"), "heavy")
        more = not heavy.isEmpty()
        some = [x.join(heavy, "key", "left_anti") if more else x for x in (short, long)]
        a, b = (x.select("key", F.col("word").alias(w), F.col("more").alias(f"more_{w}")) for x, w in zip(some, "ab"))
        tried = a.join(b, "key").filter(
            (F.col("more_a") == F.col("more_b")) & (F.char_length("b") - F.char_length("a") == F.col("more_a"))
            & ((F.col("more_a") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
        ).select("a", "b")
        found = tried if found is None else found.union(tried)
        if not more:
            return found.distinct()
        short, long = (_signed(x.join(heavy, "key", "left_semi"), w) for x, w in ((short, False), (long, True)))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last; the word itself without a form.

    A form is several times as frequent as its variant, so there are no circles and paths
    are short; each round doubles the steps that a root is ahead.
    """
    ahead = saved(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(ahead.join(further, "root").select(
            "word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        ahead = step.drop("moved")
        if step.filter("moved").isEmpty():
            return ahead


def spelling_variants(docs: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per word of at least 6 code points and 5 occurrences: word, form, root, n, n_near, form_n.

    Near words differ by one edit of a code point. The form is the near word of largest n
    (ties: the smallest in code-point order) if it is at least 5 times as frequent; root is
    the last form reached, the word itself if there is none.

    Null and empty texts have no words; a null doc_id counts as empty; rows that repeat a
    doc_id or a text count each; whole texts are read, whatever their length; columns other
    than doc_id and text do not matter. An empty table gives an empty result.
    """
    words = saved(frequent_words(docs), "words")
    pairs = near_pairs(words, most_pairs)
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("form")))
    near = both.join(counts, "near").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.minus_n") >= FORM_TIMES * F.col("n")
    forms = saved(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.minus_n")).alias("form_n")), "forms")
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
