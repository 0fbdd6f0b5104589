"""Spelling variants of the corpus' words: pairs at one edit by asymmetric q-chunks, and the common form of each word.

Two words are near if one inserted, deleted or replaced character turns one
into the other.  The longer one (either, if equally long) is cut into two
disjoint chunks.  One edit leaves a chunk whole, and the other word has it at the same place or shifted by
one, so it contributes its positional grams of the chunks' lengths at those
places: words meet by an equality join on (length, chunk's place, chunk) and
are verified.

Where more than ``GROUP`` words meet under one chunk (a common prefix, say), the part of the word outside the chunk is cut
into two chunks in turn, one of which again stays whole, and the words meet under both; so on down to
single characters, where a group holds no more words than the alphabet has letters.  No group of any size is
compared pair by pair, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstat.llm.common import lower_ascii, text_or_empty, written

LETTERS = r"A-Za-zÀ-ÿ"
LENGTH = 7  # characters of a word, at least
COUNT = 2  # occurrences of a word, at least
TIMES = 10  # a word's form is so many times as frequent, at least
GROUP = 64  # words that are compared under one chunk, at most, unless all but one character is the same


def corpus_words(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, count: int = COUNT,
    change: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Distinct words (word, n) of the whole texts: runs of letters, A-Z lower-cased, by length and occurrences.

    ``change`` (id, word) may replace each occurrence by another spelling that is not longer.  A null text has no
    words; repeated rows count each time.
    """
    pattern = f"[{LETTERS}]{{{length},}}"  # shorter runs can give no word
    runs = documents.select(
        F.col(doc_id).alias("id"), F.explode(F.regexp_extract_all(text_or_empty(text), F.lit(pattern), F.lit(0))).alias("run")
    )
    run = F.col("run")
    plain = F.octet_length(run) == F.length(run)  # then lower() touches only A-Z, and is the faster
    words = runs.select("id", F.when(plain, F.lower(run)).otherwise(lower_ascii(run)).alias("run"))
    word = change(F.col("id"), F.col("run")) if change else F.col("run")
    counted = words.select(word.alias("word")).where(F.length("word") >= length).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def _piece_rows(rows: DataFrame, pieces: list[tuple[Column, Column]]) -> DataFrame:
    """``rows`` (word, n, m) once for each of ``pieces`` (s, e), with the key of all that is outside the piece.

    ``m`` is the longer word's length; in a word one shorter the piece has one character less.
    """
    each = F.explode(F.array(*[F.struct(s.alias("s"), e.alias("e")) for s, e in pieces])).alias("p")
    cut = rows.select("word", "n", "m", each).select("word", "n", "m", "p.s", "p.e")
    after = F.col("e") - (F.col("m") - F.length("word"))
    head, tail = F.substr("word", F.lit(1), F.col("s")), F.substr("word", after + 1)
    return cut.withColumn("key", F.xxhash64("m", "s", "e", head, tail))


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """Pairs (a, a_n, b, b_n) of ``words`` (word, n) at exactly one edit, each once."""
    m = F.explode(F.array(F.length("word"), F.length("word") + 1))
    half = F.floor(F.col("m") / 2).cast("int")
    rows = _piece_rows(words.select("word", "n", m.alias("m")), [(F.lit(0), half), (half, F.col("m"))])
    found = None
    while True:
        rows = written(rows, "chunks")
        full = F.length("word") == F.col("m")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(full).alias("full"))
        sizes = written(sizes.where("size > 1 and full"), "sizes")  # nobody else has the other chunks
        met = rows.join(sizes.select("key", "size"), "key")
        hot = (F.col("size") > group) & (F.col("e") - F.col("s") > 1)
        cold = met.where(~hot)
        a = cold.where(full).select("key", "m", F.col("word").alias("a"), F.col("n").alias("a_n"))
        b = cold.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
        once = (F.length("b") < F.col("m")) | (F.col("a") < F.col("b"))
        pairs = a.join(b, "key").where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")
        pairs = written(pairs, "near")
        found = pairs if found is None else found.unionByName(pairs)
        if sizes.where(F.col("size") > group).isEmpty():
            return found.distinct()
        middle = F.floor((F.col("s") + F.col("e")) / 2).cast("int")
        rows = _piece_rows(met.where(hot), [(F.col("s"), middle), (middle, F.col("e"))])


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of ``forms`` (word, form) from each word, by pointer doubling.

    Forms must not run in a circle (those of :func:`spelling_forms` get more frequent with every step).
    """
    at = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not at.where("moved").isEmpty():
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.select("word", "root").join(on, "root", "left")
        at = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return at.select("word", "root")


def spelling_forms(words: DataFrame, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for ``words`` (word, n), whose words are distinct.

    ``form`` is the near word of largest n (ties: the first in code-point order) if that is ``times`` n or more;
    ``root`` follows forms to the last (the word itself, if it has none).
    """
    words = written(words, "words")
    pairs = near_pairs(words, group)
    sides = (("a", "a_n", "b", "b_n"), ("b", "b_n", "a", "a_n"))
    both = [pairs.select(*[F.col(c).alias(o) for c, o in zip(side, ("word", "n", "near", "near_n"), strict=True)]) for side in sides]
    best = both[0].unionByName(both[1]).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    )
    best = best.select("word", "n_near", F.when(-F.col("best.n") >= times * F.col("n"), F.col("best")).alias("best"))
    best = written(best.select("word", "n_near", F.col("best.word").alias("form"), (-F.col("best.n")).alias("form_n")), "best")
    roots = last_forms(best.where(F.col("form").isNotNull()))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
