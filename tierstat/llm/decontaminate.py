"""Benchmark decontamination: size-partitioned MinHash containment search.

A text is the set of its five-word shingles (words: runs of letters, marks
and digits, lower-cased; an item of one to four words is one shingle of its own length; no words: no
shingle).  A document contains an item if at least 80 % of the item's
shingles are among the document's of that length.

Items are partitioned by size (powers of two of their shingle count) and each
is sketched by its bottom-k MinHash values: the k smallest shingle hashes,
with k = n - ceil(0.8 n) + 1 from its size.  Whatever misses all k has more
than 20 % of the item missing, so a document that contains the item holds at
least one of them: the search loses nothing, however long the document.  A
fixed-length signature of the documents would not do: an item of 30 shingles
inside 20,000 words has a Jaccard similarity of 0.0015.  So documents are not
sketched; each streams its shingle hashes, inside one generated stage, past
the sketch hashes, and the hits meet the sketches of the item sizes the document is long enough for.  Candidate pairs
are then verified by the exact count of shared shingles, compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstat.llm.common import fresh, small, text_or_empty, written

WORD = r"[\p{L}\p{M}\p{N}]+"
SHINGLE = 5
THRESHOLD = 0.8
SLICE = 1_000_000  # hashes broadcast at once, at most: tens of megabytes


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(WORD), F.lit(0))


def _need(n: Column, threshold: float) -> Column:
    """Shingles that must be shared of ``n``."""
    return F.ceil(F.round(n * F.lit(threshold), 6)).cast("long")


def _shingles(df: DataFrame, width: int, *keep: str) -> DataFrame:
    """Rows (keep..., shingle) of ``df(keep..., words)``, repeats included; none of fewer than ``width`` words."""
    start = F.explode(F.sequence(F.lit(1), F.size("words") - width + 1))
    return (
        df.where(F.size("words") >= width)
        .select(*keep, "words", start.alias("at"))
        .select(*keep, F.array_join(F.slice("words", F.col("at"), width), " ").alias("shingle"))
    )


def _size_class(n: Column) -> Column:
    return F.floor(F.log2(n)).cast("int")


def item_shingles(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Rows (item_id, item, width, n, shingle): ``item`` tells texts apart that share an id.

    ``width`` is the words of a shingle: all that the item has, if it has fewer than asked for.
    """
    base = items.select(F.col(item_id).alias("item_id"), _words(F.col(text)).alias("words"))
    base = base.withColumn("item", F.md5(F.concat_ws(" ", "words"))).dropDuplicates(["item_id", "item"])
    base = base.withColumn("width", F.least(F.size("words"), F.lit(width))).where("width > 0")
    start = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("at")
    rows = base.select("item_id", "item", "width", "words", start)
    rows = rows.select("item_id", "item", "width", F.array_join(F.slice("words", F.col("at"), F.col("width")), " ").alias("shingle")).distinct()
    n = F.count(F.lit(1)).over(Window.partitionBy("item_id", "item"))
    return rows.select("item_id", "item", "width", n.alias("n"), "shingle")


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """Bottom-k MinHash rows (item_id, item, n, size_class, h) of ``item_shingles``."""
    hashed = shingles.withColumn("h", F.xxhash64("shingle"))
    order = Window.partitionBy("item_id", "item").orderBy("h", "shingle")
    k = F.col("n") - _need(F.col("n"), threshold) + 1
    return (
        hashed.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k)
        .select("item_id", "item", "n", _size_class(F.col("n")).alias("size_class"), "h")
    )


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every (document, item) with the item contained in the document.

    Rows (doc_id, digest, item_id, shared, item_shingles, containment); digest
    is the md5 of the document's text, so that rows sharing an id (or having
    none) are judged by their own text.  Null and empty texts have no
    shingles: they contain nothing and, as items, are contained nowhere.
    Repeated rows give one result row.  Empty tables give no row.
    """
    base = documents.select(
        F.col(doc_id).alias("doc_id"), F.md5(text_or_empty(text)).alias("digest"), _words(F.col(text)).alias("words")
    )
    every = written(item_shingles(items, item_id, item_text, width), "items")
    parts = [_contained(base, every.where(F.col("width") == width), width, threshold)]
    # Items of fewer words are one shingle of their own length: a search for each length that there is.
    for short in sorted(r["width"] for r in every.where(F.col("width") < width).select("width").distinct().collect()):
        parts.append(_contained(base, every.where(F.col("width") == short), short, threshold))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("doc_id", "digest", "item_id").agg(
        F.max(F.struct("containment", "shared", "item_shingles")).alias("best")
    ).select("doc_id", "digest", "item_id", "best.shared", "best.item_shingles", "best.containment")


def _hashes_met(stream: DataFrame, hashes: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct ``columns`` of ``stream`` rows whose ``h`` is among ``hashes(h)``.

    The hashes are broadcast in slices of at most about ``SLICE``, 8 bytes each, one reading of the documents for each
    slice: the documents' shingles are never shuffled, however many items there are.
    """
    hashes = written(hashes.distinct(), "hashes")
    slices = max(1, -(-hashes.count() // SLICE))
    out = None
    for i in range(slices):
        some = hashes if slices == 1 else hashes.where(F.pmod(F.col("h"), F.lit(slices)) == i)
        met = stream.join(F.broadcast(some), "h", "left_semi").select(*columns)
        out = met if out is None else out.unionByName(met)
    return written(out.distinct(), "met")


def _contained(base: DataFrame, shingles: DataFrame, width: int, threshold: float) -> DataFrame:
    """Rows (doc_id, digest, item_id, item, shared, item_shingles, containment) for the items of one shingle width."""
    index = written(sketches(shingles, threshold), "sketches")
    size = F.greatest(F.size("words") - width + 1, F.lit(0)).alias("size")
    stream = _shingles(base.select("*", size), width, "doc_id", "digest", "size")
    stream = stream.select("doc_id", "digest", "size", F.xxhash64("shingle").alias("h"))
    hits = _hashes_met(stream, index.select("h"), ["doc_id", "digest", "size", "h"])
    long_enough = F.col("size") >= _need(F.pow(F.lit(2.0), "size_class"), threshold)
    found = hits.join(index, "h").where(long_enough).select("doc_id", "digest", "item_id", "item").distinct()
    found = written(found, "candidates")
    keys = small(found.select(F.col("doc_id").alias("k"), F.col("digest").alias("kd")).distinct())
    candidates = base.join(keys, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("kd")), "left_semi")
    # What is in no item goes before the distinct, so that only item shingles are shuffled.
    rows = _shingles(candidates, width, "doc_id", "digest").withColumn("h", F.xxhash64("shingle"))
    rows = _hashes_met(rows, shingles.select(F.xxhash64("shingle").alias("h")), ["doc_id", "digest", "shingle"])
    pair = found.select(F.col("doc_id").alias("k"), F.col("digest").alias("kd"), F.col("item_id").alias("ki"), F.col("item").alias("kt"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("kd"))
        & F.col("item_id").eqNullSafe(F.col("ki")) & (F.col("item") == F.col("kt"))
    )
    # Hashes have only chosen the rows; what counts is equal text.
    return (
        rows.join(shingles, "shingle")
        .join(pair, same, "left_semi")
        .groupBy("doc_id", "digest", "item_id", "item")
        .agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("item_shingles"))
        .where(F.col("shared") >= _need(F.col("item_shingles"), threshold))
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
    )


def drop_contaminated(documents: DataFrame, items: DataFrame, **names) -> DataFrame:
    """``documents`` (all columns, repeated rows too) without those that contain a benchmark item."""
    doc_id, text = names.get("doc_id", "doc_id"), names.get("text", "text")
    hits = written(contained_items(documents, items, **names).select("doc_id", "digest").distinct(), "hits")
    key, dig = fresh(documents.columns, "_key"), fresh(documents.columns, "_digest")
    hits = small(hits.select(F.col("doc_id").alias(key), F.col("digest").alias(dig)))
    same = F.col(doc_id).eqNullSafe(F.col(key)) & (F.md5(text_or_empty(text)) == F.col(dig))
    return documents.join(hits, same, "left_anti")
