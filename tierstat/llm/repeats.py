"""Substring dedup by prefix-partitioned suffix trees.

A window is ``span`` consecutive words of one document: the first ``span``
words of a suffix.  A word goes if a window over it also starts in a document
with a smaller id.

Every suffix belongs to the group of one prefix: the eight-word sequence of
least hash inside its window, so equal windows are always in one group.
Neighbouring suffixes mostly have the same one and travel together as a
passage, whose text is stored once, and once for all its copies.  Prefixes
seen in one document only can hold no repeat and are dropped before any text
moves.  A group of more than ``GROUP`` words is dealt again by longer and
longer prefixes of its suffixes (8, 16, 32, ... words) until each part fits
into memory; what is still too large at the full ``span`` is one and the same
window.  Each group's suffixes are sorted into a tree, its levels by doubling: nodes at depth 1, 2, 4, ...,
``span`` words, suffixes alone in their node being leaves.  Deep internal nodes are repeated windows; runs of
them are the maximal repeats, and each carries the smallest id that holds it.
Hashes only bring suffixes together; the trees compare words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierstat.llm.common import fresh, ship, small, text_or_empty, written

SPAN = 50  # words of a window
PREFIX = 8  # words of the prefix that a group is made of, at most half a window
GROUP = 1 << 20  # words that are built into one tree
MOST = 1024  # windows of one passage
_SLICE = 1 << 20  # bytes hashed at once
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # any odd number
ship(__name__)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of ``_FACTOR`` and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
        _powers[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, f, np.uint64)))) for f in (_FACTOR, inverse)]
    return _powers


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word in the bytes ``raw``; a word ends at white space and at ``bounds``."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    first = ~space
    first[1:] &= space[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(raw))]
    first[inner] |= ~space[inner]
    starts = np.flatnonzero(first)
    last = ~space
    last[:-1] &= space[1:]
    last[inner - 1] |= ~space[inner - 1]
    ends = np.flatnonzero(last) + 1
    hashes, at = [], 0
    while at < len(starts):  # slices of whole words, so that the sums below stay small
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _SLICE, "right")))
        low, high = int(starts[at]), int(ends[stop - 1])
        power, inverse = _power_tables(max(high - low, _SLICE))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
        a, b = starts[at:stop] - low, ends[at:stop] - low
        hashes.append(_mixed((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)))
        at = stop
    return starts, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)


def _prefix_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on (of those that have as many after them)."""
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = _mixed(out * _FACTOR + words[i : i + n])
    return out


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def passage_runs(words: np.ndarray, first: np.ndarray, span: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and key of each run of windows with the same least prefix hash.

    ``words``: the hashes of all words; ``first``: where each document begins, and the end.
    """
    n = len(words) - span + 1
    counts = np.diff(first)
    held = np.flatnonzero(counts >= span)
    if n <= 0 or not len(held):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = _sliding_least(_prefix_hashes(words, prefix), span - prefix + 1)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first[held], 1)
    np.add.at(step, first[held] + counts[held] - span + 1, -1)
    valid = np.cumsum(step)[:n] > 0
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    begins[first[held]] = True
    at = np.flatnonzero(begins)
    windows = np.flatnonzero(valid)
    run = np.searchsorted(at, windows, "right") - 1
    cut = (windows - at[run]) % MOST == 0  # long runs in pieces
    at, where = windows[cut], np.flatnonzero(cut)
    sizes = np.diff(np.append(where, len(windows)))
    return at, sizes, least[at].view(np.int64)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and where each begins (and the end); nulls are empty."""
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def _runs(span: int, prefix: int):
    names = ["doc_id", "mark", "at", "n", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = _binary(batch.column(2))
            low = 0
            while low < batch.num_rows:  # some documents at a time
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + 4 * _SLICE, "right")) - 1)
                bounds = offsets[low : high + 1] - offsets[low]
                starts, words = word_hashes(raw[offsets[low] : offsets[high]], bounds)
                first = np.searchsorted(starts, bounds)
                at, n, key = passage_runs(words, first, span, prefix)
                doc = np.searchsorted(first, at, "right") - 1
                rows = pa.array(doc + low)
                columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array((at - first[doc]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(key)]
                if len(at):
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                low = high

    return run


def _cut(span: int):
    """Rows (doc_id, mark, text, spans) to a row for each span, with its words."""
    names = ["doc_id", "mark", "at", "n", "key", "passage"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for doc, mark, text, spans in zip(*(c for c in batch.columns), strict=True):
                words = text.as_py().split()
                for s in spans.as_py():
                    piece = b" ".join(words[s["at"] : s["at"] + s["n"] + span - 1])
                    out.append((doc.as_py(), mark.as_py(), s["at"], s["n"], s["key"], piece.decode("utf-8", "replace")))
                    held += len(piece)
                    if held > 4 * _SLICE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def repeated_windows(passages: list[str], least: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs (passage, from, to, smallest id) of windows, from the suffix tree of all ``passages``.

    ``least``: the smallest id that holds each passage.
    """
    split = [p.split(" ") for p in passages]
    sizes = np.array([len(w) for w in split], np.int64)
    node = pd.factorize(np.array(list(chain.from_iterable(split)), object))[0].astype(np.int64)
    end = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    smallest = least[owner].copy()
    windows = np.flatnonzero(np.arange(len(node)) + span <= end)
    # Suffixes that share their node with another one; the rest are leaves and branch no more.
    alive, depth = np.arange(len(node)), 1

    def branching(at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, ids, counts = np.unique(ids, return_inverse=True, return_counts=True)
        shared = counts[ids] > 1
        return at[shared], ids[shared]

    def deeper(at: np.ndarray, by: int, to: int) -> tuple[np.ndarray, np.ndarray]:
        at = at[at + to <= end[at]]
        at = at[(node[at] >= 0) & (node[at + by] >= 0)]
        return branching(at, node[at] * (len(node) + 1) + node[at + by])

    alive, ids = branching(alive, node)
    while True:
        node = np.full(len(node), -1, np.int64)
        node[alive] = ids
        if depth * 2 > span or not len(alive):
            break
        alive, ids = deeper(alive, depth, depth * 2)
        depth *= 2
    if depth < span and len(alive):
        alive, ids = deeper(alive, span - depth, span)
    if len(alive):  # each deep internal node hands its smallest id to its leaves
        order = np.argsort(ids, kind="stable")
        begin = np.flatnonzero(np.diff(ids[order], prepend=-1))
        smallest[alive[order]] = np.repeat(np.minimum.reduceat(smallest[alive[order]], begin), np.diff(np.append(begin, len(order))))
    value, of = smallest[windows], owner[windows]
    begin = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(value, prepend=0) != 0))
    stop = np.append(begin[1:], len(windows))
    offset = windows[begin] - (np.cumsum(sizes) - sizes)[of[begin]]
    return of[begin], offset, offset + stop - begin, value[begin]


_RUNS = "array<struct<a:int,b:int,least:bigint>>"


def _trees(span: int, most: int):
    """Rows (key, name, least, passage) sorted by key to rows (name, runs)."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("least", pa.int64())]))

    def build(rows: list[tuple]) -> pa.RecordBatch:
        of, a, b, value = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows], np.int64), span)
        offsets = np.searchsorted(of, np.arange(len(rows) + 1)).astype(np.int32)
        runs = pa.StructArray.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(value)], names=["a", "b", "least"])
        lists = pa.ListArray.from_arrays(pa.array(offsets), runs).cast(kind)
        return pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.binary()), lists], names=["name", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        words = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if words >= most and row[0] != held[-1][0]:  # whole groups only
                    yield build(held)
                    held, words = [], 0
                held.append(row)
                words += row[3].count(" ") + 1
        if held:
            yield build(held)

    return run


def _split_hot(hot: DataFrame, span: int, prefix: int, group: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups that are too large, dealt by longer prefixes of their suffixes.

    ``hot`` (key, name, least, passage) to three tables: the suffixes that go into trees, (key, name, least, passage) with one
    window each; where each came from, (name, origin, at); and (origin, at, least) for suffixes whose whole window
    alone is a group too large, which needs no tree.
    """
    words = F.split("passage", " ")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(words) - F.lit(span - 1)), lambda i: F.slice(words, i, F.lit(span)))
    each = hot.select(F.col("name").alias("origin"), "least", F.posexplode(suffixes).alias("at", "words"))
    each = written(each.withColumn("name", F.unhex(F.md5(F.concat_ws(" ", F.hex("origin"), "at")))), "suffixes")
    todo, width, parts = each.select("origin", "at", "name", "least", "words"), prefix, []
    done = each.limit(0).select("origin", "at", "least")
    while True:
        keyed = todo.withColumn("key", F.xxhash64(F.lit(width), F.slice("words", 1, width)))
        sizes = keyed.groupBy("key").agg((F.count(F.lit(1)) * span).alias("size"))
        large = written(sizes.where(F.col("size") > group).select("key"), "large")
        if large.isEmpty():
            parts.append(keyed)
            break
        parts.append(keyed.join(large, "key", "left_anti"))
        todo = written(keyed.join(large, "key", "left_semi").drop("key"), "suffixes")
        if width >= span:
            same = todo.groupBy("words").agg(F.min("least").alias("least"))
            done = todo.drop("least").join(same, "words").select("origin", "at", "least")
            break
        width = min(2 * width, span)
    rows = parts[0].select("key", "name", "least", F.concat_ws(" ", "words").alias("passage"))
    for part in parts[1:]:
        rows = rows.unionByName(part.select("key", "name", "least", F.concat_ws(" ", "words").alias("passage")))
    return rows, each.select("name", "origin", "at"), done


def repeated_spans(rows: DataFrame, span: int = SPAN, group: int = GROUP) -> DataFrame:
    """Where each of ``rows`` (doc_id, mark, text) repeats a smaller document: (doc_id, mark, spans).

    ``spans`` are half-open ranges of word positions, in any order and possibly overlapping; rows without any are left out.
    ``mark`` tells rows of one id apart.
    """
    prefix = max(1, min(PREFIX, span // 2))
    raw = rows.select("doc_id", "mark", F.col("text").cast("binary").alias("text")).where(F.col("doc_id").isNotNull())
    runs = written(raw.mapInArrow(_runs(span, prefix), "doc_id long, mark long, at int, n int, key long"), "runs")
    shared = runs.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    found = runs.join(shared.select("key"), "key", "left_semi")
    wanted = found.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("at", "n", "key")).alias("spans"))
    texts = raw.join(wanted, ["doc_id", "mark"])
    cut = texts.select("doc_id", "mark", "text", "spans").mapInArrow(
        _cut(span), "doc_id long, mark long, at int, n int, key long, passage string"
    )
    passages = written(cut.withColumn("name", F.unhex(F.md5("passage"))), "passages")
    once = written(passages.groupBy("key", "name", "passage").agg(F.min("doc_id").alias("least")), "distinct")
    length = F.length(F.regexp_replace("passage", "[^ ]", "")) + 1
    large = written(once.groupBy("key").agg(F.sum(length).alias("size")).where(F.col("size") > group).select("key"), "large")
    columns = ["key", "name", "least", "passage"]

    def trees(df: DataFrame) -> DataFrame:
        dealt = df.select(*columns).repartition("key").sortWithinPartitions("key")
        return written(dealt.mapInArrow(_trees(span, group), f"name binary, runs {_RUNS}"), "trees")

    if large.isEmpty():
        known = trees(once)
    else:
        known = trees(once.join(small(large), "key", "left_anti"))
        suffixes, origins, done = _split_hot(once.join(small(large), "key", "left_semi").select(*columns), span, prefix, group)
        least = trees(suffixes).select("name", F.col("runs")[0]["least"].alias("least"))
        least = origins.join(least, "name").select("origin", "at", "least").unionByName(done)
        run = F.struct(F.col("at").alias("a"), (F.col("at") + 1).alias("b"), "least")
        known = known.unionByName(least.groupBy("origin").agg(F.collect_list(run).alias("runs")).withColumnRenamed("origin", "name"))
    gone = passages.select("doc_id", "mark", "at", "name").join(known, "name")
    gone = gone.select("doc_id", "mark", "at", F.filter("runs", lambda r: r["least"] < F.col("doc_id")).alias("runs")).where(F.size("runs") > 0)
    spans = F.transform("runs", lambda r: F.struct((F.col("at") + r["a"]).alias("a"), (F.col("at") + r["b"] + F.lit(span - 1)).alias("b")))
    return gone.groupBy("doc_id", "mark").agg(F.flatten(F.collect_set(spans)).alias("spans"))


_KEPT = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])


@F.pandas_udf(_KEPT)
def _without(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, ranges in zip(texts, spans, strict=True):
        words = bytes(text).split()
        if ranges is None or not len(ranges):
            out.append((len(words), 0, b" ".join(words).decode("utf-8", "replace")))
            continue
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, [r["a"] for r in ranges], 1)
        np.add.at(step, [r["b"] for r in ranges], -1)
        keep = np.flatnonzero(np.cumsum(step)[:-1] == 0)
        out.append((len(words), len(words) - len(keep), b" ".join([words[i] for i in keep.tolist()]).decode("utf-8", "replace")))
    return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])


def without_repeats(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, group: int = GROUP
) -> DataFrame:
    """``documents``, all columns, with n_words, n_removed and kept: the text's words that repeat no smaller document.

    Words are maximal runs of characters other than ASCII white space, kept ones are joined by one space.  A null
    or empty text has no words.  Rows without an id lose nothing and take
    nothing from others; rows that share an id take nothing from each other.  Own columns of the names
    n_words, n_removed and kept are replaced.
    """
    mark, spans, out = (fresh(documents.columns, c) for c in ("_mark", "_spans", "_out"))
    marked = documents.withColumn(mark, F.xxhash64(text_or_empty(text)))
    rows = marked.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(mark).alias("mark"), text_or_empty(text).alias("text"))
    found = repeated_spans(rows, span, group)
    found = written(found, "spans").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_m"), F.col("spans").alias(spans))
    joined = marked.join(found, (F.col(doc_id).cast("long") == F.col("_id")) & (F.col(mark) == F.col("_m")), "left")
    joined = joined.withColumn(out, _without(text_or_empty(text).cast("binary"), F.col(spans)))
    rest = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in ("n_words", "n_removed", "kept")]
    return joined.select(*rest, *[F.col(out)[c].alias(c) for c in ("n_words", "n_removed", "kept")])
