"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint (64 bits, over the XXH64 hashes of four-word shingles) links to
another at four or fewer differing bits.  Cut into three segments, two
linked fingerprints have a segment that differs by at most one bit (two bits
in each of three would be six).  So every fingerprint is indexed under its
one-wildcard variants, one for each of the 64 bits: the segment around the
bit with that bit deleted.  Linked fingerprints share a variant; an equality
"join" (a shuffle and sort on the variant) brings candidates together and the
full distance verifies them.

Only distinct fingerprints are indexed.  Sorted runs of equal variants are
compared in numpy strips; a union-find per task keeps one link per
fingerprint and tree, so dense groups never become lists of all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tierstat.llm.common import components, fresh, ship, text_or_empty, written

WIDTH = 4
BITS = 4
SEGMENTS = (22, 21, 21)
_CHUNK = 1 << 16
ship(__name__)


def fingerprint_text(text: str | None, width: int = WIDTH) -> int:
    """64-bit SimHash of one text; 0 if it has no words."""
    data = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not data:
        return 0
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(data)]
    digest = xxhash.xxh64_intdigest
    if len(starts) <= width:
        return digest(data, 42)
    counts, n = np.zeros(64, np.int64), len(starts) - width + 1
    for at in range(0, n, _CHUNK):
        stop = min(n, at + _CHUNK)
        pieces = zip(starts[at:stop], ends[at + width - 1 : stop + width - 1], strict=True)
        hashes = np.array([digest(data[a:b], 42) for a, b in pieces], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(LongType())
def _fingerprint_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.array([fingerprint_text(t) for t in texts], np.uint64).view(np.int64))


def _masks() -> list[int]:
    """For each bit, its segment without the bit."""
    masks, low = [], 0
    for width in SEGMENTS:
        segment = ((1 << width) - 1) << low
        masks += [segment & ~(1 << bit) for bit in range(low, low + width)]
        low += width
    return [int(np.array(m, np.uint64).view(np.int64)) for m in masks]


def _find(parent: dict[int, int], x: int) -> int:
    root = x
    while parent.get(root, root) != root:
        root = parent[root]
    while parent.get(x, x) != root:
        parent[x], x = root, parent[x]
    return root


def _link_runs(keys: np.ndarray, prints: np.ndarray, bits: int, parent: dict[int, int]) -> None:
    """Union the fingerprints of equal keys that differ in at most ``bits`` bits (rows sorted by key)."""
    n = len(keys)

    def known() -> np.ndarray:
        return np.fromiter((_find(parent, p) for p in prints.tolist()), np.uint64, n)

    labels = known()
    at, step = np.arange(n), 1
    while True:
        at = at[at + step < n]
        at = at[keys[at] == keys[at + step]]  # what has no partner at this distance has none further on
        if not len(at):
            break
        apart = at[labels[at] != labels[at + step]]
        near = apart[np.bitwise_count(prints[apart] ^ prints[apart + step]) <= bits]
        for i, j in zip(near.tolist(), (near + step).tolist(), strict=True):
            a, b = _find(parent, int(prints[i])), _find(parent, int(prints[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                parent.setdefault(min(a, b), min(a, b))
        if len(near) and (step & (step - 1) == 0 or step % 64 == 0):  # what is linked needs no more comparing
            labels = known()
        step += 1


def _links(bits: int):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(keys: np.ndarray, prints: np.ndarray) -> None:
            if len(keys) > 1:
                same = np.flatnonzero(keys[1:] == keys[:-1])
                rows = np.union1d(same, same + 1)  # only runs of two and more
                _link_runs(keys[rows], prints[rows], bits, parent)

        for batch in batches:
            keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            if held and held[0][0][0] == keys[-1]:  # still one run
                held.append((keys, prints))
                continue
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            held.append((keys[:cut], prints[:cut]))
            flush(np.concatenate([k for k, _ in held]), np.concatenate([p for _, p in held]))
            held = [(keys[cut:], prints[cut:])]
        if held:
            flush(np.concatenate([k for k, _ in held]), np.concatenate([p for _, p in held]))
        pairs = [(x, _find(parent, x)) for x in list(parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        for at in range(0, len(pairs), _CHUNK):
            both = np.array(pairs[at : at + _CHUNK], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=out)

    return run


def fingerprint_links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) that span the same groups as all pairs of ``prints(fp)`` within ``bits`` bits.

    ``bits`` is at most 5: with three segments one of them differs by one bit or none.
    """
    if not 0 <= bits < 2 * len(SEGMENTS):
        raise ValueError("bits must be 0 to 5")
    masks = F.array(*[F.lit(m) for m in _masks()])
    variants = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")).select(
        F.xxhash64("bit", F.col("fp").bitwiseAND(F.element_at(masks, F.col("bit") + 1))).alias("key"), "fp"
    )
    # Equal hashes of different variants only add candidates, which the distance rejects.
    dealt = variants.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_links(bits), "a long, b long")


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, digest, fp): one per row of ``documents``; digest is the md5 of the text."""
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.md5(text_or_empty(text)).alias("digest"),
        _fingerprint_batches(F.col(text)).alias("fp"),
    )


def near_duplicates(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """``prints`` (doc_id, ..., fp) with root, naming the component, and component_id, its smallest doc_id.

    Null and empty texts have fingerprint 0 and are linked like any other.
    Null ids are never the smallest, unless a component has no other: null.
    """
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(fingerprint_links(distinct.select("fp"), bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = written(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def simhash_groups(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per row of ``documents``, over whole texts."""
    prints = written(fingerprints(documents, doc_id, text).drop("digest"), "prints")
    return near_duplicates(prints, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """``documents``, all columns, with one row of each component: that with the smallest id.

    Of rows sharing that id, the one with the smallest text digest, and of
    identical rows one.  A component without ids keeps the smallest digest.
    """
    grouped = near_duplicates(written(fingerprints(documents, doc_id, text), "prints"), bits)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    ranked = grouped.groupBy("root").agg(F.min(place).alias("keep")).select("keep.doc_id", "keep.digest")
    n = grouped.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    key, dig, rows = (fresh(documents.columns, c) for c in ("_key", "_digest", "_rows"))
    keep = ranked.select(F.col("doc_id").alias(key), F.col("digest").alias(dig))
    n = n.select(F.col("doc_id").alias("_k"), F.col("digest").alias("_d"), F.col("rows").alias(rows))
    keep = keep.join(n, F.col(key).eqNullSafe(F.col("_k")) & (F.col(dig) == F.col("_d"))).select(key, dig, rows)
    keep = written(keep, "keep")
    same = F.col(doc_id).eqNullSafe(F.col(key)) & (F.md5(text_or_empty(text)) == F.col(dig))
    once = documents.join(keep.where(F.col(rows) == 1), same, "left_semi")
    again = documents.join(keep.where(F.col(rows) > 1), same).drop(rows)
    return once.unionByName(again.dropDuplicates([key, dig]).drop(key, dig))
