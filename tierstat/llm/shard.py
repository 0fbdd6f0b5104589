"""Sharding by a hierarchical weighted hash tree (region, rack, shard).

At each level every child draws -ln(u)/weight, u the MD5 of the row's key and
the child's name as a number between 0 and 1 (so SQL can say the same), and the smallest draw wins: a child is taken with a
probability in proportion to its weight.  A child's draw depends on nothing
but the key, its name and its weight, so a changed weight moves rows only into or
out of the subtree that holds it, and below a child whose own subtree is
unchanged nothing moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstat.llm.common import fresh, gapless_rank, text_or_empty

# region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]


def shard_tree(shards: int, base: int = 16, racks: int = 2, per_rack: int = 4) -> Tree:
    """Shards 0..``shards``-1 of equal weight: ``base`` of them in full racks and regions.

    Every shard past ``base`` is a region of its own, so adding it changes one
    weight at the root (from nothing to 1) and rows move only into it.
    """
    tree: Tree = {}
    for s in range(min(shards, base)):
        rack = s // per_rack
        tree.setdefault(f"region{rack // racks}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    for s in range(base, shards):
        tree[f"region-of-{s}"] = {f"rack-of-{s}": {s: 1.0}}
    return tree


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.conv(F.substr(F.md5(F.concat(key, F.lit(f"/{name}"))), F.lit(1), F.lit(13)), 16, 10)  # 52 of them
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / F.lit(float(weight))


def _pick(key: Column, children: dict[str, tuple[object, float]]) -> Column:
    """The value of the child with the smallest draw; children: name -> (value, weight)."""
    alive = {n: (v, w) for n, (v, w) in children.items() if w > 0}
    if len(alive) == 1:
        return F.lit(next(iter(alive.values()))[0])
    draws = [F.struct(_draw(key, n, w).alias("d"), F.lit(v).alias("v")) for n, (v, w) in alive.items()]
    return F.array_min(F.array(*draws))["v"]


def _choose(level: Column, options: dict[str, Column]) -> Column:
    return reduce(lambda c, o: c.when(level == o[0], o[1]), options.items(), F).otherwise(F.lit(None))


def with_shard(df: DataFrame, key: Column, tree: Tree, out: str = "shard") -> DataFrame:
    """Append ``out``, the shard of each row's ``key`` (a null key is a key like any other)."""
    key = F.coalesce(key.cast("string"), F.lit("null key"))
    total = {r: sum(w for rack in racks.values() for w in rack.values()) for r, racks in tree.items()}
    region, rack = (fresh([*df.columns, out], n) for n in ("_region", "_rack"))
    racks = {
        r: _pick(key, {f"{r}/{k}": (f"{r}/{k}", sum(shards.values())) for k, shards in tree[r].items()})
        for r, w in total.items() if w > 0
    }
    shards = {
        f"{r}/{k}": _pick(key, {f"{r}/{k}/{s}": (s, w) for s, w in leaves.items()})
        for r, ks in tree.items() for k, leaves in ks.items() if sum(leaves.values()) > 0
    }
    return (
        df.withColumn(region, _pick(key, {r: (r, w) for r, w in total.items()}))
        .withColumn(rack, _choose(F.col(region), racks))
        .withColumn(out, _choose(F.col(rack), shards).cast("int"))
        .drop(region, rack)
    )


def shard_documents(
    documents: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", buckets: int = 256
) -> DataFrame:
    """Every row of ``documents`` with its shard and a gapless slot inside the shard.

    All columns stay; ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``law``
    ("key": id and shard count alone decide), ``shard``, ``grown_shard`` (with
    one more shard) and ``slot`` are added, and replace input columns of these
    names.  Null text: size 1, checksum 0.  Null ids share one shard.  Repeated
    rows share a shard and have slots of their own; texts that share an id (or
    have none) are still numbered in many buckets, by id and checksum.
    """
    added = {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    base = documents.drop(*[c for c in documents.columns if c.lower() in added and c not in (doc_id, text)])
    sized = base.withColumns(
        {
            "size": (F.octet_length(text_or_empty(text)) + 1).cast("long"),
            "text_crc32": F.crc32(text_or_empty(text).cast("binary")),
            "law": F.lit("key"),
        }
    )
    placed = with_shard(sized, F.col(doc_id), shard_tree(shards))
    placed = with_shard(placed, F.col(doc_id), shard_tree(shards + 1), "grown_shard")
    order = [F.col(doc_id).asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    return gapless_rank(placed, ["shard"], [F.col(doc_id), F.col("text_crc32")], order, "slot", buckets)
