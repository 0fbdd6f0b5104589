"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts; a small
classifier learns, from each sampled vector, how its neighbours spread over
the parts.  Every row is indexed in its most probable part, every query is
routed to its ``probes`` most probable parts, and those are searched exactly
(largest inner product in double precision).  ``probes`` is the smallest
number that finds ``recall`` of the true neighbours of a bounded set of
queries, which are compared with all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstat.llm.common import ship, written

SAMPLE = 4096  # vectors that the partition is learned from, at most
PARTS = 128  # parts, at most
FEWEST = 8  # parts of a small table, as long as each can hold k + 1 vectors
ROWS_PER_PART = 1024
CALIBRATION = 200  # queries whose true neighbours set ``probes``
RECALL = 0.95
BLOCK = 16384  # candidates compared at once: small parts are searched together, larger ones split
QUERY_BLOCK = 8192
_SCORES = "query_id long, vec_id long, score double"
ship(__name__)


def neighbour_graph(x: np.ndarray, degree: int = 10) -> np.ndarray:
    """The ``degree`` nearest others of each row by inner product."""
    near = np.empty((len(x), min(degree, len(x) - 1)), np.int64)
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        near[at : at + 1024] = np.argsort(-s, axis=1, kind="stable")[:, : near.shape[1]]
    return near


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """A part for each row: halves along the main direction, then moves towards neighbours within 5 % of balance."""
    labels = np.zeros(len(x), np.int64)
    todo, made = [(np.arange(len(x)), parts)], 0
    while todo:
        rows, p = todo.pop()
        if p == 1:
            labels[rows], made = made, made + 1
            continue
        centred = x[rows] - x[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ direction, kind="stable")]
        cut = len(rows) * (p // 2) // p
        todo += [(order[cut:], p - p // 2), (order[:cut], p // 2)]
    rng, most = np.random.default_rng(7), int(np.ceil(1.05 * len(x) / parts))
    least, sizes = int(0.95 * len(x) / parts), np.bincount(labels, minlength=parts)
    back: list[list[int]] = [[] for _ in x]
    for i, js in enumerate(near.tolist()):
        for j in js:
            back[j].append(i)
    around = [np.array([*near[i], *back[i]], np.int64) for i in range(len(x))]
    for _ in range(sweeps):
        moved = 0
        for i in rng.permutation(len(x)).tolist():
            votes = np.bincount(labels[around[i]], minlength=parts)
            own = labels[i]
            votes[(sizes >= most) & (np.arange(parts) != own)] = -1
            best = int(votes.argmax())
            if votes[best] > votes[own] and sizes[own] > least:
                sizes[own], sizes[best], labels[i] = sizes[own] - 1, sizes[best] + 1, best
                moved += 1
        if not moved:
            break
    return labels


@dataclass
class Router:
    """One hidden layer; gives the probability of each part."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum((x - self.mean) * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train_router(x: np.ndarray, targets: np.ndarray, hidden: int = 96, steps: int = 150) -> Router:
    """Cross-entropy against the spread ``targets`` of each row's neighbours over the parts."""
    rng = np.random.default_rng(11)
    mean, scale = x.mean(axis=0), 1.0 / max(float(x.std()), 1e-12)
    z = (x - mean) * scale
    shapes = [(z.shape[1], hidden), (hidden,), (hidden, targets.shape[1]), (targets.shape[1],)]
    p = [rng.normal(0, np.sqrt(2.0 / s[0]), s) if len(s) == 2 else np.zeros(s) for s in shapes]
    m, v = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for t in range(1, steps + 1):
        rows = rng.integers(0, len(z), min(1024, len(z)))
        a = np.maximum(z[rows] @ p[0] + p[1], 0)
        o = a @ p[2] + p[3]
        o = np.exp(o - o.max(axis=1, keepdims=True))
        d = (o / o.sum(axis=1, keepdims=True) - targets[rows]) / len(rows)
        da = (d @ p[2].T) * (a > 0)
        for i, g in enumerate((z[rows].T @ da + 1e-4 * p[0], da.sum(axis=0), a.T @ d + 1e-4 * p[2], d.sum(axis=0))):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
            p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    return Router(mean, scale, *p)


def learn(x: np.ndarray, parts: int) -> Router | None:
    """The router for ``parts`` parts, learned from the sampled rows ``x`` (None: one part)."""
    if parts == 1:
        return None
    near = neighbour_graph(x)
    labels = balanced_parts(x, near, parts)
    targets = np.zeros((len(x), parts))
    np.add.at(targets, (np.arange(len(x)), labels), 3.0)
    for j in range(near.shape[1]):
        np.add.at(targets, (np.arange(len(x)), labels[near[:, j]]), 1.0)
    return train_router(x, targets / targets.sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _orders(router: Router | None, v: np.ndarray) -> np.ndarray:
    """The parts of each row of ``v``, most probable first."""
    if router is None:
        return np.zeros((len(v), 1), np.int64)
    return np.argsort(-router.probabilities(v), axis=1, kind="stable")


def _homes(router: Router | None):
    """Rows (id, v) to rows (id, v, part): the most probable part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = pa.array(_orders(router, _matrix(batch.column(1)))[:, 0], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), part], names=["id", "v", "part"])

    return run


def _turns(router: Router, parts: int):
    """Rows (id, v) to rows (query_id, part, turn): all parts in the order they would be searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = _orders(router, _matrix(batch.column(1)))
                ids = np.repeat(batch.column(0).to_numpy(), parts)
                turn = np.tile(np.arange(parts, dtype=np.int32), len(order))
                columns = [pa.array(ids), pa.array(order.ravel(), pa.int32()), pa.array(turn)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "part", "turn"])

    return run


def _routes(router: Router | None, probes: int, groups: list[int]):
    """Rows (id, v) to rows (id, v, grp, parts) for each group with one of the ``probes`` most probable parts.

    ``groups`` has the group of each part; ``parts`` the wanted parts as a bit set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, names = np.array(groups), ["id", "v", "grp", "parts"]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            wanted = np.zeros((n, len(of)), bool)
            np.put_along_axis(wanted, _orders(router, _matrix(batch.column(1)))[:, :probes], True, axis=1)
            bits = np.packbits(wanted, axis=1)
            for group in range(int(of.max()) + 1):
                rows = np.flatnonzero(wanted[:, of == group].any(axis=1))
                some = batch.take(pa.array(rows))
                sets = pa.array([bits[i].tobytes() for i in rows.tolist()], pa.binary())
                columns = [some.column(0), some.column(1), pa.array(np.full(len(rows), group), pa.int32()), sets]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def nearest_in_block(
    qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int, wanted: np.ndarray | None = None, part: np.ndarray | None = None
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query row, candidate row and score of the ``k`` nearest candidates of each query, its own id left out.

    ``wanted`` (queries, parts) and ``part`` (of each candidate) leave out parts that a query is not routed to.
    """
    found = []
    for at in range(0, len(qid), 256):
        ids, block = qid[at : at + 256], q[at : at + 256]
        s = block @ v.T
        s[ids[:, None] == vid[None, :]] = -np.inf
        if wanted is not None:
            s[~wanted[at : at + 256][:, part]] = -np.inf
        kth = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
        # The product's rounding depends on the block's shape: take what is close and compute it again, row by row.
        slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(kth), kth, 0.0)))
        row, col = np.nonzero((s >= (kth - slack)[:, None]) & np.isfinite(s))
        score = (block[row] * v[col]).sum(axis=1)
        order = np.lexsort((vid[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, np.arange(len(s)))[row] < k
        found.append((row[keep] + at, col[keep], score[keep]))
    return found


def _search(k: int, parts: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        qid, vid = queries["id"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        q, v = (np.stack(c.to_numpy()).astype(np.float64) for c in (queries["v"], rows["v"]))
        sets = np.frombuffer(b"".join(queries["parts"]), np.uint8).reshape(len(queries), -1)
        wanted = np.unpackbits(sets, axis=1)[:, :parts].astype(bool)
        found = nearest_in_block(qid, q, vid, v, k, wanted, rows["part"].to_numpy())
        return pd.concat([pd.DataFrame({"query_id": qid[r], "vec_id": vid[c], "score": x}) for r, c, x in found])

    return run


def _blocks(size: int, most: int) -> int:
    return max(1, -(-size // most))


def part_groups(sizes: dict[int, int], parts: int) -> list[int]:
    """The group of each part: neighbouring parts together as long as they have at most ``BLOCK`` rows."""
    groups, group, held = [], 0, 0
    for p in range(parts):
        n = sizes.get(p, 0)
        if held and held + n > BLOCK:
            group, held = group + 1, 0
        groups.append(group)
        held += n
    return groups


def _lookup(key: str, values: dict[int, int]) -> Column:
    """``values`` by the column ``key``, 1 where it has none."""
    if not values:
        return F.lit(1)
    table = F.create_map(*[F.lit(int(x)) for pair in values.items() for x in pair])
    return F.coalesce(table[F.col(key)], F.lit(1))


def _pairs(queries: DataFrame, rows: DataFrame, k: int, groups: list[int]) -> DataFrame:
    """The ``k`` nearest of ``rows`` (id, v, part) for each of ``queries`` (id, v, grp, parts) among the parts it wants."""
    rows = rows.withColumn("grp", F.element_at(F.array(*[F.lit(g) for g in groups]), F.col("part") + 1))
    counts = [{r["grp"]: r["count"] for r in df.groupBy("grp").count().collect()} for df in (rows, queries)]  # PARTS rows at most
    row_blocks, query_blocks = (
        _lookup("grp", {g: _blocks(n, most) for g, n in c.items()}) for c, most in zip(counts, (BLOCK, QUERY_BLOCK), strict=True)
    )
    rows = rows.withColumn("rb", F.pmod(F.xxhash64("id"), row_blocks).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), query_blocks - 1))
    )
    queries = queries.withColumn("qb", F.pmod(F.xxhash64("id"), query_blocks).cast("int")).withColumn(
        "rb", F.explode(F.sequence(F.lit(0), row_blocks - 1))
    )
    key = ["grp", "rb", "qb"]
    found = queries.groupBy(*key).cogroup(rows.groupBy(*key)).applyInPandas(_search(k, len(groups)), _SCORES)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (id, v) that take part: id and vector given, all components finite, some not zero, the usual length."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists(v, lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    return rows.where(F.size("v") == (usual["d"] if usual else 0))


def nearest(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20, every: int = 20,
    recall: float = RECALL, rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """The ``k`` nearest found of each row whose id ``every`` divides: (query_id, rank, vec_id, score).

    Rows with a null id or a vector that is null, empty, zero, not finite or
    not of the most common length take no part.  Repeated rows count once.  Of
    equal vectors those with the ``k + 1`` smallest ids are indexed: no other
    can be among a query's ``k`` nearest, ties going to smaller ids.  Fewer than
    two times ``k + 1`` vectors are one part: two could not both be left unsearched.
    """
    rows = usable(vectors, vec_id, embedding)
    same = Window.partitionBy("v").orderBy("id")
    place = F.dense_rank().over(same)
    indexed = written(rows.distinct().withColumn("place", place).where(F.col("place") <= k + 1).select("id", "v"), "vectors")
    queries = written(rows.where(F.pmod("id", F.lit(every)) == 0).distinct(), "queries")
    n = indexed.count()
    parts = min(PARTS, max(1, _blocks(n, rows_per_part), min(FEWEST, n // (k + 1))))
    router, probes = None, 1
    if n:
        sample = indexed.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()  # bounded by SAMPLE
        router = learn(np.stack(sample["v"].to_numpy()).astype(np.float64), parts)
    row = f"id long, v {indexed.schema['v'].dataType.simpleString()}"
    index = written(indexed.mapInArrow(_homes(router), f"{row}, part int"), "index")
    sizes = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}
    if parts > 1:
        probes = _probes(queries, index, router, sizes, parts, k, recall)
    groups = part_groups(sizes, parts)
    routed = written(queries.mapInArrow(_routes(router, probes, groups), f"{row}, grp int, parts binary"), "routed")
    return _pairs(routed, index, k, groups).select("query_id", "rank", "vec_id", "score")


def true_neighbours(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of all ``index`` rows (id, v, part) for each of ``queries`` (id, v), with the part each is in."""
    asked = queries.select("id", "v", F.lit(0).alias("grp"), F.lit(b"\x80").alias("parts"))
    found = _pairs(asked, index.select("id", "v", F.lit(0).alias("part")), k, [0])
    return found.join(index.select(F.col("id").alias("vec_id"), "part").distinct(), "vec_id")


def _probes(
    queries: DataFrame, index: DataFrame, router: Router, sizes: dict[int, int], parts: int, k: int, recall: float
) -> int:
    """The fewest parts that hold ``recall`` of the calibration queries' true neighbours, and k + 1 rows for each."""
    some = written(queries.orderBy(F.xxhash64("id"), "id").limit(CALIBRATION), "calibration")
    order = some.mapInArrow(_turns(router, parts), "query_id long, part int, turn int")
    turns = true_neighbours(some, index, k).join(order, ["query_id", "part"])
    hits = {r["turn"]: r["count"] for r in turns.groupBy("turn").count().collect()}
    total, seen = sum(hits.values()), 0
    probes = parts
    for turn in range(parts):
        seen += hits.get(turn, 0)
        if seen >= recall * total:
            probes = turn + 1
            break
    # Even the smallest parts together must hold enough rows.
    least = sorted(sizes.get(p, 0) for p in range(parts))
    enough = next((i + 1 for i in range(parts) if sum(least[: i + 1]) > k), parts)
    return max(probes, enough)
