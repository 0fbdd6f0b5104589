"""Hard-negative mining by rotated one-bit codes.

Vectors become integers and are turned by one fixed rotation.  A vector's code
is the sign of each rotated component; with it are stored the length and the
code-vector alignment (the vector's component along its code).  What the code
leaves over, the residual, is coded again in the same way, ``LEVELS`` times in
all, and only the last residual's length is kept.  An anchor is rounded to
``PLANES`` bit planes, so its products with codes are popcounts; they estimate
its product with the vector, and Cauchy-Schwarz on the last residual and on the
rounding gives an interval that holds the true product for certain.  Only
vectors whose interval can matter are scored in integers.

Every anchor meets every row, in tiles of ``BLOCK`` rows and ``ANCHORS``
anchors; a tile hands on at most the wanted number of rows for each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstat.llm.common import ship, written

POSITIVES = 5  # of an anchor
NEGATIVES = 3  # of an anchor and positive
LOWEST, HIGHEST = 50, 95  # a negative's score, in hundredths of the positive's
QUANTUM = 256  # integer steps of one unit
LEVELS = 6
PLANES = 8
BLOCK = 8192  # rows of a tile
ANCHORS = 4096  # anchors of a tile
_STRIP = 1 << 16  # pairs estimated at once: what is computed for them stays in the processor's cache
LARGEST = 1 << 22  # of an integer component
ship(__name__)


_rotations: dict[int, np.ndarray] = {}


def rotation(d: int) -> np.ndarray:
    """One fixed orthogonal matrix for each length."""
    if d not in _rotations:
        _rotations.clear()  # one at a time is held
        _rotations[d] = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0] if d else np.zeros((0, 0))
    return _rotations[d]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    n, d = bits.shape
    padded = np.zeros((n, -(-max(d, 1) // 64) * 64), bool)
    padded[:, :d] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def encoded(v: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (level, row, word), alignments (level, row), last residual's and vector's length of the rows of ``v``."""
    rest = v.astype(np.float64) @ rotation(v.shape[1]).T
    length, d = np.linalg.norm(rest, axis=1), max(v.shape[1], 1)
    codes, along = [], []
    for _ in range(levels):
        sign = rest > 0
        unit = np.where(sign, 1.0, -1.0) / np.sqrt(d)
        along.append((rest * unit).sum(axis=1))
        codes.append(_packed(sign))
        rest = rest - along[-1][:, None] * unit
    return np.stack(codes), np.stack(along), np.linalg.norm(rest, axis=1), length


def _planes(q: np.ndarray, planes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes (plane, row, word) of the rotated rows of ``q``; step, integer sum and rounding's length of each row."""
    turned = q.astype(np.float64) @ rotation(q.shape[1]).T
    top = (1 << (planes - 1)) - 1
    step = np.maximum(np.abs(turned).max(axis=1, initial=0.0), 1e-9) / top
    whole = np.rint(turned / step[:, None]).astype(np.int64)
    shifted = whole + top
    bits = np.stack([_packed((shifted >> p & 1).astype(bool)) for p in range(planes)])
    return bits, step, whole.sum(axis=1), np.linalg.norm(turned - whole * step[:, None], axis=1)


def intervals(q: np.ndarray, codes: np.ndarray, along: np.ndarray, rest: np.ndarray, length: np.ndarray, planes: int = PLANES) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (anchor, row) between which the products of the anchors ``q`` with the encoded rows lie."""
    bits, step, total, off = _planes(q, planes)
    d, top = max(q.shape[1], 1), (1 << (planes - 1)) - 1
    middle = np.zeros((len(q), codes.shape[1]))
    for code, a in zip(codes, along, strict=True):
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int32)
        met = np.zeros(middle.shape, np.int32)
        for p in range(planes):
            for w in range(code.shape[1]):
                met += np.bitwise_count(bits[p, :, w, None] & code[None, :, w]).astype(np.int32) << p
        # Sum of sign times integer: twice the sum over set bits less the sum over all.
        dot = 2.0 * (met - top * ones[None, :]) - total[:, None]
        middle += dot * (step[:, None] / np.sqrt(d)) * a[None, :]
    size = np.linalg.norm(q.astype(np.float64), axis=1)
    slack = (size + off)[:, None] * rest[None, :] + off[:, None] * length[None, :] + 1e-9 * size[:, None] * length[None, :] + 1e-6
    return middle - slack, middle + slack


def _exact(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``q`` and ``v`` as doubles if no sum of products can be too large for exact whole doubles, else as they are."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(v).max(initial=0)) * q.shape[1]
    return (q.astype(np.float64), v.astype(np.float64)) if most < 1 << 53 else (q, v)


def _scores(q: np.ndarray, v: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and integer product of every wanted pair of the rows of ``q`` and ``v``."""
    row, col = np.nonzero(wanted)
    score, ends = np.empty(len(row), np.int64), np.searchsorted(row, np.arange(len(q) + 1))
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        score[a:b] = v[col[a:b]] @ q[i]
    return row, col, score


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` best of each group: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    return order[np.arange(len(g)) - np.searchsorted(g, g, "left") < most]


def _kth_largest(x: np.ndarray, k: int) -> np.ndarray:
    return np.partition(x, -k, axis=1)[:, -k] if x.shape[1] >= k else np.full(len(x), -np.inf)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """List column of equally long integer lists."""
    flat = column.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else flat.chunk(0)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), -1)


def _strips(rows: int, columns: int) -> Iterator[slice]:
    step = max(1, _STRIP // max(columns, 1))
    for at in range(0, rows, step):
        yield slice(at, min(at + step, rows))


def _codes(table: pa.Table, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(table)
    codes = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint64).reshape(n, levels, -1).transpose(1, 0, 2)
    along = np.ascontiguousarray(table["along"].combine_chunks().flatten().to_numpy().reshape(n, levels).T)
    return codes, along, table["rest"].to_numpy(), table["length"].to_numpy()


def _encode(levels: int):
    """Rows (id, label, v) with code, along, rest and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(2)], np.int64)
            for d in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == d)))
                v = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, d)
                codes, along, rest, length = encoded(v, levels)
                columns = [pa.array([codes[:, i].tobytes() for i in range(len(v))], pa.binary()), pa.array(list(along.T)), pa.array(rest), pa.array(length)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=["id", "label", "v", "code", "along", "rest", "length"])

    return run


def _tile_positives(most: int, levels: int):
    """The ``most`` best rows of the anchor's label in a tile."""
    out = pa.schema([("anchor_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(anchors) and len(rows):
            rows = rows.sort_by("label")
            label, ids, v = rows["label"].to_numpy(), rows["id"].to_numpy(), _matrix(rows["v"])
            codes, along, rest, length = _codes(rows, levels)
            anchor_label, anchor_id, q = anchors["label"].to_numpy(), anchors["id"].to_numpy(), _matrix(anchors["v"])
            exact_q, exact_v = _exact(q, v)
            for one in np.unique(anchor_label):
                low, high = np.searchsorted(label, one, "left"), np.searchsorted(label, one, "right")
                mine = np.flatnonzero(anchor_label == one)
                for s in _strips(len(mine), high - low) if high > low else ():
                    a = mine[s]
                    least, greatest = intervals(q[a], codes[:, low:high], along[:, low:high], rest[low:high], length[low:high])
                    own = anchor_id[a][:, None] == ids[None, low:high]
                    least[own] = greatest[own] = -np.inf
                    wanted = greatest >= np.maximum(_kth_largest(least, most), -1e300)[:, None]
                    row, col, score = _scores(exact_q[a], exact_v[low:high], wanted)
                    best = _first(row, score, ids[low:high][col], most)
                    found.append((anchor_id[a][row[best]], ids[low:high][col[best]], score[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=out)

    return run


def _tile_negatives(most: int, levels: int, lowest: int, highest: int):
    """The ``most`` best rows of another label in a tile for each positive of the anchor."""
    out = pa.schema([(n, pa.int64()) for n in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")])

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(anchors) and len(rows):
            label, ids, v = rows["label"].to_numpy(), rows["id"].to_numpy(), _matrix(rows["v"])
            codes, along, rest, length = _codes(rows, levels)
            anchor_label, anchor_id, q = anchors["label"].to_numpy(), anchors["id"].to_numpy(), _matrix(anchors["v"])
            positives = anchors["positives"].to_pylist()
            slots = max(len(p) for p in positives)
            score_of = np.full((len(positives), slots), -1, np.int64)  # below zero no score fits
            id_of = np.zeros((len(positives), slots), np.int64)
            for i, ps in enumerate(positives):
                for j, p in enumerate(ps):
                    score_of[i, j], id_of[i, j] = p["score"], p["vec_id"]
            low, high = -(-lowest * score_of // 100), highest * score_of // 100
            exact_q, exact_v = _exact(q, v)
            for s in _strips(len(q), len(ids)):
                least, greatest = intervals(q[s], codes, along, rest, length)
                same = anchor_label[s][:, None] == label[None, :]
                greatest[same] = least[same] = -np.inf
                wanted = np.zeros(greatest.shape, bool)
                for j in range(slots):
                    a, b = low[s, j][:, None], np.where(score_of[s, j] >= 0, high[s, j], -np.inf)[:, None]
                    fits = (greatest >= a) & (least <= b)
                    # Rows inside the bounds for certain; below the last wanted of them no other one counts.
                    sure = fits & (least >= a) & (greatest <= b)
                    for i in np.flatnonzero(np.count_nonzero(sure, axis=1) >= most).tolist():
                        fits[i] &= greatest[i] >= np.partition(least[i][sure[i]], -most)[-most]
                    wanted |= fits
                row, col, score = _scores(exact_q[s], exact_v, wanted)
                for j in range(slots):
                    p = score_of[s, j][row]
                    fits = np.flatnonzero((p >= 0) & (score >= low[s, j][row]) & (score <= high[s, j][row]))
                    best = fits[_first(row[fits], score[fits], ids[col[fits]], most)]
                    found.append((anchor_id[s][row[best]], id_of[s, j][row[best]], p[best], ids[col[best]], score[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=out)

    return run


def usable(vectors: DataFrame, vec_id: str, label: str, embedding: str, quantum: int) -> DataFrame:
    """Rows (id, label, v) that take part, one for each id, with integer vectors."""
    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    fits = F.forall(x, lambda c: F.abs(c * quantum) < LARGEST)
    fault = F.raise_error(F.concat(F.lit("components too large for integer scores in the row of id "), F.col("id"))).cast("array<int>")
    whole = F.when(fits, F.transform(x, lambda c: F.floor(c * quantum).cast("int"))).otherwise(fault)
    return rows.select("id", "label", whole.alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*")


def _dealt(df: DataFrame, size: Column, blocks: Column, own: str, other: str, others: Column) -> DataFrame:
    """``df`` with d, its own block and one copy for each block of the other side."""
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    return df.withColumn("d", size).withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), (others - 1).cast("int"))))


def _tiles(anchors: DataFrame, rows: DataFrame, search, kind: str, n_anchors: int, n_rows: int, block: int) -> DataFrame:
    row_blocks, anchor_blocks = F.lit(max(1, -(-n_rows // block))), F.lit(max(1, -(-n_anchors // ANCHORS)))
    size, key = F.size("v"), ["d", "rb", "ab"]
    a = _dealt(anchors, size, anchor_blocks, "ab", "rb", row_blocks)
    r = _dealt(rows, size, row_blocks, "rb", "ab", anchor_blocks)
    return a.groupBy(*key).cogroup(r.groupBy(*key)).applyInArrow(search, kind)


def hard_negatives(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", every: int = 50,
    positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST,
    quantum: int = QUANTUM, levels: int = LEVELS, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows whose id ``every`` divides.

    Scores are inner products of floor(``quantum`` * component); higher ones come first, ties by smaller id.  An
    anchor's ``positives`` are its first other rows of the same label; for each of them come the first
    ``negatives`` rows of other labels that score ``lowest`` to ``highest`` hundredths of the positive.

    Rows with a null id or label, a null vector, or a component that is null or not finite take no part.  Vectors
    meet only vectors of their length.  Of rows that share an id the one with the smallest (label, vector) counts.  Of equal vectors with equal
    label those with the smallest ids are compared, as many as can be among the first.  A component
    of ``LARGEST`` steps or more stops the query: its products would not fit a long.
    """
    rows = written(usable(vectors, vec_id, label, embedding, quantum), "integers")
    same = Window.partitionBy("label", "v").orderBy("id")
    place = F.row_number().over(same)
    distinct = rows.withColumn("place", place).where(F.col("place") <= max(positives + 1, negatives)).select("id", "label", "v")
    kind = "id long, label long, v array<int>, code binary, along array<double>, rest double, length double"
    index = written(distinct.mapInArrow(_encode(levels), kind), "codes")
    anchors = written(rows.where(F.pmod("id", F.lit(every)) == 0), "anchors")
    counts = (anchors.count(), index.count(), block)
    near = _tiles(anchors, index, _tile_positives(positives, levels), "anchor_id long, vec_id long, score long", *counts)
    best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    near = near.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))  # at most ``positives``
    asked = written(anchors.join(near.withColumnRenamed("anchor_id", "id"), "id").select("id", "label", "v", "positives"), "asked")
    kind = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _tiles(asked, index, _tile_negatives(negatives, levels, lowest, highest), kind, *counts)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
