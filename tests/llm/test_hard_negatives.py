"""Hard negatives against plain Python; the intervals hold every product."""

import math

import numpy as np
import pytest

from tierstat.llm import hard_negatives as hn

NAN, INF = float("nan"), float("inf")


def plain(rows, every=50, positives=5, negatives=3):
    """``rows``: (id, vector, label); repeated ids keep the smallest (label, vector)."""
    use = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = (label, [math.floor(256 * x) for x in v])
        use[i] = min(use.get(i, w), w)
    out = set()
    for a, (label, v) in use.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, m) for i, (m, w) in use.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out |= {(a, p, r + 1, i, -s, -n) for r, (n, i, _) in enumerate(fit)}
    return out


def vectors(n=700, d=24, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = centres[rng.integers(0, 12, n)] * 0.3 + rng.normal(size=(n, d)) * 0.2
    x = x.astype(np.float32).astype(float)
    rows = [(i, x[i].tolist(), int(rng.integers(0, 6))) for i in range(n)]
    rows += [(n + i, x[3].tolist(), i % 4) for i in range(120)]  # one very common vector
    rows += [(2000, None, 1), (2050, [None] + [0.1] * (d - 1), 1), (2100, [NAN] * d, 1), (2150, [INF] + [0.0] * (d - 1), 2), (2200, x[1].tolist(), None)]
    rows += [(None, x[1].tolist(), 1), rows[50], rows[50], (100, x[9].tolist(), 0), (2250, [0.0] * d, 1), (2300, [0.5] * (d - 3), 2)]
    rows += [(2301 + i, [0.5 - 0.1 * i] * (d - 3), 2 + i % 2) for i in range(9)]  # another length
    rows += [(2350, [], 1), (2351, [], 1), (2352, [], 3), (2400, [-0.4] * d, 7), (2401, [0.4] * d, 7)]  # empty; only a negative positive
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, v, m, "own", 1.0) for i, v, m in vectors()]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, rest double").repartition(5).cache()


@pytest.mark.parametrize(("block", "levels"), [(8192, hn.LEVELS), (100, 1)])
def test_against_plain_python(table, block, levels):
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    want = plain(rows)
    got = hn.hard_negatives(table, block=block, levels=levels).collect()
    assert len(want) > 100 and {tuple(r) for r in got} == want and len(got) == len(want)


def test_empty_and_lone_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(empty).collect() == []
    lone = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 2)], "vec_id long, embedding array<double>, label int")
    assert hn.hard_negatives(lone).collect() == []


def test_components_too_large_stop(spark):
    df = spark.createDataFrame([(0, [1e30], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        hn.hard_negatives(df)


@pytest.mark.parametrize("d", [1, 24, 64, 100])
@pytest.mark.parametrize("levels", [1, 4])
def test_intervals_hold_every_product(d, levels):
    rng = np.random.default_rng(d)
    v = np.concatenate([rng.integers(-300, 300, (80, d)), rng.integers(-4_000_000, 4_000_000, (20, d)), np.zeros((2, d), np.int64)])
    least, greatest = hn.intervals(v, *hn.encoded(v, levels))
    true = (v.astype(object) @ v.astype(object).T).astype(float)
    assert (least <= true).all() and (true <= greatest).all()


def test_more_levels_narrow_the_interval():
    v = np.random.default_rng(1).integers(-100, 100, (200, 64))
    widths = [np.mean(np.subtract(*hn.intervals(v, *hn.encoded(v, n))[::-1])) for n in (1, 3, 6)]
    assert widths[0] > 1.5 * widths[1] > 2 * widths[2]


def test_scores_beyond_doubles_stay_integers():
    q = np.array([[2**22 - 1, 2**22 - 3, 1]]).repeat(300, axis=1)
    assert hn._exact(q, q)[0].dtype == np.int64
    assert hn._scores(q, q, np.ones((1, 1), bool))[2][0] == sum(int(x) ** 2 for x in q[0])
