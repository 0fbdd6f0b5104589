"""Window pipelines against plain-Python restatements of the heap rules, on random data."""

import heapq
import random

import pytest

from tierstat import operators as op
from tierstat.functions import global_row_number

SCHEMA = (
    "time_period string, geographic_level string, region_name string, la_name string, "
    "school_type string, sess_overall_percent double"
)


def _random_grid(rng: random.Random):
    periods = [f"{2000 + i}/{(i + 1) % 100:02d}" for i in range(rng.randint(2, 6))]
    regions = [f"R{i:02d}" for i in range(rng.randint(2, 9))]
    values = [1.0, 2.5, 4.5, 10.1, 3.25]  # few values: many ties, one above 10
    cells = {}
    for p in periods:
        for r in regions:
            if rng.random() < 0.85:
                cells[(r, p)] = rng.choice(values)
    rows = [(p, "National", None, None, "Total", 5.0) for p in periods]
    rows += [(p, "Regional", r, None, "Total", v) for (r, p), v in cells.items()]
    return periods, regions, cells, rows


def _heap_ranking(periods, regions, cells):
    """Dense grid with 0 fill; per period pop a heap of (value, name); mean; pop (mean, name)."""
    present = sorted({r for (r, _) in cells})
    ranks = {}
    for p in periods:
        heap = [(cells.get((r, p), 0), r) for r in present]
        heapq.heapify(heap)
        for pos in range(1, len(present) + 1):
            _, r = heapq.heappop(heap)
            ranks[(r, p)] = pos
    means = [(sum(ranks[(r, p)] for p in periods) / len(periods), r) for r in present]
    heapq.heapify(means)
    final = [(i, heapq.heappop(means)[1]) for i in range(1, len(present) + 1)]
    return ranks, final


@pytest.mark.parametrize("seed", range(6))
def test_ranking_matches_heap(spark, seed):
    periods, regions, cells, rows = _random_grid(random.Random(seed))
    df = spark.createDataFrame(rows, SCHEMA)
    ranks, final = _heap_ranking(periods, regions, cells)
    got = {(r[0], r[1]): r[3] for r in op.rank_matrix(df).collect()}
    assert got == ranks
    assert [tuple(r) for r in op.region_ranking(df).collect()] == final


def _reason_rows(rng: random.Random):
    reasons = ["sess_auth_" + n for n in ("a", "b", "c", "d", "e", "f")]
    rows, expected = [], {}
    for i in range(rng.randint(3, 12)):
        period = f"{2000 + i}/{(i + 1) % 100:02d}"
        values = [rng.choice([None, 0, 3, 3, 7, 12]) for _ in reasons]
        rows.append((period, *values))
        heap = [(-(v if v is not None else 0), r[len("sess_auth_"):]) for r, v in zip(reasons, values)]
        heapq.heapify(heap)
        expected[period] = tuple(heapq.heappop(heap)[1] for _ in range(3))
    return reasons, rows, expected


@pytest.mark.parametrize("seed", range(4))
def test_top3_matches_heap(spark, seed):
    reasons, rows, expected = _reason_rows(random.Random(seed))
    schema = "time_period string, " + ", ".join(f"{r} bigint" for r in reasons)
    df = spark.createDataFrame(rows, schema)
    got = {r[0]: tuple(r[1:]) for r in op.top_reasons(df, 3, reasons=reasons).collect()}
    assert got == expected


def test_global_row_number_is_a_total_order(spark):
    rng = random.Random(7)
    data = [(rng.randint(0, 50), f"k{i:05d}") for i in range(5000)]
    df = spark.createDataFrame(data, "v int, k string").repartition(13)
    got = [(r.v, r.k, r.pos) for r in global_row_number(df, ["v", "k"]).orderBy("pos").collect()]
    expected = [(v, k, i + 1) for i, (v, k) in enumerate(sorted(data))]
    assert got == expected


def test_percent_rounds_half_up_and_nulls_zero_denominators(spark):
    """percent(n, d) = round(n / d * 100, 3) HALF_UP on the double's shortest decimal form."""
    from decimal import ROUND_HALF_UP, Decimal

    from tierstat.functions import percent

    rng = random.Random(11)
    pairs = [(rng.randint(0, 10**7), rng.choice([0, 1, 3, 7, 8, 16, 2000, rng.randint(1, 10**7)])) for _ in range(2000)]
    pairs += [(1, 2000), (5, 8000), (1, 16), (0, 0), (3, 0)]  # exact ties at the 4th place; zero denominators
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(percent("n", "d")).collect()]
    for (n, d), value in zip(pairs, got):
        if d == 0:
            assert value is None
        else:
            expected = float(Decimal(repr(n / d * 100)).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP))
            assert value == expected, (n, d, value, expected)


@pytest.mark.parametrize("seed", range(3))
def test_compare_sum_matches_pandas(spark, seed):
    import pandas as pd

    rng = random.Random(100 + seed)
    rows = []
    for period in ("2001/02", "2002/03"):
        for area in ("A", "B", "C"):
            for cat in ("Total", "P", "S", "X"):
                for _ in range(rng.randint(0, 2)):  # duplicates and gaps
                    rows.append((period, "Local authority", area, cat,
                                 rng.choice([None, 0, 1, 5, 9]), rng.choice([None, 2, 3])))
    rows.append(("2001/02", "Regional", "A", "P", 100, 100))  # other levels never count
    schema = "time_period string, geographic_level string, la_name string, school_type string, m1 long, m2 long"
    df = spark.createDataFrame(rows, schema)
    areas = [rng.choice("ABC"), rng.choice("ABC")]
    got = sorted(tuple(r) for r in op.compare_sum(df, ["m1", "m2"], areas, "2001/02").collect())

    pdf = pd.DataFrame(rows, columns=["time_period", "geographic_level", "la_name", "school_type", "m1", "m2"])
    pick = pdf[(pdf.time_period == "2001/02") & (pdf.geographic_level == "Local authority") & (pdf.school_type != "Total")]
    expected = []
    for side, area in enumerate(areas, start=1):
        part = pick[pick.la_name == area]
        if len(part):
            sums = [part[m].dropna() for m in ("m1", "m2")]
            expected.append((side, area, *[int(s.sum()) if len(s) else None for s in sums]))
    assert got == sorted(expected)


def test_period_label_matches_its_rule(spark):
    """A separator before the last two characters; shorter strings stay as they are."""
    from tierstat.sources import period_label

    rng = random.Random(5)
    codes = ["".join(rng.choice("0123456789") for _ in range(rng.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r[0] for r in df.select(period_label("c", "-")).collect()]
    assert got == [c[:-2] + "-" + c[-2:] if len(c) >= 2 else c for c in codes]


def test_lenient_long_matches_its_rule(spark):
    """Text to bigint as the lenient load reads it: a decimal number is truncated, else null."""
    import math
    import re

    from tierstat.functions import lenient_long

    def rule(s):
        if re.fullmatch(r"\s*[+-]?\d+\s*", s):  # a whole number is read exactly
            return int(s) if -(2**63) <= int(s) < 2**63 else None
        try:
            x = float(s)
        except ValueError:
            return None
        if "_" in s or not math.isfinite(x) or not (-(2**63) <= x < 2**63):
            return None
        return int(x)

    rng = random.Random(9)
    texts = ["".join(rng.choice("0123456789.-e x") for _ in range(rng.randint(0, 6))) for _ in range(500)]
    texts += ["9007199254740993", "-9223372036854775808", "9223372036854775808", "12.0", "-1.9", "1e3", " 12 ", "1e19", "1e400", "x", "", "5.", ".5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(lenient_long("t")).collect()]
    assert got == [rule(t) for t in texts]


def _pct(n, d):
    from decimal import ROUND_HALF_UP, Decimal

    if n is None or d is None or d == 0:
        return None
    return float(Decimal(repr(n / d * 100)).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP))


@pytest.mark.parametrize("seed", range(3))
def test_compare_report_matches_a_python_restatement(spark, seed):
    from tierstat.plans import compare_report
    from tierstat.plans.compare_report import _MEASURES
    from tierstat.roles import AUTH_REASONS, AUTH_TOTAL, UNAUTH_REASONS, UNAUTH_TOTAL

    rng = random.Random(300 + seed)
    cols = ["time_period", "geographic_level", "la_name", "school_type", *_MEASURES]
    rows = []
    for area in ("A", "B"):
        for cat in ("Total", "P", "S", "X"):
            for _ in range(rng.randint(0, 2)):
                rows.append(("2001/02", "Local authority", area, cat,
                             *[rng.choice([None, 0, 1, 4, 7, 20]) for _ in _MEASURES]))
    schema = ", ".join(f"`{c}` string" if i < 4 else f"`{c}` long" for i, c in enumerate(cols))
    df = spark.createDataFrame(rows, schema)
    first, second = rng.choice("AB"), rng.choice("AB")
    got = [
        (r.section, r.side, r.la_name, r.metric, r.value, r.percent)
        for r in compare_report(df, first, second, "2001/02").collect()
    ]

    def total(values):
        present = [v for v in values if v is not None]
        return sum(present) if present else None

    expected = []
    for side, area in ((1, first), (2, second)):
        picked = [dict(zip(cols, r)) for r in rows if r[2] == area and r[3] != "Total"]
        if not picked:
            continue
        per_cat = {}
        for r in picked:
            per_cat.setdefault(r["school_type"], []).append(r)
        a = {m: total([r[m] for r in picked]) for m in _MEASURES}

        def sub(x, y):
            return None if x is None or y is None else x - y

        normal = sub(a["sess_possible"], a["sess_overall"])
        exc_pa = sub(a["sess_overall"], a["sess_overall_pa_10_exact"])
        entries = [
            ("enrolment", "enrolments", a["enrolments"], None),
            ("enrolment", "enrolments_pa_10_exact", a["enrolments_pa_10_exact"],
             _pct(a["enrolments_pa_10_exact"], a["enrolments"])),
            ("sessions", "sess_possible", a["sess_possible"], None),
            ("sessions", "sess_normal", normal, _pct(normal, a["sess_possible"])),
            ("sessions", "sess_overall_exc_pa", exc_pa, _pct(exc_pa, a["sess_possible"])),
            ("sessions", "sess_overall_pa_10_exact", a["sess_overall_pa_10_exact"],
             _pct(a["sess_overall_pa_10_exact"], a["sess_possible"])),
        ]
        shares = ("sess_possible_pa_10_exact", "sess_authorised")
        entries += [("session_shares", m, a[m], _pct(a[m], a["sess_possible"])) for m in shares]
        entries += [("authorised", m, a[m], _pct(a[m], a[AUTH_TOTAL])) for m in AUTH_REASONS]
        entries.append(("authorised", AUTH_TOTAL, a[AUTH_TOTAL], None))
        entries += [("unauthorised", m, a[m], _pct(a[m], a[UNAUTH_TOTAL])) for m in UNAUTH_REASONS]
        entries.append(("unauthorised", UNAUTH_TOTAL, a[UNAUTH_TOTAL], None))
        for cat, cat_rows in per_cat.items():
            n = total([r["num_schools"] for r in cat_rows])
            entries.append(("school_type", cat, n, _pct(n, a["num_schools"])))
        expected += [(s, side, area, m, v, p) for s, m, v, p in entries]
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    assert sorted(got, key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("seed", range(4))
def test_type_region_grid_matches_its_rule(spark, seed):
    rng = random.Random(400 + seed)
    period = "2001/02"
    rows = []
    for cat in ("P", "S", "X", "Y"):  # Y only ever appears regionally
        if cat != "Y" and rng.random() < 0.8:
            rows.append((rng.choice([period, "2002/03"]), "School", None, cat, None))
    for region in ("R1", "R2", "R3"):
        for cat in ("Total", "P", "S", "X", "Y"):
            if rng.random() < 0.6:
                rows.append((rng.choice([period, period, "2002/03"]), "Regional", region, cat,
                             rng.choice([None, 1.5, 2.25, 10.1])))
    schema = "time_period string, geographic_level string, region_name string, school_type string, sess_overall_percent double"
    df = spark.createDataFrame(rows, schema)
    cats = sorted({r[3] for r in rows if r[1] == "School"})
    cells = [r for r in rows if r[0] == period and r[1] == "Regional" and r[3] != "Total"]
    regions = sorted({r[2] for r in cells})
    if not regions:
        assert op.type_region_matrix(df, period).count() == 0
        return
    expected = []
    for cat in cats:
        for region in regions:
            vals = [r[4] for r in cells if r[3] == cat and r[2] == region and r[4] is not None]
            expected.append((cat, region, max(vals) if vals else 0.0))
    got = sorted(tuple(r) for r in op.type_region_matrix(df, period).collect())
    assert got == sorted(expected)
