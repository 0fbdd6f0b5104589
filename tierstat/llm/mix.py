"""Mixing sources to target weights by entropy balancing.

Document rates w minimise sum(w log w - w + 1), the entropy distance to one
copy of each, subject to sum(w * size) = target per source and w <= 2.  The
convex dual has one multiplier per source and its solution is an exponential
tilt, w = min(2, exp(lambda * size / mean size)).  Newton steps on the
logarithm of the tilted total, kept inside a bracket, find the multipliers:
each step is one distributed aggregate over the (source, size) counts, which
are all the dual depends on; multipliers stay in a table and never reach the driver.

Rates become copies per (source, size) cell: whole copies by running totals
over the cells from large to small documents, then the words still missing
(or too many) are given to (taken from) the largest documents that fit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstat.functions.ordering import global_row_number
from tierstat.llm.common import fresh, small, text_or_empty, word_count, written

WEIGHTS = (3.0, 1.0, 2.0)  # by place of the source in code point order, repeating
SHARE = 1.5  # words taken, as a part of all words
CAP = 2  # copies at most
STEPS = 40
BUCKET = 10_000  # documents of a cell that are numbered together
SETTLED = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Rows (source, source_size, target) from cells (source, size, n).

    Sources in code point order, null last, take ``weights`` in turn and share
    ``share`` of all words; none gets more than ``cap`` times its own, the
    excess is shared again among the others.  A table without words gives targets of 0.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    # One row per source.  UTF-8 byte order, Spark's order of strings, is code point order.
    placed = global_row_number(totals, order, "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = placed.withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    table = written(placed.withColumn("most", F.col("source_size") * float(cap)), "sources")
    level = None
    capped = F.lit(False)
    while True:  # the water level only rises, and each turn caps one source more at least
        free, used, total, held = table.agg(
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.sum(F.when(capped, F.col("most")).otherwise(0.0)),
            F.sum("source_size"), F.count_if(capped),
        ).first()
        if not free:
            break
        level = max(0.0, share * float(total) - used) / free
        capped = F.col("most") < F.col("weight") * F.lit(level)
        if table.where(capped).count() == held:
            break
    if level is None:
        return table.select("source", "source_size", F.lit(0.0).alias("target"))
    target = F.least(F.col("most"), F.col("weight") * F.lit(level)).cast("double")
    return table.select("source", "source_size", target.alias("target"))


def _tilt(cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("x"), F.lit(50.0))))


def multipliers(cells: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Rows (source, mean, lam): the dual's solution for sources whose target lies between 0 and the cap."""
    stats = cells.where("size > 0").groupBy(F.col("source").alias("src")).agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.sum("n").alias("docs"), F.min("size").alias("least"),
    )
    inside = targets.where((F.col("target") > 0) & (F.col("target") < F.col("source_size") * float(cap)))
    start = inside.join(stats, F.col("source").eqNullSafe(F.col("src"))).select(
        "source", "mean", (F.col("target") / F.col("mean")).alias("goal"), F.lit(0.0).alias("lam"),
        # Outside these the total is surely above or below the goal: every document at the cap, or all below goal / docs.
        ((F.col("mean") / F.col("least")) * F.least(F.lit(0.0), F.log(F.col("target") / F.col("mean") / F.col("docs"))) - 1.0).alias("lo"),
        ((F.col("mean") / F.col("least")) * math.log(cap) + 1.0).alias("hi"),
    )
    state = written(start, "multipliers")
    for _ in range(STEPS):
        s = state.withColumnRenamed("source", "src")
        tilted = cells.where("size > 0").join(s, F.col("source").eqNullSafe(F.col("src")))
        tilted = tilted.withColumn("x", F.col("size") / F.col("mean")).withColumn("w", _tilt(cap))
        mass = F.col("n") * F.col("x") * F.col("w")
        # Decimal sums do not depend on the order of their terms, so reruns agree to the last bit.
        exact = lambda c: F.sum(c.cast("decimal(38,12)")).cast("double")
        step = tilted.groupBy("src", "mean", "goal", "lam", "lo", "hi").agg(
            exact(mass).alias("f"), exact(F.when(F.col("w") < cap, mass * F.col("x")).otherwise(0.0)).alias("slope")
        )
        above = F.col("f") > F.col("goal")
        step = step.withColumn("lo", F.when(above, F.col("lo")).otherwise(F.col("lam"))).withColumn(
            "hi", F.when(above, F.col("lam")).otherwise(F.col("hi"))
        )
        newton = F.col("lam") - F.when(F.col("slope") > 0, F.log(F.col("f") / F.col("goal")) * F.col("f") / F.col("slope"))
        good = (newton > F.col("lo")) & (newton < F.col("hi"))
        off = F.abs(F.col("f") / F.col("goal") - 1.0)
        step = step.withColumn("off", off).withColumn(
            "lam", F.when(off <= SETTLED, F.col("lam")).when(good, newton).otherwise((F.col("lo") + F.col("hi")) / 2)
        )
        state = written(step.select(F.col("src").alias("source"), "mean", "goal", "lam", "lo", "hi", "off"), "multipliers")
        worst = state.agg(F.max("off")).first()[0]
        if worst is None or worst <= SETTLED:
            return state.select("source", "mean", "lam")
        state = state.drop("off")
    raise RuntimeError(f"the multipliers did not settle in {STEPS} steps; the worst source is off by {worst:.3g} of its target")


def copies_per_cell(cells: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Cells (source, size, n) with ``target``, ``source_size`` and ``m``, the copies of all the cell's documents."""
    lam = multipliers(cells, targets, cap).withColumnRenamed("source", "src")
    t = targets.withColumnRenamed("source", "tsrc")
    rated = cells.join(t, F.col("source").eqNullSafe(F.col("tsrc"))).drop("tsrc")
    rated = rated.join(lam, F.col("source").eqNullSafe(F.col("src")), "left").drop("src")
    rated = rated.withColumn("x", F.col("size") / F.col("mean")).withColumn(
        "w",
        F.when(F.col("size") == 0, 1.0)
        .when(F.col("lam").isNotNull(), _tilt(cap))
        .when(F.col("target") <= 0, 0.0)
        .otherwise(float(cap)),
    )
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    whole = Window.partitionBy("source")
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    run = F.sum((F.col("n") * F.col("w")).cast("decimal(38,9)"))
    total = run.over(down.rowsBetween(Window.unboundedPreceding, 0))
    m = F.floor(total + F.lit(0.5)) - F.floor(F.coalesce(run.over(before), F.lit(0)) + F.lit(0.5))
    out = rated.withColumn("m", F.least(F.greatest(m.cast("long"), F.lit(0)), F.col("n") * cap).cast("long"))
    for _ in range(4):  # what is still missing halves at least each time
        out = out.withColumn("gap", F.round(F.col("target") - F.sum(F.col("m") * F.col("size")).over(whole)).cast("long"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("gap"))
        room = F.when(fits, F.when(F.col("gap") > 0, F.col("n") * cap - F.col("m")).otherwise(F.col("m"))).otherwise(0)
        out = out.withColumn("room", room.cast("long"))
        ahead = F.coalesce(F.sum(F.col("room") * F.col("size")).over(before), F.lit(0))
        out = out.withColumn("left", F.greatest(F.abs("gap") - ahead, F.lit(0)))
        step = F.least(F.col("room"), F.floor(F.col("left") / F.greatest("size", F.lit(1))).cast("long"))
        out = out.withColumn("m", F.col("m") + F.signum("gap").cast("long") * step).drop("gap", "room", "left")
    return out.select("source", "size", "n", "source_size", "target", "m")


def with_copies(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, bucket: int = BUCKET,
) -> DataFrame:
    """Every row of ``documents`` with ``copies`` (0, 1 or ... ``cap``), ``size``, ``source_size`` and ``target``.

    All columns stay; the four added ones replace input columns of these names.
    Size is the number of words (null text: 0).  A null source is a source of
    its own, last in order.  Documents without words have one copy.  Which of equally long
    documents of a source gets the extra copy follows a hash of the id, so
    reruns agree; repeated rows count each.
    """
    added = {"size", "source_size", "target", "copies"}
    base = documents.drop(*[c for c in documents.columns if c.lower() in added and c not in (doc_id, text, source)])
    crc = F.crc32(text_or_empty(text).cast("binary"))
    name = {k: fresh(base.columns, k) for k in ("_source", "_none", "_size", "_n", "_m", "_target", "_total", "_rank", "_crc", "_bucket", "_offset", "_parts")}
    rows = base.withColumns({name["_size"]: word_count(text), name["_crc"]: crc})
    rows = rows.withColumns({name["_source"]: F.coalesce(F.col(source), F.lit("")), name["_none"]: F.col(source).isNull()})
    key = [name["_source"], name["_none"], name["_size"]]
    cells = (
        documents.select(F.col(source).alias("source"), word_count(text).alias("size"))
        .groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    )
    cells = written(cells, "cells")
    targets = written(source_targets(cells, weights, share, cap), "targets")
    planned = written(copies_per_cell(cells, targets, cap), "copies").select(
        F.coalesce("source", F.lit("")).alias(key[0]), F.col("source").isNull().alias(key[1]), F.col("size").alias(key[2]),
        F.col("n").alias(name["_n"]), F.col("m").alias(name["_m"]),
        F.col("target").alias(name["_target"]), F.col("source_size").alias(name["_total"]),
    )
    order = [F.xxhash64(F.col(doc_id)), F.col(doc_id), F.col(name["_crc"])]
    n, m, part = F.col(name["_n"]), F.col(name["_m"]), name["_bucket"]
    # A cell's documents are numbered in buckets of about ``bucket``; only cells of several need the buckets' offsets.
    parts = planned.where(n > bucket).select(*key, F.ceil(n / bucket).alias(name["_parts"]))
    several = not parts.isEmpty()
    dealt = rows.join(small(parts), key, "left") if several else rows.withColumn(name["_parts"], F.lit(None).cast("long"))
    place = F.pmod(F.xxhash64(F.col(doc_id), F.col(name["_crc"])), F.col(name["_parts"]))
    dealt = dealt.withColumn(part, F.coalesce(place, F.lit(0)).cast("int"))
    ranked = dealt.withColumn(name["_rank"], F.row_number().over(Window.partitionBy(*key, part).orderBy(*order)) - 1)
    # A cell's plan, once for each of its buckets, meets the rows where they were numbered: they do not move again.
    each_part = F.sequence(F.lit(0), F.greatest(F.ceil(n / bucket), F.lit(1)).cast("int") - 1)
    planned = planned.withColumn(part, F.explode(each_part))
    if several:
        counts = dealt.where(F.col(name["_parts"]).isNotNull()).groupBy(*key, part).agg(F.count(F.lit(1)).alias("count"))
        before = Window.partitionBy(*key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(*key, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(name["_offset"]))
        planned = planned.join(written(offsets, "offsets"), [*key, part], "left")
    else:
        planned = planned.withColumn(name["_offset"], F.lit(0))
    ranked = ranked.join(planned.hint("merge"), [*key, part])
    place = F.col(name["_rank"]) + F.coalesce(F.col(name["_offset"]), F.lit(0))
    each = F.floor(m / n).cast("int") + F.when(place < m % n, 1).otherwise(0)
    return (
        ranked
        .withColumns({"copies": each, "size": F.col(name["_size"]), "source_size": F.col(name["_total"]), "target": F.col(name["_target"])})
        .select(*[F.col(f"`{c}`") for c in base.columns], "size", "source_size", "target", "copies")
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """``documents`` as the mix has them: each row as many times as it has copies, all columns with their own values."""
    # Columns that with_copies would replace keep their values under other names meanwhile.
    added = {"size", "source_size", "target", "copies"}
    used = {options.get(k, k) for k in ("doc_id", "text", "source")}
    taken = [*documents.columns, *added]
    aside = {c: fresh(taken, f"_{c}") for c in documents.columns if c.lower() in added and c not in used}
    planned = with_copies(documents.withColumnsRenamed(aside), **options)
    repeats = F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias(fresh([*planned.columns, *documents.columns], "_repeat"))
    back = [F.col(f"`{aside.get(c, c)}`").alias(c) for c in documents.columns]
    return planned.where("copies > 0").select(*back, repeats).select(*[F.col(f"`{c}`") for c in documents.columns])
