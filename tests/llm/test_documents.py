"""Operators on documents against plain Python, with nulls, empty and long texts, ties, repeats and clashing columns."""

import math
import re
import subprocess
import sys
import zlib
from collections import Counter

import pytest
import xxhash
from conftest import ROOT, SF001
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from oracle_compare import compare, duck
from tierstat.llm import common, decontaminate, mix, queries, shard, simhash

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
        StructField("source", StringType()), StructField("n_chars", LongType()),
        # Names that the operators use themselves.
        StructField("shard", StringType()), StructField("size", DoubleType()), StructField("_key", LongType()),
        StructField("digest", StringType()), StructField("copies", StringType()), StructField("_bucket", StringType()),
    ]
)
ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"word{i * i % 4801}" for i in range(30000))


def _text(i):
    return " ".join(f"w{(i * 37 + j * j * (i % 11 + 1)) % 977}" for j in range(5 + i % 40))


TEXTS = [
    *[_text(i) for i in range(60)],
    f"before, {ITEM.upper()}! after that comes more text of its own",  # another case and marks around it
    f"{LONG} {ITEM} {LONG[:500]}",  # a short item deep inside a long text
    ITEM.replace("mu", "MU changed"),  # an edit: still above 0.8? 20 words, 4 shingles gone of 16 -> no
    " ".join(ITEM.split()[:19]) + " other end",  # 15 of 16 shingles
    "just three words", "", " \t\n", None, "ümlaut ΣΑΣ straße", _text(7), _text(7) + " plus", "z" * 300_000,
]


def _row(doc_id, text, source):
    return (doc_id, text, None, source, None, "x", 1.5, 3, "d", "c", "b")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [_row(i, t, None if i % 9 == 0 else f"s{i % 4}") for i, t in enumerate(TEXTS)]
    rows += [_row(None, TEXTS[3], "s1"), _row(None, None, None), rows[5], rows[5], _row(5, "another text, same id", "s2")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(0, ITEM), (1, "just three words"), (2, None), (3, ""), (None, _text(30)), (4, "never seen here at all by anybody"), (0, ITEM)]
    return spark.createDataFrame(rows, "item_id long, text string")


def shingles(text, width=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set()


def held(doc, item):
    """(shared, shingles of the item): an item of fewer than five words is one shingle of its own length."""
    width = min(5, len(re.findall(r"[^\W_]+", (item or "").lower())))
    b = shingles(item, width) if width else set()
    return len(shingles(doc, width) & b) if b else 0, len(b)


def test_decontamination_against_brute_force(docs, items):
    got = {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in decontaminate.contained_items(docs, items).collect()}
    want = set()
    for d in docs.select("doc_id", "text").collect():
        for i in set(items.collect()):
            shared, n = held(d.text, i.text)
            if n and shared >= math.ceil(round(n * 0.8, 6)):
                want.add((d.doc_id, i.item_id, shared, n))
    assert got == want
    assert {(60, 0), (61, 0), (63, 0), (64, 1), (30, None)} <= {x[:2] for x in got} and 62 not in {x[0] for x in got}


def test_short_items_inside_long_documents(docs, spark, monkeypatch):
    texts = {0: "word1 Word4", 1: "epsilon", 2: "mu nu xi", 3: "kappa lambda mu nu", 4: "nu mu", 5: "straße", 6: ITEM, 7: "w37 w37", 8: "x" * 200_000}
    items = spark.createDataFrame(list(texts.items()), "item_id int, text string")
    want = set()
    for d in docs.select("doc_id", "text").collect():
        for i, t in texts.items():
            shared, n = held(d.text, t)
            if n and shared >= math.ceil(round(n * 0.8, 6)):
                want.add((d.doc_id, i, shared, n))
    for size in (decontaminate.SLICE, 3):  # also with the hashes in several slices
        monkeypatch.setattr(decontaminate, "SLICE", size)
        got = [(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in decontaminate.contained_items(docs, items).collect()]
        assert set(got) == want and len(got) == len(want)
    assert {i for _, i, _, _ in want} >= {0, 1, 2, 3, 5, 6}


def test_contaminated_documents_go(docs, items, empty):
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in docs.collect()) - Counter(r.doc_id for r in kept.collect()) == Counter([30, 60, 61, 63, 64])
    assert decontaminate.drop_contaminated(empty, items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == docs.count()


def test_no_shingle_is_lost_by_the_sketch(spark):
    # Each document misses another fifth of the item: whatever is missing, one sketch hash is left.
    words = [f"q{i}" for i in range(60)]
    rows = [(i, " ".join(words[i : i + 49])) for i in range(12)]
    found = decontaminate.contained_items(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    )
    assert {r.doc_id for r in found.collect()} == set(range(12))


def test_sharding_law(docs, empty):
    rows = shard.shard_documents(docs).collect()
    assert len(rows) == docs.count()
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert all(r.grown_shard in (r.shard, 16) for r in rows)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    for r in rows:
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
    again = {(r.doc_id, r.text): r.shard for r in shard.shard_documents(docs.repartition(2)).collect()}
    assert all(again[r.doc_id, r.text] == r.shard for r in rows)
    assert shard.shard_documents(empty).count() == 0


def test_texts_without_an_id_are_numbered_in_many_buckets(spark):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    placed = shard.shard_documents(df, buckets=8)
    rows = placed.collect()
    assert len({r.shard for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(4000))
    checks = [r.text_crc32 for r in sorted(rows, key=lambda r: r.slot)]
    assert sum(a > b for a, b in zip(checks, checks[1:], strict=False)) == 7  # eight buckets, each in order of the checksum


def test_a_weight_moves_rows_only_in_its_subtree(spark):
    tree = {"a": {"a1": {0: 1.0, 1: 1.0}, "a2": {2: 2.0}}, "b": {"b1": {3: 1.0, 4: 3.0}}, "c": {"c1": {5: 0.0}}}
    lighter = {"a": {"a1": {0: 1.0, 1: 1.0}, "a2": {2: 1.0}}, "b": tree["b"], "c": tree["c"]}
    keys = spark.range(20000)
    moved = shard.with_shard(shard.with_shard(keys, F.col("id"), tree, "x"), F.col("id"), lighter, "y")
    sizes = {r.x: r["count"] for r in moved.groupBy("x").count().collect()}
    for s, weight in ((0, 1), (1, 1), (2, 2), (3, 1), (4, 3)):
        assert abs(sizes[s] / 20000 - weight / 8) < 0.02
    assert 5 not in sizes
    changes = moved.where("x != y").select("x", "y").distinct().collect()
    assert changes and all({r.x, r.y} & {0, 1, 2} for r in changes)  # nothing moves inside region b
    assert not [r for r in changes if {r.x, r.y} == {0, 1}]  # nor inside the unchanged rack a1


def test_gapless_rank_needs_no_single_task(spark):
    rows = common.gapless_rank(spark.range(1000).withColumn("g", F.col("id") % 3), ["g"], [F.col("id")], [F.col("id")], "rank", 16).collect()
    for g in range(3):
        assert sorted(r["rank"] for r in rows if r.g == g) == list(range(sum(r.g == g for r in rows)))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mix_against_its_rules(docs, empty):
    rows = mix.with_copies(docs).collect()
    assert len(rows) == docs.count()
    total, weight = Counter(), {}
    for r in rows:
        assert r["size"] == len(words(r.text)) and 0 <= r.copies <= 2
        total[r.source] += r["size"]
    for i, s in enumerate(sorted(total, key=lambda s: (s is None, s or ""))):
        weight[s] = (3, 1, 2)[i % 3]
    want, free, left = {}, set(total), 1.5 * sum(total.values())
    while True:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 2 * total[s] < level * weight[s]}
        if not full:
            break
        want |= {s: 2.0 * total[s] for s in full}
        left, free = left - sum(2.0 * total[s] for s in full), free - full
    want |= {s: level * weight[s] for s in free}
    for s in total:
        mine = [r for r in rows if r.source == s]
        assert {r.source_size for r in mine} == {total[s]}
        assert abs(mine[0].target - want[s]) < 1e-6
        assert abs(sum(r["size"] * r.copies for r in mine) - want[s]) <= max(12, max(r["size"] for r in mine) / 2 if max(r["size"] for r in mine) > 1000 else 0)
    again = Counter((r.doc_id, r.text, r.copies) for r in mix.with_copies(docs.repartition(3)).collect())
    assert again == Counter((r.doc_id, r.text, r.copies) for r in rows)
    mixed = mix.mixed(docs)
    assert mixed.columns == docs.columns
    own = [c for c in docs.columns if c not in ("doc_id", "text")]  # also those that the plan uses names of
    want = Counter((r.doc_id, r.text, r.source) for r in rows for _ in range(r.copies))
    assert Counter((r.doc_id, r.text, r.source) for r in mixed.collect()) == want
    assert {r[3:] for r in map(tuple, mixed.select("doc_id", "text", "source", *own).collect())} <= {tuple(r) for r in docs.select(*own).collect()}
    assert mix.with_copies(empty).count() == 0 and mix.mixed(empty).count() == 0


def test_tilt_is_exponential(spark):
    cells = spark.createDataFrame([("a", 10, 40), ("a", 100, 20), ("a", 1000, 3)], "source string, size long, n long")
    targets = spark.createDataFrame([("a", 5400, 4000.0)], "source string, source_size long, target double")
    lam = mix.multipliers(cells, targets).first()
    rate = [min(2.0, math.exp(lam.lam * s / lam.mean)) for s in (10, 100, 1000)]
    assert abs(40 * 10 * rate[0] + 20 * 100 * rate[1] + 3 * 1000 * rate[2] - 4000) < 1e-3


def fingerprint(text):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(len(w) - 3, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(prints):
    """Smallest id reachable of each (id, fingerprint), by brute force."""
    parent = {p: p for _, p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 4:
                parent[find(a)] = find(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return Counter((i, f"{p:016x}", least.get(find(p))) for i, p in prints)


def test_simhash_against_brute_force(docs, empty):
    short = docs.where(F.length("text") < 200_000).unionByName(docs.where("text is null"))
    got = Counter(tuple(r) for r in simhash.simhash_groups(short).collect())
    assert got == groups([(r.doc_id, fingerprint(r.text)) for r in short.collect()])
    both = simhash.keep_one_of_each(docs).where("doc_id = 5").collect()
    assert {r.text for r in both} == {TEXTS[5], "another text, same id"}  # two groups whose smallest id is the same
    one_each = docs.where("text is null or text != 'another text, same id'")
    kept = simhash.keep_one_of_each(one_each)
    assert kept.columns == docs.columns
    ids = simhash.simhash_groups(one_each).collect()
    assert Counter(r.doc_id for r in kept.collect()) == Counter({r.component_id for r in ids})
    assert simhash.simhash_groups(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0


def test_simhash_links_chains_and_dense_groups(spark):
    import random

    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(200)]
    for base in prints[:40]:  # chains of steps of up to four bits
        p = base
        for _ in range(rng.randint(1, 12)):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                p ^= 1 << b
            prints.append(p)
    prints += [prints[0] ^ 1 << a ^ 1 << b for a in range(0, 64, 5) for b in range(1, 64, 7)]  # all close to one another
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    want = groups(list(enumerate(prints)))
    assert Counter((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in got) == want


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7000, 7000), (2, 1)]
    got = {(r.node, r.root) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(301)} | {(1000 + i, 1000) for i in range(50)}


def test_the_rest_works_without_these_folders(tmp_path):
    import os
    import shutil

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'top3_reasons' in q and not [k for k in q if k.startswith('op') or k == 'pipeline']"
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, check=True, timeout=120)


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if re.match(r"op\d", n)} >= {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, key):
    sf = "/root/testdata/sf0.001"
    ok, message = compare(queries.QUERIES[key](spark, sf), duck(sf), queries.ORACLE[key])
    assert ok, message


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_stages_on_odd_rows(docs, empty, items, spark, tmp_path, rows):
    """Every stage keeps rows whole, whatever other columns are called, and an empty table passes through."""
    import corpus_pipeline

    from tierstat.llm.common import written

    (docs if rows == "odd" else empty).write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    marks = [(i, int(i % 4 > 0), 0) for i in range(60)] + [(None, 1, None), (3, None, 0), (5, 1, 0)]
    spark.createDataFrame(marks if rows == "odd" else [], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = common.read(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {tuple(r) for r in at.collect()}
        at = written(stage(spark, at, str(tmp_path)), name)
        assert at.columns == docs.columns and {tuple(r) for r in at.collect()} <= before
    last = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path))
    assert last.count() == at.count() and (last.count() > 0) == (rows == "odd")


def test_pipeline_against_plain_python(spark):
    import corpus_pipeline

    from tierstat.llm import quality
    from tierstat.llm.common import read

    docs, labels = read(spark, SF001, "documents"), read(spark, SF001, "labels")
    scores = {r.doc_id: r.score for r in quality.scored_documents(docs, labels).collect()}
    left = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id] >= 0.5}
    grouped = groups([(i, fingerprint(t)) for i, t in left.items()])
    left = {i: t for i, t in left.items() if i in {c for _, _, c in grouped}}
    items = [s for r in read(spark, SF001, "benchmark").collect() if (s := shingles(r.text))]
    left = {i: t for i, t in left.items() if not any(len(shingles(t) & s) >= math.ceil(round(len(s) * 0.8, 6)) for s in items)}
    rows = corpus_pipeline.run(spark, SF001).collect()
    narrow = docs.where(F.col("doc_id").isin(list(left)))
    copies = {r.doc_id: r.copies for r in mix.with_copies(narrow).collect()}
    assert Counter(r.doc_id for r in rows) == Counter({i: n for i, n in copies.items() if n})
    placed = {r.doc_id: r.shard for r in shard.with_shard(narrow, F.col("doc_id"), shard.shard_tree(16)).collect()}
    assert all(r.shard == placed[r.doc_id] and r.text == left[r.doc_id] for r in rows)
    for s in set(placed.values()):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_copies_of_large_cells_are_whole(spark):
    """A cell of several buckets, repeated rows in it, gives the very number of copies that its plan says."""
    rows = [(i % 700, "one two three", "a") for i in range(900)] + [(2000 + i, "w " * (i % 9), "a") for i in range(90)] + [(3000 + i, "x y", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for bucket in (7, 100, 10_000):
        got = mix.with_copies(df, bucket=bucket).collect()
        assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
        taken = Counter()
        for r in got:
            taken[r.source] += r.size * r.copies
        for r in got:
            assert abs(taken[r.source] - r.target) <= 3


def test_rows_of_the_mix_move_once(spark):
    """Rows are numbered and meet their cell's plan under one exchange, and no table of cells is broadcast."""
    df = spark.range(300).selectExpr("id AS doc_id", "repeat('w ', int(id % 7)) AS text", "string(id % 3) AS source")
    for bucket in (5, 10_000):
        plan = mix.with_copies(df, bucket=bucket)._jdf.queryExecution().executedPlan().toString()
        top = plan[plan.index("SortMergeJoin"):]
        rows = top[: top.index("Range")]  # the branch of the documents
        assert rows.count("Exchange hashpartitioning") == 1 and "Window" in rows


def test_unsettled_multipliers_stop(spark, monkeypatch):
    df = spark.createDataFrame([(i, "w " * (1 + i % 13), f"s{i % 3}") for i in range(200)], "doc_id long, text string, source string")
    monkeypatch.setattr(mix, "STEPS", 1)
    with pytest.raises(RuntimeError, match="did not settle"):
        mix.with_copies(df)
