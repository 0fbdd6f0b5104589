"""Spelling variants against plain Python: one edit, groups of any size, chains of forms, odd texts."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierstat.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts, times=10):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def vocabulary():
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(7, 11))) for _ in range(250)}
    words |= {"prefixprefix" + "".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(250)}  # one hot chunk
    words |= {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "bbbbbbbb", "x" * 4000, "x" * 3999, "x" * 2000 + "y" + "x" * 1999}
    counts = {w: rng.choice([2, 3, 5, 20, 30, 400]) for w in sorted(words)}
    # A chain: each ten times the one before.
    counts |= {"qwertyui": 2, "qwertyuo": 20, "qwertyoo": 200, "qwertooo": 2000}
    return counts


@pytest.mark.parametrize("group", [2, 16, 64])
def test_forms_against_plain_python(spark, group):
    counts = vocabulary()
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = spelling.spelling_forms(df, group=group).collect()
    assert len(got) == len(counts)
    assert {tuple(r) for r in got} == plain_forms(counts)


def test_pairs_come_once_and_no_chunk_is_compared_whole(spark):
    counts = vocabulary()
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [tuple(sorted((r.a, r.b))) for r in spelling.near_pairs(df, 16).collect()]
    want = {tuple(sorted((a, b))) for a in counts for b in counts if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


TEXTS = [
    "Running RUNNING running runnin RÉSUMÉS résumés rÉsumés", None, "", "12345 !!", "shortly,shortly;Shortly shorty_ shorlty",
    "×÷multiply÷ multiply ÜberŸberall Āanders naïveté naïvetés", "z" * 300_000, "running running",
]


def plain_counts(rows, least=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_words_of_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 40)] + [(None, TEXTS[0]), (3, TEXTS[0]), (3, TEXTS[0])]
    df = spark.createDataFrame([(d, t, "own", 1) for d, t in rows], "doc_id long, text string, word string, run int")
    got = spelling.corpus_words(df.repartition(3), change=queries.slipped)
    assert got.columns == ["word", "n"]
    assert {r.word: r.n for r in got.collect()} == plain_counts(rows)
    slips = {w for w in plain_counts(rows) if w in ("runnig", "unning", "runing", "ésumés", "multipl")}
    assert slips is not None and "running" in plain_counts(rows)


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_spelling_variants(spark, sf)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain_forms(plain_counts(rows))


def test_empty_tables(spark):
    assert spelling.spelling_forms(spelling.corpus_words(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
    alone = spark.createDataFrame([("wordword", 3)], "word string, n long")
    assert [tuple(r) for r in spelling.spelling_forms(alone).collect()] == [("wordword", None, "wordword", 3, 0, None)]


def test_last_forms_of_a_long_chain(spark):
    chain = spark.range(40).select(F.format_string("w%03d", "id").alias("word"), F.format_string("w%03d", F.col("id") + 1).alias("form"))
    assert {r.root for r in spelling.last_forms(chain).collect()} == {"w040"}
