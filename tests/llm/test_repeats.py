"""Repeated passages against plain Python: whole windows, very long texts, repeats inside one text, groups dealt anew."""

import hashlib
import random
import re

import numpy as np
import pytest

from tierstat.llm import repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, span):
    """(n_words, n_removed, kept) of each (doc_id, text)."""
    first = {}
    texts = [(d, WORDS.findall(t or "")) for d, t in rows]
    for d, words in texts:
        for i in range(len(words) - span + 1):
            if d is not None:
                w = tuple(words[i : i + span])
                first[w] = min(first.get(w, d), d)
    out = []
    for d, words in texts:
        gone = set()
        for i in range(len(words) - span + 1):
            if d is not None and first[tuple(words[i : i + span])] < d:
                gone.update(range(i, i + span))
        out.append((d, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def corpus(span, seed=5):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passages = [" ".join(word() for _ in range(span + k)) for k in (0, 1, 9, 70)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(80))) for _ in range(3)]
        parts.insert(1, passages[i % 4] if i % 3 else "")
        rows.append((i, "  \t".join(parts)))
    rows += [(100 + i, rows[7][1]) for i in range(20)]  # exact copies
    rows += [(130 + i, f"{i} {rows[8][1]} end{i}") for i in range(10)]  # near copies
    rows += [(200, " ".join(["la"] * 3000)), (201, " ".join(["la"] * 2600) + " di"), (202, "la")]  # one word over and over
    rows += [(210, " ".join(f"line {j % 7}" for j in range(900))), (211, " ".join(f"line {j % 7}" for j in range(3, 600)))]
    rows += [(220, "x" * 2_500_000 + " " + passages[3]), (221, " ".join([passages[2]] * 3))]
    rows += [(230, None), (231, ""), (232, " \t\n "), (233, passages[1].replace(" ", " ")), (233, passages[3])]
    rows += [(None, passages[3]), (7, rows[7][1]), (7, rows[9][1]), (-5, passages[2] + " früh \U0001f600")]
    return rows


@pytest.mark.parametrize(("span", "group"), [(50, 1 << 20), (50, 400), (5, 60), (1, 1 << 20)])
def test_against_plain_python(spark, span, group):
    rows = corpus(span)
    df = spark.createDataFrame([(d, t, "mine", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, kept string, _mark int")
    got = repeats.without_repeats(df.repartition(4), span=span, group=group)
    assert got.columns == ["doc_id", "text", "_mark", "n_words", "n_removed", "kept"]
    got = {r["_mark"]: (r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()}
    want = plain(rows, span)
    assert len(got) == len(want)
    for i, w in enumerate(want):
        assert got[i] == w, (i, rows[i][1][:80] if rows[i][1] else None)
    if span == 50:
        assert sum(w[2] for w in want) > 5000


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.without_repeats(df).collect() == []


def test_trees_compare_words_only():
    """Deep nodes alone: suffixes that part before ``span`` words keep their own id, however long the rest."""
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join([f"a{i}" for i in range(49)] + ["x"] + [f"a{i}" for i in range(50, 60)])
    of, low, high, least = repeats.repeated_windows([a, b, a.replace("a0 ", "b ")], np.array([3, 2, 1]), 50)
    assert list(zip(of.tolist(), low.tolist(), high.tolist(), least.tolist(), strict=True)) == [(0, 0, 1, 3), (0, 1, 11, 1), (1, 0, 11, 2), (2, 0, 11, 1)]


def test_word_hashes_across_bounds():
    """Words end at white space and where the next text begins; equal words have equal hashes wherever they stand."""
    raw = np.frombuffer(b"ab cd" + b"ab" + b"" + b"\tcd ", np.uint8)
    starts, hashes = repeats.word_hashes(raw, np.array([0, 5, 7, 7, 11]))
    assert starts.tolist() == [0, 3, 5, 8]
    assert hashes[0] == hashes[2] != hashes[1] == hashes[3]


def test_query_digests(spark):
    from tierstat.llm.queries import op13_repeated_passages

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op13_repeated_passages(spark, sf).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain(rows, 50)}
