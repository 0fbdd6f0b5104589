"""Operators on pages, vectors and labels, with nulls, empty values, ties, repeats and clashing columns."""

import hashlib
import html
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from tierstat.llm import html_text, neighbours, quality, urls, warc
from tierstat.llm.common import read

PAGES = "page_id long, url string, html string, host string, address string, payload string, text string, rule string"


def _page(i, url, source):
    return (i, url, source, "x", "y", "z", "t", "r")


@pytest.fixture(scope="module")
def pages(spark):
    big = "<html><body><article><p>" + "many words here and there " * 80 + "</p></article></body></html>"
    long = "<html><body><article>" + "".join(f"<p>line {i} of a long article &amp; more words to read</p>" for i in range(20000)) + "</article></body></html>"
    link = '<p>a <a href="{}">b</a></p>'.format
    rows = [
        _page(1, "http://good.org/x", link("https://Friend.net/a?b#c")), _page(2, "http://friend.net/y", link("//next.net") + link("/own")),
        _page(3, "HTTP://next.net", "no links"), _page(4, "http://bad.com/de/1", "x"), _page(5, "http://spam.net/?q", link("http://bad.com/")),
        _page(6, "http://farm.net#t", link("http://SPAM.net") + link("http://friend.net")), _page(7, "http://alone.net/a/b", None),
        _page(8, None, big), _page(9, "no scheme", ""), _page(10, "http://Sub.Example.ORG/es/2", big), _page(11, "http://example.org/es", big),
        _page(12, "http://example.org/en/12", "é" * 500), _page(13, "http://x.example.org/en/1", "é" * 500), _page(14, "a\r\nb://h.com/fr/", "é" * 499),
        _page(15, "http://notorg/", long), _page(16, "http://a.org", big + "."), _page(16, "http://a.org", big + "."), _page(None, "http://q.com/fr/z", big + "."),
        _page(None, None, None),
    ]
    return spark.createDataFrame(rows, PAGES).repartition(4).cache()


def test_rules_and_parts(pages):
    got = {(r.page_id, r.host, r.path, r.rule) for r in urls.judged_pages(pages).collect()}
    want = set()
    for p in pages.collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", p.url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        want.add((p.page_id, host, path, max(fits, key=lambda r: len(r.name)).name if fits else None))
    assert got == want
    assert {(10, "example.org/es/"), (11, "org/"), (13, "example.org/en/1"), (14, "com/fr/"), (15, None), (16, None)} <= {(a, d) for a, _, _, d in got}


def test_verdicts_of_the_rules(spark):
    want = {  # url: (rule, verdict) as the contract lists them; the longest rule that fits decides
        "http://example.org/en/1": ("example.org/en/1", "block"), "https://Sub.Example.ORG/en/12?q#t": ("example.org/en/1", "block"),
        "http://example.org/en/2": ("org/", "allow"), "http://example.org/es/1": ("example.org/es/", "block"), "http://x.example.org/es": ("org/", "allow"),
        "http://other.org/es/1": ("org/", "allow"), "http://a.com/fr/1": ("com/fr/", "allow"), "http://b.com/de/1": ("com/de/", "block"),
    }
    rows = [_page(i, url, "") for i, url in enumerate(want)]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judged_pages(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == dict(enumerate(want.values()))


def test_propagation_against_plain_loops(pages, spark):
    got = {r.page_id: r for r in urls.judged_pages(pages).collect() if r.page_id}
    verdicts = {i: r.verdict for i, r in got.items()}
    assert [verdicts[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == ["allow"] * 3 + ["block"] * 3 + ["allow"] * 3
    edges = [("a", "b", 3), ("a", "c", 1), ("b", "c", 1), ("c", "a", 2)]
    seeds = [("trust", "a", 2), ("trust", "b", 1), ("distrust", "c", 5)]
    frame = urls.propagate(
        spark.createDataFrame(edges, "src string, dst string, n long"), spark.createDataFrame(seeds, "kind string, host string, mass long"), steps=6
    )
    for kind in ("trust", "distrust"):
        walk = [(s, d, n) if kind == "trust" else (d, s, n) for s, d, n in edges]
        out = Counter()
        for s, _, n in walk:
            out[s] += n
        start = {h: m for k, h, m in seeds if k == kind}
        start = {h: m / sum(start.values()) for h, m in start.items()}
        score = dict(start)
        for _ in range(6):
            new = defaultdict(float, {h: 0.15 * m for h, m in start.items()})
            for s, d, n in walk:
                new[d] += 0.85 * score.get(s, 0) * n / out[s]
            score = new
        rows = {r.host: r.score for r in frame.where(F.col("kind") == kind).collect()}
        assert rows.keys() == score.keys() and all(abs(rows[h] - score[h]) < 1e-12 for h in rows)


def test_propagation_goes_on_until_settled(spark):
    chain = [(f"h{i}", f"h{i + 1}", 1) for i in range(20)]
    frame = urls.propagate(
        spark.createDataFrame(chain, "src string, dst string, n long"), spark.createDataFrame([("distrust", "h20", 1)], "kind string, host string, mass long")
    )
    rows = {r.host: r.score for r in frame.collect()}
    assert rows.keys() == {f"h{i}" for i in range(21)}
    assert all(abs(rows[f"h{i}"] - 0.15 * 0.85 ** (20 - i)) < 1e-9 for i in range(21))


def test_archive_round_trip(pages, spark):
    back = warc.archived_pages(pages).collect()
    want, groups = [], defaultdict(list)
    for p in pages.collect():
        groups[p.html or ""].append(p.page_id)
    for p in pages.collect():
        data = (p.html or "").encode()
        ids = [i for i in groups[p.html or ""] if i is not None]
        original = max(ids) if ids and len(data) >= 1000 else None
        revisit = original is not None and p.page_id != original
        want.append((p.page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    assert Counter(map(tuple, back)) == Counter(want)
    archive = warc.write_archive(pages)
    assert spark.read.parquet(archive.payloads).count() == len(groups)
    for r in warc.read_archive(spark, archive).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and block[int(fields["Content-Length"]) :] == b"\r\n\r\n"
        http, _, body = block[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK")
        digest = fields["WARC-Payload-Digest"]
        assert digest == "sha1:" + hashlib.sha1(bytes(r.payload)).hexdigest()
        assert body == (b"" if fields["WARC-Type"] == "revisit" else bytes(r.payload))


def test_damaged_payload_is_noticed(pages, spark):
    archive = warc.write_archive(pages)
    damaged = spark.read.parquet(archive.payloads).withColumn("payload", F.concat("payload", F.lit(b"!")))
    path = archive.payloads + "-damaged"
    damaged.write.parquet(path)
    with pytest.raises(Exception, match="damaged or missing payload"):
        warc.read_archive(spark, warc.Archive(archive.headers, path)).collect()
    fewer = archive.payloads + "-fewer"
    spark.read.parquet(archive.payloads).where(F.length("payload") == 0).write.parquet(fewer)
    with pytest.raises(Exception, match="damaged or missing payload"):
        warc.read_archive(spark, warc.Archive(archive.headers, fewer)).collect()


@pytest.mark.parametrize("change", [("(?s)(\r\nContent-Length: )", "$11"), ("(WARC-Refers-To: <urn:uuid:)", "$1x")])
def test_records_are_rebuilt_and_read(pages, monkeypatch, change):
    write = warc.write_archive

    def damaged(*args):
        archive = write(*args)
        headers = pages.sparkSession.read.parquet(archive.headers)
        headers.withColumn("header", F.regexp_replace("header", *change)).write.parquet(archive.headers + "_damaged")
        return warc.Archive(archive.headers + "_damaged", archive.payloads)

    monkeypatch.setattr(warc, "write_archive", damaged)
    with pytest.raises(Exception, match="damaged record|no response for the revisit"):
        warc.archived_pages(pages).collect()


def test_main_text_of_the_table(spark):
    table = read(spark, SF001, "pages")
    got = {r.page_id: r for r in html_text.main_texts(table).collect()}
    for p in table.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert got[p.page_id].text == "\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_main_text_of_other_makes(spark):
    sources = [r.html for r in read(spark, SF01, "pages").orderBy("page_id").collect()]
    weights = html_text.train(sources[:150])
    rest = sources[150:]
    plain = html_text.extract(rest, weights)

    def same(change):
        return np.mean([a == b for a, b in zip(html_text.extract([change(s) for s in rest], weights), plain, strict=True)])

    div = lambda s: s.replace("<article>", "<div id=main>").replace("</article>", "</div>")
    comments = '<section class="comments"><h3>Comments</h3><p>I think that this is a very fine text indeed.</p></section>'
    assert same(div) > 0.95
    assert same(lambda s: s.replace("</article>", comments + "</article>")) > 0.95
    assert same(lambda s: s.replace("</article>", "</article>" + comments + "<aside><p>See also</p></aside><form>Name <input></form>")) > 0.95


def test_main_text_edges(pages):
    got = {(r.page_id, r.url): r.text for r in html_text.main_texts(pages).collect()}
    assert got[None, None] == "" and got[9, "no scheme"] == "" and len(got) == 18
    assert got[15, "http://notorg/"].split("\n")[-1] == "line 19999 of a long article & more words to read"
    assert html_text.extract([], html_text.train([])) == []
    assert html_text.extract(["<a<b", "a < b", "<script>x", "<!-- c"], html_text.train([])) is not None
    assert html_text.main_texts(pages.limit(0)).count() == 0


def test_sum_product_against_enumeration():
    rng = np.random.default_rng(1)
    parents, depths = np.array([0, 0, 1, 1, 0, 4]), np.array([0, 1, 2, 2, 1, 2])
    features = np.stack([rng.integers(a, b, 6) for a, b in zip(html_text.OFFSETS[:-1], html_text.OFFSETS[1:], strict=True)], axis=1)
    weights = html_text.Weights(rng.normal(size=(html_text.OFFSETS[-1], 2)), rng.normal(size=(html_text.EDGE_KINDS, 2, 2)))
    kinds, total, mass = html_text.edge_kinds(features, parents, depths), np.zeros((6, 2)), 0.0
    for state in np.ndindex(*[2] * 6):
        score = sum(weights.own[features[i], state[i]].sum() for i in range(6))
        score += sum(weights.edge[kinds[i], state[parents[i]], state[i]] for i in range(1, 6))
        mass += np.exp(score)
        for i in range(6):
            total[i, state[i]] += np.exp(score)
    marginal, edges = html_text.infer(features, parents, depths, weights)
    assert np.allclose(marginal, total / mass) and np.allclose(edges[1:].sum(axis=1), marginal[1:])


def _exact(rows, k, every):
    found = {}
    for q, x in rows.items():
        if q % every == 0:
            scored = sorted((-float((np.float64(x) * np.float64(v)).sum()), i) for i, v in rows.items() if i != q)
            found[q] = [(i, -s) for s, i in scored[:k]]
    return found


def test_neighbours_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)], 1) for i in range(70)]
    same = [float(np.float32(x)) for x in rng.normal(size=8)]
    rows += [(100 + i, same, 2) for i in range(60)]  # many equal vectors
    odd = [(200, None, 1), (220, [0.0] * 8, 1), (240, [float("nan")] * 8, 1), (260, [None] * 8, 1), (280, [1.0] * 3, 1), (None, same, 1), (300, [], 1)]
    table = spark.createDataFrame([*rows, *odd, rows[0], rows[3]], "vec_id long, embedding array<float>, id int").withColumn("part", F.lit("p"))
    got = defaultdict(list)
    for r in neighbours.nearest(table).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = _exact({i: v for i, v, _ in rows}, 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)
    assert neighbours.nearest(table.limit(0)).count() == 0
    few = neighbours.nearest(table.where("vec_id in (0, 1, 2)")).collect()
    assert [(r.query_id, r["rank"]) for r in few] == [(0, 1), (0, 2)]


def test_neighbours_recall_with_parts(spark):
    table = read(spark, SF01, "embeddings")
    rows = {r.vec_id: r.embedding for r in table.collect()}
    want = _exact(rows, 20, 20)
    got = defaultdict(set)
    for r in neighbours.nearest(table, rows_per_part=64).collect():
        got[r.query_id].add(r.vec_id)
    assert all(len(got[q]) == 20 for q in want)
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("n", [1, 20, 41, 42, 130, 500])
def test_small_tables_are_searched_by_parts(spark, monkeypatch, n):
    """From twice k + 1 vectors on there is a learned partition; recall holds at every size."""
    learned = []
    monkeypatch.setattr(neighbours, "learn", lambda x, parts, learn=neighbours.learn: learned.append(parts) or learn(x, parts))
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(5, 12))
    rows = [(i, (centres[i % 5] + 0.1 * rng.normal(size=12)).tolist()) for i in range(n)]
    got = defaultdict(set)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=5).collect():
        got[r.query_id].add(r.vec_id)
    want = _exact(dict(rows), 20, 5)
    assert all(len(got[q]) == min(20, n - 1) for q in want)
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * sum(len(x) for x in want.values())
    assert learned == ([1] if n < 42 else [min(8, n // 21)])


def test_parts_are_balanced():
    x = np.random.default_rng(3).normal(size=(1000, 16))
    sizes = np.bincount(neighbours.balanced_parts(x, neighbours.neighbour_graph(x), 7), minlength=7)
    assert sizes.min() >= 0.9 * 1000 / 7 and sizes.max() <= 1.1 * 1000 / 7


def test_quality_on_held_out_rows(spark):
    docs, labels = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    scored = quality.scored_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert len(good) > 50 and np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.9
    # Labels of held-out rows, and zeros, change nothing.
    other = labels.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1) & (F.col("quality") == 1))
    again = {r.doc_id: r.score for r in quality.scored_documents(docs.drop("lang", "source"), other).collect()}
    first = {r.doc_id: r.score for r in quality.scored_documents(docs, labels).collect()}
    assert all(abs(again[i] - first[i]) < 1e-9 for i in first)


def test_prior_from_mixtures():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.8):
        unlabelled = np.concatenate([rng.normal(2, 1, int(4000 * share)), rng.normal(-2, 1, 4000 - int(4000 * share))])
        assert abs(quality.estimate_prior(rng.normal(2, 1, 2000), unlabelled) - share) < 0.08


def test_slopes_are_those_of_the_risk():
    """Against differences of the risk written out as the method states it."""
    rng = np.random.default_rng(6)
    for prior, shift in ((0.4, 0.0), (0.9, 3.0), (0.9, -6.0), (None, 1.0)):
        gp, gu = rng.normal(1, 1, 7), rng.normal(0, 1, 11) + shift

        def loss(z):
            return np.mean(np.log1p(np.exp(-z)))

        def risk(g):
            p, u = g[:7], g[7:]
            if prior is None:
                return loss(p) + loss(-u)
            negative = loss(-u) - prior * loss(-p)
            return prior * loss(p) + negative if part else -negative

        part = prior is None or loss(-gu) - prior * loss(-gp) >= 0
        assert part == (shift != -6.0)
        g = np.concatenate([gp, gu])
        for i, slope in enumerate(quality.slopes(gp, gu, prior)):
            step = np.eye(len(g))[i] * 1e-5
            assert abs((risk(g + step) - risk(g - step)) / 2e-5 - slope) < 1e-7


def test_grams_are_those_of_the_words():
    """Equal sequences, words and pairs, in any place and case, have equal bins; others nearly always differ."""
    text = "The hill, the  mill\nand THE HILL, é " + " ".join(f"w{i} x{i * 7}" for i in range(300)) + " " + "z" * 300 + " " + "z" * 299
    data = text.encode()
    octets = np.frombuffer(data, np.uint8)
    kinds = quality._CLASS[octets]
    low = data.translate(bytes(quality._LOWER))
    words = low.split()
    plain = [[low[i : i + 4] for i in range(len(low) - 3)], words, list(zip(words[:-1], words[1:], strict=True))]
    for want, got in zip(plain, quality.grams(octets, quality._words(kinds)[1], kinds), strict=True):
        assert len(want) == len(got) and got.max() < quality.BINS
        bins = {}
        assert all(bins.setdefault(w, g) == g for w, g in zip(want, got.tolist(), strict=True))
        assert len(set(bins.values())) > 0.97 * len(bins)


def test_familiarity_of_counts():
    known = quality.familiarity(np.array([[0.0, 0, 0, 0], [6, 1, 1, 0]]))
    assert np.allclose(known, np.log([[1, 1, 1, 1], [7 / 3, 2 / 3, 2 / 3, 1 / 3]]), atol=1e-6)


def test_a_script_that_no_positive_has_is_unfamiliar(spark):
    docs, labels = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    known = quality.train(docs, labels).known
    good = docs.join(labels.where("quality = 1"), "doc_id").where(quality.fold("doc_id") == 1).collect()
    sequences = quality.SHAPE  # the first of the familiar kinds: sequences of four bytes
    least = min(quality.describe(r.text, known)[sequences] for r in good if len(r.text) > 200)
    for text in ("这是一个很好的文章。" * 20, "水が夜にまた上がり、町の人々は丘へ荷物を運んだ。 " * 9):
        assert quality.describe(text, known)[sequences] < least - 1


def test_quality_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "x " * 200_000, None), (3, "some plain words.", "c"), (3, "some plain words.", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.scored_documents(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert quality.keep_quality(docs, labels).columns == docs.columns
    assert {r.score for r in quality.scored_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.scored_documents(docs.limit(0), labels).count() == 0


RUN = "The river rose again in the night and the people of the town carried their things up the hill before it was light. "


@pytest.fixture(scope="module")
def learned(spark):
    return html_text.train([r.html for r in read(spark, SF01, "pages").orderBy("page_id").limit(150).collect()])


def _framed(inside, around="{}"):
    body = f"<nav><a href='/'>Home page of the site</a></nav><article><h1>On the river</h1><p>{RUN * 2}</p>{inside}<p>{RUN * 3}</p></article>"
    return "<html><body>" + around.format(body) + "<footer>All rights are with the site</footer></body></html>"


HEAD, ONE, TWO = "On the river", (RUN * 2).strip(), (RUN * 3).strip()


@pytest.mark.parametrize(
    "inside, middle",
    [
        ("<p title=it's>" + RUN + "It's not the end's end.</p>", RUN + "It's not the end's end."),  # a quote inside an unquoted value
        ("<p data-x=a\"b class='x'>" + RUN + "</p>", RUN),
        ("<p>Let <math><mi>x</mi> <mo>=</mo> <mn>5</mn></math> be the height. " + RUN + "</p>", "Let x = 5 be the height. " + RUN),
        ("<p>What <my-term>the town</my-term> calls <x-y>a flood</x-y> is one. " + RUN + "</p>", "What the town calls a flood is one. " + RUN),
        ("<p>Before <script>var a = '<p>';</script>and after. " + RUN + "</p>", "Before and after. " + RUN),
        ('<p class="share">' + RUN + "</p>", RUN),
        ('<div class="header-image-caption meta">' + RUN + "</div>", RUN),
        ("<blockquote><p>" + RUN + "</p><footer>Says the old man of the mill by the river, who saw it all</footer></blockquote>", RUN.strip() + "\nSays the old man of the mill by the river, who saw it all"),
        ('<div class="alert">We use cookies on this site. Accept all cookies or set them.</div>', ""),
        ("<p>1 &lt; 2 </ > and <!-- a > b -->3. " + RUN + "</p>", "1 < 2 and 3. " + RUN),
    ],
)
def test_main_text_of_odd_markup(learned, inside, middle):
    want = "\n".join(x for x in (HEAD, ONE, middle.strip(), TWO) if x)
    assert html_text.extract([_framed(inside)], learned) == [want]


def test_a_form_around_the_framed(learned):
    around = "<form action=/x><label for=q>Search this site for words</label><input id=q><select><option>One</select>{}</form>"
    assert html_text.extract([_framed("", around)], learned) == ["\n".join((HEAD, ONE, TWO))]
    inside = "<form><p>Subscribe to our letter and get the news of the river every week by mail</p></form>"
    assert html_text.extract([_framed(inside)], learned) == ["\n".join((HEAD, ONE, TWO))]


def test_an_unclosed_value_ends_with_the_framed(learned):
    for end in ('<a href="x>', "<a href='x>more", "<p title=", "<div"):
        assert "<" not in html_text.extract([f"<article><h1>A</h1><p>{RUN * 3}</p>{end}"], learned)[0]
    assert html_text.parse("<a href='x>y</a>").tags == ["#root", "a"]


def test_deep_trees_take_time_in_proportion(learned):
    source = "<div>" * 8000 + "</span></li></b>" * 8000 + f"<p>{RUN * 4}</p>" + "<li>" * 50 + "</div>" * 8000
    began = time.monotonic()
    text = html_text.extract([source], learned)[0]
    assert time.monotonic() - began < 1.0 and text == (RUN * 4).strip()


def test_portions_are_bounded_by_characters():
    sources = ["x" * n for n in (10, 700_000, 400_000, 3_000_000, 5)] + ["y"] * 130
    parts = list(html_text._portions(sources))
    assert [s for part in parts for s in part] == sources
    assert [len(part) for part in parts] == [2, 1, 1, 64, 64, 3]


@pytest.mark.parametrize("most", [4096, 3])
def test_revisits_of_one_payload_are_joined_apart(spark, monkeypatch, most):
    """Half of the rows share one payload: by broadcast, and, with a bound that no name passes, by the shuffle."""
    monkeypatch.setattr(warc, "MOST_NAMES", most)
    rows = [(i, "u", "x" * 1200 if i % 2 else f"{i % 40}" * 700) for i in range(400)] + [(None, "u", "x" * 1200), (399, "u", "x" * 1200)]
    got = warc.archived_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    last = {}
    for i, _, h in rows:
        last[h] = max(last.get(h, -1), -1 if i is None else i)
    want = Counter(
        (i, len(h), hashlib.sha1(h.encode()).hexdigest(), *(("revisit", last[h]) if i != last[h] else ("response", None))) for i, _, h in rows if len(h) >= 1000
    ) + Counter((i, len(h), hashlib.sha1(h.encode()).hexdigest(), "response", None) for i, _, h in rows if len(h) < 1000)
    assert Counter(map(tuple, got)) == want
