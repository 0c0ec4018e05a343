"""Vector codes, hard negatives and page templates against plain versions, and their edges."""

import html
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmgrid.llm import code_trees, hard_negatives, templates
from filmgrid.llm import queries as registered

VECTORS = "vec_id long, embedding array<double>, label int, code string, key long, label_error string, slice int"


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def plain_codes(rows, entries=256, rounds=4, parts=4):
    """(vec_id, label) with code and error, and the codebooks, over Python integers."""
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows if usable(v)]
    width = parts * -(-max((len(v) for *_, v in kept), default=1) // parts)
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    n = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * n : p * n + n] for r in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book))

    for _ in range(rounds if kept else 0):
        for p, book in enumerate(books):
            owned = {}
            for *_, v in kept:
                owned.setdefault(nearest(v[p * n : p * n + n], book)[1], []).append(v[p * n : p * n + n])
            for e, points in owned.items():
                book[e] = [sum(c) // len(points) for c in zip(*points)]
    coded = []
    for i, label, v in kept:
        found = [nearest(v[p * n : p * n + n], book) for p, book in enumerate(books)]
        coded.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return coded, books


def same_codes(spark, rows, entries=256, block=2048, partitions=3):
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], VECTORS).repartition(partitions)
    coded, books = code_trees.compress(frame, entries=entries, block=block)
    expected, expected_books = plain_codes(rows, entries)
    order = lambda found: sorted(found, key=repr)
    label = lambda x: None if x is None else str(x)
    assert [b.tolist() for b in books] == expected_books
    assert order((r.vec_id, r.label, r.code, r.error) for r in coded.collect()) == order((i, label(y), c, e) for i, y, c, e in expected)


def drawn(n, width, seed, spread=1.0):
    random = np.random.default_rng(seed)
    centers = random.normal(size=(6, width))
    vectors = centers[random.integers(0, 6, n)] + random.normal(size=(n, width)) * spread
    return [(int(i), [float(x) for x in v], int(i) % 5 if i % 11 else None) for i, v in enumerate(vectors)]


def test_codes_of_clustered_vectors(spark):
    same_codes(spark, drawn(400, 8, 1, 0.05), entries=16, block=150)


def test_codes_with_edges(spark):
    rows = drawn(60, 6, 2) + [(None, [0.1] * 6, 1), (7, None, 1), (8, [None] + [0.0] * 5, 1), (9, [math.nan] * 6, 1), (10, [math.inf] + [0.0] * 5, 2)]
    rows += [(1, [0.5] * 6, 1)] * 3 + [(2000, [], None), (2001, [0.25, -0.25], None)]
    same_codes(spark, rows, entries=256)
    same_codes(spark, rows, entries=5, block=7)


def test_codes_of_equal_vectors(spark):
    same_codes(spark, [(i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(100)], entries=4, block=64)


def test_codes_of_nothing(spark):
    coded, books = code_trees.compress(spark.createDataFrame([], VECTORS))
    assert coded.collect() == [] and sum(len(b) for b in books) == 0
    coded, _ = code_trees.compress(spark.createDataFrame([(1, None, 1, "x", 1, "y", 2)], VECTORS))
    assert code_trees.with_label_errors(coded).collect() == []


def test_huge_components_are_cut_off(spark):
    coded, books = code_trees.compress(spark.createDataFrame([(1, [1e300, -1e300, 0.0, 1.0], 1, "x", 1, "y", 2)], VECTORS))
    assert coded.first()["error"] == 0 and [b.tolist() for b in books] == [[[code_trees.LARGEST]], [[-code_trees.LARGEST]], [[0]], [[1024]]]


def test_label_errors_put_missing_labels_together(spark):
    coded = spark.createDataFrame([(1, "a", "0", 5), (2, None, "0", 7), (3, None, "0", 1), (4, "a", "0", 2)], "vec_id long, label string, code string, error long")
    found = {r.vec_id: r.label_error for r in code_trees.with_label_errors(coded).collect()}
    assert found == {1: 7, 2: 8, 3: 8, 4: 7}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(*[st.integers(-3, 3)] * 2), min_size=1, max_size=150), st.lists(st.tuples(*[st.integers(-3, 3)] * 2), min_size=1, max_size=9))
def test_trees_give_the_first_nearest_entry(points, entries):
    """Few different values, so that ties and equal points abound."""
    points, entries = np.array(points), np.array(entries)
    tree, book = code_trees.plant(points), code_trees.Codebook(entries)
    squares = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    codes, found = code_trees._codes_of(tree, book)
    assert codes.tolist() == squares.argmin(axis=1).tolist() and found.tolist() == squares.min(axis=1).tolist()
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), dtype=np.int64)
    code_trees._sums_of(tree, book, sums, counts)
    for e in range(len(entries)):
        assert counts[e] == (codes == e).sum() and sums[e].tolist() == points[codes == e].sum(axis=0).tolist()


def test_owned_balls_are_not_looked_into():
    """On clustered points most of them are counted through the sums that balls cache."""
    points = np.array([r[1] for r in drawn(4000, 4, 5, 0.01)])
    points = np.floor(points * 1024).astype(np.int64)
    book = code_trees.Codebook(np.floor(np.random.default_rng(5).normal(size=(6, 4)) * 1024).astype(np.int64))
    owned = sum(n for _, _, n, left in code_trees.owners(code_trees.plant(points), book) if left is None)
    assert owned > 0.9 * len(points)


def test_blocks_hold_a_bounded_number_of_rows(spark):
    rows = spark.range(1000).select(F.col("id"), F.lit("x").alias("label"), F.array_repeat(F.col("id").cast("int"), 4).alias("v")).coalesce(1)
    made = rows.mapInArrow(code_trees._blocks(4, 4, 128), "ids array<long>, labels array<string>, trees array<binary>")
    assert [r[0] for r in made.select(F.size("ids")).collect()] == [128] * 7 + [104]


# hard negatives


def plain_negatives(rows, is_anchor, positives=5, negatives=3):
    kept = [(i, label, [math.floor(256 * x) for x in v], k) for k, (i, v, label) in enumerate(rows) if label is not None and usable(v)]
    width = max((len(v) for *_, v, _ in kept), default=0)
    kept = [(i, label, v + [0] * (width - len(v)), k) for i, label, v, k in kept]
    found = []
    for i, label, v, k in kept:
        if not is_anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, j, other) for j, other, w, m in kept if m != k), key=lambda s: s[:4])
        for positive in [s for s in scored if s[5] == label][:positives]:
            p = -positive[0]
            window = [s for s in scored if s[5] != label and 50 * p <= -100 * s[0] <= 95 * p][:negatives]
            found += [(i, positive[4], rank + 1, s[4], p, -s[0]) for rank, s in enumerate(window)]
    return sorted(found, key=repr)


def same_negatives(spark, rows, condition, is_anchor, **sizes):
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], VECTORS).repartition(3)
    found = hard_negatives.mine(frame, condition, **sizes).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_negatives(rows, is_anchor)


SMALL = {"tree_rows": 64, "slice_rows": 128, "chunk": 8}


def test_negatives(spark):
    rows = [(i, v, label) for i, v, label in drawn(500, 8, 3, 0.4)]
    same_negatives(spark, rows, "vec_id % 10 = 0", lambda i: i % 10 == 0, **SMALL)


def test_negatives_with_a_hot_label_and_ties(spark):
    random = np.random.default_rng(4)
    rows = [(i, [float(x) for x in random.integers(-1, 3, 3)], 0 if i % 3 else i % 4) for i in range(300)]
    same_negatives(spark, rows, "vec_id % 25 = 0", lambda i: i % 25 == 0, **SMALL)


def test_negatives_with_edges(spark):
    rows = drawn(80, 4, 6) + [(100, None, 1), (150, [1.0, None, 0.0, 0.0], 1), (200, [math.inf, 0.0, 0.0, 0.0], 1), (250, [1.0, 1.0, 1.0, 1.0], None)]
    rows += [(300, [1.0, 1.0], 1), (350, [], 2), (400, [0.0] * 4, 77), (None, [0.9, 0.9, 0.9, 0.9], 3), (-50, [0.7] * 4, 3)]
    same_negatives(spark, rows, "vec_id % 50 = 0", lambda i: i is not None and i % 50 == 0)


def test_negatives_of_repeated_rows(spark):
    """A copy of the anchor is another row, and an anchor of its own."""
    rows = [(50, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (3, [0.8, 0.0], 2), (4, [0.8, 0.0], 2), (5, [0.1, 0.0], 2)]
    same_negatives(spark, rows, "vec_id % 50 = 0", lambda i: i % 50 == 0)


def test_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(empty, "vec_id % 50 = 0").collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1, "x", 1, "y", 2)], VECTORS), "vec_id % 50 = 0").collect() == []


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 300), st.integers(1, 40), st.integers(0, 99))
def test_packing_makes_small_full_leaves(n, leaf, seed):
    vectors = np.random.default_rng(seed).integers(-9, 9, (n, 3))
    order, ends = hard_negatives.pack(vectors, [0, 1], leaf)
    assert sorted(order.tolist()) == list(range(n)) and ends[-1] == n
    sizes = np.diff([0, *ends])
    assert sizes.max() <= leaf and sizes.min() >= 1


def test_boxes_are_passed_over():
    """Far boxes are never scored: they lie below the k-th score or outside the window."""
    random = np.random.default_rng(8)
    vectors = np.concatenate([random.normal(c, 1, (200, 4)) for c in (-300, 0, 300)]).astype(np.int32)
    order, ends = hard_negatives.pack(vectors, [0, 1], 50)
    vectors = vectors[order]
    edges = list(zip([0, *ends[:-1]], ends))
    packed = [np.arange(600), np.arange(600), vectors, np.array(ends), np.array([vectors[s:e].min(axis=0) for s, e in edges]), np.array([vectors[s:e].max(axis=0) for s, e in edges])]
    names = ["keys", "ids", "vectors", "ends", "low", "high"]
    forest = hard_negatives._Forest(pa.table({"label": [1], **{n: [a.tobytes()] for n, a in zip(names, packed)}}), 4)
    anchor = np.full((1, 4), 300)
    allowed = np.ones((1, len(ends)), dtype=bool)
    bounds = lambda x: np.array([[x]], dtype=np.int64)
    _, scored = hard_negatives.search(forest, np.array([-1]), anchor, allowed, bounds(-(1 << 62)), bounds(1 << 62), 3)
    assert scored <= 200
    best, scored = hard_negatives.search(forest, np.array([-1]), anchor, allowed, bounds(-10_000), bounds(10_000), 3)
    assert scored <= 200 and best.n[0, 0] == 3


# templates


def plain_article(page):
    inside = page[page.find("<article>") + 9 : page.find("</article>")]
    pieces = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inside)]
    return "\n".join(p for p in pieces if p)


def test_pages(spark, folder):
    found = {r.page_id: r for r in registered.op13_html_text(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        assert found[page.page_id].text == plain_article(page.html) and found[page.page_id].url == page.url
        assert found[page.page_id].n_chars == len(found[page.page_id].text)


def texts(spark, pages, schema="page_id long, url string, html string, text int, host string, template string"):
    frame = spark.createDataFrame([(*p, 1, "x", "y")[: schema.count(",") + 1] for p in pages], schema).repartition(3)
    return {r.page_id: r.text for r in templates.extract(frame).collect()}


def opaque(i):
    """A site whose names say nothing: only the other pages tell what belongs to the template."""
    words = " ".join(f"w{i}x{j}" for j in range(30 + i))
    return (
        f"<html><body><div class=q1><b>The Daily Site</b><i>All the news</i></div><div class=q2><ul><li><a href=/1>m{i}</a></li><li><a href=/2>n</a></li></ul></div>"
        f"<div class=q3><h2>Title {i}</h2><p>{words}</p><p>second &amp; <a href=x>linked {i}</a> text\n\n {i}</p><span>Read more of the site</span></div>"
        f"<div class=q4>short {i}</div></body></html>"
    )


def test_a_template_without_telling_names(spark):
    found = texts(spark, [(i, f"http://opaque.org/{i}", opaque(i)) for i in range(20)])
    for i, text in found.items():
        words = " ".join(f"w{i}x{j}" for j in range(30 + i))
        assert text == f"Title {i}\n{words}\nsecond & linked {i} text {i}"


def test_parts_beside_the_article_go(spark):
    page = (
        "<body><header><h1>Site</h1></header><aside>side</aside><main><div class='cookie-notice'>we use cookies</div><article><header><h1>Title &lt;1&gt;</h1></header>"
        "<p>One <em>two</em> three<br>four</p><div class=advertisement><p>buy</p></div><form><label>name</label><input></form><noscript>turn on</noscript>"
        "<table><tr><td>a</td><td>b</td></tr></table><section id=comments><p>first!</p></section></article></main><footer>foot</footer>"
        "<script>if (a < b) document.write('<p>no</p>')</script><!-- <p>nor this --></body>"
    )
    assert texts(spark, [(1, "http://a.org/1", page)]) == {1: "Title <1>\nOne two three four\na\nb"}


def test_pages_with_edges(spark):
    long = "<article><p>" + "word " * 200_000 + "</p></article>"
    pages = [(1, "http://a.org/1", None), (2, None, ""), (3, "no host", "plain &am text &amp more"), (4, "http://a.org/2", "<article><p>cut off"), (5, "http://a.org/3", long)]
    pages += [(6, "http://a.org/4", "<div " * 20_000), (7, "http://a.org/5", "</div></p>" * 5000 + "<article>x</article>"), (8, "http://a.org/6", "<div>" * 5000 + "deep"), (9, "http://a.org/7", "<!-- <p>x"), (10, "u", "<script>x")]
    found = texts(spark, pages)
    assert found[1] == found[2] == found[9] == found[10] == "" and found[3] == "plain &am text & more" and found[4] == "cut off"
    assert found[5] == " ".join(["word"] * 200_000) and found[7] == "x" and found[8] == "deep"


def test_repeated_pages_and_missing_ids(spark):
    page = "<nav><a>menu</a></nav><article><h1>T</h1><p>same text</p></article>"
    frame = spark.createDataFrame([(None, "http://a.org/1", page)] * 6 + [(5, "http://a.org/1", page)] * 2, "page_id long, url string, html string")
    assert [(r.page_id, r.text) for r in templates.extract(frame).orderBy("page_id").collect()] == [(None, "T\nsame text")] * 6 + [(5, "T\nsame text")] * 2


def test_no_pages(spark):
    assert texts(spark, []) == {}


def test_equal_vectors_make_a_class(spark):
    """The menu's four tags repeat a different number of times on each page, and together."""
    menu = lambda n: "<nav><ul>" + "<li><a href=x>y</a></li>" * n + "</ul></nav>"
    pages = [(f"<body>{menu(2 + i % 4)}<article><h1>t{i}</h1>{'<p>q</p>' * (1 + i % 3)}</article></body>",) for i in range(12)]
    known = templates.templates(spark.createDataFrame(pages, "html string").withColumn("host", F.lit("h")))
    template = templates.Template(known.where("host = 'hh'").first()["template"])
    # page (body, nav, ul, article, h1 with their ends); items of the menu; paragraphs
    assert sorted(template.size.values()) == [2, 4, 10]


def test_classes_out_of_order_are_not_valid(spark):
    pages = [("<body><div id=a></div><div id=b></div><p>x</p></body>" if i % 2 else "<body><div id=b></div><div id=a></div><p>x</p></body>",) for i in range(12)]
    known = templates.templates(spark.createDataFrame(pages, "html string").withColumn("host", F.lit("h")))
    assert known.where("host = 'hh'").select("template").first() is None or not templates.Template(known.where("host = 'hh'").first()["template"]).place


def test_pieces_named_by_tasks_are_counted_over_all_pages(spark):
    """A notice on every page is found, though tasks hold pages of many hosts; one on a tenth of the pages is not."""
    pages = []
    for i in range(200):
        rare = "<p>rare words here</p>" if i % 40 < 4 else "<p>own words</p>"
        pages.append((f"h{i % 4}", f"<body><div class=z>always the same</div><div class=y><h2>t{i}</h2>{rare}</div></body>"))
    known = templates.templates(spark.createDataFrame(pages, "host string, html string").repartition(16))
    found = {r.host: templates.Template(r.template) for r in known.collect()}
    assert set(found) == {"hh0", "hh1", "hh2", "hh3", "a"}
    assert all(len(t.texts) == 1 for t in found.values())


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_hard_negatives", "op13_html_text"])
def test_plans_have_no_cross_join(spark, folder, name):
    plan = registered.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
