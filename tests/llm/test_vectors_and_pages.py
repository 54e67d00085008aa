"""Searches over embeddings, the page extractor, the registry and the pipeline."""

import re
from html import unescape

import brute
import numpy as np
import pytest
from oracle_check import connect, mismatch
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from repotide.llm import cover_tree, html_blocks, knn_graph, line_dedup, near_dedup
from repotide.llm.common import table
from repotide.llm.oracle import ORACLES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, rank string, score string"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "r", "s") for i, v, label in rows], VECTORS)


def clustered(count=400, seed=0):
    """Tight clusters, copies and single vectors, over two labels."""
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((count // 10, 16))
    rows = []
    for i in range(count):
        center = centers[int(rng.integers(len(centers)))]
        spread = (0, 0.02, 0.12, 1.0)[i % 4]
        v = (center + spread * rng.standard_normal(16)).astype(np.float32).tolist()
        rows.append((i * 3, v, int(i % 3 > 0)))
    return rows


ODD = [
    (5000, None, 1), (5051, [], 1), (5002, [None] * 16, 1), (5053, [NAN] * 16, 1), (5004, [INF] + [1.0] * 15, 1),
    (5055, [0.0] * 16, 1), (5006, [1.0] * 16, None), (5057, [1.0] * 16, None),
]


# --- top k


def expected_top(rows, k=5):
    usable = {
        i: np.floor(256 * np.array(v, float)).astype(np.int64)
        for i, v, _ in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    }
    found = set()
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-int(v @ w), j) for j, w in usable.items() if j != q)[:k]
            found |= {(q, n + 1, j, -s) for n, (s, j) in enumerate(scores)}
    return found


@pytest.mark.parametrize("block_rows", [64, 4096])
def test_top_k_equals_brute_force(spark, block_rows):
    rows = clustered() + ODD + [(2000 + i, [0.5] * 16, 0) for i in range(300)] + [(None, [1.0] * 16, 0)]
    data = cover_tree.whole_numbers(vectors(spark, rows + rows[:5]))
    found = cover_tree.top_k(data.filter("vec_id % 50 = 0"), data, 5, block_rows)
    assert {tuple(r) for r in found.collect()} == expected_top(rows)
    assert found.count() == len(expected_top(rows))


def test_top_k_of_large_components_and_of_other_lengths(spark):
    rng = np.random.default_rng(11)
    rows = [(i, np.floor(4 * rng.standard_normal(6)).tolist(), 0) for i in range(60)]
    rows += [(100, [2.0**41, 1.0, 0, 0, 0, 0], 0), (101, [-(2.0**41)] + [1.0] * 5, 0), (102, [1e30] * 6, 0), (150, [-3e38, 1.0, 2.0, 0, 0, 0], 0)]
    rows += [(200, [1.0, 2.0], 0), (201, [3.0, 4.0], 0), (202, [5.0, 6.0, 7.0], 0), (250, [1.0] * 6, 0)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    data = cover_tree.whole_numbers(vectors(spark, rows))
    exact = {i: [int(256 * x) if abs(x) > 1e6 else int(np.floor(256 * x)) for x in v] for i, v, _ in rows}
    expected = set()
    for q, v in exact.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in exact.items() if j != q and len(w) == len(v))
            expected |= {(q, n + 1, j, -s if abs(s) < 1 << 63 else None) for n, (s, j) in enumerate(scores[:5])}
    assert {tuple(r) for r in cover_tree.top_k(data.filter("vec_id % 50 = 0"), data, 5, 16).collect()} == expected
    assert any(r[3] is None for r in expected)


def test_top_k_of_few_rows(spark):
    data = cover_tree.whole_numbers(vectors(spark, [(0, [1.0, 2.0], 0), (3, [1.0, 0.0], 0), (50, [0.0, -1.0], 0)]))
    found = cover_tree.top_k(data.filter("vec_id % 50 = 0"), data)
    assert {tuple(r)[:3] for r in found.collect()} == {(0, 1, 3), (0, 2, 50), (50, 1, 3), (50, 2, 0)}
    nothing = data.limit(0)
    assert cover_tree.top_k(nothing, nothing).count() == 0


def test_a_tree_covers_its_rows_and_leaves_pairs_out():
    rng = np.random.default_rng(2)
    points = np.concatenate([np.floor(100 * rng.standard_normal(8)) + rng.integers(-3, 4, (300, 8)) for _ in range(12)])
    root = cover_tree.tree(points)
    stack, leaves = [root], []
    while stack:
        node = stack.pop()
        far = np.sqrt(((points[node.rows] - node.center) ** 2).sum(axis=1)).max()
        assert far <= node.radius + 1e-6
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            stack += node.children
        else:
            leaves.append(node)
    assert len(leaves) >= 12
    met = []
    best = cover_tree._Best(4, 5)
    take = best.take
    best.take = lambda rows, scores, ids: (met.append(scores.size), take(rows, scores, ids))
    cover_tree.search(points[:4], np.arange(4), points, np.arange(len(points)), root, best)
    assert sum(met) < 4 * len(points) / 2


# --- near vectors


def test_links_equal_brute_force(spark):
    rows = clustered(seed=5) + ODD
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in knn_graph.near_duplicates(vectors(spark, rows)).collect()}
    assert found == brute.near_vectors(rows)


def test_a_saturated_group_gets_all_its_links(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16)
    rows = [(i, (base + 1e-3 * rng.standard_normal(16)).astype(np.float32).tolist(), 3) for i in range(150)]
    found = knn_graph.near_duplicates(vectors(spark, rows)).collect()
    assert {(r["n_links"], r["component_id"], r["kept"]) for r in found} == {(149, 0, False), (149, 0, True)}


def test_vectors_of_other_lengths_are_not_linked(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0][: 2 + i % 3], 1) for i in range(9)] + [(20, [2.0, 4.0], 1), (21, [1.0, 2.0], 2)]
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in knn_graph.near_duplicates(vectors(spark, rows)).collect()}
    assert found == {**{i: (3 if i % 3 == 0 else 2, i % 3) for i in range(9)}, 20: (3, 0), 21: (0, 21)}


def test_the_last_way_is_exact(spark, monkeypatch):
    rows = clustered(seed=7) + ODD
    monkeypatch.setattr(knn_graph, "RECALL", 2.0)
    monkeypatch.setattr(knn_graph, "PASSES", 1)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in knn_graph.near_duplicates(vectors(spark, rows)).collect()}
    assert found == brute.near_vectors(rows)


def test_the_audit_sees_what_is_missing(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + 1e-3 * rng.standard_normal(16)).tolist(), 1) for i in range(120)]
    rows += [(500 + i, rng.standard_normal(16).tolist(), 1) for i in range(80)]
    _, nodes = knn_graph.node_table(vectors(spark, rows))
    lists = spark.createDataFrame([], "node long, nbr long, sim double")
    none = spark.createDataFrame([], "node long, links long")
    assert knn_graph.audit(nodes, lists, none, 0.98) == 0.0
    first = nodes.filter("first_id < 40").select("node", F.lit(2).cast("long").alias("links"))
    half = knn_graph.audit(nodes, lists, first, 0.98)
    assert 0.0 < half < 1.0
    # Nothing to find says nothing.
    assert knn_graph.audit(nodes.filter("first_id >= 500"), lists, none, 0.98) is None


def test_more_planes_take_more_tables():
    counts = [knn_graph.tables_for(b, 0.98) for b in range(25)]
    assert counts[0] == 1 and counts == sorted(counts) and counts[24] < 40


def exact_vectors(rows, threshold=0.98):
    """``vec_id -> n_links`` and the number of components, of one label without copies."""
    unit = np.array([v for _, v, _ in rows], float)
    unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    links = [(rows[i][0], rows[j][0]) for i, j in np.argwhere(np.triu(linked))]
    roots = brute.components([i for i, _, _ in rows], links)
    return {r[0]: int(n) for r, n in zip(rows, linked.sum(axis=1))}, roots


def test_dense_subgroups_are_linked_to_one_another(spark):
    """Each member has more neighbours in its own subgroup than any bounded list holds."""
    rng = np.random.default_rng(8)
    first, second = np.linalg.qr(rng.standard_normal((16, 2)))[0].T
    angle = np.arccos(0.985)
    centers = first, np.cos(angle) * first + np.sin(angle) * second
    rows = [(i, (centers[i % 2] + 5e-4 * rng.standard_normal(16)).astype(np.float32).tolist(), 3) for i in range(400)]
    links, roots = exact_vectors(rows)
    assert set(links.values()) == {399} and set(roots.values()) == {0}
    found = knn_graph.near_duplicates(vectors(spark, rows)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {i: (links[i], roots[i]) for i in links}


def test_rare_links_among_many_single_vectors(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((6000, 64))
    base /= np.sqrt((base * base).sum(axis=1))[:, None]
    for i in range(0, 600, 2):
        aside = base[i + 1] - (base[i + 1] @ base[i]) * base[i]
        base[i + 1] = 0.981 * base[i] + np.sqrt(1 - 0.981**2) * aside / np.sqrt(aside @ aside)
    rows = [(i, v.astype(np.float32).tolist(), 3) for i, v in enumerate(base)]
    links, roots = exact_vectors(rows)
    assert sum(links.values()) == 600
    found = knn_graph.near_duplicates(vectors(spark, rows)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {i: (links[i], roots[i]) for i in links}


def test_repeated_and_nameless_vectors(spark):
    rows = [(5, [1.0, 1.0], 1), (5, [1.0, 1.0], 1), (None, [2.0, 2.0], 1), (8, [1.0, 1.0], 2)]
    found = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in knn_graph.near_duplicates(vectors(spark, rows)).collect())
    assert found == [(0, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (8, 0, 8, True)]
    assert knn_graph.near_duplicates(vectors(spark, rows).limit(0)).count() == 0


# --- pages


@pytest.fixture(scope="module")
def labeller(spark):
    return html_blocks.fit(table(spark, SF, "pages"))


def by_markup(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S).group(1)
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n\n".join(t for t in (" ".join(unescape(p).split()) for p in parts) if t)


def test_pages_give_their_articles(spark, labeller):
    pages = table(spark, SF, "pages")
    found = html_blocks.extract(pages, labeller)
    assert found.columns == [*pages.columns, "text"]
    for r in found.collect():
        assert r["text"] == by_markup(r["html"])


def test_written_pages_unseen_in_training(labeller):
    pages = html_blocks.written_pages(120, seed=77)
    labels = labeller.predict([html_blocks.vectors(html_blocks.blocks(h)) for h, _ in pages])
    right = np.concatenate([(p >= 0.5) == np.array(own) for p, (_, own) in zip(labels, pages)])
    assert right.mean() > 0.97


def test_odd_pages(spark, labeller):
    long = "<article>" + "<p>word word word.</p>" * 3000 + "</article>"
    rows = [(1, None), (2, ""), (3, "<p"), (4, "plain"), (5, long), (6, "<script>x</script"), (None, "<article><p>A &amp; b<br>c</article>")]
    pages = spark.createDataFrame([(i, h, "u", "old") for i, h in rows], "page_id long, html string, url string, text string")
    found = {r["page_id"]: r["text"] for r in html_blocks.extract(pages, labeller).collect()}
    assert (found[1], found[2], found[6]) == ("", "", "") and found[5].count("word") == 9000
    assert found[None] == "A & b c"
    assert html_blocks.extract(pages.limit(0), labeller).count() == 0


def test_blocks_of_broken_markup():
    html = "<div class='a b'><p>one<p>two <b>bold</div>three<ul><li>x<li>y</ul><!-- no --><style>p{}</style>"
    found = html_blocks.blocks(html)
    assert [b.text for b in found] == ["one", "two bold", "three", "x", "y"]
    assert found[0].path == ("div", ".a", ".b", "p") and found[2].path == ()


@pytest.mark.parametrize(
    ("html", "texts"),
    [
        ("<html><head><title>x</title><body><article><p>Text stays.</p></article></body></html>", ["Text stays."]),
        ("<head><meta charset=utf-8><title>x</title><p>Text stays.", ["Text stays."]),
        ("<head><title>x</title>Text stays.", ["Text stays."]),
        ("<head>dropped<style>p{}</style><noscript>no</noscript></head><p>Text stays.", ["Text stays."]),
        ("<p>one</p><textarea>two<p>three</p>", ["one", "two", "three"]),
        *((f"<p>one</p><{tag} a='b'><p>two</p>", ["one", "two"]) for tag in sorted(html_blocks._SILENT)),
        *((f"<p>one</p><{tag}>no<p>no</{tag}><p>two</p>", ["one", "two"]) for tag in sorted(html_blocks._SILENT)),
        ("<svg><p>one</p><svg>no</svg><p>two</p>", ["one", "two"]),
        ("<svg/><p>one</p><svg><svg>no</svg>no</svg><p>two</p>", ["one", "two"]),
        ("<p>one</p><script>no<p>no", ["one"]),
    ],
)
def test_silent_elements_without_end_tag_leave_the_rest(html, texts):
    assert [b.text for b in html_blocks.blocks(html)] == texts


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((5, 3, html_blocks.WIDTH))
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], float)
    w = rng.normal(0, 0.2, (html_blocks.WIDTH + html_blocks.HIDDEN + 1, 4 * html_blocks.HIDDEN))
    slope = rng.standard_normal((5, 3, html_blocks.HIDDEN)) * mask[:, :, None]
    loss = lambda: (html_blocks._forward(x, w, mask)[0][1:] * slope).sum()
    grad = html_blocks._backward(x, w, mask, *html_blocks._forward(x, w, mask), slope)
    for i, j in [(0, 0), (7, 20), (html_blocks.WIDTH + 3, 40), (-1, 50)]:
        before = w[i, j]
        w[i, j] = before + 1e-5
        high = loss()
        w[i, j] = before - 1e-5
        low = loss()
        w[i, j] = before
        assert abs((high - low) / 2e-5 - grad[i, j]) < 1e-5


# --- registry and pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = connect(SF)
    assert mismatch(entry.queries()[name](spark, SF), connection, ORACLES[name]) is None
    connection.close()


def test_the_parser_is_linear_and_pages_stand_alone(labeller):
    import time

    deep = '<div class="a b">some text here' * 8000
    hostile = [deep, "<a " * 10_000, "<p>word</p>" * 16_000, "<li><ul>" + "<div>" * 8000 + "<li></li>" * 4000, '<a "\'>' * 5000]
    for html in hostile:
        start = time.perf_counter()
        html_blocks.extract_pages([html], labeller)
        assert time.perf_counter() - start < 8
    page = by_rule(labeller)
    alone = html_blocks.extract_pages([page], labeller)[0]
    assert html_blocks.extract_pages([hostile[2], page, "<p>x</p>"], labeller)[1] == alone


def by_rule(labeller):
    return html_blocks.written_pages(3, seed=77)[1][0]


def test_prose_counts_whatever_holds_it(labeller):
    prose = "The council met on Monday. Members agreed to repair the bridge, and a plan was voted on. Work begins in spring. " * 2
    menu = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav>'
    for body in (f"<div>{prose}</div><div>{prose}</div>", f"<table><tr><td>{prose}</td></tr></table>", f"<section>{prose}</section>",
                 f"<dl><dt>One</dt><dd>{prose}</dd></dl>", f"<figure><figcaption>{prose}</figcaption></figure>"):
        text = html_blocks.extract_pages([f"<html><body>{menu}{body}<footer>&copy; Town</footer></body></html>"], labeller)[0]
        assert prose.strip() in text and "Home" not in text and "Town" not in text


def test_references_are_decoded_by_stretch_and_bad_tags_end():
    texts = lambda html: [b.text for b in html_blocks.blocks(html)]
    assert texts("a &am<b>p;</b> &lt; b") == ["a &amp; < b"]
    assert texts("<p>x<!-- open <b>y</b> z") == ["x"] and texts("<p>x<script>var a; <b> y") == ["x"]
    assert texts('<p title="a>b</p>c') == ["b", "c"] and texts("x < y") == ["x < y"]


def test_each_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_the_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
            assert {r[0] for r in docs.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
    scores = entry.queries()["op10_toxicity"](spark, SF).collect()
    assert {r["doc_id"] for r in seen["toxicity"][1].collect()} == {r["doc_id"] for r in scores if r["score"] < 0.7}
    before, after = seen["line_dedup"]
    expected = line_dedup.remove_boilerplate(before)
    assert {tuple(r) for r in after.select("doc_id", "text").collect()} <= {tuple(r) for r in expected.select("doc_id", "text").collect()}
    before, after = seen["near_dedup"]
    roots = brute.near_duplicates([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {i for i, (_, root) in roots.items() if i == root}
    before, after = seen["secrets"]
    assert before.count() == after.count()
    pattern = r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{18}"
    assert sum(len(re.findall(pattern, r["text"] or "")) for r in after.collect()) == 0
    pieces = seen["packing"][1]
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in after.collect()}
    assert near_dedup.near_duplicates(after).filter("not kept").count() <= 1
