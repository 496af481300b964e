"""Cases that earlier versions of the operators lost, or could not read."""

import itertools
import random
import subprocess
import sys

import duckdb
import numpy as np
import pytest
from pyspark import cloudpickle

from grabqc.llm import decontam, html, licenses, quality, simhash, suffix


def edited(words, edits, rng):
    """Words with that many edits: changed, taken out or put in."""
    out = list(words)
    for _ in range(edits):
        kind, at = rng.choice("sdi"), rng.randrange(len(out))
        if kind == "s":
            out[at] = f"new{rng.randrange(10**6)}"
        elif kind == "d" and len(out) > 1:
            del out[at]
        else:
            out.insert(at, f"new{rng.randrange(10**6)}")
    return out


def test_decontamination_finds_items_at_the_largest_distance():
    """200 items, three texts each with as many edits as the distance allows; 0.95 is the documented recall."""
    items = duckdb.sql("SELECT item_id, text FROM '/root/testdata/sf0.1/benchmark.parquet' ORDER BY item_id LIMIT 200").fetchall()
    index, rng = decontam.Index(items, 0.2, 0.95, 6, 5), random.Random(11)
    texts, of = [], []
    for (item, _), (_, words) in zip(items, index.items):
        for _ in range(3):
            around = [f"o{rng.randrange(10**6)}" for _ in range(20)]
            own = [w.decode() for w in words]
            texts.append(" ".join([*around, *edited(own, index.most(len(own)), rng), *around]))
            of.append(item)
    found = index.search(texts)
    assert len(texts) == 600 and sum(item in own for item, own in zip(of, found)) >= 0.95 * 600


def test_items_go_to_the_tasks_in_blocks_of_bounded_bytes():
    items = [(i, "x" * n) for i, n in enumerate([10, 10, 5000, 10, 10, 10])]
    assert [[i for i, _ in b] for b in decontam._item_blocks(items, 2, 1000)] == [[0, 1], [2], [3, 4], [5]]
    assert list(decontam._item_blocks([], 2, 1000)) == []


def brute_chain(text, template, min_run):
    """Most words of the template that disjoint runs, in the order of both, cover; over all matching runs."""
    runs = [(i, j, n) for i in range(len(text)) for j in range(len(template)) for n in range(min_run, len(template) + 1)
            if i + n <= len(text) and j + n <= len(template) and text[i:i + n] == template[j:j + n]]
    best = {}
    for i, j, n in sorted(runs):
        best[i, j, n] = n + max((v for (a, b, m), v in best.items() if a + m <= i and b + m <= j), default=0)
    return max(best.values(), default=0)


def test_licence_spans_equal_a_brute_force_chain():
    rng = random.Random(4)
    for _ in range(60):
        word = "abcdefgh"[:rng.randint(3, 8)]
        templates = [(f"t{k}", " ".join(rng.choice(word) for _ in range(rng.randint(3, 12)))) for k in range(3)]
        scanner = licenses.Scanner(templates, [], 2, 0.01)
        text = " ".join(rng.choice(word) for _ in range(20))
        got = {}
        for span in scanner.scan(text)[3]:
            got.setdefault(span["label"], []).append(round(span["cover"] * len(scanner.texts[int(span["label"][1:])])))
        for k, (label, template) in enumerate(templates):
            longest = brute_chain(text.split(), template.split(), min(2, len(template.split())))
            assert max(got.get(label, [0])) >= longest - 1 and max(got.get(label, [0])) <= longest, (text, templates, got, longest)


def test_a_passage_twice_in_a_template_and_a_shorter_run_of_another():
    twice = licenses.Scanner([("t", "a b c d x y a b c d z")], [], 4, 0.1)
    span = twice.scan("q a b c d r s a b c d q")[3]
    assert round(span[0]["cover"] * 11) == 8
    other = licenses.Scanner([("long", "a b c d e f"), ("short", "z b c d e y k l")], [], 4, 0.1)
    assert {s["label"] for s in other.scan("a b c d e f")[3]} == {"long", "short"}


@pytest.mark.parametrize("depth", [300, 1500, 10_000])
def test_deep_pages(depth):
    page = "<body>" + "<div>" * depth + "<article><p>text</p><nav>menu</nav></article>" + "</div>" * depth + "<p>after"
    assert html.main_text(page, html.host_slots({html.kind(html.tree(page)): html.tree(page)})) == "text"
    plain = "<body>" + "<span class=ad>" + "<div>" * depth + "gone" + "</div>" * depth + "</span><p>text"
    assert html.main_text(plain, html.host_slots({2: html.tree(plain)})) == "text"


def test_pages_with_ids_of_their_own_share_one_wrapper():
    pages = [f"<html><body id=p{i}><article id='post-{i}' class='post post-{i} x'><p id=para{i}>text {i}</p></article></body></html>" for i in range(2000)]
    known = html.tree(pages[0])
    for page in pages[1:]:
        known = html.merge(known, html.tree(page))
    assert html.expression(known) == "<html><body><article.post.x><p>#PCDATA</p></article.post.x></body></html>".replace("</article.post.x>", "</article>")
    assert len(html.host_slots({0: known})[0]) == 1
    assert html.dropped(html.mark("div", " id='site-footer'")) and html.dropped(html.mark("div", " class='ad-slot'"))


def test_page_functions_load_where_the_library_is_not(tmp_path):
    out = tmp_path / "f"
    out.write_bytes(cloudpickle.dumps((html.tree, html.main_text, html.text_slots, html.host_slots)))
    code = f"import pickle; t, m, s, h = pickle.load(open({str(out)!r}, 'rb')); p = '<article><p class=x>a</p></article>'; print(m(p, h({{0: t(p)}})))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin"}, capture_output=True, text=True)
    assert done.stdout.strip() == "a", done.stderr


@pytest.mark.parametrize("names", [["quality_score", "near_dup_row", "near_dup_print"], ["Benchmark_Hits", "NEAR_DUP_ROW", "Quality_Score"]])
def test_stages_keep_columns_that_have_their_helpers_names(spark, names):
    rows = [(i, f"some words that make a text of their own {i} {i * 7}" if i % 5 else "copied words here again", *(f"{n}{i}" for n in names)) for i in range(40)]
    rows += [(40, None, *names), (41, "", *names), (None, "a null id", *names)]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    benchmark = spark.createDataFrame([(1, "words that make a text of")], "item_id long, text string")
    none, key = benchmark.where("false"), str
    for out in (quality.drop_rejected(docs, labels, threshold=-1.0), decontam.drop_contaminated(docs, none)):
        assert out.columns == docs.columns and sorted((tuple(r) for r in out.collect()), key=key) == sorted(rows, key=key)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {0, 40, None} <= ids and not ids & {5, 10, 15, 20, 25, 30, 35, 41}  # copies, and the empty text after the null one
    assert {tuple(r) for r in kept.collect()} <= set(rows)
    assert decontam.drop_contaminated(docs, benchmark).count() < len(rows)
    for call in (lambda: quality.with_scores(docs, None, names[0].lower()), lambda: decontam.with_hits(docs, none, names[0].lower())):
        with pytest.raises(ValueError):
            call()


def test_the_quality_score_is_the_sum_of_its_trees(monkeypatch):
    """Every tree of the fit is kept as it is made; a score is the logistic of what they say of a row, one by one."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] + x[:, 3] * x[:, 4] + rng.normal(size=400) / 4 > 0).astype(float)
    single, double, leaves, quadrants = [], [], quality._leaves, quality._quadrants
    monkeypatch.setattr(quality, "_leaves", lambda *a: single.append((a[2], leaves(*a))) or single[-1][1])
    monkeypatch.setattr(quality, "_quadrants", lambda *a: double.append(quadrants(*a)) or double[-1])
    model = quality.Model.fit(x, y, rounds=9, rate=0.2, pair_rounds=5)
    pairs = [(a, b) for a, b, _, _ in model.pairs]
    single = [tree for depth, tree in single if depth == 2][:9 * x.shape[1]]  # not the subtrees of a tree
    assert len(single) == 9 * x.shape[1] and len(pairs) == 6
    double = [tree for tree, _ in double[-5 * 6:]]
    got = model.score(x)
    for i in range(0, 400, 7):
        bins = [sum(v >= e for e in edges) for edges, v in zip(model.edges, x[i])]
        total = model.start + sum(0.2 * tree[bins[n % x.shape[1]]] for n, tree in enumerate(single))
        coarse = [min(b * 8 // (len(edges) + 1), 7) for b, edges in zip(bins, model.edges)]
        total += sum(0.2 * tree[coarse[pairs[n % 6][0]], coarse[pairs[n % 6][1]]] for n, tree in enumerate(double))
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_no_table_is_left_in_the_catalog(spark):
    docs = spark.createDataFrame([(i, "one passage that is long enough to be cut out of the later text " + str(i)) for i in range(5)], "doc_id long, text string")
    assert suffix.repeats(docs).where("n_removed > 0").count() == 4
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("grabqc")]


def test_every_small_page_reads_alike_with_and_without_the_depth_bound(monkeypatch):
    inner = ["<p>a</p>", "<div class=ad>b</div>", "<nav>c</nav>", "<header>d</header>", "<article>e</article>", "<main><header>f</header>g</main>", "<span class=ad>h</span>"]
    pages = ["<body>" + "<div>" * 3 + "".join(parts) + "</div>" * 3 for n in (1, 2, 3) for parts in itertools.product(inner, repeat=n)]
    want = [html.main_text(p, html.host_slots({html.kind(html.tree(p)): html.tree(p)})) for p in pages]
    monkeypatch.setattr(html, "DEEPEST", 2)
    got = [html.main_text(p, html.host_slots({html.kind(html.tree(p)): html.tree(p)})) for p in pages]
    assert sum(a == b for a, b in zip(want, got)) >= 0.9 * len(pages)
    assert all(set(b) <= set("aefgdh \n") for b in got)
