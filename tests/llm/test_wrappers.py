"""What a host's wrapper knows as the template's own text."""

import random

from grabqc.llm import html


def texts(spark, pages):
    df = spark.createDataFrame([(i, url, p) for i, (url, p) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in html.extract(df).orderBy("page_id").collect()]


def article(number, share="<p class=invite>Share this story with friends</p>"):
    return f"<html><body><article><h1>Title {number}</h1><p>{'word ' * 9}{number}</p>{share}</article></body></html>"


def test_text_that_every_page_repeats_is_the_template_s(spark):
    pages = [("http://four.example/", article(i)) for i in range(4)]
    pages += [("http://three.example/", article(i)) for i in range(3)]
    pages += [("http://copies.example/", article(0))] * 6
    pages += [("http://lacks.example/", article(i, "" if i == 2 else "<p class=invite>Share</p>")) for i in range(5)]
    pages += [("http://plain.example/", f"<div class=story><p class=x>{'text ' * 9}{i}</p><p class=y>Read it all</p></div>") for i in range(4)]
    body = "Title {0}\n" + "word " * 9 + "{0}"
    share = "\nShare this story with friends"
    want = [body.format(i) for i in range(4)] + [body.format(i) + share for i in range(3)] + [body.format(0) + share] * 6
    want += [body.format(i) + ("" if i == 2 else "\nShare") for i in range(5)]
    want += ["text " * 9 + str(i) for i in range(4)]
    assert texts(spark, pages) == want


def test_a_page_with_no_other_text_keeps_the_template_s(spark):
    pages = [("http://a.example/", article(i)) for i in range(9)]
    pages.append(("http://a.example/", "<html><body><article><h1></h1><p></p><p class=invite>Share this story with friends</p></article></body></html>"))
    assert texts(spark, pages)[-1] == "Share this story with friends"


def test_template_slots_equal_a_count_over_the_pages():
    rng = random.Random(5)
    for _ in range(60):
        names = [f"b-{c}" for c in "abcdefg"]
        fixed = {n: rng.random() < 0.5 for n in names}
        always = {n: rng.random() < 0.7 for n in names}
        pages = []
        for i in range(rng.randint(2, 9)):
            blocks = {n: f"same {n}" if fixed[n] else f"text {i} of {n}" for n in names if always[n] or rng.random() < 0.5}
            blocks["main"] = f"{'long ' * 40}{rng.randint(0, 4)}"
            pages.append(blocks)
        trees = [html.tree("<article>" + "".join(f"<div class={n}>{t}</div>" for n, t in p.items()) + "</article>") for p in pages]
        known = trees[0]
        for tree in trees[1:]:
            known = html.merge(known, tree)
        seen = {0: {html.main_digest(t, 0) for t in trees}}
        everywhere = set.intersection(*map(set, pages))
        own = {n for n in everywhere if len({p[n] for p in pages}) == 1} if len({str(p) for p in pages}) >= html.ENOUGH else set()
        sizes = {n: sum(len(p.get(n, "")) for p in pages) for n in {n for p in pages for n in p}}
        if 2 * sum(sizes[n] for n in own) >= sum(sizes.values()):
            own = set()
        left = {n for p in pages for n in p} - own
        got = [{path[-1].split(".")[1] for path in s} for s in html.host_slots({0: known}, seen)]
        assert got == [s for s in (left, own) if s]
