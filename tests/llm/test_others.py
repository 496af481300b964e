"""Operators on embeddings, conversations and pages against brute force and round trips."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grabqc.llm import ann, chat, html, warc


def test_nearest(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300, rows_) for rows_ in ([0.0] * 8, None, [1.0, None] + [0.0] * 6, [float("nan")] * 8)]
    rows += [(400 + i, [1.0] * 8) for i in range(30)] + [(500, [1.0, 2.0]), (450, [2.0, 4.0]), (None, [1.0] * 8), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    good = {i: np.array(v) for i, v in rows if i is not None and ann.usable(v) is not None}
    for factor, shard in ((1.0, 4096), (1.0, 40), (0.9, 40)):
        got = {}
        for r in ann.nearest(df, F.col("vec_id") % 50 == 0, factor=factor, shard_rows=shard).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        hits = total = 0
        for q in (i for i in good if i % 50 == 0):
            others = [(-float(ann.measure(good[q][None], good[i][None])[0]), i) for i in good if i != q and len(good[i]) == len(good[q])]
            want = [i for _, i in sorted(others)[:5]]
            total += len(want)
            hits += len(set(want) & set(got.get(q, [])))
            assert factor < 1 or got.get(q, []) == want
        assert hits >= 0.9 * total
    assert ann.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_chat_round_trip(spark):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<", "|x <\\\\| \n", "", None, "é<|", "\\"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb <|", None]), rng.choice(texts), 9) for c in range(8) for t in range(rng.randint(1, 9))] + [(None, 0, "user", "hi", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, branch int")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(chat.linear(df))).collect()}
    assert len(got) == 9
    for c in got:
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        loss = "".join(b for a, b in own if a == "assistant")
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(own), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_conversations(chat.linear(df.where("false"))).count() == 0


def test_reply_trees(spark):
    # 1 - 2 - 3 and 1 - 4 - 5 - 6; 7 has no parent here; 8 and 9 answer each other, 10 answers 8
    nodes = [(1, None, 0.0), (2, 1, 1.0), (3, 2, 1.0), (4, 1, 0.0), (5, 4, 0.0), (6, 5, 3.0), (7, 99, 0.1), (8, 9, 9.0), (9, 8, 9.0), (10, 8, 9.0)]
    df = spark.createDataFrame([(1, n, p, "assistant", str(n), s) for n, p, s in nodes], "conv_id long, node_id long, parent_id long, role string, text string, score double")
    out = chat.branches(df, best=9).groupBy("branch").agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("u"), "text"))).alias("t")).orderBy("branch")
    assert [[x.text for x in r.t] for r in out.collect()] == [["1", "4", "5", "6"], ["1", "2", "3"], ["7"]]


def page(parts):
    return "<html><head><title>t</title><script>x('<p>no</p>')</script></head><body><nav><ul><li>menu</ul></nav>" + parts + "<footer>foot</footer>"


def test_main_text(spark):
    rows = [(1, "http://a.example/1", page("<div class='ad'>buy</div><article><h1>T &amp; u</h1><p><b>one<br>two<p>three &lt;\n four<aside>side</aside></article>"), 0),
            (2, "http://A.example/2", page("<article><h1>V</h1><p>x</p><div class=comments><p>nice</p></div></article>"), 0),
            (3, "http://b.example/", page("<div class=body><p>only " + "long text " * 9 + "</p><form>f</form></div><div class='cookie-notice'>c</div>"), 0),
            (4, None, None, 0), (5, "not a url", "", 0), (1, "http://a.example/1", "plain < text", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.text) for r in html.extract(df).collect()))
    assert got == sorted([(1, "T & u\none two\nthree < four"), (2, "V\nx"), (3, ("only " + "long text " * 9).strip()), (4, ""), (5, ""), (1, "")])
    assert html.extract(df.where("false")).count() == 0


def test_main_text_of_a_host_with_several_templates(spark):
    words = [f"w{i} " * 20 for i in range(8)]
    rows = [(i, "http://a.example/", page(f"<article><h1>T{i}</h1><p>{words[i]}</article>")) for i in range(3)]
    rows += [(i, "http://a.example/old", page(f"<div class=old><p>{words[i]}</p></div><p>all rights</p>")) for i in (3, 4)]
    rows += [(5, "http://a.example/home", page(f"<div class=home><h2>{words[5]}</h2></div>")), (6, None, page(f"<div><p>{words[6]}</p></div>")),
             (7, None, page(f"<main><p>{words[7]}</p></main>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert got == {i: (f"T{i}\n" if i < 3 else "") + words[i].strip() for i in range(8)}


def test_classes_that_only_tell_of_a_layout(spark):
    def of(before, inside):
        return f"<html><head><title>t</title></head>{before}{inside}</html>"

    pages = [of(f"<body class='{c}'>", f"<article class='{a}'><p>text</article><div class='comment-list'><p>no</div>")
             for c, a in (("has-sidebar", "post with-related"), ("no-sidebar comments-open", "x"), ("admin-toolbar", "comment"), ("", "ad"))]
    pages += [of("<body>", "<main id='content-navbar'><p>text</main>"), of("<body>", "<div class='sidebar'><article><p>text</article></div>"),
              of("<body>", "<div class='has-sidebar'><p>text</p></div><div id='site-footer'><p>no</p></div><div class='left_sidebar'>no</div>"),
              of("<body class='sidebar'>", "<article><p>text</article><div class='related'><article>no</article></div>")]
    rows = [(i, f"http://{h}.example/", p) for i, p in enumerate(pages) for h in ("one", f"own{i}")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [(r.page_id, r.url) for r in html.extract(df).collect() if r.text != "text"] == []
    assert all(map(html.dropped, ["div.ad", "div.cookie-notice", "nav", "div.ad-slot", "ul.share-buttons", "div.x.top_banner"]))
    assert not any(map(html.dropped, ["span.hljs-comment", "div.no-sidebar", "div.comments-open", "body.widget", "div.entry-header"]))


def test_dropped_inline_elements():
    inside = ("<p>one <span class='ad'>buy <span>this</span> <b>now</b><br></span>two <a class=share href=x>share</a>three <img class=ad> <code><span class=hljs-comment># four</span></code>"
              "<p>five <span class='ad'>not closed</p><p>six</p><ul><li>a <span class=ad>x<li>b</ul> <a class=share>x<a href=y>seven</a>")
    text = f"<html><body><article>{inside}</article></body></html>"
    assert html.main_text(text, html.main_slots(html.tree(text), 0)) == "one two three # four\nfive\nsix\na\nb\nseven"
    block = "<article>a <a class=share><div>s</div></a> b</article>"
    assert html.main_text(block, html.main_slots(html.tree(block), 0)) == "a b"


def test_wrapper_alignment():
    one = html.tree("<ul><li>a<li>b</ul><p>x</p>")
    two = html.tree("<ul><li>c</ul><h2>new</h2><p>x</p>")
    assert html.expression(html.merge(one, two)) == "<ul>(<li>#PCDATA</li>)+</ul>(<h2>#TEXT</h2>)?<p>#TEXT</p>"


@pytest.mark.parametrize("least", [0, 4])
def test_archives(spark, least):
    rows = [(1, "http://x/ a", "same"), (2, None, "same"), (3, "http://y/", "é\n\r\n\r\nWARC/1.1"), (4, "http://z/", None), (5, "", ""), (6, "u", "abc"), (7, "u", "abc"),
            (None, "n", "same"), (2, "again", "same")] + [(10 + i, "http://m/", "long " * i) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(2)
    got = warc.round_trip(df, min_bytes=least)
    out = got.collect()
    assert len(out) == len(rows)
    payloads = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest) for r in out)
    assert payloads == sorted((i or -1, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()) for i, _, h in rows)
    kinds = {}
    for r in out:
        kinds.setdefault(r.payload_digest, []).append(r)
    for same in kinds.values():
        whole = [r for r in same if r.record_type == "response"]
        top = max(r.page_id or -1 for r in same)
        assert len(whole) == (len(same) if same[0].payload_bytes < least else 1)
        assert all(r.refers_to == top for r in same if r.record_type == "revisit") and top in [r.page_id for r in whole]
    assert warc.round_trip(df.where("false")).count() == 0


def test_archive_versions():
    for version in (b"1", b"2"):
        data = warc.version_block(version) + warc.arc_record(version, 5, "http://x/ y", b"payload\n") + b"\n"
        (fields, block), = warc.read_arc(data)
        assert warc.payload_of(block) == b"payload\n" and fields[b"URL"] == b"http://x/%20y#page_id=5"
        (headers, _), = warc.read_warc(warc.warc_record(fields, block) + b"\r\n\r\n")
        assert headers[b"WARC-Type"] == b"response" and headers[b"WARC-Date"] == b"2024-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(warc.read_arc(data[:-6]))
