"""Mixing, lines, shards, rules, benchmark passages and pages on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldboard import scratch
from foldboard.llm import mixing
from foldboard.llm.decontamination import clean_documents, contamination
from foldboard.llm.html_text import article, host_of, main_text, parse
from foldboard.llm.line_dedup import parsed, recurring_lines, without_recurring_lines
from foldboard.llm.mixing import (
    FLATTENING,
    KEPT_SHARE,
    MARGINS,
    described,
    drawn_documents,
    mixed_documents,
    op4_mixing,
    probabilities,
)
from foldboard.llm.quality_rules import ablation, apply_policy, ledger, mask
from foldboard.llm.sharding import longest_first, shard_by_bytes

pytestmark = pytest.mark.usefixtures("sparse")


def test_raking_reaches_the_targets(spark):
    rows = [
        (k, "x " * (1 + k % 9), ["en", "de"][k % 7 < 2], ["a", "b", "c"][k % 3]) for k in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    target = lambda **shares: spark.createDataFrame(
        list(shares.items()), "value string, share double"
    )
    targets = {
        "source": target(a=0.5, b=0.3, c=0.2),
        "lang": target(en=0.25, de=0.75),
        "topic": target(prose=1.0),
    }
    cells = probabilities(described(docs), targets, 0.1, rounds=30, tolerance=1e-9)
    total = cells.agg(F.sum("tokens"), F.sum("weight")).first()
    assert math.isclose(total[0], total[1], rel_tol=1e-6)
    for margin in ("source", "lang"):
        shares = {r[0]: r[1] / total[0] for r in cells.groupBy(margin).agg(F.sum("weight")).collect()}
        wanted = {r["value"]: r["share"] for r in targets[margin].collect()}
        assert all(math.isclose(shares[v], wanted[v], rel_tol=1e-4) for v in wanted)


def test_saturated_cells_hand_on_their_tokens(spark):
    """Rare sources and languages want more than they have; the draw still has its size and the other margins."""
    rows = [
        (k, "word " * (20 + k % 7), "de" if k % 11 == 0 else "en", "rare" if k % 29 == 0 else "abc"[k % 3])
        for k in range(3_000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    cells = probabilities(described(docs), kept_share=0.5).collect()
    assert all(0 <= c["probability"] <= 1 for c in cells)
    total = sum(c["tokens"] for c in cells)
    drawn = lambda name, value: sum(
        c["probability"] * c["tokens"] for c in cells if c[name] == value
    )
    assert math.isclose(sum(c["probability"] * c["tokens"] for c in cells), total / 2, rel_tol=1e-3)
    # All of what is rare, and alike of the rest.
    for name, value in (("lang", "de"), ("source", "rare")):
        assert math.isclose(drawn(name, value), sum(c["tokens"] for c in cells if c[name] == value), rel_tol=1e-3)
    assert math.isclose(drawn("source", "a"), drawn("source", "b"), rel_tol=0.02)
    kept = mixed_documents(docs).filter("drawn").agg(F.sum("tokens")).first()[0]
    assert abs(kept / total - 0.5) < 0.05


def test_few_cells_are_scaled_without_shuffles(spark, monkeypatch):
    rows = [(k, "x " * (1 + k % 9), ["en", "de"][k % 7 < 2], "abc"[k % 3]) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    plans = []

    def recorded(df, label):
        if label == "cells" and "weight" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return scratch.written(df, label)

    monkeypatch.setattr(mixing, "written", recorded)

    def weights():
        plans.clear()
        cells = probabilities(described(docs), rounds=2).collect()
        return {tuple(r[m] for m in MARGINS): r["weight"] for r in cells}, plans[2:]

    together, few = weights()
    assert few and all("Window" in plan and "Exchange" not in plan for plan in few)
    monkeypatch.setattr(scratch, "ROWS_PER_TASK", 0)
    apart, many = weights()
    assert all("Exchange" in plan for plan in many)
    assert together == pytest.approx(apart)


def test_mixture_of_the_documents_is_calibrated(spark, sf_dir):
    """Plain numpy on the cells of the query: every margin gets what it can reach, and the draw has its size."""
    rows = op4_mixing(spark, sf_dir).collect()
    cells = {}
    for r in rows:
        own = cells.setdefault(tuple(r[m] for m in MARGINS), [0, r["probability"]])
        own[0] += r["tokens"]
        assert own[1] == r["probability"] and 0 <= r["probability"] <= 1
    cells = {key: own for key, own in cells.items() if own[0]}
    names, tokens = list(cells), np.array([own[0] for own in cells.values()], "float64")
    probability = np.array([own[1] for own in cells.values()])
    total = tokens.sum()
    assert abs((tokens * probability).sum() / total - KEPT_SHARE) < 1e-3
    for place, _ in enumerate(MARGINS):
        values = sorted({n[place] for n in names}, key=str)
        inside = np.array([[n[place] == v for n in names] for v in values])
        room = inside @ tokens
        share = room**FLATTENING / (room**FLATTENING).sum()
        # The level at which shares, but at most all tokens of a value, make the draw.
        low, high = 0.0, 1e12
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if np.minimum(room, share * middle).sum() < KEPT_SHARE * total else (low, middle)
        reachable = np.minimum(room, share * low)
        assert np.abs(inside @ (tokens * probability) - reachable).max() / total < 1e-3
    assert all(r["drawn"] for r in rows if r["probability"] == 1)


def test_mixing_edges(edge_docs, no_docs):
    mixed = mixed_documents(edge_docs)
    rows = mixed.collect()
    assert len(rows) == edge_docs.count()
    assert all(0 <= r["probability"] <= 1 for r in rows)
    assert mixed.columns == ["doc_id", *MARGINS, "tokens", "probability", "drawn"]
    drawn = drawn_documents(edge_docs)
    assert drawn.columns == edge_docs.columns
    assert drawn.count() == sum(r["drawn"] for r in rows)
    assert mixed_documents(no_docs).count() == drawn_documents(no_docs).count() == 0
    everything = drawn_documents(edge_docs.filter("n_chars > 10"), kept_share=1e6)
    assert everything.count() == edge_docs.filter("n_chars > 10").count()


def test_templates_generalise_fields(spark):
    same = "Posted by {} under the usual terms of this site"
    rows = [
        (k, f"own line number {'abcdefgh'[k]} {'hgfedcba'[k]} here\n{same.format(name)}\nok")
        for k, name in enumerate("ann bob cat dan eve fay gus hal".split())
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = recurring_lines(parsed(docs.select(F.xxhash64("text").alias("doc"), "text"))).collect()
    assert {r["template"] for r in found} == {"Posted by <*> under the usual terms of this site"}
    left = {r["doc_id"]: r for r in without_recurring_lines(docs).collect()}
    assert left[0]["text"] == "own line number a h here\nok"
    assert {(r["n_lines"], r["n_dropped"]) for r in left.values()} == {(3, 1)}
    # Copies of one text are no recurrence.
    copies = spark.createDataFrame([(k, rows[0][1]) for k in range(20)], docs.schema)
    assert without_recurring_lines(copies).filter("n_dropped > 0").isEmpty()


def test_line_edges(edge_docs, no_docs):
    rows = without_recurring_lines(edge_docs).collect()
    assert sorted(str(r["text"]) for r in rows) == sorted(
        str(r["text"]) for r in edge_docs.select("text").collect()
    )
    assert {r["n_lines"] for r in rows if r["text"] is None} == {0}
    assert without_recurring_lines(no_docs).count() == 0


def test_longest_first_fills_the_least_loaded():
    placed = longest_first([(7, "a"), (6, "b"), (5, "c"), (4, "d"), (3, "e")], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0} or placed == {
        "a": 0, "b": 1, "c": 1, "d": 0, "e": 1
    }
    assert longest_first([], 3) == {}


def test_shards(spark, edge_docs, no_docs):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), F.col("id").cast("int") % 50).alias("text")
    )
    rows = shard_by_bytes(docs.union(docs.limit(200)), 7).collect()
    loads, slots, of_text = {}, {}, {}
    for r in rows:
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        of_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert len(loads) == 7 and len(rows) == 3_200
    assert max(loads.values()) - min(loads.values()) <= 16 + 50 * 4 * 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    edge = shard_by_bytes(edge_docs, 3).collect()
    assert len(edge) == edge_docs.count()
    assert len({r["shard"] for r in edge if r["size"] == 16}) == 1
    assert shard_by_bytes(no_docs, 3).count() == 0


def test_rules(spark, edge_docs, no_docs):
    entries = ledger(edge_docs)
    rows = apply_policy(entries).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 50)
    assert next(r for r in rows if r["doc_id"] == 1)["kept"]
    assert apply_policy(ledger(no_docs)).count() == 0
    lines = {r["rule"]: r for r in ablation(entries, "v2").collect()}
    few = lines["few_words"]
    assert few["n_failed"] == sum(r["n_words"] < 50 for r in rows)
    alone = sum(r["fail_bits"] == mask(["few_words"]) for r in rows)
    assert few["n_only_this"] == alone and few["n_kept_without"] == few["n_kept"] + alone


def test_passages(spark, edge_docs, no_docs):
    item = " ".join(f"item{k}" for k in range(20))
    rows = [
        (1, f"before it {item.upper()}, after"),
        (2, " ".join(item.split()[:12])),
        (3, "x " * 500 + item),
        (4, None),
        (5, "say Short Item! twice short-item"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(
        [(1, item), (1, item), (2, "short item"), (3, None), (4, ""), (None, "before it")],
        "item_id long, text string",
    )
    found = {r["doc_id"]: r for r in contamination(docs, bench).collect()}
    assert (found[1]["n_words"], found[1]["n_hit"], found[1]["items"]) == (23, 22, ["", "1"])
    assert (found[2]["n_hit"], found[3]["n_hit"], found[4]["n_words"]) == (0, 20, 0)
    assert (found[5]["n_words"], found[5]["n_hit"], found[5]["items"]) == (6, 4, ["2"])
    assert sorted(r["doc_id"] for r in clean_documents(docs, bench).collect()) == [2, 3, 4]
    assert contamination(edge_docs, bench).count() == edge_docs.count()
    assert clean_documents(edge_docs, bench).columns == edge_docs.columns
    assert contamination(no_docs, bench).count() == 0
    assert contamination(docs, bench.limit(0)).filter("n_hit > 0").isEmpty()


PAGE = """<!DOCTYPE html><html><head><title>Head &amp; title</title><style>p{{}}</style></head><body>
<header><a href="/">Site</a></header><nav><ul><li>Menu<li>More</ul></nav><div class="cookie-notice">Cookies!</div>
<div id="wrap"><{box}><h1>Title &amp;  {k}</h1><p>First <b>bold
text</b><br>line {k}<p>Second &lt;one&gt;</p><script>var t = "</p>";</script>
<form>Name <input></form><aside>Also</aside><ul><li>point {k}</li></ul>
<section class="comments"><p>I disagree</p></section></{box}></div>
<div class="sidebar"><p>Links</p></div><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize("box", ["article", "main", 'div class="post"'])
def test_pages(spark, box):
    source = lambda k: PAGE.format(box=box, k=k).replace(f"</{box}>", f"</{box.split()[0]}>")
    rows = [(k, f"https://user@Host.example:8080/{k}", source(k), "x") for k in range(4)]
    rows += [(8, None, None, "x"), (None, "https://host.example/9", "", "x")]
    rows += [(9, "http://other.example", "no markup &amp at all <b", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = {r["page_id"]: r for r in main_text(pages).collect()}
    assert found[2]["text"] == "Title & 2\n\nFirst bold text line 2\n\nSecond <one>\n\npoint 2"
    assert found[2]["n_chars"] == len(found[2]["text"])
    assert found[8]["text"] == found[None]["text"] == ""
    assert found[9]["text"] == "no markup & at all <b"
    assert main_text(pages.limit(0)).count() == 0


def test_markup_that_once_lost_text():
    """Open heads, self-closed drawings, and attributes that only look like classes."""
    text = lambda source: article(parse(source), None)
    assert text("<html><head><title>T</title><meta charset=x><body><p>Here it is</p></html>") == "Here it is"
    assert text("<head><link rel=a href=b><p>Block without a body</p>") == "Block without a body"
    assert text("<body><p>One</p><svg width=1 /><p>Two</p><svg><text>no</text></svg><p>Three</p>") == "One\n\nTwo\n\nThree"
    assert text('<body><div data-class="sidebar"><p>One</p></div><div title="class=menu"><p>Two</p></div>') == "One\n\nTwo"
    assert text("<article><p>One</p></article><div class=user-comments><p>No</p></div>") == "One"


def test_classes_tell_templates_from_quotations(spark):
    """Two blocks on the same five of eight pages are a class of the template; one block alone is quoted text."""
    page = "<body><article><p>Own text {k} of {k}</p>{more}</article></body>"
    both = "<p>Read our daily letter</p><p>Follow the station</p>"
    rows = [(k, "http://a.b/x", page.format(k=k, more=both if k < 5 else "")) for k in range(8)]
    rows += [
        (10 + k, "http://c.d/x", page.format(k=k, more="<p>As the old saying goes</p>" if k < 5 else ""))
        for k in range(8)
    ]
    found = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(8):
        assert found[k] == f"Own text {k} of {k}"
        assert found[10 + k] == f"Own text {k} of {k}" + ("\n\nAs the old saying goes" if k < 5 else "")


def test_blocks_on_every_page_of_a_host_are_dropped(spark):
    """Boilerplate in unnamed elements goes; what copies of a page repeat stays."""
    body = (
        "<html><body><div class=c7>Всё меню сайта</div><article><p>Own text {k} of this page</p>"
        "<p>Read our daily letter</p><div class=x1><table><tr><td>Home<td>About</table></div></article></body></html>"
    )
    rows = [(k, f"http://a.example/{k}", body.format(k=k)) for k in range(8)]
    copied = "<body><article><p>First of a copy</p><p>Second of a copy</p></article></body>"
    rows += [(100 + k, f"http://b.example/{k}", copied) for k in range(8)]
    bare = "<body><p>Main menu here</p><div class=c1><p>Long text number {k} of the page that is read</p></div></body>"
    rows += [(200 + k, f"http://c.example/{k}", bare.format(k="abcdefgh"[k])) for k in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    for k in range(8):
        assert found[k] == f"Own text {k} of this page"
        assert found[100 + k] == "First of a copy\n\nSecond of a copy"
        assert found[200 + k] == f"Long text number {'abcdefgh'[k]} of the page that is read"


@pytest.mark.parametrize(
    "before, after",
    [
        ('<body class="has-sidebar"><article>', "</article></body>"),
        ('<body class="sidebar"><div class="layout no-ads"><div class="post">', "</div></div></body>"),
        ('<div id="with-navigation"><article>', "</article></div>"),
        ('<div class="sidebar"><p>Ad</p><article>', "</article></div>"),
        ('<form action="x"><main>', "</main></form>"),
    ],
)
def test_names_around_and_inside_an_article_keep_it(spark, before, after):
    inner = (
        '<h2 id="search-algorithm">Search</h2><p>Value {k}</p><section id="discussion"><h2 id="related-work">Related'
        '</h2><p>Debate {k}</p></section><table class="share prices"><tr><td>Price {k}</td></tr></table>'
        "<p>So <math><mi>x</mi><mo>=</mo><mn>{k}</mn></math></p><object>Object {k}</object>"
        '<div class="comments">Reply {k}</div>'
    )
    rows = [(k, f"http://a.example/{k}", before + inner.format(k=k) + after) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    for k in range(4):
        wanted = ["Search", f"Value {k}", "Related", f"Debate {k}", f"Price {k}", f"So x={k}", f"Object {k}"]
        assert found[k] == "\n\n".join(wanted)


def test_hosts():
    assert host_of("HTTP://a.B.c:80/x?y") == "a.b.c"
    assert host_of("//h/x") == "h"
    assert host_of("nothing") == host_of(None) == ""
