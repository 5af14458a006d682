"""Operators over pages and conversations."""

import hashlib
import math
import os
import random
import sys
import time

import pytest
from hypothesis import given, settings, strategies as st

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from climaflow.llm import chat_format, html_text, url_rules  # noqa: E402
from compare import check, duck  # noqa: E402

PARA = "<p>" + "The quick brown fox jumps over the lazy dog near the river bank. " * 6 + "</p>"
TEXT = ("The quick brown fox jumps over the lazy dog near the river bank. " * 6).strip()


@pytest.mark.parametrize("name", ["op9_columnar_chat", "op10_url_rules"])
def test_query_equals_sql(spark, con, small, name):
    assert check(spark, con, small, name, entry.queries()[name], entry.oracle_sql()[name]) is None


# 10: URL rules ---------------------------------------------------------------------------------------------------

def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_verdicts_equal_plain_rules(spark):
    rules = url_rules.RULES + [("a.com", "/fr/", "block"), ("b.a.com", "/", "allow"), ("com", "/fr/x", "block")]
    hosts = ["org", "x.org", "example.org", "www.Example.ORG", "notexample.org", "com", "a.com", "b.a.com", "c.b.a.com", "aa.com", "net", "", "com.", ".com", "a..com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=/es/", "/fr/", "/fr/x#y", "/de/1", "?q=/de/", "#/de/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "x://", "http:/one.org/", "a://b.org/c://d.com/de/", "http://o\nrg/es/"]
    rows = [(i % 50, u, "clash", "x") for i, u in enumerate(urls)] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, key string")
    got = url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect()
    want = sorted(str((i, *plain_verdict(u, rules))) for i, u, *_ in rows)
    assert sorted(str(tuple(r)) for r in got) == want
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark)).count() == 0
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.judge(pages, none).collect()} == {"allow"}


# 8: main text ----------------------------------------------------------------------------------------------------

CASES = {
    "menus, sidebars and readers go": (
        f"<body><div class='menu'><a href=a>Home</a></div><h1>Title</h1><div id=main>{PARA}{PARA}</div>"
        f"<div class='sidebar'>{PARA}</div><div id='comments'>{PARA}</div><footer>c</footer></body>", f"Title\n{TEXT}\n{TEXT}"),
    "an article's own header stays": (
        f"<body><header><h1>Site</h1></header><main><article><header><h1>Head</h1></header>{PARA}<form>go<input></form>{PARA}</article></main>",
        f"Head\n{TEXT}\n{TEXT}"),
    "a class of the body is no part": (f"<body class='has-sidebar'><div><a href=1>x</a></div><div>{PARA}<ul><li>one<li>two</ul>{PARA}</div>", f"{TEXT}\none\ntwo\n{TEXT}"),
    "references": ("<article><h1>T&eacute;st</h1><p>a &lt;b&gt; &amp &#65;</article>", "Tést\na <b> & A"),
    "scripts and comments": ("<body><article><p>a<!-- <p>x</p> --><script>var t='</p>';</script> b</p></article>", "a b"),
    "white space": ("<article><p>  a \n\t b<br>c </p></article>", "a b c"),
    "unfinished tag": ("<body><article><p>abc def <a hre", "abc def"),
    "no markup": ("just text & more < 5", "just text & more < 5"),
    "nothing": ("<html><body><nav>x</nav></body></html>", ""), "empty": ("", ""), "null": (None, ""),
}

CASES |= {
    "a listed word in a longer name is no part around an article": (
        f"<body><article><h1>T</h1>{PARA}<section id='related-work'><h3 id=social-effects>Effects</h3>{PARA}</section>"
        f"<div class='search-results-discussion'>{PARA}</div><p class=copyright-law>About the law.</p></article>",
        f"T\n{TEXT}\nEffects\n{TEXT}\n{TEXT}\nAbout the law."),
    "marks that say it wholly, or hold links, go": (
        f"<body><article>{PARA}<div class=ad>{PARA}</div><div class='box social-share'>x</div><div id=comments>{PARA}</div>"
        f"<div class='related-posts'><a href=1>One more story</a> <a href=2>Another one</a></div>{PARA}</article>", f"{TEXT}\n{TEXT}"),
    "a marked body without an article": (
        f"<body><div class='menu'><a href=a>Home</a></div><div class='post comment-enabled'>{PARA}<p id=notice-board>Of the board.</p>{PARA}</div><div id=comments>{PARA}</div></body>",
        f"{TEXT}\nOf the board.\n{TEXT}"),
    "a marked box beside the text": (f"<body><div>{PARA}{PARA}</div><div class='sidebar-box'>{PARA}{PARA}</div></body>", f"{TEXT}\n{TEXT}"),
    "formulas": ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>", "So x=1 holds."),
}
CASES |= {
    "an article is whole around its core": (f"<article><p>Lead.</p><div>{PARA * 5}</div><p>End line.</p></article>", "\n".join(["Lead.", *[TEXT] * 5, "End line."])),
    "direct text": (f"<article>Direct text<div>{PARA}{PARA}</div></article>", f"Direct text\n{TEXT}\n{TEXT}"),
    "a short section with its heading": (
        f"<main><section><h2>A</h2><p>short</p></section><section><h2>B</h2>{PARA * 3}</section></main>", "\n".join(["A", "short", "B", *[TEXT] * 3])),
    "running text around the core without an article": (
        f"<body><div><p>Lead.</p>own <b>text</b> here<div>{PARA * 5}</div><p>End.</p><ul><li><a href=1>Link</a></ul></div></body>",
        "\n".join(["Lead.", "own text here", *[TEXT] * 5, "End."])),
    "quotes that never close": (f"<article><p title='x>{TEXT}</p></article>", TEXT),
    "a greater sign in quotes": (f"<article><p title='x>y'>{TEXT}</p></article>", TEXT),
    "what begins like a comment": ("<article><p>abc</p></article><!-- never closed <p>x</p>", "abc"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, want = CASES[name]
    assert html_text.main_text(page) == want


@settings(max_examples=150, deadline=None)
@given(st.text("<>/ab p=\"'!-&;divtrl1\n", max_size=80))
def test_any_markup_is_read(page):
    html_text.main_text(page)


BROKEN = ["<a ", "<a '", "<a '>' ", "<b></i>", "<div>", "<ul><b></li><li>", "<p><b>", "<dl><dt>x", "<!", "</ ", "<a b=' \">", "&amp", "<script>", "< "]


@pytest.mark.parametrize("tail", ["", ">x\""])
@pytest.mark.parametrize("form", BROKEN)
def test_long_broken_pages_take_linear_time(form, tail):
    # Half a megabyte each; a quadratic reader needs many minutes.
    started = time.process_time()
    html_text.main_text(form * (500_000 // len(form)) + tail)
    assert time.process_time() - started < 15


def random_page(rng, depth=0):
    """A tree as (tag, parts), with texts of letters only."""
    parts = []
    for _ in range(rng.randint(0, 5)):
        if depth == 5 or rng.random() < 0.4:
            parts.append(" ".join("x" * rng.randint(1, 9) for _ in range(rng.randint(1, 12))) + " ")
        else:
            parts.append(random_page(rng, depth + 1))
    return rng.choice(["div", "section", "b", "a", "div", "blockquote"]) if depth else "body", parts


def markup(tree):
    return tree if isinstance(tree, str) else f"<{tree[0]}>" + "".join(map(markup, tree[1])) + f"</{tree[0]}>"


def plain_counts(tree, linked=False):
    """Characters, tags, linked characters, links below, and whether a block is in it, counted from scratch per node."""
    chars, tags, link_chars, links, block = 0, 1, 0, 0, tree[0] not in ("a", "b")
    for part in tree[1]:
        if isinstance(part, str):
            n = len(part.replace(" ", ""))
            chars, link_chars = chars + n, link_chars + n * linked
        else:
            c, t, lc, ln, bl = plain_counts(part, linked or part[0] == "a")
            chars, tags, link_chars, links, block = chars + c, tags + t, link_chars + lc, links + ln + (part[0] == "a"), block or bl
    return chars, tags, link_chars, links, block


def plain_nodes(tree, linked=False):
    yield tree, linked
    for part in tree[1]:
        if not isinstance(part, str):
            yield from plain_nodes(part, linked or part[0] == "a")


def plain_density(tree, linked, share):
    chars, tags, link_chars, links, _ = plain_counts(tree, linked)
    if not chars:
        return 0.0
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
    ratio = max(chars / max(link_chars, 1) * (tags / max(links, 1)), 1.0)
    return chars / tags * math.log(ratio) / (math.log(base) if base > 1 + 1e-9 else 1.0)


def test_densities_and_sums_equal_plain_ones():
    rng = random.Random(8)
    for _ in range(300):
        tree = random_page(rng)
        root = html_text.parse(markup(tree))
        html_text.prune(root)
        html_text.measure(root)
        body = root.parts[0]
        chars, _, link_chars, _, _ = plain_counts(tree)
        share = link_chars / max(chars, 1)
        want = []
        for node, linked in plain_nodes(tree):
            kids = [c for c in node[1] if not isinstance(c, str) and plain_counts(c)[4]]
            want.append((plain_density(node, linked, share), sum(plain_density(c, linked or c[0] == "a", share) for c in kids)))
        got = html_text._in_order(body)
        assert [n.density for n in got] == pytest.approx([d for d, _ in want])
        assert [n.total for n in got] == pytest.approx([t for _, t in want])
        parent = {id(c): n for n in got for c in n.parts if not isinstance(c, str)}
        best, threshold = html_text.core(body, parent)
        assert best.total == pytest.approx(max(t for _, t in want)) or best is body
        path = [best]
        while path[-1] is not body:
            path.append(parent[id(path[-1])])
        assert threshold == min(n.density for n in path)


def test_every_page_has_a_row(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    rows = entry.queries()["op8_text_density"](spark, small).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) for r in rows)
    odd = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>" + "long " * 100_000, "x")], "page_id bigint, url string, html string, text string")
    assert sorted(r.n_chars for r in html_text.extract(odd).collect()) == [0, 499_999]
    assert html_text.extract(odd.limit(0)).collect() == []


# 9: chat ---------------------------------------------------------------------------------------------------------

def rows_of(conversations):
    return [(c, t, role, text, "clash") for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]


def test_round_trip_and_loss_of_control_strings(spark):
    nasty = ["", None, "</turn>\n", "<turn user>\n", "\\", "\\\\<", "é\u2028\U0001f600", "a\nb", "x" * 70_000, "\\n>"]
    made = {k: [("user", nasty[k % 10]), ("assistant", nasty[(k + 3) % 10]), ("odd <r>\\\n", nasty[(k + 5) % 10]), ("assistant", nasty[k % 7]), (None, "z")] for k in range(200)}
    made[None] = [("assistant", "kept")]
    rows = spark.createDataFrame(rows_of(made), "conv_id bigint, turn bigint, role string, text string, formatted string")
    formatted = chat_format.format_conversations(rows)
    digests = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    assert len(digests) == 201
    for r in formatted.collect():
        turns = [(a or "", b or "") for a, b in made[r.conv_id]]
        assert chat_format.read_back(r.formatted) == turns
        learnt = "".join(b for a, b in turns if a == "assistant")
        whole = "".join(f"{a}\n{b}\n" for a, b in turns)
        d = digests[r.conv_id]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(turns), len(learnt), len(r.formatted))
        assert d.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert d.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert chat_format.format_conversations(rows.limit(0)).count() == 0


def test_conversations_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        made = {k: [("user" if t % 2 else "assistant", f"{k} {t}") for t in range(k % 9 + 1)] for k in range(60)}
        rows = spark.createDataFrame(rows_of(made), "conv_id bigint, turn bigint, role string, text string, x string")
        got = {r.conv_id: chat_format.read_back(r.formatted) for r in chat_format.format_conversations(rows).collect()}
        assert got == made
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
