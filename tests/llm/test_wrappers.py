"""Wrapper inference on pages of known main text."""

import random

import pytest

from columnlens.llm import wrappers
from columnlens.llm.oracle import ORACLE_SQL
from columnlens.llm.queries import QUERIES

from .common import against_sql


def page(rnd, site):
    word = lambda: rnd.choice(["alpha", "beta", "g&amp;h", "délta", "x&nbsp;y", "&lt;b&gt;"])
    line = lambda: " ".join(word() for _ in range(rnd.randrange(1, 9)))
    plain = lambda s: " ".join(s.replace("&nbsp;", " ").replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&").split())
    blocks, html = [], ""
    for _ in range(rnd.randrange(1, 6)):
        a = line()
        kind = rnd.randrange(4)
        html += [f"<p>{a}", f"<p>{a}</p>\n", f"<blockquote><p><i>{a}</i></p></blockquote>", f"<ul><li>{a}<li>{a}</ul>"][kind]
        blocks += [plain(a)] * (2 if kind == 3 else 1)
        if rnd.random() < 0.4:
            html += "<div class='ad-box'>buy now</div>"
    title = line()
    main = {"article": "<article id=p{}><h1>{}</h1>{}<section class=comments><p>me too</p></section></article>",
            "main": "<main><h1>{1}</h1>{2}<form>Name <input></form></main>",
            "named": "<div class='post-{}' id='content'><h1>{}</h1>{}<div id='related'><a href=x>more</a></div></div>"}[site]
    body = main.format(rnd.randrange(99), title, html)
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p>a{{}}</style></head><body><header>Site</header>"
            f"<nav><ul>{'<li><a href=q>menu</a></li>' * rnd.randrange(1, 5)}</ul></nav><script>var a='</p><p>no';</script><!-- <p>no -->"
            f"<div class='cookie notice'>Cookies!</div>{body}<aside><p>side</p></aside><footer>&copy; me</footer>"), " ".join([plain(title), *blocks])


@pytest.mark.parametrize("site", ["article", "main", "named"])
def test_sites(spark, site):
    rnd = random.Random(site)
    made = [page(rnd, site) for _ in range(60)]
    rows = [(i, f"https://{site}.example:80/{i}", h, "clash") for i, (h, _) in enumerate(made)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for sent in (1 << 20, 0):
        got = {r["page_id"]: r["text"] for r in wrappers.extracted(df, sent_bytes=sent).collect()}
        assert got == {i: t for i, (_, t) in enumerate(made)}


def test_expression():
    a = wrappers.page_wrapper("<ul><li>a<li>b</ul><dl><dt>1<dd>2<dt>3<dd>4</dl>")
    b = wrappers.page_wrapper("<ul><li>a</ul><p>new</p><dl><dt>1<dd>2</dl>")
    whole = wrappers.align(a, b)
    assert wrappers.expression(whole).startswith("( ul( li( # )+ ) p( new )?")
    assert wrappers.expression(wrappers.page_wrapper("<dl><dt>1<dd>2<dt>3<dd>4</dl>")) == "( dl( ( dt( # ) dd( # ) )+ ) )"


def test_constant_texts_go_where_nothing_names_the_main_part(spark):
    rows = [(i, "http://h/", f"<body><div>Same header</div><div><p>text {i}</p></div>") for i in range(5)]
    got = wrappers.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["text"].endswith(f"text {r['page_id']}") for r in got)


@pytest.mark.parametrize("copies", [1, 4])
def test_titles_that_no_other_page_confirms_stay(spark, copies):
    """A host of one page, or of its copies with other menus, is no evidence of a template."""
    long = "a paragraph of quite a few more than sixty characters, as most paragraphs have"
    rows = [(i, "http://one/", f"<body><nav>{i}</nav><div><h1>Short title</h1><p>{long}</p><p class=z>End</p></div>") for i in range(copies)]
    rows += [(10 + i, "http://many/", f"<body><div class=top>Same header</div><div><h1>Title {i}</h1><p>{long} {i}</p></div>") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(df).collect()}
    assert got == {i: f"Short title {long} End" for i in range(copies)} | {10 + i: f"Title {i} {long} {i}" for i in range(4)}


@pytest.mark.parametrize("address", ["http://h/", None])
def test_templates_of_one_host(spark, address):
    """Each page's own container counts, whatever other pages of the host have."""
    long = lambda i: f"text {i} " + "with many words " * 9
    forms = ["<article><h1>T{0}</h1><p>{1}</p><p class=more>Read on</p></article><div>Home</div>", "<main><h1>T{0}</h1><p>{1}</p></main><div>Home</div>",
             "<div class=content><h1>T{0}</h1><p>{1}</p></div><div>Home</div>", "<div><h1>T{0}</h1><p>{1}</p></div>",
             "<main><h1>T{0}</h1><p>{1}</p></main><div class=cards><article>card {0}</article></div>",
             "<article><img src=x></article><main><h1>T{0}</h1><p>{1}</p></main>"]
    rows = [(i, address, "<body>" + forms[i % 6].format(i, long(i))) for i in range(36)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(df).collect()}
    assert got == {i: f"T{i} {long(i)}".strip() for i in range(36)}


def test_pages_of_a_constant_in_any_order():
    made = [wrappers.page_wrapper(f"<div>Header</div><p>text {i % 5}</p>") for i in range(20)]
    forth, back = wrappers._fold(iter(made)), wrappers._fold(iter(made[::-1]))
    assert forth[3][0] == back[3][0] and len(forth[3][0][4]) == wrappers.CONFIRMED
    assert len(wrappers._fold(iter(made[::5]))[3][0][4]) == 1


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no address", "just text &amp; more"), (4, "http://a/", "<p>" * 5000 + "deep" + "<div>" * 3000 + "er"),
            (5, "http://b/", "<article>" + "<p>long text " * 30_000), (6, "http://c/", "a < b <"), (6, "http://c/", "a < b <"), (7, "http://d/", "<script>x<p>y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["text"]) for r in wrappers.extracted(df).collect())
    assert got == [(1, ""), (2, ""), (3, "just text & more"), (4, "deep er"), (5, " ".join(["long text"] * 30_000)), (6, "a < b <"), (6, "a < b <"), (7, "")]
    assert wrappers.extracted(df.limit(0)).count() == 0


def test_query(spark):
    against_sql(spark, "op4_main_text", QUERIES, ORACLE_SQL)
