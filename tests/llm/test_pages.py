"""URL filtering and HTML extraction."""

import itertools

import numpy as np
import pytest
from edge_cases import CLASHING

from dayledger.llm import dom, html_extract, url_filter


def pages(spark, rows, extra=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({k: F.lit(v) for k, v in CLASHING.items() if k not in ("path",)}) if extra else df


def link(*hosts):
    return "".join(f'<a class=x href="https://{h}/p?q">t</a>' for h in hosts)


URLS = {
    "https://A.Example.NET/en/x": ("a.example.net", "/en/x", "example.net/en/", "allow"), "http://example.net/de/": ("example.net", "/de/", "net/", "block"),
    "http://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"), "http://net/": ("net", "/", "net/", "block"), "http://x.net": ("x.net", "", None, "allow"),
    "http://example.com/de/1#a": ("example.com", "/de/1", "example.com/de/", "block"), "http://m.example.com/DE/": ("m.example.com", "/DE/", None, "allow"),
    "ftp://wiki.org/fr/?x": ("wiki.org", "/fr/", "org/fr/", "allow"), "http://h?x=://y/": ("h", "", None, "allow"), "//no.scheme/fr/": ("", "", None, "allow"),
    "": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://:80/x": (":80", "/x", None, "allow"), "http://example.net:8080/en/": ("example.net:8080", "/en/", None, "allow"),
}


def test_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(0, next(iter(URLS)), None)]
    got = url_filter.judge(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == list(URLS.values())[r.page_id]
    assert url_filter.judge(pages(spark, [])).collect() == []


def test_distrust_flows_back_and_trust_forward(spark, tmp_path):
    rows = [(1, "http://bad.net/x", link("victim.com")), (2, "http://farm.com/", link("bad.net", "bad.net", "farm2.com")), (3, "http://farm2.com/", link("bad.net")),
            (4, "http://good.org/fr/", link("fine.com", "bad.net")), (5, "http://fine.com/", link("bad.net")), (6, "http://victim.com/", None), (7, "http://lone.com/", link("lone.com"))]
    rows += [(10 + i, f"http://hub{i}.com/", link("big.com")) for i in range(60)] + [(99, "http://big.com/", "<a href='x'>")]
    df = pages(spark, rows, extra=False)
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert [got[i].verdict for i in (2, 3, 5, 6, 7, 99)] == ["block", "block", "allow", "allow", "allow", "allow"]
    import duckdb
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    want = {r[0]: r[4] for r in con.sql(url_filter.sql()).fetchall()}
    assert want == {i: r.verdict for i, r in got.items()}


def test_a_hub_elsewhere_changes_no_verdict_and_chains_have_no_end(spark, tmp_path):
    rows = [(1, "http://bad.net/x", None), (2, "http://one.com/", '<a href="//bad.net/y">t</a>')]
    rows += [(10 + i, f"http://far{i}.com/", link(f"far{i - 1}.com" if i else "one.com")) for i in range(12)]
    hub = [(50, "http://hub.com/", link(*[f"worse{i}.net" for i in range(80)]))] + [(100 + i, f"http://worse{i}.net/", None) for i in range(80)]
    seen = []
    for n, some in enumerate((rows, rows + hub)):
        df = pages(spark, some, extra=False)
        got = {r.page_id: r for r in url_filter.judge(df).collect()}
        seen.append({i: got[i].verdict for i in (1, 2, *range(10, 22))})
        assert got[21].distrust == pytest.approx(0.85 ** 13, abs=url_filter.LEFT)
        import duckdb
        df.coalesce(1).write.parquet(str(tmp_path / f"p{n}"))
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p{n}/*.parquet'")
        assert {r[0]: r[4] for r in con.sql(url_filter.sql()).fetchall()} == {i: r.verdict for i, r in got.items()}
    assert seen[0] == seen[1] == {i: "block" for i in seen[0]}


def test_propagation_is_the_power_iteration(spark):
    rng = np.random.default_rng(2)
    m = (rng.random((8, 8)) < 0.3) * rng.random((8, 8))
    np.fill_diagonal(m, 0)
    part = m / np.maximum(m.sum(axis=1, keepdims=True), 1e-12)
    edges = spark.createDataFrame([(str(i), str(j), float(part[i, j])) for i in range(8) for j in range(8) if part[i, j] > 0], "src string, dst string, part double")
    seeds = spark.createDataFrame([("1", 1.0), ("5", 0.5)], "host string, seed double")
    s = np.zeros(8)
    s[1], s[5] = 1, 0.5
    x = s.copy()
    for _ in range(6):
        x = 0.15 * s + 0.85 * part.T @ x
    got = {r.host: r.score for r in url_filter.propagate(edges, seeds, 6, 0.85).collect()}
    assert all(got.get(str(i), 0.0) == pytest.approx(x[i], abs=1e-12) for i in range(8))


PAGE = """<html><head><title>T &amp; x</title><script>if (a<b) document.write("<p>no</p>")</script><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><div id="cookie-notice"><p>We use cookies, accept them. They are good for you and us.</p></div>
<nav><a href=x>Home</a> <a href=y>News</a></nav><main><article class="post"><header><h1>Title &eacute;&#33;</h1></header>
<p>First <b>para</b>graph,\n with <a href=z>link</a> inside&nbsp;it.</p><!-- <p>gone</p> --><div class="ad">Buy now!</div><p>Second.<br>Line two.<ul><li>item one<li>item two</ul>
<form>Email <input></form></article><section id="comments"><article class="comment"><p>Nice article, I liked it a lot.</p></article></section></main>
<aside>Related things</aside><footer>(c) 2020</footer></body></html>"""
TEXT = "Title é! First paragraph, with link inside it. Second. Line two. item one item two"


@pytest.mark.parametrize("page,text", [
    (PAGE, TEXT), (None, ""), ("", ""), ("   ", ""), ("<nav>only menu</nav>", ""), ("<article>a<p>b<p>c", "a b c"), ("<article><p>x</article", "x"),
    ("<article>1 < 2 &lt; 3 &bogus; <i>i</i>n</article>", "1 < 2 < 3 &bogus; in"), ("<ARTICLE><P>Up</P></ARTICLE><FOOTER>f</FOOTER>", "Up"),
    ("<article><script>var a='</p>';</script><p>kept</p><style>x</style></article>", "kept"), ("<main>" + "<p>w w w.</p>" * 500 + "</main>", " ".join(["w w w."] * 500)),
    ('<div>Sign up now</div><div class="header">Site</div><article><p>body</p></article><div>Powered by us</div>', "body"),
    ('<body><div class="top">a b</div><div id="content"><p>One sentence here.</p></div><div id="footer">f</div></body>', "One sentence here."),
    ('<div class="sidebar"><div class="content"><p>side</p></div></div><article><p>body</p></article>', "body"),
])
def test_main_text(page, text):
    assert html_extract.main_text(page, np.zeros(8)) == text


def test_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article>no id</article>"), (3, "w", "")]
    got = html_extract.extract(pages(spark, rows)).collect()
    assert sorted((str(r.page_id), str(r.url), r.text) for r in got) == sorted([("1", "u", TEXT)] * 2 + [("2", "None", ""), ("None", "v", "no id"), ("3", "w", "")])
    assert html_extract.extract(pages(spark, [])).collect() == []


def test_min_cut_is_minimal():
    rng = np.random.default_rng(4)
    for _ in range(80):
        n = int(rng.integers(1, 8))
        logit = rng.normal(size=n) * 2
        edges = [(k - 1, k, float(rng.random())) for k in range(1, n)] + [(int(a), int(b), float(rng.random())) for a, b in rng.integers(0, n, (4, 2)) if a != b]
        cost = lambda label: sum(max(0, -x) if on else max(0, x) for x, on in zip(logit, label)) + sum(w for a, b, w in edges if label[a] != label[b])
        best = min(cost(label) for label in itertools.product([False, True], repeat=n))
        assert cost(html_extract.min_cut(logit, edges)) == pytest.approx(best, abs=1e-6)


def test_deep_nesting_and_long_pages():
    deep = "<div>" * 3000 + "<article><p>deep</p></article>" + "</div>" * 3000
    assert [b.text for b in dom.blocks(deep)] == ["deep"]
    assert dom.blocks("<p " + 'a="' * 50_000) is not None


PROSE = "The river rose in the night, and by morning the lower fields, as always, were under water. "
TALE = [PROSE + f"Part {k} of the account was written later, by people who had seen it." for k in range(6)]
PAGE_TEXT = " ".join(TALE)


def test_names_are_evidence_not_verdicts():
    import numpy as np
    from dayledger.llm import html_extract
    weights = np.array([-2.0, 0.9, -3.0, 1.0, 1.0, -0.5, 0.0, -0.2])  # long, unlinked, finished sentences
    tale = "".join(f"<p>{t}</p>" for t in TALE)
    nav, foot = '<nav><a href="/">Home</a></nav>', "<footer>Contact</footer>"
    text = lambda page: html_extract.main_text(nav + page + foot, weights)
    assert text(f'<div class="has-sidebar"><div class="post-content">{tale}</div></div>') == PAGE_TEXT
    assert text(f'<div class="page-sidebar"><div class="post-content">{tale}</div></div>') == PAGE_TEXT
    assert text(f'<form id="aspnetForm"><article>{tale}</article></form>') == PAGE_TEXT
    assert text(f'<article><p>Teaser of it.</p></article><div>{tale}</div>').endswith(PAGE_TEXT)
    assert text(f'<article>{tale}<h2 id="related-work">Related work</h2>{tale}</article>') == f"{PAGE_TEXT} Related work {PAGE_TEXT}"
    # What the names are for still goes.
    remarks = "".join(f'<article class="entry"><p>I do not believe that, {t}</p></article>' for t in TALE * 3)
    assert text(f'<article>{tale}</article><div id="comments">{remarks}</div>') == PAGE_TEXT
    assert text(f'<article>{tale}<div class="ad">Buy now.</div></article><div class="sidebar"><p>{PROSE}</p></div>') == PAGE_TEXT
    assert text(f'<article>{tale}</article><form><p>Your mail address, please.</p></form>') == PAGE_TEXT
