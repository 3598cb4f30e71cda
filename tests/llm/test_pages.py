"""Web pages: main text and archives."""

import base64
import hashlib
import html as entities
import io
import re
from collections import Counter

import pytest

from loomwork.llm import warc
from loomwork.llm.html import Style, extract, main_text, noisy_paths, parse

PAGES = "page_id bigint, url string, html string, text string, host string, n_chars string, payload string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PAGES).repartition(3)


def text_of(html):
    return main_text(parse(html)[0], set())


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a<p>b<br>c</p>d", "a\nb c\nd"),
        ("<p><b>bold<br><p>next</p><p>a<i>b</i>c</p>", "bold\nnext\nabc"),
        ("<nav>menu</nav><article><h1>T &amp; U&nbsp;V</h1><p>x &lt; y &#65;&am</p></article><footer>f</footer>", "T & U V\nx < y A&am"),
        ("<article><p>kept</p><div class='comments'><p>reader</p></div></article>", "kept"),
        ("<main><header>top</header><article><header><h1>title</h1></header>body</article></main>", "title\nbody"),
        ("<script>var t='</p>';if(a<b)x()</script><style>p{}</style><p>only</p><script>", "only"),
        ("<p>one<!-- two --> three <![CDATA[x]]></p><div id='cookie-notice'>we</div>", "one three"),
        ("<table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul>", "a\nb\nc\nd\ne"),
        ("<div role=navigation>n</div><form><label>l</label><input></form><aside>s</aside><p hidden>h</p><p>t</p>", "t"),
        ("<p class=\"lead\">1 < 2 and <3</p></div></article><p", "1 < 2 and <3"),
        ("<div class='adventure'>kept</div><div class='ad'>gone</div>", "kept"),
        ("<article><p>a</p></article><article class='comment'><p>c</p></article>", "a"),
        ("<a" + " x='" * 5000, ""),
        ("<p>a<svg/> b</p><p>c</p>", "a b\nc"),
        ("<p>a <select> b</p><p>c <svg>d</p>", "a b\nc d"),
        ("<p>so <math><mi>x</mi><annotation>\\x</annotation></math> holds</p>", "so x holds"),
        ("<article><p>long enough</p><p class='banner-year'>b</p><h2 class='promotion-history'>h</h2><p class='ad'>x</p></article>", "long enough\nb\nh"),
    ],
)
def test_main_text_of_one_page(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<nav><a>menu</a></nav><article class='post comments-open'><p>the text</p></article>", "the text"),
        ("<div class='layout no-sidebar'><nav><a>m</a></nav><p>the text</p><div class=ad>gone</div></div>", "the text"),
        ("<div class='layout no-sidebar'><p>all of the long text</p><div class=ad>gone</div></div>", "all of the long text"),
        ("<form><nav><a>m</a></nav><div class='no-sidebar'><p>the text</p></div></form>", "the text"),
        ("<main><h1>head</h1><p>paragraph one</p><p>two</p><article>teaser</article></main>", "head\nparagraph one\ntwo\nteaser"),
        ("<div class='entry-title'>title</div><div><p>the whole body</p></div>", "title\nthe whole body"),
        ("<article><p>short</p></article><footer>" + "legal " * 15 + "</footer>", "short"),
        ("<p>text</p><nav>" + "<a>a link</a> " * 50 + "</nav>", "text"),
    ],
)
def test_hints_never_drop_most_of_a_page(html, text):
    assert text_of(html) == text


def test_pages_of_the_test_data(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    found = {r["page_id"]: r for r in extract(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        text = _article(r["html"])
        assert (found[r["page_id"]]["text"], found[r["page_id"]]["n_chars"]) == (text, len(text))


def _article(html):
    body = html[html.index("<article>") : html.index("</article>")].replace("<br>", " ")
    parts = [
        " ".join(entities.unescape(re.sub(r"<[^>]+>", "", part)).split())
        for part in re.split(r"</?(?:p|h1|article)>", body)
    ]
    return "\n".join(p for p in parts if p)


def test_style_tree_alone_finds_articles(spark, data):
    """Without any hint by name the tree cuts menus, adverts and footers that
    differ from page to page."""
    pages = spark.read.parquet(f"{data}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in extract(pages, Style(names=False)).collect()}
    rows = pages.collect()
    assert all(set(_article(r["html"]).split("\n")) <= set(found[r["page_id"]].split("\n")) for r in rows)
    hosts = [(r["html"], found[r["page_id"]], r["url"].split("/")[2].lower()) for r in rows if r["url"]]
    many = Counter(host for _, _, host in hosts)
    judged = [text == _article(page) for page, text, host in hosts if many[host] >= 15]
    assert judged and sum(judged) >= 0.98 * len(judged), (sum(judged), len(judged))


def test_branches_behind_the_main_one(spark):
    """Adverts with other words on every page go; headings and pages of another layout stay."""
    rows = []
    for k in range(30):
        body = "".join(f"<p>{k} long own text number {j} of page {k}, which goes on for more than twelve words</p>" for j in range(1 + k % 5))
        rows.append((k, "http://a.example/", f"<div class=q1>buy {k}</div><div class=q2><h1>title {k}</h1></div><div class=q3>{body}</div>"))
    rows.append((99, "http://a.example/", "<div class=q1>only this</div>"))
    found = {r["page_id"]: r["text"] for r in extract(frame(spark, rows)).collect()}
    assert found.pop(99) == "only this"
    assert found == {
        k: "\n".join([f"title {k}", *[f"{k} long own text number {j} of page {k}, which goes on for more than twelve words" for j in range(1 + k % 5)]])
        for k in range(30)
    }


def _site(n):
    """Pages without any stated role: a shared line, a slogan from a few, own text."""
    rows = []
    for k in range(n):
        shared = "<div class='x1'><span>Our site since 1990</span></div>"
        slogan = f"<div class='x2'>slogan {k % 2}</div>"
        body = "".join(f"<p>own {k} {j} text</p>" for j in range(1 + k % 4))
        rows.append((k, f"https://User@One.Example:8080/{k}", f"<body>{shared}{slogan}<div class='x3'>{body}</div></body>"))
    return rows


def test_style_tree_cuts_what_a_site_repeats(spark):
    rows = _site(40)
    found = {r["page_id"]: r["text"] for r in extract(frame(spark, rows)).collect()}
    assert found == {k: "\n".join(f"own {k} {j} text" for j in range(1 + k % 4)) for k in range(40)}
    # Too few pages tell nothing.
    few = {r["page_id"]: r["text"] for r in extract(frame(spark, rows[:4]), Style(least_pages=8)).collect()}
    assert all(t.startswith("Our site since 1990") for t in few.values())
    assert noisy_paths(frame(spark, rows)).first()["host"] == "one.example"


def test_style_tree_keeps_marked_articles_and_sites_of_copies(spark):
    marked = [(k, "http://a.example/", "<article><p>same everywhere</p></article>") for k in range(20)]
    plain = [(100 + k, "http://b.example/", "<div>same everywhere</div>") for k in range(20)]
    found = extract(frame(spark, marked + plain)).collect()
    assert len(found) == 40 and {r["text"] for r in found} == {"same everywhere"}


@pytest.mark.parametrize("n", [2, 3, 7])
def test_style_tree_judges_small_sites(spark, n):
    rows = [(k, u, h.replace(f"slogan {k % 2}", "slogan")) for k, u, h in _site(n)]
    found = {r["page_id"]: r["text"] for r in extract(frame(spark, rows)).collect()}
    assert found == {k: "\n".join(f"own {k} {j} text" for j in range(1 + k % 4)) for k in range(n)}


@pytest.mark.parametrize("tag", ["main", "article", "div class='content'"])
def test_style_tree_cuts_inside_marked_parts(spark, tag):
    end = tag.split()[0]
    rows = [(k, u, h.replace("<body>", f"<body><{tag}>").replace("</body>", f"</{end}></body>")) for k, u, h in _site(40)]
    found = {r["page_id"]: r["text"] for r in extract(frame(spark, rows)).collect()}
    assert found == {k: "\n".join(f"own {k} {j} text" for j in range(1 + k % 4)) for k in range(40)}


def test_extract_awkward_rows(spark):
    rows = [(1, None, None), (None, "not a url", "<p>a</p>"), (2, "http://x.example", ""), (2, "http://x.example", ""), (3, None, "<p>" + "w " * 100_000)]
    found = extract(frame(spark, rows)).collect()
    shown = sorted(((r["page_id"], r["text"][:3], r["n_chars"]) for r in found), key=str)
    assert shown == sorted([(1, "", 0), (None, "a", 1), (2, "", 0), (2, "", 0), (3, "w w", 199_999)], key=str)
    assert extract(frame(spark, [])).collect() == []


ODD = [
    (1, "http://a/1\r\nEvil: x", "<p>one</p>"),
    (2, None, None),
    (3, "http://a/3", ""),
    (4, "http://a/4", "<p>one</p>"),
    (4, "http://a/4", "<p>one</p>"),
    (None, "http://a/n", "<p>one</p>"),
    (None, None, "alone"),
    (5, "http://a/5", "\r\n\r\nWARC/1.1\r\n\r\n" * 50),
    (6, "http://a/6", "é" * 70_000),
    (7, "http://a/7", "y" * 300_000),
    (-8, "http://a/8", "z"),
]


def expected_records(rows, least):
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        ids = [i for i in groups[data] if i is not None]
        first = max(ids) if ids and len(groups[data]) > 1 and len(data) >= least else None
        refers = first if first is not None and page_id != first else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "response" if refers is None else "revisit", refers, True))
    return sorted(out, key=str)


@pytest.mark.parametrize("least, archive_bytes", [(0, 1 << 26), (5, 1)])
def test_archives_read_back(spark, least, archive_bytes):
    archives = warc.write_archives(frame(spark, ODD), least_bytes=least, archive_bytes=archive_bytes)
    found = [tuple(r) for r in warc.record_table(warc.chunk_table(archives, chunk_bytes=1000)).collect()]
    assert sorted(found, key=str) == expected_records(ODD, least)


def test_chunks_rebuild_payloads(spark):
    archives = warc.write_archives(frame(spark, ODD))
    rows = warc.chunk_table(archives, chunk_bytes=4096).collect()
    payloads = {}
    for r in sorted(rows, key=lambda r: (r["record_id"], r["chunk_no"])):
        assert len(r["data"]) <= 4096
        if r["record_type"] == "response" and r["record_id"] in ("urn:page:5", "urn:page:6", "urn:page:7"):
            payloads[r["record_id"]] = payloads.get(r["record_id"], b"") + bytes(r["data"])
            digest = base64.b32encode(hashlib.sha1(payloads[r["record_id"]]).digest()).decode()
            assert (r["bytes_so_far"], r["digest_so_far"]) == (len(payloads[r["record_id"]]), digest)
    assert payloads == {f"urn:page:{i}": h.encode() for i, _, h in ODD if i in (5, 6, 7)}
    assert warc.chunk_table(warc.write_archives(frame(spark, []))).collect() == []


def test_damaged_archives_are_reported(spark):
    archives = warc.write_archives(frame(spark, [(7, None, "y" * 10_000)]))
    path = archives.first()["archive"].removeprefix("file:")
    data = open(path, "rb").read()
    for cut in (len(data) // 2, len(data) - 3):
        with pytest.raises(ValueError):
            list(warc.read_chunks(io.BytesIO(data[:cut]), "cut"))
    assert len(list(warc.read_chunks(io.BytesIO(data), "whole"))) == 1
    # Archives that are not packed read alike.
    import gzip

    assert [r["last"] for r in warc.read_chunks(io.BytesIO(gzip.decompress(data)), "plain", 6000)] == [False, True]
