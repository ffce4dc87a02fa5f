"""URL rules, WARC archives and main texts."""

import gzip
import hashlib
import random

import pytest

from wardlight.llm import html_text, url_rules, warc


def test_rules_against_brute_force(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "a.example.org", ""),
             ("block", "Example.ORG", "/es/x"), ("allow", "example.org", "/es/x"), ("block", "net", None), ("block", None, "/x")]
    urls = [None, "", "no url", "http://", "http://EXAMPLE.org/es/x?q#f", "http://www.example.org/en/123", "http://a.example.org",
            "https://b.a.example.org/es/y", "http://xexample.org/es/", "ftp://x.net", "http://x.net/a/b#c", "http://example.org./es/",
            "a://b://org/", "http://org/", "http://../es/", "http://example.org/es\n/x", "//x.org/", "http://ex\x00mple.org/es/"] * 3
    table = spark.createDataFrame([(k, u, "h", 1) for k, u in enumerate(urls)], "page_id bigint, url string, host string, rule int")

    def expected(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].lower(), rest[cut:]
            path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = {}
        for verdict, h, p in rules:
            if h is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p or ""):
                name = h.lower() + (p or "")
                fits[name] = max(fits.get(name, ""), verdict)
        best = max(fits, key=len, default=None)
        return host, path, best, fits.get(best, "allow")
    for parts in (50_000, 2):
        out = url_rules.judge(table, url_rules.rule_table(spark, rules), paths_per_part=parts).collect()
        assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out) == sorted((k, *expected(u)) for k, u in enumerate(urls))
    assert url_rules.judge(table.limit(0), url_rules.rule_table(spark, rules)).count() == 0
    none = url_rules.judge(table, url_rules.rule_table(spark, []), default="block").collect()
    assert len(none) == len(urls) and all(r.rule is None and r.verdict == "block" for r in none)


def test_archives(spark, tmp_path):
    long = "é" * 60
    rows = [(4, "http://a/ü\n", long, "x"), (2, None, long, "x"), (None, "u", long, "x"), (3, "u", None, "x"), (5, "u", "", "x"), (6, "u", "short", "x"),
            (7, "u", "short", "x"), (2, None, long, "x"), (8, "u", "z" * 300_000, "x")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, content string").repartition(3)
    path = str(tmp_path / "w")
    warc.write_archives(table, path, archive_bytes=500)
    archives = spark.read.parquet(path)
    out = warc.read_records(archives).collect()
    assert sorted((r.page_id or -1, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.digest_ok) for r in out) == sorted(
        (p or -1, u, "revisit" if h == long and p == 4 else "response", 2 if h == long and p == 4 else None, len((h or "").encode()),
         hashlib.sha256((h or "").encode()).hexdigest(), True) for p, u, h, _ in rows)
    for content in archives.collect():
        assert gzip.decompress(bytes(content.content)).count(b"WARC/1.1") >= 1
    empty = str(tmp_path / "e")
    warc.write_archives(table.limit(0), empty)
    assert warc.read_records(spark.read.schema("archive string, content binary").parquet(empty)).count() == 0


def test_damaged_archives():
    whole = warc.record(1, "u", b"body", hashlib.sha256(b"body").hexdigest(), None)
    assert [n for n, _ in warc.Members(whole + whole, chunk=7)] == [0, len(whole)]
    headers, block = warc.parse(next(iter(warc.Members(whole)))[1])
    assert block == b"body" and headers["warc-type"] == "response"
    with pytest.raises(ValueError):
        list(warc.Members(whole[:-3]))
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nbody\r\n\r\n")


PAGE = ('<html><body class="x"><nav><a>menu</a></nav><div id="cookie-notice">cookies</div><header>Site</header>{ad}<article><header><h1>Ti&amp;tle {n}</h1></header>'
        '<p>A <b>b{n}</b>c<p>d<br>e&nbsp;f<ul><li>1<li>2</ul><p>Follow us</p><script>var t="</p>";</script><style>p{{}}</style><!-- <p>no</p> -->'
        '<aside>x</aside><form>f</form><div class="share-buttons">s</div><section class="comments"><article class="comment">no</article></section></article>'
        '<div class="related">r</div><footer>foot</footer></body></html>')


def article(page):
    return [block for block, _ in html_text.article(html_text.parse(page))]


def test_article():
    assert article(PAGE.format(n=1, ad="")) == ["Ti&tle 1", "A b1c", "d e f", "1", "2", "Follow us"]
    assert article("just text <b>here") == ["just text here"]
    assert article("<div>a</div><footer>b</footer><p>c < d</p>") == ["a", "c < d"]
    assert article("<!-- open <p>x") == [] and article("") == []
    assert article("<p title='>'>x</p></div></p><script>y") == ["x"]


def test_alignment():
    own = "page ( html ( body ( nav ( ul ( li ) ) div article ( h1 p ) footer ) ) )"
    reference = "page ( html ( body ( nav ( ul ( li ) ) article ( h1 p ul ( li ) ) footer ) ) )"
    score, slots = html_text.aligned(own, reference)
    assert slots[0] == 0 and slots[7] == 6 and slots[10] == 11 and 6 not in slots and score == 20 / 23
    assert html_text.aligned(own, own) == (1.0, {k: k for k in range(11)})


def plain_match(a, b):
    """Most nodes of two trees (label, children) that match in order under matching parents."""
    if a[0] != b[0]:
        return 0
    table = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + plain_match(x, y))
    return 1 + table[-1][-1]


def test_alignment_against_brute_force():
    rnd = random.Random(1)

    def tree(depth):
        return rnd.choice("pqr"), [tree(depth - 1) for _ in range(rnd.randrange(4))] if depth else []

    def written(t):
        return t[0] + (" ( " + " ".join(map(written, t[1])) + " )" if t[1] else "")

    def size(t):
        return 1 + sum(map(size, t[1]))
    for _ in range(300):
        a, b = ("page", [tree(3) for _ in range(3)]), ("page", [tree(3) for _ in range(3)])
        score, pairs = html_text.aligned(written(a), written(b))
        assert len(pairs) == plain_match(a, b) == round(score * (size(a) + size(b)) / 2)
        assert len(set(pairs.values())) == len(pairs)


def test_sibling_articles_names_and_depth():
    assert article("<article>part one</article><article>part two</article>") == ["part one", "part two"]
    told = "".join(f"<div class='{c}'>{c}</div>" for c in ("promotion-history", "share-of-vote", "table-widget", "share-buttons", "comment-list", "adSlot"))
    assert article(f"<article><p>x</p>{told}<p id=related-posts>y</p></article>") == ["x", "promotion-history", "share-of-vote", "table-widget"]
    deep = "<div>" * 5000 + "inside" + "<p>more"
    root = html_text.parse(deep)
    assert article(deep) == ["inside", "more"]
    outline = html_text.Outline(root).written
    assert html_text.aligned(outline, outline)[0] == 1.0 and html_text.aligned(outline, outline + " ")[0] == 1.0
    assert html_text.aligned(outline, html_text.Outline(html_text.parse(deep + "<ul><li>z")).written)[0] > 0.9


def test_two_layouts_without_telling_names(spark):
    """Boilerplate has no telling names and differs by layout; words of it in another slot stay."""
    def one(k):
        return (f"<body><div>Home</div><div><p>Notice of A</p><h1>Title {k}</h1><p>Text {k} of it</p><p>More {k}</p></div>"
                f"<div><span>Imprint</span></div></body>")

    def two(k):
        return (f"<body><table><tr><td>Start</td><td><h2>Head {k}</h2><blockquote>Quote {k}</blockquote><p>Home</p><p>{k} again</p>"
                f"<p>{k} and again</p></td></tr></table><ul><li>B</li><li>Contact</li></ul><h3>All rights</h3></body>")
    pages = [(k, "http://h.org/", one(k) if k % 5 < 3 else two(k)) for k in range(60)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    out = {r.page_id: r.text for r in html_text.main_text(table).collect()}
    for k in range(60):
        want = [f"Title {k}", f"Text {k} of it", f"More {k}"] if k % 5 < 3 else [f"Head {k}", f"Quote {k}", f"{k} again", f"{k} and again"]
        assert out[k].split("\n\n") == want
    # the template word as a paragraph of one article
    odd = one(7).replace("<p>More 7</p>", "<p>More 7</p><p>Home</p>")
    table = spark.createDataFrame([(k, u, odd if k == 7 else h) for k, u, h in pages], "page_id bigint, url string, html string")
    assert html_text.main_text(table).where("page_id = 7").first().text.split("\n\n") == ["Title 7", "Text 7 of it", "More 7", "Home"]


def test_templates(spark):
    pages = [(k, f"http://h.org/{k}", PAGE.format(n=k, ad="<div>A</div>" * (k % 2)), "t") for k in range(20)]
    pages += [(100 + k, f"http://copies.org/{k}", PAGE.format(n=0, ad=f"<div>{k}</div>"), "t") for k in range(20)]
    pages += [(200, None, None, "t"), (201, "x", "", "t"), (202, "http://h.org/0", PAGE.format(n=0, ad=""), "t")]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")
    out = {r.page_id: r for r in html_text.main_text(table).collect()}
    assert len(out) == 43 and out[200].text == "" and out[201].text == ""
    whole = ["Ti&tle {}", "A b{}c", "d e f", "1", "2", "Follow us"]
    assert out[100].text == "\n\n".join(b.format(0) for b in whole)  # copies of one article are no template
    assert out[3].text == "Ti&tle 3\n\nA b3c"  # what all pages of the host have is template
    assert html_text.main_text(table.limit(0)).count() == 0
