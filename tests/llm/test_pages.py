"""URL filter, main text and archives."""

import hashlib
import html
import io
import random
import re
import time
from base64 import b32encode
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import dom, html_text, queries, trees, urls, warc

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/"))


def test_hosts_rules_and_words(spark):
    cases = {
        "http://WWW.Example.ORG/es/x?y#z": ("www.example.org", "/es/x", "example.org/es/", "block"),
        "https://a.example.org/casino": ("a.example.org", "/casino", "org/", "allow"),
        "https://org/": ("org", "/", "org/", "allow"),
        "https://notorg/": ("notorg", "/", None, "allow"),
        "https://x.com/FR/": ("x.com", "/FR/", None, "allow"),
        "https://x.com/fr/free-bets": ("x.com", "/fr/free-bets", "com/fr/", "allow"),
        "https://x.com/free-bets": ("x.com", "/free-bets", None, "block"),
        "https://x.com/free-free": ("x.com", "/free-free", None, "allow"),
        "https://x.com/freebets/cheapest": ("x.com", "/freebets/cheapest", None, "allow"),
        "https://casino-win.net": ("casino-win.net", "", None, "block"),
        "https://casinos.net?é": ("casinos.net", "", None, "allow"),
        "https://écasino.net": ("écasino.net", "", None, "allow"),
        "ftp://h?p=://q/": ("h", "", None, "allow"),
        "no scheme/casino": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://a\nb.org/\n/x": ("a\nb.org", "/\n/x", "org/", "allow"),
        "http://h.com/" + "a" * 100_000: ("h.com", "/" + "a" * 100_000, None, "allow"),
    }
    rows = [(i, u, "clash") for i, u in enumerate(cases)] + [(0, next(iter(cases)), "clash")]
    got = urls.judge(spark.createDataFrame(rows, "page_id int, url string, host string"), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.url], r.url
    assert urls.judge(spark.createDataFrame([], "page_id int, url string"), RULES).count() == 0


@pytest.fixture(scope="module")
def pages(sf):
    return pq.read_table(f"{sf}/pages.parquet").to_pylist()


@pytest.fixture(scope="module")
def model(pages):
    return html_text.train([p["html"] for p in pages[: html_text.TRAIN_PAGES]])


def article(source):
    inner = source[source.index("<article>") :].split("</article>")[0]
    blocks = re.split(r"</?(?:p|h1|article)[^>]*>", inner)
    plain = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
    return "\n".join(b for b in plain if b)


def test_articles_come_out_whole(pages, model):
    got = html_text.extract_all([p["html"] for p in pages], model)
    assert [g for g in got] == [article(p["html"]) for p in pages]


def test_held_out_layouts(pages, model):
    main, other = html_text.paragraphs([dom.Page(p["html"]) for p in pages[html_text.TRAIN_PAGES :]])
    right = total = 0
    for k in range(5000, 5200):
        page = dom.Page(html_text.layout(main, other, random.Random(k)))
        kept = dom.decode(page.parents, model.scores(np.array(page.features())).tolist())
        right += sum(a == bool(b) for a, b in zip(kept[1:], html_text.by_marks(page)[1:]))
        total += len(kept) - 1
    assert right / total > 0.97


def test_places_among_many_siblings(model):
    page = dom.Page("<article>" + "".join(f"<p>Paragraph {i} says something.</p>" for i in range(200)) + "</article>")
    at = page.tags.index("article")
    places = [row[-5] for row, parent in zip(page.features(), page.parents) if parent == at]
    assert places == [i / 200 for i in range(200)]


def test_long_layouts(pages, model):
    main, other = html_text.paragraphs([dom.Page(p["html"]) for p in pages[html_text.TRAIN_PAGES :]])
    right = total = 0
    for k in range(6000, 6040):
        page = dom.Page(html_text.layout(main, other, random.Random(k), (65, 150)))
        kept = dom.decode(page.parents, model.scores(np.array(page.features())).tolist())
        right += sum(a == bool(b) for a, b in zip(kept[1:], html_text.by_marks(page)[1:]))
        total += len(kept) - 1
    assert right / total > 0.97


def test_formulas_and_drawings_keep_their_text(model):
    formula = '<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation encoding="tex">E=m</annotation></semantics></math>'
    drawing = (
        '<svg viewBox="0 0 1 1"><title>t</title><style>p{}</style><defs><text>no</text></defs><desc>no</desc><path d="M0"/><mask id="m"/>'
        "no<g><text x=1>North</text><text><tspan>South</tspan></text></g></svg>"
    )
    body = f"<p>The energy is {formula} for a body at rest, as this sentence says.</p><p>The map shows {drawing}and what lies between them.</p>"
    hidden = "<noscript><svg><text>no</text></svg></noscript><template><math>no</math><svg><text>no</text></svg></template>"
    want = "The energy is E=m for a body at rest, as this sentence says.\nThe map shows North South and what lies between them."
    assert html_text.extract_all([f"<html><body><article>{body}{hidden}</article></body></html>"], model) == [want]


def test_boilerplate_by_names(model):
    body = "<p>The first paragraph says something, and more.</p><p>A second one &amp; its end&nbsp;here.<br>New line</p>"
    for start, end in (("<article>", "</article>"), ('<div class="post-content">', "</div>"), ("<main>", "</main>")):
        source = (
            '<html><head><title>t</title><script>var a="<p>no</p>";</script><style>p{}</style></head><body><nav><a href=/>Home</a></nav>'
            f'<header><p>Site</p></header>{start}<h1>Title of the page</h1>{body}<div class="advert"><p>Buy now</p></div><form><label>Name</label></form>{end}'
            '<aside><p>Related things</p></aside><div class="cookie-notice"><p>We use cookies</p></div>'
            '<section class="comments"><h2>Comments</h2><div class="comment"><p>I liked it a lot, thank you.</p></div></section><footer><p>Copyright</p></footer></body></html>'
        )
        want = "Title of the page\nThe first paragraph says something, and more.\nA second one & its end here. New line"
        assert html_text.extract_all([source], model) == [want]


def test_kept_nodes_hang_together():
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randint(1, 9)
        parents = [-1] + [draw.randrange(i) for i in range(1, n)]
        scores = [draw.uniform(-2, 2) for _ in range(n)]
        kept = dom.decode(parents, scores)
        best = max(
            sum(scores[i] for i in range(1, n) if bits >> i & 1)
            for bits in range(1, 1 << n, 2)
            if all(not bits >> i & 1 or bits >> parents[i] & 1 for i in range(1, n))
        )
        assert all(not kept[i] or kept[parents[i]] for i in range(1, n))
        assert sum(scores[i] for i in range(1, n) if kept[i]) == pytest.approx(best)


def test_trees_learn_and_split():
    draw = np.random.default_rng(2)
    x = draw.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = trees.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0) == y[3000:]).mean() > 0.97


def test_odd_pages(spark, model):
    odd = [None, "", "no markup", "<", "<p", "<p>a < b & c > d</p", "<!-- open", "<script>open", "<div " + "x=\"" * 2000, "</p></div>" * 1000, "<div>" * 3000 + "deep"]
    odd += ["<article><p>" + "long words " * 50_000 + "</p></article>"]
    rows = [(i, s, "clash") for i, s in enumerate(odd)] + [(1, "", "clash")]
    df = spark.createDataFrame(rows, "page_id int, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(df, model=model).collect()}
    assert got[0] == got[1] == got[6] == got[7] == "" and got[11] == " ".join(["long words"] * 50_000)
    empty = spark.createDataFrame([], "page_id int, html string")
    assert html_text.extract(empty).count() == 0


def digest(data):
    return b32encode(hashlib.sha1(data).digest()).decode()


def test_archives_read_back(spark, tmp_path):
    big = "é" * 700_000 + "\r\n\r\nWARC/1.1\r\n" * 3
    texts = ["<p>a</p>", "<p>a</p>", None, "", "b\r\n\r\nc", big, big, "<p>a</p>", "x"]
    rows = [(10 + i, f"http://h/{i} \n\x7f", t, "clash") for i, t in enumerate(texts)] + [(None, None, "<p>a</p>", "clash"), (None, None, "lone", "clash"), (18, "u", "x", "clash")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, digest string").repartition(3)
    path = f"file://{tmp_path}/archives"
    warc.write(df, path)
    table = warc.read(spark, path, size=100_000)
    parts = table.collect()
    own = {}
    for r in sorted(parts, key=lambda r: (r.archive, r.offset, r.chunk_no)):
        own.setdefault((r.archive, r.offset), []).append(r)
    assert all([r.chunk_no for r in rs] == list(range(len(rs))) and [r.last for r in rs] == [False] * (len(rs) - 1) + [True] for rs in own.values())
    assert max(len(r.data) for r in parts) == 100_000
    payloads = Counter(b"".join(r.data for r in rs).decode() for rs in own.values() if rs[0].record_type == "response")
    assert payloads == Counter(["<p>a</p>", "", "b\r\n\r\nc", big, "x", "x", "lone"])
    got = Counter((r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.records(table).collect())
    least, want = {}, Counter()
    for i, _, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, _, t, _ in rows:
        data, first = (t or "").encode(), least.get(t or "")
        revisit = first is not None and i != first
        want[("none" if i is None else str(i), "revisit" if revisit else "response", str(first) if revisit else None, len(data), digest(data))] += 1
    assert got == want
    assert all(" " not in r.url and "\n" not in r.url for r in parts)


def test_very_long_urls_read_back(spark, tmp_path):
    urls_ = ["http://h/" + "a" * (2 << 20), "http://h/" + "é" * (1 << 20), "http://h/" + "b" * (1 << 20), "http://h/"]
    df = spark.createDataFrame([(i, u, f"<p>{i // 2}</p>") for i, u in enumerate(urls_)], "page_id int, url string, html string")
    warc.write(df.coalesce(1), f"file://{tmp_path}/a")
    got = {r.record_id: (r.url, r.payload_bytes) for r in warc.records(warc.read(spark, f"file://{tmp_path}/a")).collect()}
    assert got == {str(i): (u, 8) for i, u in enumerate(urls_)}


def test_headers_without_end_are_refused():
    class Endless(io.RawIOBase):
        def __init__(self, start, block):
            self.start, self.block, self.given = start, block, 0

        def read(self, n=-1):
            out, self.start = self.start or self.block, b""
            self.given += len(out)
            assert self.given < 8 * warc.HEADER
            return out

    long = b"WARC/1.1\r\nWARC-Target-URI: " + b"u" * (2 << 20)
    for start, block in ((b"WARC/1.1\r\n", b"x" * 65_536), (b"WARC/1.1\r\n", b"A: b\r\n" * 8192), (long, b"\r\nA: b" * 8192)):
        with pytest.raises(ValueError):
            list(warc.chunks("a", Endless(start, block), 65_536, True))


def test_the_query_reads_chunks_with_their_bytes(spark, sf, monkeypatch):
    read, tables = warc.records, []
    monkeypatch.setattr(warc, "records", lambda table: tables.append(table) or read(table))
    found = {str(r.page_id): (r.payload_bytes, r.payload_digest) for r in queries.QUERIES["op7_warc_archives"](spark, sf).collect()}
    data = {}
    for r in tables[0].where("record_type = 'response'").orderBy("chunk_no").collect():
        data[r.record_id] = data.get(r.record_id, b"") + r.data
    assert data and all(found[i] == (len(d), digest(d)) for i, d in data.items())


def test_small_payloads_are_never_revisits(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id int, url string, html string")
    warc.write(df, f"file://{tmp_path}/a", least=3, compression="none")
    plain = b"".join(p.read_bytes() for p in sorted((tmp_path / "a").glob("part-*.txt")))
    assert plain.count(b"WARC/1.1\r\n") == 4 and plain.endswith(b"\r\n\r\n")
    got = {r.record_id: r.record_type for r in warc.records(warc.read(spark, f"file://{tmp_path}/a")).collect()}
    assert got == {"1": "response", "2": "response", "3": "response", "4": "revisit"}
    warc.write(df.limit(0), f"file://{tmp_path}/b")
    assert warc.read(spark, f"file://{tmp_path}/b").count() == 0


def test_reader_is_strict_and_bounded():
    body = b"HTTP/1.1 200 OK\r\n\r\n" + b"z" * 300_000
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n"
    good = head % (digest(b"z" * 300_000).encode(), len(body)) + body + b"\r\n\r\n"

    class Reads(io.BytesIO):
        most = 0

        def read(self, n=-1):
            Reads.most = max(Reads.most, n)
            return super().read(n)

    rows = list(warc.chunks("a", Reads(good * 2), 65_536, True))
    assert Reads.most == warc.READ and [r[6] for r in rows] == [0, 1, 2, 3, 4] * 2 and rows[-1][9] == 300_000
    for bad in (good[:-50], good.replace(b"z\r\n", b"y\r\n"), good[:-4] + b"oops", b"nonsense\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.chunks("a", io.BytesIO(bad), 65_536, True))


@pytest.mark.parametrize(
    "inner, want",
    [
        ('<p title="a < b">Third of the paragraphs here.</p>', "Third of the paragraphs here."),
        ('<p><img data-caption="<b>caption</b> text" src=x>Words after a picture.</p>', "Words after a picture."),
        ("<p data-x='1 > 0 \" <i>'>Quoted > marks.</p>", "Quoted > marks."),
        ("<p>Before <![CDATA[ a > b <p> ]]>and after it.</p>", "Before and after it."),
        ('<p class=a" id=b>A stray quote in a tag.</p><p>Next "one".</p>', 'A stray quote in a tag.\nNext "one".'),
        ("<p>Less < than and <b>bold</b>.</p>", "Less < than and bold."),
        ('<p a="unclosed>Lost and found.</p>', "Lost and found."),
    ],
)
def test_attribute_values_and_sections(model, inner, want):
    page = dom.Page(f"<article>{inner}</article>")
    assert page.text([True] * len(page.tags)) == want


def test_small_articles_and_lists_of_links(model):
    some = "A paragraph of the article that says what it is about, in more than a few words."
    links = "".join(f'<li><a href="/{k}">Chapter {k} of the story</a></li>' for k in range(6))
    pages = ["<article><p>Hi</p></article>", f"<html><body><article><h1>Contents of it</h1><p>{some}</p><ul>{links}</ul><p>{some}</p></article></body></html>"]
    short, listed = html_text.extract_all(pages, model)
    assert short == "Hi"
    assert listed.split("\n") == ["Contents of it", some, *[f"Chapter {k} of the story" for k in range(6)], some]


def test_unclosed_elements_take_linear_time():
    began = time.process_time()
    for page in ("<b>word <div>x</div>" * 50_000, "<ul><li><ul>" + "<b>word</li>" * 80_000, "<head><i>" + "<i><body>" * 100_000, "<p " * 300_000, '<p a="' * 150_000):
        dom.Page(page)
    assert time.process_time() - began < 20


def test_query_equals_articles(spark, sf, pages):
    """The registered query on every page whose article is known."""
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.op6(spark, sf).collect()}
    source = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert got.keys() == source.keys()
    right = known = 0
    for i, (url, text, n) in got.items():
        assert url == source[i][0] and n == len(text)
        page = dom.Page(source[i][1] or "")
        labels = html_text.by_landmarks(page)
        if labels is not None:
            known += 1
            right += text == page.text([bool(x) or k == 0 for k, x in enumerate(labels)])
    assert known and right >= 0.97 * known
