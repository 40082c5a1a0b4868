"""Main text of HTML pages by gradient-boosted trees over DOM nodes.

Every node gets features of its kind, the names on it and above it, the density of text and links in
its subtree, its depth and its siblings. Boosted trees score it, and the scores are decoded together:
a node is kept only with its parent, and the kept scores sum to the most, so an ancestor and its
descendants never contradict each other.

The model is trained in each run on a bounded sample: at most ``TRAIN_PAGES`` pages of at most
``TRAIN_BYTES`` bytes, drawn by the hash of their key and labelled by their own landmarks (article,
main, nav, ...), and ``LAYOUTS`` layouts made from the sample's paragraphs, in which the same roles are
told by other elements and by names alone; ``LONG`` more have many blocks side by side. Extraction covers every page whole.

Defined results: a null or empty page has no text. Pages of one content have one text. White space is
what ``str.split`` splits at, after references are decoded; a line break element is white space. Attribute
values end at their quotes, whatever they hold; CDATA sections are not shown. Formulas
and the text elements of drawings are text like other, annotations of formulas are not shown. A page
without a kept node has the empty text. Other columns pass through; those named like a result are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import trees
from tidemark.llm import vocab as V
from tidemark.llm import words as W
from tidemark.llm.dom import GROUPS, KIND, Page, decode

TRAIN_PAGES, TRAIN_BYTES, LAYOUTS, LONG = 100, 50_000, 300, 20
#: Bytes of pages whose nodes are scored at once.
AT_ONCE = 1 << 20
_MARK = "\x01"
_NOT_MAIN = sum(1 << k for k, g in enumerate(GROUPS) if g not in ("main", "edge"))
_OUTSIDE = {KIND[t] for t in ("nav", "footer", "aside", "form")}
FILLER = "the of and to in a is that it was for on are with as at be this have from or had by not but some what there we can out".split()


def by_landmarks(page: Page) -> list[int] | None:
    """1 for nodes of the article and those above it, 0 for others; None for a page without one."""
    if not {"article", "main"} & set(page.tags):
        return None
    n, inside, out = len(page.tags), [False] * len(page.tags), [0] * len(page.tags)
    for i in range(1, n):
        p, tag = page.parents[i], page.tags[i]
        apart = page.groups[i] & _NOT_MAIN or KIND.get(tag, -1) in _OUTSIDE
        inside[i] = not apart and (inside[p] or tag in ("article", "main"))
        out[i] = int(inside[i])
    return _upward(page, out)


def _upward(page: Page, labels: list[int]) -> list[int]:
    for i in range(len(labels) - 1, 0, -1):
        if labels[i]:
            labels[page.parents[i]] = 1
    return labels


def by_marks(page: Page) -> list[int]:
    """1 for nodes that hold marked text and those above them."""
    out = [0] * len(page.tags)
    for item in page.flow:
        if item is not None and _MARK in item[1]:
            out[item[0]] = 1
    return _upward(page, out)


def layout(main: list[str], other: list[str], draw: Random, blocks: tuple[int, int] = (1, 9)) -> str:
    """A page that tells the roles of its parts by elements or by names; text to keep is marked.

    ``blocks`` are the least and most paragraphs, for a page that has much to say.
    """
    pick = draw.choice
    if draw.random() < 0.2:  # a page with little to say
        main = [" ".join(pick(main).split()[: draw.randint(1, 4)]) for _ in range(8)]

    def tagged(*opens: str) -> tuple[str, str]:
        start = pick(opens)
        return f"<{start}>", f"</{start.split(' ')[0]}>"

    def wrap(inner: str, *opens: str) -> str:
        a, b = tagged(*opens)
        return a + inner + b

    def links(k: int) -> str:
        return "".join(f'<li><a href="/">{" ".join(pick(other).split()[: draw.randint(1, 4)])}</a></li>' for _ in range(k))

    def some(k: int) -> str:
        return "".join(f"<p>{pick(other)}</p>" for _ in range(k))

    def title() -> str:
        return " ".join(pick(main).split()[:7])

    parts = {
        "menu": lambda: wrap(f"<ul>{links(draw.randint(2, 12))}</ul>", "nav", 'div class="nav"', 'div class="menu"', 'div id="navbar"', 'ul class="breadcrumb"', 'div class="top-navigation"'),
        "header": lambda: wrap(f"<h1>{title()}</h1><p>{pick(other)}</p>", "header", 'div class="header"', 'div id="masthead"', 'div class="banner"'),
        "ad": lambda: wrap(pick((pick(other), some(1))), 'div class="ad"', 'div class="ads"', 'div class="advert"', 'div id="ad-top"', 'aside class="sponsored"', 'div class="promo"'),
        "notice": lambda: wrap(some(1), 'div class="cookie-notice"', 'div id="cookie-consent"', 'div class="gdpr popup"', 'div class="alert notice"', 'div role="alert"'),
        "side": lambda: wrap(pick((f"<ul>{links(4)}</ul>", some(2))), "aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"', 'section class="newsletter"'),
        "form": lambda: wrap(f"<label>{pick(other)}</label><input name=q><button>{pick(FILLER)}</button>", "form", 'form class="search"', 'div class="search-form"', 'div class="login"'),
        "comments": lambda: wrap(f"<h2>{pick(FILLER)}</h2>" + "".join(wrap(f"<p>{pick(main)}</p>", 'div class="comment"', "div", "li") for _ in range(draw.randint(1, 5))), 'section class="comments"', 'div id="comments"', 'ol class="commentlist"', 'div class="discussion"', 'div class="reader-comments"'),
        "footer": lambda: wrap(pick((some(1), pick(other), f"<ul>{links(3)}</ul>")), "footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"'),
    }

    def paragraph() -> str:
        text = _MARK + pick(main)
        kind = draw.random()
        if kind < 0.72:
            return f"<p>{text}</p>"
        if kind < 0.8:
            return f"<p><b>{text}<br>"
        if kind < 0.86:
            return f"<h2>{_MARK}{title()}</h2>"
        if kind < 0.9:
            items = [_MARK + (pick(main) if draw.random() < 0.5 else title()) for _ in range(draw.randint(1, 6))]
            if draw.random() < 0.5:  # a list of links that belongs to the text
                items = [f'<a href="/">{i}</a>' for i in items]
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        if kind < 0.94:
            return f"<blockquote>{text}</blockquote>"
        return wrap(text, "div", "pre", "section", "table><tr><td")

    body = [paragraph() for _ in range(draw.randint(*blocks) if len(main) > 8 else 1)]
    if draw.random() < 0.4:
        body.insert(draw.randint(0, len(body)), parts[pick(("ad", "side", "form", "notice", "menu"))]())
    if draw.random() < 0.25:
        body.append(parts["comments"]())
    heading = f"<h1>{_MARK}{title()}</h1>"
    heading = wrap(heading, "header", 'div class="title"', "div") if draw.random() < 0.25 else heading if draw.random() < 0.8 else ""
    inner = heading + "".join(body)
    inner = wrap(
        inner, "article", "article", "main", "main><article", 'div class="content"', 'div id="main"', 'div class="post"', 'section class="story"',
        'div class="article-body"', 'div class="entry-content"', "div", "section",
    )
    before = [parts[k]() for k in ("header", "menu", "notice", "ad", "form") if draw.random() < 0.5]
    after = [parts[k]() for k in ("side", "ad", "comments", "form", "notice", "footer", "footer") if draw.random() < 0.4]
    draw.shuffle(before)
    if draw.random() < 0.08:  # nothing but the article
        return inner
    return f"<html><head><title>{title()}</title></head><body>{''.join(before)}{inner}{''.join(after)}</body></html>"


def paragraphs(pages: list[Page]) -> tuple[list[str], list[str]]:
    """Texts of the pages' articles and of their other parts; filler where there is none."""
    main: list[str] = []
    other: list[str] = []
    for page in pages:
        labels = by_landmarks(page)
        if labels is None:
            continue
        for item in page.flow:
            if item is not None and item[1] != " ":
                (main if labels[item[0]] else other).append(" ".join(item[1].replace("&", " ").replace("<", " ").split()))
    draw = Random(5)
    made = [" ".join(draw.choice(FILLER) for _ in range(draw.randint(4, 60))).capitalize() + "." for _ in range(200)]
    return [m for m in main if m] + made[:100], [o for o in other if o] + [" ".join(m.split()[:8]) for m in made[100:]]


def train(sources: list[str]) -> trees.Boosted:
    """Trees from a bounded sample of pages."""
    pages = [Page(s) for s in sources]
    rows, labels = [], []
    for page in pages:
        marked = by_landmarks(page)
        if marked is not None:
            rows += page.features()[1:]
            labels += marked[1:]
    main, other = paragraphs(pages)
    for k in range(LAYOUTS + LONG):
        page = Page(layout(main, other, Random(k), (1, 9) if k < LAYOUTS else (65, 150)))
        rows += page.features()[1:]
        labels += by_marks(page)[1:]
    return trees.fit(np.array(rows, np.float64), np.array(labels, np.float64))


def extract_all(sources: list[str], model: trees.Boosted) -> list[str]:
    pages = [Page(s) for s in sources]
    rows = [p.features() for p in pages]
    scores = model.scores(np.array([r for own in rows for r in own], np.float64)).tolist() if rows else []
    out, at = [], 0
    for page, own in zip(pages, rows):
        out.append(page.text(decode(page.parents, scores[at : at + len(own)])))
        at += len(own)
    return out


def sample(df: DataFrame, page: str, source: str) -> list[str]:
    """The training pages: a draw by hash.

    A share of all pages that gives some four times as many as needed is drawn first, so what reaches
    the driver does not grow with the table or its tasks. Rows that repeat count once.
    """
    short = df.where(F.octet_length(F.col(source)).between(1, TRAIN_BYTES))
    share = min(1.0, 4 * TRAIN_PAGES / max(1, short.count()))
    draw = F.xxhash64(F.col(page), F.col(source), F.lit(6))
    drawn = short.select(draw.alias("_draw"), F.col(source).alias("_html"))
    drawn = drawn.where(F.pmod(F.col("_draw"), F.lit(2**32)) <= int(share * 2**32)).distinct()
    return [r[1] for r in drawn.orderBy("_draw", "_html").limit(TRAIN_PAGES).collect()]


def extract(df: DataFrame, page: str = "page_id", source: str = "html", text: str = "text", model: trees.Boosted | None = None) -> DataFrame:
    """Add ``text``, the main text of ``source``; without a ``model`` one is trained on a sample of ``df``."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model or train(sample(df, page, source)))
    kept = df.drop(text) if text != source else df
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str] = []
            group, held = [], 0
            for s in V.texts(batch.column(source)):
                group.append(s)
                held += len(s)
                if held >= AT_ONCE:
                    found += extract_all(group, shared.value)
                    group, held = [], 0
            found += extract_all(group, shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, text])

    W.narrow(spark)
    return kept.mapInArrow(run, schema)
