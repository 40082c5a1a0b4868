"""HTML pages as flat trees: the nodes that can hold text, their features, and the text in page order."""

from __future__ import annotations

import html
import re
from functools import lru_cache
from math import log1p

#: Elements that make a block of their own, that have no end tag, whose content is not shown.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head iframe noscript object script select style template textarea title video audio canvas annotation annotation-xml".split())
#: Drawings show the text of these, unless they stand in the others.
DRAWN, UNDRAWN = frozenset("text foreignobject".split()), frozenset("defs symbol clippath mask pattern marker metadata desc".split())
#: Whether text is shown: yes, only that of DRAWN, no.
SHOWN, DRAWING, NEVER = 0, 1, 2
RAW = frozenset("script style title textarea noscript iframe".split())
#: An end tag of a text element doesn't reach past these.
BARRIER = frozenset("article aside body div footer form header html main nav section table td th ul ol".split())
#: Start tags that end an open element of the same kind.
SELF_ENDING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

KINDS = (
    ("p",), ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"), ("ul", "ol", "li", "dl", "dt", "dd", "menu", "dir"),
    ("table", "tbody", "thead", "tfoot", "tr", "td", "th"), ("article", "main"), ("nav",), ("header",), ("footer",), ("aside",),
    ("form", "fieldset", "option", "optgroup", "button", "label"), ("blockquote", "pre", "figure", "figcaption"), ("#text",), ("body", "html"),
)
KIND = {tag: k for k, tags in enumerate(KINDS) for tag in tags}
N_KINDS = len(KINDS) + 1

#: Words in class, id and role names, by what they tell.
TOKENS = {
    "main": "article articlebody content main maincontent post story entry body text prose blogpost news",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs topbar sitemap toolbar skip",
    "edge": "header masthead footer foot copyright legal colophon banner logo imprint contentinfo",
    "side": "sidebar aside side rail widget related recommended recommendation trending popular teaser newsletter subscribe subscription "
    "signup social share sharing follow tags complementary archive links",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored adsense adslot promo promoted promotion outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notification popup modal overlay alert disclaimer privacy paywall",
    "form": "form search login register contact poll survey captcha",
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback review reviews reader readers forum",
}
GROUPS = tuple(TOKENS)
_GROUP = {word: 1 << k for k, words in enumerate(TOKENS.values()) for word in words.split()}
_MAIN, _COMMENT, _AD = 1, 1 << GROUPS.index("comment"), 1 << GROUPS.index("ad")

# A quoted value ends at its quote, whatever it holds; outside of values a "<" begins the next tag.
_TAG = re.compile(
    r"""<(?:!--|!\[CDATA\[|(?P<end>/?)(?P<name>[a-zA-Z][^\s/><]*)(?P<attrs>(?:[^>"'<=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>|[!?][^>]*>|[a-zA-Z/!?][^<>]*\Z)"""
)
#: What ends the sections that are no elements.
SECTIONS = {"<!--": "-->", "<![CDATA[": "]]>"}
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(maxsize=4096)
def token_groups(attrs: str) -> int:
    """Groups of the words in class, id and role names as bits."""
    bits = 0
    for value in _NAMES.findall(attrs):
        for word in _WORD.findall("".join(value)):
            bits |= _GROUP.get(word.lower(), 0)
    return bits


class Page:
    """Nodes in page order with parent, tag and token groups; ``flow`` has the text, None ends a block."""

    def __init__(self, source: str):
        self.tags, self.parents, self.groups, self.kids = ["html"], [-1], [0], [[]]
        self.places = [0]
        self.flow: list[tuple[int, str, bool] | None] = []
        self.blocks = [False]
        self._parse(source)
        self._own_runs()

    def _node(self, tag: str, parent: int, groups: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.groups.append(groups)
        self.kids.append([])
        self.places.append(len(self.kids[parent]))
        self.blocks.append(False)
        n = len(self.tags) - 1
        self.kids[parent].append(n)
        return n

    def _parse(self, source: str) -> None:
        self._stack: list[tuple[str, int, int]] = []  # tag, node, hidden
        #: Where the open elements of a name, and all barriers, stand on the stack.
        self._open_at: dict[str, list[int]] = {}
        self._barriers: list[int] = []
        self._links = 0
        self._push("html", 0, SHOWN)
        stack, at, flow = self._stack, 0, self.flow
        search = _TAG.search
        while True:
            m = search(source, at)
            text = source[at : m.start() if m else len(source)]
            if text and not text.isspace() and not stack[-1][2]:
                flow.append((stack[-1][1], html.unescape(text) if "&" in text else text, self._links > 0))
            elif text and not stack[-1][2]:
                flow.append((stack[-1][1], " ", self._links > 0))
            if not m:
                return
            at = m.end()
            name = m["name"]
            if name is None:
                if m.group() in SECTIONS:
                    closing = SECTIONS[m.group()]
                    end = source.find(closing, at)
                    at = len(source) if end < 0 else end + 3
                continue
            name = name.lower()
            if m["end"]:
                self._close(name)
                continue
            self._open(name, m["attrs"])
            if name in RAW:
                end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)

    def _push(self, name: str, node: int, hidden: int) -> None:
        at = len(self._stack)
        self._open_at.setdefault(name, []).append(at)
        if name in BARRIER:
            self._barriers.append(at)
        self._stack.append((name, node, hidden))
        self._links += name == "a"

    def _open(self, name: str, attrs: str) -> None:
        stack = self._stack
        if name in RAW:
            return
        if name in VOID:
            self.flow.append(None if name == "hr" else (stack[-1][1], " ", self._links > 0))
            return
        if name in ("html", "body"):
            groups = token_groups(attrs) if attrs else 0
            self.groups[0] |= groups & _MAIN
            if self._open_at.get("head"):
                self._pop(self._open_at["head"][0], silent=True)
            return
        if name in BLOCKS:
            self._end(("p",))
            if name in SELF_ENDING:
                self._end(SELF_ENDING[name])
            if stack[-1][0] == "head":
                self._pop(len(stack) - 1, silent=True)
            self.flow.append(None)
        groups = token_groups(attrs) if attrs and "=" in attrs else 0
        node, hidden = stack[-1][1], stack[-1][2]
        if hidden == DRAWING:
            if attrs.endswith("/"):
                return
            hidden = NEVER if name in UNDRAWN or name in HIDDEN else SHOWN if name in DRAWN else DRAWING
            if hidden == SHOWN:
                self.flow.append((node, " ", self._links > 0))
        elif name in HIDDEN:
            hidden = NEVER
        elif name == "svg":
            hidden = max(hidden, DRAWING)
        if not hidden and (name in BLOCKS or groups):
            if name in BLOCKS:
                self.blocks[node] = True
            node = self._node(name, node, groups)
        self._push(name, node, hidden)

    def _end(self, names: tuple[str, ...]) -> None:
        """Ends the nearest open element of ``names`` that no barrier hides; looked up, not searched for."""
        at = max((held[-1] for n in names if (held := self._open_at.get(n))), default=0)
        if at > 0 and at >= (self._barriers[-1] if self._barriers else 0):
            self._pop(at)

    def _pop(self, k: int, silent: bool = False) -> None:
        stack = self._stack
        for tag, node, hidden in stack[k:]:
            self._links -= tag == "a"
            if silent:
                continue
            if tag in DRAWN and hidden == SHOWN:
                self.flow.append((node, " ", self._links > 0))
            if tag in BLOCKS and (not self.flow or self.flow[-1] is not None):
                self.flow.append(None)
        for tag, _, _ in reversed(stack[k:]):
            self._open_at[tag].pop()
            if tag in BARRIER:
                self._barriers.pop()
        del stack[k:]

    def _close(self, name: str) -> None:
        if name in ("html", "body") or name in VOID:
            return
        if name not in BARRIER:
            self._end((name,))
        elif self._open_at.get(name):
            self._pop(self._open_at[name][-1])

    def _own_runs(self) -> None:
        """Text that stands beside blocks in its element becomes a node of its own."""
        run: dict[int, int] = {}
        for i, item in enumerate(self.flow):
            if item is None:
                run.clear()
            elif self.blocks[item[0]] and item[1] != " ":
                owner = item[0]
                if owner not in run:
                    run[owner] = self._node("#text", owner, 0)
                self.flow[i] = (run[owner], item[1], item[2])

    def features(self) -> list[list[float]]:
        """One row a node: kind, names and those above, text density, links, depth and siblings."""
        n = len(self.tags)
        chars, linked, ends, words, parts = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        for item in self.flow:
            if item is not None and item[1] != " ":
                node, text, link = item
                size = len(text)
                chars[node] += size
                linked[node] += size if link else 0
                ends[node] += text.count(".") + text.count("!") + text.count("?") + text.count(",")
                words[node] += text.count(" ") + 1
                parts[node] += 1
        below = [1] * n
        for i in range(n - 1, 0, -1):  # a run's node comes last, but never before its parent
            p = self.parents[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            ends[p] += ends[i]
            words[p] += words[i]
            parts[p] += parts[i]
            below[p] += below[i]
        total = max(1, chars[0])
        depth, kinds, above, around = [0] * n, [0] * n, [0] * n, [0] * n
        out = []
        for i in range(n):
            tag, p = self.tags[i], self.parents[i]
            kind = KIND.get(tag, N_KINDS - 1)
            kinds[i] = kind
            inside = 1 << kind
            if p >= 0:
                depth[i] = depth[p] + 1
                # A header or footer of an article belongs to it, so only the first landmark counts.
                inside = above[p] | (0 if kind in (6, 7) and above[p] >> 4 & 1 else inside)
                around[i] = around[p] | self.groups[i]
                place, count = self.places[i], len(self.kids[p])
                beside = (chars[p] - chars[i]) / max(1, count - 1)
            else:
                around[i], place, count, beside = self.groups[i], 0, 1, 0.0
            above[i] = inside
            own = self.groups[i]
            row = [0.0] * N_KINDS
            row[kind] = 1.0
            row += [float(own >> k & 1) for k in range(len(GROUPS))]
            row += [float(around[i] >> k & 1) for k in range(len(GROUPS))]
            row += [float(inside >> k & 1) for k in (2, 4, 5, 6, 7, 8, 9)]
            size = chars[i]
            row += [
                float(depth[i]), log1p(size), linked[i] / size if size else 0.0, log1p(size / below[i]), log1p(words[i] / max(1, parts[i])),
                100 * ends[i] / size if size else 0.0, float(len(self.kids[i])), place / count, float(count), size / total,
                size / max(1, chars[p]) if p >= 0 else 1.0, log1p(beside),
            ]
            out.append(row)
        return out

    def text(self, kept: list[bool]) -> str:
        """Blocks of the kept nodes in page order, white space collapsed."""
        blocks, run = [], []
        for item in self.flow:
            if item is None:
                if run:
                    blocks.append("".join(run))
                    run = []
            elif kept[item[0]]:
                run.append(item[1])
        blocks.append("".join(run))
        return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def decode(parents: list[int], scores: list[float]) -> list[bool]:
    """Nodes to keep: a node only with its parent, so that the kept scores sum to the most.

    Leaves first, a node's worth is its score with what its children add; a branch worth nothing goes
    as a whole, so no kept node stands below one that went.
    """
    worth = list(scores)
    for i in range(len(parents) - 1, 0, -1):
        if worth[i] > 0:
            worth[parents[i]] += worth[i]
    kept = [True] * len(parents)
    for i in range(1, len(parents)):
        kept[i] = worth[i] > 0 and kept[parents[i]]
    return kept
