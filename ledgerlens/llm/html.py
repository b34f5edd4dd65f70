"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block nodes (inline elements belong to their block; text beside
blocks is a node of its own).  Each node has features of its subtree (text density,
link share, words, punctuation), of its tag and attribute tokens, its depth, its place among its
siblings and their statistics.  Boosted trees give the log odds that the node holds main text.
Decoding picks the best labelling in which a node below rejected nodes is rejected: an
ancestor and a descendant can't contradict each other, and one pass up and one down the tree
find the optimum.

The trees learn from a bounded sample of the table's own pages, FIT_PAGES by hash of page_id, all nodes of each.  Their
labels come from meaning that pages declare: article and main elements hold the text, navigation,
asides, headers, footers, forms and blocks with tokens such as "comment" or "ad" don't, unless these hold most of
the page.  Each page is learned as it is and VERSIONS times with side parts put in (paragraphs of other sample pages under random
tags and names, half of them names that no list has, and now and then the article itself under an odd name), and each
version also with tags and tokens hidden, so that a part is told by its place, size and by having a name as well.

Attribute tokens speak by smoothed label shares, counted over the sample; an unseen token by those of its letter
4-grams (``Tokens``). The evidence is a feature like the others and bounded, so no single token settles a long text.

Pages without declared text teach nothing; if the whole sample has none, a built-in score over the
same features stands in.

Defined results: a null or empty html has the empty text; scripts, styles, templates, comments and head
never count (a head without end tag ends at the first text or element that can't stand in it);
unclosed and misnested elements are closed as browsers close paragraphs, list items and table
cells; a page cut off in a tag loses that tag; character references are
decoded, white space inside a block is one space; very long pages are parsed
whole; repeated rows are extracted row by row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as references
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import arrow_map, hashed_sample

FIT_PAGES = 200
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 32
VERSIONS = 3  # of each page with side parts put in

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")
#: Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noframes".split())
_DROPPED = frozenset("script style template noscript iframe object svg math canvas head title textarea select".split())
_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp "
    "small span strike strong sub sup time tt u var wbr br img".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol table html body div article section main td th".split())

#: Words in class, id and role values that usually name a part: what the token evidence starts from.
_AGAINST = frozenset(
    "ad ads advert advertisement aside banner breadcrumb breadcrumbs comment comments cookie consent copyright "
    "disqus footer form header login menu meta modal nav navbar navigation newsletter notice pager pagination "
    "popup promo promoted related reply replies search share sharing shop sidebar signup social sponsor sponsored "
    "subscribe tags teaser toolbar widget".split())
_FOR = frozenset("article body content entry main post story text".split())
_TAGS_AGAINST = frozenset("nav aside footer header form menu dialog button fieldset".split())
_TAGS_FOR = frozenset("article main".split())
_TAG_KINDS = {t: k for k, group in enumerate((
    ("p",), ("li", "dd", "dt"), ("ul", "ol", "dl", "menu"), ("div", "section"), ("article", "main"),
    ("h1", "h2", "h3", "h4", "h5", "h6"), ("nav",), ("aside",), ("header", "footer"), ("form", "fieldset"),
    ("table", "tbody", "tr", "td", "th"), ("blockquote", "pre", "figure", "figcaption"), ("#text",), ("html", "body")), 1)
    for t in group}


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    tokens: tuple[str, ...] = ()
    hidden: bool = False
    text: list[str] = field(default_factory=list)
    links: int = 0  # characters in links
    children: list[int] = field(default_factory=list)
    planted: str = ""  # set by the fit: "side" or "main"


_GRAMS = 1 << 14
_SEED, _SMOOTH, _MOST = 4.0, 2.0, 2.0


def _gram_slots(token: str) -> list[int]:
    padded = f"^{token}$"
    return [zlib.crc32(padded[k:k + 4].encode()) % _GRAMS for k in range(max(1, len(padded) - 3))]


class Tokens:
    """How far attribute tokens speak for or against main text: smoothed log ratios of the labels they were seen with.

    A token that was seen has its own ratio; an unseen one has the mean of those of its letter 4-grams, so that
    words of one stem, or of related languages, speak alike. Both lie within _MOST: one token never settles a node.
    """

    def __init__(self):
        self.seen: dict[str, list[float]] = {}
        self.grams = np.zeros((_GRAMS, 2))
        for words, label in ((_AGAINST, 0), (_FOR, 1)):
            for w in words:
                self.add(w, label, _SEED)
        self.known: dict[str, float] = {}

    def add(self, token: str, label: int, weight: float = 1.0) -> None:
        self.seen.setdefault(token, [0.0, 0.0])[label] += weight
        for g in _gram_slots(token):
            self.grams[g, label] += weight

    def learn(self, nodes: list[Node], label: np.ndarray) -> None:
        """Count the tokens of a page's nodes, those of made-up parts left out."""
        for x, y in zip(nodes, label):
            if not x.planted:
                for t in set(x.tokens):
                    self.add(t, int(y))

    def score(self, tokens: tuple[str, ...]) -> float:
        return sum(map(self._one, set(tokens)))

    def _one(self, token: str) -> float:
        found = self.known.get(token)
        if found is None:
            if token in self.seen:
                found = _ratio(*self.seen[token])
            else:
                found = float(np.mean([_ratio(*self.grams[g]) for g in _gram_slots(token)]))
            if len(self.known) < 100_000:
                self.known[token] = found
        return found


def _ratio(against: float, favour: float) -> float:
    return min(max(math.log((favour + _SMOOTH) / (against + _SMOOTH)), -_MOST), _MOST)


_PLANTED = "data-ledgerlens-planted"


def _attributes(source: str) -> tuple[tuple[str, ...], bool, str]:
    """Words of class, id and role, whether the element is hidden, and the mark of a part that the fit has made up."""
    words: list[str] = []
    hidden, planted = False, ""
    for name, a, b, c in _ATTRIBUTE.findall(source):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop"):
            words += _WORDS.findall((a or b or c).lower())
        elif name == _PLANTED:
            planted = a
        elif name == "hidden" or name == "style" and "display:none" in (a or b or c).replace(" ", "").lower():
            hidden = True
    return tuple(words), hidden, planted


def parse(source: str) -> list[Node]:
    """The block nodes of a page in page order; node 0 is the root, a node's text are its pieces in order."""
    nodes = [Node("html", -1)]
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements: tag, the block that they belong to
    dropped = 0  # open dropped elements
    links = 0
    run = -1  # the text node that is being filled

    def add(text: str) -> None:
        nonlocal run
        if text and text.strip():
            leave_head()
        if dropped or not text:
            return
        block = stack[-1][1]
        if run < 0 or nodes[run].parent != block:
            if not text.strip():
                return
            nodes.append(Node("#text", block))
            run = len(nodes) - 1
            nodes[block].children.append(run)
        decoded = references.unescape(text) if "&" in text else text
        nodes[run].text.append(decoded)
        if links:
            nodes[run].links += len(decoded.strip())

    def close(k: int) -> None:
        nonlocal dropped, links, run
        while len(stack) > k:
            tag, _ = stack.pop()
            if tag in _DROPPED:
                dropped -= 1
            elif tag == "a":
                links -= 1
            if tag not in _INLINE:
                run = -1

    def leave_head() -> None:
        while stack[-1][0] == "head":
            close(len(stack) - 1)

    def last(tags, scope) -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                return k
            if stack[k][0] in scope:
                break
        return -1

    at = 0
    for m in iter(lambda: _TOKEN.search(source, at), None):
        add(source[at:m.start()])
        at = m.end()
        if at == m.start():
            break
        if m[1] is not None:
            add(m[1].replace("&", "&amp;"))
            continue
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag == "br":
                add(" ")
                continue
            k = last((tag,), ())
            if k > 0:
                close(k)
            continue
        if not source.endswith(">", 0, at) and at == len(source):
            break  # cut off in this tag
        if tag in ("html", "body"):
            if tag == "body" and not any(t == "body" for t, _ in stack):
                close(1)
                words, hidden, _ = _attributes(m[4])
                nodes.append(Node("body", 0, words, hidden))
                nodes[0].children.append(len(nodes) - 1)
                stack.append(("body", len(nodes) - 1))
                run = -1
            continue
        if tag not in _HEAD:
            leave_head()
        if tag in _CLOSES_P:
            k = last(("p",), _SCOPE)
            if k > 0:
                close(k)
        if tag in _SAME:
            k = last(_SAME[tag], ("ul", "ol", "dl", "table", "tr") if tag not in ("tr",) else ("table",))
            if k > 0:
                close(k)
        if tag in _VOID:
            if tag in ("br", "hr", "img"):
                add(" ")
            if tag == "hr":
                run = -1
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if m[4].endswith("/") and tag not in _CLOSES_P and tag not in _INLINE:
            continue
        block = stack[-1][1]
        if tag in _DROPPED:
            dropped += 1
        elif tag == "a":
            links += 1
        elif tag not in _INLINE and not dropped:
            words, hidden, planted = _attributes(m[4]) if m[4] else ((), False, "")
            nodes.append(Node(tag, block, words, hidden, planted=planted))
            nodes[block].children.append(len(nodes) - 1)
            block = len(nodes) - 1
            run = -1
        stack.append((tag, block))
    add(source[at:])
    return nodes


N_FEATURES = 28
_MEANING = slice(0, 6)  # features that hiding a page's tags and tokens removes


def features(nodes: list[Node], tokens: Tokens | None = None) -> np.ndarray:
    """One row of features a node; ``tokens``: the evidence of attribute tokens (what it starts from, if none is given)."""
    tokens = tokens or _seeds()
    n = len(nodes)
    chars, links, words, stops, paragraphs, own, depth = ([0] * n for _ in range(7))
    blocks = [1] * n
    for i, x in enumerate(nodes):
        if i:
            depth[i] = depth[x.parent] + 1
        if x.text:
            t = "".join(x.text) if len(x.text) > 1 else x.text[0]
            own[i] = chars[i] = len(t)
            links[i] = min(x.links, len(t))
            words[i] = t.count(" ") + 1
            stops[i] = t.count(".") + t.count(",") + t.count("。") + t.count("!") + t.count("?")
        if x.tag == "p":
            paragraphs[i] = 1
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = nodes[i].parent
        chars[p] += chars[i]
        links[p] += links[i]
        words[p] += words[i]
        stops[p] += stops[i]
        blocks[p] += blocks[i]
        paragraphs[p] += paragraphs[i]
    against, favour = [0.0] * n, [0.0] * n  # declarations of the node and its ancestors
    named = [0] * n  # nodes with tokens from the root down to here
    apart = [sum([chars[k] for k in x.children if nodes[k].tokens]) for x in nodes]  # characters in children with tokens
    total = chars[0] or 1
    out: list[tuple | None] = [None] * n
    sums = [sum([chars[k] for k in x.children]) for x in nodes]
    most = [max([chars[k] for k in x.children], default=0) for x in nodes]
    place, before, alike = [0] * n, [-1] * n, [1.0] * n  # alike: the share of siblings of its kind
    for x in nodes:
        last = -1
        for k, c in enumerate(x.children):
            place[c], before[c] = k, last
            last = c
        if len(x.children) > 1:
            kinds = [(nodes[c].tag, bool(nodes[c].tokens)) for c in x.children]
            counts = Counter(kinds)
            for c, kind in zip(x.children, kinds):
                alike[c] = counts[kind] / len(kinds)
    for i, x in enumerate(nodes):
        p = x.parent if i else 0
        up = nodes[p]
        mine, yours = 0.0, 0.0
        if x.tag in _TAGS_AGAINST:
            mine = 1
        elif x.tag in _TAGS_FOR:
            yours = 1
        if x.tokens:
            said = tokens.score(x.tokens)
            mine, yours = mine + max(-said, 0.0), yours + max(said, 0.0)
        if i:
            against[i], favour[i] = against[p] + mine, favour[p] + yours
            named[i] = named[p] + (1 if x.tokens else 0)
            count, side, top = len(up.children), sums[p], most[p]
        else:
            count, side, top = 1, total, total
        c, left = chars[i], before[i]
        out[i] = (
            _TAG_KINDS.get(x.tag, 0), _TAG_KINDS.get(up.tag, 0), mine, yours, against[i], favour[i],
            depth[i], c, own[i], links[i] / (c or 1), words[i], c / blocks[i], stops[i] / (words[i] or 1),
            paragraphs[i], blocks[i], c / total, count, place[i] / count, side / count, c / (side or 1), top,
            links[left] / (chars[left] or 1) if left >= 0 else -1.0, chars[p] / blocks[p] if i else 0.0, len(x.children),
            1 if x.tokens else 0, named[i], apart[p] / (side or 1) if i else 0.0, alike[i])
    return np.array(out, dtype=np.float64)


def declared(nodes: list[Node]) -> np.ndarray | None:
    """Labels that the page's own markup gives its nodes; None if it declares no main text.

    1 for nodes with main text in their subtree, 0 for the others. A token that usually names a side part doesn't
    reject a block with more than half of the page's text.
    """
    n = len(nodes)
    chars = [sum(map(len, x.text)) for x in nodes]
    for i in range(n - 1, 0, -1):
        chars[nodes[i].parent] += chars[i]
    inside, against = [False] * n, [False] * n
    label = np.zeros(n, dtype=np.int64)
    for i, x in enumerate(nodes):
        up = x.parent
        words = set(x.tokens)
        inside[i] = i > 0 and (inside[up] or x.tag in _TAGS_FOR)
        # A header within an article may be its title: only outside it does the tag declare anything.
        off = (x.tag in _TAGS_AGAINST and not (x.tag == "header" and inside[i]) or x.hidden or x.planted == "side"
               or bool(words & _AGAINST) and x.planted != "main" and 2 * chars[i] <= chars[0])
        against[i] = i > 0 and (against[up] or off)
        if x.text and inside[i] and not against[i]:
            label[i] = 1
    if not label.any():
        return None
    for i in range(n - 1, 0, -1):
        label[nodes[i].parent] |= label[i]
    return label


_seed_tokens: list[Tokens] = []


def _seeds() -> Tokens:
    if not _seed_tokens:
        _seed_tokens.append(Tokens())
    return _seed_tokens[0]


@dataclass
class Trees:
    """Boosted trees of fixed depth: for each inner node a feature and a threshold, for each leaf a value."""
    start: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    tokens: Tokens | None = None

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - (2 ** DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Gradient boosting of the logistic loss with histogram splits (gain of the second-order expansion)."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score = np.full(len(y), start)
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    model = Trees(start, np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    smooth = 1.0
    for k in range(trees):
        p = 1 / (1 + np.exp(-np.clip(score, -35, 35)))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            cell = at - first
            best = np.zeros(width)
            for f in range(x.shape[1]):
                key = cell * BINS + binned[:, f]
                gs = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + smooth) + (gt - gs)**2 / (ht - hs + smooth) - gt**2 / (ht + smooth)
                gain[:, len(edges[f]):] = 0
                top = gain.argmax(axis=1)
                for c in range(width):
                    if gain[c, top[c]] > best[c] + 1e-9:
                        best[c] = gain[c, top[c]]
                        model.feature[k, first + c] = f
                        model.threshold[k, first + c] = edges[f][top[c]]
            right = x[np.arange(len(y)), model.feature[k, at]] > model.threshold[k, at]
            at = 2 * at + 1 + right
        leaf = at - inner
        gs, hs = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        model.value[k] = RATE * gs / (hs + smooth)
        score += model.value[k][leaf]
    return model


def _fallback() -> Trees:
    """A single split on declared parts and one on link share, for samples that declare nothing."""
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    model = Trees(0.5, np.zeros((2, inner), dtype=np.int64), np.full((2, inner), np.inf), np.zeros((2, leaves)))
    half = leaves // 2
    for k, (f, t, low, high) in enumerate(((4, 0.5, 1.0, -3.0), (9, 0.5, 1.0, -3.0))):
        model.feature[k, 0], model.threshold[k, 0] = f, t
        model.value[k, :half], model.value[k, half:] = low, high
    return model


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The labelling of greatest summed log odds in which nothing below a rejected node is chosen."""
    n = len(nodes)
    keep = odds.tolist()
    drop = [-x for x in keep]
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    chosen = [False] * n
    for i, x in enumerate(nodes):
        chosen[i] = (i == 0 or chosen[x.parent]) and keep[i] > drop[i] and not x.hidden
    return chosen


def main_text(nodes: list[Node], chosen: list[bool]) -> str:
    """Texts of the chosen nodes in page order, one block a line."""
    blocks = (_SPACE.sub(" ", "".join(x.text)).strip() for x, c in zip(nodes, chosen) if c and x.text)
    return "\n".join(b for b in blocks if b)


def _name(rng: np.random.Generator) -> str:
    """A name that no list has: some syllables."""
    return "".join(rng.choice(list("bdfgklmnprstvz")) + rng.choice(list("aeiou")) for _ in range(rng.integers(2, 5)))


def _with_parts(source: str, others: list[str], rng: np.random.Generator) -> str:
    """The page with side parts put in, filled with paragraphs of other pages, and its article under another name.

    Half of the parts have names that are in no list, so that the trees learn to see a part by its place, size and by having a
    name at all. Now and then most of the article is wrapped in a block with an odd name, which stays main text.
    """
    def part() -> str:
        tag = str(rng.choice(["div", "div", "section", "ul", *sorted(_TAGS_AGAINST)]))
        named = tag not in _TAGS_AGAINST or rng.random() < 0.5
        word = _name(rng) if rng.random() < 0.5 else rng.choice(sorted(_AGAINST))
        name = f' {rng.choice(["class", "id"])}="{word}"' if named else ""
        body = [str(rng.choice(others)) for _ in range(rng.integers(1, 5))]
        if rng.random() < 0.4:  # short ones, as in menus and adverts
            body = [x[:int(rng.integers(10, 80))] for x in body]
        wrap = "li" if tag == "ul" else str(rng.choice(["p", "p", "div"]))
        inner = "".join(f"<{wrap}>{x}</{wrap}>" for x in body)
        if rng.random() < 0.4:
            inner = inner.replace(f"<{wrap}>", "").replace(f"</{wrap}>", " ")
        return f'<{tag}{name} {_PLANTED}="side">{inner}</{tag}>'
    if rng.random() < 0.4:
        m = re.search(r"(<article[^>]*>)(.*?)(</article>)", source, re.S)
        if m:
            word = rng.choice(sorted(_AGAINST)) if rng.random() < 0.5 else _name(rng)
            # all of it, or what follows one of the first paragraphs
            ends = [0] + [e.end() for e in re.finditer(r"</p>|</h1>", m[2]) if 2 * e.end() < len(m[2])]
            k = m.end(1) + ends[int(rng.integers(len(ends)))]
            source = f'{source[:k]}<div class="{word}" {_PLANTED}="main">{source[k:m.start(3)]}</div>{source[m.start(3):]}'
    if rng.random() < 0.4:  # the article in a block of its own, side parts beside it or not
        tag = str(rng.choice(["main", "div", "section"]))
        word = f' class="{_name(rng)}"' if rng.random() < 0.5 else ""
        side = part() if rng.random() < 0.5 else ""
        source = re.sub(r"<article[^>]*>.*?</article>", lambda m: f'<{tag}{word} {_PLANTED}="main">{m[0]}{side}</{tag}>', source,
                        count=1, flags=re.S)
    for spot in (r"<article[^>]*>", r"</article>", r"</p>", r"<body[^>]*>", r"<footer"):
        if rng.random() < 0.5:
            found = list(re.finditer(spot, source))
            if found:  # before or after an opening tag, before a closing one, after a paragraph
                m = found[int(rng.integers(len(found)))] if spot == r"</p>" else found[0]
                after = spot.startswith("<body") or spot == r"</p>" or spot.startswith("<article") and rng.random() < 0.3
                k = m.end() if after else m.start()
                source = source[:k] + part() + source[k:]
    kind = rng.integers(3)
    if kind < 2:
        name = ("main", "article")[kind]
        source = source.replace("<article", f"<{name}").replace("</article>", f"</{name}>")
    return source


def _paragraphs(nodes: list[Node], label: np.ndarray) -> list[str]:
    return [references.escape(t) for x, y in zip(nodes, label) if y and x.text and (t := "".join(x.text).strip())]


def fit_pages(pages: list[str]) -> Trees:
    """The trees and the token evidence of a bounded list of pages."""
    rng = np.random.default_rng(11)
    parsed = [(s, t, y) for s in pages for t in [parse(s)] for y in [declared(t)] if y is not None]
    others = [p for _, t, y in parsed for p in _paragraphs(t, y)[:6]]
    tokens = Tokens()
    for _, nodes, label in parsed:
        tokens.learn(nodes, label)
    x, y = [], []
    for source, nodes, label in parsed:
        changed = [parse(_with_parts(source, others, rng)) for _ in range(VERSIONS)]
        for t, z in ((nodes, label), *((c, declared(c)) for c in changed)):
            if z is None:
                continue
            f = features(t, tokens)
            bare = f.copy()
            bare[:, _MEANING] = 0
            x += [f, bare]
            y += [z, z]
    if not y or len(np.unique(np.concatenate(y))) < 2:
        return _fallback()
    model = boost(np.concatenate(x), np.concatenate(y).astype(float))
    if model is not None:
        model.tokens = tokens
    return model


def fit(pages: DataFrame, fit_rows: int = FIT_PAGES) -> Trees:
    """Learn from ``fit_rows`` pages, the smallest by hash of page_id."""
    rows = hashed_sample(pages.where(F.length("html") > 0).select("page_id", "html"), "page_id", fit_rows).collect()
    return fit_pages(sorted(r["html"] for r in rows))


def extract(pages: DataFrame, model: Trees) -> DataFrame:
    """page_id, url, text of every row."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        trees = [parse(s) if s else [] for s in batch.column("html").to_pylist()]
        parts = [features(t, held.value.tokens) for t in trees if t]
        odds = held.value.log_odds(np.concatenate(parts)) if parts else np.zeros(0)
        at, texts = 0, []
        for t in trees:
            texts.append(main_text(t, decode(t, odds[at:at + len(t)])) if t else "")
            at += len(t)
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                          ["page_id", "url", "text"])
    rows = pages.select(F.col("page_id").alias("page_id"), F.col("url").alias("url"), F.col("html").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return arrow_map(rows, run, f"page_id {kind}, url string, text string")
