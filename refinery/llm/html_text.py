"""Main text of web pages: gradient-boosted trees over DOM-node features.

A page is parsed into its block-level elements. Each gets features of its
subtree (text, link and punctuation density), attribute tokens, depth, siblings and
ancestors. Boosted trees, trained in numpy on a bounded sample of pages and on
layouts composed from their paragraphs, give each node log odds of holding article
text. Decoding is hierarchical: the labelling of highest total log odds in which
a dropped node has no kept descendant, found bottom-up.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import in_one_task, map_arrow, tune

#: Bounds of the training sample: pages, and bytes of a training page.
TRAIN_PAGES, TRAIN_BYTES = 150, 30_000
#: Text of composed layouts where the sampled pages have none.
FILLER = ("The first paragraph says what the page is about.", "A second one goes on with the matter, at more length.",
          "Short ones follow.", "The last paragraph draws what was said before together.")
LAYOUTS = 4             # composed layouts per sampled page
TREES, DEPTH, BINS, RATE = 40, 4, 32, 0.3

# Element groups.
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption nav header footer aside form fieldset details summary address hgroup center menu "
    "dialog hr".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
UNSEEN = frozenset("head script style template noscript iframe svg select textarea button title".split())
RAW = frozenset("script style title textarea".split())
CONTROLS = frozenset("input select textarea button label".split())
PAGE_PARTS = frozenset("nav header footer aside form fieldset menu dialog".split())
ARTICLE_PARTS = frozenset("article main".split())
PARAGRAPHS = frozenset("p blockquote pre dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
LISTS = frozenset("ul ol li dl dt dd menu".split())
# Attribute tokens of page parts and of article parts.
PAGE_TOKENS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments commentlist consent "
    "contact cookie cookies copyright cta disqus discussion donate footer form gallery gdpr header hidden login logo "
    "masthead menu meta modal nav navbar navigation newsletter notice alert notification overlay pager pagination "
    "popup privacy promo promoted recommended related replies reply respond review reviews search share sharing "
    "sidebar side signup skip social sponsor sponsored subscribe subscription tags teaser toolbar top topbar tracking "
    "widget widgets".split())
ARTICLE_TOKENS = frozenset(
    "article articlebody body content entry main mainbody page post prose story text".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "tbody": {"table"}}
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>"']*+(?:(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))[^>"']*+)*+)(?:>|\Z)"""
    r"""|<[!?/][^>]*(?:>|\Z)""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKENS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_MARKED = re.compile(r'data-label="([01])"')
_STOPS = re.compile(r"[.,;:!?]")


@dataclass
class Page:
    """Block-level nodes of a page in document order, and its text runs by block."""
    parent: list = field(default_factory=list)
    tag: list = field(default_factory=list)
    attrs: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    chars: list = field(default_factory=list)
    words: list = field(default_factory=list)
    links: list = field(default_factory=list)
    stops: list = field(default_factory=list)
    controls: list = field(default_factory=list)
    runs: list = field(default_factory=list)        # (node, text of one block)


def parse(source: str) -> Page:
    """Tolerant parse: unclosed and misnested elements, cut-off pages, raw text elements."""
    page = Page()

    def node(tag: str, attrs: str, parent: int) -> int:
        for column, value in ((page.parent, parent), (page.tag, tag), (page.attrs, attrs),
                              (page.depth, page.depth[parent] + 1 if parent >= 0 else 0), (page.chars, 0),
                              (page.words, 0), (page.links, 0), (page.stops, 0), (page.controls, 0)):
            column.append(value)
        return len(page.tag) - 1

    stack = [(node("body", "", -1), "body")]        # (node, tag) of open block elements
    inline_links, unseen, block = 0, [], []

    def flush() -> None:
        text = " ".join("".join(block).split())
        block.clear()
        if text:
            at = stack[-1][0]
            page.runs.append((at, text))
            page.chars[at] += len(text)
            page.words[at] += text.count(" ") + 1
            page.stops[at] += len(_STOPS.findall(text))

    def add(chunk: str) -> None:
        if unseen or not chunk:
            return
        if "&" in chunk:
            chunk = html.unescape(chunk)
        block.append(chunk)
        if inline_links:
            page.links[stack[-1][0]] += len(chunk.strip())

    at, n = 0, len(source)
    while at < n:
        m = _MARKUP.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        tag, closing = name.lower(), m.group(1) == "/"
        if tag in UNSEEN:
            if tag in CONTROLS:
                page.controls[stack[-1][0]] += 1
            if closing:
                if tag in unseen:
                    del unseen[unseen.index(tag):]
            elif not m.group(3).rstrip().endswith("/"):
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
                    at = n if end is None else end.start()
                    if end is not None:
                        gone = re.compile(r"[^>]*(?:>|\Z)").match(source, end.end())
                        at = gone.end()
                else:
                    unseen.append(tag)
            continue
        if not closing and (tag == "body" or unseen == ["head"] and tag in BLOCKS):
            unseen.clear()                              # the head ends where the body begins
        if unseen:
            continue
        if tag in CONTROLS and not closing:
            page.controls[stack[-1][0]] += 1
        if tag == "a":
            inline_links = 0 if closing else 1
        if tag == "br":
            block.append(" ")
        if tag not in BLOCKS or tag in ("html", "body"):
            if tag == "body" and not closing and m.group(3).strip():
                page.attrs[0] += " " + m.group(3)
            continue
        flush()
        inline_links = 0
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][1] == tag:
                    del stack[i:]
                    break
            continue
        if stack[-1][1] == "p" or (len(stack) > 1 and stack[-1][1] in HEADINGS and tag in HEADINGS):
            stack.pop()                                 # a block closes an open paragraph
        if tag in _CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][1] in _SCOPES.get(tag, ()):
                    break
                if stack[i][1] in _CLOSES[tag]:
                    del stack[i:]
                    break
        if tag not in VOID and not (m.group(3).endswith("/") and tag == "hr"):
            stack.append((node(tag, m.group(3), stack[-1][0]), tag))
    flush()
    return page


def _tokens(attrs: str) -> tuple[int, int]:
    """(page-part tokens, article tokens) of an element's attributes."""
    if "=" not in attrs:
        return 0, 0
    text = " ".join(next(x for x in m if x) if any(m) else "" for m in _NAMED.findall(attrs))
    found = set(_TOKENS.findall(_CAMEL.sub(" ", text).lower()))
    return len(found & PAGE_TOKENS), len(found & ARTICLE_TOKENS)


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, parent, depth, first node of each page and the end) over all nodes of pages."""
    sizes = np.array([len(p.tag) for p in pages], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    n = int(first[-1])

    def column(name: str) -> np.ndarray:
        return np.array([x for p in pages for x in getattr(p, name)], np.float64)

    parent = np.concatenate([np.array(p.parent, np.int64) + o for p, o in zip(pages, first)]) if n else np.zeros(0, np.int64)
    parent[first[:-1]] = first[:-1]
    depth = column("depth").astype(np.int64)
    tags = [t for p in pages for t in p.tag]
    known: dict = {}
    tok = np.array([known[a] if a in known else known.setdefault(a, _tokens(a))
                    for p in pages for a in p.attrs], np.float64).reshape(-1, 2)
    hidden = np.array([bool(a) and bool(_HIDDEN.search(a)) for p in pages for a in p.attrs], np.float64)

    def isin(group: frozenset) -> np.ndarray:
        return np.array([t in group for t in tags], np.float64)

    part, art = isin(PAGE_PARTS), isin(ARTICLE_PARTS)
    own = np.stack([column("chars"), column("words"), column("links"), column("stops"), column("controls"),
                    np.ones(n), isin(PARAGRAPHS)], axis=1)
    sub, above = own.copy(), np.stack([tok[:, 0], tok[:, 1], part, art, hidden], axis=1)
    ups = np.zeros_like(above)
    levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max(initial=0)) + 1)]
    for rows in reversed(levels):
        np.add.at(sub, parent[rows], sub[rows])
    for rows in levels:
        ups[rows] = ups[parent[rows]] + above[parent[rows]]
    page_of = np.repeat(np.arange(len(pages)), sizes)
    total = np.maximum(sub[first[:-1]][page_of, 0], 1)
    before = np.cumsum(own[:, 0]) - own[:, 0]
    before -= before[first[:-1]][page_of]
    kids = np.bincount(parent, minlength=n) - (parent == np.arange(n))
    order = np.lexsort((np.arange(n), parent))
    left, right = np.zeros(n), np.zeros(n)
    same = (parent[order[1:]] == parent[order[:-1]]) & (order[:-1] != parent[order[:-1]])
    left[order[1:][same]], right[order[:-1][same]] = sub[order[:-1][same], 0], sub[order[1:][same], 0]
    place = np.zeros(n)
    run = np.flatnonzero(np.concatenate(([True], parent[order[1:]] != parent[order[:-1]]))) if n else np.zeros(0, int)
    place[order] = np.arange(n) - np.repeat(run, np.diff(np.concatenate((run, [n]))))
    chars = np.maximum(sub[:, 0], 1)
    x = np.stack([
        depth, place, kids[parent], np.log1p(sub[:, 0]), np.log1p(sub[:, 1]), sub[:, 2] / chars, sub[:, 5] / chars,
        sub[:, 0] / total, np.log1p(sub[:, 6]), sub[:, 1] / np.maximum(sub[:, 5], 1), sub[:, 3] / np.maximum(sub[:, 1], 1),
        tok[:, 0], ups[:, 0], tok[:, 1], ups[:, 1], part, ups[:, 2], art, ups[:, 3], isin(HEADINGS), isin(LISTS),
        before / total, np.log1p(left), np.log1p(right), sub[:, 4], hidden + ups[:, 4], isin(PARAGRAPHS),
        own[:, 0] / chars], axis=1)
    return x, parent, depth, first


# ---- boosted trees ----------------------------------------------------------

@dataclass
class Trees:
    edges: list             # bin edges per feature
    base: float
    nodes: list             # per tree: (feature, bin, leaf values), complete binary trees of DEPTH


def _binned(x: np.ndarray, edges: list) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, l2: float = 2.0) -> Trees:
    """Logistic gradient boosting on histograms; complete trees, second-order leaf values."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    b = _binned(x, edges)
    p0 = np.clip((weight * y).sum() / weight.sum(), 0.01, 0.99)
    model = Trees(edges, float(np.log(p0 / (1 - p0))), [])
    f = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = weight * (y - p), np.maximum(weight * p * (1 - p), 1e-9)
        place = np.zeros(len(y), np.int64)
        feat, cut = [], []
        for d in range(DEPTH):
            n = 1 << d
            best = np.full(n, 1e-6)
            bf, bc = np.zeros(n, np.int64), np.full(n, BINS, np.int64)
            for j in range(x.shape[1]):
                k = place * BINS + b[:, j]
                hg = np.bincount(k, g, n * BINS).reshape(n, BINS).cumsum(1)
                hh = np.bincount(k, h, n * BINS).reshape(n, BINS).cumsum(1)
                tg, th = hg[:, -1:], hh[:, -1:]
                gain = hg ** 2 / (hh + l2) + (tg - hg) ** 2 / (th - hh + l2) - tg ** 2 / (th + l2)
                gain[:, -1] = 0
                at = gain.argmax(1)
                better = gain[np.arange(n), at] > best
                best[better], bf[better], bc[better] = gain[np.arange(n), at][better], j, at[better]
            feat.append(bf)
            cut.append(bc)
            place = place * 2 + (b[np.arange(len(y)), bf[place]] > bc[place])
        n = 1 << DEPTH
        leaf = RATE * np.bincount(place, g, n) / (np.bincount(place, h, n) + l2)
        model.nodes.append((feat, cut, leaf))
        f += leaf[place]
    return model


def log_odds(x: np.ndarray, model: Trees) -> np.ndarray:
    b, rows = _binned(x, model.edges), np.arange(len(x))
    f = np.full(len(x), model.base)
    for feat, cut, leaf in model.nodes:
        place = np.zeros(len(x), np.int64)
        for bf, bc in zip(feat, cut):
            place = place * 2 + (b[rows, bf[place]] > bc[place])
        f += leaf[place]
    return f


def decode(z: np.ndarray, parent: np.ndarray, depth: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Kept nodes: the best total log odds where a dropped node's subtree is dropped whole."""
    z = np.clip(z, -5, 5)
    drop, keep = -z, z.copy()
    levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max(initial=0)) + 1)]
    for rows in reversed(levels):
        np.add.at(keep, parent[rows], np.maximum(keep[rows], drop[rows]))
        np.add.at(drop, parent[rows], drop[rows])
    kept = keep >= drop
    for rows in levels:
        kept[rows] &= kept[parent[rows]]
    return kept


def extract(pages: list[Page], model: Trees) -> list[str]:
    """Main text of each page: kept blocks in page order."""
    x, parent, depth, first = features(pages)
    if not len(x):
        return ["" for _ in pages]
    kept = decode(log_odds(x, model), parent, depth, first)
    out = []
    for p, o in zip(pages, first):
        texts = [t for at, t in p.runs if kept[o + at]]
        # a page that marks no part of itself as anything else is its own article
        out.append("\n\n".join(texts if texts or not _unmarked(p) else [t for _, t in p.runs]))
    return out


def _unmarked(p: Page) -> bool:
    """No element or attribute of the page says that it is a part beside an article."""
    apart = PAGE_PARTS | CONTROLS | LISTS
    return not any(t in apart for t in p.tag) and not any(
        _tokens(a)[0] or _HIDDEN.search(a) for a in set(p.attrs) if a)


# ---- training pages ---------------------------------------------------------

def _weak_labels(p: Page) -> np.ndarray | None:
    """Own text of article parts without page parts, where the page has an article part."""
    if not any(t in ARTICLE_PARTS for t in p.tag):
        return None
    inside = np.zeros(len(p.tag), bool)
    for i, t in enumerate(p.tag):
        up = inside[p.parent[i]] if i else False
        page_part, article = _tokens(p.attrs[i])
        inside[i] = (up or t in ARTICLE_PARTS) and not (t in PAGE_PARTS and t != "header") and not (
            page_part and not article)
    return inside


def _marked_labels(p: Page) -> np.ndarray:
    out = np.zeros(len(p.tag), bool)
    for i, a in enumerate(p.attrs):
        m = _MARKED.search(a)
        out[i] = m[1] == "1" if m else (out[p.parent[i]] if i else False)
    return out


def compose(texts: list[str], rng: np.random.Generator) -> str:
    """A page of one of many layouts around paragraphs; data-label marks article text."""
    def pick(*options):
        return options[rng.integers(len(options))]

    def some(lo: int, hi: int) -> str:
        words = pick(*texts).split()
        n = int(rng.integers(lo, hi + 1))
        at = int(rng.integers(0, max(1, len(words) - n)))
        return html.escape(" ".join(words[at:at + n]), quote=False)

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{some(1, 3)}</a></li>' for i in range(n))

    def wrap(body: str, tags: tuple, names: tuple, label: int) -> str:
        tag = pick(*tags)
        name = "" if tag != "div" and rng.random() < 0.5 else f' {pick("class", "id")}="{pick(*names)}"'
        return f'<{tag}{name} data-label="{label}">{body}</{tag}>'

    menu = wrap(f"<ul>{links(int(rng.integers(3, 9)))}</ul>", ("nav", "div", "div"),
                ("menu", "navbar", "nav-main", "site-navigation", "breadcrumbs", "topbar"), 0)
    head = wrap(pick(f"<h2>{some(2, 5)}</h2>", f'<a href="/">{some(1, 3)}</a>', f"<p>{some(3, 9)}</p>") + pick("", menu),
                ("header", "div"), ("header", "masthead", "site-header", "logo"), 0)
    advert = wrap(pick(some(4, 20), f"<p>{some(4, 25)}</p>"), ("div", "aside"), ("ad", "ads", "advert", "sponsored", "promo"), 0)
    notice = wrap(f"<p>{some(6, 30)}</p>" + pick("", "<button>OK</button>"), ("div", "section", "div"),
                  ("cookie-notice", "consent", "notice", "alert", "banner", "newsletter", "gdpr-popup"), 0)
    side = wrap(f"<h3>{some(1, 4)}</h3>" + pick(f"<ul>{links(int(rng.integers(2, 7)))}</ul>", f"<p>{some(8, 40)}</p>"),
                ("aside", "div"), ("sidebar", "widget", "related", "recommended", "side"), 0)
    form = wrap(f"<label>{some(1, 3)}</label><input><p>{some(3, 12)}</p><button>Go</button>", ("form", "form", "div"),
                ("search", "contact-form", "subscribe", "login"), 0)
    talk = "".join(pick(f"<li><p>{some(4, 45)}</p></li>", f'<div class="comment"><p>{some(4, 60)}</p></div>')
                   for _ in range(int(rng.integers(1, 7))))
    talk = wrap(pick(f"<h3>{some(1, 3)}</h3>", "") + talk, ("section", "div", "ol"),
                ("comments", "comment-list", "discussion", "replies", "reviews", "respond"), 0)
    share = wrap(f"<ul>{links(3)}</ul>", ("div",), ("share", "social", "tags", "toolbar"), 0)
    foot = wrap(pick(f"&copy; {some(2, 14)}", f"<p>{some(4, 20)}</p><ul>{links(3)}</ul>"), ("footer", "div"),
                ("footer", "copyright", "site-footer"), 0)
    paras = []
    for t in [texts[i] for i in rng.permutation(len(texts))[:int(rng.integers(1, 9))]]:
        t = html.escape(t, quote=False)
        paras.append(pick(f"<p>{t}</p>", f"<p>{t}</p>", f"<p><b>{t}<br>", f"<blockquote><p>{t}</p></blockquote>",
                          f"<h2>{some(1, 6)}</h2><p>{t}</p>", f"<ul><li>{t}</li><li>{some(3, 25)}</li></ul>",
                          f"<div>{t}</div>", f"<p>{t}</p><table><tr><td>{some(1, 5)}</td><td>{some(1, 12)}</td></tr>"
                          f"<tr><td>{some(1, 5)}</td><td>{some(1, 12)}</td></tr></table>",
                          f"<figure><figcaption>{some(2, 15)}</figcaption></figure><p>{t}</p>", f"<p>{some(1, 8)}</p>"))
    if rng.random() < 0.06:         # a page of bare paragraphs
        return "<html><body>" + "".join(f'<p data-label="1">{html.escape(t, quote=False)}</p>' for t in texts[:4]) + "</body></html>"
    inner = []
    for x in paras:
        inner.append(x)
        if rng.random() < 0.08:
            inner.append(pick(advert, side, share))
    title = f"<h1>{some(1, 10)}</h1>"
    body = pick(title, title, f"<header>{title}</header>") + "".join(inner)
    body += pick("", "", share, talk)
    body = wrap(body, ("article", "main", "div", "div", "section"),
                ("content", "post", "entry-content", "article-body", "main", "story", "page-content"), 1)
    body = pick(body, body, f"<div>{body}</div>", f'<main>{body}</main>', f'<div id="wrapper">{body}{side}</div>')
    return "<html><body>" + "".join([
        pick("", notice), pick(head, menu, head + menu), pick("", advert), pick("", form), body, pick("", side, form),
        pick("", talk), pick("", advert, notice), pick(foot, foot, "")]) + "</body></html>"


def train(sources: list[str], seed: int = 11, layouts: int = LAYOUTS) -> Trees | None:
    """Trees from sampled pages: their own markup where it is clear, and composed layouts."""
    rng = np.random.default_rng(seed)
    pages, labels, texts = [], [], []
    for s in sources:
        p = parse(s)
        y = _weak_labels(p)
        if y is not None:
            pages.append(p)
            labels.append(y)
        texts.append([t for _, t in p.runs if len(t) >= 20])
    # a sample of nothing but short runs still gives a model
    everything = [t for ts in texts for t in ts] or list(FILLER)
    for ts in texts:
        for _ in range(layouts):
            p = parse(compose(ts if len(ts) > 3 else everything, rng))
            pages.append(p)
            labels.append(_marked_labels(p))
    x, parent, depth, first = features(pages)
    own = np.array([c for p in pages for c in p.chars], np.float64) * np.concatenate(labels)
    for d in range(int(depth.max()), 0, -1):
        rows = np.flatnonzero(depth == d)
        np.add.at(own, parent[rows], own[rows])
    return fit_trees(x, (own > 0).astype(np.float64), np.ones(len(x)))


def fit_extractor(pages: DataFrame, rows: int = TRAIN_PAGES, most_bytes: int = TRAIN_BYTES) -> Trees | None:
    """Train on ``rows`` pages, those of at most ``most_bytes`` bytes first, by id hash.

    Of a larger page the training sample takes the start, cut at a tag; every page is
    extracted whole. None only where no page has html.
    """
    html = F.col("html").cast("string")
    whole = F.octet_length("html") <= most_bytes
    start = F.regexp_replace(F.left("html", F.lit(most_bytes // 4)), r"<[^<>]*\z", "")
    sample = (pages.select(F.col("page_id").cast("long").alias("page_id"), html.alias("html")).where("html is not null")
              .orderBy(~whole, F.xxhash64("page_id"), "page_id").limit(rows)
              .select(F.when(whole, F.col("html")).otherwise(start).alias("html")))
    return in_one_task(sample, lambda t: train(sorted(t.column("html").to_pylist())))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null or empty html gives an empty text; repeated rows give equal texts; pages
    without markup are one block; an empty table gives no rows. Nothing of the kept
    blocks is cut, however long or deeply nested the page is.
    """
    tune(pages.sparkSession)
    model = pages.sparkSession.sparkContext.broadcast(fit_extractor(pages))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        source = [x or "" for x in batch.column("html").to_pylist()]
        texts = [""] * len(source) if model.value is None else extract([parse(s) for s in source], model.value)
        return pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return map_arrow(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                                  F.col("html").cast("string").alias("html")),
                     run, "page_id long, url string, text string, n_chars long")
