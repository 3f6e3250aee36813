"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into its leaf blocks: text between block-level tags, with the open elements around it. Each block is labelled
main text or not. Its score adds up weights of features of the ancestors (tags, the nearest landmark, words of class, id and
role) and of the text (length, links, punctuation, position); transitions tie neighbours together, and the Viterbi path is the
page's labelling. Weights are fitted to labelled pages by gradient descent on the negative log-likelihood, with marginals from
the forward-backward recursion.

The labelled pages are made by a generator with known labels (LABELLED pages, a documented bound), as no table holds labels;
`fitted` takes any others. Extraction is local to the row: no shuffle, and the weights are a few kilobytes.

Defined cases: null or empty html gives empty text; a page without tags is one block; unclosed elements end with the page, an
unfinished tag at the end is no text; repeated rows are treated alike; an empty table gives an empty result; extra columns are
ignored. White space is what str.split() splits at.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .shared import own_columns

LABELLED = 600
ROUNDS, RATE, RIDGE = 250, 0.15, 1e-3

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
#: Their contents are no text.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "select", "button", "object", "audio", "video", "canvas", "math", "head"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
LANDMARKS = {"article", "aside", "body", "dialog", "details", "fieldset", "figure", "footer", "form", "header", "main", "menu", "nav", "section", "table"}
#: An opening tag ends these open elements, up to the given containers.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CUES = {"cookie", "cookies", "privacy", "subscribe", "newsletter", "copyright", "©", "reply", "share", "login", "advertisement", "sponsored", "comments", "menu", "search", "related", "tags"}


class Context:
    """Open elements around a block: their features, and the children met so far."""

    def __init__(self, tag: str, words: tuple[str, ...] = (), parent: Context | None = None) -> None:
        self.tag, self.parent = tag, parent
        above = parent.features if parent else frozenset()
        near = tag if tag in LANDMARKS else parent.near if parent else ""
        self.near = near
        article = "article" if parent and ("t=article" in above or "t=main" in above) else ""
        self.features = frozenset({f for f in above if f[:2] in ("t=", "c=")} | {f"t={tag}", f"p={tag}", f"n={near}", f"n={near}|{article}"} | {f"c={w}" for w in words})
        self.children: dict[tuple[str, str], Context] = {}
        self.score: float | None = None

    def child(self, tag: str, attributes: str) -> Context:
        key = (tag, " ".join("".join(m.groups("")[1:]) for m in ATTRIBUTE.finditer(attributes)).lower() if attributes else "")
        found = self.children.get(key)
        if found is None:
            if len(self.children) > 5000:
                self.children.clear()
            found = self.children[key] = Context(tag, tuple(WORDS.findall(key[1])), self)
        return found


def blocks_of(page: str, root: Context) -> list[tuple[Context, str, float]]:
    """(context, text, share of linked characters) of each leaf block that has text."""
    out: list[tuple[Context, str, float]] = []
    at, context, parts, linked, link = 0, root, [], 0, False

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((context, text, min(1.0, linked / len(text))))
            parts, linked = [], 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece)
            parts.append(piece)
            if link:
                linked += len(piece.strip())

    while m := TOKEN.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in ("br", "wbr"):
            parts.append(" " if tag == "br" else "")
            continue
        if tag == "a":
            link = not closing
            continue
        if tag in INLINE or tag == "img":
            continue
        flush()
        link = False
        if tag in VOID:
            continue
        if closing:
            up = context
            while up.parent and up.tag != tag:
                up = up.parent
            if up.parent:
                context = up.parent
            continue
        if tag in RAW and not attributes.endswith("/"):
            if tag == "head":  # its elements are raw or empty; an unclosed head ends with the body's beginning
                continue
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if context.tag == "p":
            context = context.parent or context
        if tag in IMPLIED:
            ends, stops = IMPLIED[tag]
            up = context
            while up.parent and up.tag not in ends and up.tag not in stops:
                up = up.parent
            if up.parent and up.tag in ends:
                context = up.parent
        if not attributes.endswith("/"):
            context = context.child(tag, attributes)
    add(page[at:])
    flush()
    return out


def _step(x: float, limits: tuple) -> int:
    return sum(x >= y for y in limits)


def text_features(text: str, linked: float, place: float) -> list[str]:
    words = text.split()
    features = [
        f"words={_step(len(words), (2, 4, 8, 15, 30, 60))}", f"link={_step(linked, (0.01, 0.3, 0.7))}", f"place={_step(place, (0.1, 0.3, 0.7, 0.9))}",
        f"commas={_step(text.count(','), (1, 3))}", f"end={text[-1] in '.!?…\"”»'}", f"upper={text[0].isupper()}", f"digits={sum(c.isdigit() for c in text[:200]) * 5 > min(len(text), 200)}",
    ]
    features.append(features[0] + features[1])
    return features + [f"w={w}" for w in CUES.intersection(w.strip(".,:;!?").lower() for w in words[:40])]


def page_features(blocks: list[tuple[Context, str, float]]) -> list[list[str]]:
    n = max(1, len(blocks) - 1)
    return [[*c.features, *text_features(t, a, i / n)] for i, (c, t, a) in enumerate(blocks)]


# --- labelled pages

_SYLLABLES = "an be cor de el fi gra ho in jo ka lu mo ne or pa qui ri so tu ul ve wa xi yo za".split()
#: Usual words of classes and ids.
_ROLES = {
    "main": "content post entry story body text article main prose markdown page single".split(),
    "nav": "nav menu navbar breadcrumb breadcrumbs navigation toolbar links pagination pager skip".split(),
    "header": "header masthead topbar branding logo banner tagline site".split(),
    "footer": "footer colophon copyright legal bottom imprint".split(),
    "side": "sidebar aside widget rail related recommended trending popular more read secondary".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo banner promoted adsbox".split(),
    "notice": "cookie consent notice alert banner gdpr popup modal message warning overlay".split(),
    "form": "search subscribe newsletter login signup form contact".split(),
    "comments": "comments comment replies discussion responses thread disqus respond commentlist reply".split(),
    "share": "share social sharing buttons follow tags meta".split(),
}


def labelled_page(seed: int) -> tuple[str, list[tuple[str, bool]]]:
    """A page and its blocks with labels, in page order."""
    r = random.Random(seed)
    truth: list[tuple[str, bool]] = []

    def words(low: int, high: int) -> str:
        out = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 3))) for _ in range(r.randint(low, high))]
        if r.random() < 0.1:
            out = [w.upper() + "!!" for w in out]
        return " ".join(out)

    def sentences(low: int, high: int) -> str:
        return " ".join(words(3, 18).capitalize().replace(" so ", ", so ") + "." for _ in range(r.randint(low, high)))

    def block(tag: str, text: str, main: bool, inner: str = "{}") -> str:
        truth.append((" ".join(text.split()), main))
        end = "" if tag in ("p", "li") and r.random() < 0.1 else f"</{tag}>"
        return f"<{tag}>{inner.format(text)}{end}"

    def attributes(role: str) -> str:
        if r.random() < 0.15:
            return ""
        names = r.sample(_ROLES[role], r.randint(1, 2))
        return f' {r.choice(["class", "class", "id"])}="{r.choice([" ", "-", "_"]).join(names)}"'

    def box(role: str, tags: list[str], fill) -> str:
        tag = r.choice(tags)
        named = attributes(role) if tag in ("div", "section", "ul", "ol", "p") or r.random() < 0.5 else ""
        if tag in ("div", "section") and not named:
            named = f' class="{r.choice(_ROLES[role])}"'
        return f"<{tag}{named}>{fill()}</{tag}>"

    def menu() -> str:
        return "<ul>" + "".join(block("li", words(1, 3), False, '<a href="/x">{}</a>') for _ in range(r.randint(3, 8))) + "</ul>"

    def lines(low: int = 1, high: int = 3) -> str:
        return "".join(block(r.choice(["p", "p", "div"]), sentences(1, 2) if r.random() < 0.7 else words(2, 8), False) for _ in range(r.randint(low, high)))

    def bare(low: int, high: int) -> str:
        text = words(low, high) if r.random() < 0.5 else sentences(1, 2)
        truth.append((" ".join(text.split()), False))
        return text

    def footer() -> str:
        return bare(3, 12) if r.random() < 0.5 else lines() + (menu() if r.random() < 0.5 else "")

    def comments() -> str:
        return block(r.choice(["h2", "h3"]), words(1, 3), False) + "".join(box("comments", ["div", "li", "article"], lambda: (block("p", words(1, 2), False) if r.random() < 0.5 else "") + "".join(block("p", sentences(1, 4), False) for _ in range(r.randint(1, 2)))) for _ in range(r.randint(1, 6)))

    def form() -> str:
        return f"<form{attributes('form') if r.random() < 0.5 else ''}>" + block(r.choice(["p", "div"]), words(2, 12), False) + '<input type="text"></form>'

    def body() -> str:
        parts = [block("h1", words(3, 10), True)] if r.random() < 0.8 else []
        if r.random() < 0.3:
            parts = [f"<header>{''.join(parts)}</header>"]
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            if kind < 0.74:
                text = sentences(1, 6) if r.random() < 0.75 else words(1, 20)
                parts.append(block("p", text, True, r.choice(["{}", "{}", "{}", "<b>{}</b>", "<b>{}<br>"])))
            elif kind < 0.82:
                parts.append(block(r.choice(["h2", "h3"]), words(2, 7), True))
            elif kind < 0.88:
                parts.append("<ul>" + "".join(block("li", sentences(1, 1) if r.random() < 0.5 else words(2, 9), True) for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.91:
                parts.append("<blockquote>" + block("p", sentences(1, 3), True) + "</blockquote>")
            elif kind < 0.93:
                parts.append("<figure><img src='x'>" + block("figcaption", sentences(1, 1), True) + "</figure>")
            elif kind < 0.96:
                parts.append(box("ad", ["div", "aside", "section"], lambda: bare(2, 8)))
            elif kind < 0.98:
                parts.append(box("side", ["aside", "div"], lambda: lines()))
            else:
                parts.append(form())
        if r.random() < 0.2:
            parts.append(box("share", ["div", "ul"], lambda: bare(1, 4)))
        return "".join(parts)

    parts = []
    if r.random() < 0.4:
        parts.append(box("notice", ["div", "section", "dialog"], lambda: lines(1, 2)))
    if r.random() < 0.5:
        parts.append(box("header", ["header", "div"], lambda: bare(1, 6) + (menu() if r.random() < 0.4 else "")))
    if r.random() < 0.8:
        parts.append(box("nav", ["nav", "nav", "div"], menu))
    if r.random() < 0.5:
        parts.append(box("ad", ["div", "aside", "section"], lambda: bare(2, 14)))
    if r.random() < 0.3:
        parts.append(box("side", ["aside", "div"], lambda: lines() + menu()))
    inside = r.random() < 0.2

    def article() -> str:
        out = body()
        return out + box("comments", ["section", "div", "ol"], comments) if inside else out

    wrap = r.random()
    if wrap < 0.5:
        parts.append(f"<article{attributes('main') if r.random() < 0.4 else ''}>{article()}</article>")
    elif wrap < 0.7:
        parts.append(f"<main{attributes('main') if r.random() < 0.4 else ''}>{article()}</main>")
    elif wrap < 0.95:
        parts.append(box("main", ["div", "section"], article))
    else:
        parts.append(article())
    if not inside and r.random() < 0.4:
        parts.append(box("comments", ["section", "div", "ol"], comments))
    if r.random() < 0.4:
        parts.append(box("side", ["aside", "div"], lambda: lines() + menu()))
    if r.random() < 0.3:
        parts.append(form())
    if r.random() < 0.3:
        parts.append(box("notice", ["div", "section"], lambda: bare(4, 20)))
    if r.random() < 0.8:
        parts.append(box("footer", ["footer", "footer", "div"], footer))
    end = "</body></html>" if r.random() < 0.9 else ""
    return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title><style>p{{}}</style><script>var a='<p>';</script></head><body>{''.join(parts)}{end}", truth


# --- the model


class Model:
    """Weights of label "main text" against "other", of the transitions between labels, and of the first label."""

    def __init__(self, names: list[str], weights: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> None:
        self.weights = dict(zip(names, weights.tolist(), strict=True))
        self.transitions, self.first = transitions.tolist(), first.tolist()
        self.root = Context("")

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "transitions": self.transitions, "first": self.first}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, root=Context(""))

    def labels(self, blocks: list[tuple[Context, str, float]]) -> list[bool]:
        """The most probable labelling."""
        get, n, trace = self.weights.get, max(1, len(blocks) - 1), []
        (same0, turn1), (turn0, same1) = self.transitions
        v0 = v1 = 0.0
        for i, (context, text, linked) in enumerate(blocks):
            if context.score is None:
                context.score = sum(get(f, 0.0) for f in context.features)
            s = context.score + sum(get(f, 0.0) for f in text_features(text, linked, i / n))
            if i == 0:
                v0, v1 = self.first[0], self.first[1] + s
            else:
                a, b = v0 + same0 >= v1 + turn0, v0 + turn1 >= v1 + same1
                v0, v1 = (v0 + same0 if a else v1 + turn0), (v0 + turn1 if b else v1 + same1) + s
                trace.append((a, b))
        out = [v1 > v0]
        for a, b in reversed(trace):
            out.append(not (b if out[-1] else a))
        return out[::-1] if blocks else []

    def main_text(self, page: str | None) -> str:
        blocks = blocks_of(page, self.root) if page else []
        return "\n".join(t for (_, t, _), main in zip(blocks, self.labels(blocks), strict=True) if main) if blocks else ""


def fitted(pages: list[tuple[list[list[str]], list[bool]]]) -> Model:
    """pages: features and labels of each page's blocks."""
    pages = [(f, y) for f, y in pages if f]
    names = sorted({x for f, _ in pages for block in f for x in block})
    index = {x: i for i, x in enumerate(names)}
    longest = max(len(y) for _, y in pages)
    shape = (len(pages), longest)
    gold, real = np.zeros(shape, int), np.zeros(shape, bool)
    block_of, feature_of = [], []
    for p, (f, y) in enumerate(pages):
        gold[p, : len(y)], real[p, : len(y)] = y, True
        for t, block in enumerate(f):
            feature_of += [index[x] for x in block]
            block_of += [p * longest + t] * len(block)
    block_of, feature_of = np.array(block_of), np.array(feature_of)
    pair_gold = np.zeros((2, 2))
    for t in range(1, longest):
        both = real[:, t]
        np.add.at(pair_gold, (gold[both, t - 1], gold[both, t]), 1)
    first_gold = np.bincount(gold[:, 0], minlength=2)
    theta = np.zeros(len(names) + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    last = real.sum(1) - 1
    for k in range(1, ROUNDS + 1):
        w, trans, first = theta[: len(names)], theta[len(names) : -2].reshape(2, 2), theta[-2:]
        score = np.bincount(block_of, w[feature_of], minlength=shape[0] * longest).reshape(shape)
        emit = np.stack([np.zeros(shape), score], 2)
        forward, backward = np.zeros((*shape, 2)), np.zeros((*shape, 2))
        forward[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            forward[:, t] = np.logaddexp(forward[:, t - 1, :1] + trans[0], forward[:, t - 1, 1:] + trans[1]) + emit[:, t]
        for t in range(longest - 2, -1, -1):
            ahead = emit[:, t + 1] + backward[:, t + 1]
            step = np.logaddexp(ahead[:, :1] + trans[:, 0], ahead[:, 1:] + trans[:, 1])
            backward[:, t] = np.where(real[:, t + 1, None], step, 0)
        end = forward[np.arange(shape[0]), last]
        total = np.logaddexp(end[:, 0], end[:, 1])
        marginal = np.exp(forward + backward - total[:, None, None])
        pairs = np.zeros((2, 2))
        for t in range(1, longest):
            both = real[:, t]
            x = forward[both, t - 1, :, None] + trans + (emit[both, t] + backward[both, t])[:, None, :] - total[both, None, None]
            pairs += np.exp(x).sum(0)
        off = np.where(real, marginal[:, :, 1] - gold, 0).ravel()
        grad = np.concatenate([np.bincount(feature_of, off[block_of], minlength=len(names)), (pairs - pair_gold).ravel(), marginal[:, 0].sum(0) - first_gold]) / shape[0] + RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Model(names, theta[: len(names)], theta[len(names) : -2].reshape(2, 2), theta[-2:])


def labelled_features(seeds: range) -> Iterator[tuple[list[list[str]], list[bool]]]:
    root = Context("")
    for seed in seeds:
        page, truth = labelled_page(seed)
        blocks = blocks_of(page, root)
        if [t for _, t, _ in blocks] != [t for t, _ in truth]:
            raise ValueError(f"labelled page {seed} is read otherwise than written")
        yield page_features(blocks), [y for _, y in truth]


@functools.cache
def default_model() -> Model:
    return fitted(list(labelled_features(range(LABELLED))))


def extracted(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())
    pages = own_columns(pages, ["page_id", "url", "html"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches, 2):
            texts = [shared.value.main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(scan, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")
