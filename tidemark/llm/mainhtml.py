"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into blocks of running text at block-level tags. Each block has features of its ancestors (what kind of
container it stands in) and of its text; the chain has two labels, main and other. Weights are fitted on labelled pages
by gradient steps on the exact log-likelihood (forward and backward sums) and pages are decoded by Viterbi.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages of the table that weights are fitted on, at most, and the longest of them in characters and blocks.
TRAIN_PAGES, TRAIN_CHARS, TRAIN_BLOCKS = 400, 100_000, 200
STEPS, PENALTY = 150, 0.01

#: Tags that end a block, whose content is no text, that have no end tag, and kinds of containers.
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
SILENT_TAGS = set("script style noscript template svg math iframe object textarea title select option datalist button canvas audio video".split())
VOID_TAGS = set("area base br col embed hr img input link meta source track wbr param".split())
OTHER_TAGS = set("nav aside footer form menu dialog fieldset".split())
MAIN_TAGS = {"article", "main"}
OTHER_ROLES = set("navigation complementary contentinfo banner search dialog alertdialog alert menu menubar toolbar form note".split())
OTHER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer discussion disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification pager pagination popup promo promotion recommended related replies reply respond search share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar widget".split()
)
COMMENT_NAMES = set("comment comments reply replies".split())
MAIN_NAMES = set("article content entry main post story".split())
#: A class or id with one of these words says how its element looks or what it allows, not what it holds.
STATE_NAMES = set(
    "allow allowed category closed disabled enabled format has is layout no off on open opened show status tag theme type with without".split()
)
#: Silent elements whose text runs to the end of the page if they are not closed.
RAW_TAGS = set("script style textarea title iframe".split())
NESTING_TAGS = set("svg template object noscript".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_BLOCK_EDGE = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK_TAGS))})(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_BLANKS = re.compile(r"\s+")
NONE, MAIN, OTHER = 0, 1, 2


@dataclass
class Block:
    text: str
    tag: str
    kind: int
    in_main: bool
    linked: int
    heads: bool


@dataclass
class _Open:
    tag: str
    kind: int
    in_main: bool
    link: bool
    heads: bool


def _kind(tag: str, attributes: str, in_main: bool) -> int:
    if tag in OTHER_TAGS or (tag == "header" and not in_main):
        return OTHER
    found = MAIN if tag in MAIN_TAGS else NONE
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                return OTHER
            if name == "role":
                if value in OTHER_ROLES:
                    return OTHER
                found = MAIN if value in ("main", "article") else found
            elif name in ("class", "id") and tag not in ("body", "html"):
                said = [set(re.split(r"[^a-z]+", x)) for x in value.split()]
                names = set().union(*(x for x in said if not x & STATE_NAMES))
                if tag in MAIN_TAGS:  # layouts name what stands beside an article on the article; only readers' comments are articles too
                    names &= COMMENT_NAMES
                if names & OTHER_NAMES or (not in_main and "header" in names):
                    return OTHER
                if names & MAIN_NAMES and tag not in ("span", "a", "p", *HEADINGS):
                    found = MAIN
    return found


def _silent_end(page: str, at: int, name: str) -> int:
    """Where a silent element that opened before ``at`` is over: after its end tag, or, if it has none before the next of its kind, at the next block."""
    over = re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I)
    if name in RAW_TAGS:
        ends = (m.end() for m in over.finditer(page, at) if m[1])
        return next(ends, len(page))
    depth = 1
    for m in over.finditer(page, at):
        depth += -1 if m[1] else 0 if m[0].endswith("/>") else 1
        if not depth:
            return m.end()
        if depth > 1 and name not in NESTING_TAGS:
            break
    m = _BLOCK_EDGE.search(page, at)
    return m.start() if m else len(page)


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order; white space is one blank, character references are decoded."""
    found: list[Block] = []
    stack = [_Open("", NONE, False, False, False)]
    parts: list[str] = []
    tag, linked, at = "", 0, 0

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = _BLANKS.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                top = stack[-1]
                found.append(Block(text, tag or top.tag, top.kind, top.in_main, min(linked, len(text)), top.heads))
        parts, linked = [], 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if stack[-1].link:
                linked += len(text)

    while m := _TOKEN.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        ends, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name == "br":
            say("\n")
            continue
        if name in BLOCK_TAGS:
            close()
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    del stack[depth:]
                    break
                if stack[depth].tag in BLOCK_TAGS and name not in BLOCK_TAGS:
                    break
            tag = stack[-1].tag
            continue
        if name in SILENT_TAGS:
            if not attributes.endswith("/"):
                at = _silent_end(page, at, name)
            continue
        if name in VOID_TAGS or attributes.endswith("/"):
            continue
        if name in BLOCK_TAGS:
            while len(stack) > 1 and (stack[-1].tag not in BLOCK_TAGS or stack[-1].tag == "p" or stack[-1].tag == name == "li"):
                stack.pop()
            tag = name
        up = stack[-1]
        kind = _kind(name, attributes, up.in_main)
        in_main = up.in_main or kind == MAIN
        if kind == MAIN and up.kind == OTHER:
            kind = NONE if name not in MAIN_TAGS else MAIN  # a named part of a side container is no article
            in_main = up.in_main or kind == MAIN
        stack.append(_Open(name, kind or up.kind, in_main, up.link or name == "a", up.heads or name in HEADINGS))
    say(page[at:])
    close()
    return found


#: Features, each 0 or 1.
NAMES = (
    "always", "main", "other", "none", "other_in_main", "none_beside_main", "none_alone", "heading", "paragraph", "item", "cell",
    "plain", "no_link", "some_link", "all_link", "words2", "words5", "words10", "words25", "words_more", "sentence", "comma",
    "copyright", "first", "last", "mid",
)
_AT = {n: i for i, n in enumerate(NAMES)}


def features(page: list[Block], containers: bool = True) -> np.ndarray:
    """(blocks, features); without ``containers`` the page looks as if no element said what it holds."""
    x = np.zeros((len(page), len(NAMES)), np.float64)
    has_main = containers and any(b.kind == MAIN for b in page)
    for i, b in enumerate(page):
        kind = b.kind if containers else NONE
        n = b.text.count(" ") + 1
        density = b.linked / len(b.text)
        names = ["always", ("none", "main", "other")[kind], "no_link" if density == 0 else "some_link" if density < 0.5 else "all_link"]
        names.append("words2" if n <= 2 else "words5" if n <= 5 else "words10" if n <= 10 else "words25" if n <= 25 else "words_more")
        names.append("heading" if b.heads else {"p": "paragraph", "blockquote": "paragraph", "pre": "paragraph", "li": "item", "dd": "item", "dt": "item", "td": "cell", "th": "cell"}.get(b.tag, "plain"))
        names.append("first" if 5 * i < len(page) else "last" if 5 * i >= 4 * len(page) else "mid")
        if kind == OTHER and b.in_main:
            names.append("other_in_main")
        if kind == NONE:
            names.append("none_beside_main" if has_main else "none_alone")
        if b.text[-1] in ".!?…»”\"'":
            names.append("sentence")
        if "," in b.text:
            names.append("comma")
        if "©" in b.text or "(c)" in b.text:
            names.append("copyright")
        x[i, [_AT[f] for f in names]] = 1
    return x


@dataclass
class Chain:
    """Weights: (labels, features), start of a label, and (label before, label)."""

    emit: np.ndarray = field(default_factory=lambda: np.zeros((2, len(NAMES))))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, x: np.ndarray) -> list[int]:
        """Viterbi: the most likely labels."""
        scores = (x @ self.emit.T).tolist()
        (a, b), ((s00, s01), (s10, s11)) = (self.start + scores[0]).tolist(), self.step.tolist()
        back = []
        for e0, e1 in scores[1:]:
            from0, from1 = a + s00 >= b + s10, a + s01 >= b + s11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = (a + s00 if from0 else b + s10) + e0, (a + s01 if from1 else b + s11) + e1
        labels = [0 if a >= b else 1]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]

    def vector(self) -> np.ndarray:
        return np.concatenate([self.emit.ravel(), self.start, self.step.ravel()])

    @staticmethod
    def of(v: np.ndarray) -> Chain:
        n = 2 * len(NAMES)
        return Chain(v[:n].reshape(2, -1), v[n : n + 2], v[n + 2 :].reshape(2, 2))


def fit(pages: list[tuple[np.ndarray, np.ndarray, float]], steps: int = STEPS) -> Chain:
    """Weights of the greatest penalised likelihood of (features, labels, weight), by Adam over all pages at once."""
    pages = [p for p in pages if len(p[0])]
    if not pages:
        return Chain()
    n, longest = len(pages), max(len(x) for x, _, _ in pages)
    x = np.zeros((n, longest, len(NAMES)))
    y = np.zeros((n, longest), np.int64)
    there = np.zeros((n, longest), bool)
    for i, (f, labels, _) in enumerate(pages):
        x[i, : len(f)], y[i, : len(f)], there[i, : len(f)] = f, labels, True
    weight = np.array([w for _, _, w in pages])
    weight = weight / weight.sum()
    known = np.eye(2)[y] * there[..., None]
    chain, m, v = Chain().vector(), 0.0, 0.0
    for t in range(1, steps + 1):
        c = Chain.of(chain)
        score = x @ c.emit.T
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = c.start + score[:, 0]
        for k in range(1, longest):
            new = np.logaddexp(ahead[:, k - 1, :1] + c.step[0], ahead[:, k - 1, 1:] + c.step[1]) + score[:, k]
            ahead[:, k] = np.where(there[:, k, None], new, ahead[:, k - 1])
        behind = np.zeros((n, longest, 2))
        for k in range(longest - 2, -1, -1):
            onward = score[:, k + 1] + behind[:, k + 1]
            new = np.logaddexp(c.step[:, 0] + onward[:, :1], c.step[:, 1] + onward[:, 1:])
            behind[:, k] = np.where(there[:, k + 1, None], new, 0.0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])[:, None, None]
        share = np.exp(ahead + behind - total) * there[..., None]
        pairs = ahead[:, :-1, :, None] + c.step + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[..., None]
        pairs = np.exp(pairs) * there[:, 1:, None, None]
        real = known[:, :-1, :, None] * known[:, 1:, None, :]
        gap = (share - known) * weight[:, None, None]
        gradient = np.concatenate([
            np.einsum("nkl,nkf->lf", gap, x).ravel(), gap[:, 0].sum(axis=0), ((pairs - real) * weight[:, None, None, None]).sum(axis=(0, 1)).ravel(),
        ]) + PENALTY * chain
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        chain = chain - 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Chain.of(chain)


#: Hand-labelled pages for what a table's pages may lack: text between ¶ marks is main.
LABELLED = (
    "<body><header><div>Daily Paper</div><nav><a>Home</a><a>World</a></nav></header><div class='cookie-notice'><p>We use cookies, as you know.</p></div>"
    "<main><h1>¶A bridge opens</h1><p>¶The new bridge over the river was opened on Monday, after years of work.</p><p>¶It is long.</p>"
    "<div class='share'>Share this</div><p>¶Trains will follow in the spring, the mayor said.</p>"
    "<section id='comments'><p>I have waited for this bridge for ten years, well done.</p><p>Too expensive, if you ask me.</p></section></main>"
    "<aside><h2>Related</h2><p>The old bridge will be closed next year, officials say.</p></aside><form>Your mail <p>Subscribe now, it is free.</p></form><footer>© Daily Paper</footer></body>",
    "<body><div>Home</div><div><a>News</a> <a>Sport</a></div><h1>¶How to bake bread</h1><p>¶Mix flour, water, salt and yeast, and let the dough rest for an hour.</p>"
    "<p>¶Then bake it in a hot oven until the crust is brown, about forty minutes in all.</p><ul><li>¶Flour, half a kilogram of it, as fine as you like.</li></ul><div><a>About us</a></div><div>© Bakers</div></body>",
    "<body><div id='header'>My Blog</div><div class='sidebar'><p>I write about plants, birds and the weather here.</p></div><div id='content'>"
    "<h2>¶Rain</h2><p>¶It rained.</p><p>¶All day long, the garden was under water and the birds were quiet.</p><div class='ad'>Buy boots, they are cheap this week.</div></div><div id='footer'><p>All rights reserved, by me.</p></div></body>",
)


def _labelled() -> list[tuple[np.ndarray, np.ndarray, float]]:
    rows = []
    for page in LABELLED:
        found = blocks(page)
        labels = np.array([b.text.startswith("¶") for b in found], np.int64)
        for b in found:
            b.text = b.text.lstrip("¶")
        rows += [(features(found), labels, 6.0), (features(found, False), labels, 2.0)]
    return rows


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights from the sample. A page that marks its article labels its own blocks; a copy of it without marks teaches the text."""
    rows = _labelled()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            found = blocks(page)
            if any(b.kind == MAIN for b in found) and len(found) <= TRAIN_BLOCKS:
                labels = np.array([b.kind == MAIN for b in found], np.int64)
                rows += [(features(found), labels, 1.0), (features(found, False), labels, 0.3)]
    yield pa.RecordBatch.from_arrays([pa.array([fit(rows).vector().tobytes()], pa.binary())], names=["weights"])


def train(pages: DataFrame) -> Chain:
    """Weights from ``TRAIN_PAGES`` pages with the least hash of their id, and from ``LABELLED``; fitted in one task."""
    sample = pages.select(F.col("page_id").alias("id"), F.col("html").cast("string").alias("html")).where(F.length("html") <= TRAIN_CHARS)
    sample = sample.orderBy(F.xxhash64("id"), "html").limit(TRAIN_PAGES).select("html").repartition(1).sortWithinPartitions("html")
    row = sample.mapInArrow(_learn, "weights binary").first()
    return Chain.of(np.frombuffer(row.weights)) if row else fit(_labelled())


def main_text(page: str | None, chain: Chain) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n".join(b.text for b, label in zip(found, chain.decode(features(found)), strict=True) if label)


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    text: the main blocks joined by a line feed, from the whole html; empty if there is none or html is NULL.
    n_chars: its code points. Repeated rows give equal rows; NULL ids and urls stay; other columns are left out.
    """
    chain = chain or train(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x.as_py(), chain) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
