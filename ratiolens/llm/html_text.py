"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks: runs of text between block-level tags, in page order.
Each block has features from its ancestors (tags, class and id words) and its text
(length, links, end sign, place on the page); a chain of two labels, main or not, runs
over the blocks. The field is trained by gradient on labelled pages and decoded by
Viterbi.

Labelled pages are made from a bounded sample of the table, at most ``TRAIN_PAGES`` pages
that mark their article, in the order of a hash until they have ``TRAIN_BLOCKS`` blocks:
as found, and rebuilt ``VARIANTS`` times with other wrappers, with the article's text as
paragraphs, lists, tables, code, quotes, figures and definitions, and with added menus,
notices, sidebars, forms and reader comments, whose texts come from other pages, so that
the labels are known and texts give nothing away. A page of any length trains with all
its blocks, cut into chains of ``CHAIN``, each of which knows the label before it.

Defined results: a null or empty page, or one without main blocks, has the empty text;
a null id is carried; repeated rows are extracted each; where no sampled page marks an
article, what is outside known boilerplate tags counts as its article in training; a
table without any text trains nothing and gives empty texts; an empty table gives an
empty result; other columns are ignored. Broken markup never fails: unknown end tags are
skipped, unclosed ones end with what holds them.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, slices

TRAIN_PAGES = 120
#: The page that passes this number of blocks is the last one that trains.
TRAIN_BLOCKS = 8_000
VARIANTS = 6
CHAIN = 64
STEPS = 120

#: Element names of HTML by their role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "iframe label legend li main menu nav noscript object ol optgroup option p pre search section "
    "select summary table tbody td template textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW_TAGS = ("script", "style")
CLOSES_P = BLOCK_TAGS - {"body", "html", "head", "label", "button", "option"}
BOILERPLATE_TAGS = frozenset(
    "aside button dialog footer form head header iframe label menu nav noscript object option "
    "select template textarea title".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>script|style)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^>]*>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
NOT_LETTERS = re.compile(r"[^a-z]+")


def _names(attrs: str) -> tuple[str, ...]:
    """Words of an element's class, id and role, without plural ends."""
    words = []
    for found in NAMED.findall(attrs):
        plain = re.sub(r"([a-z])([A-Z])", r"\1 \2", " ".join(found))
        words += NOT_LETTERS.split(plain.lower())
    return tuple(sorted({w.removesuffix("s") for w in words if w}))


@dataclass
class Block:
    path: tuple  # of (tag, class words), outermost first
    text: str
    linked: int  # characters in links
    label: int | None = None


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page that have text."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links = 0, 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Block(tuple(stack), text, linked))
            parts.clear()
        linked = 0

    for token in TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            parts.append(text)
            if links:
                linked += len(text)
            continue
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        block = name in BLOCK_TAGS
        if token["end"]:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if block:
                close()
            if at is not None:
                del stack[at:]
                if name == "a":
                    links = max(0, links - 1)
            if block:
                links = sum(1 for tag, _ in stack if tag == "a")
        elif name in VOID_TAGS:
            if block:
                close()
            else:
                parts.append(" ")
        else:
            if block:
                close()
                at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"), None)
                if name in CLOSES_P and at is not None:
                    del stack[at:]
                    links = sum(1 for tag, _ in stack if tag == "a")
            attrs = token["attrs"]
            stack.append((name, _names(attrs) if "=" in attrs else ()))
            if name == "a":
                links += 1
    close()
    return found


def path_features(path: tuple) -> list[str]:
    tags = {tag for tag, _ in path}
    words = {w for _, some in path for w in some}
    block = next((tag for tag, _ in reversed(path) if tag in BLOCK_TAGS), "")
    return [
        *(f"t:{t}" for t in tags),
        *(f"c:{w}" for w in words),
        f"p:{block}",
        *["boilerplate"] * bool(tags & BOILERPLATE_TAGS),
    ]


def text_features(blocks: list[Block], k: int) -> list[str]:
    block, last = blocks[k], len(blocks) - 1
    size = len(block.text)
    return [
        f"n:{size.bit_length()}",
        f"l:{min(4, 5 * block.linked // size)}",
        "end" if block.text[-1] in ".!?…»”\"" else "open",
        f"at:{4 * k // (last + 1)}",
        *["first"] * (k == 0),
        *["last"] * (k == last),
        *["sign"] * any(c in "©®|" for c in block.text[:40]),
    ]


@dataclass
class Field:
    """Weights of the label main against not, and the scores of label changes."""

    weights: dict[str, float]
    moves: tuple[tuple[float, float], tuple[float, float]]
    starts: tuple[float, float]
    by_path: dict[tuple, float] = field(default_factory=dict)

    def scores(self, blocks: list[Block]) -> list[float]:
        out = []
        for k, block in enumerate(blocks):
            base = self.by_path.get(block.path)
            if base is None:
                if len(self.by_path) > 20_000:
                    self.by_path.clear()
                base = sum(self.weights.get(f, 0.0) for f in path_features(block.path))
                self.by_path[block.path] = base
            out.append(base + sum(self.weights.get(f, 0.0) for f in text_features(blocks, k)))
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """Viterbi: the best label sequence."""
        if not blocks:
            return []
        (stay0, to1), (to0, stay1) = self.moves
        scores = self.scores(blocks)
        zero, one = self.starts[0], self.starts[1] + scores[0]
        back = []
        for score in scores[1:]:
            from0 = (0, zero + stay0) if zero + stay0 >= one + to0 else (1, one + to0)
            from1 = (0, zero + to1) if zero + to1 > one + stay1 else (1, one + stay1)
            back.append((from0[0], from1[0]))
            zero, one = from0[1], from1[1] + score
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]


def train(pages: list[list[Block]], steps: int = STEPS, ridge: float = 0.02) -> Field:
    """Gradient ascent on the penalised likelihood, all chains side by side.

    A page longer than ``CHAIN`` is cut into chains; one that goes on starts from the
    change of label that its first block makes, so every block and change counts once.
    """
    names: dict[str, int] = {}
    chains = [(page, at) for page in pages for at in range(0, len(page), CHAIN)]
    if not chains:
        return Field({}, ((0.0, 0.0), (0.0, 0.0)), (0.0, 0.0))
    long = max(min(CHAIN, len(page) - at) for page, at in chains)
    labels = np.zeros((len(chains), long), dtype=np.int64)
    mask = np.zeros((len(chains), long))
    before = np.full(len(chains), -1)
    rows, columns = [], []
    for i, (page, at) in enumerate(chains):
        if at:
            before[i] = page[at - 1].label
        for k, block in enumerate(page[at : at + CHAIN]):
            labels[i, k], mask[i, k] = block.label, 1
            for name in {*path_features(block.path), *text_features(page, at + k)}:
                rows.append(i * long + k)
                columns.append(names.setdefault(name, len(names)))
    rows, columns = np.array(rows), np.array(columns)
    weights, moves, starts = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    params = [weights, moves, starts]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    both = mask[:, 1:] > 0
    begins, goes_on = before < 0, before >= 0
    pair = np.zeros((2, 2))
    np.add.at(pair, (labels[:, :-1][both], labels[:, 1:][both]), 1)
    np.add.at(pair, (before[goes_on], labels[goes_on, 0]), 1)
    begin = np.bincount(labels[begins, 0], minlength=2).astype(float)

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis)
        return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))

    for step in range(1, steps + 1):
        score = np.bincount(rows, weights=weights[columns], minlength=mask.size).reshape(mask.shape)
        emit = np.stack([np.zeros_like(score), score], axis=2)
        ahead = np.zeros((len(chains), long, 2))
        behind = np.zeros((len(chains), long, 2))
        ahead[:, 0] = np.where(begins[:, None], starts, moves[before]) + emit[:, 0]
        for k in range(1, long):
            new = total(ahead[:, k - 1, :, None] + moves[None], 1) + emit[:, k]
            ahead[:, k] = np.where(mask[:, k, None] > 0, new, ahead[:, k - 1])
        for k in range(long - 2, -1, -1):
            new = total(moves[None] + (emit[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
            behind[:, k] = np.where(mask[:, k + 1, None] > 0, new, behind[:, k + 1])
        norm = total(ahead[:, -1], 1)
        chance = np.exp(ahead + behind - norm[:, None, None]) * mask[:, :, None]
        edge = np.exp(
            ahead[:, :-1, :, None]
            + moves[None, None]
            + (emit[:, 1:] + behind[:, 1:])[:, :, None, :]
            - norm[:, None, None, None]
        )
        expected = (edge * both[:, :, None, None]).sum(axis=(0, 1))
        np.add.at(expected, before[goes_on], chance[goes_on, 0])
        grads = [
            np.bincount(columns, weights=(labels * mask - chance[:, :, 1]).ravel()[rows], minlength=len(names))
            - ridge * weights,
            pair - expected - ridge * moves,
            begin - chance[begins, 0].sum(axis=0) - ridge * starts,
        ]
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(
        {n: float(weights[k]) for n, k in names.items()},
        tuple(map(tuple, moves.tolist())),
        tuple(starts.tolist()),
    )


#: Words for wrappers and boilerplate of the rebuilt pages.
MAIN_NAMES = (
    "content", "post", "entry", "story", "article-body", "main-text", "post-content", "body-text",
    "entry-content", "page-content", "text", "single", "blog-post", "article",
)
BOILERPLATE = {
    "menu": ("menu", "nav", "navigation", "navbar", "main-menu", "top-links", "breadcrumbs", "tabs"),
    "header": ("header", "site-header", "masthead", "top", "banner", "branding"),
    "side": ("sidebar", "side", "related", "widget", "more-stories", "recommended", "popular", "tags"),
    "notice": ("cookie-notice", "cookie", "consent", "notice", "alert", "gdpr", "popup", "modal", "message"),
    "ad": ("ad", "ads", "advert", "sponsored", "promo", "ad-box", "advertisement", "banner-ad", "sponsor"),
    "form": ("newsletter", "subscribe", "signup", "search", "login", "contact-form"),
    "comments": ("comments", "comment-list", "disqus", "responses", "discussion", "replies", "reader-comments"),
    "share": ("share", "social", "byline-links", "pagination", "print"),
    "footer": ("footer", "site-footer", "copyright", "legal", "bottom", "imprint"),
}


BOILERPLATE_WORDS = frozenset(
    w for some in BOILERPLATE.values() for n in some if "-" not in n for w in _names(f'class="{n}"')
)


def _boilerplate(kind: str, say, rng: random.Random) -> list[tuple[tuple, str, int]]:
    """Blocks (path below the page, text, linked characters) of one piece of boilerplate."""
    name = rng.choice(BOILERPLATE[kind])
    words = _names(f'class="{name}"')
    tag = {
        "menu": ("nav", "div", "ul"),
        "header": ("header", "div"),
        "side": ("aside", "div", "section"),
        "notice": ("div", "section", "dialog", "p"),
        "ad": ("div", "aside", "section", "p"),
        "form": ("form", "div"),
        "comments": ("section", "div", "ol", "ul", "article"),
        "share": ("div", "ul", "p"),
        "footer": ("footer", "div"),
    }[kind]
    outer = (rng.choice(tag), words if rng.random() < 0.8 or "div" in tag[:1] else ())
    if outer[0] in ("div", "section", "p", "ol", "ul", "article") and not outer[1]:
        outer = (outer[0], words)
    out = []
    if kind in ("menu", "share"):
        for _ in range(rng.randint(2, 8)):
            text = " ".join(say().split()[: rng.randint(1, 3)]) or "Home"
            out.append(((outer, ("ul", ()), ("li", ()), ("a", ())), text, len(text)))
    elif kind == "comments":
        for _ in range(rng.randint(1, 6)):
            inner = (rng.choice(("div", "li", "article")), _names(f'class="{rng.choice(("comment", "reply", ""))}"'))
            out.append(((outer, inner, ("p", ())), say(), 0))
    elif kind == "form":
        for _ in range(rng.randint(1, 3)):
            text = " ".join(say().split()[: rng.randint(1, 12)])
            out.append(((outer, (rng.choice(("label", "p", "button", "span")), ())), text, 0))
    else:
        for _ in range(rng.randint(1, 3)):
            text = say() if kind in ("side", "ad", "notice") else " ".join(say().split()[:8])
            linked = len(text) if kind == "side" and rng.random() < 0.5 else 0
            inner = rng.choice((("p", ()), ("div", ()), ("li", ())))
            out.append(((outer, inner) if rng.random() < 0.6 else (outer,), text, linked))
        if kind == "footer":
            out[0] = (out[0][0], "© " + out[0][1], 0)
    return [x for x in out if x[1]]


def labelled(page: str, marked: bool = True) -> list[Block]:
    """A page's blocks with labels from its own markup; [] if it does not mark an article.

    With ``marked`` off, all that is outside known boilerplate counts as the article.
    """
    blocks = blocks_of(page)
    for block in blocks:
        tags = [tag for tag, _ in block.path]
        words = {w for _, some in block.path for w in some}
        inside = not marked or "article" in tags or "main" in tags
        block.label = int(inside and not set(tags) & BOILERPLATE_TAGS and not words & BOILERPLATE_WORDS)
    return blocks if any(b.label for b in blocks) else []


def _shaped(block: Block, kind: str, rng: random.Random) -> list[tuple[tuple, str]]:
    """A main block's text as another kind of block, or several: (path inside the article, text)."""
    words = block.text.split()

    def cut(least: int, most: int, parts: int) -> list[str]:
        out, at = [], 0
        while at < len(words) and len(out) < parts:
            size = rng.randint(least, most)
            out.append(" ".join(words[at : at + size]))
            at += size
        return out

    if kind == "list":
        outer = (rng.choice(("ul", "ol")), ())
        inner = (("li", ()),) + (("p", ()),) * (rng.random() < 0.2)
        most = rng.choice((2, 8, 25))
        return [((outer, *inner), text) for text in cut(1, most, rng.randint(2, 40))]
    if kind == "table":
        base = (("table", ()),) + ((rng.choice(("tbody", "thead")), ()),) * (rng.random() < 0.6)
        cell = rng.choice(("td", "td", "th"))
        return [((*base, ("tr", ()), (cell, ())), text) for text in cut(1, 5, rng.randint(2, 24))]
    if kind == "terms":
        return [
            ((("dl", ()), (("dt", "dd")[k % 2], ())), text)
            for k, text in enumerate(cut(1, 10, rng.randint(2, 12)))
        ]
    if kind == "heading":
        return [(((f"h{rng.randint(2, 6)}", ()),), " ".join(words[: rng.randint(1, 9)]))]
    path = {
        "code": rng.choice(((("pre", ()),), (("pre", ()), ("code", ())))),
        "quote": rng.choice(((("blockquote", ()),), (("blockquote", ()), ("p", ())))),
        "figure": (("figure", ()), ("figcaption", ())),
        "section": (("section", ()), ("p", ())),
        "box": rng.choice(((("div", ()),), (("div", ()), ("p", ())), (("details", ()), ("summary", ())))),
    }[kind]
    short = kind in ("figure", "code") and rng.random() < 0.5
    return [(path, " ".join(words[: rng.randint(1, 12)]) if short else block.text)]


#: Kinds of main blocks besides paragraphs.
KINDS = ("list", "table", "terms", "heading", "code", "quote", "figure", "section", "box")


def rebuilt(blocks: list[Block], texts: list[str], rng: random.Random) -> list[Block]:
    """A page with the same main blocks in other wrappers, among boilerplate of all kinds."""
    frame = (("html", ()), ("body", ()))
    shell = ((rng.choice(("div", "section")), _names('class="{}"'.format(rng.choice(("wrapper", "page", "container", "")))) ),)
    wrap = rng.choice(
        (
            (("article", ()),),
            (("main", ()), ("article", ())),
            (("main", ()),),
            (("div", _names(f'class="{rng.choice(MAIN_NAMES)}"')),),
            (("div", ()), ("div", _names(f'id="{rng.choice(MAIN_NAMES)}"'))),
            (("div", ()),),
            (("article", _names(f'class="{rng.choice(MAIN_NAMES)}"')),),
        )
    )
    base = frame + shell * rng.randint(0, 1)

    def say() -> str:
        return rng.choice(texts)

    def extra(kind: str, at: tuple) -> list[Block]:
        return [Block(at + p, t, n, 0) for p, t, n in _boilerplate(kind, say, rng)]

    head = [b for b in blocks if "head" in {t for t, _ in b.path}]
    page = [Block(b.path, b.text, b.linked, 0) for b in head]
    for kind in ("notice", "header", "menu", "ad", "side"):
        if rng.random() < 0.6:
            page += extra(kind, base)
    inside = base + wrap
    # paragraphs mostly, a mixture of kinds, or one kind for the whole article
    mixture = rng.choice((0.0, 0.3, 0.7, 1.0))
    kinds = rng.choice((KINDS, KINDS, (rng.choice(KINDS),)))
    for block in blocks:
        if not block.label:
            continue
        own = next((t for t, _ in reversed(block.path) if t in BLOCK_TAGS), "p")
        own = own if own not in ("article", "main", "div", "body") else "p"
        if own != "h1" and rng.random() < mixture:
            parts = _shaped(block, rng.choice(kinds), rng)
            page += [Block(inside + path, text, 0, 1) for path, text in parts]
        else:
            page.append(Block((*inside, (own, ())), block.text, block.linked, 1))
        if rng.random() < 0.08:
            page += extra(rng.choice(("ad", "form", "share", "side", "notice")), inside)
    if rng.random() < 0.5:
        page += extra("comments", rng.choice((inside, base)))
    for kind in ("share", "form", "comments", "side", "ad", "footer", "notice"):
        if rng.random() < 0.4:
            page += extra(kind, base)
    return page


def sample_pages(pages: DataFrame, id_col: str, html_col: str) -> list[str]:
    """The pages with the smallest hashes, at most ``TRAIN_PAGES``; only their hashes are sorted."""
    text = F.col(f"`{html_col}`").cast("string")
    source = pages.select(
        F.xxhash64(F.col(f"`{id_col}`"), text).alias("print"), text.alias("html")
    ).where("html IS NOT NULL")
    prints = source.select("print").distinct().orderBy("print").limit(TRAIN_PAGES).collect()
    chosen = source.where(F.col("print").isin([r.print for r in prints]))
    rows = chosen.groupBy("print").agg(F.min("html").alias("html")).orderBy("print").collect()
    return [r.html for r in rows]


def training_pages(found: list[str], rng: random.Random) -> list[list[Block]]:
    """Labelled pages up to ``TRAIN_BLOCKS`` blocks, as they are and rebuilt."""
    pages = [p for p in map(labelled, found) if p]
    pages = pages or [p for p in (labelled(x, marked=False) for x in found) if p]
    kept, blocks = [], 0
    for page in pages:
        kept.append(page)
        blocks += len(page)
        if blocks >= TRAIN_BLOCKS:
            break
    texts = [b.text for p in kept for b in p if b.label]
    return kept + [rebuilt(p, texts, rng) for p in kept for _ in range(VARIANTS)]


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Field:
    """The field trained on pages made from a bounded sample of the table."""
    ship_package(pages.sparkSession)
    return train(training_pages(sample_pages(pages, id_col, html_col), random.Random(7)))


def main_text(field: Field, page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, label in zip(blocks, field.decode(blocks), strict=True) if label)


def _extract(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 8 << 20):
            texts = [main_text(field, p) for p in batch.column("html").to_pylist()]
            rest = [n for n in batch.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in rest), pa.array(texts, pa.string())], [*rest, "text"]
            )

    return run


def extract(
    field: Field, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per page: id, url, text and n_chars."""
    ship_package(pages.sparkSession)
    source = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").cast("string").alias("html"),
    )
    kinds = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in ("page_id", "url"))
    done = source.mapInArrow(_extract(field), f"{kinds}, text string")
    return done.withColumn("n_chars", F.char_length("text").cast("long")).withColumnsRenamed(
        {"page_id": id_col, "url": url_col}
    )
