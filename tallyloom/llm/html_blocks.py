"""HTML extraction: a bidirectional LSTM labels every block of a page by its place among all others."""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import lstm
from tallyloom.llm.common import batches, table

# Elements that don't break a line, that never close, and whose text is no text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style noscript template svg math iframe object".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
DRAWN, HTML_IN_DRAWN = frozenset("svg math".split()), frozenset("foreignobject desc title annotation-xml mtext".split())
ENDS_DRAWN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

PATH_DIMS, NAME_DIMS, WORD_DIMS, ENDS_DIMS, DENSE = 48, 48, 24, 24, 6
WIDTH = PATH_DIMS + NAME_DIMS + WORD_DIMS + ENDS_DIMS + DENSE
FIRST, LAST = 6, 4  # words that also count as a block's beginning and end
SAMPLE_PAGES, SAMPLE_CHARS, SAMPLE_BLOCKS, MADE_PAGES = 150, 200_000, 300, 450  # bounds of what the labeller is fitted on
TOGETHER = 64  # pages whose blocks are labelled at once


class Blocks(HTMLParser):
    """The page's leaf sequence: (path, text, characters in links); path: (tag, names) from the root.

    Ends that a page may leave out are put in where a browser puts them: a head ends at the
    first element or text that it can't hold, a drawing at the first element of running text.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.path: list[tuple[str, tuple[str, ...]]] = []
        self.out: list[tuple[tuple, str, int]] = []
        self.parts: list[str] = []
        self.linked = self.links = self.unseen = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.out.append((tuple(p for p in self.path if p[0] not in INLINE), text, min(self.linked, len(text))))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.unseen:
            self._end_left_out(tag)
        if tag not in INLINE:
            self.flush()
        for inner in CLOSES.get(tag, {"p"} if tag in ENDS_P else ()):
            if self.path and any(t == inner for t, _ in self._near(tag)):
                self._close(inner)
        if tag in VOID:
            return
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role", "itemprop"))
        self.path.append((tag, tuple(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()))))
        self.unseen += tag in UNSEEN
        self.links += tag == "a"

    def _end_left_out(self, tag: str) -> None:
        """Close a drawing or a head that can't hold such an element."""
        inner = next((t for t, _ in reversed(self.path) if t in DRAWN or t in HTML_IN_DRAWN), None)
        while inner in DRAWN and (tag in ENDS_DRAWN or tag in ENDS_P):
            self._close(inner)
            inner = next((t for t, _ in reversed(self.path) if t in DRAWN or t in HTML_IN_DRAWN), None)
        if self.path and self.path[-1][0] == "head" and tag not in IN_HEAD:
            self._close("head")

    def _near(self, tag: str) -> list:
        """What is open inside the closest element that keeps such a tag."""
        holders = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}.get(tag, ("td", "th", "li", "div", "article", "section"))
        for n in range(len(self.path) - 1, -1, -1):
            if self.path[n][0] in holders:
                return self.path[n + 1 :]
        return self.path

    def _close(self, tag: str) -> None:
        for n in range(len(self.path) - 1, -1, -1):
            if self.path[n][0] == tag:
                for t, _ in self.path[n:]:
                    self.unseen -= t in UNSEEN
                    self.links -= t == "a"
                del self.path[n:]
                return

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.path and self.path[-1][0] == "head" and not data.isspace():
            self._close("head")
        if not self.unseen:
            self.parts.append(data)
            self.linked += len(data) if self.links else 0


def blocks_of(html: str) -> list[tuple[tuple, str, int]]:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.out


def _put(out: np.ndarray, first: int, dims: int, word: str, amount: float) -> None:
    h = zlib.crc32(word.encode())
    out[first + h % dims] += amount if h & 0x10000 else -amount
    h = zlib.crc32(word.encode(), 99)
    out[first + h % dims] += amount if h & 0x10000 else -amount


class Words(dict):
    """Places of words in a table of hashed vectors; of bounded number."""

    table = np.zeros((4 * WORD_DIMS * WORD_DIMS, WORD_DIMS))  # of all pairs of two signed dimensions
    for n in range(len(table)):
        for side in divmod(n, 2 * WORD_DIMS):
            table[n, side >> 1] += 1 if side & 1 else -1

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        low, sides = word.lower().encode("utf-8", "replace"), 2 * WORD_DIMS
        self[word] = found = zlib.crc32(low) % sides * sides + zlib.crc32(low, 99) % sides
        return found


class Vectors(dict):
    """Hashed vectors of whole paths, kept for the paths of a task, of bounded number."""

    def __init__(self) -> None:
        super().__init__()
        self.words = Words()

    def __missing__(self, path: tuple) -> np.ndarray:
        if len(self) > 20_000:
            self.clear()
        own = np.zeros(PATH_DIMS + NAME_DIMS)
        for depth, (tag, names) in enumerate(path):
            _put(own, 0, PATH_DIMS, tag, 1.0)
            if depth == len(path) - 1:
                _put(own, 0, PATH_DIMS, f"{tag}!", 1.0)
            for name in names:
                _put(own, PATH_DIMS, NAME_DIMS, name, 1.0)
        self[path] = own = np.clip(own, -3, 3)
        return own


def _sum_of(at: np.ndarray) -> np.ndarray:
    """Sum of the table's rows at these places; each 4096 words at once."""
    return sum((Words.table[at[k : k + 4096]].sum(axis=0) for k in range(0, len(at), 4096)), np.zeros(WORD_DIMS))


def vectors(blocks: list[tuple[tuple, str, int]], memo: Vectors) -> np.ndarray:
    """A row for each block: hashed path and names, all its words hashed, its first and last ones, and what its text looks like."""
    out = np.zeros((len(blocks), WIDTH))
    for n, (path, text, linked) in enumerate(blocks):
        words = text.split(" ")
        at = np.fromiter(map(memo.words.__getitem__, words), np.int64, len(words))
        own = out[n]
        own[: PATH_DIMS + NAME_DIMS] = memo[path]
        own[-DENSE - ENDS_DIMS - WORD_DIMS : -DENSE - ENDS_DIMS] = _sum_of(at) * (0.5 / len(words) ** 0.5)
        own[-DENSE - ENDS_DIMS : -DENSE] = _sum_of(np.concatenate([at[:FIRST], at[-LAST:]])) * 0.15
        own[-DENSE:] = (np.log1p(len(words)) / 3, linked / len(text), text[-1] in ".!?", sum(map(text.count, ".,;")) / len(words), n / len(blocks), len(path) / 10)
    return out


# Names by which pages of all kinds mark what is not their article.
AROUND = {
    "nav": ["menu", "navbar", "nav", "main-menu", "breadcrumb", "breadcrumbs"],
    "header": ["header", "masthead", "site-header", "topbar", "logo"],
    "aside": ["sidebar", "related", "widget", "side-bar", "popular", "recommended"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner"],
    "notice": ["cookie-notice", "cookie-banner", "notice", "alert", "consent", "gdpr", "popup", "disclaimer"],
    "comments": ["comments", "comment", "comment-list", "responses", "discussion", "replies"],
    "form": ["search", "newsletter", "subscribe", "signup", "login", "contact-form"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom"],
    "share": ["share", "social", "tags", "pagination", "meta", "byline"],
}
HOLDERS = [("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("main", "content"), ("div", "content"), ("div", "post-body"), ("div", "article-body"), ("div", "entry-content"), ("section", "story"), ("div", "main-text"), ("div", "")]
APART = frozenset("nav aside footer header form menu button select textarea fieldset dialog".split())
APART_NAMES = frozenset(w for names in AROUND.values() for n in names for w in n.split("-")) - {"main", "site", "list", "bar", "bottom", "meta", "side"}


def marked(path: tuple) -> bool:
    """The teacher of real pages: inside an article or main element, not inside what it sets apart."""
    tags = [t for t, _ in path]
    inside = next((n for n, t in enumerate(tags) if t in ("article", "main")), None)
    return inside is not None and not any(t in APART or APART_NAMES.intersection(names) for t, names in path[inside:])


def made_page(pool: list[str], rng: random.Random) -> list[tuple[tuple, str, int, bool]]:
    """Labelled blocks of a page in a layout drawn at random, from texts of the sampled pages."""
    holes: list[str] = []
    keep: list[bool] = []

    def some(least: int, most: int) -> str:
        words = rng.choice(pool).split()
        n = min(len(words), rng.randint(least, most))
        i = rng.randrange(len(words) - n + 1)
        return escape(" ".join(words[i : i + n]))

    def put(html: str, good: bool) -> None:
        holes.append(html)
        keep.append(good)

    def named(tag: str, name: str) -> str:
        return f'<{tag} {rng.choice(("class", "class", "id"))}="{name}">' if name else f"<{tag}>"

    page = ["<html><body>"]

    def leaf(html: str, good: bool) -> None:
        page.append(html.replace("\0", f"\1{len(holes)}\2"))
        put("", good)

    def around(kind: str) -> None:
        name = rng.choice(AROUND[kind])
        own = {"nav": "nav", "header": "header", "aside": "aside", "footer": "footer", "form": "form", "comments": "section"}.get(kind, "div")
        tag = own if rng.random() < 0.5 else rng.choice(("div", "section", "ul") if kind in ("nav", "share") else ("div", "section"))
        plain = tag == own and own != "div" and own != "section" and rng.random() < 0.6
        page.append(named(tag, "" if plain else name))
        if kind in ("nav", "share", "footer", "header") and rng.random() < 0.8:
            page.append("<ul>")
            for _ in range(rng.randint(2, 7)):
                leaf(f'<li><a href="#">{some(1, 3)}\0</a></li>', False)
            page.append("</ul>")
        else:
            for _ in range(rng.randint(1, 5) if kind in ("comments", "aside") else rng.randint(1, 2)):
                inner = rng.choice(("p", "div", "li", "span", ""))
                wrap = '<div class="comment">' if kind == "comments" and rng.random() < 0.5 else ""
                if kind == "form":
                    leaf(f"<label>{some(1, 4)}\0</label><input type=text><br>", False)
                elif inner:
                    leaf(f"{wrap}<{inner}>{some(2, 40)}\0</{inner}>" + ("</div>" if wrap else "<br>"), False)
                else:
                    leaf(f"{some(2, 25)}\0<br>", False)
        page.append(f"</{tag}>")

    for kind in rng.sample(("nav", "header", "ad", "notice", "form", "share"), rng.randint(1, 4)):
        around(kind)
    if rng.random() < 0.3:
        around("aside")
    wrapped = rng.random() < 0.5
    page.append(rng.choice(("<div>", '<div id="wrapper">', '<div class="container">')) if wrapped else "")
    holder, name = rng.choice(HOLDERS)
    page.append(named(holder, name))
    if rng.random() < 0.8:
        leaf(f"<h1>{some(2, 12)}\0</h1>", True)
    for _ in range(rng.randint(1, 14)):
        tag = rng.choice(("p", "p", "p", "p", "p", "div", "li", "blockquote", "h2", "h3", "td", "pre"))
        words = some(1, 8) if rng.random() < 0.25 or tag in ("h2", "h3") else some(5, 120)
        if rng.random() < 0.15:
            words = f'<a href="#">{words}</a>' if rng.random() < 0.3 else f"<b>{words}</b>"
        leaf({"li": f"<ul><li>{words}\0</li></ul>", "td": f"<table><tr><td>{words}\0</td></tr></table>"}.get(tag, f"<{tag}>{words}\0</{tag}>"), True)
        if rng.random() < 0.08:
            around(rng.choice(("ad", "aside", "share", "notice", "form")))
    if rng.random() < 0.2:
        around(rng.choice(("comments", "share")))
    page.append(f"</{holder}>")
    for kind in rng.sample(("comments", "aside", "share", "ad", "form", "notice"), rng.randint(0, 3)):
        around(kind)
    page.append("</div>" if wrapped else "")
    if rng.random() < 0.9:
        around("footer")
    out = []
    for path, text, linked in blocks_of("".join(page)):
        at = re.search("\1(\\d+)\2", text)
        clean = re.sub("\1\\d+\2", "", text).strip()
        if at and clean:
            out.append((path, clean, min(linked, len(clean)), keep[int(at[1])]))
    return out


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES, made: int = MADE_PAGES, seed: int = 11) -> dict[str, np.ndarray]:
    """Train the labeller on at most `sample` pages, the first by hashed id, labelled by their
    landmark elements, and on `made` layouts filled with their texts.  Without pages, on
    layouts of a few plain words.  Of pages above SAMPLE_CHARS none is chosen, and of a
    longer page the first SAMPLE_BLOCKS blocks train: bounds of the sample, not of what is labelled."""
    chosen = pages.where(F.length("html") <= SAMPLE_CHARS).select("page_id", "html").orderBy(F.xxhash64("page_id"), "page_id", F.xxhash64("html")).limit(sample)
    real = [blocks_of(r.html) for r in chosen.collect()]
    pool = [b[1] for page in real for b in page] or ["some plain words of a text, which is short."]
    rng, memo = random.Random(seed), Vectors()
    labelled = [[(*b, marked(b[0])) for b in page] for page in real if any(t in ("article", "main") for b in page for t, _ in b[0])]
    labelled += [made_page(pool, rng) for _ in range(made)]
    labelled = [page[:SAMPLE_BLOCKS] for page in labelled if page]
    return lstm.train([vectors([b[:3] for b in page], memo) for page in labelled], [np.array([b[3] for b in page]) for page in labelled])


def labelled_pages(html: list[str], weights: dict[str, np.ndarray], memo: Vectors) -> list[list[tuple[str, bool]]]:
    """(text, kept) of all blocks of each page.  Pages of like length are labelled together."""
    pages = [blocks_of(x) for x in html]
    out: list[list[tuple[str, bool]]] = [[] for _ in pages]
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and stop - start < TOGETHER and (stop - start + 1) * len(pages[order[stop]]) <= 20_000:
            stop += 1
        part = order[start:stop]
        x, mask = lstm.padded([vectors(pages[i], memo) for i in part])
        good = lstm.probabilities(weights, x, mask) > 0.5
        for n, i in enumerate(part):
            out[i] = [(b[1], bool(g)) for b, g in zip(pages[i], good[:, n], strict=False)]
        start = stop
    return out


def main_text(pages: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) per row: the blocks labelled as article, in order.

    A null, empty or textless page gives an empty text.  Blocks end at every element that
    isn't inline and at line breaks; their white space becomes single spaces.  A page of any
    length is labelled whole: all blocks, and all words of each.  Repeated rows and null ids
    are taken as they come; other columns aren't read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64())])

    def extract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Vectors()

        def of(batch: pa.RecordBatch) -> list:
            found = []
            for start in range(0, batch.num_rows, 512):
                found += labelled_pages([x or "" for x in batch.column("html").slice(start, 512).to_pylist()], shared.value, memo)
            texts = ["\n".join(t for t, good in page if good) for page in found]
            return [batch.column("page_id"), batch.column("url"), texts, list(map(len, texts)), list(map(len, found))]

        return batches(rows, out, of)

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id long, url string, text string, n_chars long, n_blocks long")


def op1_block_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages))
