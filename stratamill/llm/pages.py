"""Main text of web pages: page structure, and the runs of tokens that a host's pages share.

A page is read into blocks in page order. Blocks in menus, headers, footers, sidebars,
notices, adverts, forms and reader comments are boilerplate, but for the headings in an
article's own header; those in an article (or, if there is none, in a main element) are
content and stay whole, however often other pages repeat them. About all other blocks the
host decides:

* runs of ``RUN`` tokens, boilerplate included and content not, are counted over the
  whole host by the distinct pages they stand on; pages of equal blocks are one;
* runs that stand on ``PAGES`` pages or more cover boilerplate;
* covered tokens of undecided blocks are removed, the rest is kept. Beside an article or
  main element, the rest is kept if it has ``RUN`` words or more: an article that is only
  a teaser does not silence the text around it.

Pages are read row by row. What is shuffled are 64-bit hashes of runs outside of content,
once per distinct page of a host, and their counts, aggregated on the map side; the markup
itself moves only for pages with undecided blocks, to meet the runs found. No task gets a
host as a whole. ``main_texts`` gives the same for the pages of one host in memory, by a
suffix array.

Defined cases: a null or empty page has an empty text. A null url, or one without a
host, belongs to the host "". Repeated pages give a row each. Unclosed and stray tags are
read as browsers do, roughly. Very long pages are read whole. Empty tables give an
empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamill.llm.reputation import url_parts
from stratamill.llm.tokens import chunks
from stratamill.sinks.written import written_once

RUN = 8
PAGES = 3
# Pages that a task holds at once.
SHARD_PAGES = 256

EXCLUDED, UNDECIDED, MAIN, ARTICLE = range(4)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|[^<]+|<", re.S
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\s(?:hidden(?=[\s=]|\Z)|aria-hidden\s*=\s*[\"']?true)", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Elements of HTML by how they are read.
_RAW = frozenset("script style title textarea template noscript iframe svg xmp annotation annotation-xml".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody tfoot thead tr ul".split()
)
_SPACES = frozenset("br td th img".split())
_BOILERPLATE_TAGS = frozenset("aside button dialog footer form head header menu nav select".split())
_BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored promo cookie cookies gdpr popup modal newsletter "
    "subscribe nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets footer masthead disqus share "
    "sharing toolbar pagination pager login signup menu menus notice notices banner banners consent alert".split()
)
_COMMENT_NAMES = frozenset("comment comments reply replies".split())
# Names that content has as well: the host decides about the text in such elements.
_DOUBTFUL_NAMES = frozenset(
    "sponsor promotion aside header discussion related social search".split()
)
# Names with these speak of a state, a layout or a topic, not of what the element is.
_STATES = frozenset(
    "has with without no not is layout grid template theme enabled disabled free tag category type".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTENT_TAGS = frozenset("article main".split())
_PLAIN_NAMES = frozenset("html body h1 h2 h3 h4 h5 h6".split())


NOTHING, DOUBTFUL, SOFT, HARD = range(4)


def _named(attributes: str) -> int:
    """What class, id and role say: a name counts by any part of it, unless another part says that it is a state."""
    found = NOTHING
    for name in " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)).split():
        parts = {part.lower() for part in _PARTS.findall(name) if not part.isdigit()}
        for kind, names in ((HARD, _COMMENT_NAMES), (SOFT, _BOILERPLATE_NAMES), (DOUBTFUL, _DOUBTFUL_NAMES)):
            if kind > found and parts & names and not parts & _STATES:
                found = kind
    return found


def _excluded(tag: str, attributes: str) -> int:
    """Whether the element is boilerplate: HARD whatever it holds, SOFT unless the page's article is in it."""
    if tag in _BOILERPLATE_TAGS:
        return SOFT if tag == "form" and not _HIDDEN.search(attributes) and _named(attributes) < HARD else HARD
    if not attributes or tag in _PLAIN_NAMES:
        return NOTHING
    if _HIDDEN.search(attributes):
        return HARD
    named = _named(attributes)
    return named if named == HARD or tag not in _CONTENT_TAGS else NOTHING


def _mode(tag: str, excluded: int, outer: int) -> int:
    if outer == EXCLUDED or excluded >= SOFT:
        return EXCLUDED
    if tag == "article":
        return ARTICLE
    if tag == "main":
        return max(outer, MAIN)
    return UNDECIDED if excluded == DOUBTFUL else outer


def blocks_of(html: str) -> list[tuple[int, str]]:
    """The page's blocks in order: what they stand in, and their text with single spaces.

    Where the page has its article or main element only inside of boilerplate by name, or
    of a form, those elements around it are not boilerplate.
    """
    blocks, around = _blocks(html, frozenset())
    return _blocks(html, around)[0] if around else blocks


def _blocks(html: str, plain: frozenset[int]) -> tuple[list[tuple[int, str]], frozenset[int]]:
    """The blocks, with the elements at ``plain`` no boilerplate; where elements around the only article begin."""
    out: list[tuple[int, str]] = []
    pending: list[str] = []
    stack: list[tuple[str, int, int, int]] = []
    mode, at = UNDECIDED, 0
    around: set[int] = set()
    outside = False

    def flush() -> None:
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            out.append((mode, text))

    def close(depth: int) -> None:
        nonlocal mode
        flush()
        mode = stack[depth - 1][1] if depth else UNDECIDED
        del stack[depth:]

    def open_at(tag: str, walls: frozenset[str]) -> int | None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                return i
            if stack[i][0] in walls:
                return None
        return None

    def in_own_header() -> bool:
        """Whether the article's own header is the only boilerplate around."""
        walls = [i for i, (_, _, kind, _) in enumerate(stack) if kind >= SOFT and stack[i][3] not in plain]
        return len(walls) == 1 and walls[0] > 0 and stack[walls[0]][0] == "header" and stack[walls[0] - 1][1] == ARTICLE

    while m := _TOKEN.match(html, at):
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                pending.append(unescape(m[0]))
            continue
        if m[1]:
            depth = open_at(tag, _NO_WALLS)
            if tag in _BLOCKS:
                flush()
            if depth is not None:
                around_it = stack[depth - 1][1] if depth else UNDECIDED
                if around_it != mode or any(element[0] in _BLOCKS for element in stack[depth:]):
                    close(depth)
                else:
                    del stack[depth:]
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in _SPACES:
            pending.append(" ")
        if tag in _BLOCKS:
            flush()
            for inner, walls in (("p", _P_WALLS), (tag if tag in _SIBLINGS else "", _LIST_WALLS)):
                if inner and (depth := open_at(inner, walls)) is not None:
                    close(depth)
        if tag in _VOID:
            continue
        excluded = NOTHING if m.start() in plain else _excluded(tag, m[3])
        if tag in _CONTENT_TAGS and excluded == NOTHING:
            if mode != EXCLUDED:
                outside = True
            elif all(kind < HARD for _, _, kind, _ in stack):
                around.update(begin for _, _, kind, begin in stack if kind == SOFT)
        inner_mode = _mode(tag, excluded, mode)
        if tag in _HEADINGS and mode == EXCLUDED and in_own_header():
            inner_mode = ARTICLE
        if inner_mode != mode:
            flush()
        stack.append((tag, inner_mode, excluded, m.start()))
        mode = inner_mode
    flush()
    return out, frozenset() if outside else frozenset(around)


_NO_WALLS: frozenset[str] = frozenset()
_P_WALLS = _BLOCKS - {"p"}
_SIBLINGS = frozenset("li dd dt option tr".split())
_LIST_WALLS = frozenset("ul ol menu dl select table".split())


def covered(streams: list[np.ndarray], run: int = RUN, pages: int = PAGES) -> list[np.ndarray]:
    """For each stream of token numbers, which tokens lie in a run that ``pages`` streams or more hold.

    A suffix array of all streams, sorted to the depth of ``run`` tokens by doubling.
    """
    sizes = [len(s) for s in streams]
    # A separator of its own behind every stream, and enough of them behind the last.
    joined = np.concatenate([np.append(s, -1 - i) for i, s in enumerate(streams)] + [np.full(run, -1 - len(streams))])
    owner = np.concatenate([np.repeat(np.arange(len(sizes)), np.array(sizes) + 1), np.full(run, -1)]).astype(np.int64)
    rank, depth = np.unique(joined, return_inverse=True)[1].astype(np.int64), 1
    while depth < run:
        step = min(depth, run - depth)
        behind = np.append(rank[step:], np.zeros(step, np.int64))
        rank = np.unique(rank * (rank.max() + 1) + behind, return_inverse=True)[1].astype(np.int64)
        depth += step
    order = np.lexsort((owner, rank))
    first = np.flatnonzero(np.append(True, rank[order][1:] != rank[order][:-1]))
    new_page = np.append(True, (owner[order][1:] != owner[order][:-1]) | (rank[order][1:] != rank[order][:-1]))
    many = np.add.reduceat(new_page.astype(np.int64), first) >= pages
    begins = np.zeros(len(joined) + 1, np.int64)
    starts = order[np.repeat(many, np.diff(np.append(first, len(order))))]
    # Runs over a separator are of one stream alone, and never repeat.
    np.add.at(begins, starts, 1)
    np.add.at(begins, np.minimum(starts + run, len(joined)), -1)
    inside = np.cumsum(begins[:-1]) > 0
    bounds = np.cumsum(np.array(sizes) + 1)
    return [inside[end - size - 1 : end - 1] for size, end in zip(sizes, bounds.tolist(), strict=True)]


def _unique_words(words: list[str], hidden: np.ndarray) -> list[str]:
    """A block without its covered runs; none if it is covered as a whole.

    Shorter pieces, of runs that reach in from the block before or behind, stay.
    """
    if hidden.all():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hidden.astype(np.int8), [0]))))
    for start, end in zip(edges[::2], edges[1::2], strict=True):
        if end - start < RUN:
            hidden[start:end] = False
    return [w for w, h in zip(words, hidden.tolist(), strict=True) if not h]


def _is_content(mode: int, best: int) -> bool:
    return mode == best >= MAIN


def _best(blocks: list[tuple[int, str]]) -> int:
    return max((mode for mode, _ in blocks), default=EXCLUDED)


def _is_open(blocks: list[tuple[int, str]]) -> bool:
    """Whether the host has to decide about some of the page's blocks."""
    best = _best(blocks)
    return any(mode >= UNDECIDED and not _is_content(mode, best) for mode, _ in blocks)


def _outside(blocks: list[tuple[int, str]]) -> list[str]:
    """The words that are not content."""
    best = _best(blocks)
    return [w for mode, text in blocks if not _is_content(mode, best) for w in text.split(" ")]


def _mark(blocks: list[tuple[int, str]]) -> bytes:
    return hashlib.blake2b(
        "\n".join(f"{mode} {text}" for mode, text in blocks).encode("utf-8", "surrogatepass"), digest_size=16
    ).digest()


def _page_text(blocks: list[tuple[int, str]], hidden: np.ndarray) -> str:
    """Text of a page; ``hidden`` says which of the words outside of content are covered."""
    best, at, kept, own = _best(blocks), 0, [], 0
    for mode, text in blocks:
        if _is_content(mode, best):
            kept.append((True, text))
            continue
        words = text.split(" ")
        if mode >= UNDECIDED and (unique := _unique_words(words, hidden[at : at + len(words)].copy())):
            kept.append((False, " ".join(unique)))
            own += len(unique)
        at += len(words)
    return "\n".join(text for content, text in kept if content or best == UNDECIDED or own >= RUN)


def main_texts(pages: list[list[tuple[int, str]]]) -> list[str]:
    """Texts of pages of one host, given as blocks."""
    numbers: dict[str, int] = {}
    streams: dict[bytes, np.ndarray] = {}
    marks = [_mark(blocks) for blocks in pages]
    for mark, blocks in zip(marks, pages, strict=True):
        if mark not in streams:
            streams[mark] = np.array([numbers.setdefault(w, len(numbers)) for w in _outside(blocks)], np.int64)
    hidden = dict(zip(streams, covered(list(streams.values())), strict=True)) if streams else {}
    return [_page_text(blocks, hidden[mark]) for mark, blocks in zip(marks, pages, strict=True)]


@lru_cache(maxsize=1 << 16)
def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _runs(words: list[str]) -> np.ndarray:
    """A hash of the ``RUN`` words that begin at each place."""
    if len(words) < RUN:
        return np.zeros(0, np.int64)
    hashes = np.array([_word_hash(w) for w in words], np.uint64)
    out = np.zeros(len(words) - RUN + 1, np.uint64)
    for k in range(RUN):
        out = (out ^ hashes[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _hidden(words: list[str], often: np.ndarray) -> np.ndarray:
    """Which words lie in one of the runs ``often``."""
    runs = _runs(words)
    change = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.isin(runs, often))
    np.add.at(change, starts, 1)
    np.add.at(change, starts + RUN, -1)
    return np.cumsum(change[:-1]) > 0


def _pages(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, column):
        for start in range(0, batch.num_rows, SHARD_PAGES):
            yield batch.slice(start, SHARD_PAGES)


def page_texts(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id`` (the key), ``url``, ``text`` and ``n_chars`` of every row of ``df``."""
    rows = df.select(
        F.col(key).alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
        url_parts(F.col(url))[0].alias("host"),
    )
    types = dict(df.dtypes)
    ids = f"page_id {types[key]}, url {types[url]}"

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pages(batches, 1):
            pages = [blocks_of(page) for page in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([_mark(blocks) for blocks in pages], pa.binary()),
                pa.array([_is_open(blocks) for blocks in pages], pa.bool_()),
                pa.array([np.unique(_runs(_outside(blocks))) for blocks in pages], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "mark", "open", "runs"])

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pages(batches, 2):
            pages = [blocks_of(page) for page in batch.column(2).to_pylist()]
            texts = [None if _is_open(b) else _page_text(b, np.zeros(len(_outside(b)), bool)) for b in pages]
            yield with_text(batch, texts).filter(pa.array([t is not None for t in texts], pa.bool_()))

    def undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pages(batches, 2):
            pages = [blocks_of(page) for page in batch.column(2).to_pylist()]
            marks = pa.array([_mark(blocks) for blocks in pages], pa.binary())
            columns = [*batch.columns, marks]
            full = pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "html", "host", "mark"])
            yield full.filter(pa.array([_is_open(blocks) for blocks in pages], pa.bool_()))

    def uncovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pages(batches, 2):
            texts = []
            for page, often in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                blocks = blocks_of(page)
                texts.append(_page_text(blocks, _hidden(_outside(blocks), np.array(often or [], np.int64))))
            yield with_text(batch, texts)

    def with_text(batch: pa.RecordBatch, texts: list[str | None]) -> pa.RecordBatch:
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
        columns.append(pa.array([None if t is None else len(t) for t in texts], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    outlines = rows.select("host", "html").mapInArrow(outline, "host string, mark binary, open boolean, runs array<long>")
    distinct = written_once(outlines.groupBy("host", "mark").agg(F.first("open").alias("open"), F.first("runs").alias("runs")))
    runs = distinct.select("host", "mark", "open", F.explode("runs").alias("run"))
    often = runs.groupBy("host", "run").agg(F.count("*").alias("pages")).where(F.col("pages") >= PAGES)
    found = runs.where("open").join(often.select("host", "run"), ["host", "run"])
    found = found.groupBy("host", "mark").agg(F.collect_list("run").alias("often"))
    columns = ["page_id", "url", "html", "host"]
    schema = f"{ids}, text string, n_chars long"
    open_pages = rows.select(*columns).mapInArrow(undecided, f"{ids}, html string, host string, mark binary")
    met = open_pages.join(found, ["host", "mark"], "left").select("page_id", "url", "html", "often")
    return rows.select(*columns).mapInArrow(decided, schema).union(met.mapInArrow(uncovered, schema))
