"""Main text of web pages: markup first, then what a host repeats.

``blocks`` cuts a page into blocks of text and leaves out what its markup says is no article: menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden parts and readers'
comments. If the page marks its article, only that is taken, else its main part, else its body
without blocks that are mostly links.

The blocks of each host are then concatenated as token streams, with a mark at block ends, and what
is repeated across enough distinct pages is removed: the host's suffix array, sorted to a depth of
``DEPTH`` tokens. Each task sorts the suffixes of its pages by doubling (keys of 2, 4, 8 tokens); a
run of equal keys is an interval whose common prefix is that long, and its distinct pages are
counted. The shuffle adds up the intervals of all tasks by key, so no host needs to fit into one
task. Suffixes are sampled by local minima: two equal stretches of ``DEPTH + STEP - 1`` tokens hold
the same ones. Keys are hashes of content, hence comparable between tasks.

Articles share passages and are copied, which is no boilerplate. Inside a marked article a repeat
must be on most pages of the host (``MARKED``), elsewhere on fewer (``UNMARKED``), and a page nearly
all of which is repeated is taken to be a copy and left as it is. What is not covered stays, word by word.

The repeats of a host that are kept are bounded by its tokens a page over the share asked for,
not by its pages. They are joined by host with no forced broadcast; Spark splits hot hosts there.

Nulls: a page without html has an empty text, one without host no repeats. Empty tables give no
rows; repeated rows count as pages of their own. Long pages are cut as a whole, in one task. Other
columns are not read, so their names can't clash.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import extended
from eventloom.session import stage_table

DEPTH = 8  # tokens that suffixes are sorted by, a power of two
STEP = 8  # of so many neighbours at least one suffix is sampled


@dataclass(frozen=True)
class Evidence:
    """What makes a repeat boilerplate: pages that have it, and their share of the host's pages."""

    pages: int
    share: float
    most_covered: float  # of a page; beyond it the page is a copy


MARKED = Evidence(pages=8, share=0.6, most_covered=0.5)
UNMARKED = Evidence(pages=3, share=0.3, most_covered=0.9)

# Elements of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video xmp noframes".split())
LEFT_OUT = frozenset("nav footer aside form button select fieldset dialog menu head datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|sponsor|sponsored|promo|promotion|banner|nav|navbar|"
    r"navigation|menu|breadcrumbs?|sidebar|footer|masthead|comments?|commentlist|disqus|respond|replies|cookies?|consent|"
    r"gdpr|notice|notification|alert|newsletter|subscribe|subscription|signup|login|popup|modal|overlay|share|sharing|"
    r"social|related|recommended|recommendations|widget|pagination|pager|toolbar|skip|disclaimer|copyright)(?=$|[\s_-])"
)
COMMENT_NAMES = re.compile(r"(?:^|[\s_-])comments?(?=$|[\s_-])")
UNSAID = re.compile(r"(?:^|\s)(?:with|has|no|is|without)-\S+")

MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|$))",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
ARTICLE, MAIN, BODY = 2, 1, 0


def _marks(name: str, more: str, in_article: bool) -> tuple[bool, int]:
    """Whether an element is left out, and the part of the page it opens."""
    part = ARTICLE if name == "article" else MAIN if name == "main" else BODY
    if name in LEFT_OUT or (name == "header" and not in_article):
        return True, part
    if "=" not in more and "hidden" not in more:
        return False, part
    own = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(more)}
    if "hidden" in own or own.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", own.get("style", "")):
        return True, part
    role = own.get("role", "").lower()
    if role == "main" and part == BODY:
        part = MAIN
    if "articlebody" in own.get("itemprop", "").lower():
        part = ARTICLE
    if role in ROLES:
        return True, part
    called = UNSAID.sub(" ", f"{own.get('class', '')} {own.get('id', '')}".lower())
    if name in ("html", "body", "main"):
        return False, part
    if part == ARTICLE:
        return bool(COMMENT_NAMES.search(called)), part
    return bool(NAMES.search(called)) or (not in_article and bool(re.search(r"(?:^|[\s_-])header(?=$|[\s_-])", called))), part


def blocks(page: str) -> tuple[bool, list[str]]:
    """Whether the page marks its article or main part, and the blocks of text taken from it."""
    found: list[tuple[int, str, float]] = []  # part of the page, text, share of it in links
    stack: list[tuple[str, bool, int]] = []
    pieces: list[str] = []
    linked = skipped = links = 0
    parts = [0, 0, 0]

    def end_block() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            part = ARTICLE if parts[ARTICLE] else MAIN if parts[MAIN] else BODY
            found.append((part, text, linked / len(text)))
        pieces.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal skipped, links
        while len(stack) > depth:
            name, out, part = stack.pop()
            skipped -= out
            links -= name == "a"
            if part:
                parts[part] -= 1

    at, open_names = 0, {}
    while found_markup := MARKUP.search(page, at):
        text = page[at : found_markup.start()]
        if text and not skipped:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            linked += len(text) if links else 0
        at = found_markup.end()
        name = found_markup["name"]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            end_block()
        if found_markup["close"]:
            if open_names.get(name):
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                for other, _, _ in stack[depth:]:
                    open_names[other] -= 1
                pop_to(depth)
            continue
        if name in RAW and not found_markup["more"].endswith("/>"):
            closing = CLOSING[name].search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if name in VOID or name in RAW:
            continue
        if name not in INLINE:
            # A block ends an open paragraph; a list item or cell ends the one before it.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or (stack[i][0] == name and name in CLOSED_BY_SAME):
                    for other, _, _ in stack[i:]:
                        open_names[other] -= 1
                    pop_to(i)
                    break
                if stack[i][0] not in INLINE:
                    break
        out, part = _marks(name, found_markup["more"], parts[ARTICLE] + parts[MAIN] > 0)
        stack.append((name, out, part))
        open_names[name] = open_names.get(name, 0) + 1
        skipped += out
        links += name == "a"
        if part:
            parts[part] += 1
    if not skipped:
        pieces.append(html.unescape(page[at:]))
    end_block()
    best = max((part for part, _, _ in found), default=BODY)
    if best:
        return True, [text for part, text, _ in found if part == best]
    return False, [text for _, text, share in found if share < 0.6]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit number of two, by position: (a, b) is not (b, a)."""
    c = (a ^ (b * np.uint64(0x9E3779B97F4A7C15) + (a << np.uint64(6)))) * np.uint64(0xBF58476D1CE4E5B9)
    return c ^ (c >> np.uint64(29))


class Suffixes:
    """The sampled suffixes of a page's token stream, by the key of their first ``DEPTH`` tokens."""

    def __init__(self, texts: list[str]):
        self.words = [text.split(" ") for text in texts]
        tokens = [token for words in self.words for token in ("", *words)] + [""]  # a mark at every block's ends
        keys = pd.util.hash_array(np.array(tokens, object), categorize=False).astype(np.uint64)
        half = 1
        while half < DEPTH and len(keys) > half:
            keys = _mixed(keys[:-half], keys[half:])
            half *= 2
        self.length = len(tokens)
        if half < DEPTH or not len(keys):
            self.places, self.keys = np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        if len(keys) > STEP:
            near = np.lib.stride_tricks.sliding_window_view(keys, STEP)
            self.places = np.unique(near.argmin(1) + np.arange(len(near)))
        else:
            self.places = np.array([int(keys.argmin())])
        self.keys = keys[self.places].view(np.int64)

    def without(self, repeated: np.ndarray, most_covered: float) -> list[str]:
        """The blocks without the stretches that ``repeated`` keys cover."""
        hits = self.places[np.isin(self.keys, repeated)]
        if not len(hits):
            return [" ".join(words) for words in self.words]
        covered = np.zeros(self.length, bool)
        marks = np.cumsum([0] + [len(words) + 1 for words in self.words])
        # Hits that follow one another closely are one stretch.
        first = hits[np.r_[True, np.diff(hits) > STEP]]
        last = hits[np.r_[np.diff(hits) > STEP, True]] + DEPTH
        for a, b in zip(first.tolist(), last.tolist()):
            # Its ends lie fewer than STEP tokens further out: they are moved there if a block ends there.
            before, after = marks[np.searchsorted(marks, a, "right") - 1], marks[np.searchsorted(marks, b - 1, "left")]
            covered[before if a - before < STEP else a : after if after - b < STEP else b] = True
        if covered.sum() > most_covered * self.length:
            return [" ".join(words) for words in self.words]
        return [
            " ".join(word for word, gone in zip(words, covered[at + 1 : at + 1 + len(words)]) if not gone)
            for words, at in zip(self.words, marks)
        ]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, in small letters; null if empty."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.when(host != "", host)


def intervals(pages: DataFrame) -> DataFrame:
    """(host, marked, key, n) from (host, html): per task, the pages of a host that hold a sampled suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, marks, keys = [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                marked, texts = blocks(page.as_py())
                own = np.unique(Suffixes(texts).keys)  # each once a page
                keys.append(own)
                hosts.append(np.full(len(own), host, np.int64))
                marks.append(np.full(len(own), marked, bool))
            key, host, mark = np.concatenate(keys), np.concatenate(hosts), np.concatenate(marks)
            order = np.lexsort((key, mark, host))
            key, host, mark = key[order], host[order], mark[order]
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (mark[1:] != mark[:-1]) | (host[1:] != host[:-1])][: len(key)])
            n = np.diff(np.r_[new, len(key)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(host[new]), pa.array(mark[new]), pa.array(key[new]), pa.array(n.astype(np.int64))],
                names=["host", "marked", "key", "n"],
            )

    return pages.mapInArrow(run, "host bigint, marked boolean, key bigint, n bigint")


def repeats(pages: DataFrame, marked: Evidence = MARKED, unmarked: Evidence = UNMARKED) -> DataFrame:
    """(host, in_marked, in_unmarked): the keys of suffixes that are boilerplate of a host's two kinds of pages."""
    least = min(marked.pages, unmarked.pages)
    summed = intervals(pages.select("host", "html").where("host is not null"))
    summed = summed.groupBy("host", "key", "marked").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    sizes = pages.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    enough = lambda e: (F.col("n") >= e.pages) & (F.col("n") >= e.share * F.col("pages"))
    fits = F.when(F.col("marked"), enough(marked)).otherwise(enough(unmarked))
    met = summed.join(sizes, "host").where(fits)
    return met.groupBy("host").agg(
        F.collect_list(F.when(F.col("marked"), F.col("key"))).alias("in_marked"),
        F.collect_list(F.when(~F.col("marked"), F.col("key"))).alias("in_unmarked"),
    )


def extract(pages: DataFrame, marked: Evidence = MARKED, unmarked: Evidence = UNMARKED) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    source = pages.select(
        "page_id", "url", F.xxhash64(host_of(F.col("url"))).alias("_hash"), host_of(F.col("url")).isNotNull().alias("_known"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).select("page_id", "url", F.when(F.col("_known"), F.col("_hash")).alias("host"), "html")
    known = stage_table(repeats(source, marked, unmarked), "host-repeats")
    joined = source.join(known, "host", "left").select("page_id", "url", "in_marked", "in_unmarked", "html")
    schema = extended(source.select("page_id", "url"), "text string, n_chars bigint")
    limits = {True: marked.most_covered, False: unmarked.most_covered}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for in_marked, in_unmarked, page in zip(batch.column(2), batch.column(3), batch.column(4)):
                is_marked, found = blocks(page.as_py())
                keys = (in_marked if is_marked else in_unmarked).values
                if keys is not None and len(keys):
                    found = Suffixes(found).without(keys.to_numpy(zero_copy_only=False), limits[is_marked])
                texts.append(" ".join(text for text in found if text))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, schema)
