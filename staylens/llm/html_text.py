"""Main text of web pages: markup roles as a prior, and a suffix array per host that decides about blocks.

A page is read into blocks. Markup gives each a role: what stands in <article> or
<main> is article text, what stands in navigation, header, footer, side, form, advert,
notice or comment elements is no text. On a page without <article> and <main> the other
blocks are open. Article text and open blocks are decided per host, on every page: the
token streams of its pages (all blocks) are concatenated, and a suffix array finds the
runs of ``run`` tokens that occur on at least ``min_pages`` distinct pages and on
``min_share`` of the host's distinct pages. A block is boilerplate where such runs cover
all of it; a block that they cover in part stays whole, so no phrase is cut out of a text.

What markup says is the article is mostly the page's own text: where the covered blocks
hold more than half of its words, the page is one of many near copies and not framed by
a notice, and all its article blocks stay.

Distinct pages are told by a sketch of all their words (``sketch``), so copies of one
page, exact or with a few words changed, count as one page. A host that consists of
hundreds of near copies of one page has more than one sketch, and what they share then
counts as the host's boilerplate on pages without article markup.

A large host is cut into shards of about ``shard_tokens`` tokens. A run on enough of the
host's pages is on that number divided by the shards in one of them at least: such runs
of a shard's suffix array are the candidates, and a host of more than one shard counts
each candidate's distinct pages over all its pages, so cutting changes no result.

Cases: null html is empty; a null or odd url has host ""; truncated pages are read to
their end, an unfinished tag, comment or script is no text; repeated rows count as
one page; pages without text give "" and 0; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from staylens.llm.common import mix, stored, xx, xx_array

VOID_TEXT = ("script", "style", "template", "noscript", "iframe", "svg", "textarea", "select", "math", "object", "title")
# Inside a tag: a quoted value may hold ">"; a quote that nothing closes is a character like others.
IN_TAG = r"""(?:[^>=]+|=\s*(?:"[^"]*"|'[^']*')|=)*+"""
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(" + "|".join(VOID_TEXT) + r")\b" + IN_TAG + r"(?:>.*?(?:</\1\s*>|\Z)|\Z)"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(" + IN_TAG + r")(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|([^<]+|<)", re.S | re.I)
MAIN = {"article", "main"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "button", "fieldset"}
#: Tokens of class, id or role that mark a block as no text. Whole tokens: "no-sidebar" or "search-results" says nothing.
CHROME_WORDS = {"nav", "navbar", "navigation", "menu", "header", "footer", "sidebar", "aside", "ad", "ads", "advert",
                "advertisement", "advertising", "sponsor", "gdpr", "commentlist", "banner", "promo", "sponsored", "cookie", "cookies", "consent", "notice", "popup",
                "modal", "newsletter", "subscribe", "comment", "comments", "disqus", "breadcrumb", "breadcrumbs",
                "related", "share", "social", "search", "complementary", "contentinfo",
                "nav-bar", "nav-menu", "main-nav", "main-menu", "main-navigation", "site-nav", "site-navigation", "top-nav",
                "menu-item", "sub-menu", "site-header", "site-footer", "page-footer", "footer-nav", "left-sidebar",
                "right-sidebar", "ad-banner", "ad-container", "ad-slot", "cookie-banner", "cookie-consent", "cookie-notice",
                "newsletter-signup", "comment-list", "comment-form", "comments-area", "comments-section", "related-posts",
                "related-articles", "related-links", "share-buttons", "social-share", "social-links", "search-form", "search-box"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: A token made of parts marks a block too when it begins or ends with one of these ("ad-box", "user-comments") ..
FIRST_PARTS = {"ad", "ads", "advert", "advertising", "cookie", "cookies", "gdpr", "sponsor", "sponsored"}
LAST_PARTS = {"ad", "ads", "advert", "advertising", "comments", "commentlist", "cookies", "gdpr", "sponsor", "sponsors"}
#: .. unless a part says that it is not there ("no-comments", "ad-free").
DENIALS = {"no", "not", "without", "has", "with", "free", "hide", "non"}
BLOCK = {"p", "div", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
         "table", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "blockquote", "pre", "figure", "figcaption",
         "hr", "address", "body", "html", *CHROME}
VOID = {"br", "hr", "img", "input", "meta", "link", "source", "wbr", "area", "base", "col", "embed", "param", "track"}
#: Elements whose end tag may be missing: what their opening ends, and where the search for it stops.
ROW = {"tr", "td", "th"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": (ROW, {"table"}),
        **{t: ({"thead", "tbody", "tfoot", "caption", *ROW}, {"table"}) for t in ("thead", "tbody", "tfoot")}}
P_SCOPE = {"table", "td", "th", "caption", "button"}
OPEN, TEXT, OTHER, WRAPPED = 0, 1, 2, 3  # roles of a block; WRAPPED is settled at the page's end


def _is_chrome(tag: str, attrs: str, in_main: bool) -> bool:
    if tag in CHROME:
        return not (tag == "header" and in_main)
    if tag in MAIN or tag in HEADINGS or tag in ("body", "html") or "=" not in attrs:
        return False
    words = {w for m in ATTR.finditer(attrs) if m[1].lower() in ("class", "id", "role")
             for w in (m[2] or m[3] or m[4] or "").lower().replace("_", "-").split()}
    return bool(words & CHROME_WORDS - ({"header"} if in_main else set())) or any(map(_says_chrome, words))


def _says_chrome(word: str) -> bool:
    parts = word.split("-")
    return len(parts) > 1 and (parts[0] in FIRST_PARTS or parts[-1] in LAST_PARTS) and not DENIALS & set(parts)


def blocks(page: str) -> tuple[list[tuple[int, str]], bool]:
    """(role, text) of the page's blocks in order, and whether it has an <article> or <main>."""
    # stack: (tag, state before it); state: in main, in chrome, in chrome by element, in a main that a class-marked wrapper
    # holds, in a marked inline element (whose text goes, while the block around it stays one)
    out, piece, stack = [], [], []
    state = (False, False, False, False, False)
    has_main = has_wrapped = False

    def flush():
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            piece.clear()
            if text:
                main, chrome, _, wrapped, _ = state
                out.append((OTHER if chrome else WRAPPED if wrapped else TEXT if main else OPEN, text))

    def end(tags, stop):
        """Close the innermost of ``tags``, and all in it, if no element of ``stop`` stands in between."""
        nonlocal state
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                state = stack[i][1]
                del stack[i:]
                return True
            if stack[i][0] in stop:
                return False
        return False

    for m in TOKEN.finditer(page):
        text = m[5]
        if text is not None:
            if not state[4]:
                piece.append(text)
            continue
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in VOID:
            if tag == "hr":
                flush()
                end({"p"}, P_SCOPE)
            elif tag == "br":
                piece.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if not m[2]:
            attrs = m[4]
            if attrs.endswith("/"):
                continue
            if tag in BLOCK and tag != "button":
                end({"p"}, P_SCOPE)
            if tag in ENDS:
                tags, stop = ENDS[tag]
                while end(tags, stop):
                    pass
            in_main, in_chrome, hard, wrapped, mute = state
            chrome = _is_chrome(tag, attrs, in_main)
            main = tag in MAIN or bool(re.search(r"role\s*=\s*[\"']?main\b", attrs, re.I))
            if tag not in BLOCK and not main:
                if chrome or mute:  # in a marked inline element all elements count, so that its own end tag is found
                    stack.append((tag, state))
                    state = (*state[:4], True)
            else:
                flush()
                stack.append((tag, state))
                if main and in_chrome and not hard and not in_main:  # only a class or id says that this is no text
                    in_chrome, wrapped, has_wrapped = False, True, True
                elif main and not in_chrome and not wrapped:
                    has_main = True
                state = (in_main or main, in_chrome or chrome, hard or chrome and tag in CHROME, wrapped, mute)
        elif any(t == tag for t, _ in stack):
            if tag in BLOCK or not state[4]:
                flush()
            end({tag}, () if tag in BLOCK or not state[4] else BLOCK)
    flush()
    # an <article> in a class-marked wrapper is a teaser or a comment where the page has one outside, else it is the text
    out = [((OTHER if has_main else TEXT) if r == WRAPPED else r, t) for r, t in out]
    return out, has_main or has_wrapped


def sketch(words: list[str], size: int = 3) -> int:
    """The two smallest hashes of the page's runs of ``size`` words: most near copies share both, most other pages do not."""
    h = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))
    n = max(1, min(size, len(h)))
    key = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for j in range(n):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + h[j:j + len(key)])
    low = np.unique(key)[:2]
    return int(mix(low[:1] * np.uint64(3) + low[-1:]).view(np.int64)[0]) if len(low) else 0


def repeated_runs(tokens: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``tokens`` and the number of each suffix's class: equal numbers share ``run`` first tokens.

    Built by prefix doubling; a step sorts only the suffixes that the steps before left equal to others.
    Suffixes beside each other are then compared over ``run`` tokens.
    Page ends must be marks that occur once, so no run goes over them.
    """
    n = len(tokens)
    if n < 2:
        return np.arange(n), np.zeros(n, np.int64)
    order, width = np.argsort(tokens, kind="stable"), 1
    rank = np.empty(n, np.int64)  # where the group of a suffix begins in ``order``
    first = np.concatenate([[True], tokens[order][1:] != tokens[order][:-1]])
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while width < n:
        open_ = np.flatnonzero(~(first & np.concatenate([first[1:], [True]])))
        if not len(open_):
            break
        at = order[open_]
        key = rank[at] * (n + 1)
        inside = at + width < n
        key[inside] += rank[at[inside] + width] + 1
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        order[open_], first[open_] = at, new
        rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        width *= 2
    padded = np.concatenate([tokens, np.arange(-run - 2, -2, dtype=np.int64)])
    same = np.ones(n - 1, bool)
    for j in range(run):
        same &= padded[order[1:] + j] == padded[order[:-1] + j]
    return order, np.concatenate([[0], np.cumsum(~same)])


def run_keys(hashes: np.ndarray, run: int) -> np.ndarray:
    """Hash of the run of ``run`` words that starts at each position, from the words' hashes."""
    key = np.zeros(max(0, len(hashes) - run + 1), np.uint64)
    for j in range(run):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + len(key)])
    return key.view(np.int64)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pages of a batch that go to one shard, compressed together: half of what their rows would take in the shuffle."""
    for frame in batches:
        rows = [(*key, g["page"].tolist(), zstandard.ZstdCompressor(level=3).compress("\n".join(g["stream"]).encode()))
                for key, g in frame.groupby(["host", "shard", "shards", "needed"])]
        yield pd.DataFrame(rows, columns=["host", "shard", "shards", "needed", "pages", "streams"])


def _candidates(shard: pd.DataFrame, run: int) -> pd.DataFrame:
    """Hashes of the runs that stand on the shard's part of the distinct pages that its host needs."""
    words: dict[str, int] = {}
    pages, needed = np.concatenate(shard["pages"].to_list()), -(-int(shard["needed"].iloc[0]) // int(shard["shards"].iloc[0]))
    texts = (t for s in shard["streams"] for t in zstandard.ZstdDecompressor().decompress(s).decode().split("\n"))
    stream, page, pos = [], [], []
    for i, text in enumerate(texts):
        t = text.split()
        stream.append(np.fromiter((words.setdefault(w, len(words)) for w in t), np.int64, len(t)))
        stream.append(np.array([-1 - i], np.int64) - run - 2)  # page end: a mark of its own
        page.append(np.full(len(t) + 1, i))
        pos.append(np.arange(len(t) + 1))
    empty = pd.DataFrame({"host": pd.Series([], dtype=object), "run": pd.Series([], dtype=np.int64)})
    tokens, page, pos = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (stream, page, pos))
    if len(tokens) <= run or len(np.unique(pages)) < needed:
        return empty
    order, cls = repeated_runs(tokens, run)
    lens = np.bincount(page)
    whole = pos[order] + run < lens[page[order]]
    order, cls = order[whole], cls[whole]
    if not len(order):
        return empty
    cls = np.unique(cls, return_inverse=True)[1]
    often = np.bincount(cls)[cls] >= needed  # a run on that many pages occurs as often at least
    on = np.unique(np.stack([cls[often], pages[page[order[often]]]]), axis=1)[0]
    found = np.flatnonzero(np.bincount(on, minlength=1) >= needed)
    first = order[np.searchsorted(cls, found)]
    hashes = xx_array([w.encode() for w in words])
    keys = run_keys(hashes[tokens[first[:, None] + np.arange(run)]].ravel(), run)[::run] if len(first) else []
    return pd.DataFrame({"host": shard["host"].iloc[0], "run": np.asarray(keys, np.int64)})


def _row_keys(stream: str, run: int, known: dict[str, int]) -> np.ndarray:
    words = stream.split()
    for w in words:
        if w not in known:
            known[w] = xx(w.encode())
    return run_keys(np.fromiter((known[w] for w in words), np.uint64, len(words)), run)


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html_col: str = "html", run: int = 6,
            min_pages: int = 3, min_share: float = 0.3, shard_tokens: int = 500_000) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html_col).alias("html"))

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [blocks(h or "") for h in batch.column(2).to_pylist()]
            words = [" ".join(t for _, t in b) for b, _ in got]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(words, pa.string()), pa.array([len(w.split()) for w in words], pa.int64()),
                 pa.array([sketch(w.split()) for w in words], pa.int64()), pa.array([has for _, has in got], pa.bool_()),
                 pa.array([[r == (TEXT if has else OPEN) for r, _ in b] for b, has in got], pa.list_(pa.bool_())),
                 pa.array([[len(t.split()) for _, t in b] for b, _ in got], pa.list_(pa.int32()))],
                names=["page_id", "url", "stream", "n", "page", "article", "judged", "lens"])

    types = dict(src.dtypes)
    read = src.mapInArrow(streams, f"page_id {types['page_id']}, url {types['url']}, stream string, n long, page long, article boolean, "
                                   "judged array<boolean>, lens array<int>")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    all_streams = stored(read.withColumn("row", F.monotonically_increasing_id()).withColumn("host", host), "page-streams")
    shards = F.ceil((F.sum("n") + F.count("*")) / shard_tokens).cast("int")
    hosts = all_streams.groupBy("host").agg(F.greatest(shards, F.lit(1)).alias("shards"))
    distinct = all_streams.select("host", "page").distinct().groupBy("host").agg(
        F.greatest(F.lit(min_pages), F.ceil(F.count("*") * min_share)).alias("needed"))
    hosts = stored(hosts.join(distinct, "host"), "page-hosts")
    dealt = all_streams.select("host", "row", "page", "stream").join(hosts, "host") \
        .withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int")) \
        .select("host", "shard", "shards", "needed", "page", "stream") \
        .mapInPandas(_packed, "host string, shard int, shards int, needed long, pages array<long>, streams binary")
    found = stored(dealt.groupBy("host", "shard").applyInPandas(
        lambda g: _candidates(g, run), "host string, run long").distinct().join(hosts, "host"), "page-runs")

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for frame in batches:
            on = [np.intersect1d(_row_keys(s, run, known), c) for s, c in zip(frame["stream"], frame["runs"])]
            known = known if len(known) < 1_000_000 else {}
            n = [len(x) for x in on]
            yield pd.DataFrame({"host": frame["host"].repeat(n), "page": frame["page"].repeat(n),
                                "run": np.concatenate([*on, np.zeros(0, np.int64)])})

    # written, so that Spark knows their size and sends few runs to the pages instead of the pages to the runs
    by_host = lambda runs, name: stored(runs.groupBy("host").agg(F.collect_list("run").alias("runs")), name)
    many = all_streams.join(by_host(found.where("shards > 1"), "page-candidates"), "host").select("host", "page", "stream", "runs")
    counted = many.mapInPandas(occurrences, "host string, page long, run long").distinct() \
        .groupBy("host", "run").agg(F.count("*").alias("total")).join(hosts, "host").where("total >= needed")
    common = found.where("shards = 1").select("host", "run").unionByName(counted.select("host", "run"))

    def own_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for frame in batches:
            texts = []
            for stream, article, judged, lens, runs in zip(frame["stream"], frame["article"], frame["judged"], frame["lens"], frame["runs"]):
                words, n, keep = stream.split(), np.asarray(lens, np.int64), np.asarray(judged, bool)
                ends = np.cumsum(n)
                if runs is not None and len(words) >= run:
                    gone = np.zeros(len(words) + 1, np.int64)
                    starts = np.flatnonzero(np.isin(_row_keys(stream, run, known), runs))
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + run, -1)
                    covered = np.concatenate([[0], np.cumsum(np.cumsum(gone)[:-1] > 0)])
                    repeated = keep & (covered[ends] - covered[ends - n] == n)
                    if not article or 2 * n[repeated].sum() <= n[keep].sum():
                        keep = keep & ~repeated
                texts.append("\n".join(" ".join(words[e - k:e]) for e, k, kept in zip(ends, n, keep) if kept))
            known = known if len(known) < 1_000_000 else {}
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    return all_streams.join(by_host(common, "page-common"), "host", "left").select("page_id", "url", "stream", "article", "judged", "lens", "runs") \
        .mapInPandas(own_blocks, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
