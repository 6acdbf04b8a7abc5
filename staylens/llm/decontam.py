"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark items' windows of ``window`` consecutive words (an
item with fewer words is one window), one search per window length. A shift table
over blocks of two words says how far the search may skip; where it says zero, the
bucket of the block selects the windows that end in it, and their words are
compared directly. Many stretches of text are searched at once, one position each.
No document is shuffled: the items are dealt by hash into shards of about ``shard_windows``
windows, with one pass over the documents per shard. The driver holds one shard at a time (its
tables have at most 2^``TABLE_BITS`` entries and its windows), and what a pass found is written
before the next shard is read, so neither the driver nor a task grows with the benchmark.

Cases: null text has no words and is clean; null item texts have no window; a null
item_id hits but is not listed; an item_id given twice counts once; an item without
words has no window; an empty benchmark leaves all clean; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylens.llm.common import stored, text_bytes

# Lower-case ASCII letters, digits and all non-ASCII bytes are word bytes; others separate.
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
                   for b in range(256))
STRETCH = 512  # words one search position covers
# FIXED VALUE of the contract: a word is a maximal match (A-Z lower-cased).
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD_WINDOWS = 250_000  # about 50 MB in a task, 150 MB in the driver while its tables are made
TABLE_BITS = 20
REPORT_SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Patterns:
    """Windows of one benchmark shard, grouped by length, as word numbers (0: no benchmark word)."""

    def __init__(self, items: list[tuple], window: int):
        self.vocab: dict[bytes, int] = {}
        by_len: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            w = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in words_of(text)]
            m = min(window, len(w))
            for i in range(len(w) - m + 1 if w else 0):
                by_len.setdefault(m, {}).setdefault(tuple(w[i:i + m]), set()).add(item)
        self.tables = [self._table(m, list(found), [sorted((x for x in s if x is not None), key=str) for s in found.values()])
                       for m, found in sorted(by_len.items())]

    def _table(self, m: int, windows: list[tuple], owners: list[list]):
        pats = np.array(windows, np.int64)
        size = 2 if m > 1 else 1
        bits = min(TABLE_BITS, max(10, int(len(windows) * m * 4).bit_length()))
        shift = np.full(1 << bits, m - size + 1, np.int16)
        for end in range(size - 1, m):
            np.minimum.at(shift, self._bucket(pats[:, end - size + 1], pats[:, end], size, bits), np.int16(m - 1 - end))
        last = self._bucket(pats[:, m - size], pats[:, m - 1], size, bits)
        order = np.argsort(last, kind="stable")
        starts = np.searchsorted(last[order], np.arange((1 << bits) + 1)).astype(np.int32)
        return m, size, bits, shift, pats[order].astype(np.int32), starts, [owners[i] for i in order]

    @staticmethod
    def _bucket(first, second, size, bits):
        x = second if size == 1 else first * 0x9E3779B1 + second
        return ((x * 0x2545F491) >> 7) & ((1 << bits) - 1)

    def search(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[list]]]:
        """Per length: (length, window starts, numbers of the windows found, owners of each window)."""
        for m, size, bits, shift, pats, starts, owners in self.tables:
            lo = np.arange(m - 1, len(ids), STRETCH)
            hi = np.minimum(lo + STRETCH, len(ids))
            at, stop, found, which = lo, hi, [], []
            while len(at):
                bucket = self._bucket(ids[at - size + 1], ids[at], size, bits)
                skip = np.where((ids[at] == 0) | (ids[at - size + 1] == 0), m - size + 1, shift[bucket])
                hit = skip == 0
                if hit.any():
                    b, e = bucket[hit], at[hit]
                    n = starts[b + 1] - starts[b]
                    ends = np.repeat(e, n)
                    pat = np.repeat(starts[b], n) + np.arange(len(ends)) - np.repeat(np.cumsum(n) - n, n)
                    same = (ids[ends[:, None] + np.arange(1 - m, 1)] == pats[pat]).all(axis=1)
                    found.append(ends[same] - m + 1)
                    which.append(pat[same])
                at = at + np.maximum(skip, 1)
                on = at < stop
                at, stop = at[on], stop[on]
            if found:
                yield m, np.concatenate(found), np.concatenate(which), owners


def scan(texts: list[bytes], patterns: Patterns):
    """Per text: number of words, positions hit (array) and the items found (set)."""
    ids, lens = [], []
    get = patterns.vocab.get
    for text in texts:
        w = words_of(text)
        ids.append(np.fromiter((get(x, 0) for x in w), np.int64, len(w)))
        ids.append(np.zeros(1, np.int64))  # no window goes over this mark
        lens.append(len(w))
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(np.array(lens, np.int64) + 1)])
    cover = np.zeros(len(flat) + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    for m, begin, which, owners in patterns.search(flat):
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + m, -1)
        for d, p in {(int(d), int(p)) for d, p in zip(np.searchsorted(starts, begin, "right") - 1, which)}:
            items[d].update(owners[p])
    hit = np.cumsum(cover)[:-1] > 0
    return [(n, np.flatnonzero(hit[s:s + n]), found) for n, s, found in zip(lens, starts, items)]


def verdict(n_words: int, n_hit: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def shards(benchmark: DataFrame, item_id: str, text: str, window: int, shard_windows: int) -> tuple[int, Iterator[list[tuple]]]:
    """Number of shards, and one after the other their items (id, text); an item is never cut."""
    items = stored(benchmark.select(F.monotonically_increasing_id().alias("n"), F.col(item_id).alias("i"),
                                    F.col(text).cast("string").alias("t")).where("t is not null"), "decontam-items")
    words = F.regexp_count("t", F.lit(WORD))
    total = items.agg(F.sum(F.greatest(words - (window - 1), F.lit(1)))).first()[0] or 0
    n = 1 + total // shard_windows

    def read() -> Iterator[list[tuple]]:
        for k in range(n):
            rows = items.where(F.pmod(F.xxhash64("n"), F.lit(n)) == k).select("i", F.col("t").cast("binary").alias("t"))
            yield [(r.i, bytes(r.t)) for r in rows.collect()]

    return n, read()


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def report(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", window: int = 13,
           shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """One row per document with its words hit, the items found and the verdict."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n, groups = shards(benchmark, item_id, item_text, window, shard_windows)
    if n == 1:
        pats = Patterns(next(groups), window)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = scan(text_bytes(batch.column(1)), pats)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), *(pa.array(x, t) for x, t in (
                        ([n for n, _, _ in out], pa.int64()), ([len(h) for _, h, _ in out], pa.int64()),
                        ([len(i) for _, _, i in out], pa.int64()), ([digest(i) for _, _, i in out], pa.string()),
                        ([verdict(n, len(h)) for n, h, _ in out], pa.bool_())))],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

        return src.mapInArrow(run, REPORT_SCHEMA)
    return _merged(src, groups, window)


def _merged(src: DataFrame, groups: Iterator[list[tuple]], window: int) -> DataFrame:
    """Several shards: a pass each over numbered rows, its hits written; then their union by row.

    The first pass lists every row, the others those they hit.
    """
    rows = stored(src.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    both = None
    for group in groups:
        pats, every = Patterns(group, window), both is None

        def run(batches, pats=pats, every=every):
            for batch in batches:
                out = scan(text_bytes(batch.column(1)), pats)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2), batch.column(0), pa.array([n for n, _, _ in out], pa.int64()),
                     pa.array([h.tolist() for _, h, _ in out], pa.list_(pa.int64())),
                     pa.array([sorted(map(str, i)) for _, _, i in out], pa.list_(pa.string()))],
                    names=["row", "doc_id", "n_words", "hits", "items"]).filter(
                    pa.array([every or len(h) > 0 for _, h, _ in out], pa.bool_()))

        found = stored(rows.mapInArrow(run, "row long, doc_id long, n_words long, hits array<long>, items array<string>"),
                       "decontam-hits")
        both = found if both is None else both.unionByName(found)
    sets = both.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                                   F.array_distinct(F.flatten(F.collect_list("hits"))).alias("h"),
                                   F.array_distinct(F.flatten(F.collect_list("items"))).alias("i"))
    n_hit = F.size("h").cast("long")
    return sets.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("i").cast("long").alias("n_items"),
                       F.sha2(F.array_join(F.array_sort("i"), ","), 256).alias("items_sha256"),
                       ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
          item_text: str = "text", window: int = 13, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    n, groups = shards(benchmark, item_id, item_text, window, shard_windows)
    at = docs.columns.index(text)
    if n == 1:
        pats = Patterns(next(groups), window)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = scan(text_bytes(batch.column(at)), pats)
                yield batch.filter(pa.array([not verdict(n, len(h)) for n, h, _ in out], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "decontam-docs")
    found = _merged(numbered.select(F.col("__row").alias("doc_id"), F.col(text).alias("text")), groups, window)
    bad = found.where("contaminated").select(F.col("doc_id").alias("__row"))
    return numbered.join(bad, "__row", "left_anti").drop("__row")
