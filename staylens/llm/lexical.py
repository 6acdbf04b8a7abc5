"""Ranked lexical search over bit-sliced Bloom signatures.

Index: documents in blocks of up to ``BLOCK_ROWS`` of like length. A block is a bit matrix, a
bit position a row and a document a column; a term that occurs tf times sets ``HASHES``
positions for each of the levels 1, 2, 4, .. up to tf. The number of positions is in proportion
to the longest document of the block, so the share of set bits stays the same at every length.

Search: the AND of a term's rows overestimates in which documents of a block it stands, level by
level how often. Every level's slice is weighted by what the term can add to the score at that
level; the sum is an upper bound of the score of each document. Documents whose bound is below
the worst of the best scores already found are excluded; all others are tokenised and scored
exactly. A task keeps the best of the blocks it has read, so its bar rises as it goes; the
best of all tasks are ranked at the end.

Queries are dealt by hash into shards of about ``SHARD_TERMS`` terms; the driver holds one
shard at a time, and each shard's results are written before the next is read.

Cases: null or empty text has no terms and is neither counted nor found; a null item text or an
item without known terms finds nothing; equal scores rank by ascending doc_id (null last), copies
of a row are ranked one after another; each benchmark row is a query of its own; very long texts
are whole; empty tables give an empty result; other columns of the inputs are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from staylens.llm.common import stored, text_bytes

# FIXED VALUE of the contract: a term is a maximal match.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

BLOCK_ROWS = 256          # documents of a block
BLOCK_BYTES = 16 << 20    # text of a block (one longer document is a block of its own)
SORT_ROWS = 4096          # documents that are put in order of length before they are cut into blocks
SORT_BYTES = 64 << 20
HASHES = 3
BITS_PER_ENTRY = 12       # signature positions for each entry of the longest document: 1 % false entries
SHARD_TERMS = 20_000      # terms of a query shard
BEST = 20

INDEX_SCHEMA = "ids array<long>, sizes array<long>, texts array<binary>, positions long, levels int, slices binary"
FOUND_SCHEMA = "query long, doc_id long, score long, task int"


def _table() -> bytes:
    t = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        t[c] = c
    for c in range(ord("A"), ord("Z") + 1):
        t[c] = c + 32
    return bytes(t)


TABLE = _table()


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(TABLE).split()


# --- index ---

def _positions(hashes: np.ndarray, level: np.ndarray | int, positions: int) -> np.ndarray:
    """``HASHES`` positions of each (term hash, level), by double hashing."""
    h = hashes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(1) * np.asarray(level, np.uint64)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(32))
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((a + steps * b) % np.uint64(positions)).astype(np.int64)


def _block(rows: list[tuple], bits_per_entry: int = BITS_PER_ENTRY) -> dict:
    """One index row of documents (id, text, term counts)."""
    seen: dict = {}
    term, doc, tf = [], [], []
    for column, (_, _, counts) in enumerate(rows):
        term += [seen.setdefault(w, len(seen)) for w in counts]
        tf += counts.values()
        doc += [column] * len(counts)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, seen), np.uint64, len(seen))
    term, doc, tf = (np.array(x, np.int64) for x in (term, doc, tf))
    top = np.frexp(tf.astype(float))[1]  # levels 0..top-1: tf >= 2^level
    entries = np.bincount(doc, top, minlength=len(rows)).max() if len(tf) else 0
    positions = max(64, int(entries) * bits_per_entry)
    matrix = np.zeros((positions, (len(rows) + 7) // 8), np.uint8)
    for level in range(int(top.max()) if len(tf) else 0):
        on = top > level
        at = _positions(hashes[term[on]], level, positions)
        np.bitwise_or.at(matrix, (at, doc[on] >> 3), (1 << (doc[on] & 7)).astype(np.uint8))
    return {"ids": [i for i, _, _ in rows], "sizes": [sum(c.values()) for _, _, c in rows], "texts": [t for _, t, _ in rows],
            "positions": positions, "levels": int(top.max()) if len(tf) else 0, "slices": matrix.tobytes()}


def _blocks(block_rows: int, sort_rows: int, bits_per_entry: int):
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary())),
                        ("positions", pa.int64()), ("levels", pa.int32()), ("slices", pa.binary())])

    def cut(held):
        held.sort(key=lambda r: len(r[2]))
        part, size = [], 0
        for r in held:
            if part and (len(part) == block_rows or size + len(r[1]) > BLOCK_BYTES):
                yield pa.RecordBatch.from_pylist([_block(part, bits_per_entry)], schema)
                part, size = [], 0
            part.append(r)
            size += len(r[1])
        if part:
            yield pa.RecordBatch.from_pylist([_block(part, bits_per_entry)], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                counts = Counter(terms_of(t))
                if counts:
                    held.append((i, t, counts))
                    size += len(t)
                if len(held) == sort_rows or size > SORT_BYTES:
                    yield from cut(held)
                    held, size = [], 0
        yield from cut(held)

    return run


def index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS,
          sort_rows: int = SORT_ROWS, bits_per_entry: int = BITS_PER_ENTRY) -> DataFrame:
    """The written index of the documents that have a term."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stored(src.mapInArrow(_blocks(block_rows, sort_rows, bits_per_entry), INDEX_SCHEMA), "lexical-index")


# --- queries ---

class Shard:
    """Queries with their terms numbered: term ``t`` of ``terms``, per query its terms and how often."""

    def __init__(self, rows: list[tuple]):
        self.number: dict[bytes, int] = {}
        self.queries = []
        for query, text in rows:
            counts = Counter(terms_of(text))
            at = np.array([self.number.setdefault(w, len(self.number)) for w in counts], np.int64)
            self.queries.append((query, at, np.array(list(counts.values()), np.int64)))

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.number), np.uint64, len(self.number))


def _document_counts(number: dict):
    """Per task, in how many documents each of the numbered terms stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(number), np.int64)
        for batch in batches:
            for texts in batch.column(0).to_pylist():
                for t in texts:
                    for w in set(terms_of(t)) & number.keys():
                        n[number[w]] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["term", "df"])
    return run


def contribution(tf, m):
    """What a term that occurs ``tf`` times adds for each unit of its weight (rises with tf)."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Searcher:
    """One shard's queries against index blocks; keeps the best documents of each query."""

    def __init__(self, shard: Shard, weights: np.ndarray, n_docs: int, n_terms: int, best: int):
        self.shard, self.weights, self.best = shard, weights, best
        self.n_docs, self.n_terms = n_docs, n_terms
        self.hashes = shard.hashes()
        self.kept = [[] for _ in shard.queries]  # (score, doc_id) of at most ``best`` documents
        self.bar = [1] * len(shard.queries)      # a score below it cannot be among them
        self.rescored = self.possible = 0

    def _bounds(self, block, m: np.ndarray) -> np.ndarray:
        """Per term and document the most that the term can add, by the slices."""
        cols = len(m)
        slices = np.frombuffer(block["slices"], np.uint8).reshape(block["positions"], -1)
        out = np.zeros((len(self.hashes), cols), np.int64)
        low = np.zeros(cols, np.int64)
        alive = np.arange(len(self.hashes))
        for level in range(block["levels"]):
            rows = slices[_positions(self.hashes[alive], level, block["positions"])]
            both = np.bitwise_and.reduce(rows, axis=0)
            some = both.any(axis=1)
            alive, both = alive[some], both[some]  # a term that reaches no document here reaches none above
            if not len(alive):
                break
            high = contribution((2 << level) - 1, m)
            out[alive] += np.unpackbits(both, axis=1, count=cols, bitorder="little") * (high - low)
            low = high
        return out

    def read(self, block: dict) -> None:
        sizes, ids = np.array(block["sizes"], np.int64), block["ids"]
        m = 100 - 25 + (25 * sizes * self.n_docs) // self.n_terms
        bound = self._bounds(block, m) * self.weights[:, None]
        tf: dict = {}

        def exact(query: int, columns: np.ndarray) -> None:
            _, at, times = self.shard.queries[query]
            for c in columns.tolist():
                if c not in tf:
                    column = np.zeros(len(self.hashes), np.int64)
                    for w, n in Counter(terms_of(block["texts"][c])).items():
                        t = self.shard.number.get(w)
                        if t is not None:
                            column[t] = n
                    tf[c] = column
            found = np.array([tf[c][at] for c in columns.tolist()])
            score = (contribution(found, m[columns][:, None]) * (self.weights[at] * times)).sum(axis=1)
            self.rescored += len(columns)
            kept = self.kept[query] + [(int(s), ids[c]) for s, c in zip(score, columns.tolist()) if s > 0]
            kept.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
            self.kept[query] = kept[:self.best]
            if len(kept) >= self.best:
                self.bar[query] = self.kept[query][-1][0]  # a document with this very score may rank before by its id

        for query, (_, at, times) in enumerate(self.shard.queries):
            if not len(at):
                continue
            most = (bound[at] * times[:, None]).sum(axis=0)
            self.possible += len(most)
            open_ = np.flatnonzero(most >= self.bar[query])
            if len(open_) > self.best:  # the most promising first: they raise the bar for the others
                first = open_[np.argpartition(-most[open_], self.best - 1)[:self.best]]
                exact(query, first)
                open_ = np.setdiff1d(open_[most[open_] >= self.bar[query]], first)
            if len(open_):
                exact(query, open_)


def _search(shard: Shard, weights: np.ndarray, n_docs: int, n_terms: int, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        s = Searcher(shard, weights, n_docs, n_terms, best)
        for batch in batches:
            for block in batch.to_pylist():
                s.read(block)
        rows = [(q[0], d, x) for q, kept in zip(shard.queries, s.kept) for x, d in kept]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()), pa.array([task] * len(rows), pa.int32())],
            names=["query", "doc_id", "score", "task"])
    return run


def search(index: DataFrame, queries: DataFrame, *, item_id: str = "item_id", text: str = "text", best: int = BEST,
           shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The ``best`` documents of every query row: item_id, rank, doc_id, score."""
    spark = index.sparkSession
    items = stored(queries.select(F.monotonically_increasing_id().alias("query"), F.col(item_id).alias("item_id"),
                                  F.col(text).cast("binary").alias("text")), "lexical-queries")
    size = index.select(F.explode("sizes").alias("n")).agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    total = items.agg(F.sum(F.regexp_count(F.col("text").cast("string"), F.lit(TERM)))).first()[0] or 0
    n_shards = 1 + total // shard_terms
    found = None
    for k in range(n_shards):
        rows = items.where((F.pmod(F.xxhash64("query"), F.lit(n_shards)) == k) & F.col("text").isNotNull())
        shard = Shard([(r["query"], bytes(r["text"])) for r in rows.select("query", "text").collect()])
        df = np.zeros(len(shard.number), np.int64)
        counted = index.select("texts").mapInArrow(_document_counts(shard.number), "term long, df long")
        for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        weights = np.array([weight(size["docs"], n) for n in df.tolist()], np.int64)
        part = stored(index.mapInArrow(_search(shard, weights, size["docs"], size["terms"] or 1, best), FOUND_SCHEMA),
                      f"lexical-found-{k}")
        found = part if found is None else found.unionByName(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]

    def first(df: DataFrame, *keys) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy("query", *keys).orderBy(*order))) \
            .where(F.col("rank") <= best)

    short = first(found.withColumn("part", F.col("task") % 64), "part").drop("rank", "part", "task")
    return first(short).join(items.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
