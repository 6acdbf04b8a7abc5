"""Token blocks: a corpus as rows of about ``block_tokens`` tokens, and key exchange between them.

Operators that must know how often a token sequence occurs in the whole corpus
would otherwise shuffle one row per token. Here each block reduces its own
sequences to distinct 64-bit keys, sends them to the part that owns the key
range (one packed row per block and part), and gets one answer per key back.
A key that fills a third of the corpus is still one entry per block, so no part
grows with a hot key; parts are equal ranges of hash values. Both the block
size (``block_tokens``) and the number of parts (one per ``block_tokens`` of
corpus) are bounded by the memory of one task, not by the corpus.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from staylens.llm.common import pack, pack_sorted, stored, text_bytes, unpack, unpack_sorted  # noqa: F401

BLOCK_TOKENS = 2_000_000
BLOCK_SCHEMA = "block long, n_tokens long, docs binary, nulls binary, folds binary, lens binary, ids binary, words binary"
SENT_SCHEMA = "part int, block long, keys binary, data array<binary>"
REPLY_SCHEMA = "part int, block long, data array<binary>"


class Block:
    """One block in memory: per document its id, fold and token count; token ids into ``words``
    (a row may leave the words out and give ``n_words``)."""

    def __init__(self, row):
        self.block = row.block
        self.docs = unpack(row.docs, np.int64)
        self.nulls = unpack(row.nulls, np.uint8).astype(bool)
        self.folds = unpack(row.folds, np.int8)
        self.lens = unpack(row.lens, np.int64)
        self.ids = unpack(row.ids, np.int32).astype(np.int64)
        if hasattr(row, "words"):
            self.words = zstandard.ZstdDecompressor().decompress(row.words).split(b"\n")
        self.n_words = len(self.words) if hasattr(row, "words") else row.n_words
        self.starts = np.concatenate([[0], np.cumsum(self.lens)])

    def doc_ids(self) -> list:
        return [None if null else int(d) for d, null in zip(self.docs, self.nulls)]


def _emit(docs, folds, lens, ids, words, number) -> pa.RecordBatch:
    comp = zstandard.ZstdCompressor(level=3)
    tokens = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    row = [number, len(tokens), pack(np.array([d or 0 for d in docs], np.int64)),
           pack(np.array([d is None for d in docs], np.uint8)), pack(np.array(folds, np.int8)),
           pack(np.array(lens, np.int64)), pack(tokens), comp.compress(b"\n".join(words))]
    names = [x.split()[0] for x in BLOCK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_pydict({n: pa.array([v], pa.int64() if i < 2 else pa.binary())
                                       for i, (n, v) in enumerate(zip(names, row))})


def write_blocks(docs: DataFrame, name: str, *, lower: bool, markers: int = 0,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Stored block table of ``docs`` (doc_id long, text string, fold byte).

    Words are `[^\\x20\\x09-\\x0D]+`. The first ``markers`` dictionary entries are
    b"" and runs of spaces: no word, free for an operator's own marks. A text
    larger than a block makes a block of its own. Null text: no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0

        def fresh():
            ids = defaultdict(itertools.count().__next__)
            for k in range(markers):
                ids[b" " * k]
            return ids, [], [], [], [], 0

        words, doc_ids, folds, lens, tokens, total = fresh()
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for d, text, fold in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
                found = (text.lower() if lower else text).split()
                doc_ids.append(d)
                folds.append(fold)
                lens.append(len(found))
                tokens.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
                total += len(found)
                if total >= block_tokens:
                    yield _emit(doc_ids, folds, lens, tokens, list(words), base + number)
                    number += 1
                    words, doc_ids, folds, lens, tokens, total = fresh()
        if doc_ids:
            yield _emit(doc_ids, folds, lens, tokens, list(words), base + number)

    cols = docs.select(F.col("doc_id").cast("long"), "text", F.col("fold").cast("int"))
    return stored(cols.mapInArrow(run, BLOCK_SCHEMA), name)


def part_count(blocks: DataFrame, block_tokens: int = BLOCK_TOKENS) -> int:
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    return int(min(1 << 20, max(16, -(-tokens // (block_tokens // 2)))))


def split_parts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of each part in ascending ``keys``: parts + 1 positions."""
    edges = np.array([(p << 32) // parts for p in range(1, parts)], np.uint64) << np.uint64(32)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def send(blocks: DataFrame, parts: int, keyed: Callable[[Block], tuple[np.ndarray, list[np.ndarray]]]) -> DataFrame:
    """One row per block and part. ``keyed`` gives ascending distinct keys and arrays along them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                keys, data = keyed(Block(row))
                at = split_parts(keys, parts)
                yield pd.DataFrame({
                    "part": np.arange(parts, dtype=np.int32), "block": row.block,
                    "keys": [pack_sorted(keys[a:b]) for a, b in zip(at, at[1:])],
                    "data": [[pack(x[a:b]) for x in data] for a, b in zip(at, at[1:])]})

    return blocks.mapInPandas(run, SENT_SCHEMA)


def answer(sent: DataFrame, dtypes: list, reply: Callable) -> DataFrame:
    """Reply rows, one per row sent: ``reply(keys, slots, n, arrays)`` gives arrays along all rows' entries.

    ``keys`` are the entries of every block one after another, ``slots`` number
    equal keys alike from 0 to n - 1, ``arrays`` are the sent arrays. What it
    returns is cut back into the blocks' rows; a scalar goes to each row.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(k) for k in group["keys"]]
        lens = [len(k) for k in keys]
        arrays = [np.concatenate([unpack(d[i], t) for d in group["data"]]) for i, t in enumerate(dtypes)]
        distinct, slots = np.unique(np.concatenate(keys), return_inverse=True)
        out = reply(distinct, slots, len(distinct), arrays)
        at = np.concatenate([[0], np.cumsum(lens)])
        data = [[pack(np.array([x])) if np.isscalar(x) else pack(x[a:b]) for x in out] for a, b in zip(at, at[1:])]
        return pd.DataFrame({"part": group["part"], "block": group["block"], "data": data})

    return sent.groupBy("part").applyInPandas(run, REPLY_SCHEMA)


def apply_replies(blocks: DataFrame, replies: DataFrame, dtypes: list, use: Callable, schema: str) -> DataFrame:
    """``use(block, arrays)`` for each block with the answers to its keys, in the order sent.

    arrays[i] is the i-th answer over all parts one after another.
    """

    def run(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = right.sort_values("part")["data"].tolist()
        arrays = [np.concatenate([unpack(d[i], t) for d in rows]) for i, t in enumerate(dtypes)]
        return pd.concat([use(row, arrays) for row in left.itertuples()], ignore_index=True)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(run, schema)
