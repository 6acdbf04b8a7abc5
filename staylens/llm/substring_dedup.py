"""Substring dedup by difference-cover anchors.

A window is ``window`` consecutive words. Hashes are taken only at positions
whose remainder modulo ``PERIOD`` lies in a difference cover, so that for any two
places some common shift (below the period) puts both on the cover: every
repeated window holds, at an equal offset, an anchor of ``window - PERIOD + 1``
words that both places hash. Anchors that occur once in the corpus rule out the
windows around them; the rest are extended to whole windows and compared by a
hash of all their words. Each word of a window whose word sequence starts
earlier elsewhere (smaller doc_id, or same document and earlier start) goes.

Anchors and windows are compared by key exchange between token blocks (see
blocks.py): a passage that fills a third of the corpus is one entry per block,
and no pairs of documents are formed.

Cases: null text has no words; a null doc_id comes after all others; rows with
the same doc_id count as the same document at the same place (a window that
starts at the same word of the same doc_id is not earlier, so neither goes); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from staylens.llm import blocks as B
from staylens.llm.common import mix, xx_array

# Every difference modulo 13 is a difference of two of these.
PERIOD, COVER = 13, (0, 1, 3, 9)
LAST = np.iinfo(np.int64).max
OUT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _rolling(b: B.Block, length: int, mult: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``length`` words from each position, and whether they lie in one document."""
    h = xx_array(b.words)[b.ids] if len(b.ids) else np.zeros(0, np.uint64)
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(len(h), np.uint64), np.zeros(len(h), bool)
    out = np.zeros(len(h), np.uint64)
    factor = 1
    for j in range(length):
        out[:n] += h[j:j + n] * np.uint64(factor)
        factor = factor * mult % (1 << 64)
    left = np.repeat(b.starts[1:], b.lens) - np.arange(len(h))
    return mix(out), left >= length


def _offsets(b: B.Block) -> np.ndarray:
    return np.arange(len(b.ids)) - np.repeat(b.starts[:-1], b.lens)


def _anchors(b: B.Block, length: int):
    h, whole = _rolling(b, length, 0x9E3779B97F4A7C15)
    at = np.flatnonzero(whole & np.isin(_offsets(b) % PERIOD, COVER))
    keys, inverse, n = np.unique(h[at], return_inverse=True, return_counts=True)
    return at, keys, inverse, n


def _shared(keys, slots, n, arrays):
    return [(np.bincount(slots, arrays[0], n) > 1).astype(np.uint8)[slots]]


def _windows(b: B.Block, window: int, live: np.ndarray, at: np.ndarray, inverse: np.ndarray):
    """Windows that hold a shared anchor: positions, distinct keys, each position's key number."""
    near = np.zeros(len(b.ids) + 1, np.int64)
    hits = at[live[inverse].astype(bool)] if len(at) else at
    np.add.at(near, np.maximum(hits - PERIOD + 1, 0), 1)
    np.add.at(near, hits + 1, -1)
    h, whole = _rolling(b, window, 0xD6E8FEB86659FD93)
    pos = np.flatnonzero(whole & (np.cumsum(near)[:-1] > 0))
    keys, inv = np.unique(h[pos], return_inverse=True)
    return pos, keys, inv


def _places(b: B.Block, pos: np.ndarray):
    number = np.repeat(np.arange(len(b.lens)), b.lens)[pos]
    docs = np.where(b.nulls, LAST, b.docs)[number]
    return docs, pos - b.starts[number]


def _earliest(slots, n, docs, offs):
    """Smallest (doc, offset) per slot."""
    order = np.lexsort((offs, docs, slots))
    first = np.searchsorted(slots[order], np.arange(n))
    return docs[order][first], offs[order][first]


def _first_seen(keys, slots, n, arrays):
    docs, offs = _earliest(slots, n, arrays[0], arrays[1].astype(np.int64))
    return [((arrays[0] == docs[slots]) & (arrays[1] == offs[slots])).astype(np.uint8)]


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = 20,
          block_tokens: int = B.BLOCK_TOKENS, keep_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, and (``keep_text``) the kept words themselves."""
    if window < PERIOD + 1:
        raise ValueError(f"window must exceed the cover's period {PERIOD}")
    length = window - PERIOD + 1
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(0).alias("fold"))
    table = B.write_blocks(src, "substring-blocks", lower=False, block_tokens=block_tokens)
    parts = B.part_count(table, block_tokens)

    def send_anchors(b):
        _, keys, _, n = _anchors(b, length)
        return keys, [np.minimum(n, 2).astype(np.uint8)]

    cols = [x.split()[0] for x in B.BLOCK_SCHEMA.split(", ")]

    def flag(row, arrays):
        return pd.DataFrame({**{k: [getattr(row, k)] for k in cols}, "live": [B.pack(arrays[0])]})

    shared = B.answer(B.send(table, parts, send_anchors), [np.uint8], _shared)
    flagged = B.stored(B.apply_replies(table, shared, [np.uint8], flag, B.BLOCK_SCHEMA + ", live binary"),
                       "substring-anchors")

    def candidates(b, live):
        at, _, inverse, _ = _anchors(b, length)
        return _windows(b, window, B.unpack(live, np.uint8), at, inverse)

    def send_windows(frames):
        for frame in frames:
            for row in frame.itertuples():
                b = B.Block(row)
                pos, keys, inv = candidates(b, row.live)
                d, o = _earliest(inv, len(keys), *_places(b, pos)) if len(pos) else (np.zeros(0, np.int64),) * 2
                cut = B.split_parts(keys, parts)
                yield pd.DataFrame({
                    "part": np.arange(parts, dtype=np.int32), "block": row.block,
                    "keys": [B.pack_sorted(keys[x:y]) for x, y in zip(cut, cut[1:])],
                    "data": [[B.pack(d[x:y]), B.pack(o[x:y].astype(np.uint32))] for x, y in zip(cut, cut[1:])]})

    first = B.answer(flagged.mapInPandas(send_windows, B.SENT_SCHEMA), [np.int64, np.uint32], _first_seen)

    def keep(row, arrays):
        b = B.Block(row)
        pos, keys, inv = candidates(b, row.live)
        gone = np.zeros(len(b.ids) + 1, np.int64)
        if len(pos):
            d, o = _places(b, pos)
            bd, bo = _earliest(inv, len(keys), d, o)
            late = ~(arrays[0].astype(bool)[inv] & (d == bd[inv]) & (o == bo[inv]))
            np.add.at(gone, pos[late], 1)
            np.add.at(gone, pos[late] + window, -1)
        kept = np.cumsum(gone)[:-1] == 0
        rows = []
        for s, e in zip(b.starts, b.starts[1:]):
            body = b" ".join([b.words[i] for i in b.ids[s:e][kept[s:e]]])
            rows.append((e - s, (~kept[s:e]).sum(), hashlib.sha256(body).hexdigest(),
                         body.decode() if keep_text else None))
        out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept"])
        out.insert(0, "doc_id", pd.array(b.doc_ids(), "Int64"))
        return out

    return B.apply_replies(flagged, first, [np.uint8], keep, OUT_SCHEMA)
