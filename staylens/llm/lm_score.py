"""Deleted interpolation: a bigram model whose mixture weights depend on how often the context was seen.

p(w | v) = l2(b) c(v,w)/c(v) + l1(b) c(w)/N + l0(b) / (V+1), b the bucket of c(v)
(one per power of two). The weights of each bucket are learned by expectation-
maximisation on held-out counts: training documents of fold ``em_fold`` are
counted apart from the others, and the weights maximise their likelihood under
the others' counts. The scored model then uses the counts of all training
documents. Tokens are the words and one end per text; the first context is a
begin mark that is no token.

Counting is a key exchange between token blocks (see blocks.py): distinct
unigrams and bigrams of a block go to the part owning the hash, the corpus
counts come back. Nothing is cut off by frequency. The driver receives only the
EM histogram, whose cells are (bucket, quantised ratios of the three estimates
in 1/8 octaves): bounded by the number of cells, not by the corpus.

Cases: null or empty text is the end alone; a null doc_id is trained on and
scored; repeated rows are scored one by one (each trains); an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from staylens.llm import blocks as B
from staylens.llm.common import crc_fold, mix, stored, xx_array

END, BEGIN = 0, 1  # dictionary entries b"" and b" " of a block
BUCKETS = 40       # bucket 0: context never seen; k: 2^(k-1) <= count < 2^k
STEP = 8           # histogram cells per octave
SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")


def _grams(b: B.Block):
    """Token ids with ends, each token's context, document number, and distinct pairs of the block."""
    n_docs = len(b.lens)
    tok = np.insert(b.ids, b.starts[1:], END)
    lens = b.lens + 1
    doc = np.repeat(np.arange(n_docs), lens)
    ctx = np.empty_like(tok)
    ctx[1:] = tok[:-1]
    ctx[np.concatenate([[0], np.cumsum(lens)[:-1]])] = BEGIN
    pairs, inverse = np.unique(ctx * b.n_words + tok, return_inverse=True)
    return tok, ctx, doc, pairs, inverse


def _keys(b: B.Block, pairs: np.ndarray):
    """64-bit keys of the block's words and pairs, and the order that sorts them all."""
    h = xx_array(b.words)
    uni = mix(h)
    bi = mix(h[pairs // len(b.words)] * np.uint64(0x9E3779B97F4A7C15) + h[pairs % len(b.words)] + np.uint64(1))
    keys = np.concatenate([uni, bi])
    return keys, np.argsort(keys, kind="stable"), len(uni)


def _counts(b: B.Block, tok, ctx, doc, inverse, n_pairs, fold):
    """Occurrences of each word (begin marks as contexts) and pair in the fold's documents."""
    use = b.folds[doc] == fold
    uni = np.bincount(tok[use], minlength=len(b.words))
    uni[BEGIN] = (b.folds == fold).sum()
    return np.concatenate([uni, np.bincount(inverse[use], minlength=n_pairs)])


def _sent(b: B.Block):
    tok, ctx, doc, pairs, inverse = _grams(b)
    keys, order, n_uni = _keys(b, pairs)
    a, held = (_counts(b, tok, ctx, doc, inverse, len(pairs), f).astype(np.uint32)[order] for f in (0, 1))
    kind = (np.arange(len(keys)) < n_uni).astype(np.uint8)
    kind[BEGIN] = 2  # a context, not a type
    return keys[order], [a, held, kind[order]]


def _reply(keys, slots, n, arrays):
    a, held, kind = arrays
    sum_a, sum_held = (np.bincount(slots, x, n).astype(np.uint64) for x in (a, held))
    is_word = np.zeros(n, bool)
    is_word[slots[kind == 1]] = True
    types = [np.uint64((is_word & (s > 0)).sum()) for s in (sum_a, sum_a + sum_held)]
    return [sum_a[slots], sum_held[slots], *types]


def _unsort(b: B.Block, counts: np.ndarray, pairs: np.ndarray) -> list[bytes]:
    """Corpus counts of the block's words and pairs, in its own order, packed."""
    _, order, n_uni = _keys(b, pairs)
    out = np.empty_like(counts)
    out[order] = counts
    return [B.pack(out[:n_uni]), B.pack(out[n_uni:])]


def _known(row, all_training: bool) -> tuple[np.ndarray, np.ndarray]:
    """Counts of words and pairs outside the held-out fold, or in all training documents."""
    a_uni, a_bi, h_uni, h_bi = (B.unpack(x, np.uint64) for x in row.counts)
    return (a_uni + h_uni, a_bi + h_bi) if all_training else (a_uni, a_bi)


def _bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(c > 0, np.floor(np.log2(np.maximum(c, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)


def _estimates(b, pairs, uni, bi, total, types):
    v, w = pairs // b.n_words, pairs % b.n_words
    c = uni[v]
    return _bucket(c), np.where(c > 0, bi / np.maximum(c, 1), 0.0), uni[w] / max(total, 1), 1.0 / (types + 1)


def learn_weights(cells: pd.DataFrame, rounds: int = 60) -> np.ndarray:
    """EM over histogram cells (bucket, q2, q1, n): weights [bucket, (bigram, unigram, uniform)].

    q are the log2 ratios of an estimate to the uniform one, in 1/STEP octaves
    (-1 << 20: estimate is zero). A bucket without held-out counts keeps the start.
    """
    lam = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    lam[0] = [0.0, 0.8, 0.2]
    if not len(cells):
        return lam
    bucket, n = cells["bucket"].to_numpy(), cells["n"].to_numpy(float)
    ratio = np.stack([*(np.where(cells[q] > -(1 << 20), 2.0 ** (cells[q].to_numpy(float) / STEP), 0.0)
                        for q in ("q2", "q1")), np.ones(len(cells))], axis=1)
    weight = np.bincount(bucket, n, BUCKETS)
    for _ in range(rounds):
        part = lam[bucket] * ratio
        part *= (n / part.sum(axis=1))[:, None]
        new = np.stack([np.bincount(bucket, part[:, k], BUCKETS) for k in range(3)], axis=1)
        seen = weight > 0
        # one pseudo-count spread over the components keeps every text possible
        lam[seen] = (new[seen] + lam[seen] * [0.0, 0.5, 0.5] + 1e-3) / (weight[seen] + 3e-3 + 0.5 * lam[seen][:, 1:].sum(1))[:, None]
        lam[0, 0] = 0.0
        lam /= lam.sum(axis=1, keepdims=True)
    return lam


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", mod: int = 7, held: int = 2,
          em_fold: int = 3, block_tokens: int = B.BLOCK_TOKENS) -> DataFrame:
    """Score every text; documents with crc32(id) mod ``mod`` == ``held`` are never learned from."""
    rest = crc_fold(doc_id, mod)
    fold = F.when(rest == held, 2).when(rest == em_fold, 1).otherwise(0)
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), fold.alias("fold"))
    table = B.write_blocks(src, "lm-blocks", lower=True, markers=2, block_tokens=block_tokens)

    def sizes(frames):
        for frame in frames:
            for row in frame.itertuples():
                b_folds, lens = B.unpack(row.folds, np.int8), B.unpack(row.lens, np.int64) + 1
                yield pd.DataFrame({"a": [int(lens[b_folds == 0].sum())], "t": [int(lens[b_folds != 2].sum())]})

    n_a, n_all = table.select("folds", "lens").mapInPandas(sizes, "a long, t long").agg(F.sum("a"), F.sum("t")).first()
    n_a, n_all = n_a or 0, n_all or 0
    parts = B.part_count(table, block_tokens)
    replies = B.answer(B.send(table, parts, _sent), [np.uint32, np.uint32, np.uint8], _reply)

    def counted(row, arrays):
        b = B.Block(row)
        pairs = _grams(b)[3]
        return pd.DataFrame({**{k: [getattr(row, k)] for k in cols}, "n_words": [b.n_words],
                             "counts": [[x for c in arrays[:2] for x in _unsort(b, c, pairs)]],
                             "types": [[int(arrays[2].sum()), int(arrays[3].sum())]]})

    # later passes need the tokens and counts, not the words
    kept = [x for x in B.BLOCK_SCHEMA.split(", ") if x != "words binary"]
    cols = [x.split()[0] for x in kept]
    known = stored(B.apply_replies(table, replies, [np.uint64] * 4, counted,
                                   ", ".join([*kept, "n_words long, counts array<binary>, types array<long>"])), "lm-counts")

    def histogram(frames):
        for frame in frames:
            for row in frame.itertuples():
                b = B.Block(row)
                if not (b.folds == 1).any():
                    continue
                tok, ctx, doc, pairs, inverse = _grams(b)
                n = np.bincount(inverse[b.folds[doc] == 1], minlength=len(pairs))
                uni, bi = _known(row, False)
                bucket, p2, p1, p0 = _estimates(b, pairs, uni, bi, n_a, row.types[0])
                q = [np.where(p > 0, np.round(np.log2(np.maximum(p, 1e-300) / p0) * STEP), -(1 << 20)).astype(np.int64)
                     for p in (p2, p1)]
                yield (pd.DataFrame({"bucket": bucket, "q2": q[0], "q1": q[1], "n": n})[n > 0]
                       .groupby(["bucket", "q2", "q1"], as_index=False)["n"].sum())

    cells = (known.mapInPandas(histogram, "bucket long, q2 long, q1 long, n long")
             .groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n")).toPandas())
    lam = learn_weights(cells.sort_values(["bucket", "q2", "q1"]))

    def final(frames):
        for frame in frames:
            for row in frame.itertuples():
                b = B.Block(row)
                tok, ctx, doc, pairs, inverse = _grams(b)
                uni, bi = _known(row, True)
                types = row.types[1]
                bucket, p2, p1, p0 = _estimates(b, pairs, uni, bi, n_all, types)
                x = lam[bucket]
                logp = np.log10(x[:, 0] * p2 + x[:, 1] * p1 + x[:, 2] * p0)
                base = np.log10((uni + 1) / (n_all + (types + 1)))
                n_docs = len(b.lens)
                yield pd.DataFrame({
                    "doc_id": pd.array(b.doc_ids(), "Int64"), "held_out": b.folds == 2, "n_tokens": b.lens + 1,
                    "n_known": np.bincount(doc, uni[tok] > 0, n_docs).astype(np.int64), "train_tokens": n_all,
                    "base_score": np.bincount(doc, base[tok], n_docs), "score": np.bincount(doc, logp[inverse], n_docs)})

    return known.mapInPandas(final, SCORE_SCHEMA)
