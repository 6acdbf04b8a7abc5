"""Toxicity by compression distance: a zstandard dictionary trained on toxic text and one on ordinary text.

Both dictionaries come from a bounded sample of labelled documents (``sample_docs``
of each class, taken by hash of the id). Toxic documents are mostly ordinary
prose, so the windows that train the toxic dictionary are those holding a byte
sequence typical of the class: sequences too frequent there for chance are picked one
by one, each time the one that covers most toxic documents not yet covered often, less
its share in ordinary ones; windows that hold any are kept from the ordinary dictionary.
Every window (``window_words`` words) of a text is compressed under both dictionaries;
the difference of the lengths says which text it resembles. Windows are widened to two
bytes a letter first, the second a hash of the word so far: matches of short words then
pay for their sequence header, and only words that begin alike match. How many windows
reach each of a row of thresholds (of the difference, and of the difference a byte), and
at what rate, goes into a logistic function whose weights are calibrated on the sample.

Only ``toxic`` labels of the learning folds are read; nothing but the text is
scored. The model (two dictionaries, at most ``dict_bytes`` each, and some weights)
is what goes to the tasks; documents are not shuffled. The sample goes to one task, which
fits; the driver holds the model alone.

Cases: null text is empty; an empty text gets the score of no windows; null doc_ids
are scored and never learned from; a label given twice for a doc_id counts once as
toxic if any says so; without both classes in the sample the score is the share of
toxic labels (0 without labels); an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from staylens.llm.common import crc_fold, text_bytes, xx

THRESHOLDS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16)
RATES = (0.3, 0.45, 0.6, 0.75, 0.9, 1.1)  # differences a byte of the window
LENGTHS = (5, 6, 8)      # bytes of a typical sequence
COVER = 8                # times a toxic document is to be covered
SEQUENCES = 256          # at most so many typical sequences
MEMO = 400_000           # windows whose difference a task remembers


def windows(text: bytes, n: int) -> list[bytes]:
    w = text.lower().split()
    return [b" " + x + b" " for x in w] if n == 1 else [b" " + b" ".join(w[i:i + n]) + b" " for i in range(0, len(w), n)]


def _widen(window: bytes) -> bytes:
    """Each byte, and after it a byte that hashes the word so far."""
    out, h = bytearray(), 0
    for c in window:
        h = 0 if c == 32 else (h * 167 + c * 59 + 13) & 0xFF
        out += bytes((c, h))
    return bytes(out)


def _significant(k: np.ndarray, n: np.ndarray, p: float) -> np.ndarray:
    """Whether k of n is so far above the share p that no sequence should come so far by chance (Chernoff's bound)."""
    q = np.clip(k / np.maximum(n, 1), p, 1 - 1e-12)
    return n * (q * np.log(q / p) + (1 - q) * np.log((1 - q) / (1 - p))) >= np.log(max(len(k), 1)) + 2


class Sample:
    """The sample's windows by number: each document's windows, and each window's byte sequences."""

    def __init__(self, classes: list[list[bytes]], n: int):
        ids: dict[bytes, int] = {}
        self.docs = [[np.fromiter((ids.setdefault(w, len(ids)) for w in windows(t, n)), np.int64) for t in texts]
                     for texts in classes]
        self.windows = list(ids)
        count = [sum(max(len(w) - k + 1, 0) for k in LENGTHS) for w in self.windows]
        self.at = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        found = (xx(w[i:i + k]) for w in self.windows for k in LENGTHS for i in range(len(w) - k + 1))
        hashes = np.fromiter(found, np.uint64, int(self.at[-1]))
        # each sequence's first place gives its bytes
        _, self.first, self.sequence = np.unique(hashes, return_index=True, return_inverse=True)

    def sequences(self, doc: np.ndarray) -> np.ndarray:
        parts = [self.sequence[self.at[w]:self.at[w + 1]] for w in np.unique(doc)]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)

    def share(self, docs: list[np.ndarray]) -> np.ndarray:
        """Documents that hold each sequence."""
        n = np.zeros(len(self.first), np.int64)
        for doc in docs:
            n[self.sequences(doc)] += 1
        return n

    def typical(self) -> np.ndarray:
        """Sequences of the first class, chosen greedily by cover."""
        toxic, ordinary = self.docs
        in_toxic, in_ordinary = self.share(toxic), self.share(ordinary)
        n_toxic, n_ordinary = len(toxic), max(len(ordinary), 1)
        good = (in_toxic / n_toxic >= 4 * (in_ordinary + 1) / n_ordinary) & _significant(
            in_toxic, in_toxic + in_ordinary, n_toxic / (n_toxic + n_ordinary))
        number = np.cumsum(good) - 1
        held = [number[s[good[s]]] for s in map(self.sequences, toxic)]
        chosen, cost = np.flatnonzero(good), in_ordinary[good] / n_ordinary
        gain = in_toxic[good].astype(float)
        docs = np.repeat(np.arange(n_toxic), [len(h) for h in held])
        flat = np.concatenate(held) if held else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[order], np.arange(len(chosen) + 1))
        covered, picked = np.zeros(n_toxic, int), []
        while len(picked) < min(SEQUENCES, len(chosen)):
            worth = gain / n_toxic - cost
            best = int(worth.argmax())
            if worth[best] <= 0.003:
                break
            picked.append(chosen[best])
            gain[best] = -np.inf
            for d in docs[order[ends[best]:ends[best + 1]]]:
                covered[d] += 1
                if covered[d] == COVER:
                    gain[held[d]] -= 1
        return np.array(picked, np.int64)


class Model:
    """Two dictionaries and the calibration; picklable, compressors are made where it is used."""

    def __init__(self, window_words: int, rate: float = 0.0):
        self.window_words, self.rate = window_words, rate
        self.dicts, self.weights, self.mean, self.scale = None, None, None, None
        self._tools = None

    def __getstate__(self):
        return {**self.__dict__, "_tools": None}

    def _difference(self, window: bytes) -> int:
        if self._tools is None:
            made = []
            for data in self.dicts:
                d = zstandard.ZstdCompressionDict(data)
                p = zstandard.ZstdCompressionParameters.from_level(
                    3, min_match=3, write_content_size=False, write_dict_id=False, write_checksum=False)
                d.precompute_compress(compression_params=p)
                made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p))
            self._tools = (*made, {})
        ordinary, toxic, memo = self._tools
        got = memo.get(window)
        if got is None:
            wide = _widen(window)
            got = len(ordinary.compress(wide)) - len(toxic.compress(wide))
            if len(memo) >= MEMO:
                memo.clear()
            memo[window] = got
        return got

    def features(self, text: bytes) -> np.ndarray:
        w = windows(text, self.window_words)
        d = np.fromiter(map(self._difference, w), np.int64, len(w))
        rate = d / np.fromiter(map(len, w), np.int64, len(w))
        reach = np.array([*((d >= t).sum() for t in THRESHOLDS), *((rate >= t).sum() for t in RATES)], float)
        return np.concatenate([np.log1p(reach), reach / (len(w) + 3), [np.log1p(len(w))]])

    def fit(self, toxic: list[bytes], ordinary: list[bytes], dict_bytes: int):
        n = self.window_words
        sample = Sample([toxic, ordinary], n)
        marked = np.isin(sample.sequence, sample.typical())
        sums = np.concatenate([[0], np.cumsum(marked)])
        like = sums[sample.at[1:]] > sums[sample.at[:-1]]
        like_toxic = [_widen(sample.windows[w]) for doc in sample.docs[0] for w in doc[like[doc]]]
        common = np.zeros(len(sample.windows), np.int64)
        for doc in sample.docs[1]:
            common[np.unique(doc)] += 1
        common[like] = 0  # what is typical of the other class teaches the ordinary dictionary nothing
        top = np.argsort(-common, kind="stable")[:20_000]
        like_ordinary = [_widen(sample.windows[w]) for w in top[common[top] > 0]]
        del sample
        try:
            self.dicts = [zstandard.train_dictionary(dict_bytes, s).as_bytes() for s in (like_ordinary, like_toxic)]
        except zstandard.ZstdError:  # too little text to train on: the share of toxic labels stands
            self.dicts = None
            return self
        x = np.array([self.features(t) for t in (*toxic, *ordinary)])
        y = np.repeat([1.0, 0.0], [len(toxic), len(ordinary)])
        # the sample holds equal numbers of each class: weigh them by their shares
        share = np.where(y == 1, self.rate / max(len(toxic), 1), (1 - self.rate) / max(len(ordinary), 1)) * len(y)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        self.weights = _logistic((x - self.mean) / self.scale, y, share)
        return self

    def score(self, text: bytes) -> float:
        if self.dicts is None:
            return self.rate
        x = (self.features(text) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -40, 40))))


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = x.T @ (x * (share * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hess, x.T @ (share * (y - p)) - ridge * w)
    return w


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          mod: int = 5, held: int = 0, sample_docs: int = 2500, sample_bytes: int = 12 << 20, window_words: int = 1,
          dict_bytes: int = 4096) -> Model:
    """Fit on at most ``sample_docs`` toxic and as many ordinary documents (and ``sample_bytes`` of each),
    those whose ids hash lowest, outside the fold crc32(id) mod ``mod`` == ``held``."""
    marked = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y")).where("y in (0, 1) and id is not null")
              .where(crc_fold("id", mod) != held).groupBy("id").agg(F.max("y").alias("y")))
    counts = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    rate = counts.get(1, 0) / total if total else 0.0
    ids = [marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample_docs) for y in (1, 0)]
    picked = ids[0].union(ids[1])
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("t"))
    got = texts.join(F.broadcast(picked), "id")  # at most 2 * sample_docs ids
    rows = got.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "t").select("y", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample, size = ([], []), [0, 0]
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                if size[y] + len(t) <= sample_bytes:
                    size[y] += len(t)
                    sample[y].append(t)
        if sample[0] and sample[1]:
            model = Model(window_words, rate).fit(sample[1], sample[0], dict_bytes)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = rows.mapInArrow(run, "model binary").collect()  # one row: the fit's memory is a task's, not the driver's
    return pickle.loads(made[0].model) if made else Model(window_words, rate)


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text", mod: int = 5,
          held: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                      F.coalesce(crc_fold(doc_id, mod) == held, F.lit(False)).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([model.score(t) for t in text_bytes(batch.column(1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return src.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns as they are."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(t) < 0.5 for t in text_bytes(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
