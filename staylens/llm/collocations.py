"""Phrase collocations per language from sorted count streams, merge-joined in lockstep.

Counts of one, two and three words are gathered order by order. Each order is counted only
where both parts of the phrase can still reach ``min_count``: a bitmap of ``BITS`` bits holds
the hashes of the phrases of the order below that reach it. A bit that two hashes share lets a
phrase through that its count then drops, so the counts are exact whatever the fill; the bitmap
is the only thing sent to all tasks, and its size is fixed.

The counted phrases are then laid out as one stream in prefix order (first two words, then the
third) and one in suffix order (last two words, then the first), each range-partitioned and
sorted. A pair stands at the head of the phrases that extend it, so one pass over the sorted
stream hands the pair's count to its extensions (left count in prefix order, right count in
suffix order) and the largest extension count back to the pair. No hash table of phrases is
built and nothing is dealt by hash; a group is one pair with its extensions.

Cases: null text has no words; null language is ``und``; documents, pieces and languages never
share a phrase; repeated rows count again; empty tables give an empty result; phrases with equal
score and count rank by their bytes; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from staylens.llm.common import stored, text_bytes

# FIXED VALUES of the contract: characters that end a piece, characters between words.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
WORD_GAPS = " \t"

UND = "und"
CHUNK_BYTES = 8 << 20   # text counted together in a task before its counts are sent on
BATCH_ROWS = 1 << 16    # counted rows handed to Spark at a time
BITS = 1 << 26          # bitmap of frequent phrases: 8 MB, whatever the corpus
SLOT = 1 << 15          # bits of one bitmap aggregate
SPREAD = 8              # parts that the pairs of one word are dealt to

BREAK, GAP, FIRST_WORD = 0, 1, 2  # ids of the piece mark, of the empty token, of the first word


def _table() -> bytes:
    t = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        t[c] = c + 32
    for c in PIECE_ENDS:
        t[ord(c)] = ord("\n")
    for c in WORD_GAPS:
        t[ord(c)] = ord(" ")
    return bytes(t)


TABLE = _table()


class Chunk:
    """Texts of one language as numbers: word ids in order, piece ends as ``BREAK``."""

    def __init__(self, lang: str):
        self.lang, self.ids, self.seen = lang, [], {b"\n": BREAK, b"": GAP}

    def add(self, texts: list[bytes]) -> None:
        tokens = b"\n".join([*texts, b""]).translate(TABLE).replace(b"\n", b" \n ").split(b" ")
        for word in set(tokens) - self.seen.keys():
            self.seen[word] = len(self.seen)
        ids = np.fromiter(map(self.seen.__getitem__, tokens), np.int32, len(tokens))
        self.ids.append(ids[ids != GAP])

    def words(self) -> pa.Array:
        """The vocabulary; a word stands at its id."""
        return pa.array(list(self.seen), pa.binary()).view(pa.string())

    def flow(self) -> np.ndarray:
        flow = np.concatenate(self.ids).astype(np.int64)
        self.ids = []
        return flow

    def seed(self) -> int:
        return xxhash.xxh64_intdigest(self.lang.encode(), 42)

    def frequent(self, bits: np.ndarray) -> np.ndarray:
        """Per id: may the word reach the least count?"""
        seed = self.seed()
        ok = has(bits, (xxhash.xxh64_intdigest(w, seed) for w in self.seen), len(self.seen))
        ok[:FIRST_WORD] = False
        return ok


def has(bits: np.ndarray, hashes: Iterator[int], n: int) -> np.ndarray:
    last = 8 * len(bits) - 1
    at = np.fromiter((h & last for h in hashes), np.int64, n)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[Chunk]:
    """(lang, text) batches as chunks, one language each, of about ``chunk_bytes`` together."""
    held, size = {}, 0
    for batch in batches:
        by_lang: dict = {}
        for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            by_lang.setdefault(lang, []).append(text)
            size += len(text)
        for lang, texts in by_lang.items():
            held.setdefault(lang, Chunk(lang)).add(texts)
        if size >= chunk_bytes:
            yield from held.values()
            held, size = {}, 0
    yield from held.values()


def _rows(chunk: Chunk, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = chunk.words()
    names = ["lang", *(f"w{i + 1}" for i in range(len(columns))), "f"]
    for at in range(0, len(counts), BATCH_ROWS):
        n = counts[at:at + BATCH_ROWS]
        lang = pa.array([chunk.lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32)))
        yield pa.RecordBatch.from_arrays([lang, *(words.take(pa.array(c[at:at + BATCH_ROWS])) for c in columns), pa.array(n, pa.int64())],
                                         names=names)


def _singles(chunk_bytes: int):
    def run(batches):
        for chunk in chunks(batches, chunk_bytes):
            n = np.bincount(chunk.flow(), minlength=len(chunk.seen))
            at = np.flatnonzero(n[FIRST_WORD:]) + FIRST_WORD
            yield from _rows(chunk, [at], n[at])
    return run


def _pairs(chunk_bytes: int, words: np.ndarray):
    def run(batches):
        for chunk in chunks(batches, chunk_bytes):
            flow, v = chunk.flow(), len(chunk.seen)
            ok = chunk.frequent(words)[flow]
            at = np.flatnonzero(ok[:-1] & ok[1:])
            code, n = np.unique(flow[at] * v + flow[at + 1], return_counts=True)
            yield from _rows(chunk, [code // v, code % v], n)
    return run


def _both(code: np.ndarray, v: int, step: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """The two ids of every code, a stretch at a time."""
    for at in range(0, len(code), step):
        part = code[at:at + step]
        yield from zip((part // v).tolist(), (part % v).tolist())


def _triples(chunk_bytes: int, words: np.ndarray, pairs: np.ndarray):
    def run(batches):
        for chunk in chunks(batches, chunk_bytes):
            flow, v, seed = chunk.flow(), len(chunk.seen), chunk.seed()
            ok = chunk.frequent(words)[flow]
            at = np.flatnonzero(ok[:-1] & ok[1:])
            code, which = np.unique(flow[at] * v + flow[at + 1], return_inverse=True)
            vocab = list(chunk.seen)
            lead = {int(a): xxhash.xxh64_intdigest(vocab[a], seed) for a in np.unique(code // v)}
            good = has(pairs, (xxhash.xxh64_intdigest(vocab[b], lead[a]) for a, b in _both(code, v)), len(code))
            pair = np.full(len(flow), -1)
            pair[at] = np.where(good[which], which, -1)
            at = np.flatnonzero((pair[:-2] >= 0) & (pair[1:-1] >= 0))
            triple, n = np.unique(pair[at] * v + flow[at + 2], return_counts=True)
            first = code[triple // v]
            yield from _rows(chunk, [first // v, first % v, triple % v], n)
    return run


def _bitmap(frequent: DataFrame, size: int, *columns: str) -> np.ndarray:
    """``size`` bits of the hashes of the rows; at most ``size / SLOT`` rows of ``SLOT`` bits reach the driver."""
    at = F.pmod(F.xxhash64(*columns), F.lit(size))
    rows = (frequent.select(at.alias("at")).groupBy(F.floor(F.col("at") / SLOT).cast("int").alias("slot"))
            .agg(F.bitmap_construct_agg(F.col("at") % SLOT).alias("bits")).collect())
    out = np.zeros(size // 8, np.uint8)
    for r in rows:
        out[r.slot * (SLOT // 8):(r.slot + 1) * (SLOT // 8)] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def count_streams(docs: DataFrame, *, lang: str = "lang", text: str = "text",
                  min_count: int = 10, chunk_bytes: int = CHUNK_BYTES, bits: int = BITS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Word totals (lang, n) and the phrases of one, two and three words that occur ``min_count`` times."""
    src = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UND)).alias("lang"), F.col(text).alias("text"))

    def counted(run, order: int) -> DataFrame:
        words = [f"w{i + 1}" for i in range(order)]
        schema = "lang string, " + ", ".join(f"{w} string" for w in words) + ", f long"
        return src.mapInArrow(run, schema).groupBy("lang", *words).agg(F.sum("f").alias("f"))

    singles = stored(counted(_singles(chunk_bytes), 1), "collocations-1")
    totals = singles.groupBy("lang").agg(F.sum("f").alias("n"))
    enough = F.col("f") >= min_count
    singles = singles.where(enough)
    words = _bitmap(singles, bits, "lang", "w1")
    pairs = stored(counted(_pairs(chunk_bytes, words), 2).where(enough), "collocations-2")
    both = _bitmap(pairs, bits, "lang", "w1", "w2")
    triples = stored(counted(_triples(chunk_bytes, words, both), 3).where(enough), "collocations-3")
    return totals, singles, pairs, triples


def _merged(stream: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, Window, Window]:
    """The stream in order of ``keys`` then ``order`` (heads, null there, first), and windows over a key's rows."""
    sort = ["lang", *keys, *order]
    laid = stream.repartitionByRange("lang", *keys).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in sort])
    rows = Window.partitionBy("lang", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return laid, rows.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy("lang", *keys)


def _word_counts(pairs: DataFrame, singles: DataFrame, word: str, out: str) -> DataFrame:
    """The count of ``word`` beside every pair: words head the stream, in parts for words of many pairs."""
    part = F.pmod(F.xxhash64("w1", "w2"), F.lit(SPREAD)).cast("int")
    heads = singles.select("lang", F.col("w1").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"),
                           F.col("f").alias("head"))
    stream = (pairs.select("*", F.col(word).alias("k"), part.alias("part"))
              .unionByName(heads, allowMissingColumns=True))
    laid, rows, _ = _merged(stream, ["k", "part"], ["w1", "w2"])
    return laid.withColumn(out, F.first("head").over(rows)).where(F.col("w1").isNotNull()).drop("k", "part", "head")


def candidates(singles: DataFrame, pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """Phrases with their count ``a``, the counts of every cut's parts and ``longer``, the largest extension."""
    pairs = _word_counts(_word_counts(pairs, singles, "w1", "f_first"), singles, "w2", "f_last")
    stream = (pairs.select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "f", "f_first", "f_last")
              .unionByName(triples, allowMissingColumns=True))
    # prefix order: the first two words' pair heads its extensions to the right
    laid, rows, group = _merged(stream, ["w1", "w2"], ["w3"])
    extension = F.when(F.col("w3").isNotNull(), F.col("f"))
    prefixed = laid.select("*", F.first("f").over(rows).alias("left2"), F.first("f_first").over(rows).alias("left1"),
                           F.max(extension).over(group).alias("longer_right"))
    # suffix order: the last two words' pair heads its extensions to the left
    turned = prefixed.select("*", F.coalesce(F.when(F.col("w3").isNotNull(), F.col("w2")), F.col("w1")).alias("k1"),
                             F.coalesce("w3", "w2").alias("k2"), F.when(F.col("w3").isNotNull(), F.col("w1")).alias("before"))
    laid, rows, group = _merged(turned, ["k1", "k2"], ["before"])
    suffixed = laid.select("*", F.first("f").over(rows).alias("right2"), F.first("f_last").over(rows).alias("right1"),
                           F.max(F.when(F.col("before").isNotNull(), F.col("f"))).over(group).alias("longer_left"))
    is_pair = F.col("w3").isNull()
    return suffixed.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"),
        F.when(is_pair, F.col("f_first")).otherwise(F.col("left1")).alias("l1"),
        F.when(is_pair, F.col("f_last")).otherwise(F.col("right2")).alias("r1"),
        F.when(~is_pair, F.col("left2")).alias("l2"), F.when(~is_pair, F.col("right1")).alias("r2"),
        F.when(is_pair, F.greatest("longer_right", "longer_left")).alias("longer"))


def _score(left: str, right: str) -> str:
    # decimals of 38 digits: exact beyond 64 bits, for counts up to 10^15
    return (f"(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) "
            f"div (cast({left} as decimal(15,0)) * cast({right} as decimal(15,0)))")


def mine(docs: DataFrame, *, lang: str = "lang", text: str = "text", min_count: int = 10, share: int = 50,
         top: int = 2000, chunk_bytes: int = CHUNK_BYTES, bits: int = BITS) -> DataFrame:
    """The ``top`` collocations of each language.

    A candidate goes where a longer one that holds it occurs at least ``share`` per cent as often.
    """
    totals, singles, pairs, triples = count_streams(docs, lang=lang, text=text, min_count=min_count,
                                                    chunk_bytes=chunk_bytes, bits=bits)
    found = candidates(singles, pairs, triples).where(~F.coalesce(F.col("longer") * 100 >= F.col("a") * share, F.lit(False)))
    scored = (found.withColumn("s1", F.expr(_score("l1", "r1"))).withColumn("s2", F.expr(_score("l2", "r2")))
              .withColumn("second", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False)))
              .select("lang", "phrase", "a", F.when(F.col("second"), F.col("l2")).otherwise(F.col("l1")).alias("l"),
                      F.when(F.col("second"), F.col("r2")).otherwise(F.col("r1")).alias("r"),
                      F.when(F.col("second"), F.col("s2")).otherwise(F.col("s1")).alias("score")))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first the best of each part of a language, so that no task ranks a whole language
    part = Window.partitionBy("lang", "part").orderBy(*best)
    short = (scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
             .withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top).drop("rank", "part"))
    ranked = short.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return (ranked.where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
