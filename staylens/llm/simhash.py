"""SimHash near-duplicates, linked through BK-trees.

A text's fingerprint has a bit set where over half of its shingles' XXH64 values
have it. Fingerprints at most ``radius`` bits apart link; a component is what
links reach. The distinct fingerprints are dealt to shards: 64 bits fall into
four bands, the other three bands of each into four pieces, and two fingerprints
at most three bits apart agree on some band and, there, on some piece. Each of
the 16 (band, piece) values names a shard, and each shard has its BK-tree:
children keyed by their Hamming distance to the parent, a search following only
edges within the radius of the query's own distance. All shard trees together
grow with the corpus, so they are not broadcast: a tree is built in the task that
holds its shard's queries. A shard of more than ``shard_rows`` fingerprints is cut
into salted chunks, and every pair of chunks is a task's unit of its own. A unit
returns a spanning forest of its links (fewer links than fingerprints), never
all pairs. Components are then found by alternating large and small stars, each
round written to the shared checkpoint folder.

Cases: null or wordless texts have fingerprint zero and link like any other; a
null doc_id takes part by its text, and is a component id only where no other id
is in the component; repeated rows give repeated result rows; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from staylens.llm.common import stored, text_bytes, xx

MAX_RADIUS = 3  # the sharding rule holds up to three bits
LEAF = 32       # items below which a subtree is compared directly


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xx(b" ".join(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    h = np.fromiter((xx(joined[a:b]) for a, b in spans), np.uint64, len(words) - shingle + 1)
    count = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        count += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str, shingle: int, name: str) -> DataFrame:
    """``docs`` and one more column ``name``: the fingerprint as a signed long."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(at))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))],
                                             names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def bk_links(items: np.ndarray, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (item, query) within the radius, by descending a BK-tree with all queries at once."""

    def dist(x, pivot):
        return np.bitwise_count(x ^ pivot).astype(np.int16)

    todo = [(np.arange(len(items)), np.arange(len(queries)))]
    while todo:
        own, ask = todo.pop()
        if len(own) <= LEAF:
            d = np.bitwise_count(items[own][:, None] ^ queries[ask][None, :])
            a, b = np.nonzero(d <= radius)
            yield own[a], ask[b]
            continue
        pivot = items[own[0]]
        d_own, d_ask = dist(items[own], pivot), dist(queries[ask], pivot)
        near = ask[d_ask <= radius]
        yield np.full(len(near), own[0]), near
        d_own[0] = -1
        for edge in np.unique(d_own[1:]):
            child, follow = own[d_own == edge], ask[np.abs(d_ask - edge) <= radius]
            if len(follow):
                todo.append((child, follow))


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest of its component) within one unit."""
    label = np.arange(len(fps))
    pairs = list(bk_links(fps, fps, radius))
    a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            break
        label = low
    odd = label != np.arange(len(fps))
    return fps[odd], fps[label[odd]]


def _links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Forests of the units of a sorted partition; a unit may go over several batches."""
    rest = None
    for frame in batches:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        unit = frame[["key", "lo", "hi"]].to_numpy()
        cuts = np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1
        last = cuts[-1] if len(cuts) else 0
        rest = frame.iloc[last:]
        yield _forests(frame["fp"].to_numpy()[:last], cuts, radius)
    if rest is not None and len(rest):
        yield _forests(rest["fp"].to_numpy(), [len(rest)], radius)


def _forests(fps, cuts, radius) -> pd.DataFrame:
    a, b, start = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    fps = fps.astype(np.int64).view(np.uint64)
    for cut in cuts:
        if cut - start == 2:
            if int(fps[start] ^ fps[start + 1]).bit_count() <= radius:
                a.append(fps[start + 1:cut])
                b.append(fps[start:start + 1])
        elif cut - start > 2:
            x, y = forest(fps[start:cut], radius)
            a.append(x)
            b.append(y)
        start = cut
    return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})


def shard_keys(fp) -> list:
    out = []
    for i in range(4):
        band = F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
        low = fp.bitwiseAND(F.lit((1 << 16 * i) - 1))
        rest = low if i == 3 else F.shiftleft(F.shiftrightunsigned(fp, 16 * (i + 1)), 16 * i).bitwiseOR(low)
        for j in range(4):
            piece = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            out.append(F.lit((4 * i + j) << 28).cast("long").bitwiseOR(F.shiftleft(band, 12)).bitwiseOR(piece))
    return out


def links(fps: DataFrame, radius: int = 3, shard_rows: int = 1000) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fp`` that span every component."""
    if not 0 <= radius <= MAX_RADIUS:
        raise ValueError(f"radius must be 0 to {MAX_RADIUS}")
    keyed = fps.select("fp", F.explode(F.array(*shard_keys(F.col("fp")))).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / shard_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    units = (keyed.join(sizes, "key")
             .select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
             .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    dealt = units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInPandas(lambda b: _links(b, radius), "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): each linked node's smallest reachable node, by large and small stars."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        pairs = e.select("a", "b").union(e.select(F.col("b"), F.col("a"))) if large else \
            e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        both = pairs.join(low, "a")
        if large:
            moved = both.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:  # both ends of an edge move to the smallest; from one pass, so that the edges are planned and read once less
            moved = both.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        return moved.where("a <> b").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    e = stored(edges.where("a <> b"), "simhash-edges")
    before = mark(e)
    for _ in range(rounds):
        e = stored(star(star(e, True), False), "simhash-stars")
        now = mark(e)
        if now == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
    raise RuntimeError("components did not settle")


def fingerprint_classes(prints: DataFrame, radius: int) -> DataFrame:
    """From rows (doc_id, fp): one row per fingerprint with its component's smallest doc_id and its holder's fp."""
    fps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = fps.join(components(links(fps, radius)).withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    held = F.min(F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("first"), F.col("fp").alias("fp")))
    best = roots.groupBy("root").agg(held.alias("best"))
    return roots.join(best, "root").select("fp", F.col("best.first").alias("component_id"), F.col("best.fp").alias("best_fp"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = stored(with_fingerprint(src, "text", shingle, "fp").select("doc_id", "fp"), "simhash-prints")
    return prints.join(fingerprint_classes(prints, radius), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
             radius: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest doc_id."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = stored(with_fingerprint(src, "text", shingle, "fp").select("doc_id", "fp"), "simhash-prints")
    best = (fingerprint_classes(prints, radius).where("fp = best_fp")
            .select(F.col("fp").alias("__kept_fp"), F.col("component_id").alias("__kept_id")))
    rows = with_fingerprint(docs, text, shingle, "__fp")
    same = (F.col("__fp") == F.col("__kept_fp")) & F.col(doc_id).eqNullSafe(F.col("__kept_id"))
    own = docs.columns
    kept = rows.join(best, same).withColumn("__again", F.xxhash64(*[F.col(f"`{c}`") for c in own]))
    ranked = kept.groupBy("__fp").agg(F.min(F.struct("__again", *[F.col(f"`{c}`") for c in own])).alias("r"))
    return ranked.select(*[F.col("r").getField(c).alias(c) for c in own])
