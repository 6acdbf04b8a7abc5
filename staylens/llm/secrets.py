"""Secret scan with corpus-wide ownership of each candidate.

Candidates are found per text: the base kinds (keyword assignments, access key
ids, long hex runs) and, as additions, private-key headers, prefixed service
tokens and high-entropy strings. Each candidate's hash is then counted over the
corpus by distinct owners and distinct repositories: a value many owners carry is
a copied example; a value of one owner that looks random is live; others are unclear.
Base spans are always reported; an added span unless its value is a copied example.
All candidates are judged and counted, reported or not. The value of a private key is
its body: what follows the header up to its end mark, or else the base64 lines.

The hash is a 128-bit prefix of SHA-256, so no secret leaves the scan.

Cases: null text is empty; null owner or repository is an owner or repository of
its own; repeated rows are reported one by one and count as one repository; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staylens.llm.common import stored

# Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "private_key", "service", "entropy")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----")
KEY_LINES = re.compile(r"(?:(?:\s|\\[nr])+[A-Za-z0-9+/=]{16,})+")
KEY_END = re.compile(r"-----(BEGIN|END)")
KEY_GAP = re.compile(r"\s|\\[nr]")
SERVICE = re.compile(r"(?:gh[oprsu]_|xox[abprs]-|sk_live_|AIza)[A-Za-z0-9_-]{16,}")
ENTROPY = re.compile(r"[A-Za-z0-9+/_-]{20,}")
MIN_BITS = 3.5  # Shannon entropy a character from which a string looks random

SPAN = "struct<start:int,order:int,end:int,hash:string,random:boolean>"
FOUND_SCHEMA = (f"doc_id long, owner string, repo string, n_assign long, n_access long, n_hex long, "
                f"base_sha256 string, spans array<{SPAN}>")


def bits(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str) -> bool:
    """Mixed letters and digits with the spread of a generated value."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and bits(value) >= min(MIN_BITS, 0.8 * math.log2(max(len(value), 2)))


def key_value(text: str, at: int) -> str:
    """Body of the private key whose header ends at ``at``, without line ends; "" if there is none."""
    mark = KEY_END.search(text, at)
    if mark and mark[1] == "END":
        return KEY_GAP.sub("", text[at:mark.start()])
    lines = KEY_LINES.match(text, at)
    return KEY_GAP.sub("", lines[0]) if lines else ""


def find(text: str) -> list[tuple[int, int, int, str]]:
    """Candidate spans (start, kind number, end, value) of one text, sorted."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted(out)
    if "-----BEGIN" in text:
        out += [(m.start(), 3, m.end(), key_value(text, m.end()) or m[0]) for m in PRIVATE_KEY.finditer(text)]
    out += [(m.start(), 4, m.end(), m[0]) for m in SERVICE.finditer(text)]
    out += [(m.start(), 5, m.end(), m[0]) for m in ENTROPY.finditer(text) if looks_random(m[0])]
    taken, k = [], 0
    for span in sorted(out):
        # additions inside what a base kind (or an earlier addition) already covers say nothing new
        if span[1] >= 3 and (any(b[0] < span[2] and span[0] < b[2] for b in base) or span[0] < k):
            continue
        taken.append(span)
        if span[1] >= 3:
            k = max(k, span[2])
    return taken


def _digest(spans) -> str:
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in spans).encode()).hexdigest()


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
         repo: str = "doc_id", example_owners: int = 3) -> DataFrame:
    """One row per document: base counts and digest, all spans, and how its candidates are judged."""
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(owner).cast("string").alias("owner"),
                      F.col(repo).cast("string").alias("repo"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("order", pa.int32()), ("end", pa.int32()), ("hash", pa.string()),
                          ("random", pa.bool_())])
        for batch in batches:
            all_found = [find(t or "") for t in batch.column(3).to_pylist()]
            counts = [[sum(k == i for _, k, _, _ in f) for f in all_found] for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([_digest([x for x in f if x[1] < 3]) for f in all_found], pa.string()),
                 pa.array([[{"start": s, "order": k, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()[:32],
                             "random": looks_random(v)} for s, k, e, v in f] for f in all_found], pa.list_(span))],
                names=["doc_id", "owner", "repo", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    found = stored(src.mapInArrow(run, FOUND_SCHEMA).withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    spans = found.select("row", "owner", "repo", F.explode("spans").alias("s"))
    owned = (spans.select("s.hash", "owner", "repo").distinct()
             .groupBy("hash", "owner").agg(F.count("*").alias("repos"))
             .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos")))
    judged = spans.select("row", "s.*").join(owned, "hash")
    verdict = (F.when(F.col("n_owners") >= example_owners, "example")
               .when((F.col("n_owners") == 1) & F.col("random"), "live").otherwise("unclear"))
    judged = judged.withColumn("verdict", verdict)
    listed = (F.col("order") < 3) | (F.col("verdict") != "example")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(listed, F.struct("start", "order", "end")))).alias("all"),
        F.sum((F.col("verdict") == "live").cast("long")).alias("n_live"),
        F.sum((F.col("verdict") == "example").cast("long")).alias("n_example"))
    text_of = F.array_join(F.transform("all", lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["order"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.drop("spans").join(per_row, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(text_of, F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"))
