"""Lexical search, quality rules and collocations against brute force, with the cases of their docstrings."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staylens.llm import collocations, lexical, quality
from staylens.llm.common import crc_fold

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocab = ["the", "of", "The", "naïve", "Ünder", "data", "x1", "été", "ab-cd"] + [f"w{i}" for i in range(40)]
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " - "]
    texts = ["".join(rng.choice(vocab) + rng.choice(marks) for _ in range(rng.choice([0, 1, 3, 20, 60]))) for _ in range(80)]
    texts += ["new york city hall. " * 12, "New York\tcity: new york; York city\n" * 6, "x\x01y x\x01y x " * 15]
    texts += [texts[4]] * 4 + [None, "", " \n\t", "z" * 150_000, "a b c " * 9000]
    out = [(i, t, [None, "en", "fr", "und"][i % 4]) for i, t in enumerate(texts)]
    return out + [(7, texts[7], "fr"), (None, texts[9], "en"), (None, texts[9], "en")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = {c: F.lit("x") for c in ("f", "w1", "k", "part", "n", "a", "score", "rank", "query", "task", "ids", "w", "lines", "h", "rule")}
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(clash)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


# --- 11 lexical search ---

def ranked(rows, items, best=20):
    docs = [(d, Counter(TERM.findall(low(t or "")))) for d, t, _ in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    big_n, total = len(docs), sum(n for _, _, n in docs)
    out = []
    for item, text in items:
        q = Counter(TERM.findall(low(text or "")))
        weight = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * sum(t in c for _, c, _ in docs) + 1))) for t in q}
        scores = []
        for d, c, n in docs:
            m = 100 - 25 + (25 * n * big_n) // total
            s = sum(k * weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in q.items())
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=str)


ITEMS = [(1, "The data of new york"), (2, "w1 w1 w2 x1 été"), (3, None), (4, ""), (5, "unknownterm"), (6, "x y z"),
         (7, "z" * 150_000), (8, "a b c a"), (8, "ab cd data"), (None, "naïve under w30")]


# tiny blocks and full signatures: bounds hardly exclude, results stay
@pytest.mark.parametrize("sizes", [{}, {"block_rows": 3, "sort_rows": 7, "bits_per_entry": 1}])
def test_lexical_search(spark, docs, rows, sizes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("query", F.lit("x"))
    index = lexical.index(docs, **sizes)
    for shard_terms in (20_000, 12):
        got = sorted(map(tuple, lexical.search(index, items, shard_terms=shard_terms).collect()), key=str)
        assert got == ranked(rows, ITEMS)
    assert lexical.search(lexical.index(docs.limit(0)), items).count() == 0
    assert lexical.search(index, items.limit(0)).count() == 0


def test_lexical_bounds_exclude_without_losing(rows):
    """Bounds are never below the exact score, and most documents are excluded unscored."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(int(rng.expovariate(0.02))) for _ in range(80)) for _ in range(1500)]
    held = [(i, t.encode(), Counter(lexical.terms_of(t.encode()))) for i, t in enumerate(texts)]
    shard = lexical.Shard([(0, texts[3].encode()), (1, texts[900].encode())])
    df = [sum(w in c for _, _, c in held) for w in shard.number]
    weights = lexical.np.array([lexical.weight(len(held), n) for n in df], lexical.np.int64)
    s = lexical.Searcher(shard, weights, len(held), 80 * len(held), 20)
    for at in range(0, len(held), 250):
        s.read(lexical._block(held[at:at + 250]))
    want = ranked([(i, t, None) for i, t in enumerate(texts)], [(0, texts[3]), (1, texts[900])])
    assert sorted(((q, k + 1, d, x) for q, kept in enumerate(s.kept) for k, (x, d) in enumerate(kept)), key=str) == want
    assert s.rescored < 0.5 * s.possible


# --- 12 quality rules ---

def statistics_of(text):
    text = text or ""
    w = SPLIT.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.fixture(scope="module")
def judged(spark):
    """Good texts, and poor ones of two kinds: symbols, or shouting without stops."""
    rng = random.Random(2)
    out = []
    for i in range(900):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(25, 60))]
        kind = i % 6
        if kind == 1:
            words = [w + rng.choice("#$%") if rng.random() < 0.5 else w for w in words]
        if kind == 2:
            words = [w.upper() for w in words]
        text = ". ".join(" ".join(words[j:j + 7]) for j in range(0, len(words), 7))
        out.append((i, text.replace(". ", " ") if kind == 2 else text, int(kind not in (1, 2))))
    return out


def test_quality_statistics(docs, rows, nothing):
    got = [tuple(r)[1:] for r in quality.statistics(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()]
    assert sorted(got) == sorted(statistics_of(t) for _, t, _ in rows)
    assert quality.statistics(nothing).count() == 0


def test_quality_rules(spark, judged, docs, nothing):
    frame = spark.createDataFrame(judged, "doc_id long, text string, quality int")
    stats = quality.statistics(frame)
    labels = frame.select("doc_id", "quality", F.lit("x").alias("poor"))
    odd = spark.createDataFrame([(5, None, "x"), (1, 1, "x"), (None, 0, "x"), (77_777, 0, "x")], "doc_id long, quality int, poor string")
    held = crc_fold("doc_id", 5) == 0
    model = quality.learn(stats.where(~held), labels.unionByName(odd))
    assert 2 <= len(model.rules) <= 4, str(model)
    seen = {r.doc_id: r for r in quality.judge(stats.where(held), model).collect()}
    truth = {i: q for i, _, q in judged}
    assert all(r.kept == (truth[i] == 1) for i, r in seen.items())
    # the list means what it says: conditions checked one by one against brute-force statistics
    def holds(text, c):
        n, chars, symbols, dup, rep = statistics_of(text)
        lines = sum(1 for x in text.split("\n") if SPLIT.search(x))
        x = {"words": n, "word_length": chars / n, "symbols_a_word": symbols / n, "repeated_lines": dup / lines,
             "repeated_words": rep / n, "words_a_line": n / lines, "capitals": len(re.findall("[A-Z]", text)) / chars,
             "stops_a_word": len(re.findall("[.!?]", text)) / n}[c.feature]
        return x > c.threshold if c.above else x <= c.threshold
    texts = {i: t for i, t, _ in judged}
    for i, r in seen.items():
        first = next((k for k, rule in enumerate(model.rules, 1) if all(holds(texts[i], c) for c in rule)), None)
        assert r.rule == first
    # nothing to learn from: the base alone decides
    out = quality.filter_report(docs, labels.limit(0)).collect()
    assert len(out) == docs.count() and all(r.kept == (not r.base_failed) and r.rule is None for r in out)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in out)
    assert quality.filter_report(nothing, labels).count() == 0


# --- 13 collocations ---

def phrases(rows, min_count=10, share=50, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in (1, 2, 3):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    gone = {(lang, part) for (lang, w), b in cand.items() if len(w) == 3 for part in (w[:2], w[1:])
            if (lang, part) in cand and 100 * b >= share * cand[lang, part]}
    by = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            s, _, l, r = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
            by.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, found in by.items() for k, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


# many chunks, and a bitmap that phrases share bits of
@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 200, "bits": 1 << 15}])
def test_collocations(docs, rows, nothing, sizes):
    want = phrases(rows)
    assert sorted(map(tuple, collocations.mine(docs, **sizes).collect())) == want and len(want) >= 10
    assert sorted(map(tuple, collocations.mine(docs, min_count=20, share=90, top=3).collect())) == phrases(rows, 20, 90, 3)
    assert collocations.mine(nothing).count() == 0


def test_collocation_streams_are_not_dealt_by_hash(docs):
    """The merges are windows over range-partitioned, sorted streams."""
    _, singles, pairs, triples = collocations.count_streams(docs)
    plan = collocations.candidates(singles, pairs, triples)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Join" not in plan and plan.count("rangepartitioning") == 4


def test_collocation_scores_beyond_64_bits(spark):
    big = 3_000_000_000
    frame = spark.createDataFrame([(big, big + 1, big + 7)], "a long, l1 long, r1 long")
    got = frame.selectExpr(f"{collocations._score('l1', 'r1')} as s").first().s
    assert got == 1_000_000 * big * big // ((big + 1) * (big + 7))
