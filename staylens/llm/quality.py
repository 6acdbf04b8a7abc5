"""Quality rules: statistics of whole texts and a learned decision list, all in DataFrame functions.

Statistics are row-local: the words of a text are an array column, hashes of its 8-word windows
another; each is materialised by a one-row ``inline``, so that no expression computes it twice.

The decision list is learned by sequential covering. Labelled statistics are cut at quantiles
of either class, a conjunction of thresholds is grown on one part of them by information gain,
pruned back on the other part, kept if it is right there often enough, and its rows leave before
the next is grown. A threshold is set halfway to the next cut. Every step is one aggregate over the written labelled statistics; only counts
by (statistic, cut) reach the driver. The rules come out as one ordered ``CASE`` expression.

Cases: null or empty text has no words (base_failed); a null, missing or contradictory label
teaches nothing; repeated rows are rows of their own, each judged and each learned from; without
labels of both classes no rule is learned and all that pass the base are kept; empty tables give
an empty result; other columns of the inputs are not read; very long texts are whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from staylens.llm.common import crc_fold, stored

# FIXED VALUES of the contract.
GAPS = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

CUTS = 64             # quantiles a class and statistic: the thresholds that rules may use
MAX_CONDITIONS = 4
MAX_RULES = 16
MIN_PRECISION = 0.9   # of a rule on the rows that pruned it
MIN_COVER = 4         # rows of the poor class that a rule has to catch there


def _let(value: Column, use) -> Column:
    """``use(x)`` with x computed once."""
    return F.transform(F.array(value), use)[0]


def _windows(words: Column) -> Column:
    """Hashes of all runs of ``WINDOW`` (8) words: of one word, then of 2, 4 and 8 from two halves each."""
    def joined(halves: Column, size: int) -> Column:
        return _let(halves, lambda h: F.zip_with(F.slice(h, F.lit(1), F.size(h) - size), F.slice(h, F.lit(1 + size), F.size(h)),
                                                 lambda a, b: F.xxhash64(a, b)))
    return joined(joined(joined(F.transform(words, lambda x: F.xxhash64(x)), 1), 2), 4)


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash stands twice or more: equal neighbours in sorted order, then the union of spans."""
    def starts(pairs: Column) -> Column:
        same = F.zip_with(pairs, F.slice(pairs, F.lit(2), F.size(pairs)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        either = _let(same, lambda s: F.zip_with(s, F.concat(F.array(F.lit(False)), s), lambda a, b: F.coalesce(a, F.lit(False)) | b))
        found = F.zip_with(pairs, F.slice(either, F.lit(1), F.size(pairs)), lambda p, on: F.when(on, p["i"]))
        return F.array_sort(F.filter(found, lambda i: i.isNotNull()))

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    span = F.aggregate(
        _let(pairs, starts), F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(span).cast("long")


def statistics(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of the base and of the further statistics, from the whole text of each row."""
    body = F.coalesce(F.col(text), F.lit(""))
    src = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    words = F.array_remove(F.split("text", GAPS), "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CHAR))
    split = src.select("doc_id", "text", F.inline(F.array(F.struct(words.alias("w"), lines.alias("lines")))))
    n = F.size("w")
    windows = F.when(n >= WINDOW, _windows(F.col("w"))).otherwise(F.array().cast("array<bigint>"))

    def long(c: Column) -> Column:
        return c.cast("long")

    def of(characters: str) -> Column:
        return long(F.char_length(F.regexp_replace("text", f"[^{characters}]+", "")))

    counted = split.select(
        "doc_id", long(n).alias("n_words"), long(F.char_length(F.array_join("w", ""))).alias("word_chars"),
        of(SYMBOLS).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        long(F.size("lines")).alias("n_lines"), of("A-Z").alias("n_capitals"), of(".!?").alias("n_stops"),
        F.inline(F.array(F.struct(windows.alias("h")))))
    return counted.withColumn("n_repeat_words", _covered(F.col("h"))).drop("h")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)


def _ratio(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))



def features() -> dict[str, Column]:
    return {
        "words": F.col("n_words").cast("double"), "word_length": _ratio("word_chars", "n_words"),
        "symbols_a_word": _ratio("n_symbols", "n_words"), "repeated_lines": _ratio("n_dup_lines", "n_lines"),
        "repeated_words": _ratio("n_repeat_words", "n_words"), "words_a_line": _ratio("n_words", "n_lines"),
        "capitals": _ratio("n_capitals", "word_chars"), "stops_a_word": _ratio("n_stops", "n_words")}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool       # value > threshold, else value <= threshold
    threshold: float

    def column(self) -> Column:
        x = features()[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered conjunctions; the first that holds rejects, a text that none holds for is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule(self) -> Column:
        """Number of the first rule that holds, from 1 (null: none)."""
        out = None
        for k, conditions in enumerate(self.rules, 1):
            held = conditions[0].column()
            for c in conditions[1:]:
                held = held & c.column()
            out = F.when(held, k) if out is None else out.when(held, k)
        return F.lit(None).cast("int") if out is None else out.cast("int")

    def __str__(self) -> str:
        return "\n".join(f"{k}. {' and '.join(map(str, r))}" for k, r in enumerate(self.rules, 1))


def gain(p: float, n: float, p0: float, n0: float) -> float:
    """FOIL's information gain of narrowing (p0 poor, n0 good) rows to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(stats: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", quality: str = "quality", max_rules: int = MAX_RULES,
          max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> DecisionList:
    """The decision list for labels 0 (poor) and 1, from the rows that pass the base; a third of them prunes."""
    names = list(features())
    marks = (labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("q")).where("q in (0, 1)")
             .groupBy("doc_id").agg(F.min("q").alias("lo"), F.max("q").alias("hi")).where("lo = hi")
             .select("doc_id", (F.col("lo") == 0).alias("poor")))
    rows = stored(stats.where(~base_failed()).join(marks, "doc_id").select(
        "poor", (crc_fold("doc_id", 3) == 0).alias("prunes"), *[c.alias(f) for f, c in features().items()]), "quality-labelled")
    wanted = [k / CUTS for k in range(CUTS)]
    quantiles = rows.groupBy("poor").agg(*[F.percentile_approx(f, wanted, 10_000).alias(f) for f in names]).collect()
    if len(quantiles) < 2:
        return DecisionList(())
    cuts = {f: sorted({x for r in quantiles for x in r[f]}) for f in names}
    # a value's bin: how many cuts lie below it; "value > cuts[k]" is "bin > k"
    def bin_of(f: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda t: t < F.col(f))).alias(f)

    binned = stored(rows.select("poor", "prunes", *map(bin_of, names)), "quality-binned")
    p, n = F.count_if("poor"), F.count_if(~F.col("poor"))

    def test(feature: str, above: bool, k: int) -> Column:
        return F.col(feature) > k if above else F.col(feature) <= k

    def both(conditions) -> Column:
        out = F.lit(True)
        for c in conditions:
            out = out & test(*c)
        return out

    def grow(left: DataFrame) -> list[tuple]:
        rule: list[tuple] = []
        while len(rule) < max_conditions:
            bins = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in names]))
            counts = left.where(both(rule)).select("poor", bins.alias("b")).groupBy("b.f", "b.bin").agg(p.alias("p"), n.alias("n")).collect()
            by: dict = {f: {} for f in names}
            for r in counts:
                by[r.f][r.bin] = (r.p, r.n)
            p0, n0 = (sum(x[i] for x in by[names[0]].values()) for i in (0, 1))
            if not p0 or not n0:
                break
            best = (1e-9, None)
            for f in names:
                below_p = below_n = 0
                for k in range(len(cuts[f])):
                    a, b = by[f].get(k, (0, 0))
                    below_p, below_n = below_p + a, below_n + b
                    for above, (x, y) in ((False, (below_p, below_n)), (True, (p0 - below_p, n0 - below_n))):
                        g = gain(x, y, p0, n0)
                        if g > best[0] and x + y < p0 + n0:
                            best = (g, (f, above, k))
            if best[1] is None:
                break
            rule.append(best[1])
        return rule

    rules, left = [], binned
    for _ in range(max_rules):
        rule = grow(left.where(~F.col("prunes")))
        if not rule:
            break
        held = left.where("prunes").agg(*[agg.alias(f"{name}{k}") for k in range(1, len(rule) + 1)
                                          for name, agg in (("p", F.count_if(F.col("poor") & both(rule[:k]))),
                                                            ("n", F.count_if(~F.col("poor") & both(rule[:k]))))]).first()
        # the shortest of the best prefixes on rows that did not grow it
        worth = [((held[f"p{k}"] - held[f"n{k}"]) / max(1, held[f"p{k}"] + held[f"n{k}"]), -k) for k in range(1, len(rule) + 1)]
        k = -max(worth)[1]
        if held[f"p{k}"] < min_cover or held[f"p{k}"] < min_precision * (held[f"p{k}"] + held[f"n{k}"]):
            break
        rules.append(tuple(Condition(f, above, sum(cuts[f][c:c + 2]) / len(cuts[f][c:c + 2])) for f, above, c in rule[:k]))
        left = left.where(~both(rule[:k]))
    return DecisionList(tuple(rules))


def judge(stats: DataFrame, model: DecisionList) -> DataFrame:
    """The statistics with base_failed, the rule that rejects (null: none) and kept."""
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("rule", F.when(~F.col("base_failed"), model.rule()))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def filter_report(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **learning) -> DataFrame:
    """One row per document: base statistics, the verdict and the rule behind it. Texts are read once."""
    stats = stored(statistics(docs, doc_id=doc_id, text=text), "quality-statistics")
    out = judge(stats, learn(stats, labels, **learning))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
