"""Quality rules: word and line statistics, and a decision list learned from labelled documents.

``statistics`` counts words, symbols, repeated lines and repeated three-word windows of a text. ``learn`` runs sequential
covering on a bounded sample of labelled rows: a conjunction of thresholds grows on two thirds of them by information
gain, is pruned on the rest, and what it covers is taken out before the next one. ``verdict`` turns the rules into one
ordered Spark conditional expression.

Null texts have no words and all counts 0; ratios of an empty text are 0. Labels or ids that are null are not learned
from; without usable labels there are no rules and every row that passes the base rules is kept. Repeated labelled rows
count as often as they stand. Only the named columns are read, so further ones may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.session import work_path

# Fixed values of the base rules.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_upper", "n_digits")


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that stand twice or more among the windows."""
    size = len(words)
    if size < 4:
        return 0
    number = dict(zip(dict.fromkeys(words), count()))
    ids = np.fromiter(map(number.__getitem__, words), np.int64, size)
    kinds = len(number)
    pairs = ids[:-2] * kinds + ids[1:-1]
    if kinds >= 2_000_000:  # keeps the product below in 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * kinds + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(size, bool)
    again = np.zeros(size - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    twice[:-2] = again
    twice[1:-1] |= again
    twice[2:] |= again
    return int(twice.sum())


def count_text(text: str) -> tuple[int, ...]:
    """The COUNTS of one text."""
    data = text.encode()
    words = data.split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    raw = np.frombuffer(data, np.uint8)
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), len(text), int(((raw >= 65) & (raw <= 90)).sum()), int(((raw >= 48) & (raw <= 57)).sum()),
    )


def statistics(text: Column) -> Column:
    """A struct of COUNTS, all long."""

    @F.arrow_udf(", ".join(f"{name} long" for name in COUNTS))
    def counted(texts: pa.Array) -> pa.Array:
        rows = [count_text(value.as_py() or "") for value in texts]
        table = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))

    return counted(text)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def features(stats: Column) -> dict[str, Column]:
    """The ratios that rules test, from a struct of COUNTS."""
    at = {name: stats[name].cast("double") for name in COUNTS}
    return {
        "words": at["n_words"],
        "word_length": _share(at["word_chars"], at["n_words"]),
        "symbols_per_word": _share(at["n_symbols"], at["n_words"]),
        "repeated_line_share": _share(at["n_dup_lines"], at["n_lines"]),
        "repeated_word_share": _share(at["n_repeat_words"], at["n_words"]),
        "capital_share": _share(at["n_upper"], at["n_chars"]),
        "digit_share": _share(at["n_digits"], at["n_chars"]),
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < LEAST_WORDS) | (100 * stats["n_repeat_words"] > MOST_REPEATED_PERCENT * stats["n_words"])


@dataclass(frozen=True)
class Test:
    """``feature`` above (or else at most) ``threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self, at: dict[str, Column]) -> Column:
        return at[self.feature] > self.threshold if self.above else at[self.feature] <= self.threshold

    def holds(self, values: np.ndarray, names: list[str]) -> np.ndarray:
        own = values[:, names.index(self.feature)]
        return own > self.threshold if self.above else own <= self.threshold


Rule = tuple[Test, ...]


def _covered(rule: Rule, values: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(values), bool)
    for test in rule:
        out &= test.holds(values, names)
    return out


def _grow(values: np.ndarray, bad: np.ndarray, names: list[str], thresholds: int, most_tests: int) -> Rule:
    """Adds the test with the most information gain until only bad rows are covered."""
    rule: Rule = ()
    inside = np.ones(len(values), bool)
    while len(rule) < most_tests and bad[inside].any() and not bad[inside].all():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best, best_gain = None, 1e-9
        for i, name in enumerate(names):
            own = values[inside, i]
            met = np.unique(np.quantile(own, np.linspace(0, 1, thresholds + 1), method="nearest"))
            if len(met) < 2:
                continue
            cuts = (met[1:] + met[:-1]) / 2  # half way, so that neither side is met by a hair
            order = np.argsort(own, kind="stable")
            below_all = np.searchsorted(own[order], cuts, side="right")
            bad_below = np.concatenate([[0], np.cumsum(bad[inside][order])])[below_all]
            for above in (False, True):
                p1 = p - bad_below if above else bad_below
                n1 = (len(own) - below_all if above else below_all) - p1
                gain = p1 * (np.log2(np.maximum(p1, 0.5) / np.maximum(p1 + n1, 1)) - np.log2(p / (p + n)))
                k = int(np.argmax(gain))
                if gain[k] > best_gain:
                    best, best_gain = Test(name, above, float(cuts[k])), gain[k]
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(values, names)
    return rule


def _worth(rule: Rule, values: np.ndarray, bad: np.ndarray, names: list[str]) -> float:
    inside = _covered(rule, values, names)
    p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def cover(
    values: np.ndarray, bad: np.ndarray, names: list[str], precision: float = 0.95, thresholds: int = 64, most_tests: int = 4, most_rules: int = 20
) -> list[Rule]:
    """Sequential covering of the bad rows. A rule counts if, after pruning, at least ``precision`` of what it covers on
    the held-back third (and of all it covers) is bad; the search ends at the first that does not."""
    rules: list[Rule] = []
    held_back = np.arange(len(values)) % 3 == 2
    left = np.ones(len(values), bool)
    while len(rules) < most_rules and bad[left].any():
        grow, prune = left & ~held_back, left & held_back
        rule = _grow(values[grow], bad[grow], names, thresholds, most_tests)
        if not rule:
            break
        shorter = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(shorter, key=lambda r: (_worth(r, values[prune], bad[prune], names), -len(r)))
        inside = _covered(rule, values, names) & left
        in_prune = inside & held_back
        if not in_prune.any() or bad[in_prune].mean() < precision or bad[inside].mean() < precision:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, **how) -> list[Rule]:
    """Rules for what ``labels`` (doc_id, quality 0 or 1) call bad, from at most ``sample_rows`` labelled rows, those with
    the smallest hash of their id. Rows that fail the base rules are not learned from, as they are gone already."""
    named = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality"))
    # Ids and labels only, sample_rows at most: 12 bytes each, so this side may be broadcast.
    chosen = F.broadcast(named.orderBy(F.xxhash64("_id"), "_id", "_quality").limit(sample_rows))
    # Written first: a filter on the statistics would be pushed below the join, and all texts be counted to learn from some.
    path = work_path(docs.sparkSession, "labelled")
    docs.join(chosen, F.col("doc_id") == F.col("_id")).select("_id", "_quality", "text").write.parquet(path)
    stats = docs.sparkSession.read.parquet(path).select("_id", "_quality", statistics(F.col("text")).alias("_stats"))
    at = features(F.col("_stats"))
    # What fails the base rules leaves here: a filter would be pushed below the counting and count every text a second time,
    # in a second Python worker for each task, and executors keep such workers for what runs next.
    told = stats.select("_quality", F.xxhash64("_id").alias("_order"), *[c.alias(n) for n, c in at.items()], base_failed(F.col("_stats")).alias("_failed"))
    rows = [r[:-1] for r in told.collect() if r["_failed"] is False]
    rows.sort(key=lambda r: r[1:])  # by hash of the id, so that every third row is a fair sample
    names = list(at)
    values = np.array([r[2:] for r in rows], float).reshape(len(rows), len(names))
    return cover(values, np.array([r[0] == 0 for r in rows], bool), names, **how)


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The number of the first rule that holds, null if none does: one conditional expression in rule order."""
    at = features(stats)
    out = None
    for number, rule in enumerate(rules, 1):
        held = rule[0].column(at)
        for test in rule[1:]:
            held = held & test.column(at)
        out = F.when(held, number) if out is None else out.when(held, number)
    return F.lit(None).cast("int") if out is None else out


def describe(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{t.feature} {'>' if t.above else '<='} {t.threshold:g}" for t in rule) for rule in rules]


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """row (a struct of the columns of ``docs``, whatever their names), stats, base_failed, rule (number of the rule that
    rejects) and kept."""
    stats = docs.select(F.struct("*").alias("row"), statistics(F.col("text")).alias("stats"))
    tested = stats.withColumns({"base_failed": base_failed(F.col("stats")), "rule": verdict(rules, F.col("stats"))})
    return tested.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
