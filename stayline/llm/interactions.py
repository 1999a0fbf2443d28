"""How filters overlap: what each removes in every order, and its Shapley value by the Hart-Mas-Colell potential.

The removal game gives a coalition S of filters the number v(S) of documents that at least one of them removes. Its
potential is P(empty) = 0 and P(S) = (v(S) + sum of P(S without i) over i in S) / |S|, so one pass over the 2^k coalitions
gives all: the Shapley value of i is P(all) - P(all without i), and what i removes after S is v(S and i) - v(S). Kept as
|S|! P(S), the potentials are whole numbers.

Documents are counted by part and by the set of filters that they fail, at most 2^k counts a part; only these go on.
The filters of ``profile``: A, few words; B, few distinct words; C, many capitals; D, markup characters; E, a text that a
smaller doc_id has too. Null texts are empty. A null doc_id is neither smaller nor larger than another, so such rows
never fail E, nor do rows that repeat the smallest id of their text. Labels with several rows for a doc_id count as 1 where
any of them does; rows without a label count as 0. Null parts are the empty string. Empty tables give empty results. Only
the named columns are read, so others may have any names.

Texts meet by SHA-256 and ids by value, each after its rows were counted map-side, so that neither a text with many copies
nor a repeated id is collected in one task; rows without an id are spread by their text.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
E = 1 << FILTERS.index("E")
#: White space between words, and the characters that filter D looks for.
SPACE, MARKUP = r"[\x20\x09-\x0D]+", r"[#$%&*|]"


def failed_alone(text: Column) -> Column:
    """Bits of the filters A to D that ``text`` (not null) fails."""
    words = F.array_remove(F.split(text, SPACE), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = [n_words < 200, 100 * n_distinct < 50 * n_words, 100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"), text.rlike(MARKUP)]
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def profile(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, failed (bits of the filters), and the documents with it: n, n_good (quality 1), n_toxic (toxic 1)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), failed_alone(text).alias("alone"), F.unhex(F.sha2(text, 256)).alias("digest"))
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marked = rows.join(marks.withColumn("_spread", F.lit(0).cast("long")), (F.col("doc_id") == F.col("_id")) & (F.col("spread") == F.col("_spread")), "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    same = ["digest", "part", "alone", "good", "toxic"]
    by_id = marked.select("doc_id", "spread", "digest", "part", "alone", *flags).groupBy("doc_id", "spread", *same).agg(F.count("*").alias("n"))

    # The first id of a text, and how many rows hold it: parts and labels tell at most a few groups of a text apart.
    known = F.col("doc_id").isNotNull()
    by_text = by_id.groupBy(*same).agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("known"), F.min(F.when(known, F.struct("doc_id", "n"))).alias("least"),
    )
    group = F.struct("part", "alone", "good", "toxic", "n", "known", "least")
    firsts = by_text.groupBy("digest").agg(F.min("least.doc_id").alias("first"), F.collect_list(group).alias("groups"))
    groups = firsts.select("first", F.explode("groups").alias("g")).select("first", "g.*")
    copies = F.col("known") - F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    halves = F.array(F.struct(F.col("alone").alias("failed"), (F.col("n") - copies).alias("n")), F.struct((F.col("alone") + E).alias("failed"), copies.alias("n")))
    told = groups.select("part", "good", "toxic", F.explode(halves).alias("h")).select("part", "good", "toxic", "h.failed", "h.n")
    of = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))
    return told.groupBy("part", "failed").agg(F.sum("n").alias("n"), of("good").alias("n_good"), of("toxic").alias("n_toxic"))


def removed_by(counts: Column, field: str, filters: int) -> Column:
    """v of every coalition, by its bits: the documents that fail at least one of its filters."""
    hit = lambda s: lambda total, c: total + F.when(c["failed"].bitwiseAND(s) != 0, c[field]).otherwise(0)
    return F.transform(F.sequence(F.lit(0), F.lit((1 << filters) - 1)), lambda s: F.aggregate(counts, F.lit(0).cast("long"), hit(s)))


def potentials(v: Column, filters: int) -> Column:
    """|S|! P(S) of every coalition, by its bits; those of smaller coalitions stand before it."""
    scale = F.array(*[F.lit(factorial(n)).cast("long") for n in range(filters)])

    def next_to(known: Column, s: Column) -> Column:
        without = sum((F.when(s.bitwiseAND(1 << i) != 0, F.get(known, s - (1 << i))).otherwise(0) for i in range(filters)), F.lit(0).cast("long"))
        return F.concat(known, F.array(F.get(scale, F.bit_count(s) - 1) * F.get(v, s) + without))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")), next_to)


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row a part, order and step, from what ``profile`` returns; filter i of ``names`` has the bit 2^i. ``shapley`` is
    the filter's value times the number of orders."""
    k, everything = len(names), (1 << len(names)) - 1
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.collect_list(F.struct("failed", "n", "n_good", "n_toxic")).alias("counts"))
    games = parts.select("part", "total", *[removed_by(F.col("counts"), c, k).alias(v) for c, v in (("n", "v"), ("n_good", "v_good"), ("n_toxic", "v_toxic"))])
    games = games.withColumn("q", potentials(F.col("v"), k))

    orders = F.split(F.lit(",".join(map("".join, permutations(names)))), ",")
    letters, powers = F.array(*map(F.lit, names)), F.array(*[F.lit(1 << i) for i in range(k)])
    bit = lambda letter: F.element_at(powers, F.array_position(letters, letter).cast("int"))
    steps = games.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    own = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: bit(F.substring(F.col("filter_order"), i, F.lit(1))))
    steps = steps.withColumn("bits", own).withColumn("bit", F.element_at("bits", F.col("step")))
    steps = steps.withColumn("before", F.aggregate(F.slice("bits", 1, F.col("step") - 1), F.lit(0), lambda total, b: total + b))
    gain = lambda v: F.get(F.col(v), F.col("before") + F.col("bit")) - F.get(F.col(v), F.col("before"))
    rest = F.lit(everything) - F.col("bit")
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - F.get("v", F.col("before") + F.col("bit"))).alias("kept"), gain("v").alias("removed"),
        (F.get("v", F.col("bit")) - gain("v")).alias("redundant"), (F.get("v", F.lit(everything)) - F.get("v", rest)).alias("unique_fails"),
        gain("v_good").alias("good_lost"), gain("v_toxic").alias("toxic_lost"), (F.get("q", F.lit(everything)) - k * F.get("q", rest)).alias("shapley"),
    )
