"""Breed attributes: size by keyword, tier by lookup, and the names that still need them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import params as P
from stayline.functions.text import classify_by_keywords, tokens
from stayline.session import shuffled


def new_categories(df: DataFrame, known: DataFrame, column: str = "breed") -> DataFrame:
    """Distinct non-null values of ``column`` that ``known`` lacks."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().join(known.select(column), column, "left_anti")


def with_breed_attributes(df: DataFrame, breeds: DataFrame) -> DataFrame:
    return df.join(breeds.select("breed", "tier", "breed_size"), "breed")


def with_size(names: DataFrame, rules: Mapping[str, Sequence[str]] | DataFrame, column: str = "breed") -> DataFrame:
    """Size class by keyword: the last class of ``P.SIZE_PRIORITY`` with a keyword in the name wins. ``rules`` are short lists
    by class, or a table (size_class, keyword) of any length."""
    if not isinstance(rules, DataFrame):
        return names.withColumn("breed_size", classify_by_keywords(F.col(column), rules))
    hits = keyword_hits(names.select(F.lower(column).alias("name")), rules.select(F.lower("keyword").alias("keyword"), "size_class"))
    order = F.array(*map(F.lit, P.SIZE_PRIORITY))
    ranked = hits.select("name", F.array_position(order, F.col("size_class")).alias("at")).where("at > 0")
    best = ranked.groupBy("name").agg(F.element_at(order, F.max("at").cast("int")).alias("_size")).withColumnRenamed("name", "_name")
    joined = names.join(best, F.lower(column) == F.col("_name"), "left")
    fallback = F.when(F.col(column).isNotNull(), P.DEFAULT_SIZE)
    return joined.withColumn("breed_size", F.coalesce("_size", fallback)).drop("_name", "_size")


def grams(text: Column, size: int) -> Column:
    """The distinct runs of ``size`` characters; none if the text is shorter."""
    starts = F.sequence(F.lit(1), F.char_length(text) - (size - 1))
    found = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))
    return F.when(F.char_length(text) >= size, found).otherwise(F.array().cast("array<string>"))


def keyword_hits(names: DataFrame, keywords: DataFrame, size: int = 3) -> DataFrame:
    """(name, keyword and its other columns) wherever a distinct ``name`` contains ``keyword``; nulls meet nothing.

    Each keyword is filed under its rarest gram, by how many names hold it, and names meet only what is filed under a gram of
    theirs; ``contains`` settles the rest. A keyword with a gram that no name holds is dropped. Keywords of fewer than ``size``
    characters are a gram themselves, the empty one a gram of every name.
    """
    distinct = names.where("name is not null").select("name").distinct()
    every = F.concat(F.array(F.lit("")), *[grams(F.col("name"), k) for k in range(1, size + 1)])
    held = distinct.select("name", F.explode(every).alias("gram"))
    often = held.groupBy("gram").agg(F.count("*").alias("n"))

    words = keywords.where("keyword is not null").distinct()
    own = F.when(F.char_length("keyword") < size, F.array("keyword")).otherwise(grams(F.col("keyword"), size))
    parts = words.select("keyword").distinct().select("keyword", F.explode(own).alias("gram"))
    counted = parts.join(often, "gram", "left").groupBy("keyword").agg(F.min(F.struct("n", "gram")).alias("rarest"), F.count(F.when(F.col("n").isNull(), 1)).alias("_missing"))
    filed = counted.where("_missing = 0").select("keyword", "rarest.gram")
    met = held.join(filed, "gram").where(F.contains(F.col("name"), F.col("keyword")))
    return met.select("name", "keyword").join(words, "keyword").select("name", *words.columns)


def tier_lookup(names: DataFrame, labelled: DataFrame, column: str = "breed") -> DataFrame:
    """Tier and score per distinct name.

    An exact match (ignoring case) scores 1. Otherwise the labelled name with the largest token overlap (shared tokens over
    all tokens) wins, ties by labelled name; no shared token gives the default tier with score 0.

    Tokens are in one global order, rarest among the labels first. The first label of each token of a name and each length
    gives a first score: no label that shares one token alone can beat it. What remains shares two tokens or more, so the last token of
    either side need not be looked up, and a label must have a length and the shared token a place from which the score so
    far can still be reached. Names meet labels by token and label length, for names and labels of any length.
    """
    label_text = F.lower("unique_breed")
    labels = (
        labelled.where(F.col("unique_breed").isNotNull()).groupBy(label_text.alias("label")).agg(F.min("matching_breed").alias("label_tier"))
        .withColumn("label_tokens", tokens(F.col("label")))
    )
    wanted = names.select(column).where(F.col(column).isNotNull()).distinct().withColumn("text", F.lower(column))
    exact = labels.select(F.col("label").alias("text"), F.col("label_tier").alias("exact_tier"))
    matched = wanted.join(shuffled(exact), "text", "left")
    open_names = matched.where("exact_tier is null").select("text").distinct().withColumn("name_tokens", tokens(F.col("text")))
    best = nearest_labels(open_names, labels).select("text", F.col("label_tier").alias("near_tier"), F.col("score").alias("near_score"))
    return matched.join(best, "text", "left").select(
        column,
        F.coalesce("exact_tier", "near_tier", F.lit(P.DEFAULT_TIER[0])).alias("tier"),
        F.when(F.col("exact_tier").isNotNull(), F.lit(1.0))
        .otherwise(F.coalesce("near_score", F.lit(P.DEFAULT_TIER[1])))
        .alias("tier_score"),
    )


def nearest_labels(names: DataFrame, labels: DataFrame) -> DataFrame:
    """text, label, label_tier and score: for each name (text, name_tokens) the label (label, label_tier, label_tokens) with
    the largest overlap, the first on ties; no row if it shares no token with any."""
    labels = labels.withColumn("n_label", F.size("label_tokens"))
    posted = labels.select("label", "label_tier", "label_tokens", "n_label", F.explode("label_tokens").alias("token"))
    openers = posted.groupBy("token", "n_label").agg(F.count("*").alias("uses"), F.min(F.struct("label", "label_tier", "label_tokens")).alias("opener"))
    tokens_by_use = openers.groupBy("token").agg(F.sum("uses").alias("uses"))

    # Known tokens of each name, rarest first, and the best of the first labels of each token and length.
    overlap = lambda shared, n_label: shared / (F.size("name_tokens") + n_label - shared)
    in_common = lambda label_tokens: F.size(F.array_intersect("name_tokens", label_tokens))
    said = names.select("text", "name_tokens", F.explode("name_tokens").alias("token"))
    ranked = said.join(shuffled(tokens_by_use), "token").groupBy("text", "name_tokens").agg(F.array_sort(F.collect_list(F.struct("uses", "token"))).alias("known"))
    opened = said.join(shuffled(openers), "token").select("text", (-overlap(in_common(F.col("opener.label_tokens")), F.col("n_label"))).alias("neg"), "opener.label", "opener.label_tier")
    first = opened.groupBy("text").agg(F.min(F.struct("neg", "label", "label_tier")).alias("first"))
    known = ranked.join(shuffled(first), "text")

    ordered = posted.join(shuffled(tokens_by_use), "token").groupBy("label", "label_tier", "label_tokens", "n_label").agg(
        F.array_sort(F.collect_list(F.struct("uses", "token"))).alias("t")
    )
    heads = F.transform(F.slice("t", 1, F.col("n_label") - 1), lambda t, i: F.struct(t["token"].alias("token"), (F.col("n_label") - i).alias("label_rest")))
    name_marks, label_marks = [[f"{of}_mark_{i}" for i in range(MARKS)] for of in ("name", "label")]
    marks = [m.alias(c) for c, m in zip(label_marks, token_marks(F.col("label_tokens")))]
    filed = ordered.where("n_label >= 2").select("label", "n_label", *marks, F.explode(heads).alias("h")).select("label", "n_label", *label_marks, "h.token", "h.label_rest")
    lengths = labels.select("n_label").distinct().agg(F.array_sort(F.collect_list("n_label"))).scalar()  # as many as the longest label has tokens
    near = 1e-12  # a tie must not fall to rounding

    def meet(known: DataFrame) -> DataFrame:
        """text, label and ``at_most``: what can still reach the score so far, and the score it can reach."""
        # (token, length) pairs that a better label of two shared tokens or more would have as its first shared token. ``rest``
        # is how many shared tokens there can be from there on.
        so_far, n_name = -F.col("first.neg"), F.size("name_tokens")
        places = F.transform(F.slice("known", 1, F.greatest(F.size("known") - 1, F.lit(0))), lambda t, i: F.struct(t["token"].alias("token"), (F.size("known") - i).alias("rest")))
        own = [m.alias(c) for c, m in zip(name_marks, token_marks(F.col("name_tokens")))]
        looked = known.select("text", n_name.alias("n_name"), so_far.alias("so_far"), *own, F.explode(places).alias("p"), lengths.alias("lengths"))
        reach = lambda rest, n_label: rest / (F.col("n_name") + n_label - rest)
        able = F.filter("lengths", lambda n: (n >= 2) & (reach(F.least(F.col("p.rest"), n), n) >= F.col("so_far") - near))
        looked = looked.select("text", "n_name", "so_far", *name_marks, F.col("p.token").alias("token"), F.col("p.rest").alias("rest"), F.explode(able).alias("n_label"))
        # Each mark that one side has and the other lacks is a token at least that they do not share, so most pairs are
        # settled by a few numbers.
        lacking = lambda these, those: sum((F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y)))) for x, y in zip(these, those)), F.lit(0))
        shared = F.least("rest", "label_rest", F.col("n_name") - lacking(name_marks, label_marks), F.col("n_label") - lacking(label_marks, name_marks))
        at_most = reach(shared, F.col("n_label"))
        return looked.join(shuffled(filed), ["token", "n_label"]).where(at_most >= F.col("so_far") - near).select("text", "label", at_most.alias("at_most"))

    def compared(pairs: DataFrame) -> DataFrame:
        """The best of the pairs (text, name_tokens and a label's columns) of each text."""
        score = F.struct((-overlap(in_common(F.col("label_tokens")), F.col("n_label"))).alias("neg"), "label", "label_tier")
        return pairs.groupBy("text").agg(F.min(score).alias("b"))

    # The pair that promises most is compared first. Its score leaves little else to compare. It is found by one number, of
    # steps of the score and bits of the label's hash, which is summed up before the shuffle; labels of equal bits are all compared.
    bits = F.xxhash64("label").bitwiseAND(F.lit((1 << 40) - 1))
    promise = meet(known).groupBy("text").agg(F.max((F.col("at_most") * (1 << 20)).cast("long") * (1 << 40) + bits).alias("most"))
    likely = promise.select("text", F.col("most").bitwiseAND(F.lit((1 << 40) - 1)).alias("bits")).join(shuffled(labels.withColumn("bits", bits)), "bits")
    likely = compared(likely.join(shuffled(known.select("text", "name_tokens")), "text"))
    known = known.join(shuffled(likely), "text", "left").withColumn("first", F.least("first", "b")).drop("b")

    met = meet(known).select("text", "label").distinct()
    candidates = compared(met.join(shuffled(known.select("text", "name_tokens")), "text").join(shuffled(labels), "label"))
    found = candidates.unionByName(known.select("text", F.col("first").alias("b"))).groupBy("text").agg(F.min("b").alias("b"))
    return found.select("text", "b.label", "b.label_tier", (-F.col("b.neg")).alias("score"))


#: Numbers of 64 bits that stand for the tokens of a name.
MARKS = 2


def token_marks(words: Column) -> list[Column]:
    """A bit for each token, by its hash, spread over ``MARKS`` numbers. Tokens may share a bit."""
    place = lambda w: F.pmod(F.xxhash64(w), F.lit(64 * MARKS)).cast("int")
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), place(w) % 64)
    none = F.lit(0).cast("long")
    mark = lambda i: F.aggregate(words, none, lambda held, w: held.bitwiseOR(F.when(F.floor(place(w) / 64) == i, bit(w)).otherwise(none)))
    return [mark(i) for i in range(MARKS)]


def enrich_new(df: DataFrame, known: DataFrame, labelled: DataFrame, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows to append to the breeds table for names it lacks."""
    return with_size(tier_lookup(new_categories(df, known), labelled), rules).select("breed", "tier", "tier_score", "breed_size")
