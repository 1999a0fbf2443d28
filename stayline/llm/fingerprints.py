"""Document fingerprints that tell which paragraphs two versions do not share: invertible Bloom lookup sketches.

A text's paragraphs are the runs between line breaks, long ones in pieces of ``LONGEST`` characters; their 64-bit digests form
a set. A sketch files each digest in three cells, one in each third; a cell keeps how many digests it got, their exclusive or
and that of their check values. Two sketches subtract cell by cell, which leaves the digests of only one side. Peeling reads
a cell that holds a single one, takes it out of its other cells, and goes on with what that uncovers. If cells are left, the
attempt failed, and sketches of twice the size with other hashes are tried, past the size at which both texts would fit.

All of it is built-in expressions on one row: cells are kept sparse and sorted, and merged by sorting, so a text of n
paragraphs takes about n log n steps. Only the next document's text must be fetched: rows are dealt to ranges of their ids by
sampled splitters, each range's first row also to the range before it, and one window a range looks one row ahead.

Null texts are empty and have no paragraphs; two empty texts are alike (1.0). Repeated paragraphs count once. Rows stand by
doc_id, then by hash of their text; null ids first. Rows that repeat both follow one another in any order. The first row follows
the last; a single row follows itself. An empty table gives an empty result. Only the named columns are read, so others may
have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.ranges import longs, place

#: Characters of a paragraph that are hashed together; cells of the fingerprint; attempts past the size that fits both.
LONGEST, CELLS, MORE = 256, 30, 6
#: Rounds of peeling in one attempt; each takes out all that the one before uncovered.
ROUNDS = 32
#: Rows of a range that are aimed at, ranges at most, and sampled ids for each.
RANGE_ROWS, RANGES, SAMPLES = 16_384, 16_384, 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def paragraphs(text: Column, longest: int = LONGEST) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\r\n]{1,%d}" % longest), F.lit(0))


def digests(text: Column, longest: int = LONGEST) -> Column:
    """The set of paragraph digests, array<bigint>."""
    return F.array_distinct(F.transform(paragraphs(text, longest), lambda p: F.xxhash64(p)))


def check(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("check")), 32)


def entry(cell: Column, n: Column, key: Column, checked: Column) -> Column:
    return F.struct(cell.cast("int").alias("cell"), n.cast("int").alias("n"), key.alias("key"), checked.alias("check"))


def entries(keys: Column, sign: int, cells: Column) -> Column:
    """What ``keys`` add to a sketch of ``cells`` cells, a multiple of three."""
    return F.flatten(F.transform(keys, lambda key: F.array(*_three(key, F.lit(sign), cells))))


def _three(key: Column, n: Column, cells: Column) -> list[Column]:
    third = (cells / 3).cast("int")
    return [entry(F.pmod(F.xxhash64(key, F.lit(j), cells), third) + third * j, n, key, check(key)) for j in range(3)]


def merged(parts: Column) -> Column:
    """One entry a cell, by cell, from any entries; cells in which nothing is left are dropped."""
    add = lambda a, b: entry(a["cell"], a["n"] + b["n"], a["key"].bitwiseXOR(b["key"]), a["check"].bitwiseXOR(b["check"]))
    zero = F.lit(0).cast("long")

    def by_cell(sorted_: Column) -> Column:
        new = lambda i: (i == 0) | (F.get(sorted_, i - 1)["cell"] != F.get(sorted_, i)["cell"])
        starts = F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), new)

        def summed(starts: Column) -> Column:
            run = lambda s, j: F.slice(sorted_, s + 1, F.coalesce(F.get(starts, j + 1), F.size(sorted_)) - s)
            return F.transform(starts, lambda s, j: F.aggregate(run(s, j), entry(F.get(sorted_, s)["cell"], F.lit(0), zero, zero), add))

        kept = F.filter(let(starts, summed), lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))
        return F.when(F.size(sorted_) == 0, sorted_).otherwise(kept)

    return let(F.array_sort(parts), by_cell)


def sketch(keys: Column, cells: int = CELLS) -> Column:
    """The cells of a set of digests that are not empty."""
    return merged(entries(keys, 1, F.lit(cells)))


def subtract(a: Column, b: Column) -> Column:
    return merged(F.concat(a, F.transform(b, lambda c: entry(c["cell"], -c["n"], c["key"], c["check"]))))


def peel(difference: Column, cells: Column) -> Column:
    """struct<cells, only_a, only_b, stuck>: the digests read off a difference, and the cells that are left."""

    def round_(state: Column, _: Column) -> Column:
        single = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == check(c["key"])))
        found = F.array_distinct(F.transform(single, lambda c: F.struct(c["key"].alias("key"), c["n"].alias("n"))))

        def taken(found: Column) -> Column:
            gone = F.flatten(F.transform(found, lambda f: F.array(*_three(f["key"], -f["n"], cells))))
            of = lambda n: F.transform(F.filter(found, lambda f: f["n"] == n), lambda f: f["key"])
            rest = merged(F.concat(state["cells"], gone))
            more = _state(rest, F.concat(state["only_a"], of(1)), F.concat(state["only_b"], of(-1)), F.size(found) == 0)
            return F.when(F.size(found) == 0, _state(state["cells"], state["only_a"], state["only_b"], F.lit(True))).otherwise(more)

        return F.when(state["stuck"], state).otherwise(let(found, taken))

    none = F.array().cast("array<bigint>")
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), _state(difference, none, none, F.lit(False)), round_)


def _state(cells: Column, only_a: Column, only_b: Column, stuck: Column) -> Column:
    return F.struct(cells.alias("cells"), only_a.alias("only_a"), only_b.alias("only_b"), stuck.alias("stuck"))


def difference(keys_a: Column, keys_b: Column, sketch_a: Column, sketch_b: Column, cells: int = CELLS) -> Column:
    """struct<peeled, only_a, only_b, attempts>: the digests of one side only, from two sketches of ``cells`` cells; where
    these are too small, from larger ones of the digests."""

    def outcome(p: Column, attempts: Column) -> Column:
        return F.struct((F.size(p["cells"]) == 0).alias("peeled"), p["only_a"].alias("only_a"), p["only_b"].alias("only_b"), attempts.cast("int").alias("attempts"))

    def larger(state: Column, level: Column) -> Column:
        size = F.lit(cells) * F.element_at(F.array(*[F.lit(1 << i) for i in range(26)]), level + 1)
        again = let(size, lambda n: peel(merged(F.concat(entries(keys_a, 1, n), entries(keys_b, -1, n))), n))
        return F.when(state["peeled"], state).otherwise(let(again, lambda p: outcome(p, level + 1)))

    fits = F.ceil(F.log2(F.greatest(F.lit(1.0), 2.0 * (F.size(keys_a) + F.size(keys_b)) / cells))).cast("int")
    first = let(peel(subtract(sketch_a, sketch_b), F.lit(cells)), lambda p: outcome(p, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.least(fits + MORE, F.lit(25))), first, larger)


def likeness(keys_a: Column, keys_b: Column, told: Column) -> Column:
    """Shared paragraphs over all, from the sizes of both sets and their ``difference``; null if that was never peeled."""
    shared, every = F.size(keys_a) - F.size(told["only_a"]), F.size(keys_a) + F.size(told["only_b"])
    return F.when(told["peeled"], F.when(every == 0, 1.0).otherwise(shared / every))


def written(keys: Column, cells: Column) -> Column:
    """A sketch as a string: the number of digests, then cell, count, digests and checks of each cell in use."""
    cell = lambda c: F.concat_ws(".", c["cell"], c["n"], F.lower(F.hex(c["key"])), F.lower(F.hex(c["check"])))
    return F.concat_ws(";", F.size(keys).cast("string"), F.array_join(F.transform(cells, cell), ","))


def changed(text: Column, only: Column, longest: int = LONGEST) -> Column:
    """The paragraphs of ``text`` whose digests are among ``only``."""
    return F.filter(paragraphs(text, longest), lambda p: F.array_contains(only, F.xxhash64(p)))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """doc_id, ``columns`` and the same of the next row, named next_...; the texts are shuffled once."""
    spark = docs.sparkSession
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    keyed = docs.withColumns({"_id": id_, "_tie": F.xxhash64("text")})
    n, least = docs.agg(F.count("*"), F.min(id_)).first()
    ranges = max(1, min(max(n // RANGE_ROWS, int(spark.conf.get("spark.sql.shuffle.partitions"))), RANGES, n // SAMPLES))
    stride = max(1, n // (ranges * SAMPLES))
    sample = sorted({tuple(r) for r in keyed.where(F.pmod(F.xxhash64("_id", "_tie"), F.lit(stride)) == 0).select("_id", "_tie").collect()})
    firsts = {sample[i * len(sample) // ranges] for i in range(1, ranges)} if sample else set()
    if n:
        # Splitters are rows of the table: each is the first of its range.
        firsts.add((least, keyed.where(F.col("doc_id").isNull() if least == -(2**63) else F.col("doc_id") == least).agg(F.min("_tie")).first()[0]))
    splitters = sorted(firsts)
    first_of = [longs([s[i] for s in splitters]) for i in range(2)]
    placed = keyed.withColumn("_range", place([F.col("_id"), F.col("_tie")], splitters) - 1)
    is_first = (F.get(first_of[0], F.col("_range")) == F.col("_id")) & (F.get(first_of[1], F.col("_range")) == F.col("_tie"))
    own = F.struct(F.col("_range").alias("of"), F.lit(False).alias("ahead"))
    before = F.struct(F.pmod(F.col("_range") - 1, F.lit(max(1, len(splitters)))).alias("of"), F.lit(True).alias("ahead"))
    dealt = placed.withColumn("_at", F.explode(F.when(is_first, F.array(own, before)).otherwise(F.array(own))))
    ahead = Window.partitionBy("_of").orderBy("_ahead", "_id", "_tie")
    dealt = dealt.select("doc_id", *columns, "_id", "_tie", F.col("_at.of").alias("_of"), F.col("_at.ahead").alias("_ahead"))
    return dealt.select("doc_id", *columns, "_ahead", *[F.lead(c).over(ahead).alias(f"next_{c}") for c in columns]).where("not _ahead").drop("_ahead")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last half replaced by the start of ``next_text``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def compared(docs: DataFrame, cells: int = CELLS, longest: int = LONGEST) -> DataFrame:
    """doc_id, text, edited, the fingerprints of both, and ``to_edited`` and ``to_next``: what sets the text apart from its
    edited form and from the next text, with the likeness to each."""
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(whole.withColumn("keys", digests(F.col("text"), longest)), ["text", "keys"])
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text"))).drop("next_text")
    rows = rows.withColumn("edited_keys", digests(F.col("edited"), longest))
    named = ["keys", "edited_keys", "next_keys"]
    rows = rows.withColumns({f"{c}_cells": sketch(F.col(c), cells) for c in named})
    told = lambda c: difference(F.col("keys"), F.col(c), F.col("keys_cells"), F.col(f"{c}_cells"), cells)
    rows = rows.withColumns({"to_edited": told("edited_keys"), "to_next": told("next_keys")})
    return rows.select(
        "doc_id", "text", "edited", written(F.col("keys"), F.col("keys_cells")).alias("fingerprint"),
        written(F.col("edited_keys"), F.col("edited_keys_cells")).alias("edited_fingerprint"), "to_edited", "to_next",
        likeness(F.col("keys"), F.col("edited_keys"), F.col("to_edited")).alias("near_edited"),
        likeness(F.col("keys"), F.col("next_keys"), F.col("to_next")).alias("near_next"),
    )
