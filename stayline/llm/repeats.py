"""Removes bytes covered by a long string that also starts earlier in the corpus.

A string of ``length`` bytes is a repeat if an equal one starts earlier: in a document with a smaller id, or further left in
the same one. The work is that of a suffix array, on a thinned set of suffixes:

* Content-defined tokens. Of the 24-byte grams in a window the one with the smallest hash is the window's anchor; it
  depends on nothing but the window, so equal windows have equal anchors. Windows with the same anchor form a *family*, one
  row for about 40 bytes of text: the anchor gram is the suffix's leading token, the rest of the family the next one.
* Splitters sampled from the corpus range-partition the families by leading token (then next token, document, place, so
  that a frequent token spreads over several buckets). Each bucket is sorted locally by multikey quicksort: by the first
  key, then ties by the next.
* Neighbours are compared. In a run of equal families all but the first are repeats as a whole. A family whose leading
  token it shares with a different one may repeat in part, as may those in a run that touches a bucket's boundary: their
  windows are keyed one by one, range-partitioned and sorted in the same way, and the first of each bucket is compared with
  the last of those before.

Families and windows are compared by 128 bits of hash. Null texts count as empty. Rows with a null id are left whole and
make nothing a repeat; rows that repeat an id are the same document, so equal places in them are not earlier than each
other. Texts shorter than ``length`` bytes are left whole, very long ones are worked on in pieces of fixed size where it
matters for memory. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.session import work_path

GRAM, LENGTH = 24, 100
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)


def _eights(data: bytes) -> np.ndarray:
    out = np.empty(max(len(data) - 7, 0), np.uint64)
    for j in range(min(8, len(out))):
        out[j::8] = np.frombuffer(data, "<u8", count=(len(data) - j) // 8, offset=j)
    return out


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of what ``a`` stands for followed by what ``b`` stands for."""
    return _mix(a * _U(0xD6E8FEB86659FD93) + (b ^ (b >> _U(32))) * _U(0xA0761D6478BD642F))


def hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the gram and of the window that start at each place."""
    level, width = _mix(_eights(data)), 8
    grams = None
    while width * 2 <= LENGTH:
        doubled = _join(level[:-width], level[width:])
        if width == 8:
            grams = _join(doubled[:-8], level[16:])
        level, width = doubled, width * 2
    rest = LENGTH - width
    return grams, _join(level[: len(level) - rest], level[rest:])


def anchors(grams: np.ndarray, windows: int) -> np.ndarray:
    """The leftmost place of the smallest gram hash in each window."""
    span = LENGTH - GRAM + 1
    value, place, width = grams, np.arange(len(grams)), 1

    def least(step: int) -> tuple[np.ndarray, np.ndarray]:
        first = value[:-step] <= value[step:]
        return np.where(first, value[:-step], value[step:]), np.where(first, place[:-step], place[step:])

    while width * 2 <= span:
        value, place = least(width)
        width *= 2
    if span > width:
        value, place = least(span - width)
    return place[:windows]


def families(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading token, next token and packed place (first window, windows after it, anchor after it) of each family."""
    count = len(data) - LENGTH + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
    grams, whole = hashes(data)
    own = anchors(grams, count)
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    ends = np.append(starts[1:], count) - 1
    shape = (ends - starts) << 7 | (own[starts] - starts)
    return grams[own[starts]], _join(_join(whole[starts], whole[ends]), shape.astype(np.uint64)), starts << 14 | shape


def pieces(data: bytes, family: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of the given families (packed places) in groups of eight starts that follow each other: hash of the core
    that all of a group share, the seven bytes before and after it, and the packed place. A window is its core, the nearest
    j bytes before it and the nearest 7 - j after it."""
    first, shift = family >> 14, family & 127
    last = first + ((family >> 7) & 127)
    anchor = first + shift
    nearest, farthest = anchor - last, anchor - first  # how far windows start before the anchor
    many = farthest // 8 - nearest // 8 + 1
    at = np.repeat(np.arange(len(family)), many)
    group = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + nearest[at] // 8
    core = anchor[at] - 8 * group
    low, high = np.maximum(nearest[at] - 8 * group, 0), np.minimum(farthest[at] - 8 * group, 7)
    level, width = _mix(_eights(data)), 8
    while width * 2 <= LENGTH - 7:
        level, width = _join(level[:-width], level[width:]), width * 2
    rest = LENGTH - 7 - width
    # The group's number too: equal windows have equal anchors, and a core may serve two anchors.
    whole = _join(_join(level[core], level[core + rest]), group.astype(np.uint64))
    padded = np.frombuffer(b"\0" * 8 + data + b"\0" * 8, np.uint8)
    before, after = np.zeros(len(core), np.uint64), np.zeros(len(core), np.uint64)
    for t in range(7):
        before |= padded[core + 7 - t].astype(np.uint64) << _U(8 * t)
        after |= padded[core + 8 + LENGTH - 7 + t].astype(np.uint64) << _U(8 * t)
    after |= (low << 3 | high).astype(np.uint64) << _U(56)  # rows are equal only if they hold the same windows
    return whole, before, after, core << 6 | low << 3 | high


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order of rows by several keys: quicksort by the first, then only what is tied by the next, and so on."""
    order = np.argsort(keys[0], kind="stable")
    tied = np.arange(len(order))  # places in the order whose rows may still be tied with a neighbour
    start = np.arange(len(order)) == 0
    for depth, key in enumerate(keys):
        if depth:
            run = np.cumsum(start[tied])
            part = order[tied]
            order[tied] = part[np.lexsort((key[part], run))]
        new = np.ones(len(order), bool)
        if len(order):
            sorted_key = key[order]
            new[1:] = start[1:] | (sorted_key[1:] != sorted_key[:-1])
        start = new
        lone = start & np.append(start[1:], True)
        tied = np.flatnonzero(~lone)
        if not len(tied):
            break
    return order


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any key."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _later(new: np.ndarray, docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rows that come later in the corpus than the first of their run (which starts where ``new``)."""
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.empty(0, np.int64)
    return (docs != docs[head]) | (places != places[head])


def _merged(docs: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of a document as one. Spans that follow each other in order are enough here: what is
    not merged is merged when a document's spans are gathered."""
    if not len(docs):
        return docs, low, high
    order = np.lexsort((low, docs))
    docs, low, high = docs[order], low[order], high[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (low[1:] > high[:-1])
    starts = np.flatnonzero(new)
    return docs[starts], low[starts], np.maximum.reduceat(high, starts)


KEYS = ("a", "b", "c", "doc", "place")
_SHAPE = "kind int, a long, b long, c long, doc long, place long"
SPAN, ROW, OPEN = 0, 1, 2


def _signed(*arrays: np.ndarray) -> list[np.ndarray]:
    return [x.view(np.int64) if x.dtype == np.uint64 else x for x in arrays]


def _frame(kind: int, a, b, c, doc, place) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.int32(kind), "a": a, "b": b, "c": c, "doc": doc, "place": place})


def _spans(docs: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
    docs, low, high = _merged(docs, low, high)
    zero = np.zeros(len(docs), np.int64)
    return _frame(SPAN, zero, zero, high, docs, low)


class Buckets:
    """Splitters between buckets: rows are dealt by their keys, document and place last, in ascending order."""

    def __init__(self, sample: list[tuple], count: int) -> None:
        sample = sorted(sample)
        self.cuts = sorted({sample[len(sample) * i // count] for i in range(1, count)}) if sample else []
        self.lead = np.array([c[0] for c in self.cuts], np.int64)

    def of(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.searchsorted(self.lead, rows[0], side="right")
        for i in np.flatnonzero(np.searchsorted(self.lead, rows[0], side="left") != out):  # as frequent as a splitter
            out[i] = bisect.bisect_right(self.cuts, tuple(int(x[i]) for x in rows))
        return out.astype(np.int32)


def _stack(parts: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64)] * 5


def _family_rows(docs: pd.DataFrame) -> list[np.ndarray]:
    parts = []
    for doc, text in zip(docs["doc_id"].tolist(), docs["text"]):
        lead, then, place = families(text.encode())
        parts.append((*_signed(lead, then), np.zeros(len(place), np.int64), np.full(len(place), doc, np.int64), place))
    return _stack(parts)


def _piece_rows(docs: pd.DataFrame) -> list[np.ndarray]:
    parts = []
    for doc, text, family in zip(docs["doc_id"].tolist(), docs["text"], docs["families"]):
        core, before, after, place = pieces(text.encode(), np.sort(np.asarray(family, np.int64)))
        parts.append((*_signed(core, before, after), np.full(len(place), doc, np.int64), place))
    return _stack(parts)


def _dealt(rows: list[np.ndarray], span_of, buckets: Buckets) -> pd.DataFrame:
    """What a batch sends on: of equal rows only the earliest, the others being repeats already."""
    order = multikey_order(*rows)
    rows = [x[order] for x in rows]
    new = _runs(*rows[:3])
    later = _later(new, *rows[3:])
    low, high = span_of(rows[4][later])
    kept = [x[new] for x in rows]
    spans, sent = _spans(rows[3][later], low, high), _frame(ROW, *kept)
    sent["bucket"] = buckets.of(kept)
    spans["bucket"] = (spans["doc"] % (len(buckets.cuts) + 1)).astype("int32")
    return pd.concat([spans, sent])


def _family_span(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = place >> 14
    return low, low + ((place >> 7) & 127) + LENGTH


def _piece_span(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (place >> 6) - (place & 7), (place >> 6) - ((place >> 3) & 7) + LENGTH


def _compare_families(rows: list[np.ndarray]) -> list[pd.DataFrame]:
    """Spans of the families that repeat an earlier one; families that may repeat in part are left open."""
    order = multikey_order(*rows)
    lead, then, _, doc, place = (x[order] for x in rows)
    new, new_lead = _runs(lead, then), _runs(lead)
    later = _later(new, doc, place)
    run = np.cumsum(new_lead) - 1
    kinds = np.bincount(run, weights=new)
    kinds[[0, -1]] = 2  # may go on in a neighbouring bucket
    still = new & (kinds[run] > 1)
    zero = np.zeros(still.sum(), np.int64)
    return [_spans(doc[later], *_family_span(place[later])), _frame(OPEN, zero, zero, zero, doc[still], place[still])]


def _compare_pieces(rows: list[np.ndarray]) -> list[pd.DataFrame]:
    """Spans of the windows that repeat an earlier one; the first ones of a bucket's outer runs are left open."""
    order = multikey_order(rows[0], rows[3], rows[4])
    core, before, after, doc, place = (x[order] for x in rows)
    run = np.cumsum(_runs(core)) - 1
    alone = np.bincount(run) == 1
    outer = (run == 0) | (run == run[-1])
    use = ~alone[run] | outer
    core, before, after, doc, place, outer = (x[use] for x in (core, before, after, doc, place, outer))
    out, spans = [], []
    for j in range(8):
        has = np.flatnonzero((((place >> 3) & 7) <= j) & ((place & 7) >= j))
        keys = core[has], before[has] & ((1 << 8 * j) - 1), after[has] & ((1 << 8 * (7 - j)) - 1) | j << 56
        start = (place[has] >> 6) - j
        order = multikey_order(*keys, doc[has], start)
        keys, docs, start, edge = [k[order] for k in keys], doc[has][order], start[order], outer[has][order]
        new = _runs(*keys)
        later = _later(new, docs, start)
        spans.append((docs[later], start[later], start[later] + LENGTH))
        still = new & edge
        out.append(_frame(OPEN, *[k[still] for k in keys], docs[still], start[still]))
    return [_spans(*[np.concatenate(x) for x in zip(*spans)]), *out]


def _bucketed(rows: DataFrame, shape_of, span_of, compare, buckets: Buckets) -> DataFrame:
    """Deals rows to their buckets and compares them there; result in the shared folder: spans and what is left open."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 2_000):
                yield _dealt(shape_of(batch.iloc[lo : lo + 2_000]), span_of, buckets)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for batch in batches:
            row = batch["kind"] == ROW
            yield batch.loc[~row, ["kind", *KEYS]]
            held.append(batch.loc[row, list(KEYS)])
        rows = pd.concat(held) if held else pd.DataFrame(columns=list(KEYS))
        if len(rows):
            yield from compare([rows[k].to_numpy(np.int64) for k in KEYS])

    dealt = rows.mapInPandas(deal, f"{_SHAPE}, bucket int").repartitionById(len(buckets.cuts) + 1, F.col("bucket"))
    path = work_path(rows.sparkSession, "repeats")
    dealt.drop("bucket").mapInPandas(settle, _SHAPE).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _sampled(rows: DataFrame, shape_of, each: int, count: int) -> Buckets:
    """Splitters from ``rows``, a bounded sample, with ``each`` of what a row gives."""

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame(dict(zip(KEYS, shape_of(batch))))
            yield found.sample(frac=1, random_state=0).groupby("doc").head(each)[list(KEYS)]

    shape = ", ".join(f"{k} long" for k in KEYS)
    return Buckets([tuple(r) for r in rows.mapInPandas(some, shape).collect()], count)


def spans(docs: DataFrame, sample_docs: int = 1_000, sample_each: int = 100, buckets: int | None = None) -> DataFrame:
    """doc_id and spans, the maximal runs of bytes (start, end) that are repeats, of documents (doc_id, text) with any.
    Splitters come from ``sample_each`` suffixes each of ``sample_docs`` documents; they even out the buckets only."""
    spark = docs.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    # Ids only, sample_docs at most: 8 kB by default.
    chosen = F.broadcast(texts.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(sample_docs).select(F.col("doc_id").alias("_of")))
    sample = texts.join(chosen, F.col("doc_id") == F.col("_of"), "left_semi")
    first = _bucketed(texts, _family_rows, _family_span, _compare_families, _sampled(sample, _family_rows, sample_each, count))

    unsettled = first.where(F.col("kind") == OPEN).groupBy(F.col("doc").alias("_of")).agg(F.collect_list("place").alias("families"))
    again = texts.join(unsettled.hint("shuffle_hash"), F.col("doc_id") == F.col("_of")).select("doc_id", "text", "families")
    probe = sample.join(unsettled, F.col("doc_id") == F.col("_of")).select("doc_id", "text", "families")
    second = _bucketed(again, _piece_rows, _piece_span, _compare_pieces, _sampled(probe, _piece_rows, sample_each, count))

    edges = second.where(F.col("kind") == OPEN)
    heads = edges.groupBy("a", "b", "c").agg(F.min(F.struct("doc", "place")).alias("head"))
    crossed = edges.join(heads, ["a", "b", "c"]).where(F.struct("doc", "place") > F.col("head"))
    span = F.struct(F.col("place").alias("start"), F.col("c").alias("end"))
    found = first.where(F.col("kind") == SPAN).unionAll(second.where(F.col("kind") == SPAN)).select("doc", span.alias("span"))
    found = found.unionAll(crossed.select("doc", F.struct(F.col("place").alias("start"), (F.col("place") + LENGTH).alias("end")).alias("span")))
    return found.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list("span").alias("spans"))


def _united(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    at = np.flatnonzero(new)
    return list(zip(starts[at].tolist(), ends[np.append(at[1:], len(starts)) - 1].tolist()))


def remove(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_bytes, removed (the runs of bytes taken out) and kept (the bytes left, end to end) of each document."""
    found = spans(docs, **how).withColumnRenamed("doc_id", "_of")
    named = docs.select(F.col("doc_id"), "text")
    joined = named.join(found.hint("shuffle_hash"), F.col("doc_id") == F.col("_of"), "left")
    starts, ends = F.transform("spans", lambda s: s["start"]), F.transform("spans", lambda s: s["end"])
    asked = joined.select(F.col("doc_id").cast("decimal(20,0)").alias("doc_id"), "text", starts.alias("starts"), ends.alias("ends"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, start, end in zip(batch["doc_id"].tolist(), batch["text"], batch["starts"], batch["ends"]):
                data = (text or "").encode()
                gone = _united(np.asarray(start, np.int64), np.asarray(end, np.int64)) if start is not None else []
                left = [0, *[e for _, e in gone]], [*[s for s, _ in gone], len(data)]
                kept = b"".join([data[lo:hi] for lo, hi in zip(*left)]) if gone else data
                out.append((None if doc is None else int(doc), len(data), [{"start": s, "end": e} for s, e in gone], kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "removed", "kept"]).astype({"doc_id": "Int64"})

    return asked.mapInPandas(cut, "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")
