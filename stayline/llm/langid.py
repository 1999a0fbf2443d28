"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary (its pieces up to eight UTF-8 bytes, and all
single bytes). The probability of a word is the sum over all ways to cut it into pieces, which a forward pass computes
byte by byte; a text's score is the product over its words. Piece probabilities come from expectation maximisation, a
forward and a backward pass over the words of a bounded sample of labelled rows per language.

A word is a run of letters, lower-cased; runs over 64 letters count as several words. Null texts and texts without a
letter are ``und`` with score 0, and so is every text if there was nothing to learn from. Rows with a null label or id
are not learned from. Rows are independent, so ties and repeated rows get equal results; equally likely languages are
settled by name. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
LONGEST = 8  # bytes of a piece, so that one fits a 64-bit key
_WORDS = regex.compile(r"\p{L}{1,64}").findall
_CHUNK_BYTES, _CHUNK_WORDS = 16_000_000, 20_000


def pieces(model_file: str) -> np.ndarray:
    """Sorted keys of the vocabulary in a SentencePiece model file, without word marks and lower-cased."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    found = {model.id_to_piece(i).replace("▁", "").lower().encode() for i in range(model.get_piece_size()) if not model.is_byte(i)}
    found = {p for p in found if 0 < len(p) <= LONGEST} | {bytes([b]) for b in range(1, 256)}
    return np.array(sorted(int.from_bytes(p, "little") for p in found), np.uint64)


def _lattice(words: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the words, and for each end position and piece length the piece's number there (len(keys): none)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=0))
    letters = np.zeros((len(words), width), np.uint8)
    letters[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    numbers = np.full((width + 1, LONGEST + 1, len(words)), len(keys), np.int32)
    packed = np.zeros((len(words), width), np.uint64)  # packed[:, s]: the piece of the current length that starts at s
    for length in range(1, min(LONGEST, width) + 1):
        starts = width - length + 1
        packed = packed[:, :starts] | (letters[:, length - 1 :].astype(np.uint64) << np.uint64(8 * (length - 1)))
        place = np.searchsorted(keys, packed)
        place[place == len(keys)] = 0
        place = np.where(keys[place] == packed, place, len(keys))
        numbers[length:, length, :] = place.T
    return lengths, numbers


def word_scores(words: list[bytes], keys: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word (rows) under each column of ``chances`` (pieces by languages)."""
    out = np.zeros((len(words), chances.shape[1]))
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    padded = np.vstack([chances, np.zeros((1, chances.shape[1]))])
    for lo in range(0, len(order), _CHUNK_WORDS):
        own = order[lo : lo + _CHUNK_WORDS]
        lengths, numbers = _lattice([words[i] for i in own], keys)
        shape = (len(own), chances.shape[1])
        ahead = [np.ones(shape)]  # the last LONGEST forward sums, scaled
        scale = np.zeros(shape)
        for end in range(1, int(lengths[0]) + 1 if len(own) else 0):
            live = int(np.searchsorted(-lengths, -end, side="right"))  # lengths fall, so live words come first
            total = np.zeros((live, shape[1]))
            for length in range(1, min(LONGEST, end) + 1):
                total += ahead[-length][:live] * padded[numbers[end, length, :live]]
            ahead = [a[:live] for a in ahead[-(LONGEST - 1) :]] + [total]
            if end % 8 == 0:
                top = np.maximum.reduce(ahead)
                top[top == 0] = 1
                ahead = [a / top for a in ahead]
                scale[:live] += np.log(top)
            ends = np.flatnonzero(lengths[:live] == end)
            if len(ends):
                with np.errstate(divide="ignore"):
                    scale[ends] += np.log(ahead[-1][ends])
        out[own] = scale
    return out


def expected_counts(words: list[bytes], weights: np.ndarray, keys: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, all segmentations weighed by their probability."""
    out = np.zeros(len(keys) + 1)
    padded = np.append(chances, 0.0)
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    for lo in range(0, len(order), _CHUNK_WORDS):
        own = order[lo : lo + _CHUNK_WORDS]
        lengths, numbers = _lattice([words[i] for i in own], keys)
        width, rows = int(lengths.max()), np.arange(len(own))
        # Each word's sums are kept in proportion: byte probabilities bound them below, so doubles do for 64 letters
        # once every position is scaled by the word's own factor.
        before = np.zeros((width + 1, len(own)))
        before[0] = 1
        factor = np.ones((width + 1, len(own)))
        for end in range(1, width + 1):
            grown = np.ones(len(own))
            for length in range(1, min(LONGEST, end) + 1):
                grown = grown / factor[end - length + 1] if length > 1 else np.ones(len(own))
                before[end] += before[end - length] * padded[numbers[end, length]] * grown
            factor[end] = np.where(before[end] > 0, before[end], 1)
            before[end] = np.where(before[end] > 0, 1.0, 0.0)
        after = np.zeros((width + 1, len(own)))
        after[lengths, rows] = 1
        for start in range(width - 1, -1, -1):
            grown = np.ones(len(own))
            for length in range(1, min(LONGEST, width - start) + 1):
                grown = grown / factor[start + length]
                part = after[start + length] * padded[numbers[start + length, length]] * grown
                after[start] += part
                np.add.at(out, numbers[start + length, length], part * before[start] * weights[own])
    return out[:-1]


def learn_pieces(words: Counter, keys: np.ndarray, rounds: int = 3, added: float = 0.05) -> np.ndarray:
    """Probability of each piece for the counted words of one language."""
    spelled = [w.encode() for w in words]
    weights = np.fromiter(words.values(), float, len(words))
    chances = np.full(len(keys), 1.0 / len(keys))
    for _ in range(rounds):
        counts = expected_counts(spelled, weights, keys, chances) + added
        chances = counts / counts.sum()
    return chances


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    keys: np.ndarray
    chances: np.ndarray
    prior: np.ndarray


def fit(docs: DataFrame, keys: np.ndarray, rows_per_language: int = 1_500, rounds: int = 3) -> Model:
    """Learns from ``docs`` (doc_id, text, lang): per language from at most ``rows_per_language`` rows, those with the
    smallest hash of their id; the shares of the languages come from all rows. The sample's texts stay in Spark; what
    reaches the driver is one number per piece and language."""
    named = docs.where("lang is not null and doc_id is not null")
    shares = {r.lang: r.rows for r in named.groupBy("lang").agg(F.count("*").alias("rows")).collect()}
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = named.select("doc_id", "lang").withColumn("_rank", rank).where(F.col("_rank") <= rows_per_language)
    chosen = chosen.select(F.col("doc_id").alias("_id")).distinct()
    sample = named.join(chosen, F.col("doc_id") == F.col("_id")).select("lang", "text")

    def learned(rows: pd.DataFrame) -> pd.DataFrame:
        words = Counter(w for text in rows["text"] if text for w in _WORDS(text.lower()))
        if not words:
            return pd.DataFrame({"lang": [], "chances": []})
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "chances": [learn_pieces(words, keys, rounds).tolist()]})

    found = {r.lang: r.chances for r in sample.groupBy("lang").applyInPandas(learned, "lang string, chances array<double>").collect()}
    languages = tuple(sorted(found))
    total = sum(shares[name] for name in languages) or 1
    chances = np.array([found[name] for name in languages]).reshape(len(languages), len(keys)).T
    return Model(languages, keys, np.ascontiguousarray(chances), np.array([shares[name] / total for name in languages]))


def _predicted(texts: list[str], model: Model) -> list[tuple[str, float]]:
    index: dict[str, int] = defaultdict(count().__next__)
    found = [np.fromiter(map(index.__getitem__, _WORDS(text.lower())), np.int64) for text in texts]
    scores = word_scores([w.encode() for w in index], model.keys, model.chances)
    out = []
    for ids in found:
        if not len(ids) or not model.languages:
            out.append((UNKNOWN, 0.0))
            continue
        total = scores[ids].sum(axis=0) + np.log(model.prior)
        best = int(np.argmax(total))
        out.append((model.languages[best], float(1 / np.exp(total - total[best]).sum())))
    return out


def predict(text: Column, model: Model) -> Column:
    """struct<lang, score> of each text: the likeliest language and its posterior probability."""

    @F.arrow_udf("lang string, score double")
    def predicted(texts: pa.Array) -> pa.Array:
        out: list[tuple[str, float]] = []
        held: list[str] = []
        size = 0
        for value in texts:
            held.append(value.as_py() or "")
            size += len(held[-1])
            if size > _CHUNK_BYTES:
                out += _predicted(held, model)
                held, size = [], 0
        out += _predicted(held, model)
        return pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], names=["lang", "score"])

    return predicted(text)
