"""Byte-level BPE, encoded by dynamic programming over prefixes.

For every prefix of a pretoken the *last* token of its encoding is unique, so one token id per prefix is stored. The
tokens that end a prefix come from an automaton over the vocabulary; such a token is right if the encoding of what is
left of it ends in a token that it can stand next to, i.e. no merge across their border would have come first. The ids
are read off by following the stored tokens backwards.

Null texts count as empty and give no ids. The text of an added token (``<|endoftext|>``) becomes its id. Rows are
independent: ties, repeated rows and other columns do not matter, a very long text is one row of a batch, and an empty
table gives an empty result. Ids outside the vocabulary are left out when decoding; null id lists decode to null.
"""

from __future__ import annotations

import ctypes
import gc
import json
import threading
import time
from array import array
from contextlib import suppress
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The split pattern of byte-level BPE, with white space named by its Unicode property.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Pretokens and token pairs that a worker remembers at most; then it starts afresh. Speed only, never results.
REMEMBERED = 300_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file, as letter -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """A vocabulary file of the tokenizers library, ready to encode and decode."""

    def __init__(self, content: str, remembered: int = REMEMBERED) -> None:
        import ahocorasick
        import regex

        self.remembered = remembered
        spec = json.loads(content)
        letters = byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: text.encode() for text, i in self.added.items()}
        vocabulary = spec["model"]["vocab"]
        # rank of the merge that makes a token; parts it is made of; rank of joining two tokens
        self.born = dict.fromkeys(vocabulary.values(), -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made = vocabulary[left + right]
            self.joined[vocabulary[left], vocabulary[right]] = rank
            if made not in self.parts:
                self.parts[made] = vocabulary[left], vocabulary[right]
                self.born[made] = rank
        self.endings = ahocorasick.Automaton()
        for i in vocabulary.values():
            token = self.bytes_of[i].decode("latin-1")
            self.endings.add_word(token, (i, len(token)))
        self.endings.make_automaton()
        self.pieces = regex.compile(SPLIT).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.span = max(self.bytes_of, default=0) + 1
        self.pairs: dict[int, bool] = {}  # by left * span + right
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        # the tokens' bytes end to end; the last entry is empty and stands for unknown ids
        table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=-1) + 1)] + [b""]
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.letters = np.frombuffer(b"".join(table), np.uint8)

    def side_by_side(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` stay two tokens: goes back through the merges that made them, the latest first, and
        asks at each point whether what then stood at the border would have been joined before it was used up."""
        never = len(self.born) + len(self.joined)
        left, right, left_used, right_used = a, b, never, never
        while True:
            rank = self.joined.get((left, right))
            if rank is not None and rank < left_used and rank <= right_used:
                return False
            if self.born[left] > self.born[right]:
                left_used, left = self.born[left], self.parts[left][1]
            elif right in self.parts:
                right_used, right = self.born[right], self.parts[right][0]
            else:
                return True

    def fits(self, pair: int) -> bool:
        """``side_by_side``, remembered."""
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= self.remembered:
                self.pairs.clear()
            found = self.pairs[pair] = self.side_by_side(*divmod(pair, self.span))
        return found

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Stores the last token of each prefix that can be asked for and reads them off from the end."""
        data = piece.encode().decode("latin-1")
        size = len(data)
        endings: list[list] = [[] for _ in range(size + 1)]
        for at, ending in self.endings.iter(data):
            endings[at + 1].append(ending)  # the longest first
        last: list[int] = [-1] * (size + 1)
        taken = [0] * (size + 1)
        known, span = self.pairs.get, self.span
        # Prefixes are settled when first needed; ``open_ends`` holds those still waiting for a shorter one.
        open_ends, tried = [size], [0] * (size + 1)
        while open_ends:
            end = open_ends[-1]
            options = endings[end]
            while True:
                token, length = options[tried[end]]
                start = end - length
                if not start:
                    break
                before = last[start]
                if before < 0:
                    open_ends.append(start)
                    break
                pair = before * span + token
                if known(pair) or self.fits(pair):
                    break
                tried[end] += 1
            if open_ends[-1] == end:
                last[end], taken[end] = token, length
                open_ends.pop()
        out, end = [], size
        while end:
            out.append(last[end])
            end -= taken[end]
        out.reverse()
        return tuple(out)

    def packed_piece(self, piece: str) -> bytes:
        """The ids of a pretoken as 32-bit integers; what was used lately outlives a full memory. A pretoken that starts with a
        space is remembered as a word, so that nothing is kept twice."""
        if len(piece) > 1 and piece[0] == " ":
            return self.words.get(piece[1:]) or self.packed_word(piece[1:])
        ids = self.known.get(piece) or self.older.get(piece) or array("i", self.encode_piece(piece)).tobytes()
        if len(piece) <= 64:
            if len(self.known) >= self.remembered // 2:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def packed_word(self, word: str) -> bytes:
        """The ids of a space and the word after it."""
        ids = self.older_words.get(word)
        if ids is None:
            parts = self.pieces(" " + word)
            ids = b"".join(map(self.packed_piece, parts)) if len(parts) > 1 else array("i", self.encode_piece(parts[0])).tobytes()
        if len(word) <= 64:
            if len(self.words) >= self.remembered // 2:
                self.older_words, self.words = self.words, {}
            self.words[word] = ids
        return ids

    def packed_plain(self, text: str) -> bytes:
        if "  " in text:
            return b"".join(map(self.packed_piece, self.pieces(text)))
        # No pretoken crosses a single space but to start with it, so such words can be coded one by one.
        first, *words = text.split(" ")
        at_hand = self.words.get
        lead = b"".join(map(self.packed_piece, self.pieces(first)))
        return lead + b"".join([at_hand(w) or self.packed_word(w) for w in words])

    def packed(self, text: str) -> bytes:
        """The ids of a text, as 32-bit integers."""
        if self.cut and any(t in text for t in self.added):
            parts = self.cut.split(text)
            return b"".join([array("i", [self.added[p]]).tobytes() if p in self.added else self.packed_plain(p) for p in parts])
        return self.packed_plain(text)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode_packed(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        ids = np.where((ids >= 0) & (ids < len(self.sizes)), ids, len(self.sizes) - 1)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        # source of each written byte: its token's start in the table, plus its place in the token
        place = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.letters[place].tobytes().decode("utf-8", errors="replace")

    def decode(self, ids) -> str:
        return self.decode_packed(np.asarray(ids, np.int64))


@lru_cache(maxsize=1)
def codec(content: str, remembered: int = REMEMBERED) -> Codec:
    return Codec(content, remembered)


class _Idle:
    """Gives back what a Python worker holds for coding once it has coded nothing for a while: workers are used again for
    other stages, which need the room."""

    seconds = 6.0

    def __init__(self) -> None:
        self.last, self.watch = 0.0, None

    def touch(self) -> None:
        self.last = time.monotonic()
        if self.watch is None or not self.watch.is_alive():
            self.watch = threading.Thread(target=self.wait, daemon=True)
            self.watch.start()

    def wait(self) -> None:
        while (left := self.last + self.seconds - time.monotonic()) > 0:
            time.sleep(left)
        codec.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # the C library's own free lists, where it is glibc
            ctypes.CDLL(None).malloc_trim(0)


_IDLE = _Idle()


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Sends ``rows`` texts at a time to Python. A batch's texts, ids and decoded texts are in a worker's memory at once, and
    Spark's own 10,000 rows are too many for long texts. Speed and memory only, never results."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def _content(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(text: Column, path: str) -> Column:
    """The ids of ``text`` under the vocabulary file at ``path`` (read by the driver), an array of ints."""
    content = _content(path)

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _encoded(codec(content), texts)

    return ids(text)


def _encoded(own: Codec, texts: pa.Array) -> pa.ListArray:
    flat, ends = bytearray(), [0]
    _IDLE.touch()
    for value in texts:
        flat += own.packed(value.as_py() or "")
        ends.append(len(flat) // 4)
    _IDLE.touch()
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))


def _decoded(own: Codec, lists: pa.ListArray) -> pa.Array:
    flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    known = lists.is_valid().to_pylist()
    return pa.array([own.decode_packed(flat[ends[i] : ends[i + 1]]) if known[i] else None for i in range(len(lists))], pa.string())


def round_trip(text: Column, path: str, remembered: int = REMEMBERED) -> Column:
    """struct<ids, decoded>: the ids and the text that they decode to, by one call. ``decode(encode(text))`` beside
    ``encode(text)`` would encode twice, as Spark puts both into one call to Python. With less ``remembered`` a worker holds
    less and codes more pretokens anew."""
    content = _content(path)

    @F.arrow_udf("ids array<int>, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        own = codec(content, remembered)
        ids = _encoded(own, texts)
        return pa.StructArray.from_arrays([ids, _decoded(own, ids)], names=["ids", "decoded"])

    return both(text)


def decode(ids: Column, path: str) -> Column:
    """The text of a column of id arrays."""
    content = _content(path)

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        return _decoded(codec(content), lists)

    return text(ids)
