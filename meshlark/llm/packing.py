"""Packing along a space-filling curve: similar documents share training sequences, and nothing is padded.

Every document becomes a vector of hashed token counts, projected to three dimensions; its place on a Hilbert
curve orders the documents. The token stream in that order is cut into sequences.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.llm import common
from meshlark.plans.lineage import store
from meshlark.plans.ordered import running_totals

DIMENSIONS, BITS, BUCKETS = 3, 16, 4096
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 1_000_000
#: Rows and bytes that Spark hands to Python at a time, about one slice, and rows that it reads from a file at a time. All are
#: held in the JVM, some of them several times over; its heap grows with them and seldom shrinks.
BATCH_ROWS, BATCH_BYTES, READ_ROWS = 1_000, 900_000, 256
#: Encoded words that a Python worker remembers, and, as a power of 2, the places of the table in which they are found.
REMEMBERED, PLACE_BITS = 500_000, 21
#: Bytes that tell a word in the table; longer words are found by a dictionary.
SHORT = 16
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Signs that the tokenizer takes as one word where they follow letters: all of ASCII but the apostrophe.
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A word as letters (of Latin-1), signs after them, and what else it holds.
_PARTS = re.compile(rb"((?:[a-zA-Z]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc2[\xaa\xb5\xba])*+)"
                    rb"([" + re.escape(_SIGNS) + rb"]*+)([^ ]*+) ")
PIECE_SCHEMA = ("doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long, "
                "padded_length long, curve_key long")
_PROJECTION = np.random.RandomState(11).standard_normal((BUCKETS, DIMENSIONS))


class WordEncoder:
    """Token ids of whole texts, each distinct word encoded once.

    The tokenizer's rules never look across ASCII white space and ignore case, so a text's ids are those of its
    words in turn; the ids of all words (16 bits each) stand in one array. A word of up to ``SHORT`` bytes is known by
    these bytes, two numbers that are found in a table with open places; its number is its row in the arrays. Runs of
    letters are encoded many at a time: each ends in a token that ends a word. Signs after such a run are a word of
    their own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits: the tokenizer has more than 65,536")
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.table = np.zeros(1 << PLACE_BITS, np.int32)  # number of the word + 1
        self.keys = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.long: dict[bytes, int] = {}
        self.signs: dict[bytes, bytes] = {}
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, "<u2")

    def _letters(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u2")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            return self._any(words)
        raw, at = ids.tobytes(), [0, *(2 * stops).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _any(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(c.ids, "<u2").tobytes() for c in coded]

    def _find(self, keys: tuple[np.ndarray, ...]) -> np.ndarray:
        """Numbers of the words with these keys, -1 for those that the table does not have."""
        number = np.full(len(keys[0]), -1)
        left = np.flatnonzero(keys[2] <= SHORT)
        place = _places(keys)[left]
        while len(left):
            held = self.table[place] - 1
            left, place, held = (x[held >= 0] for x in (left, place, held))
            same = np.logical_and.reduce([own[held] == key[left] for own, key in zip(self.keys, keys)])
            number[left[same]] = held[same]
            left, place = left[~same], (place[~same] + 1) & (len(self.table) - 1)
        return number

    def _remember(self, words: list[bytes], keys: tuple[np.ndarray, ...]) -> None:
        number = len(self.keys[0]) + np.arange(len(words))
        self.keys = tuple(np.concatenate(x) for x in zip(self.keys, keys))
        self.long.update((word, n) for word, n in zip(words, number.tolist()) if len(word) > SHORT)
        short = keys[2] <= SHORT
        number, place = number[short], _places(keys)[short]
        while len(number):
            free = self.table[place] == 0
            self.table[place[free]] = number[free] + 1
            left = self.table[place] != number + 1  # taken before, or by another of these words
            number, place = number[left], (place[left] + 1) & (len(self.table) - 1)

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are not known."""
        found = _PARTS.findall(b" ".join(words) + b" ") if words else []
        alone = {word for word, (run, signs, rest) in zip(words, found) if run and not signs and not rest}
        runs = list({run for run, signs, rest in found if run and signs and not rest} - alone)
        stops = np.cumsum([len(run) for run in runs], dtype=np.int64)
        number = self._find(_keys(np.frombuffer(b"".join(runs), np.uint8), np.append(0, stops[:-1])[:len(runs)], stops)).tolist()
        edges = [*zip(self.starts[number].tolist(), self.starts[np.array(number, np.int64) + 1].tolist())]
        new = {run: self.ids[a:b].tobytes() for run, n, (a, b) in zip(runs, number, edges) if n >= 0}
        if len(self.signs) > 10_000:
            self.signs = {}
        signs = self.signs
        for kind, encode, to in (([*alone, *(run for run in runs if run not in new)], self._letters, new),
                                 ([word for word, (run, _, rest) in zip(words, found) if rest or not run], self._any, new),
                                 (list({sign for run, sign, rest in found if run and sign and not rest} - signs.keys()), self._any, signs)):
            for start in range(0, len(kind), 5000):
                part = kind[start:start + 5000]
                to.update(zip(part, encode([word.decode() for word in part])))
        return [new[run] + signs[sign] if run and sign and not rest else new[word]
                for word, (run, sign, rest) in zip(words, found)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        return self.encode_joined(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))

    def encode_joined(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts (UTF-8) that ``data`` holds one after the other."""
        low, raw = common.lowered(data), data.tobytes()
        # Strings such as <|endoftext|> are tokens in this spelling only.
        at = raw.find(b"<|")
        while at >= 0:
            text = int(np.searchsorted(offsets, at, "right"))
            low[offsets[text - 1]:offsets[text]] = data[offsets[text - 1]:offsets[text]]
            at = raw.find(b"<|", int(offsets[text]))
        raw = low.tobytes()
        starts, stops = common.word_bounds(low, offsets)
        keys = _keys(low, starts, stops)
        number, count = self._find(keys), len(self.keys[0])
        left = np.flatnonzero(number < 0)
        fresh, long = {}, self.long
        words = [raw[a:b] for a, b in zip(starts[left].tolist(), stops[left].tolist())]
        number[left] = [long[w] if w in long else fresh.setdefault(w, count + len(fresh)) for w in words]
        words = list(fresh)
        learned = self._learn(words)
        ids = np.concatenate((self.ids, np.frombuffer(b"".join(learned), "<u2")))
        edges = np.concatenate((self.starts, self.starts[-1] + np.cumsum([len(x) // 2 for x in learned], dtype=np.int64)))
        if words and count < REMEMBERED:  # the words seen first hold the frequent ones; others are forgotten
            kept = min(len(words), REMEMBERED - count)
            row = left[np.unique(number[left], return_index=True)[1]][-len(words):][:kept]
            self.starts, self.ids = edges[:count + kept + 1], ids[:edges[count + kept]]
            self._remember(words[:kept], tuple(key[row] for key in keys))
        sizes = edges[number + 1] - edges[number]
        upto = np.append(0, np.cumsum(sizes))
        coded = ids[np.repeat(edges[number] - upto[:-1], sizes) + np.arange(upto[-1])]
        cuts = upto[np.searchsorted(starts, offsets)]
        return [coded[a:b] for a, b in zip(cuts, cuts[1:])]


def _keys(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """The first 8 bytes of each word, the 8 after them, and its size."""
    sizes = stops - starts
    eight = np.ndarray(len(data) + 9, "<u8", np.append(data, np.zeros(16, np.uint8)), strides=(1,))
    return (eight[starts] & _FIRST_BYTES[np.minimum(sizes, 8)],
            eight[np.minimum(starts + 8, len(data))] & _FIRST_BYTES[np.clip(sizes - 8, 0, 8)], sizes)


def _places(keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """Where the search for words begins."""
    mixed = common.mixed(keys[0] * np.uint64(0x9E3779B97F4A7C15) + common.mixed(keys[1] + keys[2].astype(np.uint64)))
    return (mixed >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


_encoders: dict[str, WordEncoder] = {}


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of integer points (rows, dimensions) on the Hilbert curve of ``bits`` bits per dimension (Skilling, 2004)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, from the coarsest cell to the finest
        p = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            t = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(texts: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of the projected vector of damped, hashed counts of each list of ids."""
    flat = np.zeros((len(texts), DIMENSIONS))
    for row, ids in enumerate(texts):
        if len(ids):
            bucket = ids.astype(np.uint32) * np.uint32(2654435761) >> np.uint32(20)
            counts = np.sqrt(np.bincount(bucket, minlength=BUCKETS))
            flat[row] = counts @ _PROJECTION / np.sqrt((counts * counts).sum())
    cells = (1 / (1 + np.exp(-1.702 * flat)) * (1 << BITS)).astype(np.int64).clip(0, (1 << BITS) - 1)
    return hilbert_key(cells)


def _tokenise(path: str, end_id: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(path, None) or WordEncoder(path)
        _encoders[path] = encoder
        end = np.array([end_id], "<u2").tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = common.utf8(batch.column(1))
            for start, stop in common.slices(offsets, SLICE_BYTES):
                own = offsets[start:stop + 1] - offsets[start]
                gc.disable()  # no cycles are made here; a collection would walk all words held
                try:
                    coded = encoder.encode_joined(data[offsets[start]:offsets[stop]], own)
                finally:
                    gc.enable()
                keys = curve_keys(coded)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(coded))), batch.column(0).slice(start, stop - start),
                     pa.array(keys), pa.array([len(c) + 1 for c in coded], pa.int64()),
                     pa.array([c.tobytes() + end for c in coded], pa.binary())],
                    ["row", "doc_id", "curve_key", "n", "coded"])
                row += len(coded)

    return kernel


def cut_points(total: int, length: int) -> np.ndarray:
    """Starts of the sequences after the last full one: what is left is cut at powers of two, largest first."""
    full = total // length * length
    left, cuts = total - full, []
    while left:
        cuts.append(full)
        full += 1 << (left.bit_length() - 1)
        left -= 1 << (left.bit_length() - 1)
    return np.array([*cuts, total], np.int64)


def _cut(total: int, length: int):
    tail = cut_points(total, length)
    full = total // length

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for doc, key, n, coded, upto in zip(*[c.to_pylist() for c in batch.slice(at, 64).columns]):
                    ids = np.frombuffer(coded, "<u2").astype("<u4")
                    first = upto - n
                    cuts = np.arange(first // length * length + length, min(upto, full * length) + 1, length)
                    cuts = np.unique(np.concatenate(([first], cuts, tail[(tail > first) & (tail < upto)])))
                    cuts = cuts[cuts < upto]
                    for begin, stop in zip(cuts, [*cuts[1:], upto]):
                        if begin < full * length:
                            sequence, opened, width = begin // length, begin // length * length, length
                        else:
                            k = int(np.searchsorted(tail, begin, "right")) - 1
                            sequence, opened, width = full + k, int(tail[k]), int(tail[k + 1] - tail[k])
                        out.append((doc, begin - first, ids[begin - first:stop - first].tobytes(), n, sequence,
                                    begin - opened, width, key))
                columns = list(zip(*out)) if out else [()] * 8
                kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
                names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x if not isinstance(x, np.integer) else int(x) for x in c], t)
                     for c, t in zip(columns, kinds)], names)

    return kernel


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of ``docs`` (columns ``doc_id``, ``text``; others are ignored), as they fill sequences of ``length``:

    ``doc_id, start, ids, doc_tokens, sequence_id, offset, padded_length, curve_key``. ``ids`` are little-endian
    unsigned 32-bit numbers. A document is its text's ids and then ``end_id``; null and empty texts are ``end_id``
    alone; the tokenizer has at most 65,536 ids. Documents follow each other along the curve (ties in input order), each id once, without gaps. Full
    sequences hold ``length`` ids; what remains at the end of the corpus becomes sequences whose lengths are powers
    of two, so ``padded_length`` is what a sequence holds. Repeated rows and null ids are packed like any others; an
    empty table has no pieces.

    Tokenised once into the shared folder; the order is worked out on one short row per document, in range pieces
    with one carry row each.
    """
    coded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text")).mapInArrow(
        _tokenise(tokenizer, end_id), "row long, doc_id long, curve_key long, n long, coded binary")
    stored = store(coded, total=F.sum("n"))
    total = stored.measures["total"] or 0
    places = running_totals(stored.df.select("row", "curve_key", "n"), [], ["curve_key", "row"], {"upto": F.col("n")})
    placed = stored.df.join(places.select("row", "upto").hint("merge"), "row")
    return placed.select("doc_id", "curve_key", "n", "coded", "upto").mapInArrow(_cut(total, length), PIECE_SCHEMA)


def piece_digest() -> list[Column]:
    """Length and CRC-32 of the ids of a piece."""
    return [(F.length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32")]
