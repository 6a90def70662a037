"""Language-model scores from a probabilistic suffix tree over tokens.

The tree's states are strings of up to ``DEPTH`` tokens that precede a token. A state is kept if its share of the
corpus is large enough and the tokens after it diverge enough from those after its longest kept suffix (Ron, Singer
and Tishby, 1996). Its distribution is smoothed towards that suffix's, and a token is scored by the longest state
that stands before it. Without a state, known tokens have their discounted share, and the mass so freed belongs to
the one unknown token.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.llm import common
from meshlark.plans.lineage import Stored, exists, forget, shared_folder, store

DEPTH = 3
#: Numbers in ``SuffixTree`` of all tokens without a number of their own, and of the end.
OTHER, END = 65_534, 65_535
#: Bits that a state must save over its suffix to be kept.
LEAST_GAIN = 16.0
#: The end of a text among hashed tokens.
HASHED_END = common.mixed(np.array([0x656E64], np.uint64))[0]
#: A gram must occur so often in training to be a state or a token after a state, whatever the size of the input.
LEAST_COUNT = 2
#: Most bits, as a power of 2, of the filter that keeps most strings without a row in a table from being shuffled; what it lets through is
#: joined, so it saves work only.
FILTER_BITS = 28
#: The most frequent strings with a value, sent to all tasks; the values of all others are joined.
HEAD = 1_000_000
#: Values (strings times columns) that a counting task holds before it passes them on.
HELD = 3_000_000
#: The same for a scoring task, which merges nothing.
ASKED = 2_000_000
#: Strings that a counting task gets, about: their hashes are dealt to a number of parts that grows with the input.
PART = 500_000
#: The least number of bits that name a part. A task makes a row for each part, so small inputs have few.
LEAST_BITS = 6
#: Rows and bytes for the session to hand to Python at a time: texts, or packed parts of up to 100 kB. The JVM and Python
#: hold them.
BATCH_ROWS, BATCH_BYTES = 500, 4_000_000
_NEXT, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class SuffixTree:
    """The tree of a small alphabet in memory, by the rules that ``score_texts`` follows in tables.

    Per depth: sorted states with the log weight of their suffix's distribution, and sorted (state, next) pairs
    with log probabilities; ``root`` has the log probabilities without a state."""

    root: np.ndarray
    states: list[np.ndarray] = field(default_factory=list)
    fallback: list[np.ndarray] = field(default_factory=list)
    pairs: list[np.ndarray] = field(default_factory=list)
    log_p: list[np.ndarray] = field(default_factory=list)

    def log_probability(self, state: np.ndarray, depth: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Natural log probability of each symbol after the packed tokens ``state``, of which ``depth`` count."""
        out = np.zeros(len(symbol))
        left = np.arange(len(symbol))
        for d in range(len(self.states), 0, -1):
            states, pairs = self.states[d - 1], self.pairs[d - 1]
            if not len(states) or not len(left):
                continue
            own = suffix(state[left], d)
            at = np.minimum(np.searchsorted(states, own), len(states) - 1)
            hit = np.flatnonzero((states[at] == own) & (depth[left] >= d))
            pair = own[hit] << np.uint64(16) | symbol[left[hit]]
            where = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            exact = pairs[where] == pair
            out[left[hit]] += np.where(exact, self.log_p[d - 1][where], self.fallback[d - 1][at[hit]])
            keep = np.ones(len(left), bool)
            keep[hit[exact]] = False
            left = left[keep]
        out[left] += self.root[symbol[left].astype(np.int64)]
        return out

    def grow(self, state: np.ndarray, symbol: np.ndarray, n: np.ndarray, least_gain: float, total: dict) -> None:
        """Add the next level: counts ``n`` of tokens after states; ``total`` has how often each state occurs."""
        d = len(self.states) + 1
        order = np.lexsort((symbol, state))
        state, symbol, n = state[order], symbol[order], n[order].astype(float)
        if len(state):
            new = np.concatenate(([True], state[1:] != state[:-1]))
            first, group = np.flatnonzero(new), np.cumsum(new) - 1
            every = np.array([total[int(s)] for s in state[first]], float)
            kinds = np.diff(np.concatenate((first, [len(state)])))
            parent = np.exp(self.log_probability(suffix(state, d - 1), np.full(len(state), d - 1), symbol))
            p = (n + kinds[group] * parent) / (every + kinds)[group]
            rest = np.maximum(1 - np.add.reduceat(p, first), 1e-9) / np.maximum(1 - np.add.reduceat(parent, first), 1e-9)
            gain = np.add.reduceat(n * np.log2(p / parent), first) + (every - np.add.reduceat(n, first)) * np.log2(rest)
            kept = gain >= least_gain
            level = state[first][kept], np.log(rest[kept]), (state << np.uint64(16) | symbol)[kept[group]], np.log(p[kept[group]])
        else:
            level = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0)
        for name, values in zip(("states", "fallback", "pairs", "log_p"), level):
            getattr(self, name).append(values)


def suffix(state: np.ndarray, depth: int) -> np.ndarray:
    return state & np.uint64((1 << (16 * depth)) - 1)


def strings(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The packed ``DEPTH`` tokens before each token of the texts that begin at ``starts``, and how many of them
    count: those up to the start of the text or a token without a number of its own."""
    state, depth = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.int64)
    open_ = np.ones(len(ids), bool)
    begin = np.zeros(len(ids), bool)
    begin[starts] = True
    for k in range(1, DEPTH + 1):
        far = np.full(len(ids), OTHER, np.uint64)
        far[k:] = ids[:-k] if k < len(ids) else far[k:]
        # A text starts at this token or one of the k - 1 before it: the k-th before lies in another text.
        crossed = np.zeros(len(ids), bool)
        crossed[k - 1:] = begin[:len(ids) - k + 1]
        open_ &= ~crossed & (far < OTHER)
        state[open_] |= far[open_] << np.uint64(16 * (k - 1))
        depth[open_] = k
    return state, depth


def _grams(data: np.ndarray, offsets: np.ndarray, longest: int = DEPTH + 1) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """64-bit hashes of the strings of 1, 2, ... ``longest`` tokens that end at each token, the end of a text being
    its last; the number of tokens before it in its text; and where texts start. A string is there only if it has that
    many tokens in the text."""
    hashes, before = common.words(data, offsets)
    counts = np.diff(before)
    ids = np.full(len(hashes) + len(counts), HASHED_END)
    ids[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
    starts = np.cumsum(counts + 1) - (counts + 1)
    levels = [ids]
    for k in range(2, longest + 1):
        longer = np.zeros_like(ids)
        longer[1:] = common.mixed(levels[-1][:-1] * _NEXT + ids[1:] * _LAST + np.uint64(k))
        levels.append(longer)
    return levels, np.arange(len(ids)) - np.repeat(starts, counts + 1), starts


def _may_hold(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    at = grams >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _bits(gram: np.ndarray, bits: int, size: int) -> bytes:
    """The ``size`` bits of a filter that stand for one of ``2 ** bits`` parts of all strings."""
    held = np.zeros(size, np.uint8)
    held[(gram >> np.uint64(64 - bits - size.bit_length() + 1)) & np.uint64(size - 1)] = 1
    return np.packbits(held, bitorder="little").tobytes()


def _assembled(made: DataFrame, bits: int, size: int) -> np.ndarray:
    """The filter from its parts (columns ``part``, ``packed``)."""
    out, words = np.zeros((size << bits) // 64, np.uint64), size // 64
    table = made.select("part", "packed").toArrow()
    for k, raw in zip(table["part"].to_pylist(), table["packed"].to_pylist()):
        out[k * words:(k + 1) * words] = np.frombuffer(raw, "<u8")
    return out


#: Rows of packed columns: which table they are of, which part of its keys, and the bytes of one column after the other.
_PACKED = "side int, part long, packed binary"
#: Columns of the packed tables: strings (with the strings without their last and first token) and their counts or values.
#: Of strings that are only looked for, 32 bits after those of the part: that sets a bit too many now and then.
_SEEN = ("<u4", "u1")
_PAIRS = ("<u8", "<u8", "<u8", "<u8")
_JOINED = ("<u8", "<u8", "<u8", "<f8")
_LEVEL = ("<u8", "<u8", "<f8")
_VALUES = ("<u8", "<u8", "<f8", "<f8")
_SCORES = ("<u8", "<f8", "<f8")
_ASKED = ("<u8", "<u4", "<u4")
_ADDED = ("<u4", "<u4", "<f8", "<f8")


def _rows(sides: list[int], parts: list[int], packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(sides, pa.int32()), pa.array(parts, pa.int64()), pa.array(packed, pa.binary())],
                                      ["side", "part", "packed"])


class _Dealer:
    """Columns that a task holds for a while and passes on in parts, by the first ``bits`` bits of a key."""

    def __init__(self, bits: int, most: int = HELD):
        self.bits, self.most, self.size, self.held = bits, most, 0, {}

    def add(self, side: int, key: int, kinds: tuple, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.held.setdefault((side, key, kinds), []).append(columns)
            self.size += len(columns[0]) * len(columns)

    def full(self, made=None) -> Iterator[pa.RecordBatch]:
        if self.size > self.most:
            yield from self.out(made)

    def out(self, made=None) -> Iterator[pa.RecordBatch]:
        """All that is held; ``made`` may first shorten the columns of a table."""
        for (side, key, kinds), held in self.held.items():
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            if made is not None:
                columns = made(side, columns)
            part = (columns[key] >> np.uint64(64 - self.bits)).astype(np.uint16)
            order = np.argsort(part, kind="stable")
            if kinds == _SEEN:
                columns[0] = (columns[0] << np.uint64(self.bits)) >> np.uint64(32)
            columns = [c[order].astype(kind, copy=False) for c, kind in zip(columns, kinds)]
            edges = np.searchsorted(part[order], np.arange((1 << self.bits) + 1))
            parts = np.flatnonzero(np.diff(edges)).tolist()
            if kinds == _ASKED:
                yield _rows([side] * len(parts), parts, [_asked_bytes(*(c[edges[p]:edges[p + 1]] for c in columns), self.bits) for p in parts])
                continue
            yield _rows([side] * len(parts), parts, [b"".join(c[edges[p]:edges[p + 1]].tobytes() for c in columns) for p in parts])
        self.held, self.size = {}, 0


def _asked_width(bits: int) -> int:
    """Bytes of a hash that its part does not tell: a part of ``bits`` bits tells the first byte or none."""
    return 7 if bits >= 8 else 8


def _asked_bytes(gram: np.ndarray, task: np.ndarray, text: np.ndarray, bits: int) -> bytes:
    """Strings of one part that one task asks for: the task, the hashes without a first byte that the part tells,
    and the steps from text to text, all first bytes of them, then all second ones."""
    steps = np.diff(text, prepend=text.dtype.type(0)).astype("<u4")
    hashes = gram.view(np.uint8).reshape(-1, 8)[:, :_asked_width(bits)]
    return b"".join((task[:1].tobytes(), hashes.tobytes(), steps.view(np.uint8).reshape(-1, 4).T.tobytes()))


def _asked(held: list[bytes], part: int, bits: int) -> list[np.ndarray]:
    """What ``_asked_bytes`` packed: hashes, and tasks with texts as one number."""
    grams, rows, width = [], [], _asked_width(bits)
    for raw in held:
        n = (len(raw) - 4) // (width + 4)
        gram = np.empty((n, 8), np.uint8)
        gram[:, :width] = np.frombuffer(raw, np.uint8, width * n, 4).reshape(n, width)
        if width < 8:
            gram[:, 7] = part >> (bits - 8)
        steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 4 + width * n).reshape(4, n).T).view("<u4").ravel()
        grams.append(gram.view("<u8").ravel())
        rows.append(np.cumsum(steps, dtype=np.uint32) | np.uint64(np.frombuffer(raw, "<u4", 1)[0]) << np.uint64(32))
    return [np.concatenate(grams), np.concatenate(rows)]


def _unpacked(held: list[bytes], kinds: tuple) -> list[np.ndarray]:
    width = sum(np.dtype(k).itemsize for k in kinds)
    columns: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for raw in held:
        at, n = 0, len(raw) // width
        for column, kind in zip(columns, kinds):
            column.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(c) for c in columns]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """What is packed for one part after the other, by side, from rows in that order."""
    now, held = None, {}
    for batch in batches:
        for side, part, raw in zip(*(c.to_pylist() for c in batch.columns)):
            if part != now:
                if held:
                    yield now, held
                now, held = part, {}
            held.setdefault(side, []).append(raw)
    if held:
        yield now, held


def _by_part(frame: DataFrame, per_part, at_end, bits: int) -> DataFrame:
    """Rows of packed columns from all rows of one part at a time: ``per_part(part, packed by side, dealer)`` yields
    rows or adds to the dealer, ``at_end()`` yields rows after the task's last part."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(bits)
        for part, held in _parts(batches):
            yield from per_part(part, held, dealer)
            yield from dealer.full()
        if at_end is not None:
            yield from at_end()
        yield from dealer.out()

    return _together(frame).mapInArrow(kernel, _PACKED)


def _together(frame: DataFrame) -> DataFrame:
    """All rows of a part in one task, parts dealt in turn: by hash, some tasks got three times the parts of others."""
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.select("side", "part", "packed").repartitionById(tasks, F.col("part").cast("int") % tasks).sortWithinPartitions("part")


def _stored_apart(frame: DataFrame, *sides: int) -> list[Stored]:
    """The ``sides`` of packed rows as tables of their own, written at once."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    with _brief_shuffles(spark):
        frame.write.partitionBy("side").parquet(path)
    found = []
    for side in sides:
        own = f"{path}/side={side}"
        table = (spark.read.schema("part long, packed binary").parquet(own) if exists(spark, own)
                 else spark.createDataFrame([], "part long, packed binary"))
        found.append(Stored(table.select(F.lit(0).alias("side"), "part", "packed"), 0, own))
    return found


def _as_side(frame: DataFrame, side: int) -> DataFrame:
    return frame.select(F.lit(side).alias("side"), "part", "packed")


class _Index:
    """Where hashes are among the sorted, distinct ``grams``: those of equal first bits stand together, about one for each
    value of the bits that follow the first ``shared`` ones, which all have in common."""

    def __init__(self, grams: np.ndarray, shared: int = 0):
        self.size, self.shared, self.bits = len(grams), np.uint64(shared), len(grams).bit_length()
        self.grams = np.append(grams, ~np.uint64(0))
        starts = np.zeros((1 << self.bits) + 1, np.int32)
        np.cumsum(np.bincount(self._first(grams), minlength=1 << self.bits), out=starts[1:])
        self.starts = starts

    def _first(self, x: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(x), np.int64)
        return ((x << self.shared) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``wanted`` are there, and where."""
        at = self.starts[self._first(wanted)]
        found = self.grams[at]
        behind = np.flatnonzero(found < wanted)
        while len(behind):
            at[behind] += 1
            step = self.grams[at[behind]]
            found[behind] = step
            behind = behind[step < wanted[behind]]
        return (found == wanted) & (at < self.size), at


def _sorted(columns: list[np.ndarray], key: int = 0) -> list[np.ndarray]:
    order = np.argsort(columns[key], kind="stable")
    return [c[order] for c in columns]


def _firsts(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out():
        gram, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])

    for batch in batches:
        data, offsets = common.utf8(batch.column(0))
        for start, stop in common.slices(offsets):
            held.append(_grams(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start], 1)[0][0])
            size += len(held[-1])
            if size > HELD:
                yield out()
                size = 0
    if held:
        yield out()


def _counted(taught: DataFrame, k: int, bits: int, shorter, level: DataFrame, size: int, least_count: int) -> DataFrame:
    """One pass over the texts for strings of ``k`` tokens and of ``k - 1``, whose filter ``shorter`` is.

    Side 0: the filter of the strings of ``k`` tokens that occur twice or more (once, if ``least_count`` is 1), up to
    the longest. They are told apart by their hashes alone, and only if neither part of one token less is too rare.
    Side 1: the strings of ``k - 1`` tokens, from 2 on, that occur ``least_count`` times, dealt by their prefixes. They
    are counted where their suffixes are, whose log probabilities they get from ``level``.
    """
    def merged(side: int, columns: list[np.ndarray]) -> list[np.ndarray]:
        if side == 0:
            gram, n = np.unique(columns[0], return_counts=True)
            return [gram, np.minimum(n, 2)]
        gram, first, n = np.unique(columns[0], return_index=True, return_counts=True)
        return [gram, columns[1][first], columns[2][first], n]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(bits)
        for batch in batches:
            data, offsets = common.utf8(batch.column(0))
            for start, stop in common.slices(offsets):
                levels, place, _ = _grams(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start],
                                          min(k, DEPTH + 1))
                frequent = _may_hold(shorter.value, levels[k - 2])
                if k <= DEPTH + 1:
                    at = np.flatnonzero((place >= k - 1) & frequent)
                    dealer.add(0, 0, _SEEN, levels[k - 1][at[frequent[at - 1]]])
                if k > 2:
                    at = np.flatnonzero((place >= k - 2) & frequent)
                    dealer.add(1, 2, _PAIRS, levels[k - 2][at], levels[k - 3][at - 1], levels[k - 3][at])
                yield from dealer.full(merged)
        yield from dealer.out(merged)

    least = min(least_count, 2)

    def per_part(part, held, dealer):
        if 0 in held:
            gram, n = _sorted(_unpacked(held[0], _SEEN))
            first = _firsts(gram)
            often = gram[first][np.add.reduceat(n.astype(np.int64), first) >= least].astype(np.uint64) << np.uint64(32 - bits)
            yield _rows([0], [part], [_bits(often, bits, size)])
        if 1 in held and 2 in held:
            gram, prefix, suffix, n = _sorted(_unpacked(held[1], _PAIRS))
            known, _, log_p = _sorted(_unpacked(held[2], _LEVEL))
            first = _firsts(gram)
            total = np.add.reduceat(n, first)
            hit, at = _Index(known, bits).find(suffix[first])
            kept = hit & (total >= least_count)
            first = first[kept]
            dealer.add(1, 1, _JOINED, gram[first], prefix[first], total[kept], log_p[at[kept]])

    found = taught.mapInArrow(kernel, _PACKED)
    return _by_part(found.union(_as_side(level, 2)) if k > 2 else found, per_part, None, bits)


def _level(pairs: DataFrame, shorter: DataFrame, bits: int, least_gain: float) -> list[Stored]:
    """The strings ``pairs`` (a state and a token) with their log probabilities, and the values of the states kept and
    of their pairs.

    ``shorter`` has the strings of one token less, the states; both are dealt by the states' hashes.
    """
    def states(part, held, dealer):
        if 0 in held and 1 in held:
            gram, prefix, n, parent = _sorted(_unpacked(held[1], _JOINED), 1)
            known, counts, _ = _sorted(_unpacked(held[0], _LEVEL))
            first = _firsts(prefix)
            state = prefix[first]
            kinds = np.diff(np.append(first, len(prefix)))
            group = np.repeat(np.arange(len(first)), kinds)
            _, at = _Index(known, bits).find(state)
            every, q, n_ = counts[at].astype(float), np.exp(parent), n.astype(float)
            total, sum_q = np.add.reduceat(n_, first), np.add.reduceat(q, first)
            sum_p = (total + kinds * sum_q) / (every + kinds)
            rest = np.maximum(1 - sum_p, 1e-9) / np.maximum(1 - sum_q, 1e-9)
            p = (n_ + kinds[group] * q) / (every + kinds)[group]
            gain = np.add.reduceat(n_ * np.log2(p / q), first) + (every - total) * np.log2(rest)
            kept = gain >= least_gain
            own, log_p, fallback = kept[group], np.log(p), np.log(rest)
            dealer.add(0, 0, _LEVEL, gram, n, np.where(own, log_p, parent))
            dealer.add(1, 0, _VALUES, gram[own], n[own], (log_p - parent - fallback[group])[own], np.zeros(own.sum()))
            dealer.add(1, 0, _VALUES, state[kept], counts[at][kept], fallback[kept], np.zeros(kept.sum()))
        return ()

    return _stored_apart(_by_part(_as_side(pairs, 1).union(shorter), states, None, bits), 0, 1)


@contextmanager
def _brief_shuffles(spark):
    """Spark deletes the shuffle files of a table as soon as it is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_TEXTS = pa.schema([("text", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _score(head, seen, bits: int, floor: float, unknown: float):
    """Side 2: the texts of a task, which is the part, with the sums over their strings in ``head``. Side 0: their other
    strings that may have a value, dealt by hash."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, score, base = head.value
        index = _Index(grams)
        task, number, dealer = TaskContext.get().partitionId(), 0, _Dealer(bits, ASKED)

        for batch in batches:
            data, offsets = common.utf8(batch.column(1))
            for start, stop in common.slices(offsets):
                levels, place, starts = _grams(data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start])
                texts = stop - start
                sizes = np.diff(np.append(starts, len(place)))
                owner = np.repeat(np.arange(texts), sizes)
                known, plain, own = np.zeros(texts, np.int64), -floor * sizes, unknown * sizes
                for k, level in enumerate(levels):
                    at = np.flatnonzero((place >= k) & _may_hold(seen.value, level))
                    gram = level[at]
                    hit, where = index.find(gram)
                    where, text = where[hit], owner[at[hit]]
                    own += np.bincount(text, score[where], texts)
                    if k == 0:
                        plain += np.bincount(text, base[where], texts)
                        known += np.bincount(text, minlength=texts)
                    other = owner[at[~hit]]
                    dealer.add(0, 0, _ASKED, gram[~hit], np.full(len(other), task, np.uint32), (number + other).astype(np.uint32))
                part = batch.slice(start, texts)
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(number, number + texts)), part.column(0), part.column(2), pa.array(sizes.astype(np.int64)),
                     pa.array(known), pa.array(plain), pa.array(own)], schema=_TEXTS)
                yield _rows([2], [task], [rows.serialize().to_pybytes()])
                number += texts
                yield from dealer.full()
        yield from dealer.out()

    return kernel


def _added(asked: DataFrame, every: DataFrame, bits: int) -> DataFrame:
    """Side 0: what the strings ``asked`` add to the texts of a task, which is the part. Side 2 as it is."""

    def merged(held: list) -> tuple[np.ndarray, ...]:
        row, *sums = (np.concatenate(c) for c in zip(*held))
        row, at = np.unique(row, return_inverse=True)
        return (row, *(np.bincount(at, x, len(row)) for x in sums))

    def out(held: list):
        if not held:
            return
        row, *sums = merged(held)
        held.clear()
        task = row >> np.uint64(32)
        columns = [c.astype(kind) for c, kind in zip((row & np.uint64(0xFFFFFFFF), *sums), _ADDED)]
        first = _firsts(task)
        edges = np.append(first, len(task))
        yield _rows([0] * len(first), task[first].tolist(),
                    [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(edges, edges[1:])])

    def kernels():
        held, size = [], [0]

        def per_part(part, sides, dealer):
            if 2 in sides:
                yield _rows([2] * len(sides[2]), [part] * len(sides[2]), sides[2])
            if 0 in sides and 1 in sides:
                gram, row = _asked(sides[0], part, bits)
                known, _, score, base = _sorted(_unpacked(sides[1], _VALUES))
                hit, at = _Index(known, bits).find(gram)
                at = at[hit]
                held.append((row[hit], base[at] > 0, base[at], score[at]))
                size[0] += 4 * len(at)
                if size[0] > ASKED:
                    # Texts that many parts add to are sent on once.
                    held[:] = [merged(held)]
                    size[0] = 4 * len(held[0][0])
                    if size[0] > ASKED // 2:
                        size[0] = 0
                        yield from out(held)

        return per_part, lambda: out(held)

    return _by_part(asked.union(_as_side(every, 1)), *kernels(), bits)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of one task after the other, with all that was added to them."""
    for _, held in _parts(batches):
        rows = [pa.ipc.read_record_batch(pa.py_buffer(raw), _TEXTS) for raw in held[2]]
        table = pa.Table.from_batches(rows).sort_by("text")
        text, *more = _unpacked(held.get(0, []), _ADDED)
        for name, x in zip(("n_known", "base_score", "score"), more):
            field_ = _TEXTS.field(name)
            sums = np.bincount(text, x, table.num_rows).astype(field_.type.to_pandas_dtype())
            table = table.set_column(_TEXTS.get_field_index(name), field_, pa.array(table[name].to_numpy() + sums))
        yield from table.drop_columns(["text"]).to_batches()


def _valued(values: DataFrame, bits: int, size: int) -> DataFrame:
    """Side 0: each string with the sum of its values; 1: how many strings have which count; 2: their filter."""
    sizes: dict[int, int] = {}

    def per_part(part, held, dealer):
        gram, n, value, base = _sorted(_unpacked(held[0], _VALUES))
        first = _firsts(gram)
        most = np.maximum.reduceat(n, first)
        dealer.add(0, 0, _VALUES, gram[first], most, np.add.reduceat(value, first) / np.log(10), np.add.reduceat(base, first))
        for x, many in zip(*(y.tolist() for y in np.unique(most, return_counts=True))):
            sizes[x] = sizes.get(x, 0) + many
        yield _rows([2], [part], [_bits(gram[first], bits, size)])

    def at_end():
        if sizes:
            yield _rows([1], [0], [np.array(list(sizes), "<u8").tobytes() + np.array(list(sizes.values()), "<u8").tobytes()])

    return _by_part(values, per_part, at_end, bits)


def _head(every: DataFrame, counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``HEAD`` most frequent strings (about) with their values, sorted.

    The number of strings per count says at which count the head ends; of the strings with that count a share is
    taken by their hashes, so no task sorts or sends more than it holds of them.
    """
    sizes = counts.select("packed").toArrow()["packed"].to_pylist()
    n, many = _unpacked(sizes, ("<u8", "<u8"))
    n, at = np.unique(n, return_inverse=True)
    many = np.bincount(at, many, len(n)).astype(np.int64)[::-1]
    n = n[::-1]
    whole = int(np.searchsorted(np.cumsum(many), HEAD, "right"))
    least, some, share = (n[whole - 1] if whole else np.uint64(2**64 - 1)), None, np.uint64(0)
    if whole < len(n):
        some = n[whole]
        share = np.uint64((HEAD - int(many[:whole].sum())) / int(many[whole]) * 2**64 * 0.999)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                gram, n, value, base = _unpacked([raw], _VALUES)
                top = (n >= least) if some is None else (n >= least) | (n == some) & (gram < share)
                if top.any():
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(c[top].tobytes() for c in (gram, value, base))], pa.binary())], ["packed"])

    top = every.select("packed").mapInArrow(kernel, "packed binary").toArrow()["packed"].to_pylist()
    return tuple(_sorted(_unpacked(top, _SCORES)))


def score_texts(docs: DataFrame, held_out, least_gain: float = LEAST_GAIN, least_count: int = LEAST_COUNT) -> DataFrame:
    """One row per row of ``docs`` (columns ``doc_id``, ``text``): ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``.

    The model learns from the rows where the boolean column ``held_out`` is not true. Tokens are words (runs without
    ASCII white space, A-Z in lower case) and then the end of the text. ``base_score`` is the unigram score with one
    added to each count, ``score`` the tree's; both log10, and both count all tokens that were not in training as
    one. Null text is empty: one token. Repeated rows are learned from and scored each. Without any training row the
    end and the unknown token are equally likely.

    A state, and a token after a state, must occur ``least_count`` times, whatever the size of the input; every token
    of training counts as itself. The tree is a table per level, of strings by their 64-bit hashes, packed in parts by
    hash that meet the parts of the level before: where a string's suffix is, and then where its state is. A log probability is a sum over the strings that end at the token: the unigram's, what
    each kept state takes off for tokens it has not seen, and what a token after a state has above that. So texts are
    scored by one lookup of their strings in one table. What is sent to all tasks is bounded: the ``HEAD`` most
    frequent strings, and a filter of at most ``2 ** FILTER_BITS`` bits, by the number of tokens, that only saves
    shuffling.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"))
    taught = texts.where(~F.col("held_out")).select("text")

    is_end = F.col("gram") == int(HASHED_END.view(np.int64))
    tokens = taught.mapInArrow(_count_tokens, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    with _brief_shuffles(spark):
        tokens = store(tokens, total=F.sum("n"), distinct=F.count(F.lit(1)), ends=F.sum(F.when(is_end, F.col("n"))),
                       once=F.count(F.when(~is_end & (F.col("n") == 1), 1)),
                       twice=F.count(F.when(~is_end & (F.col("n") == 2), 1)))
    total, distinct, ends = (tokens.measures[x] or 0 for x in ("total", "distinct", "ends"))
    words = distinct - (ends > 0)
    once, twice = tokens.measures["once"], tokens.measures["twice"]
    discount = once / (once + 2 * twice) if twice else 0.5
    # Half of the mass is free where no word was learned.
    unknown, end = (max(discount * words / total, 1e-12), ends / total) if words else (0.5, 0.5)

    filter_bits = min(max(int(total).bit_length() + 2, 20), FILTER_BITS)
    bits = min(max(int(total // PART).bit_length(), LEAST_BITS), 13)
    size = 1 << (filter_bits - bits)
    hashed_end, log_unknown = int(HASHED_END.view(np.int64)), float(np.log(unknown))

    def unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(bits)
        for batch in batches:
            gram, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            log_p = np.log(np.where(gram == hashed_end, end, np.maximum((n - discount) / max(total, 1), 1e-300)))
            gram = gram.view(np.uint64)
            dealer.add(0, 0, _LEVEL, gram, n, log_p)
            dealer.add(1, 0, _VALUES, gram, n, log_p - log_unknown, np.log10(n + 1))
            yield from dealer.full()
        yield from dealer.out()

    def known(part, held, dealer):
        gram, n, _ = _unpacked(held[0], _LEVEL)
        yield _rows([0], [part], [_bits(gram[n >= least_count], bits, size)])

    level, kept = _stored_apart(tokens.df.mapInArrow(unigrams, _PACKED), 0, 1)
    forget(tokens)
    seen = spark.sparkContext.broadcast(_assembled(_by_part(level.df, known, None, bits), bits, size))
    values = [kept]
    for k in range(2, DEPTH + 3):
        # Strings of k tokens are looked for while those of k - 1 are counted.
        frequent, pairs = _stored_apart(_counted(taught, k, bits, seen, level.df, size, least_count), 0, 1)
        seen.destroy()
        if k > 2:
            if pairs.df.isEmpty():
                forget(frequent)
                break
            longer, kept = _level(pairs.df, level.df, bits, least_gain)
            forget(pairs)
            forget(level)
            level = longer
            values.append(kept)
        if k < DEPTH + 2:
            seen = spark.sparkContext.broadcast(_assembled(frequent.df, bits, size))
            forget(frequent)
    forget(level)
    every = values[0].df
    for table in values[1:]:
        every = every.union(table.df)
    every, counts, filters = _stored_apart(_valued(every, bits, size), 0, 1, 2)
    for table in values:
        forget(table)
    seen = spark.sparkContext.broadcast(_assembled(filters.df, bits, size))
    top = spark.sparkContext.broadcast(_head(every.df, counts.df))
    floor = float(np.log10(total + distinct + 1))
    asked = texts.mapInArrow(_score(top, seen, bits, floor, float(np.log10(unknown))), _PACKED)
    whole = _together(_added(asked, every.df, bits)).mapInArrow(
        _whole, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                        "base_score", "score")
