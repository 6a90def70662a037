"""Alignment of two tokenizers over a corpus: groups of tokens that cover the same bytes, and counts of linked pairs.

Documents are cut where both tokenizers must cut (a space after a character that is no white space), each distinct
piece is encoded and aligned once, and a document is the run of its pieces. Linked id pairs are counted outside
memory: a block of documents writes its pair-document records as zstd runs, one for each radix part of the first
side's id and sorted by first, then second id. Runs of a part are merged through a heap, some at a time, until one
run has the corpus-wide counts of the part; as the order puts all pairs of a first id together, its highest count is
known there. Each run is then read once more against the counts of its part, and what it adds to the numbers of its
documents goes back to their block.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.llm import common
from meshlark.plans.lineage import forget, store

#: Low bits of the first id that choose a part. The pairs of a part are bounded by the vocabularies.
RADIX_BITS = 5
#: Compressed bytes of runs that one task merges or reads back.
GROUP_BYTES = 16_000_000
#: Runs of a part that one merge takes.
FAN_IN = 64
#: Pairs in a zstd frame of a run.
FRAME = 16_384
#: Bytes of text in a block, and pieces that a Python worker remembers.
BLOCK_BYTES, REMEMBERED, LONG_PIECE = 4_000_000, 250_000, 64
_ID_BITS, _ROW_BITS = 20, 24
_ANY_SPLIT = re.compile(r"\s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?|\s+")
_ODD_SPACE = re.compile(r"\s(?: |\Z)")


# Frames: arrays of unsigned integers, bytes of equal weight together, compressed.

def _packed(array: np.ndarray, kind: str) -> bytes:
    raw = np.ascontiguousarray(array, kind)
    planes = raw.view(np.uint8).reshape(len(raw), -1).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(frame: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(frame), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _run(keys: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Frames of rising keys and their counts."""
    at = range(0, len(keys), FRAME)
    return ([_packed(np.diff(keys[i:i + FRAME], prepend=np.uint64(0)), "<u8") for i in at],
            [_packed(counts[i:i + FRAME], "<u8") for i in at])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def merged(runs: list[tuple[list[bytes], list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys in rising order with the sums of their counts, in arrays, from runs of frames.

    One frame of each run is open. The least last key of the open frames bounds what can be given out; runs whose
    next key lies above it are not touched.
    """
    opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    frames = [zip(keys, counts) for keys, counts in runs]
    firsts: list[tuple[int, int]] = []
    lasts: list[tuple[int, int]] = []

    def load(run: int) -> None:
        frame = next(frames[run], None)
        if frame is None:
            opened.pop(run, None)
            return
        keys = np.cumsum(_unpacked(frame[0], "<u8"), dtype=np.uint64)
        opened[run] = keys, _unpacked(frame[1], "<u8")
        heapq.heappush(firsts, (int(keys[0]), run))
        heapq.heappush(lasts, (int(keys[-1]), run))

    for run in range(len(runs)):
        load(run)
    while firsts:
        bound, taken, spent = lasts[0][0], [], []
        while firsts and firsts[0][0] <= bound:
            run = heapq.heappop(firsts)[1]
            keys, counts = opened[run]
            stop = int(np.searchsorted(keys, np.uint64(bound), "right"))
            taken.append((keys[:stop], counts[:stop]))
            if stop < len(keys):
                opened[run] = keys[stop:], counts[stop:]
                heapq.heappush(firsts, (int(keys[stop]), run))
            else:
                spent.append(run)
        while lasts and lasts[0][0] <= bound:
            heapq.heappop(lasts)
        for run in spent:
            load(run)
        yield _summed(*[np.concatenate(part) for part in zip(*taken)])


# Pieces: a word with what white space stands before it, encoded on both sides and aligned.

class Aligner:
    """Tokens of both tokenizers for pieces of text, and which of them cover common bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size_a = self.a.get_vocab_size()
        if max(size_a, self.b.get_piece_size()) > 1 << _ID_BITS:
            raise ValueError(f"tokenizers with more than {1 << _ID_BITS} ids")
        signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in signs} | {
            chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in signs)}
        self.bytes_a = [b""] * size_a
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        spans = [p for p in map(self.b.id_to_piece, range(self.b.get_piece_size())) if re.search("[^▁]▁", p)]
        if spans:
            raise ValueError(f"pieces of the second tokenizer reach over the start of a word: {spans[:3]}")
        self.sizes_a, self.sizes_b = np.array([len(x) for x in self.bytes_a]), np.array([len(x) for x in self.bytes_b])
        self.known: dict[str, tuple] = {}

    def _fits(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode()
        return b"".join([self.bytes_a[i] for i in a]) == raw and b"".join([self.bytes_b[i] for i in b]) == raw

    def learn(self, pieces: set[str]) -> None:
        """Align pieces, given without their first space, that are not known."""
        pieces = sorted(pieces)
        joined = [p for p in pieces if p and not p[-1].isspace()]
        for start in range(0, len(joined), 5000):
            part = joined[start:start + 5000]
            if not self._learn_joined(part):
                self._learn_apart(part)
        apart = [p for p in pieces if not p or p[-1].isspace()]
        for start in range(0, len(apart), 5000):
            self._learn_apart(apart[start:start + 5000])

    def _learn_joined(self, part: list[str]) -> bool:
        """Encode pieces that end in no white space as one text, in which both tokenizers cut between them; false if
        the tokens of a side do not spell them."""
        text = " ".join(part)
        ends = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in part), np.int64, len(part)))
        ids, numbers = [], []
        for coded, spelled, sizes in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a, self.sizes_a),
                                      (self.b.encode(text), self.bytes_b, self.sizes_b)):
            if b"".join([spelled[i] for i in coded]) != b" " + text.encode():
                return False
            coded = np.array(coded)
            stops = np.cumsum(sizes[coded])
            last = np.searchsorted(stops, ends)
            if not np.array_equal(stops[last], ends):
                return False
            ids.append(coded)
            numbers.append(np.diff(last, prepend=-1))
        self.known.update(zip(part, self._aligned(ids[0], numbers[0], ids[1], numbers[1])))
        return True

    def _learn_apart(self, part: list[str]) -> None:
        coded_a = [c.ids for c in self.a.encode_batch_fast([" " + p for p in part], add_special_tokens=False)]
        # The space that the second tokenizer adds stands for the piece's own; alone it is not added.
        coded_b = [b if p else [self.b.piece_to_id("▁")] for p, b in zip(part, self.b.encode(part, num_threads=1))]
        fits = [self._fits(" " + p, a, b) for p, a, b in zip(part, coded_a, coded_b)]
        self.known.update((p, _MISFIT) for p, fit in zip(part, fits) if not fit)
        part, coded_a, coded_b = [[x for x, fit in zip(line, fits) if fit] for line in (part, coded_a, coded_b)]
        if part:
            n_a, n_b = [np.fromiter(map(len, c), np.int64, len(c)) for c in (coded_a, coded_b)]
            a, b = [np.fromiter(chain.from_iterable(c), np.int64, int(n.sum())) for c, n in ((coded_a, n_a), (coded_b, n_b))]
            self.known.update(zip(part, self._aligned(a, n_a, b, n_b)))

    def _aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Iterator[tuple]:
        """``groups, keys, times, (n_a, n_b, n_groups, n_links), fits`` of pieces whose tokens spell them.

        The pieces are one text here: at each piece's end tokens of both sides end.
        """
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        piece = np.repeat(np.arange(len(n_a)), n_a)
        # Links: the b tokens from the one that covers a token's first byte to the one that covers its last.
        first = np.searchsorted(ends_b, ends_a - self.sizes_a[a], "right")
        width = np.searchsorted(ends_b, ends_a, "left") - first + 1
        other = np.repeat(first - np.cumsum(width) + width, width) + np.arange(width.sum())
        keys = _pair_key(np.repeat(a, width), b[other])
        linked, times = np.unique(np.repeat(piece, width) << (2 * _ID_BITS) | keys, return_counts=True)
        links = np.bincount(np.repeat(piece, width), minlength=len(n_a))
        at = (8 * np.searchsorted(linked >> (2 * _ID_BITS), np.arange(len(n_a) + 1))).tolist()
        keys, times = (linked & ((1 << 2 * _ID_BITS) - 1)).astype(np.uint64).tobytes(), times.astype(np.uint64).tobytes()
        # Groups: tokens by the common end that closes them, side a before side b, and what follows each.
        common_ends = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        group_a, group_b = np.searchsorted(common_ends, ends_a), np.searchsorted(common_ends, ends_b)
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        mark_b = np.where(last_b, 2, 0)  # after a token: , | ; or the end of a piece
        mark_b[np.cumsum(n_b) - 1] = 3
        code = np.concatenate((4 * a + np.where(last_a, 1, 0), 4 * b + mark_b))[order]
        texts = "".join([f"{c >> 2}{_MARKS[c & 3]}" for c in code.tolist()]).split("\n")
        groups = np.bincount(piece, np.isin(ends_a, common_ends, assume_unique=True), len(n_a)).astype(np.int64)
        numbers = np.stack((n_a, n_b, groups, links), 1).tolist()
        for n, (text, line) in enumerate(zip(texts, numbers)):
            yield text, keys[at[n]:at[n + 1]], times[at[n]:at[n + 1]], line, True


_MARKS = (",", "|", ";", "\n")
_MISFIT = ("", b"", b"", [0, 0, 0, 0], False)


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Key of an id pair: the radix part of ``a``, the rest of ``a``, ``b``."""
    return ((a & ((1 << RADIX_BITS) - 1)) << (_ID_BITS - RADIX_BITS) | a >> RADIX_BITS) << _ID_BITS | b


def pair_ids(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of pair keys."""
    side = keys >> np.uint64(_ID_BITS)
    high = side & np.uint64((1 << (_ID_BITS - RADIX_BITS)) - 1)
    return (high << np.uint64(RADIX_BITS)) | (side >> np.uint64(_ID_BITS - RADIX_BITS)), keys & np.uint64((1 << _ID_BITS) - 1)


def pieces_of(text: str) -> list[str]:
    """Pieces of space + ``text``, each without its first space."""
    if _ODD_SPACE.search(" " + text) is None:
        return text.split(" ")
    return [p[1:] for p in _ANY_SPLIT.findall(" " + text)]


_aligners: dict[tuple[str, str], Aligner] = {}

BLOCK_SCHEMA = ("block long, part int, doc_id long, place int, n_a long, n_b long, n_groups long, n_links long, groups string, "
                "keys array<binary>, counts array<binary>, rows binary, times binary")
_ARROW = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int32()), ("n_a", pa.int64()),
                    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
                    ("keys", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary())), ("rows", pa.binary()),
                    ("times", pa.binary())])


def _filled(size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _ARROW], schema=_ARROW)


def _blocks(path_a: str, path_b: str, digest: bool):
    """Kernel from texts to the rows of their blocks: one for each document, one run for each part."""

    def block(aligner: Aligner, number: int, ids: pa.Array, texts: list[str]) -> Iterator[pa.RecordBatch]:
        known = aligner.known
        split = [pieces_of(t) if t else [] for t in texts]
        distinct = set().union(*split)
        new = distinct.difference(known)
        aligner.learn(new)
        index = {p: n for n, p in enumerate(distinct)}
        entries = [known[p] for p in index]
        if len(known) > REMEMBERED:  # the pieces seen first hold the frequent ones; these go
            for piece in new:
                del known[piece]
        else:
            for piece in new:
                if len(piece) > LONG_PIECE:
                    del known[piece]
        at = [np.fromiter(map(index.__getitem__, s), np.int64, len(s)) for s in split]
        fits = np.array([e[4] for e in entries], bool)
        whole = [bool(len(x)) and bool(fits[x].all()) for x in at]
        numbers = np.array([e[3] for e in entries], np.int64).reshape(-1, 4)
        totals = np.array([numbers[x].sum(0) if w else (0, 0, 0, 0) for x, w in zip(at, whole)], np.int64).reshape(-1, 4)
        spelled = [e[0] for e in entries]
        groups = [";".join([spelled[i] for i in x.tolist()]) if w else "" for x, w in zip(at, whole)]
        if digest:
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        yield _filled(len(texts), block=np.full(len(texts), number), doc_id=ids, place=np.arange(len(texts)), groups=groups,
                      n_a=totals[:, 0], n_b=totals[:, 1], n_groups=totals[:, 2], n_links=totals[:, 3])

        held = np.concatenate([np.zeros(0, np.int64), *[x for x, w in zip(at, whole) if w]])
        row = np.repeat(np.flatnonzero(whole), [len(x) for x, w in zip(at, whole) if w])
        if not len(held):
            return
        pair, often = np.unique(row * len(entries) + held, return_counts=True)
        row, held = pair // len(entries), pair % len(entries)
        sizes = np.array([len(e[1]) // 8 for e in entries], np.int64)
        keys = np.frombuffer(b"".join([e[1] for e in entries]), np.uint64)
        times = np.frombuffer(b"".join([e[2] for e in entries]), np.uint64)
        n = sizes[held]
        source = np.repeat((np.cumsum(sizes) - sizes)[held] - np.cumsum(n) + n, n) + np.arange(n.sum())
        record, times = _summed(keys[source] << np.uint64(_ROW_BITS) | np.repeat(row, n).astype(np.uint64),
                                times[source] * np.repeat(often, n).astype(np.uint64))
        key, row = record >> np.uint64(_ROW_BITS), record & np.uint64((1 << _ROW_BITS) - 1)
        part = (key >> np.uint64(2 * _ID_BITS - RADIX_BITS)).astype(np.int64)
        cuts = np.searchsorted(part, np.arange((1 << RADIX_BITS) + 1))
        for p, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if i < j:
                own, counts = np.unique(key[i:j], return_counts=True)
                frames = _run(own, counts)
                yield _filled(1, block=[number], part=[p], keys=[frames[0]], counts=[frames[1]],
                              rows=[_packed(row[i:j], "<u4")], times=[_packed(times[i:j], "<u8")])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path_a, path_b) not in _aligners:
            _aligners[path_a, path_b] = Aligner(path_a, path_b)
        aligner = _aligners[path_a, path_b]
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = common.utf8(batch.column(1))
            for start, stop in common.slices(offsets, BLOCK_BYTES):
                yield from block(aligner, number, batch.column(0).slice(start, stop - start),
                                 batch.column(1).slice(start, stop - start).to_pylist())
                number += 1

    return kernel


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    runs = list(zip(table.column("keys").to_pylist(), table.column("counts").to_pylist()))
    keys, counts = [], []
    for k, c in merged(runs):
        frames = _run(k, c)
        keys += frames[0]
        counts += frames[1]
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "salt": pa.array([key[1].as_py()], pa.int64()),
                     "keys": pa.array([keys], pa.list_(pa.binary())), "counts": pa.array([counts], pa.list_(pa.binary()))})


def _decoded(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([np.cumsum(_unpacked(f, "<u8"), dtype=np.uint64) for f in keys]),
            np.concatenate([_unpacked(f, "<u8") for f in counts]))


def _highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each pair, whether no pair of its first id has a higher count."""
    side = keys >> np.uint64(_ID_BITS)
    first = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
    top = np.maximum.reduceat(counts, first)
    return counts == np.repeat(top, np.diff(np.append(first, len(keys))))


def _contributions(key: tuple, runs: pa.Table, totals: pa.Table) -> pa.Table:
    """What each run adds to the documents of its block: sum of counts, links of highest count."""
    blocks, sums, bests = [], [], []
    if runs.num_rows:
        keys, counts = _decoded(totals.column("keys")[0].as_py(), totals.column("counts")[0].as_py())
        best = _highest(keys, counts)
        for r in range(runs.num_rows):
            own, per_key = _decoded(runs.column("keys")[r].as_py(), runs.column("counts")[r].as_py())
            at = np.repeat(np.searchsorted(keys, own), per_key.astype(np.int64))
            row = _unpacked(runs.column("rows")[r].as_py(), "<u4").astype(np.int64)
            times = _unpacked(runs.column("times")[r].as_py(), "<u8")
            added, links = np.zeros(int(row.max()) + 1, np.uint64), np.zeros(int(row.max()) + 1, np.uint64)
            np.add.at(added, row, times * counts[at])
            np.add.at(links, row, times * best[at].astype(np.uint64))
            blocks.append(runs.column("block")[r].as_py())
            sums.append(_packed(added, "<u8"))
            bests.append(_packed(links, "<u8"))
    return pa.table({"block": pa.array(blocks, pa.int64()), "sums": pa.array(sums, pa.binary()),
                     "bests": pa.array(bests, pa.binary())})


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _returned(key: tuple, docs: pa.Table, added: pa.Table) -> pa.Table:
    """The documents of a block with the sums of all that the runs of the block add."""
    place = docs.column("place").to_numpy()
    total = np.zeros((2, int(place.max()) + 1), np.uint64)
    for sums, bests in zip(added.column("sums").to_pylist(), added.column("bests").to_pylist()):
        for line, frame in zip(total, (sums, bests)):
            part = _unpacked(frame, "<u8")
            line[:len(part)] += part
    return pa.table({"doc_id": docs.column("doc_id"), **{n: docs.column(n) for n in _NUMBERS},
                     "n_best": pa.array(total[1][place].astype(np.int64)),
                     "count_sum": pa.array(total[0][place].astype(np.int64)), "groups": docs.column("groups")})


RUN_SCHEMA = "part int, salt long, keys array<binary>, counts array<binary>"


def _salt(salts: int):
    return F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt")


def _counted(runs: DataFrame, salts: int) -> DataFrame:
    """One run of corpus-wide counts for each part: merges of at most ``FAN_IN`` merged runs, written in between."""
    found = store(runs.select("part", _salt(salts), "keys", "counts").groupBy("part", "salt").applyInArrow(_merge, RUN_SCHEMA))
    while salts > 1:
        salts = -(-salts // FAN_IN)
        again = found.df.withColumn("salt", F.pmod("salt", F.lit(salts))).groupBy("part", "salt")
        newer = store(again.applyInArrow(_merge, RUN_SCHEMA))
        forget(found)
        found = newer
    return found.df


def _spilled(docs: DataFrame, path_a: str, path_b: str, digest: bool) -> tuple[DataFrame, DataFrame, int]:
    """The blocks' documents, their runs, and how many groups the runs of a part need."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    blocks = store(texts.mapInArrow(_blocks(path_a, path_b, digest), BLOCK_SCHEMA)).df
    runs = blocks.where("part IS NOT NULL").select("block", "part", "keys", "counts", "rows", "times")
    # At most as many rows as parts, whose number is fixed.
    weight = F.length("rows") + F.length("times") + F.expr("aggregate(keys, 0, (n, k) -> n + length(k))")
    heaviest = runs.groupBy("part").agg(F.sum(weight).alias("bytes")).agg(F.max("bytes")).first()[0] or 0
    return (blocks.where("part IS NULL").select("block", "doc_id", "place", *_NUMBERS, "groups"), runs,
            max(1, -(-heaviest // GROUP_BYTES)))


def align(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """One row for each document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    Space + ``text`` is encoded by the byte-level tokenizer at ``path_a``, ``text`` by the sentencepiece model at
    ``path_b``, which adds the space itself; strings of special tokens are plain text. ``groups`` has the ids between
    byte offsets where tokens of both end, as ``a1,a2|b1;a3|b2``, or its SHA-256 with ``digest``. Links are the pairs of
    token occurrences whose byte ranges overlap; a pair's count is the number of documents that hold it linked;
    ``n_best`` counts the links whose pair has the highest count of its first id (ties included), ``count_sum`` sums
    the counts over the links.

    A null or empty text, and one that a side's tokens do not spell byte by byte, has zeros and empty ``groups``.
    Repeated rows, also with one id, are documents each; a null id stays null. Other columns are not read. A very long
    text is a block of its own. An empty table gives no rows.

    Records are summed in their block before anything is shuffled, so a pair that every document holds is one entry
    of each run. Runs are dealt by part and a hash of their block into groups of about ``GROUP_BYTES``.
    """
    rows, runs, salts = _spilled(docs, path_a, path_b, digest)
    counts = _counted(runs, salts)
    each = counts.select("part", "keys", "counts").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    salted = runs.withColumn("salt", _salt(salts))
    added = store(salted.groupBy("part", "salt").cogroup(each.groupBy("part", "salt")).applyInArrow(
        _contributions, "block long, sums binary, bests binary")).df
    numbers = ", ".join(f"{n} long" for n in _NUMBERS)
    return rows.groupBy("block").cogroup(added.groupBy("block")).applyInArrow(
        _returned, f"doc_id long, {numbers}, n_best long, count_sum long, groups string")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for frames in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys, counts = _decoded(*frames)
            best = _highest(keys, counts)
            a, b = pair_ids(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(counts.astype(np.int64)), pa.array(best)],
                ["a_id", "b_id", "n_docs", "is_best"])


def linked_pairs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``a_id, b_id, n_docs, is_best``: every id pair that is linked anywhere, with its count; see ``align``."""
    _, runs, salts = _spilled(docs, path_a, path_b, True)
    return _counted(runs, salts).select("keys", "counts").mapInArrow(_listed, "a_id long, b_id long, n_docs long, is_best boolean")
