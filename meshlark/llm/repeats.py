"""Maximal repeats of long byte strings, across and within documents, and their removal.

Every string of ``length`` bytes has one anchor: its least 64-byte gram by hash. Equal strings have equal anchors at
equal places, so all that repeat meet at the gram of their anchor. There the texts around the anchor are sorted, which
makes an enhanced suffix array of the suffixes that begin at it; a stack scan over the common prefixes yields the
interval tree, and inside each interval the same scan over what stands to the left finds the groups that cannot be
extended to either side with all their occurrences (Abouelhoda, Kurtz and Ohlebusch, 2004).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.llm import common
from meshlark.plans.lineage import store

GRAM = 64
#: Grams with more different surroundings than this are not compared in one task, but split by what stands around them.
LARGE_GROUP = 512
_ANCHORS = "doc long, text_hash long, gram long, around long, low int, high int, at int"
_NO_ID = -(1 << 63)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbouring values, from running minima inside blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of ``length`` bytes: row, gram hash, hash of all the strings that share the anchor,
    first and last start of these strings, and place of the anchor, the last three within the text."""
    width = length - GRAM + 1
    sizes = np.diff(offsets)
    if not (sizes >= length).any():
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums = common.prefix_hash(data)
    place = np.arange(len(data) - GRAM + 1)
    gram = common.mixed(common.ranges_hash(sums, place, place + GRAM))
    bits = np.uint64(len(gram).bit_length())
    least = sliding_least((gram >> bits) << bits | place.astype(np.uint64), width)
    row = np.repeat(np.arange(len(sizes)), sizes)
    start = np.flatnonzero(row[:len(least)] == row[length - 1:length - 1 + len(least)])
    at = (least[start] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (row[start[1:]] != row[start[:-1]])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(start)])) - 1
    low, high, at = start[first], start[last], at[first]
    around = common.ranges_hash(sums, low, high + length)
    around = common.mixed(around + common.mixed((at - low).astype(np.uint64) << np.uint64(32) | (high - low).astype(np.uint64)))
    own = row[low]
    return own, gram[at], around, low - offsets[own], high - offsets[own], at - offsets[own]


def _anchors(length: int):
    def per_slice(batch, data, offsets):
        row, gram, around, low, high, at = anchors_of(data, offsets, length)
        take = pa.array(row)
        small = [pa.array(x.astype(np.int32)) for x in (low, high, at)]
        hashes = [pa.array(x.astype(np.uint64).view(np.int64)) for x in (gram, around)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), *hashes, *small],
            ["doc", "text_hash", "gram", "around", "low", "high", "at"])

    return common.text_kernel(per_slice)


def _surroundings(length: int):
    """The bytes around each requested anchor of a text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                out = []
                for text, asked in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    raw = text.encode()
                    out += [(a["gram"], a["around"], a["n"], a["at"] - a["low"], raw[a["low"]:a["high"] + length]) for a in asked]
                columns = list(zip(*out)) if out else [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["gram", "around", "n", "before", "bytes"])

    return kernel


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def intervals(strings: list[bytes]) -> tuple[list[int], list[tuple[int, int, int, list[int]]]]:
    """Order of ``strings`` and the interval tree of their common prefixes: ``(length, first, last, cuts)``, with
    ``cuts`` where the children part, by one scan with a stack."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    shared = [common_length(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    nodes, stack = [], [(-1, 0, [])]
    for i, h in enumerate([*shared, -1], 1):
        first = i - 1
        while stack[-1][0] > h:
            length, first, cuts = stack.pop()
            nodes.append((length, first, i - 1, cuts))
        if h >= 0:
            if stack[-1][0] < h:
                stack.append((h, first, []))
            stack[-1][2].append(i)
    return order, nodes


def maximal_groups(before: list[bytes], after: list[bytes], length: int) -> list[tuple[int, int, list[int]]]:
    """Maximal repeats of ``length`` bytes or more through one anchor: ``(left, right, members)``.

    ``before`` holds what stands before the anchor, reversed; ``after`` what begins at it. A group's members share
    ``left`` bytes before and ``right`` bytes from the anchor on, and neither can be extended for all of them.
    """
    found = []
    order, nodes = intervals(after)
    for right, first, last, cuts in nodes:
        members = order[first:last + 1]
        child = np.searchsorted(cuts, np.arange(first, last + 1), "right")
        own_order, own_nodes = intervals([before[m] for m in members])
        for left, a, b, _ in own_nodes:
            inside = own_order[a:b + 1]
            # Diverse to the right as well: members of several children of this interval.
            if left + right >= length and len({int(child[i]) for i in inside}) > 1:
                found.append((left, right, [members[i] for i in inside]))
    return found


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """Rows of one gram after the other, from batches in that order; repeated rows once."""
    gram, rows = None, {}
    for batch in batches:
        for g, around, n, left, raw in zip(*[c.to_pylist() for c in batch.columns]):
            if g != gram:
                if len(rows) > 1:
                    yield gram, list(rows.values())
                gram, rows = g, {}
            rows[around] = (around, n, left, raw)
    if len(rows) > 1:
        yield gram, list(rows.values())


def _repeats(length: int, covers_only: bool):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch():
            columns = list(zip(*out))
            out.clear()
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["gram", "around", "number", "left", "right"])

        for gram, rows in _groups(batches):
            before = [raw[:left][::-1] for _, _, left, raw in rows]
            after = [raw[left:] for _, _, left, raw in rows]
            reach: dict[int, tuple[int, int]] = {}
            for number, (left, right, members) in enumerate(maximal_groups(before, after, length)):
                for m in members:
                    if covers_only:
                        old = reach.get(m, (0, 0))
                        reach[m] = max(left, old[0]), max(right, old[1])
                    else:
                        out.append((gram, rows[m][0], number, left, right))
            # All strings of an anchor hold it, so what they cover is one stretch.
            out += [(gram, rows[m][0], 0, *r) for m, r in reach.items() if rows[m][1] == 1]
            if len(out) > 20_000:
                yield batch()
        if out:
            yield batch()

    return kernel


def _strings(length: int):
    """A row for each string of ``length`` bytes of each surrounding."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                raw = part.column(4).to_pylist()
                sizes = np.array([len(r) for r in raw])
                sums = common.prefix_hash(np.frombuffer(b"".join(raw), np.uint8))
                offset = np.cumsum(sizes) - sizes
                count = sizes - length + 1
                row = np.repeat(np.arange(len(raw)), count)
                start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = offset[row] + start
                hashes = common.mixed(common.ranges_hash(sums, at, at + length))
                take = pa.array(row)
                before = part.column(3).to_numpy(zero_copy_only=False)[row]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), part.column(2).take(take),
                     pa.array(hashes.view(np.int64)), pa.array((before - start).astype(np.int32))],
                    ["gram", "around", "n", "string", "left"])

    return kernel


def _halves(length: int):
    """Two rows for each row of a class, which stands for the strings with ``low`` to ``high`` bytes before the anchor:
    one for those with fewer, one for those with more. ``core`` names the class by the bytes that all these strings
    hold, ``kind`` the bytes of those that are there, from ``before`` bytes before the anchor on."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                low, high, before = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4))
                raw = part.column(5).to_pylist()
                data, sizes = b"".join(raw), np.array([len(r) for r in raw])
                sums = common.prefix_hash(np.frombuffer(data, np.uint8))
                anchor = np.cumsum(sizes) - sizes + before
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    least, most = np.maximum(a, before - (sizes - length)), np.minimum(b, before)
                    row = np.flatnonzero(least <= most)
                    at, a, b, least, most = (x[row] for x in (anchor, a, b, least, most))
                    names = []
                    for few, many, start, stop in ((a, b, at - a, at + length - b), (least, most, at - most, at + length - least)):
                        place = common.mixed(few.astype(np.uint64) << np.uint64(32) | many.astype(np.uint64))
                        names.append(pa.array(common.mixed(common.ranges_hash(sums, start, stop) + place).view(np.int64)))
                    held = [data[x:y] for x, y in zip((at - most).tolist(), (at + length - least).tolist())]
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), part.column(1).take(take), *names,
                         *[pa.array(x.astype(np.int32)) for x in (a, b, most)], pa.array(held, pa.binary())],
                        ["gram", "around", "core", "kind", "low", "high", "before", "bytes"])

    return kernel


def _crowded(large: DataFrame, crowded: int, length: int) -> DataFrame:
    """``gram, around, left, right``: what repeats of the surroundings of ``crowded`` grams with very many kinds, over and over
    split into classes of strings that hold the same bytes.

    Surroundings that agree in all strings of a class repeat there, and one of them goes on for all. Classes of up to
    ``LARGE_GROUP`` kinds are compared in one task, the others are split again, at last into single strings, which are
    of one kind.
    """
    repeat = "gram long, around long, number int, left int, right int"
    split = "gram long, around long, core long, kind long, low int, high int, before int, bytes binary"
    found = large.select("gram", "around", F.lit(0).alias("left"), F.lit(0).alias("right")).limit(0)
    now = large.select("gram", "around", F.lit(0).alias("low"), F.lit(length - GRAM).alias("high"), "before", "bytes")
    while crowded:
        rows = store(now.mapInArrow(_halves(length), split)).df
        one = F.min(F.struct("gram", "around", "low", "high", "before", "bytes")).alias("one")
        kinds = rows.groupBy("core", "kind").agg(F.count(F.lit(1)).alias("n"), one)
        cores = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"))
        many = F.col("kinds") > LARGE_GROUP
        stored = store(kinds.join(cores.hint("merge"), "core"), crowded=F.count(F.when(many, 1)))
        kinds, crowded = stored.df, stored.measures["crowded"]
        ends = rows.select("core", "kind", "gram", "around", F.col("before").alias("left"), (F.length("bytes") - F.col("before")).alias("right"))
        whole = ends.join(kinds.where("n > 1").select("core", "kind").hint("merge"), ["core", "kind"])
        small = kinds.where((F.col("kinds") > 1) & ~many)
        reach = small.select(F.col("core").alias("gram"), F.col("kind").alias("around"), "n", "one.before", "one.bytes").repartition(
            "gram").sortWithinPartitions("gram").mapInArrow(_repeats(length, True), repeat)
        reach = reach.select(F.col("gram").alias("core"), F.col("around").alias("kind"), "left", "right").join(
            small.select("core", "kind", "one.gram", "one.around").hint("merge"), ["core", "kind"])
        found = found.union(whole.select("gram", "around", "left", "right")).union(reach.select("gram", "around", "left", "right"))
        now = kinds.where(many).select("one.*")
    return found


class _Plan:
    """The steps that removal and listing share."""

    def __init__(self, docs: DataFrame, length: int):
        if length <= GRAM:
            raise ValueError(f"length must exceed {GRAM}")
        self.length = length
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text")).withColumns(
            {"doc": F.coalesce("doc_id", F.lit(_NO_ID)), "text_hash": F.xxhash64("text")})
        found = self.docs.select("doc", "text_hash", "text").mapInArrow(_anchors(length), _ANCHORS)
        self.anchors = store(found).df
        one = F.struct("doc", "text_hash", "low", "high", "at")
        self.classes = store(self.anchors.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one"))).df
        grams = self.classes.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        several = self.classes.join(grams.hint("merge"), "gram")
        asked = several.groupBy("one.doc", "one.text_hash").agg(
            F.collect_list(F.struct("gram", "around", "n", "one.low", "one.high", "one.at", "kinds")).alias("asked"))
        self.asked = asked
        texts = self.docs.join(asked.hint("merge"), ["doc", "text_hash"])
        small = F.filter("asked", lambda a: a["kinds"] <= LARGE_GROUP)
        large = F.filter("asked", lambda a: a["kinds"] > LARGE_GROUP)
        schema = "gram long, around long, n long, before int, bytes binary"
        # Written once: the joined texts feed both ways of comparing.
        near = store(texts.select("text", F.concat(small, large).alias("asked")).mapInArrow(_surroundings(length), schema)).df
        crowded = store(grams.where(F.col("kinds") > LARGE_GROUP).select("gram"))
        self.crowded = crowded.rows
        self.small = near.join(crowded.df, "gram", "left_anti")
        self.large = near.join(crowded.df, "gram", "left_semi").dropDuplicates(["gram", "around"])


def _stretches(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Documents with keys, and the stretches of each that repeat: ``doc, text_hash, low, high``."""
    plan = _Plan(docs, length)
    whole = plan.classes.where("n > 1").select("gram", "around")
    copied = plan.anchors.join(whole.hint("merge"), ["gram", "around"]).select(
        "doc", "text_hash", "low", (F.col("high") + length).alias("high"))
    grouped = plan.small.repartition("gram").sortWithinPartitions("gram")
    reach = grouped.mapInArrow(_repeats(length, True), "gram long, around long, number int, left int, right int")
    reach = reach.select("gram", "around", "left", "right")
    # All strings of an anchor hold it, so what they cover is one stretch.
    crowded = _crowded(plan.large, plan.crowded, length).groupBy("gram", "around").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    single = plan.classes.where("n = 1").select("gram", "around", "one")
    partly = reach.union(crowded).join(single.hint("merge"), ["gram", "around"]).select(
        "one.doc", "one.text_hash", (F.col("one.at") - F.col("left")).alias("low"), (F.col("one.at") + F.col("right")).alias("high"))
    return plan.docs, copied.union(partly)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 200):
            part = batch.slice(begin, 200)
            sizes, spans, kept = [], [], []
            for text, packed in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                raw = text.encode()
                own: list[list[int]] = []
                for low, high in sorted((p >> 32, p & 0xFFFFFFFF) for p in packed or ()):
                    if own and low <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], high)
                    else:
                        own.append([low, high])
                edges = [0, *[x for span in own for x in span], len(raw)]
                sizes.append(len(raw))
                spans.append([{"start": a, "stop": b} for a, b in own])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for each row of ``docs`` (columns ``doc_id``, ``text``): the size of the UTF-8
    text, the maximal runs of bytes (``start``, ``stop``) covered by strings of ``length`` bytes that also begin
    anywhere else in the table, and what remains.

    Strings are judged on the input. Null text is empty, and has no spans, as any text shorter than ``length``. A
    repeated row repeats all its strings. Rows without an id are told apart by their texts. ``length`` must exceed
    the gram's 64 bytes. An empty table gives no rows.

    What moves between tasks is one short row per anchor (about one in ``length / 2.4`` bytes), and the surroundings
    of one anchor of each kind where several kinds meet. Equal surroundings are counted by partial aggregation, so a
    passage of a third of all documents is no more than a few rows. Grams with very many kinds are split into two
    classes, by how much of a string stands before the anchor, and these again, by the bytes that all strings of a
    class hold: at most two rows per kind in a round, and none for kinds that share these bytes with no other.
    Strings are told apart by 64-bit hashes in the counts, by bytes in the tree.
    """
    named, stretches = _stretches(docs, length)
    packed = (F.col("low").cast("long") * (1 << 32) + F.col("high")).alias("p")
    spans = stretches.select("doc", "text_hash", packed).groupBy("doc", "text_hash").agg(F.collect_set("p").alias("spans"))
    return named.join(spans.hint("merge"), ["doc", "text_hash"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")


def maximal_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``gram, number, n_bytes, doc_id, start``: all occurrences of every maximal repeat of ``length`` bytes or more.

    ``gram`` and ``number`` name the repeat. An occurrence is listed in every document that holds it. A repeat is
    followed as far as the strings of one anchor reach (below twice ``length``); a longer one is listed as overlapping
    repeats, one at each anchor. Grams with more than ``LARGE_GROUP`` kinds of surroundings are listed by strings of
    exactly ``length`` bytes, ``number`` being -1 - the string's place before the anchor.
    """
    plan = _Plan(docs, length)
    schema = "gram long, around long, number int, left int, right int"
    found = plan.small.repartition("gram").sortWithinPartitions("gram").mapInArrow(_repeats(length, False), schema)
    strings = plan.large.mapInArrow(_strings(length), "gram long, around long, n long, string long, left int")
    again = strings.groupBy("string").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("string")
    listed = strings.join(again.hint("merge"), "string").select(
        F.col("string").alias("gram"), "around", (-1 - F.col("left")).alias("number"), "left",
        (F.lit(length) - F.col("left")).cast("int").alias("right"))
    alone = plan.classes.where("n > 1").select(
        "gram", "around", F.lit(1 << 30).alias("number"), (F.col("one.at") - F.col("one.low")).alias("left"),
        (F.col("one.high") + length - F.col("one.at")).alias("right"))
    # Surroundings that recur as a whole are a repeat of their own, unless a group already lists them.
    groups = found.union(listed).union(alone)
    return groups.withColumnRenamed("gram", "repeat").join(
        plan.anchors.hint("merge"), "around").select(
        F.col("repeat").alias("gram"), "number", (F.col("left") + F.col("right")).alias("n_bytes"),
        F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), (F.col("at") - F.col("left")).alias("start"))
