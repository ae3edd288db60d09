"""Packing over the histogram of lengths, the pack with most room first.

Documents become token ids once, in tasks, and are cut to pieces of at most ``capacity`` ids; pieces are written with their
rank among equal lengths of their task. The histogram of lengths has at most ``capacity`` rows, whatever the table's size,
and is all that is planned over: lengths are placed longest first, each into the packing pattern that has most room, for as
many packs of that pattern as there are pieces left; where none has room, new packs open. What comes out is patterns with
counts, and from them ranges of ranks: the pieces of one length with ranks a to b lie at that offset of packs p to q. Each
piece finds its range by its rank, so the patterns meet the documents without a shuffle of texts or ids.

Packs with more room than ``slack`` are dissolved: their pieces are laid end to end, cut at every ``capacity`` ids, and the
tail at powers of two, which need no padding. So padding is at most slack / capacity, whatever the lengths are.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxlake.llm.bpe import WordBpe, byte_letters
from boxlake.llm.common import text_slices, vocabulary
from boxlake.session import Scratch, size_bytes, written

LEAF = pa.schema([("part", pa.int32()), ("rank", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])
LEAF_SQL = "part int, rank long, doc_id long, start long, length int, doc_tokens long, crc long, ids binary"
PLACED = "part int, rank long, length int, doc_id long, start long, cut long, size long, crc long, doc_tokens long, sequence_id long, offset long"
#: Ranks of one length stay below this; a length stands above it in the keys of ranges.
RANKS = 1 << 48
#: Most chunks a task remembers, some 100 bytes each; then it starts anew.
CACHE = 600_000
#: Broadcast the first ranks of tasks up to this size; beyond it, they meet the pieces by a shuffle.
BROADCAST_BYTES = 32 << 20


class IdCoder(dict):
    """Little-endian ids of texts under a word-end vocabulary; chunks between white space are remembered, up to ``CACHE``.

    New chunks are encoded all at once by tiktoken: a line feed, which no word holds, stands for the end of a word, and a
    byte before it merges with it first, which gives the vocabulary's word-final letters. Each token comes of one merge, so
    merging by the rank of what is made is merging by the rank of the pair. A lone line feed ends a chunk.
    """

    def __init__(self, data: bytes) -> None:
        super().__init__()
        self.bpe = WordBpe(data)
        spec = json.loads(data)["model"]
        byte = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        end = spec["end_of_word_suffix"]

        def spelled(token: str) -> bytes:
            return b"".join([byte[c] for c in token.removesuffix(end)]) + (b"\n" if token.endswith(end) else b"")

        made = [spelled("".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["merges"]]
        letters = [bytes([b]) for b in range(256)] + [bytes([b, 10]) for b in range(256) if b != 10]
        ranks = {t: r for r, t in enumerate([*letters, *made])}
        ids = {spelled(t): i for t, i in self.bpe.vocab.items()}
        self.ids = np.array([ids.get(t, 0) for t in ranks], "<u4")
        self.words = tiktoken.Encoding("word ends", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.update((i, np.array([i], "<u4").tobytes()) for i in self.bpe.special.values())

    def learn(self, chunks: set[str]) -> None:
        known = list(chunks)
        text = "\n".join([*known, ""])
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        found = self.words.encode_to_numpy(self.bpe.words.sub(r"\g<0>\n", text.lower()))
        cuts = np.flatnonzero(found == 10)
        data = self.ids[found].tobytes()
        ends = (4 * cuts).tolist()
        self.update((c, data[a:b]) for c, a, b in zip(known, [0, *(e + 4 for e in ends)], ends, strict=False))

    def rows(self, texts: list[str | None]) -> list[bytes]:
        split = [self.bpe.split(t) if any(s in t for s in self.bpe.special) else self.bpe._chunks(t) for t in (x or "" for x in texts)]
        new = set().union(*split).difference(self)
        if len(self) + len(new) > CACHE:
            self._forget()
            new = set().union(*split).difference(self)
        if new:
            self.learn(new)
        return [b"".join(map(self.__getitem__, s)) for s in split]


def _leaf(data: bytes, capacity: int, eot: int):
    end = np.array([eot], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = IdCoder(data), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in text_slices(batches):
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), coder.rows(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                for a in range(0, n, capacity):
                    own = ids[4 * a : 4 * (a + capacity)]
                    k = len(own) // 4
                    rows.append((part, seen[k], doc, a, k, n, zlib.crc32(own), own))
                    seen[k] += 1
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, LEAF, strict=True)], schema=LEAF)

    return run


def patterns(histogram: np.ndarray, capacity: int) -> list[tuple[int, int, tuple[tuple[int, int], ...]]]:
    """(room, packs, ((length, copies), ...)) from the number of pieces of each length.

    At most three patterns come of each length, so their number is bounded by the capacity, not by the table.
    """
    by_room: dict[int, list[tuple[int, tuple]]] = {}
    rooms, out = 0, []  # rooms: bit r is set where a pattern has r ids of room

    def add(room: int, packs: int, pattern: tuple) -> None:
        nonlocal rooms
        if room:
            by_room.setdefault(room, []).append((packs, pattern))
            rooms |= 1 << room
        elif packs:
            out.append((0, packs, pattern))

    for length in range(capacity, 0, -1):
        left = int(histogram[length])
        while left:
            most = rooms.bit_length() - 1
            if most < length:  # no pack has room: a new one takes as many as it can, then the next
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    add(capacity - each * length, whole, ((length, each),))
                if rest:
                    add(capacity - rest * length, 1, ((length, rest),))
                break
            packs, pattern = by_room[most].pop()
            taken = min(packs, left)
            if packs > taken:
                by_room[most].append((packs - taken, pattern))
            elif not by_room[most]:
                rooms &= ~(1 << most)
            *head, (last, copies) = pattern
            add(most - length, taken, (*head, (last, copies + 1)) if last == length else (*pattern, (length, 1)))
            left -= taken
    return out + [(room, packs, pattern) for room, made in sorted(by_room.items()) for packs, pattern in made]


class Plan:
    """Ranges of ranks by length, sorted: where the pieces in them go. Its size is bounded by the capacity."""

    def __init__(self, histogram: np.ndarray, capacity: int, slack: int) -> None:
        made = patterns(histogram, capacity)
        rows, used = [], np.zeros(capacity + 1, np.int64)
        packs_before, ids_before = 0, 0
        for room, packs, pattern in sorted(made, key=lambda m: m[0] > slack):
            loose, offset = room > slack, 0
            for length, copies in pattern:
                rows.append((length * RANKS + int(used[length]), copies, ids_before if loose else packs_before, offset, capacity - room, loose))
                used[length] += packs * copies
                offset += length * copies
            if loose:
                ids_before += packs * (capacity - room)
            else:
                packs_before += packs
        rows.sort()
        self.key, self.copies, self.before, self.offset, self.full, loose = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        self.loose = loose.astype(bool)
        self.capacity, self.first_loose = capacity, packs_before
        # Cuts of the ids that are laid end to end: the last whole multiple, then falling powers of two.
        whole, tail = ids_before // capacity * capacity, ids_before % capacity
        self.whole = whole
        self.tail = whole + np.cumsum([0] + [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1])

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a piece is loose, and its pack (if loose: its place among the loose ids) and offset there."""
        at = np.searchsorted(self.key, length * RANKS + rank, side="right") - 1
        turn, copy = np.divmod(length * RANKS + rank - self.key[at], self.copies[at])
        offset, loose = self.offset[at] + copy * length, self.loose[at]
        return loose, np.where(loose, self.before[at] + turn * self.full[at] + offset, self.before[at] + turn), offset

    def parts(self, at: int, length: int) -> list[tuple[int, int, int, int]]:
        """(cut, size, sequence_id, offset) of a loose piece of ``length`` ids at a place."""
        out, cut = [], 0
        while cut < length:
            here = at + cut
            if here < self.whole:
                begin = here // self.capacity * self.capacity
                end, sequence = begin + self.capacity, here // self.capacity
            else:
                k = int(np.searchsorted(self.tail, here, side="right"))
                begin, end, sequence = int(self.tail[k - 1]), int(self.tail[k]), self.whole // self.capacity + k - 1
            size = min(length - cut, end - here)
            out.append((cut, size, self.first_loose + sequence, here - begin))
            cut += size
        return out


def _places(plan: Plan):
    names = [c.split()[0] for c in PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, rank, length, doc, start, tokens, crc, before = (batch.column(c) for c in ("part", "rank", "length", "doc_id", "start", "doc_tokens", "crc", "before"))
            size = length.to_numpy().astype(np.int64)
            loose, pack, offset = plan.place(size, rank.to_numpy() + before.to_numpy())
            tied = np.flatnonzero(~loose)
            if len(tied):
                t = pa.array(tied)
                own = [c.take(t) for c in (part, rank, length, doc, start)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.zeros(len(tied), np.int64)), pa.array(size[tied]), crc.take(t), tokens.take(t), pa.array(pack[tied]), pa.array(offset[tied])], names=names)
            rows = []
            for i in np.flatnonzero(loose).tolist():
                own = [c[i].as_py() for c in (part, rank, length, doc, start)]
                made = plan.parts(int(pack[i]), int(size[i]))
                rows += [(*own[:4], own[4] + cut, cut, n, crc[i].as_py() if len(made) == 1 else None, tokens[i].as_py(), sequence, o) for cut, n, sequence, o in made]
            if rows:
                kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.int64()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids and checksum of the cut parts of pieces."""
    for batch in batches:
        ids = [x[4 * a : 4 * (a + n)] for x, a, n in zip(batch.column("ids").to_pylist(), batch.column("cut").to_pylist(), batch.column("size").to_pylist(), strict=True)]
        at = batch.schema.get_field_index
        batch = batch.set_column(at("crc"), "crc", pa.array([zlib.crc32(x) for x in ids], pa.int64()))
        yield batch.set_column(at("ids"), "ids", pa.array(ids, pa.binary()))


def pack(docs: DataFrame, vocab_path: str, capacity: int = 4096, eot: int = 2, slack: int = 64, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every piece of every document and its place; with
    ``keep_ids`` also its ids, four little-endian bytes each.

    A null or empty text is the end token alone. Repeated rows are packed as often as they stand; a null doc_id stays null.
    No rows give no rows. Columns other than doc_id and text are not read. Documents over the capacity are cut into full
    pieces and a rest; others are cut only where they lie in a pack with more room than ``slack``. sequence_id counts from 0
    without gaps. The driver gets a histogram of at most ``capacity`` rows, and sends the patterns' ranges back.
    """
    scratch = Scratch(docs.sparkSession)
    # Read again for ids: the table of pieces stays, what is derived from it goes.
    leaf = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_leaf(vocabulary(vocab_path), capacity, eot), LEAF_SQL), "pieces")
    counts = scratch.written(leaf.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row a length
        histogram[r["length"]] = r["n"]
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids binary" if keep_ids else "")
    if not histogram.any():
        return docs.sparkSession.createDataFrame([], out)
    plan = Plan(histogram, capacity, slack)
    # The ranks of a task's pieces of a length begin after those of the tasks before it: a row a task in each window.
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(counts.select("part", "length", ahead.alias("before")), "starts")
    scratch.clear()
    starts = F.broadcast(starts) if size_bytes(starts) <= BROADCAST_BYTES else starts
    narrow = leaf.select("part", "rank", "doc_id", "start", "length", "doc_tokens", "crc").join(starts, ["part", "length"])
    placed = narrow.mapInArrow(_places(plan), PLACED)
    columns = ["doc_id", "start", F.col("size").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    if keep_ids:
        every = placed.join(leaf.select("part", "length", "rank", "ids"), ["part", "length", "rank"])
        return every.mapInArrow(_checked, every.schema).select(*columns, "ids")
    if not plan.loose.any():
        return placed.select(*columns)
    # A cut piece, one a pack that was dissolved at most, gets its parts' checksums from its ids.
    placed = written(placed, "placed")
    cut = written(placed.filter("crc is null"), "cut")
    cut = F.broadcast(cut) if size_bytes(cut) <= BROADCAST_BYTES else cut
    cut = leaf.select("part", "length", "rank", "ids").join(cut, ["part", "length", "rank"])
    return placed.filter("crc is not null").select(*columns).unionByName(cut.mapInArrow(_checked, cut.schema).select(*columns))
