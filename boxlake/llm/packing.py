"""Hierarchical residual packing: local best-fit, nearly full bins leave, underfull bins meet again as items.

Every partition tokenises and packs its own pieces without a shuffle. Bins whose free space is at most ``slack`` are
final; the others are items of the next round, dealt to groups of at most ``group_rows`` bins, and so on up the tree
until one group is left, a round saves no bin, or ``max_rounds`` are over: in either case the underfull bins that are left
could meet in one group only by way of more rounds, and stay as they are. A bin carries its pieces' references (at most
one for each token), never tokens.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from boxlake.llm.bpe import byte_letters
from boxlake.llm.common import text_slices, vocabulary
from boxlake.session import written

MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
BIN = pa.schema([("size", pa.int32()), ("members", pa.list_(MEMBER))])
BIN_SQL = "size int, members array<struct<doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint>>"
OUT = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
#: Fixed value: the pattern that splits text before the merges of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 300_000


class ByteCoder(dict):
    """Little-endian ids of a text under a byte-level BPE file of the tokenizers library.

    The pattern always starts a new token at a space before a character that isn't white space, so a text is the sum of
    the chunks between such places; chunks are remembered, up to ``CACHE`` of them. A text with a special token, or with
    white space other than single spaces and line feeds, goes to the library whole.
    """

    def __init__(self, data: bytes) -> None:
        super().__init__()
        spec = json.loads(data)
        self.whole = Tokenizer.from_str(data.decode())
        self.whole.no_truncation()
        self.whole.no_padding()
        self.special = [t["content"] for t in spec["added_tokens"]]
        back = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        (self.line,) = self.fast.encode_ordinary("\n")
        self.odd = re.compile(r"\s\s|[^\S \n]|^\s|\s$").search

    def encode(self, text: str) -> bytes:
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks that aren't known yet: all that follow a space in one call, with line feeds, tokens of their own, between."""
        plain = [c for c in chunks if c[0] != "\n"]
        ids = np.array(self.fast.encode_ordinary("".join([f"\n {c}" for c in plain])), "<u4")
        cuts = np.append(np.flatnonzero(ids == self.line), len(ids)).tolist()
        data = ids.tobytes()
        self.update((c, data[4 * a + 4 : 4 * b]) for c, a, b in zip(plain, cuts[:-1], cuts[1:], strict=True))
        self.update((c, self.encode(c)) for c in chunks if c[0] == "\n")

    def rows(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out: list[bytes] = []
        split: dict[int, tuple[str, list[str]]] = {}
        for i, text in enumerate(texts):
            out.append(b"")
            if any(s in text for s in self.special):
                out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            elif not text or self.odd(text):
                out[i] = self.encode(text)
            else:
                first, *rest = text.replace("\n", " \n").split(" ")
                split[i] = (first, rest)
        new = set().union(*[r for _, r in split.values()]).difference(self)
        if len(self) + len(new) > CACHE:
            self.clear()
            new = set().union(*[r for _, r in split.values()])
        self.learn(new)
        for i, (first, rest) in split.items():
            out[i] = self.encode(first) + b"".join(map(self.__getitem__, rest))
        return out


def pieces_of(ids: bytes, capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32): the first piece takes what is left over, all others are full."""
    n = len(ids) // 4
    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Bin of each item by best-fit in order of falling size; the open residuals are the bits of one integer."""
    where = np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fit = mask >> s
        if fit:
            left = s + (fit & -fit).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                mask &= ~(1 << left)
            left -= s
        else:
            b, left = bins, capacity - s
            bins += 1
        if left:
            open_bins[left].append(b)
            mask |= 1 << left
        where[i] = b
    return where, bins


def pack_bins(table: pa.Table, capacity: int) -> pa.Table:
    """Best-fit over bins as items: one row for each new bin, with the members of its items in order."""
    if not table.num_rows:
        return table
    sizes = table.column("size").to_numpy()
    where, bins = best_fit(sizes, capacity)
    order = np.argsort(where, kind="stable")
    members = table.column("members").take(pa.array(order)).combine_chunks()
    counts = pa.compute.list_value_length(members).to_numpy(zero_copy_only=False)
    per_bin = np.bincount(where[order], weights=counts, minlength=bins).astype(np.int64)
    offsets = np.append(0, np.cumsum(per_bin)).astype(np.int32)
    totals = np.bincount(where, weights=sizes, minlength=bins).astype(np.int32)
    return pa.table([pa.array(totals), pa.ListArray.from_arrays(pa.array(offsets), members.flatten())], schema=BIN)


def _leaf(data: bytes, capacity: int, eot: int):
    end = np.array([eot], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, rest = ByteCoder(data), []
        for part in text_slices(batches):
            rows = []
            for doc, ids in zip(part.column(0).to_pylist(), coder.rows([t or "" for t in part.column(1).to_pylist()]), strict=True):
                rows += [(doc, *p) for p in pieces_of(ids + end, capacity)]
            columns = list(zip(*rows, strict=True))
            members = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MEMBER, strict=True)], fields=list(MEMBER))
            bins = pa.table([pa.array(columns[3], pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1), pa.int32()), members)], schema=BIN)
            full = pa.compute.equal(bins.column("size"), capacity)
            yield from bins.filter(full).to_batches()
            rest.append(bins.filter(pa.compute.invert(full)))
        if rest:
            yield from pack_bins(pa.concat_tables(rest), capacity).to_batches(max_chunksize=10_000)

    return run


def pack(docs: DataFrame, vocab_path: str, capacity: int = 2048, eot: int = 0, slack: int = 4, group_rows: int = 16_384, max_rounds: int = 8) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece of every document and its place.

    A null or empty text is the end token alone. Repeated rows are packed as often as they stand; a null doc_id stays
    null. No rows give no rows. Columns other than doc_id and text are not read. sequence_id is unique for each sequence,
    with gaps.
    """
    data = vocabulary(vocab_path)
    bins = written(docs.select("doc_id", "text").mapInArrow(_leaf(data, capacity, eot), BIN_SQL), "bins")
    full, under = [bins.filter(F.col("size") >= capacity - slack)], bins.filter(F.col("size") < capacity - slack)
    n = under.count()

    def merge(group: pa.Table) -> pa.Table:
        return pack_bins(group.select(["size", "members"]), capacity)

    for level in range(max_rounds):
        groups = -(-n // group_rows)
        if n < 2:
            break
        # Dealt by the place in the written files, so that rows that share an id, or have none, spread like all others.
        dealt = under.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(level)), F.lit(groups)))
        bins = written(dealt.groupBy("g").applyInArrow(merge, BIN_SQL), "bins")
        full.append(bins.filter(F.col("size") >= capacity - slack))
        under = bins.filter(F.col("size") < capacity - slack)
        before, n = n, under.count()
        if groups == 1 or n + full[-1].count() == before:
            break
    placed = under
    for part in full:
        placed = placed.unionByName(part)
    numbered = placed.select(F.monotonically_increasing_id().alias("sequence_id"), "members")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            counts = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            length = flat.field("length").to_numpy()
            before = np.cumsum(length) - length
            firsts = np.cumsum(counts) - counts
            offset = before - np.repeat(before[firsts] if len(firsts) else before[:0], counts)
            ids = np.repeat(batch.column(0).to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([*flat.flatten(), pa.array(ids), pa.array(offset)], names=[f.split()[0] for f in OUT.split(", ")])

    return numbered.mapInArrow(rows, OUT)
