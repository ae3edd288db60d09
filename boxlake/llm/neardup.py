"""MinHash near-duplicates by an inverted join over signature coordinates.

Texts with the same set of shingles form a class first; only one row for each class goes on. A class posts under its
(coordinate, value) pairs, ordered from the rarest to the most frequent: two classes that agree in at least ``least`` of
``coords`` coordinates must share one of the first ``coords - least + 1`` pairs of either (prefix merging), so the
longest lists are skipped. Members of a list are compared by their whole signatures; those of at least ``least`` equal
coordinates, directly or through others, form a family. Within a family, pairs are confirmed on the full shingle sets, by
integers: 100 * intersection >= 80 * union.

Pairs never become rows. Lists and families are compared inside a task, which gives back one row for each member that it
connects; members already connected aren't compared again. A list or family over a block is cut into blocks and compared
block against block, after rounds in which all of it meets one hub.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from boxlake.llm.common import text_slices
from boxlake.operators.graph import connected_components
from boxlake.session import Scratch, size_bytes, written

#: Most words whose hash a task remembers.
CACHE = 300_000
#: Broadcast a set of candidate ids up to this many bytes; beyond it the rows are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: The same for tables of candidates' labels, signatures and sets, by the size of their files and of their rows in memory.
LOOKUP_BYTES = 8 << 20
#: Bytes of a row of a hashed table beside its values, for its place and its key.
ROW_BYTES = 48


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, one without words has none."""
    if not text:
        return np.zeros(0, np.uint64)
    # bytes.lower and bytes.split are ASCII only: A-Z, and the six white-space characters of the contract.
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(h))
    mult = np.uint64(0x9E3779B97F4A7C15)
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix(out * mult + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def _print(hashes: np.ndarray) -> bytes | None:
    """Fingerprint of a set: equal for equal sets."""
    return blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def coordinates(coords: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of the signature's hash functions; fixed."""
    rng = np.random.default_rng(20_240_607)
    return rng.integers(0, 2**31, coords, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, coords, np.uint32)


def signature(hashes: np.ndarray, mult: np.ndarray, add: np.ndarray) -> list[int]:
    """For each coordinate, 31 bits of the shingle hash that is smallest under that coordinate's order."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out, buffer = [], np.empty_like(x)
    for a, b in zip(mult, add, strict=True):
        np.multiply(x, a, out=buffer)
        np.add(buffer, b, out=buffer)
        out.append(buffer.argmin())
    return (_mix(hashes[out]) >> np.uint64(33)).astype(np.int64).tolist()


def _signatures(words: int, coords: int):
    mult, add = coordinates(coords)

    def run(batches):
        known = _WordHash()
        for part in text_slices(batches):
            n, prints, sigs = [], [], []
            for text in part.column(1).to_pylist():
                h = shingle_hashes(text, words, known)
                n.append(len(h))
                prints.append(_print(h))
                sigs.append(signature(h, mult, add) if len(h) else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))], names=["doc_id", "n_shingles", "fp", "sig"])

    return run


def _sets(words: int):
    def run(batches):
        known = _WordHash()
        for part in text_slices(batches):
            sets = [shingle_hashes(t, words, known) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([_print(h) for h in sets], pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())], names=["id", "fp", "set"])

    return run


def _semi(rows: DataFrame, ids: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """Rows whose ``key`` is in ``ids`` (one column, ``key``): broadcast if the ids' checked size allows it, else by a shuffle."""
    ids = scratch.written(ids.distinct(), "ids")
    small = ids.count() * (ROW_BYTES + 8) <= BROADCAST_BYTES
    return rows.join(F.broadcast(ids) if small else ids.hint("merge"), key, "left_semi")


def _lookup(table: DataFrame) -> DataFrame:
    """A written table as the side that is looked up: broadcast if its files and its counted rows are small, else by a shuffle.

    Files of numbered rows take a fraction of what their rows take in the driver's memory, so their size alone says little.
    """
    small = size_bytes(table) <= LOOKUP_BYTES and table.count() * (ROW_BYTES + 8 * len(table.columns)) <= LOOKUP_BYTES
    return F.broadcast(table) if small else table.hint("merge")


def _shuffled(table: DataFrame) -> DataFrame:
    """A side that grows with the input: joined by a shuffle, whatever the planner takes its size for, which for what comes of
    exploded arrays is far too low."""
    return table.hint("merge")


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by (g, x, y) as tables of whole tiles, with the places where tiles start."""

    def keys(t: pa.Table) -> list[np.ndarray]:
        return [t.column(c).to_numpy() for c in ("g", "x", "y")]

    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        rest = t if rest is None else pa.concat_tables([rest, t])
        if rest.num_rows:
            new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys(rest)])) + 1
            if len(new):
                yield rest.slice(0, new[-1]).combine_chunks(), np.append(0, new[:-1])
                rest = rest.slice(new[-1])
    if rest is not None and rest.num_rows:
        new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys(rest)])) + 1
        yield rest.combine_chunks(), np.append(0, new)


def _met(c: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """(u, v): for each component that met others under a label, itself and the smallest of them."""
    both = np.unique(np.stack([label, c]), axis=1)
    first = np.append(True, both[0, 1:] != both[0, :-1])
    low = both[1][np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
    return pa.RecordBatch.from_arrays([pa.array(both[1][~first]), pa.array(low[~first])], names=["u", "v"])


def _agreeing(least: int, percent: int):
    """Tiles of (side, c, n, sig): what links is at least ``least`` equal coordinates, and sizes that allow the similarity.

    All tiles of a table go forward together: in round r, the r-th row of each is compared with the rows after it (on the
    other side, if the tile has two) that aren't connected with it yet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _whole_tiles(batches):
            rows = t.num_rows
            c, n, side = (t.column(k).to_numpy() for k in ("c", "n", "side"))
            sig = t.column("sig").combine_chunks().flatten().to_numpy().reshape(rows, -1)
            seg = np.zeros(rows, np.int64)
            seg[starts[1:]] = 1
            seg = np.cumsum(seg)
            pos = np.arange(rows) - starts[seg]
            left = np.add.reduceat((side == 1).astype(np.int64), starts)
            probes = np.where(left > 0, left, np.diff(np.append(starts, rows)))
            label = np.unique(np.stack([seg, c]), axis=1, return_inverse=True)[1].reshape(-1)
            others = np.flatnonzero(pos >= left[seg])
            for r in range(int(probes.max())):
                others = others[(pos[others] > r) & (probes[seg[others]] > r)]
                if not len(others):
                    break
                probe = starts[seg[others]] + r
                open_ = (label[others] != label[probe]) & (100 * np.minimum(n[others], n[probe]) >= percent * np.maximum(n[others], n[probe]))
                j, i = others[open_], probe[open_]
                hit = (sig[j] == sig[i]).sum(axis=1) >= least
                if hit.any():
                    to = np.arange(rows)
                    to[label[j[hit]]] = label[i[hit]]
                    label = to[label]
            yield _met(c, label)

    return run


def _confirming(percent: int):
    """Tiles of (side, c, n, set): what links is the similarity of the full sets; a tile is compared on its own."""

    def tile(side: np.ndarray, c: np.ndarray, n: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
        left = int((side == 1).sum())
        label = np.unique(c, return_inverse=True)[1].reshape(-1)
        _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count[code] > 1
        stops = np.append(0, np.cumsum(shared))[np.append(0, np.cumsum(n))]
        code, mark = code[shared], np.zeros(len(count), np.int32)
        for i in range(left or len(n) - 1):
            lo = max(i + 1, left)
            j = lo + np.flatnonzero((label[lo:] != label[i]) & (100 * np.minimum(n[lo:], n[i]) >= percent * np.maximum(n[lo:], n[i])))
            if not len(j):
                continue
            own = code[stops[i] : stops[i + 1]]
            mark[own] = 1
            if 8 * len(j) < len(n) - lo:
                both = np.array([int(mark[code[stops[k] : stops[k + 1]]].sum()) for k in j])
            else:
                sums = np.append(0, np.cumsum(mark[code[stops[lo] :]]))
                both = sums[stops[j + 1] - stops[lo]] - sums[stops[j] - stops[lo]]
            mark[own] = 0
            hit = j[100 * both >= percent * (n[i] + n[j] - both)]
            if len(hit):
                label[np.isin(label, label[hit])] = label[i]
        return label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _whole_tiles(batches):
            c, n, side = (t.column(k).to_numpy() for k in ("c", "n", "side"))
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in t.column("set").combine_chunks()]
            labels, top = [], 0
            for a, b in zip(starts, np.append(starts[1:], t.num_rows), strict=True):
                labels.append(tile(side[a:b], c[a:b], n[a:b], sets[a:b]) + top)
                top += b - a
            yield _met(c, np.concatenate(labels))

    return run


def _parts(limits: tuple[int, int]) -> Column:
    """Blocks that hold ``rows`` rows of ``bytes`` bytes, at most about limits[0] rows and limits[1] bytes each."""
    return F.greatest(F.ceil(F.col("rows") / limits[0]), F.ceil(F.col("bytes") / limits[1])).cast("int")


def _sizes(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"), F.min("c").alias("low"), F.max("c").alias("high"))


def _star_tiles(rows: DataFrame, large: DataFrame, limits: tuple[int, int], turn: int) -> DataFrame:
    """For each large group, one hub on the left and each block of its members on the right: linear in the rows."""
    hubs = rows.join(large.select("g", _parts(limits).alias("parts")), "g")
    hub = hubs.groupBy("g").agg(F.min_by(F.struct("node", "c", "parts"), F.xxhash64("c", F.lit(turn))).alias("h"))
    left = hub.select("g", F.lit(0).alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("h.parts").cast("long") - 1)).alias("y"), F.lit(1).alias("side"), "h.node", "h.c")
    right = hubs.select("g", F.lit(0).alias("x"), F.pmod(F.xxhash64("node"), F.col("parts")).alias("y"), F.lit(2).alias("side"), "node", "c")
    return left.unionByName(right).withColumn("x", F.col("x").cast("long"))


def _block_tiles(rows: DataFrame, large: DataFrame, limits: tuple[int, int], scratch: Scratch) -> DataFrame:
    """Every pair of blocks of a large group but those of one component, and each block with itself.

    A component that fills a block has blocks of its own, which need no comparison among themselves; the others share blocks.
    """
    rows = rows.join(large.select("g"), "g")
    per = scratch.written(_sizes(rows, "g", "c").withColumn("parts", _parts(limits)), "components")
    pure = per.filter("parts > 1").select("g", F.col("c").alias("own"), "parts")
    pools = per.filter("parts <= 1").groupBy("g").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).select("g", F.lit(None).cast("long").alias("own"), _parts(limits).alias("parts"))
    name = F.xxhash64("own", "k").alias("b")
    blocks = pure.unionByName(pools).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("g", "own", name)
    p, q = blocks.alias("p"), blocks.alias("q")
    pairs = p.join(q, (F.col("p.g") == F.col("q.g")) & (F.col("p.b") <= F.col("q.b")) & ~F.coalesce(F.col("p.own") == F.col("q.own"), F.lit(False)))
    pairs = pairs.select("p.g", F.col("p.b").alias("x"), F.col("q.b").alias("y"))
    meet = pairs.select("g", "x", "y", F.col("x").alias("b"), F.when(F.col("x") == F.col("y"), 0).otherwise(1).alias("side"))
    meet = scratch.written(meet.unionByName(pairs.filter("x <> y").select("g", "x", "y", F.col("y").alias("b"), F.lit(2).alias("side"))), "meetings")
    own = rows.join(pure.withColumnRenamed("own", "c"), ["g", "c"], "left").withColumn("own", F.when(F.col("parts").isNotNull(), F.col("c")))
    own = own.join(pools.select("g", F.col("parts").alias("pool")), "g", "left").withColumn("k", F.pmod(F.xxhash64("node"), F.coalesce("parts", "pool")).cast("int"))
    return own.select("g", "node", "c", name).join(_shuffled(meet), ["g", "b"]).select("g", "x", "y", "side", "node", "c")


def _components(groups: DataFrame, payload: DataFrame, judge, limits: tuple[int, int], rounds: int, scratch: Scratch) -> DataFrame:
    """(node, component): components of the links that ``judge`` finds among nodes of one group (g, node, bytes).

    Groups within one block are compared whole. Larger ones first meet one hub a round, which connects most of a group of
    copies at a cost in proportion to its size; what is left then meets block by block. Tiles give back a row for each
    component that they connect with another, never pairs, and no pair is left out.
    """
    column = payload.columns[-1]
    kind = payload.schema[column].dataType.simpleString()

    def links(tiles: DataFrame) -> DataFrame:
        rows = tiles.join(_lookup(payload), "node").select("g", "x", "y", "side", "node", "c", "n", column)
        rows = rows.repartition("g", "x", "y").sortWithinPartitions("g", "x", "y", "side", "node")
        return scratch.written(rows.mapInArrow(judge, "u long, v long").distinct(), f"links-{kind[:5]}")

    found = None
    rows = groups.withColumn("c", F.col("node"))
    for turn in range(rounds + 1):
        sizes = scratch.written(_sizes(rows, "g").filter("low < high").withColumn("parts", _parts(limits)), "sizes")
        large = sizes.filter("parts > 1")
        none = large.isEmpty()
        if none or turn == rounds:
            break
        fresh = links(_star_tiles(rows, large, limits, turn))
        if fresh.isEmpty():
            break
        found = fresh if found is None else found.unionByName(fresh)
        merged = scratch.written(connected_components(found), "merged")
        rows = scratch.written(groups.join(_lookup(merged), "node", "left").select("g", "node", "bytes", F.coalesce("component", "node").alias("c")), "rows")
    small = sizes.filter("parts <= 1").select("g")
    tiles = rows.join(_shuffled(small), "g").select("g", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(0).alias("side"), "node", "c")
    if not none:
        tiles = tiles.unionByName(_block_tiles(rows, large, limits, scratch))
    fresh = links(tiles)
    return scratch.written(connected_components(fresh if found is None else found.unionByName(fresh)), "merged")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, coords: int = 48, least: int = 22, id_col: str = "doc_id", text_col: str = "text", block_rows: int = 1024, block_bytes: int = 8 << 20, rounds: int = 3, prints: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), with ``prints`` also fp: one row per row of the input.

    Similarity is that of the sets of distinct word shingles, A-Z lower-cased; a text with fewer words is one shingle.
    Null and empty texts and texts without words link with nothing; nor does a row with a null id, whose component_id is null.
    Rows are told apart by their texts, so rows that share an id may lie in different components: component_id is the smallest
    id of the rows that a row reaches. Repeated rows are kept alike. No rows give no rows. Ids are integers; columns other
    than id and text are not read. A pair at the similarity bound has fewer than ``least`` equal coordinates with a chance of
    about 1e-8 by default.
    """
    scratch = Scratch(docs.sparkSession)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(read.mapInArrow(_signatures(words, coords), "doc_id bigint, n_shingles bigint, fp binary, sig array<int>"), "signatures")
    linked = rows.filter("fp is not null and doc_id is not null")
    classes = linked.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    # Numbers are fixed by writing them.
    classes = scratch.written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    lists = _lists(classes, coords, least, scratch)
    payload = scratch.written(_semi(classes, lists.select("node"), "node", scratch).select("node", "n", "sig"), "payload")
    alike = _components(lists, payload, _agreeing(least, percent), (2 * block_rows, block_bytes), rounds, scratch)

    near = scratch.written(classes.join(_lookup(alike), "node").select("node", "id", "fp", "n", F.col("component").alias("g")), "near")
    wanted = _semi(read.filter("doc_id is not null").withColumnRenamed("doc_id", "id"), near.select("id"), "id", scratch)
    sets = wanted.mapInArrow(_sets(words), "id bigint, fp binary, set binary").dropDuplicates(["fp"]).select("fp", "set")
    sets = scratch.written(sets.join(_lookup(near.select("node", "fp", "n")), "fp").select("node", "n", "set"), "sets")
    found = _components(near.select("g", "node", (8 * F.col("n")).alias("bytes")), sets, _confirming(percent), (block_rows, block_bytes), rounds, scratch)

    least_id = near.join(_lookup(found), "node").groupBy("component").agg(F.min("id").alias("least"))
    reached = near.select("node").join(_lookup(found), "node").join(_shuffled(least_id), "component").select("node", "least")
    # Only classes of several rows or with links change a row's own id.
    labels = classes.select("fp", "node", "id", "copies").join(_shuffled(reached), "node", "left").filter("copies > 1 or least is not null").select("fp", F.coalesce("least", "id").alias("component_id"))
    labels = written(labels, "labels")
    scratch.clear()
    out = rows.select("doc_id", "n_shingles", "fp").join(_lookup(labels), "fp", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *(["fp"] if prints else []))


def fingerprinted(docs: DataFrame, words: int = 5, text_col: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with a text's fingerprint as ``near_duplicates`` gives it, null for a text without words; no shuffle."""

    def run(batches):
        known = _WordHash()
        for part in text_slices(batches, text_col):
            texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
            prints = pa.array([_print(shingle_hashes(t, words, known)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, prints], names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def _lists(classes: DataFrame, coords: int, least: int, scratch: Scratch) -> DataFrame:
    """(g, node, bytes): the lists of the rarest (coordinate, value) pairs of each class; lists of equal members are one."""
    posts = classes.select("node", F.posexplode("sig").alias("k", "v"))
    # (coordinate, value) as one key; a pair with a single posting can't link anything and needs no list.
    posts = posts.select("node", F.xxhash64("k", "v").alias("g"))
    several = posts.groupBy("g").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = posts.join(_shuffled(several), "g").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("own"))
    # All single pairs come first in the order, so the prefix has that many places less.
    room = F.size("own") - (least - 1)
    prefix = scratch.written(ranked.filter(room > 0).select("node", F.explode(F.slice("own", 1, room)).alias("p")).select("node", "p.g"), "prefix")
    members = prefix.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(node))").alias("m1"), F.expr("bit_xor(xxhash64(node, 1))").alias("m2"))
    chosen = members.filter("n > 1").groupBy("n", "m1", "m2").agg(F.min("g").alias("g")).select("g")
    return scratch.written(prefix.join(_shuffled(chosen), "g").withColumn("bytes", F.lit(4 * coords + 64).cast("long")), "lists")
