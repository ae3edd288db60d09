"""Exact groups by content hash; near groups by banded hashes, two gates, and components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxlake.functions import grammar as G
from boxlake.operators import geometry as geo
from boxlake.operators.graph import connected_components
from boxlake.operators.order import numbered
from boxlake.session import written


def exact_members(files: DataFrame, content: Column, path: str = "path") -> DataFrame:
    """(path, hash, keep): every file with its group's smallest path. A file without content is a group of its own.

    Two narrow shuffles on the hash; contents are hashed before anything moves.
    """
    hashed = files.select(F.col(path).alias("path"), F.coalesce(F.sha1(content), F.concat(F.lit("path:"), F.col(path))).alias("hash"))
    return hashed.join(hashed.groupBy("hash").agg(F.min("path").alias("keep")), "hash")


def exact_groups(files: DataFrame, content: Column, path: str = "path", most: int = 1000) -> DataFrame:
    """(hash, keep, part, dups): the smallest path kept, its duplicates in order, at most ``most`` in a part.

    Parts count from 0, so a group of any size is arrays of bounded size, and no task holds a group; a file without duplicates
    has one empty part.
    """
    members = exact_members(files, content, path)
    dups = numbered(members.filter("path <> keep").select("hash", "path"), "hash", "path", name="_n")
    first = dups.groupBy("hash").agg(F.min("_n").alias("_first"))
    parts = dups.join(first, "hash").groupBy("hash", F.floor((F.col("_n") - F.col("_first")) / most).cast("int").alias("part")).agg(F.sort_array(F.collect_list("path")).alias("dups"))
    heads = members.filter("path = keep").select("hash", "keep").distinct()
    return heads.join(parts, "hash", "left").select("hash", "keep", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("dups", F.array().cast("array<string>")).alias("dups"))


def _pieces(column: str, count: int) -> Column:
    """A hash (array of bits) as ``count`` texts of equal size. A lambda binds it, so that it is computed once a row."""

    def cut(h: Column) -> Column:
        size = (F.size(h) / count).cast("int")
        return F.array(*[F.array_join(F.slice(h, size * i + 1, size), "") for i in range(count)])

    return F.get(F.transform(F.array(column), cut), F.lit(0))


def bands(items: DataFrame, hashes: dict[str, str], count: int, key: str) -> DataFrame:
    """(key, tag, band, value): each hash (array of bits) cut into ``count`` bands of equal size."""
    parts = [items.select(key, F.lit(tag).alias("tag"), F.posexplode(_pieces(column, count)).alias("band", "value")) for tag, column in hashes.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def candidates(items: DataFrame, hashes: dict[str, str], count: int, key: str, cap: int | None = None, block: int = 4096) -> DataFrame:
    """(a, b), a < b: distinct pairs that share a band.

    A pair is given by the first band that it shares, so pairs of two keys that stand in one row each, which are nearly all,
    never meet in a shuffle. Buckets are cut into blocks of about ``block`` rows, and two blocks meet in a task: a hot bucket is
    many tasks. The pairs themselves are quadratic.

    ``cap`` compares the ``cap`` smallest keys of each bucket only, as a speed limit of the caller's choice; default none.
    """
    if cap is not None:
        posted = bands(items, hashes, count, key)
        least = posted.groupBy("tag", "band", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cap)
        rank = F.row_number().over(Window.partitionBy("tag", "band", "value").orderBy(key))
        posted = posted.join(least, ["tag", "band", "value"], "left").withColumn("r", F.when(F.col("n").isNull(), 0).otherwise(rank)).filter(F.col("r") <= cap).drop("r", "n")
        a, b = posted.withColumnRenamed(key, "a"), posted.withColumnRenamed(key, "b")
        return a.join(b, ["tag", "band", "value"]).filter("a < b").select("a", "b").distinct()
    # Texts of at most 62 bits as numbers, which are quicker to compare; longer ones by 64 bits of a hash.
    code = lambda v: F.when(v.rlike("^[01]{1,62}$"), F.conv(F.concat(F.lit("1"), v), 2, 10).cast("long")).otherwise(F.xxhash64(v))
    values = F.concat(*[_pieces(column, count) for column in hashes.values()])
    rows = items.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), values.alias("values"))
    own = F.transform("values", lambda v: F.when(v.isNotNull(), code(v)))
    # An inner explode would have the planner filter by the array first, and compute it twice.
    posted = rows.select("k", own.alias("own"), F.posexplode_outer("values").alias("place", "value")).filter("value is not null")
    parts = F.ceil(F.count(F.lit(1)) / block).cast("int")
    hot = posted.groupBy("place", "value").agg(parts.alias("parts")).filter("parts > 1")
    posted = posted.join(hot, ["place", "value"], "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    again = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k")
    if again.isEmpty():
        return _meetings(posted, posted, len(hashes) * count)
    # Rows of a repeated key may give a pair several times.
    one, more = posted.join(again, "k", "left_anti"), posted.join(again, "k", "left_semi")
    several = _meetings(more, posted, len(hashes) * count).unionByName(_meetings(posted, more, len(hashes) * count))
    return _meetings(one, one, len(hashes) * count).unionByName(several.distinct())


def _meetings(left: DataFrame, right: DataFrame, places: int) -> DataFrame:
    """(a, b), a < b: posted rows (k, own, place, value, parts, block) of either side that agree at no earlier place."""
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    # A column a place keeps the test short enough to be compiled; no value agrees with none.
    own = lambda none: [F.coalesce(F.get("own", F.lit(at)), F.lit(none)).alias(f"own_{at}") for at in range(places - 1)]
    a = left.select(F.col("k").alias("a"), "place", "value", F.col("block").alias("x"), every.alias("y"), *own(-1))
    b = right.select(F.col("k").alias("b"), "place", "value", every.alias("x"), F.col("block").alias("y"), *own(-2))
    on = F.col("a") < F.col("b")
    for at in range(places - 1):
        on = on & ((a["place"] <= at) | (a[f"own_{at}"] != b[f"own_{at}"]))
    for c in ("place", "value", "x", "y"):
        on = (a[c] == b[c]) & on
    # Sides are larger than the planner takes exploded rows for: none is to be broadcast.
    return a.join(b.hint("merge"), on).select("a", "b")


def bucket_report(items: DataFrame, hashes: dict[str, str], count: int, key: str, cap: int) -> DataFrame:
    """(tag, band, value, n, cut): buckets that a cap would cut."""
    return bands(items, hashes, count, key).groupBy("tag", "band", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cap).withColumn("cut", F.col("n") - cap)


def near_pairs(items: DataFrame, pairs: DataFrame, hash_a: str, hash_b: str, vector: str, key: str, most_bits: int | tuple[int, int], most_mse: float) -> DataFrame:
    """(a, b): pairs close by either hash and by mean squared error; ``most_bits`` may differ by hash. The hash gate runs on hashes alone, before vectors move."""
    most_a, most_b = most_bits if isinstance(most_bits, tuple) else (most_bits, most_bits)
    h = items.select(key, hash_a, hash_b)
    gate = pairs.join(h.select(F.col(key).alias("a"), F.col(hash_a).alias("a1"), F.col(hash_b).alias("a2")), "a").join(h.select(F.col(key).alias("b"), F.col(hash_a).alias("b1"), F.col(hash_b).alias("b2")), "b")
    gate = gate.filter((geo.bits_differ(F.col("a1"), F.col("b1")) <= most_a) | (geo.bits_differ(F.col("a2"), F.col("b2")) <= most_b)).select("a", "b")
    v = items.select(key, vector)
    return gate.join(v.select(F.col(key).alias("a"), F.col(vector).alias("va")), "a").join(v.select(F.col(key).alias("b"), F.col(vector).alias("vb")), "b").filter(geo.mse(F.col("va"), F.col("vb")) <= most_mse).select("a", "b")


def bits_to_long(bits: Column) -> Column:
    """An array of at most 64 zeros and ones as a long, the first the most significant."""
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(x.cast("long")))


class _Gate:
    """Which pairs of a tile pass either hash's gate, and met in no bucket before this one."""

    def __init__(self, most: tuple[int, int], count: int, tags: list[str]) -> None:
        self.most, self.count, self.tags = most, count, tags

    def pairs(self, pdf: pd.DataFrame):
        """Chunks of (places left, places right)."""
        hashes = [pdf[c].to_numpy().astype(np.uint64) for c in ("_a", "_p")]
        sizes = [int(pdf[c].iloc[0]) for c in ("_na", "_np")]
        own = self.tags.index(pdf["tag"].iloc[0]), int(pdf["band"].iloc[0])
        side = pdf["side"].to_numpy()
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        both = bool((side == 0).all())
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            near = np.zeros((len(rows), len(right)), bool)
            for h, most in zip(hashes, self.most, strict=True):
                near |= np.bitwise_count(h[rows][:, None] ^ h[right]) <= most
            i, j = np.nonzero(near)
            a, b = rows[i], right[j]
            if both:
                a, b = a[a < b], b[a < b]
            new = np.ones(len(a), bool)
            for t, (h, bits) in enumerate(zip(hashes, sizes, strict=True)):
                width = bits // self.count
                for band in range(self.count):
                    if (t, band) < own:
                        shift, mask = np.uint64(bits - width * (band + 1)), np.uint64((1 << width) - 1)
                        new &= (h[a] ^ h[b]) >> shift & mask != 0
            yield a[new], b[new]


def _passing(gate: _Gate, columns: list[str]):
    """Members of a tile with such a pair."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(len(pdf), bool)
        for a, b in gate.pairs(pdf):
            seen[a] = seen[b] = True
        return pdf[seen][columns]

    return run


def _tile(gate: _Gate, vector: str, key: str, most_mse: float, pairs: bool = False):
    """One block of a bucket against another, or itself: each row that links, and the smallest key it is connected with; or
    the pairs that are near."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, ignore_index=True)
        x, low = np.stack(pdf[vector].to_numpy()).astype(np.float64), np.arange(len(pdf))
        if pairs:
            found = [np.zeros((0, 2), np.int64)]
            for a, b in gate.pairs(pdf):
                for k in range(0, len(a), 65_536):
                    p, q = a[k : k + 65_536], b[k : k + 65_536]
                    ok = ((x[p] - x[q]) ** 2).T.sum(axis=0) / x.shape[1] <= most_mse
                    found.append(np.stack([np.minimum(p, q)[ok], np.maximum(p, q)[ok]], axis=1))
            at, keys = np.concatenate(found), pdf[key].to_numpy()
            return pd.DataFrame({"a": keys[at[:, 0]], "b": keys[at[:, 1]]})
        for a, b in gate.pairs(pdf):
            open_ = (a != b) & (low[a] != low[b])
            a, b = a[open_], b[open_]
            for k in range(0, len(a), 65_536):
                p, q = a[k : k + 65_536], b[k : k + 65_536]
                # Components are added one after another, as a fold over the arrays would.
                ok = ((x[p] - x[q]) ** 2).T.sum(axis=0) / x.shape[1] <= most_mse
                low = _joined(low, p[ok], q[ok])
        keys, linked = pdf[key].to_numpy(), low != np.arange(len(low))
        return pd.DataFrame({"a": keys[linked], "b": keys[low[linked]]})

    return run


def _joined(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a[i] with b[i]: the smallest row of each component."""
    while len(a):
        before = low.copy()
        m = np.minimum(low[a], low[b])
        for side in (a, b):
            np.minimum.at(low, before[side], m)
            np.minimum.at(low, side, m)
        low = low[low]
        if (low == before).all():
            break
    return low


def near_links(items: DataFrame, hashes: dict[str, str], count: int, vector: str, key: str, most_bits: int | tuple[int, int], most_mse: float, block: int = 1024) -> DataFrame:
    """(a, b): links enough to connect whatever ``near_pairs`` over ``candidates`` connects, without a row a pair.

    Buckets are cut into blocks of about ``block`` rows, and blocks compared inside a task, which gives back at most one row
    a member; so a hot bucket is many tasks, and its pairs are never written. Two phases: the hashes alone, as longs, go
    through all buckets; vectors then go only to the tiles where their row has a pair that passes the hashes' gate and met
    in no earlier bucket. hashes: two columns of at most 64 bits, by tag.
    """
    return _in_tiles(items, hashes, count, vector, key, most_bits, most_mse, block, False).distinct()


def near_pairs_by_tiles(items: DataFrame, hashes: dict[str, str], count: int, vector: str, key: str, most_bits: int | tuple[int, int], most_mse: float, block: int = 1024) -> DataFrame:
    """(a, b), a < b: what ``near_pairs`` over ``candidates`` gives, each pair once, without a row for a pair that isn't near.

    Give one row of each group of copies (``exact_members``): copies are pairs among themselves.
    """
    return _in_tiles(items, hashes, count, vector, key, most_bits, most_mse, block, True)


def _in_tiles(items: DataFrame, hashes: dict[str, str], count: int, vector: str, key: str, most_bits: int | tuple[int, int], most_mse: float, block: int, pairs: bool) -> DataFrame:
    hash_a, hash_b = hashes.values()
    most = most_bits if isinstance(most_bits, tuple) else (most_bits, most_bits)
    gate = _Gate(most, count, list(hashes))
    posted, bucket = bands(items, hashes, count, key), ["tag", "band", "value"]
    sizes = posted.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    cut = posted.join(sizes, bucket).withColumn("p", F.pmod(F.xxhash64(key), F.col("parts")).cast("int"))
    # Block p meets block o: as the left one where it is the smaller, as the right one where it is the larger.
    meet = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(F.col("p"), o).alias("x"), F.greatest(F.col("p"), o).alias("y"), F.when(o == F.col("p"), 0).when(o > F.col("p"), -1).otherwise(1).alias("side")))
    kind = items.schema[key].dataType.simpleString()
    coded = items.select(key, bits_to_long(F.col(hash_a)).alias("_a"), bits_to_long(F.col(hash_b)).alias("_p"), F.size(hash_a).alias("_na"), F.size(hash_b).alias("_np"))
    tiles = cut.select(key, *bucket, F.explode(meet).alias("m")).select(key, *bucket, "m.x", "m.y", "m.side").join(coded, key)
    place = f"{key} {kind}, tag string, band int, value string, x int, y int, side int, _a long, _p long, _na int, _np int"
    names = [c.split()[0] for c in place.split(", ")]
    tile = [*bucket, "x", "y"]
    passing = written(tiles.groupBy(*tile).applyInPandas(_passing(gate, names), place), "passing")
    full = passing.join(items.select(key, vector), key)
    return full.groupBy(*tile).applyInPandas(_tile(gate, vector, key, most_mse, pairs), f"a {kind}, b {kind}")


def piece_limits(radius: int, pieces: int) -> list[int]:
    """Most bits in which each piece may differ: two hashes within ``radius`` keep at least one of them, as the limits and
    one each add up to radius + 1. -1 means that the others suffice."""
    each, more = divmod(radius + 1, pieces)
    return [each - 1 + (i < more) for i in range(pieces)]


def hash_classes(items: DataFrame, key: str, hash_col: str) -> DataFrame:
    """(key, hash, rep): rows with a hash, and the smallest key that has the same one."""
    rows = items.select(key, F.col(hash_col).alias("hash")).filter("hash is not null")
    return rows.join(rows.groupBy("hash").agg(F.min(key).alias("rep")).hint("shuffle_hash"), "hash").select(key, "hash", "rep")


def hamming_join(items: DataFrame, key: str, hash_col: str, radius: int, pieces: int = 4) -> DataFrame:
    """(a, b, bits, n_a, n_b): pairs of different 64-bit hashes that differ in at most ``radius`` bits, none missed.

    A pair stands once, a < b, for the smallest keys of its two hashes, of which n_a and n_b rows have one; rows of one hash
    are ``hash_classes``. Hashes are cut into pieces; one piece of a near pair differs in at most its limit's bits
    (``piece_limits``), so each hash is posted under its pieces, and probes all values within the limit on the other side
    (137 values of 16 bits for two bits, 697 for three). What meets is tested by counting bits, in the join itself, and
    pairs that an earlier piece brings together are left to it. Null hashes and null keys take no part. Tasks hold the posted
    hashes of their values; the driver holds nothing that grows.
    """
    width = 64 // pieces
    limits = piece_limits(radius, pieces)
    rows = items.filter(F.col(key).isNotNull() & F.col(hash_col).isNotNull())
    classes = written(rows.groupBy(F.col(hash_col).alias("h")).agg(F.min(key).alias("k"), F.count(F.lit(1)).alias("n")), "hashes")
    sparse = classes.count() < 1 << width

    def piece(h: Column, i: int) -> Column:
        size = width if i < pieces - 1 else 64 - width * i
        return F.shiftrightunsigned(h, width * i).bitwiseAND(F.lit((1 << size) - 1))

    out = None
    for i, limit in enumerate(limits):
        if limit < 0:
            continue
        size = width if i < pieces - 1 else 64 - width * i
        masks = [sum(1 << b for b in at) for k in range(limit + 1) for at in combinations(range(size), k)]
        posted = classes.select(F.col("k").alias("b"), F.col("h").alias("hb"), F.col("n").alias("n_b"), piece(F.col("h"), i).alias("value"))
        probes = classes.select(F.col("k").alias("a"), F.col("h").alias("ha"), F.col("n").alias("n_a"), F.explode(F.transform(F.lit(masks), lambda m: piece(F.col("h"), i).bitwiseXOR(m.cast("long")))).alias("value"))
        if sparse:  # values that nothing is posted under: at most 2 ** width of them are
            probes = probes.join(F.broadcast(posted.select("value").distinct()), "value", "left_semi")
        apart = F.col("ha").bitwiseXOR(F.col("hb"))
        on = (probes["value"] == posted["value"]) & (F.col("a") < F.col("b")) & (F.bit_count(apart) <= radius)
        for j in range(i):
            if limits[j] >= 0:
                on = on & (F.bit_count(piece(apart, j)) > limits[j])
        # By a shuffle, whatever the planner takes the exploded probes' size for: else it may collect and broadcast them.
        met = probes.join(posted.hint("shuffle_hash"), on).select("a", "b", F.bit_count(apart).alias("bits"), "n_a", "n_b")
        out = met if out is None else out.unionByName(met)
    return out


def hamming_links(items: DataFrame, key: str, hash_col: str, radius: int, pieces: int = 4) -> DataFrame:
    """(key, rep, n_links): every row with a hash, the smallest key of its hash, and how many other rows lie within ``radius``."""
    pairs = hamming_join(items, key, hash_col, radius, pieces)
    ways = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("rep"), F.col("n_b").alias("n")), F.struct(F.col("b").alias("rep"), F.col("n_a").alias("n")))).alias("w"))
    near = ways.groupBy("w.rep").agg(F.sum("w.n").alias("n"))
    members = hash_classes(items.filter(F.col(key).isNotNull()), key, hash_col)
    same = members.groupBy("rep").agg(F.count(F.lit(1)).alias("same"))
    return members.join(same.hint("shuffle_hash"), "rep").join(near.hint("shuffle_hash"), "rep", "left").select(key, "rep", (F.col("same") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))


def near_members(pairs: DataFrame) -> DataFrame:
    """(key, keep): members of groups of two and more, with the smallest key of the group."""
    return connected_components(pairs, "a", "b").select(F.col("node").alias("key"), F.col("component").alias("keep"))


def two_stage(items: DataFrame, content: Column, near, key: str, exact_stage: bool = True, near_stage: bool = True) -> DataFrame:
    """(stage, key, keep): exact duplicates first, then near ones among what the first stage keeps; either may be off.

    ``near`` takes the items that are left and gives pairs (a, b) of keys. A row is a duplicate's; what is kept has none.
    """
    out, left = None, items
    if exact_stage:
        members = exact_members(items.withColumn("_key", F.col(key)), content, "_key").select(F.col("path").alias(key), "keep")
        out = members.filter(F.col(key) != F.col("keep")).select(F.lit("exact").alias("stage"), key, "keep")
        left = items.join(members.filter(F.col(key) == F.col("keep")).select(key), key, "left_semi")
    if near_stage:
        found = near_members(near(left)).filter("key <> keep").select(F.lit("near").alias("stage"), F.col("key").alias(key), "keep")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else items.select(F.lit("none").alias("stage"), key, F.col(key).alias("keep")).limit(0)


def stage_totals(dups: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """(stage, groups, dups, moved): moved counts the actions of ``results`` (stage, result) that went through; without, all planned."""
    planned = dups.groupBy("stage").agg(F.count_distinct("keep").alias("groups"), F.count(F.lit(1)).alias("dups"))
    if results is None:
        return planned.withColumn("moved", F.col("dups"))
    done = results.groupBy("stage").agg(F.count_if(F.col("result") == "ok").alias("moved"))
    return planned.join(done, "stage", "left").withColumn("moved", F.coalesce("moved", F.lit(0)))


def group_totals(members: DataFrame, keep: str = "keep") -> DataFrame:
    """One row: groups of two and more, and the duplicates in them."""
    return members.groupBy(keep).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dups"))


def layout(members: DataFrame, numbers: DataFrame, root: str, out: str, tag: str) -> DataFrame:
    """(path, dst): ``<out>/<tag>/group_000001/<path below root>``; numbers: (keep, group_no)."""
    g = F.format_string("%s/%s/group_%06d/%s", F.lit(out), F.lit(tag), F.col("group_no"), G.relative_to(F.col("path"), root))
    return members.join(numbers, "keep").select("path", g.alias("dst"))
