"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors.

Every distinct unit vector o is rotated at random (fixed seeds) a few times, and the signs are kept as a binary code: ō_r is
the code's unit vector under rotation r. The correction factors <ō_r, o> are stored beside it, with the rotated vector in four
bits a coordinate and the norm of what that rounding lost. For a vector q, the mean over r of <ō_r, q> / <ō_r, o> estimates
<o, q> without bias, and its error is at most epsilon * sqrt(sum_r (1 - <ō_r, o>²) / (<ō_r, o>² (D - 1))) / rotations with a
confidence that grows with epsilon, plus what the rounding of q can add. Codes are written once, and they alone travel to the
comparisons; full vectors are fetched for members of pairs whose upper bound reaches the threshold, and these pairs are
computed again exactly, in double precision.

Which pairs meet at all is decided by bands of the code's sign bits: two vectors that agree in all bits of a band are in one
bucket. The bits of a band grow with the logarithm of the number of vectors, so that buckets keep their size and work grows
nearly in proportion; the number of bands follows from the chance of missing a pair exactly at the threshold. A pair that
meets in several bands counts in the first one only. Buckets are cut into blocks of bounded size and compared block by
block; a block emits one row for each vector - its links there, and a link to the smallest vector it is connected with -
never its pairs. ``exact`` compares all blocks with each other and leaves nothing to chance, at a quadratic cost.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.operators.graph import connected_components
from boxlake.session import Scratch, size_bytes, written

#: Broadcast the vectors that link up to this size; beyond it, a shuffle joins.
BROADCAST_BYTES = 8 << 20
PLACES = "band int, key int, x int, y int, side int, node long"


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def band_plan(n: int, threshold: float, bucket: int, miss: float) -> tuple[int, int]:
    """Bits of a band and number of bands for ``n`` vectors.

    Two unit vectors at angle a differ in a random sign with chance a / pi; bands are added until a pair exactly at the
    threshold misses all of them with a chance below ``miss``.
    """
    bits = max(1, math.ceil(math.log2(max(2.0, n / bucket))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-same))


@dataclass(frozen=True)
class Coder:
    """Codes of vectors of one dimension: ``bits`` * ``bands`` sign bits at least, ``rotations`` of them for estimates."""

    dim: int
    bits: int
    bands: int
    rotations: int = 4
    epsilon: float = 6.0

    @property
    def turns(self) -> list[np.ndarray]:
        return [rotation(self.dim, 101 + k) for k in range(max(self.rotations, -(-self.bits * self.bands // self.dim)))]

    def encode(self, unit: np.ndarray) -> list[bytes]:
        """One string of bytes a unit vector: factors, scale and lost norm as floats, four-bit coordinates, sign bits."""
        turned = [unit @ t.T for t in self.turns]
        factors = np.stack([np.abs(t).sum(axis=1) / math.sqrt(self.dim) for t in turned[: self.rotations]], axis=1)
        scale = (np.abs(turned[0]).max(axis=1) / 7).astype("<f4")
        q = np.rint(turned[0] / scale[:, None].astype(np.float64)).clip(-7, 7)
        lost = np.linalg.norm(turned[0] - q * scale[:, None], axis=1)
        floats = np.concatenate([factors, scale[:, None], lost[:, None] * 1.000001], axis=1).astype("<f4").view(np.uint8).reshape(len(unit), -1)
        half = np.zeros((len(unit), self.dim + self.dim % 2), np.uint8)
        half[:, : self.dim] = (q + 8).astype(np.uint8)
        return [r.tobytes() for r in np.concatenate([floats, half[:, ::2] << 4 | half[:, 1::2], np.packbits(np.concatenate(turned, axis=1) > 0, axis=1)], axis=1)]

    def decode(self, codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Floats, four-bit coordinates and sign bits of stored codes."""
        raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
        cut = 4 * (self.rotations + 2)
        end = cut + (self.dim + 1) // 2
        half = raw[:, cut:end]
        q = np.stack([half >> 4, half & 15], axis=2).reshape(len(raw), -1)[:, : self.dim].astype(np.float32) - 8
        return np.ascontiguousarray(raw[:, :cut]).view("<f4"), q, np.unpackbits(raw[:, end:], axis=1)

    def keys(self, bits: np.ndarray, bands: int) -> np.ndarray:
        """(vector, band) -> key, for the first ``bands`` bands."""
        return (bits[:, : self.bits * bands].reshape(len(bits), bands, self.bits) * (1 << np.arange(self.bits, dtype=np.int64))).sum(axis=2)

    def pairs(self, pdf: pd.DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows (a, b) of a tile whose upper bound reaches ``least`` and that met in no earlier band."""
        floats, q, bits = self.decode(pdf["code"])
        factors, scale, lost = floats[:, : self.rotations], floats[:, [-2]], floats[:, -1]
        turns = self.turns
        sign = bits[:, : self.rotations * self.dim].reshape(len(bits), self.rotations, self.dim).astype(np.float32) * 2 - 1
        code = (sign / (factors * np.float32(math.sqrt(self.dim) * self.rotations))[:, :, None]).reshape(len(bits), -1)
        query = np.concatenate([(q * scale) @ (t @ turns[0].T).T.astype(np.float32) for t in turns[: self.rotations]], axis=1)
        slack = self.epsilon / self.rotations * np.sqrt(((1 - factors**2).clip(0) / (factors**2 * max(1, self.dim - 1))).sum(axis=1))
        reach = (1 / factors).mean(axis=1)
        band, side = int(pdf["band"].iloc[0]), pdf["side"].to_numpy()
        keys = self.keys(bits, band)
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        own = len(left) == len(right) and (left == right).all()
        found = [np.zeros((2, 0), np.int64)]
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            ahead = query[rows] @ code[right].T + slack[right] + np.outer(lost[rows], reach[right])
            back = code[rows] @ query[right].T + slack[rows][:, None] + np.outer(reach[rows], lost[right])
            i, j = np.nonzero(np.minimum(ahead, back) >= least)
            a, b = rows[i], right[j]
            if own:
                a, b = a[a < b], b[a < b]
            if band:
                fresh = ~(keys[a] == keys[b]).any(axis=1)
                a, b = a[fresh], b[fresh]
            found.append(np.stack([a, b]))
        a, b = np.concatenate(found, axis=1)
        return a, b


def _encode(coder: Coder):
    def run(frames):
        for pdf in frames:
            if len(pdf):
                x = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
                yield pd.DataFrame({"node": pdf["node"], "code": coder.encode(x / np.linalg.norm(x, axis=1)[:, None])})

    return run


def _posts(coder: Coder, code: bool):
    """(band, key), with ``code`` also (node, code): a row a vector and band."""

    def run(frames):
        for pdf in frames:
            if len(pdf):
                keys = coder.keys(coder.decode(pdf["code"])[2], coder.bands).astype(np.int32)
                for band in range(coder.bands):
                    out = {"band": np.full(len(pdf), band, np.int32), "key": keys[:, band]}
                    yield pd.DataFrame(out | {"node": pdf["node"], "code": pdf["code"]} if code else out)

    return run


def _near(coder: Coder, threshold: float):
    """Members of a tile with a pair whose bound reaches the threshold."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = coder.pairs(pdf, threshold - 1e-5)
        return pdf.iloc[np.unique(np.concatenate([a, b]))][[c.split()[0] for c in PLACES.split(", ")]]

    return run


def _exact(coder: Coder, threshold: float):
    """Links of each such member in its tile, and the smallest member of its component there."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        x = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        # Sums may round otherwise than in the larger tile: a little more room, so that no pair of that tile is lost.
        a, b = coder.pairs(pdf, threshold - 2e-5)
        exact = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", unit[a[k : k + 65_536]], unit[b[k : k + 65_536]]) for k in range(0, len(a), 65_536)]])
        # The unit vectors carry rounding; what lies at the threshold itself is decided by dot / (norm * norm).
        for k in np.flatnonzero(np.abs(exact - threshold) < 1e-9):
            exact[k] = np.dot(x[a[k]], x[b[k]]) / (np.linalg.norm(x[a[k]]) * np.linalg.norm(x[b[k]]))
        a, b = a[exact >= threshold], b[exact >= threshold]
        weight, ids = pdf["weight"].to_numpy(), pdf["node"].to_numpy()
        links, low = np.zeros(len(x), np.int64), np.arange(len(x))
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        while len(a):  # labels fall to the smallest of each component
            m = np.minimum(low[a], low[b])
            before = low.copy()
            np.minimum.at(low, a, m)
            np.minimum.at(low, b, m)
            low = low[low]
            if (low == before).all():
                break
        keep = links > 0
        return pd.DataFrame({"node": ids[keep], "n": links[keep], "low": ids[low[keep]]})

    return run


def near_vectors(df: DataFrame, threshold: float = 0.95, epsilon: float = 6.0, bucket: int = 4096, block: int = 2048, miss: float = 1e-6, exact: bool = False, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    A row links with every other row of cosine >= threshold in double precision; none below links. A pair at the threshold
    isn't met by any band with a chance of ``miss``; with ``exact`` all pairs are computed. Vectors that are null, empty or
    zero, or hold null or non-finite components, link with nothing, nor do rows with a null id; vectors of different lengths
    don't link. Equal vectors are one class that links within itself. Rows are told apart by their vectors, so rows that share
    an id may lie in different components: component_id is the smallest id of the rows that a row reaches. No rows give no
    rows. Ids are integers; columns other than id and vector are not read.
    """
    scratch = Scratch(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vector"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    ok = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(F.exists("vector", bad), F.lit(True)) & F.coalesce(F.exists("vector", lambda v: v != 0), F.lit(False))
    good = rows.filter(ok)
    # Equal vectors meet by value, with partial counts; one row for each goes on. Numbers are fixed by writing them.
    classes = good.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    classes = scratch.written(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = None
    for r in classes.groupBy(F.size("vector").alias("dim")).count().collect():
        part = _of_dim(classes.filter(F.size("vector") == r["dim"]), r["dim"], r["count"], threshold, epsilon, bucket, block, miss, exact, scratch)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "node long, n long, low long")
    found = scratch.written(found, "found")
    sums = found.groupBy("node").agg(F.sum("n").alias("n"))
    reach = connected_components(found, "node", "low").join(classes.select("node", "id"), "node")
    reach = reach.join(reach.groupBy("component").agg(F.min("id").alias("least")), "component").select("node", "least")
    labels = classes.join(sums, "node", "left").join(reach, "node", "left").filter("weight > 1 or n is not null")
    labels = written(labels.select("vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "id").alias("component_id")), "labels")
    scratch.clear()
    # Only vectors that link are looked up; the others stand alone. Bad ones equal none of them, or have no id.
    near = F.broadcast(labels) if size_bytes(labels) <= BROADCAST_BYTES else labels
    out = rows.join(near, (rows["vector"] == labels["vector"]) & rows["vec_id"].isNotNull(), "left")
    out = out.select(rows["vec_id"], F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", rows["vec_id"]).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _of_dim(classes: DataFrame, dim: int, n: int, threshold: float, epsilon: float, bucket: int, block: int, miss: float, exact: bool, scratch: Scratch) -> DataFrame:
    bits, bands = (1, 0) if exact else band_plan(n, threshold, bucket, miss)
    coder = Coder(dim, bits, bands, epsilon=1e3 if exact else epsilon)
    codes = scratch.written(classes.select("node", "vector").mapInPandas(_encode(coder), "node long, code binary"), "codes")
    if exact:
        posted = codes.select(F.lit(0).alias("band"), F.lit(0).alias("key"), "node", "code")
    else:
        posted = codes.mapInPandas(_posts(coder, True), "band int, key int, node long, code binary")
    # Buckets over one block are cut into blocks by a hash of the id; only their sizes are gathered, a few rows a bucket.
    sizes = (posted if exact else codes.mapInPandas(_posts(coder, False), "band int, key int")).groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"))
    cut = posted.join(sizes.filter(F.col("size") > block), ["band", "key"], "left").withColumn("parts", F.ceil(F.coalesce("size", F.lit(1)) / block).cast("int"))
    cut = cut.withColumn("p", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # Block p meets block o for each o >= p: as the left one where it is p itself, as the right one where o is its own.
    meet = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(F.col("p"), o).alias("x"), F.greatest(F.col("p"), o).alias("y"), F.when(o == F.col("p"), 0).when(o > F.col("p"), -1).otherwise(1).alias("side")))
    tiles = cut.withColumn("m", F.explode(meet)).select("band", "key", "m.x", "m.y", "m.side", "node", "code")
    near = scratch.written(tiles.groupBy("band", "key", "x", "y").applyInPandas(_near(coder, threshold), PLACES), "near")
    full = near.join(classes.select("node", "weight", "vector"), "node").join(codes, "node")
    return full.groupBy("band", "key", "x", "y").applyInPandas(_exact(coder, threshold), "node long, n long, low long")
