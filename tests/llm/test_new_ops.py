"""Packing over the histogram, hard negatives and whitening against brute force and exact round trips."""

import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from boxlake.llm import hardneg, histpack, whitening
from boxlake.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF, same_rows

VOCAB = public_tokenizers.path("word_bpe_49k.json")


# --- packing over the histogram ----------------------------------------------------------------------------------------
def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCAB)
    t.no_truncation()
    t.no_padding()
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def padding(rows, capacity):
    """Share of the padded sequences that is padding; sequences as {id: size}."""
    sizes = {}
    for r in rows:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    padded = [n if n & (n - 1) == 0 else capacity for n in sizes.values()]
    return 1 - sum(sizes.values()) / max(1, sum(padded)), sizes


def check_pieces(rows, docs, capacity, eot=2):
    """Pieces cover each document once, lie gapless in their sequences, and have the library's ids."""
    want = {i: ids + [eot] for (i, _), ids in zip(docs, library_ids([t for _, t in docs]), strict=True)}
    of, seqs = {}, {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    assert set(of) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(of[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sorted(seqs) == list(range(len(seqs)))


def test_histogram_packing_covers_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op11_histpack"](spark, SF).collect()
    check_pieces(rows, docs, 4096)
    assert padding(rows, 4096)[0] <= 64 / 4096


@pytest.mark.parametrize("capacity", [7, 64])
def test_histogram_packing_of_odd_tables(spark, capacity):
    docs = [(1, None), (2, ""), (3, "  \n "), (4, "word " * 500), (5, "word"), (6, "a<|endoftext|>b <|startoftext|>"), (7, "Ünïcode ΣΑΣ é \x1c x y")] + [(10 + i, "one two three four") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("part", F.lit(1)).repartition(5)
    rows = histpack.pack(df, VOCAB, capacity=capacity, slack=0).collect()
    check_pieces(rows, docs, capacity)
    assert padding(rows, capacity)[0] == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    rows = histpack.pack(twice, VOCAB).collect()
    assert sum(r.length for r in rows) == 3 * 3 + 1 and {r.doc_id for r in rows} == {1, None}
    assert histpack.pack(df.limit(0), VOCAB).count() == 0


def test_lengths_that_pack_badly_are_cut(spark):
    docs = [(i, "word " * 40) for i in range(203)]  # 41 ids: one a sequence of 64 would waste a third
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = histpack.pack(df, VOCAB, capacity=64, slack=1, keep_ids=True).collect()
    check_pieces(rows, docs, 64)
    share, sizes = padding(rows, 64)
    assert share == 0 and len(sizes) <= -(-203 * 41 // 64) + 6
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


@pytest.mark.parametrize("seed", range(6))
def test_patterns_hold_every_piece(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(1, 200))
    h = np.append(0, rng.integers(0, [2, 50, 10**9][seed % 3], capacity))
    made = histpack.patterns(h, capacity)
    seen = np.zeros(capacity + 1, np.int64)
    for room, packs, pattern in made:
        assert room + sum(n * c for n, c in pattern) == capacity
        for n, c in pattern:
            seen[n] += packs * c
    assert (seen == h).all() and len(made) <= 3 * capacity
    plan = histpack.Plan(h, capacity, 0)
    used = set()
    if h.sum() < 20_000:
        for length in np.flatnonzero(h):
            loose, pack, offset = plan.place(np.full(h[length], length), np.arange(h[length]))
            for one, p, o in zip(loose.tolist(), pack.tolist(), offset.tolist(), strict=True):
                parts = plan.parts(p, int(length)) if one else [(0, int(length), p, o)]
                assert sum(x[1] for x in parts) == length
                for _, size, sequence, at in parts:
                    cells = {(sequence, at + k) for k in range(size)}
                    assert not cells & used and at + size <= capacity
                    used |= cells


# --- hard negatives ----------------------------------------------------------------------------------------------------
def plain_negatives(rows, is_anchor, k=5):
    ok = [(i, y, [int(np.floor(256 * float(c))) for c in v]) for i, y, v in rows if i is not None and y is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=True))
    out = []
    for n, (i, y, x) in enumerate(ok):
        if not is_anchor(i):
            continue
        others = [(m, j, z, dot(x, v)) for m, (j, z, v) in enumerate(ok) if m != n and len(v) == len(x)]
        ranked = sorted(others, key=lambda o: (-o[3], o[1]))
        for _, pid, _, ps in [o for o in ranked if o[2] == y][:k]:
            within = [o for o in ranked if o[2] != y and 80 * ps <= 100 * o[3] <= 100 * ps][:k]
            out += [(i, pid, r + 1, o[1], ps, o[3]) for r, o in enumerate(within)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 17)])
def test_hard_negatives(spark, blocks):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((4, 12))
    rows = [(i, int(i % 4), (centre[i % 4] * 0.3 + rng.standard_normal(12) * 0.7 + 0.4).astype(np.float32).tolist()) for i in range(220)]
    rows += [(300 + i, i % 3, rows[5][2]) for i in range(40)]  # many equal vectors: ties by id
    rows += [(700, None, rows[0][2]), (800, 1, None), (810, 1, [float("nan")] + rows[0][2][1:]), (820, 1, [None] + rows[0][2][1:]), (None, 1, rows[0][2]), (830, 1, [float("inf")] * 12)]
    rows += [(900, 9, rows[0][2]), (910, 2, [0.0] * 12), (920, 2, [1.5, -2.0]), (930, 2, [1.0, 3.0]), (931, 3, [1.0, 2.5]), (940, 1, []), (941, 1, []), (942, 2, []), (950, 0, [-0.001] * 12)]
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<float>").withColumn("node", F.lit(1)).withColumn("x", F.lit("x"))
    out = hardneg.mine(df, F.col("vec_id") % 10 == 0, anchor_block=blocks[0], row_block=blocks[1])
    assert sorted(map(tuple, out.collect())) == plain_negatives(rows, lambda i: i % 10 == 0)
    assert len(plain_negatives(rows, lambda i: i % 10 == 0)) > 300


def test_hard_negatives_of_odd_tables(spark):
    kind = "vec_id long, label long, embedding array<double>"
    everyone = F.lit(True)
    assert hardneg.mine(spark.createDataFrame([], kind), everyone).count() == 0
    assert hardneg.mine(spark.createDataFrame([(1, 1, [1.0])], kind), everyone).count() == 0
    # Rows that share an id are rows of their own.
    rows = [(1, 1, [1.0]), (1, 1, [1.0]), (1, 2, [0.9]), (2, 2, [1.0])]
    out = sorted(map(tuple, hardneg.mine(spark.createDataFrame(rows, kind), F.col("label") == 1).collect()))
    assert out == sorted([(1, 1, 1, 2, 65536, 65536), (1, 1, 2, 1, 65536, 58880)] * 2)
    # Components that need integers instead of doubles.
    rng = np.random.default_rng(2)
    wide = [(i, i % 2, (rng.standard_normal(3) * 30_000 + 20_000).tolist()) for i in range(60)]
    assert sorted(map(tuple, hardneg.mine(spark.createDataFrame(wide, kind), F.col("vec_id") < 9).collect())) == plain_negatives(wide, lambda i: i < 9)
    with pytest.raises(Exception, match="fit a long"):
        hardneg.mine(spark.createDataFrame([(1, 1, [1e9]), (2, 1, [1.0])], kind), everyone)


def test_bit_planes_drop_rows_early():
    rng = np.random.default_rng(3)
    x = rng.integers(-200, 200, (4000, 64))
    search, seen = hardneg.Search(hardneg.sliced(x, 9), 64, 200), []
    tightened = search.tightened
    search.tightened = lambda *a: seen.append(tightened(*a)) or seen[-1]
    goals = np.array([[hardneg.NO_LIMIT]] * 8)
    for i, at, score in search.run(x[:8], goals, 5):
        exact = x @ x[i]
        assert (score == exact[at]).all() and set(np.argsort(-exact)[:5]) <= set(at)
    first = [s.mean() for s in seen if s.shape[0] == 8]
    assert first[-1] <= 0.05 and len(first) < 9


def test_hard_negative_sql(spark, duck):
    same_rows(QUERIES["op12_hardneg"](spark, SF), duck, ORACLE_SQL["op12_hardneg"])


def test_hard_negative_query(spark):
    rows = [(r.vec_id, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = plain_negatives(rows, lambda i: i % 100 == 0)
    got = sorted(map(tuple, QUERIES["op12_hardneg"](spark, SF).collect()))
    assert got == want and want


# --- whitening ---------------------------------------------------------------------------------------------------------
def plain_whitening(vectors):
    """n, exact sums, covariance from fractions."""
    fit = sorted({tuple(int(np.floor(256 * float(c))) for c in v) for v in vectors})
    n, dim = len(fit), len(fit[0])
    total = [sum(x[d] for x in fit) for d in range(dim)]
    z = np.array([[float(Fraction(x[d]) - Fraction(total[d], n)) for d in range(dim)] for x in fit])
    return n, total, z.T @ z / n


def check_whitening(rows, vectors, most=4):
    n, total, v = plain_whitening([x for _, x in vectors])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    want = min(most, int((e > e[0] * 1e-9).sum()))
    assert set(by) == {i for i, _ in vectors} and all(sorted(x) == list(range(1, want + 1)) for x in by.values())
    for k in range(1, want + 1):
        sign = 0
        for i, vec in vectors:
            x = [int(np.floor(256 * float(c))) for c in vec]
            r, y = by[i][k], float(np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, total, strict=True)]) @ u[:, k - 1] / np.sqrt(e[k - 1]))
            sign = sign or (1 if r.whitened * y >= 0 else -1) * (abs(y) > 1e-3)
            assert abs(r.whitened - (sign or 1) * y) < 1e-8
            assert r.n == n and int(r.deviation) == sum((n * a - s) ** 2 for a, s in zip(x, total, strict=True))
            assert abs(r.explained - e[k - 1] / np.trace(v)) < 1e-9 and r.identity_error < 1e-8


def test_whitening_query(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op13_whitening"](spark, SF).collect(), vectors)


def test_whitening_of_odd_tables(spark):
    rng = np.random.default_rng(4)
    good = [(i, (rng.standard_normal(5) * [5, 3, 2, 1, 1] + 1000).tolist()) for i in range(50)]
    good += [(100 + i, good[0][1]) for i in range(30)]  # a copy counts once in the fit
    bad = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5), (203, [float("-inf")] * 5), (204, [])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn("n", F.lit("n"))
    check_whitening(whitening.whiten(df.repartition(6)).collect(), good)
    kind = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).count() == 0  # no variance
    line = [(i, [i / 4, i / 2, 3.0]) for i in range(9)]  # one direction only
    check_whitening(whitening.whiten(spark.createDataFrame(line, kind)).collect(), line)
    # Lengths apart; a repeated and a null id; entries that need more than longs.
    two = [(1, [1.0, 2.0]), (1, [4.0, 1.0]), (None, [0.0, 7.0]), (9, [1e12, -1e12, 5.0]), (10, [-1e12, 3e12, 6.0]), (11, [1e12, 1e12, 9.0])]
    rows = whitening.whiten(spark.createDataFrame(two, kind)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in rows) == sorted([(False, 1, 1), (False, 1, 2)] * 2 + [(True, 0, 1), (True, 0, 2)] + [(i, j, k) for i, j, k in [(False, 9, 1), (False, 9, 2), (False, 10, 1), (False, 10, 2), (False, 11, 1), (False, 11, 2)]])
    n, total, _ = plain_whitening([v for i, v in two if len(v) == 3])
    assert {r.vec_id: int(r.deviation) for r in rows if r.vec_id in (9, 10, 11)} == {i: sum((n * int(np.floor(256 * c)) - s) ** 2 for c, s in zip(v, total, strict=True)) for i, v in two if len(v) == 3}
