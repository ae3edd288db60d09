"""Near-duplicates and near vectors against brute force; the pipeline; queries with SQL."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from boxlake.llm import neardup, vectors
from boxlake.llm.queries import ORACLE_SQL, QUERIES
from boxlake.session import Scratch, size_bytes
from tests.conftest import SF, same_rows

A_Z = {c: c + 32 for c in range(65, 91)}


def components(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, words):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(A_Z)) if x]
    return {tuple(w)} - {()} if len(w) < words else {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def near(rows, words):
    s = {i: shingles(t, words) for i, t in rows}
    ids = list(s)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])]
    return s, components(ids, pairs)


def chain(rng, n, start=0):
    """Texts of which each is near the one before it, but not near those further off."""
    words = [f"w{k}" for k in rng.integers(0, 10_000, 120)]
    out = []
    for i in range(n):
        out.append((start + i, " ".join(words)))
        words[(i * 7) % 110 : (i * 7) % 110 + 7] = [f"v{k}" for k in rng.integers(0, 10_000, 7)]
    return out


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(spark, words):
    rng = np.random.default_rng(words)
    rows = chain(rng, 15) + chain(rng, 10, 100)
    base = [f"b{k}" for k in range(200)]
    for i in range(40):
        copy = list(base)
        for k in rng.integers(0, 200, int(rng.integers(0, 6))):
            copy[k] = f"e{i}_{k}"
        rows.append((200 + i, " ".join(copy)))
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one two"), (304, "ONE two"), (305, "one two three"), (306, "one\x0btwo"), (307, "É x y z q"), (308, "é x y z q")]
    rows += [(400 + i, " ".join(f"r{k}" for k in rng.integers(0, 60, 30))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sig", F.lit(1)).withColumn("fp", F.lit("x"))
    out = {r.doc_id: r for r in neardup.near_duplicates(df, words=words).collect()}
    s, want = near(rows, words)
    assert {i: out[i].n_shingles for i in s} == {i: len(x) for i, x in s.items()}
    assert {i: out[i].component_id for i in s} == want
    assert all(out[i].kept == (want[i] == i) for i in s)


@pytest.mark.parametrize(("rounds", "block_bytes"), [(0, 6000), (2, 8 << 20)])
def test_groups_over_a_block(spark, rounds, block_bytes):
    """A hot group of copies edited so differently that most pairs stay below the bound, cut into many blocks."""
    rng = np.random.default_rng(5)
    rows, base = chain(rng, 12, 500), [f"b{k}" for k in range(150)]
    for i in range(90):
        copy = list(base)
        for k in rng.integers(0, 150, int(rng.integers(0, 14))):
            copy[k] = f"e{i}_{k}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, want = near(rows, 4)
    assert len(set(want.values())) > 10
    out = neardup.near_duplicates(df, words=4, block_rows=8, block_bytes=block_bytes, rounds=rounds)
    assert {r.doc_id: r.component_id for r in out.collect()} == want


def test_a_similarity_of_exactly_eighty_percent_links(spark):
    rows = [(1, " ".join(f"a{k}" for k in range(93))), (2, " ".join([*(f"a{k}" for k in range(83)), *(f"b{k}" for k in range(10))]))]
    i, u = len(shingles(rows[0][1], 4) & shingles(rows[1][1], 4)), len(shingles(rows[0][1], 4) | shingles(rows[1][1], 4))
    assert 100 * i == 80 * u
    assert {r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()} == {1}


def test_no_rounds_still_lose_no_link(spark):
    rows = chain(np.random.default_rng(9), 12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, want = near(rows, 4)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, words=4, rounds=0).collect()} == want


def test_near_duplicates_of_odd_tables(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "A b c d e f")], "doc_id long, text string")
    rows = neardup.near_duplicates(df).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [(-1, -1, True), (5, 5, True), (5, 5, True), (7, 5, False)]
    shared = spark.createDataFrame([(3, "a b c d e f"), (5, "a b c d e f"), (5, "t u v w x y"), (5, "t u v w x y"), (4, "t u v w x y"), (3, "k l m n o p"), (None, None)], "doc_id long, text string")
    rows = neardup.near_duplicates(shared).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (3, 3), (3, 3), (4, 4), (5, 3), (5, 4), (5, 4)]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def plain_vectors(rows, threshold):
    ok = {i: np.array(v, float) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = list(ok)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= threshold]
    n = {i: 0 for i, _ in rows}
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    return n, components([i for i, _ in rows], pairs)


@pytest.mark.parametrize("block", [2048, 16])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(60)]
    for i in range(60):
        v = np.array(rows[i % 6][1])
        rows.append((100 + i, (v + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3]) * np.linalg.norm(v) / 4).astype(np.float32).tolist()))
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [None] * 16), (305, [float("inf"), *[1.0] * 15]), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (308, rows[0][1]), (309, rows[0][1])]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("band", F.lit(1)).withColumn("weight", F.lit(2))
    out = {r.vec_id: r for r in vectors.near_vectors(df, bucket=8, block=block).collect()}
    n, comp = plain_vectors(rows, 0.95)
    assert {i: out[i].n_links for i in n} == n
    assert {i: out[i].component_id for i in comp} == comp
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_band_plan_bounds_the_miss():
    for n in (10, 10**4, 10**9):
        bits, bands = vectors.band_plan(n, 0.95, 1024, 1e-6)
        assert (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** bands <= 1e-6 and n / 2**bits <= 1024


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, duck, name):
    same_rows(QUERIES[name](spark, SF), duck, ORACLE_SQL[name])


def test_a_repeated_id_loses_only_the_text_that_has_a_copy(spark):
    a, b = "a b c d e f g", "t u v w x y z"
    rows = [(3, a), (5, a), (5, b), (5, b), (9, b), (5, None), (11, "k l m n o p q"), (None, a), (None, a), (12, None), (12, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.minhash_neardup(spark, df, "")
    # Rows without an id, and texts without words, link with nothing; of copies under one id, one stays.
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, a), (0, a), (3, a), (5, ""), (5, b), (11, "k l m n o p q"), (12, ""), (12, "")]


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), int(k))) for k in rng.integers(2, 9, 300)]
    say = lambda n: " ".join(rng.choice(words, n))
    one = say(90)
    rows = [(i, f"menu line\n{say(80)}", "en", "s", 0) for i in range(60)] + [(100, one, "en", "t", 0), (101, one + " end", "en", "t", 0), (102, "short", "en", "t", 0), (103, None, None, None, None), (104, say(70) + " mail joe@example.com", "en", "t", 0)]
    spark.createDataFrame(rows, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    out = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == docs.columns
    left = {r.doc_id: r.text for r in out.collect()}
    assert set(left) == {*range(60), 100, 104} and left[104].endswith("mail [EMAIL]") and "menu" not in left[0]
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(left)


def test_tables_that_grow_are_not_broadcast(spark, monkeypatch):
    """Lists of signatures meet by shuffles, and rows in the driver are counted as they are there, not as their files are."""
    plans = []
    write = Scratch.written

    def seen(self, df, label="step"):
        plans.append((label, df._jdf.queryExecution().sparkPlan().toString()))
        return write(self, df, label)

    monkeypatch.setattr(Scratch, "written", seen)
    scratch = Scratch(spark)
    sig = F.transform(F.sequence(F.lit(0), F.lit(47)), lambda k: ((F.col("id") % 40) * 48 + k).cast("int"))
    classes = write(scratch, spark.range(80).select(F.col("id").alias("node"), sig.alias("sig")))
    assert neardup._lists(classes, 48, 22, scratch).count() > 0
    assert {label for label, _ in plans} == {"prefix", "lists"}
    assert [label for label, plan in plans if "BroadcastHashJoin" in plan] == []
    many = write(scratch, spark.range(400_000).select(F.col("id").alias("node"), (F.col("id") % 2).alias("component")))
    assert size_bytes(many) <= neardup.LOOKUP_BYTES
    assert "Broadcast" not in spark.range(9).join(neardup._lookup(many), F.col("id") == F.col("node"))._jdf.queryExecution().sparkPlan().toString()
    scratch.clear()
