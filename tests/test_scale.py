"""What only shows in larger tables, planted in small ones: each against the query's own SQL."""

import tracemalloc

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from boxlake.operators import cluster, dedup, pivots
from boxlake.plans import folders  # noqa: F401  registers its queries
from boxlake.plans.queries import ORACLE_SQL, QUERIES
from boxlake.sources import single, sinks
from tests.conftest import SF, same_rows


def tables(tmp_path, **extra):
    """A folder with these tables, and a connection that knows them."""
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for name, t in extra.items():
        pq.write_table(t, tmp_path / f"{name}.parquet")
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    return str(tmp_path), con


def embeddings(x, labels=None):
    labels = [i % 10 for i in range(len(x))] if labels is None else labels
    return pa.table({"vec_id": pa.array(range(len(x)), pa.int64()), "embedding": pa.array(list(map(list, x)), pa.list_(pa.float32())), "label": pa.array(labels, pa.int32())})


# F10
def test_units_that_round_to_zero_keep_their_sign(spark, tmp_path):
    x = np.full((3, 64), 0.125)
    x[0, :4] = [-1e-7, 1e-7, 0.0, -0.0]
    x[1, :2] = [-4.9e-7, -5.1e-7]
    d, con = tables(tmp_path, embeddings=embeddings(x))
    same_rows(QUERIES["unit_vectors"](spark, d), con, ORACLE_SQL["unit_vectors"])


# F12, F13, F14
@pytest.mark.parametrize("name", ["purge_plan", "purge_report", "status_labels"])
def test_crops_of_one_name(spark, tmp_path, name):
    """Boxes of an image that differ in their line number alone give crops, and review lines, of one name."""
    lines = pq.read_table(f"{SF}/lineitem.parquet")
    again = lines.set_column(lines.schema.get_field_index("l_linenumber"), lines.schema.field("l_linenumber"), pa.compute.add(lines["l_linenumber"], 4).cast(lines.schema.field("l_linenumber").type))
    d, con = tables(tmp_path, lineitem=pa.concat_tables([lines, again]), orders=pq.read_table(f"{SF}/orders.parquet"))
    same_rows(QUERIES[name](spark, d), con, ORACLE_SQL[name])


# F4, F5, F6
@pytest.mark.parametrize("name", ["hamming_pairs_sign", "hamming_pairs_mean", "hamming_link_counts"])
def test_no_table_that_grows_is_broadcast(spark, tmp_path, name):
    """Only the set of values of 16 bits may be sent to all; probes and hashes meet by shuffles."""
    x = np.random.default_rng(3).standard_normal((300, 64))
    x[1::3] = x[::3] * np.where(np.arange(64) < 3, -1, 1)
    d, con = tables(tmp_path, embeddings=embeddings(x))
    found = QUERIES[name](spark, d)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "LeftSemi" not in x] == []
    same_rows(found, con, ORACLE_SQL[name])


# F7, F8, F9, F11
@pytest.mark.parametrize("pass_rows", [1, 40, 500, 20_000])
def test_farthest_points_of_all_rows(spark, pass_rows):
    """However few rows a pass brings, the choice is that of one pass over everything; repeated rows and ties too."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((600, 8))
    x[300:320] = x[:20]
    x[320] = -x[5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id long, v array<double>").repartition(3)
    want = [tuple(r) for r in cluster.farthest_points(df, 30, "id", "v", pool_max=None).orderBy("ord").collect()]
    assert [tuple(r) for r in cluster.farthest_exact(df, 30, "id", "v", pass_rows=pass_rows).orderBy("ord").collect()] == want
    if pass_rows == 40:
        assert cluster.farthest_exact(df.limit(0), 3, "id", "v").count() == 0 and cluster.farthest_exact(df.filter("id < 2"), 9, "id", "v").count() == 2


def test_cover_of_a_table_of_several_groups(spark, tmp_path):
    """More rows than a group of cores holds: the SQL samples all of them."""
    x = np.random.default_rng(5).standard_normal((20_100, 64))
    d, con = tables(tmp_path, embeddings=embeddings(x))
    same_rows(QUERIES["cover_reps"](spark, d), con, ORACLE_SQL["cover_reps"])


# F16, F17, F18, F19
def test_shells_hold_few_rows_at_a_time():
    """What a batch of items sends to its shells leaves the worker in slices."""
    rng = np.random.default_rng(2)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.standard_normal((n, 64)))
    shells = pivots.Shells(unit(64), [{"cell": c, "low": 0.05 * p, "high": 0.05 * p + 0.04} for c in range(64) for p in range(20, 32)])
    items = pd.DataFrame({"node": range(1024), "v": list(unit(1024)), "sim": 0.4})
    out = list(shells.others([items]))
    assert sum(map(len, out)) > 100_000 and max(map(len, out)) <= 8192
    least = shells.least(items)
    want = least <= np.arccos(0.4) + pivots.TOLERANCE
    want[np.arange(1024), least.argmin(axis=1)] = False
    assert sorted(zip(*[np.concatenate([o[c] for o in out]) for c in ("node", "shell")], strict=True)) == sorted(zip(*np.nonzero(want), strict=True))


# F15
def test_pairs_of_a_band_meet_in_no_shuffle(spark, tmp_path):
    """Pairs are quadratic: what leaves the join is what is returned, with copies and null vectors too."""
    x = list(map(list, np.random.default_rng(7).standard_normal((150, 64))))
    x[40:60] = [x[0]] * 20
    x[70] = None
    t = pa.table({"vec_id": pa.array(range(150), pa.int64()), "embedding": pa.array(x, pa.list_(pa.float32())), "label": pa.array([0] * 150, pa.int32())})
    d, con = tables(tmp_path, embeddings=t)
    found = QUERIES["lsh_candidates"](spark, d)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("Join Inner")[0].splitlines() if "Aggregate" in line or "Repartition" in line]
    same_rows(found, con, ORACLE_SQL["lsh_candidates"])


@pytest.mark.parametrize("block", [3, 4096])
@pytest.mark.parametrize("size", [8, 160])
def test_pairs_of_a_band_are_given_once(spark, block, size):
    """In blocks or not, by short bands and long ones; repeated keys, null keys and a missing hash as well."""
    rng = np.random.default_rng(size)
    half = rng.integers(0, 2, (3, size // 2)).tolist()
    rows = [(int(k), half[rng.integers(3)] + half[rng.integers(3)], half[rng.integers(3)] * 2 if k % 5 else None) for k in [*range(30), 4, 4, 9]] + [(None, half[0] * 2, None)]
    items = spark.createDataFrame(rows, "k int, h array<int>, g array<int>")
    cut = lambda v: [] if v is None else [(i, tuple(v[i * size // 2 : (i + 1) * size // 2])) for i in range(2)]
    posts = [(k, {("h", *p) for p in cut(h)} | {("g", *p) for p in cut(g)}) for k, h, g in rows if k is not None]
    want = sorted({(a, b) for a, p in posts for b, q in posts if a < b and p & q})
    assert sorted(tuple(r) for r in dedup.candidates(items, {"h": "h", "g": "g"}, 2, "k", block=block).collect()) == want


# F20
def test_a_writer_copies_no_batch(spark, tmp_path):
    """Files leave a batch one by one, and batches are small: a worker holds little, however many files a task writes."""
    text = b"0 0.5 0.5 0.1 0.1\n" * 10_000
    batch = pa.record_batch([pa.array([f"{i}.txt" for i in range(100)] + ["none.txt", "empty.txt"]), pa.array([text] * 100 + [None, b""], pa.binary())], names=["name", "content"])
    writer = single.SingleFileWriter(str(tmp_path / "staging"))
    tracemalloc.start()
    done = writer.write(iter([batch.slice(0, 0), batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done.files == 102 and (tmp_path / "staging" / done.folder.split("/")[-1] / "99").read_bytes() == text
    assert peak < batch.nbytes / 4
    before = spark.conf.get(single.BATCH[0])
    assert single.write_files(spark.createDataFrame([("a", "x"), ("b", None)], "name string, content string"), str(tmp_path / "out")) == 2
    assert spark.conf.get(single.BATCH[0]) == before and (tmp_path / "out" / "a").read_text() == "x" and (tmp_path / "out" / "b").read_bytes() == b""


# F21
def test_files_are_rewritten_in_one_reading(spark, tmp_path, monkeypatch):
    """Files are read once, by folder, and no line is shuffled; the result is the SQL's."""
    plans = []
    write = sinks.write_labels
    monkeypatch.setattr(sinks, "write_labels", lambda rows, root: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or write(rows, root))
    d, con = tables(tmp_path, lineitem=pq.read_table(f"{SF}/lineitem.parquet"), supplier=pq.read_table(f"{SF}/supplier.parquet"))
    same_rows(QUERIES["rewritten_label_files"](spark, d), con, ORACLE_SQL["rewritten_label_files"])
    assert plans[0].count("FileScan text") == 1 and "Exchange" not in plans[0]


def test_rewritten_files_are_as_by_lines(spark):
    texts = [("a", "0 1\n1 2\r\n\n0 3\n"), ("b", "0 1\n"), ("c", "1 1\r1 2"), ("d", ""), ("e", "\n\n"), ("f", "1 "), ("g", "11 2\n 1 2\n")]
    files = spark.createDataFrame(texts, "base string, text string")
    lines = files.select("base", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line_no", "line")).filter("line <> ''")
    want = {tuple(map(str, r)) for r in sinks.rewritten_labels(lines.filter("line not like '1 %'"), lines).collect()}
    got = {tuple(map(str, r)) for r in sinks.rewritten_files(files, lambda line: ~line.startswith("1 ")).collect()}
    assert got == want == {("a", "['0 1', '0 3']"), ("c", "[]"), ("f", "[]")}


# F5, F6
@pytest.mark.parametrize(("pass_rows", "core"), [(8, 2), (100, 7), (32_768, 512)])
def test_many_farthest_points_of_all_rows(spark, pass_rows, core):
    """However few rows a pass brings, the choice is that of one pass over everything; copies, and more points than differ."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((150, 5))
    x[100:120] = x[:20]
    x[120] = -x[5]
    df = spark.createDataFrame(list(enumerate(x.tolist())), "id long, v array<double>").repartition(3)
    for rows, k in ((df, 45), (df.filter("id < 10 or id between 100 and 109"), 15), (df.filter("id < 2"), 9), (df.limit(0), 3)):
        want = [tuple(r) for r in cluster.farthest_points(rows, k, "id", "v", pool_max=None).orderBy("ord").collect()]
        assert [tuple(r) for r in cluster.farthest_many(rows, k, "id", "v", pass_rows=pass_rows, core=core).orderBy("ord").collect()] == want


def test_groups_of_more_rows_than_a_pool(spark, tmp_path):
    """Representatives come out of all rows, and their number from all rows: 5,000 and 2,000 of them cut both."""
    x = np.random.default_rng(8).standard_normal((5_300, 6))
    x[2_600:] = x[:2_700]
    d, con = tables(tmp_path, embeddings=embeddings(x))
    assert "limit 2000" not in ORACLE_SQL["fps_pick"] + ORACLE_SQL["fps_totals"] and "limit 5000" not in ORACLE_SQL["fps_pick"] + ORACLE_SQL["fps_totals"]
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    df = spark.createDataFrame(list(enumerate(u.tolist())), "id long, v array<double>")
    reps = sorted(r.id for r in cluster.farthest_points(df, 1_590, "id", "v", pool_max=None).collect())
    sims = np.round(sum(np.outer(u[:, k], u[reps, k]) for k in range(6)), 12)
    near = {i: reps[s.argmax()] for i, s in enumerate(sims)}
    assert {r.vec_id: r.rep for r in QUERIES["fps_pick"](spark, d).select("vec_id", "rep").collect()} == near
    assert tuple(QUERIES["fps_totals"](spark, d).first()) == (len(set(near.values())), 5_300 - len(set(near.values())), 5_300)


# F1, F2, F3, F4
@pytest.mark.parametrize("large", [7, 64])
def test_blocks_where_bounds_rule_out_little(spark, large):
    """Vectors go out once a large block instead of once a shell; copies, ties and a missing direction as ever."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((200, 16))
    x[100:120] = x[:20]
    x[150] = 0
    df = spark.createDataFrame(list(enumerate(x.tolist())), "id long, v array<double>")
    plans, tiled = [], pivots._large_met
    pivots._large_met = lambda *a: plans.append(a) or tiled(*a)
    try:
        found = cluster.nearest(df, df.filter("id >= 60"), "id", "v", few=0, sends=0, large=large).collect()
    finally:
        pivots._large_met = tiled
    u = x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    sims = np.round(sum(np.outer(u[:, k], u[60:, k]) for k in range(16)), 12)
    assert len(plans) == 1 and {(r.id, r.rep, round(r.sim, 12) + 0.0) for r in found} == {(i, 60 + int(s.argmax()), s.max() + 0.0) for i, s in enumerate(sims)}


def test_copies_are_equal_wherever_they_stand():
    """A product of blocks may give copies other last bits; the smallest id of equal cosines is given all the same."""
    rng = np.random.default_rng(6)
    x, y = rng.standard_normal((50, 33)), rng.standard_normal((40, 33))
    y = np.repeat(y, 7, axis=0)[rng.permutation(280)]
    ids = rng.permutation(280)
    best, rep = np.full(50, -np.inf), np.zeros(50, np.int64)
    pivots.closest(x, y, ids, best, rep)
    sims = np.round(sum(np.outer(x[:, k], y[:, k]) for k in range(33)), 12)
    assert rep.tolist() == [min(ids[s == s.max()]) for s in sims] and best.tolist() == sims.max(axis=1).tolist()
