import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boxlake.operators import cluster, dedup, geometry as geo, joins, pivots, pose, sampling, stats, validate as val
from boxlake.operators.graph import connected_components
from boxlake.plans.fixtures import view
from boxlake.plans.queries import QUERIES
from tests.conftest import SF


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("x", "step", "b"), [(0.0, 0.02, 0), (1 - 1e-13, 0.02, 49), (1.0, 0.02, 49), (1.2, 0.1, 9), (-0.1, 0.02, 0), (0.06, 0.02, 3), (0.58, 0.02, int(0.58 / 0.02)), (0.95, 0.3, 3)])
def test_bins(spark, x, step, b):
    assert value(spark, geo.bin_index(F.lit(x), step)) == b


def test_last_edge_is_one(spark):
    assert value(spark, geo.bin_hi(F.lit(3), 0.3)) == 1.0
    assert value(spark, geo.clamp(F.lit(float("nan")))) is None


def test_conventions_differ_on_halves(spark):
    df = spark.createDataFrame([(0.25, 0.25, 0.5, 0.5, 10, 6), (0.9, 0.9, 0.4, 0.4, 10, 10)], "xc double, yc double, w double, h double, img_w int, img_h int")
    rows = lambda c, k=1.0: [tuple(r) for r in df.select(*[v.alias(n) for n, v in geo.to_pixels(c, k).items()]).collect()]
    assert rows(geo.Pixels.CROP)[1][2:] == (10, 10)
    assert rows(geo.Pixels.POSE)[1][2:] == (9, 9)
    assert rows(geo.Pixels.REVIEW)[0] == (0, 0, 5, 3)
    assert rows(geo.Pixels.SCALED, 1.5)[0] == (0, 0, 6, 4)


def test_keypoint_colors(spark):
    for v, ring, chip in ((1.6, "green", "blue"), (3.0, "green", "red"), (0.0, "red", "red"), (2.0, "green", "green")):
        c = geo.keypoint_colors(F.lit(v))
        assert (value(spark, c["ring"]), value(spark, c["chip"])) == (ring, chip)


def test_histogram_invariants(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.random() * 1.1, rng.random()) for _ in range(500)]
    hist = stats.histogram(spark.createDataFrame(rows, "cls int, w double, h double"), 0.1).collect()
    for m in stats.METRICS:
        total = [r["count"] for r in sorted((r for r in hist if r.metric == m and r.class_id == "ALL"), key=lambda r: r.bin)]
        parts = [sum(r["count"] for r in hist if r.metric == m and r.class_id != "ALL" and r.bin == b) for b in range(10)]
        assert total == parts and sum(total) == 500


def test_width_and_height_are_told_apart(spark):
    hist = stats.histogram(spark.createDataFrame([(0, 0.15, 0.85)], "cls int, w double, h double"), 0.1)
    full = {(r.metric, r.bin) for r in hist.filter("count > 0 and class_id = 'ALL'").collect()}
    assert full == {("area", 1), ("width", 1), ("height", 8)}


def test_empty_histogram_has_listed_classes(spark):
    hist = stats.histogram(spark.createDataFrame([], "cls int, w double, h double"), 0.5, [4])
    assert hist.count() == 12 and hist.agg(F.sum("count")).first()[0] == 0


def test_known_shares(spark):
    counts = {0: 105154, 1: 258675, 2: 17931}
    labels = spark.createDataFrame(list(counts.items()), "cls int, k int").select(F.explode(F.array_repeat("cls", F.col("k"))).alias("cls"))
    got = {r.class_id: r.ratio for r in stats.class_share(labels, spark.range(49510), "d").collect()}
    assert got == {"0": 0.27544530595138306, "1": 0.6775853939647947, "2": 0.046969300083822295}


def test_priority(spark):
    df = spark.createDataFrame([("a", ".png", 2), ("a", ".jpg", 0), ("b", ".bmp", 3)], "base string, ext string, prio int")
    assert {tuple(r) for r in joins.by_priority(df).collect()} == {("a", ".jpg", ".png"), ("b", ".bmp", ".bmp")}


def test_class_three_has_a_range_of_its_own(spark):
    df = spark.createDataFrame([("d", f"i_{c}_0.1_0.1_0.1_0.1.jpg") for c in (3, 0, 2, 7)], "pred_dir string, crop_name string")
    assert [(r.ord, r.pos, r.group_start, r.group_count) for r in val.review_order(df).orderBy("pos").collect()] == [(0, 0, 0, 1), (2, 1, 1, 1), (3, 2, 2, 1), (9, 3, 3, 1)]


def test_delete_removes_every_equal_box(spark):
    box = "base string, cls int, xc double, yc double, w double, h double"
    labels = spark.createDataFrame([("a", 0, 0.9, 0.5, 0.1, 0.1), ("a", 0, 0.9 - 1e-12, 0.5, 0.1, 0.1), ("a", 1, 0.9, 0.5, 0.1, 0.1), ("b", 0, 0.9, 0.5, 0.1, 0.1)], box)
    left = val.delete_matches(labels, spark.createDataFrame([("a", 0, 0.9000001, 0.5, 0.1, 0.1)], box))
    assert {(r.base, r.cls) for r in left.collect()} == {("a", 1), ("b", 0)}


def test_routing_loses_nothing(spark):
    names = ["x/i_0_0.1_0.1_0.1_0.1.jpg", "y/i_0_0.1_0.1_0.1_0.1.jpg", "x/i_3_0.1_0.1_0.1_0.1.jpg", "x/readme.md", "x/bad.jpg", "crop_valid.txt"]
    plan = {r.relkey: (r.op, r.dst) for r in val.route_plan(spark.createDataFrame([(n,) for n in names], "relkey string")).collect()}
    assert plan == {names[0]: ("move", "O_Person/i_0_0.1_0.1_0.1_0.1.jpg"), names[1]: ("move", "O_Person/i_0_0.1_0.1_0.1_0.1_dup1.jpg"), names[2]: ("skip_unknown", None), names[3]: ("skip_nonimg", None), names[4]: ("skip_parse", None)}


def test_every_crop_has_a_route(spark):
    crops = sorted(f"{r.pred_dir}/{r.crop_name}" for r in view(spark, SF, "v_crops").collect())
    assert sorted(r.relkey for r in QUERIES["route_all_plan"](spark, SF).collect()) == crops
    assert sum(r.n for r in QUERIES["route_all_totals"](spark, SF).collect()) == len(crops)
    print(len(crops), QUERIES["route_plan"](spark, SF).count())


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25))
def test_components(spark, pairs):
    parent = list(range(31))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(pairs, "u long, v long")
    for most in (0, 1000):
        got = {r.node: r.component for r in connected_components(df, "u", "v", task_edges=most).collect()}
        assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}


def test_long_path_is_one_component(spark):
    got = connected_components(spark.range(200).selectExpr("id as u", "id + 1 as v"), "u", "v", task_edges=0)
    assert got.count() == 201 and got.agg(F.max("component")).first()[0] == 0


def test_bucket_cap_is_a_choice(spark):
    df = spark.createDataFrame([(i, [1, 0], [i % 2, 1]) for i in range(5)], "k long, a array<int>, p array<int>")
    every = dedup.candidates(df, {"a": "a"}, 2, "k").count()
    assert every == 10 and dedup.candidates(df, {"a": "a"}, 2, "k", cap=3).count() == 3
    assert dedup.bucket_report(df, {"a": "a"}, 2, "k", 3).count() == 2


def test_unreadable_files_are_groups_of_their_own(spark):
    df = spark.createDataFrame([("b", b"x"), ("a", b"x"), ("c", None), ("d", None)], "path string, content binary")
    assert {(r.keep, r.part, tuple(r.dups)) for r in dedup.exact_groups(df, F.col("content")).collect()} == {("a", 0, ("b",)), ("c", 0, ()), ("d", 0, ())}


def test_large_groups_come_in_parts(spark):
    df = spark.range(57).select(F.format_string("p%02d", "id").alias("path"), F.when(F.col("id") < 45, "x").otherwise(F.col("id").cast("string")).cast("binary").alias("content")).repartition(5)
    got = sorted((r.keep, r.part, tuple(r.dups)) for r in dedup.exact_groups(df, F.col("content"), most=10).collect())
    assert got[:5] == [("p00", k, tuple(f"p{i:02d}" for i in range(10 * k + 1, min(10 * k + 11, 45)))) for k in range(5)] and got[5:] == [(f"p{i}", 0, ()) for i in range(45, 57)]
    assert dedup.exact_groups(df.limit(0), F.col("content")).count() == 0


def test_small_k_bounds(spark):
    r = cluster.k_estimate(spark.createDataFrame([(1, "s")], "id long, s string"), F.col("s"), "id").first()
    assert (r.k, r.min_k, r.max_k) == (2, 2, 1)


def test_farthest_points_are_distinct_and_cover(spark):
    rows = [(i, [float(i % 4 == j) for j in range(4)]) for i in range(40)]
    picked = [r.id for r in cluster.farthest_points(spark.createDataFrame(rows, "id long, v array<double>"), 4, "id", "v").orderBy("ord").collect()]
    assert len({i % 4 for i in picked}) == 4
    assert cluster.farthest_points(spark.createDataFrame(rows[:3], "id long, v array<double>"), 9, "id", "v").count() == 3


def test_nearest_and_best_member(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.9, 0.1]), (3, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    a = cluster.nearest(df, df.filter("id < 2"), "id", "v")
    assert {(r.id, r.rep) for r in a.collect()} == {(0, 0), (1, 1), (2, 0), (3, 0)}
    assert {r.id for r in cluster.pick_best(a, "id").filter("role = 'rep'").collect()} == {0, 1}


def test_groups_of_chosen_representatives(spark, tmp_path):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((60, 8))
    spark.createDataFrame([(100 + i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    reps = sorted(r.vec_id for r in QUERIES["fps_reps"](spark, str(tmp_path)).collect())
    assert len(set(reps)) == 18  # three tenths of 60 different vectors
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    sims = {100 + i: {r: round(float(u[i] @ u[r - 100]), 12) for r in reps} for i in range(60)}
    near = {i: min(reps, key=lambda r: (-s[r], r)) for i, s in sims.items()}
    assert {r.vec_id: r.rep for r in QUERIES["fps_nearest"](spark, str(tmp_path)).collect()} == near
    best = {r: min((i for i in near if near[i] == r), key=lambda i: (-sims[i][r], i)) for r in set(near.values())}
    assert {(r.rep, r.vec_id, r.role) for r in QUERIES["fps_pick"](spark, str(tmp_path)).collect()} == {(r, i, "rep" if best[r] == i else "dup") for i, r in near.items()}
    assert tuple(QUERIES["fps_totals"](spark, str(tmp_path)).first()) == (18, 42, 60)


def test_clashing_names_get_suffixes(spark):
    df = spark.createDataFrame([(1, "a.jpg", "x/a.jpg"), (1, "a.jpg", "y/a.jpg"), (2, "a.jpg", "z/a.jpg")], "g int, name string, path string")
    assert [r.dst_name for r in cluster.clash_free(df, "g", "name", "path").orderBy("path").collect()] == ["a.jpg", "a_dup1.jpg", "a.jpg"]


def test_absent_keypoints(spark):
    objects = spark.createDataFrame([("i", 0, 0, 50, 50, 100, 100)], "base string, x1 int, y1 int, x2 int, y2 int, img_w int, img_h int")
    kpts = spark.createDataFrame([("i", 0, 0.1, 0.1, 2), ("i", 1, 0.9, 0.1, 2)], "base string, kpt_idx int, kx double, ky double, v int")
    index = spark.createDataFrame([(0, "a", ""), (1, "b", ""), (2, "c", "")], "idx int, name string, comment string")
    rows = {r["idx"]: (r.v, r.visible) for r in pose.points(objects, kpts, index).collect()}
    assert rows == {0: (2, True), 1: (2, False), 2: (0, False)}


def test_routes_pass_names_that_are_taken(spark):
    crop = "i_0_0.1_0.1_0.1_0.1"
    rows = spark.createDataFrame([(f"{d}/{crop}.jpg",) for d in "abc"] + [("a/notes.md",), ("a/x.jpg",), ("a/i_9_0.1_0.1_0.1_0.1.jpg",), ("a/crop_valid.txt",)], "relkey string")
    there = spark.createDataFrame([(f"O_Person/{crop}.jpg",), (f"O_Person/{crop}_dup2.jpg",), (f"O_Bike/{crop}.jpg",)], "dst string")
    plan = {r.relkey: (r.op, r.dst) for r in val.route_plan(rows, there).collect()}
    assert [plan[f"{d}/{crop}.jpg"][1] for d in "abc"] == [f"O_Person/{crop}_dup{k}.jpg" for k in (1, 3, 4)]
    assert {plan[k][0] for k in plan if not k.endswith(f"{crop}.jpg")} == {"skip_nonimg", "skip_parse", "skip_unknown"} and len(plan) == 6
    free = {r.relkey: r.dst for r in val.route_plan(rows).collect()}
    assert [free[f"{d}/{crop}.jpg"] for d in "abc"] == [f"O_Person/{crop}.jpg", f"O_Person/{crop}_dup1.jpg", f"O_Person/{crop}_dup2.jpg"]


def test_positions_in_a_total_order(spark):
    rows = [(int(k),) for k in np.random.default_rng(1).permutation(2000)]
    from boxlake.operators.order import numbered

    out = numbered(spark.createDataFrame(rows, "k long").repartition(7), "k").collect()
    assert len(out) == 2000 and all(r.k == r.pos for r in out)
    assert numbered(spark.createDataFrame([], "k long"), "k").count() == 0


def plain_farthest(vectors, first, k):
    """Each time the point whose best cosine to those chosen is lowest; the first of equal ones."""
    unit = [np.array(v) / max(np.linalg.norm(v), 1e-12) for v in vectors]
    chosen = [first]
    while len(chosen) < min(k, len(unit)):
        best = [max(float(u @ unit[c]) for c in chosen) for u in unit]
        chosen.append(int(np.argmin(best)))
    return chosen


def test_farthest_points_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    first = df.orderBy(sampling.draw(F.col("id"), 12345)).first().id
    got = [r.id for r in cluster.farthest_points(df, 12, "id", "v").orderBy("ord").collect()]
    assert got == plain_farthest([v for _, v in rows], first, 12)
    pool = {r.id for r in cluster.sample_exact(df, 20, F.col("id"), 12345).collect()}
    assert {r.id for r in cluster.farthest_points(df, 99, "id", "v", pool_max=20).collect()} == pool and len(pool) == 20


def test_samples_are_the_smallest_hashes(spark):
    df = spark.range(500)
    hashes = sorted((r.h, r.id) for r in df.select("id", sampling.draw(F.col("id"), 7).alias("h")).collect())
    assert {r.id for r in cluster.sample_exact(df.repartition(5), 40, F.col("id"), 7).collect()} == {i for _, i in hashes[:40]}
    assert cluster.sample_exact(df, 1000, F.col("id")).count() == 500
    items = df.withColumn("s", F.col("id") % 30)
    hashes = sorted((r.h, r.id) for r in df.select("id", sampling.draw(F.col("id"), 12345).alias("h")).collect())
    uniq = len({i % 30 for _, i in hashes[:100]})
    r = cluster.k_estimate(items, F.col("s"), "id", sample_max=100).first()
    assert (r.n, r.sample_n, r.uniq, r.k) == (500, 100, uniq, max(50, min(150, round(uniq / 100 * 500))))


def test_candidates_within_a_cap(spark):
    items = spark.createDataFrame([(i, [0, 0, i % 2, 1]) for i in range(6)], "k long, h array<int>")
    pairs = lambda cap: {tuple(r) for r in dedup.candidates(items, {"h": "h"}, 2, "k", cap).collect()}
    assert pairs(None) == {(a, b) for a in range(6) for b in range(a + 1, 6)}
    assert pairs(2) == {(0, 1), (0, 2), (1, 3)}


def test_review_batches_and_thresholds(spark):
    items = spark.createDataFrame([(0, [0, 0, 0, 0], [0, 0, 0, 0], [0.0]), (1, [1, 1, 0, 0], [1, 0, 0, 0], [0.0]), (2, [1, 1, 1, 1], [1, 1, 1, 0], [0.0])], "k long, a array<int>, p array<int>, v array<double>")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a long, b long")
    near = lambda bits: {tuple(r) for r in dedup.near_pairs(items, pairs, "a", "p", "v", "k", bits, 0.0).collect()}
    assert (near((0, 1)), near((2, 0)), near(2)) == ({(0, 1)}, {(0, 1), (1, 2)}, {(0, 1), (1, 2)})


def test_an_empty_crop_has_its_state(spark):
    images = spark.createDataFrame([("a", 0, 5), ("b", 9, 9), ("c", 9, 9), ("d", 9, 9)], "base string, img_w int, img_h int")
    objects = spark.createDataFrame([("a", 0, 0, 0, 3, 3), ("b", 0, 4, 4, 2, 5), ("c", 0, 1, 1, 3, 3)], "base string, ord int, x1 int, y1 int, x2 int, y2 int")
    assert {r.base: r.state for r in pose.crop_state(images, objects).collect()} == {"a": "Empty Crop", "b": "Invalid BBox", "c": "ok", "d": "No Objects Found"}


@pytest.mark.parametrize("block", [1024, 4])
def test_links_by_blocks_connect_what_pairs_connect(spark, block):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(0, 2, 16).tolist() if i % 3 else [1] * 15 + [i % 2], rng.integers(0, 2, 16).tolist(), (rng.integers(0, 3, 4) / 2).tolist()) for i in range(60)]
    items = spark.createDataFrame(rows, "k long, a array<int>, p array<int>, v array<double>")
    pairs = dedup.near_pairs(items, dedup.candidates(items, {"a": "a", "p": "p"}, 4, "k"), "a", "p", "v", "k", (5, 3), 0.2)
    links = dedup.near_links(items, {"a": "a", "p": "p"}, 4, "v", "k", (5, 3), 0.2, block)
    want = {tuple(r) for r in dedup.near_members(pairs).collect()}
    assert {tuple(r) for r in dedup.near_members(links).collect()} == want and len({c for _, c in want}) > 1
    tiled = dedup.near_pairs_by_tiles(items, {"a": "a", "p": "p"}, 4, "v", "k", (5, 3), 0.2, block)
    assert sorted(map(tuple, tiled.collect())) == sorted(map(tuple, pairs.collect()))
    assert dedup.near_members(dedup.near_links(items.limit(0), {"a": "a", "p": "p"}, 4, "v", "k", 5, 0.2)).count() == 0


def test_samples_take_some_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 30 + [(1, "b")] * 5 + [(None, "c")] * 4, "k long, v string").repartition(4)
    for n in (0, 1, 7, 33, 38, 39, 50):
        got = cluster.sample_exact(df, n, F.col("k")).collect()
        assert len(got) == min(n, 39)
        want = sorted(df.select(sampling.draw(F.col("k"), 1).alias("h")).collect())[:n]
        assert sorted(r.h for r in spark.createDataFrame(got, df.schema).select(sampling.draw(F.col("k"), 1).alias("h")).collect()) == [r.h for r in want]
    assert cluster.sample_exact(df, None, F.col("k")).count() == 39 and cluster.sample_exact(df.limit(0), 3, F.col("k")).count() == 0
    plan = cluster.k_estimate(df, F.col("v"), "k", sample_max=10)._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "NestedLoop" not in plan


def plain_nearest(items, reps):
    unit = lambda v: np.array(v) / (np.linalg.norm(v) if np.linalg.norm(v) >= 1e-12 else 1.0)
    sims = np.round(np.array([unit(v) for _, v in items]) @ np.array([unit(v) for _, v in sorted(reps)]).T, 12) + 0.0
    return sorted((i, sorted(reps)[k][0], s) for (i, _), k, s in zip(items, sims.argmax(axis=1), sims.max(axis=1), strict=True))


@pytest.mark.parametrize(("block", "tile", "pivot_count", "few"), [(2048, 4096, 64, 2048), (2048, 4096, 64, 0), (3, 5, 4, 0), (7, 50, 1, 0)])
def test_nearest_equals_all_pairs(spark, block, tile, pivot_count, few):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((6, 10))
    rows = [(i, (centres[i % 6] + rng.standard_normal(10) * 0.2).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(300, [0.0] * 10), (301, [-x for x in rows[3][1]]), (302, [2 * x for x in rows[3][1]])]
    odd = [(None, rows[0][1]), (400, None), (401, [None] * 10), (402, [float("nan")] * 10)]
    kind = "id long, v array<double>"
    items = spark.createDataFrame(rows + odd, kind).withColumn("rep", F.lit(1)).withColumn("shell", F.lit("x"))
    for reps in (rows[:60], [*rows[:20], (250, rows[5][1]), (300, [0.0] * 10)], [(300, [0.0] * 10)], [(7, rows[3][1]), (8, rows[3][1])]):
        found = cluster.nearest(items, spark.createDataFrame([*reps, *odd], kind), "id", "v", few=few, pivots=pivot_count, block=block, tile=tile)
        assert sorted((r.id, r.rep, round(r.sim, 9) + 0.0) for r in found.collect()) == [(i, k, round(s, 9) + 0.0) for i, k, s in plain_nearest(rows, reps)]
    assert cluster.nearest(items, spark.createDataFrame([], kind), "id", "v").count() == 0
    assert cluster.nearest(items.limit(0), items, "id", "v").count() == 0


def test_bounds_skip_most_pairs(spark):
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((40, 16))
    rows = [(i, (centres[i % 40] + rng.standard_normal(16) * 0.05).tolist()) for i in range(2000)]
    items = spark.createDataFrame(rows, "id long, v array<double>")
    found = cluster.nearest(items, items.filter("id < 800"), "id", "v", few=0)
    assert pivots.share_computed(found, 800) < 0.1
    assert sorted((r.id, r.rep) for r in found.collect()) == [(i, k) for i, k, _ in plain_nearest(rows, rows[:800])]


def test_no_task_meets_all_pairs(spark, capfd):
    items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "id long, v array<double>")
    shells, plans = pivots._met, []
    pivots._met = lambda *a: plans.append(shells(*a)._jdf.queryExecution().toString()) or shells(*a)
    try:
        cluster.nearest(items, items, "id", "v", few=0).collect()
    finally:
        pivots._met = shells
    assert plans and not any("Cartesian" in p or "NestedLoop" in p for p in plans)


@pytest.mark.parametrize("group_rows", [40, 100])
def test_covers_of_whole_tables(spark, group_rows):
    rng = np.random.default_rng(13)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(400)] + [(500, None), (501, [float("inf")] * 3)] + [(600, [1.0, 2.0, 3.0])] * 30
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    good = [v for _, v in rows if v is not None and np.isfinite(v).all()]
    unit = np.array(good) / np.linalg.norm(good, axis=1)[:, None]
    reach = lambda chosen: np.arccos(np.clip((unit @ chosen.T).max(axis=1), -1, 1)).max()
    at = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v is not None}
    got = [r.id for r in cluster.farthest_cover(df, 10, "id", "v", group_rows=group_rows).orderBy("ord").collect()]
    assert len(set(got)) == 10
    plain = reach(unit[plain_farthest(good, 0, 10)])
    rounds = 3 if group_rows == 100 else 6
    assert reach(np.array([at[i] for i in got])) <= 2 * rounds * plain  # and far below it in fact
    assert reach(np.array([at[i] for i in got])) <= 2 * plain
    whole = [r.id for r in cluster.farthest_cover(df, 10, "id", "v").orderBy("ord").collect()]
    assert whole == [r.id for r in cluster.farthest_points(df, 10, "id", "v", pool_max=None).orderBy("ord").collect()]
    assert cluster.farthest_cover(df.limit(0), 3, "id", "v").count() == 0 and cluster.farthest_cover(df.filter("id < 2"), 9, "id", "v").count() == 2
    with pytest.raises(ValueError):
        cluster.farthest_cover(df, 11, "id", "v", group_rows=40)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 11, 12])
def test_hamming_join_misses_no_pair(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    rows = []
    for i in range(300):
        h = int(base[i % 12])
        for b in rng.choice(64, int(rng.integers(0, 9)), replace=False):
            h ^= 1 << int(b)
        rows.append((i, h - (1 << 64) if h >> 63 else h))
    rows += [(300 + i, -1) for i in range(40)] + [(400, 0), (401, (1 << 11) - 1), (402, (1 << 12) - 1), (403, -(1 << 53))]
    df = spark.createDataFrame(rows + [(None, 1), (500, None)], "id long, h long").withColumn("k", F.lit(1)).repartition(3)
    by = {}
    for i, h in rows:
        by.setdefault(h, []).append(i)
    classes = sorted((min(v), h, len(v)) for h, v in by.items())
    far = lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count()
    want = sorted((a, b, far(x, y), n, m) for k, (a, x, n) in enumerate(classes) for b, y, m in classes[k + 1 :] if far(x, y) <= radius)
    assert sorted(map(tuple, dedup.hamming_join(df, "id", "h", radius).collect())) == want
    assert sum(dedup.piece_limits(radius, 4)) + 4 == radius + 1
    if radius == 11:
        links = {r.id: (r.rep, r.n_links) for r in dedup.hamming_links(df, "id", "h", radius).collect()}
        assert links == {i: (min(by[h]), sum(far(h, g) <= radius for _, g in rows) - 1) for i, h in rows} and len(want) > 100
        assert dedup.hamming_join(df.limit(0), "id", "h", radius).count() == 0


def test_vectors_move_only_for_pairs_that_pass(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [0] * 8 + rng.integers(0, 2, 56).tolist(), [0] * 8 + rng.integers(0, 2, 56).tolist(), rng.random(4).tolist()) for i in range(200)]
    rows += [(200 + i, rows[i][1], rows[i][2], rows[i][3]) for i in range(5)]
    items = spark.createDataFrame(rows, "k long, a array<int>, p array<int>, v array<double>")
    moved, kept = [], dedup.written
    dedup.written = lambda df, label: moved.append(kept(df, label)) or moved[-1]
    try:
        links = dedup.near_links(items, {"a": "a", "p": "p"}, 8, "v", "k", (5, 5), 0.01, 64)
        assert {(r.a, r.b) for r in links.collect()} == {(200 + i, i) for i in range(5)}
    finally:
        dedup.written = kept
    assert moved[0].count() == 10  # of 205 rows in one hot bucket, and of 16 buckets for each copy
