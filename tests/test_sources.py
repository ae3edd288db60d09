import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.functions import pixels
from boxlake.operators import parse, stats, validate as val
from boxlake.plans import runs
from boxlake.sources import actions, files, sinks
from boxlake.streaming import ingest, sessions


def png(w, h, value=0):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = b"".join(b"\0" + b"".join(bytes([value, (x * 7) % 256, 40]) for x in range(w)) for _ in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes(b"0 .1 .2 .3 .4\r\n1 .1 .2 .3 .4\r2 .1 .2 .3 .4")
    (tmp_path / "empty.TXT").write_bytes(b"")
    (tmp_path / "bad.txt").write_bytes(b"0 .1 .2 \xff .4\n")
    (tmp_path / "sub" / "b.txt").write_text("0 .5 .5 .5 .5\n")
    (tmp_path / "a.png").write_bytes(png(20, 10))
    (tmp_path / "broken.jpg").write_bytes(b"no image")
    return tmp_path


def test_listing_counts_empty_files(spark, folder):
    assert {r.name for r in files.listing(spark, str(folder), kind="label").collect()} == {"a.txt", "empty.TXT", "bad.txt"}
    assert files.listing(spark, str(folder), recursive=True, kind="label").count() == 4
    assert files.listing(spark, str(folder / "missing")).count() == 0
    assert [r.subdir for r in files.subdirectories(spark, str(folder)).collect()] == ["sub"]


def test_lines_and_counts(spark, folder):
    lines = files.label_lines(spark, str(folder), recursive=True)
    assert lines.filter("base = 'a'").count() == 3
    share = stats.class_share(parse.parse_labels(lines, parse.Variant.LENIENT_COUNT), files.listing(spark, str(folder), True, "label"), "d").collect()
    assert {r.total_txt_files for r in share} == {4} and sum(r["count"] for r in share) == 5


def test_image_headers(spark, folder):
    got = {r.path.rsplit("/", 1)[1]: (r.img_w, r.img_h, r.state) for r in files.image_sizes(files.contents(spark, str(folder)).filter("path like '%.png' or path like '%.jpg'")).collect()}
    assert got == {"a.png": (20, 10, "ok"), "broken.jpg": (None, None, "bad")}
    assert pixels.image_size(b"BM" + bytes(16) + struct.pack("<ii", 3, -4)) == (3, 4)
    assert pixels.image_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x05\x00\x06\x03") == (6, 5)
    assert pixels.image_size(b"") == (None, None)


def test_pixel_kernels(spark, folder):
    img = spark.read.format("image").load(str(folder / "a.png")).select("image.*")
    row = img.select(pixels.ahash_udf("height", "width", "data").alias("a"), pixels.phash_udf("height", "width", "data").alias("p"), pixels.signature_udf("height", "width", "data").alias("s"), pixels.feature_udf("height", "width", "data").alias("f"), pixels.thumbnail_udf("height", "width", "data").alias("t")).first()
    assert len(row.s) == 256 and len(row.f) == 5892 and len(row.t) == 1024
    assert abs(np.linalg.norm(row.f) - 1) < 1e-4
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (64, 64, 3), np.uint8)
    same = [pixels.perceptual_hash(pixels.prepared(y)) & (1 << 64) - 1 for y in (x, np.kron(x, np.ones((2, 2, 1), np.uint8)), rng.integers(0, 256, (64, 64, 3), np.uint8))]
    assert (same[0] ^ same[1]).bit_count() <= 8 < (same[0] ^ same[2]).bit_count()
    assert pixels.crop(x, 2, 3, 10, 5).shape == (2, 8, 3)
    assert pixels.edges(np.zeros((20, 20))).sum() == 0


def test_actions_are_dry_by_default(spark, folder):
    plan = spark.createDataFrame([("delete", f"{folder}/bad.txt", None), ("move", f"{folder}/a.txt", f"{folder}/to/a.txt"), ("copy", f"{folder}/sub/b.txt", f"{folder}/to/b.txt"), ("delete", f"{folder}/none", None)], sinks.ACTIONS)
    assert {r.result for r in sinks.apply_actions(plan).collect()} == {"dry"} and (folder / "bad.txt").exists()
    assert sorted(r.result for r in sinks.apply_actions(plan, dry_run=False).collect()) == ["gone", "ok", "ok", "ok"]
    assert not (folder / "bad.txt").exists() and (folder / "to" / "a.txt").exists() and (folder / "sub" / "b.txt").exists()
    assert sorted(r.result for r in sinks.apply_actions(plan, dry_run=False).collect()) == ["exists", "gone", "gone", "gone"]


def test_reviews_survive_a_rewrite(spark, tmp_path):
    path = str(tmp_path / "reviews")
    for status in (1, 2):
        sinks.save_reviews(spark.createDataFrame([("b c", status), ("a", 0)], "relkey string, status int"), path)
    assert [(r.relkey, r.status) for r in sinks.load_reviews(spark, path).collect()] == [("a", 0), ("b c", 2)]


def test_rewritten_labels(spark):
    original = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z"), ("c", 0, "w")], "base string, line_no int, line string")
    out = {r.base: r.lines for r in sinks.rewritten_labels(original.filter("line not in ('x', 'w')"), original).collect()}
    assert out == {"a": ["y"], "c": []}


def test_histogram_file(spark, tmp_path):
    hist = stats.histogram(spark.createDataFrame([(0, 0.1, 0.9)], "cls int, w double, h double"), 0.5)
    sinks.write_histogram({"bin_step": 0.5}, hist, str(tmp_path / "h"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "h")).collect()]
    assert lines[:4] == ["key,value", "bin_step,0.5", "", "metric,class_id,bin_lo,bin_hi,count"] and lines[4] == "area,ALL,0.0000,0.5000,1"


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("0 .1 .2 .3 .4\n1 .1 .2 .3 .4\n0 .1 .2 .3 .4\n")
    q = ingest.running_counts(ingest.label_stream(spark, str(src))).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.cls, r.n) for r in spark.table("counts").collect()} == {(0, 2), (1, 1)}


def test_review_upserts_are_idempotent(spark, tmp_path):
    merge = ingest.upsert_reviews(str(tmp_path / "r"))
    one = spark.createDataFrame([("a", 1), ("b", 1)], "relkey string, status int")
    two = spark.createDataFrame([("a", 0, 1), ("a", 2, 3), ("a", 1, 2)], "relkey string, status int, seq int")
    for batch, i in ((one, 0), (two, 1), (two, 1)):
        merge(batch, i)
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "r" / "v=1")).collect()} == {("a", 2), ("b", 1)}


def test_late_events_close_windows(spark, tmp_path):
    src = tmp_path / "e"
    spark.createDataFrame([("2024-01-01 00:05:00", "k"), ("2024-01-01 00:20:00", "k"), ("2024-01-01 03:00:00", "k")], "t string, k string").select(F.to_timestamp("t").alias("t"), "k").write.parquet(str(src))
    s = ingest.windowed_counts(spark.readStream.schema("t timestamp, k string").parquet(str(src)), "t", "k")
    q = s.writeStream.outputMode("append").format("memory").queryName("windows").start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.table("windows").collect()] == [2]


def plain_resized(image, size):
    """Area means, a target pixel at a time."""
    out = np.zeros((size, size))
    for a in range(size):
        for b in range(size):
            total = weight = 0.0
            for y in range(image.shape[0]):
                for x in range(image.shape[1]):
                    h = min((a + 1) * image.shape[0] / size, y + 1) - max(a * image.shape[0] / size, y)
                    w = min((b + 1) * image.shape[1] / size, x + 1) - max(b * image.shape[1] / size, x)
                    if h > 0 and w > 0:
                        total, weight = total + h * w * image[y, x], weight + h * w
            out[a, b] = total / weight
    return out


def test_kernels_have_the_values_of_their_definitions():
    rng = np.random.default_rng(2)
    g = rng.random((13, 9)) * 255
    assert np.allclose(pixels.resized(g, 8), plain_resized(g, 8))
    small = plain_resized(g, 8)
    want = sum(int(v > small.mean()) << (63 - i) for i, v in enumerate(small.ravel()))
    assert pixels.average_hash(g) & (1 << 64) - 1 == want
    wide = plain_resized(g, 32)
    dct = np.array([[sum(wide[y, x] * np.cos(np.pi * (2 * y + 1) * u / 64) * np.cos(np.pi * (2 * x + 1) * v / 64) for y in range(32) for x in range(32)) for v in range(8)] for u in range(8)])
    want = sum(int(v > np.median(dct)) << (63 - i) for i, v in enumerate(dct.ravel()))
    assert pixels.perceptual_hash(g) & (1 << 64) - 1 == want
    flat = np.full((6, 6, 3), 90, np.uint8)
    assert np.allclose(pixels.prepared(flat), 90) and pixels.gray(np.array([[[10, 20, 30]]], np.uint8))[0, 0] == pytest.approx(0.114 * 10 + 0.587 * 20 + 0.299 * 30)
    colors = pixels.color_histogram(np.array([[[0, 0, 255], [0, 0, 255], [255, 0, 0], [0, 255, 0]]], np.uint8), (6, 1, 1))
    assert colors.tolist() == [0.5, 0, 0.25, 0, 0.25, 0]
    step = np.zeros((96, 96, 3), np.uint8)
    step[:, 48:] = 200
    hog = pixels.gradients_histogram(step)
    assert np.linalg.norm(hog) == pytest.approx(1) and hog.shape == (11 * 11 * 36,) and set(np.flatnonzero(hog > 1e-9) % 9) <= {0, 8}
    line = pixels.edges(pixels.gray(step))
    assert line.any(axis=0).sum() in (1, 2) and line[:, 47:49].any(axis=1).all()
    signature = np.frombuffer(pixels.coarse_signature(step), np.uint8)
    assert signature[:64].reshape(8, 8)[:, 3:5].sum() > 0 == signature[:64].reshape(8, 8)[:, :3].sum() and signature[64:].sum() == 2 * 127
    assert np.allclose(np.linalg.norm(pixels.feature(step)), 1, atol=1e-5)


def test_scans_by_kind_are_sorted(spark, tmp_path):
    for name in ("b.JPG", "a.jpeg", "c.png", "d.bmp", "e.webp", "f.txt", "g"):
        (tmp_path / name).write_bytes(b"x")
    names = lambda kind: [r.base for r in files.listing(spark, str(tmp_path), kind=kind).collect()]
    assert (names("crop_source"), names("prediction"), names("review"), names("pose"), names("dedup")) == (list("abc"), list("bc"), list("abcde"), list("abcd"), list("abcde"))


def test_boxes_of_several_folders(spark, folder):
    assert files.label_boxes(spark, [str(folder), str(folder / "sub")]).count() == 4
    assert [r.cls for r in files.label_boxes(spark, [str(folder), str(folder / "sub")], [0, 7]).collect()] == [0, 0]


def test_review_files(spark, tmp_path):
    (tmp_path / "crop_valid.txt").write_text("d\\a.jpg 1\nd/b.jpg 7\nd/a.jpg 2\nshort\nd/c.jpg x\n")
    assert {tuple(r) for r in files.review_map(spark, str(tmp_path / "crop_valid.txt")).collect()} == {("d/a.jpg", 2), ("d/b.jpg", 0)}
    items = spark.createDataFrame([("d/a.jpg",), ("d/z.jpg",)], "relkey string")
    lines = parse.parse_reviews(files.ordered_lines(spark, str(tmp_path / "crop_valid.txt")), parse.StatusPolicy.LOAD)
    assert sorted((r.relkey, r.status) for r in val.with_status(items, lines).collect()) == [("d/a.jpg", 2), ("d/z.jpg", 0)]


def test_keypoint_and_skeleton_files(spark, tmp_path):
    (tmp_path / "index.txt").write_text("nose # tip\n\n left_eye \n")
    (tmp_path / "skeleton.txt").write_text("[nose, left_eye]\n junk [nose, left_eye] [left_eye,nose]")
    assert [tuple(r) for r in parse.parse_keypoint_index(files.whole_text(spark, str(tmp_path / "index.txt"))).collect()] == [(0, "nose", "tip"), (1, "left_eye", "")]
    assert [tuple(r) for r in parse.parse_skeleton(files.whole_text(spark, str(tmp_path / "skeleton.txt"))).collect()] == [(0, "nose", "left_eye"), (1, "left_eye", "nose")]


def test_crops_are_written_and_decode_to_their_pixels(spark, folder, tmp_path):
    images = files.decoded_images(spark, str(folder))
    assert [(r.base, r.width, r.height) for r in images.collect()] == [("a", 20, 10)]
    boxes = spark.createDataFrame([("a", 1, 0.5, 0.5, 0.5, 0.4), ("a", 1, 0.5, 0.5, 0.5, 0.4), ("a", 0, 0.1, 0.1, 0.0, 0.2), ("z", 0, 0.1, 0.1, 0.1, 0.2)], "base string, cls int, xc double, yc double, w double, h double")
    cut = sinks.crops(images, boxes)
    assert sinks.write_files(cut, str(tmp_path / "crops")) == 1
    (back,) = files.decoded_images(spark, str(tmp_path / "crops")).collect()
    whole = images.first()
    want = pixels.pixels(whole.height, whole.width, bytes(whole.data))[3:7, 5:15]
    assert back.base == "a_1_0.500000_0.500000_0.500000_0.400000" and (pixels.pixels(back.height, back.width, bytes(back.data)) == want).all()
    assert {p.name for p in (tmp_path / "crops").iterdir()} == {f"{back.base}.png"}  # no staging folder is left


def test_label_files_are_rewritten(spark, tmp_path):
    rewritten = spark.createDataFrame([("a", ["0 1", "1 2"]), ("c", [])], "base string, lines array<string>")
    assert sinks.write_labels(rewritten, str(tmp_path)) == 2
    assert (tmp_path / "a.txt").read_text() == "0 1\n1 2\n" and (tmp_path / "c.txt").read_bytes() == b""


def test_copies_trees_and_log(spark, folder, tmp_path):
    (folder / "classes.txt").write_text("x\n")
    targets = spark.createDataFrame([("a_0_0.1_0.1_0.1_0.1.jpg", 1), ("a_1_0.1_0.1_0.1_0.1.jpg", 2), ("q_1_0.1_0.1_0.1_0.1.jpg", 2), ("a_1_0.2_0.1_0.1_0.1.jpg", 0)], "crop_name string, status int")
    images = spark.createDataFrame([("a", ".png"), ("b", ".png")], "base string, ext string")
    plan = val.copy_plan(targets, images, files.listing(spark, str(folder), kind="label"), "/valid")
    done = sinks.apply_actions(sinks.actions(plan, f"{folder}/", str(tmp_path)), dry_run=False)
    assert {r.result for r in done.collect()} == {"ok"} and {p.name for p in (tmp_path / "valid").iterdir() if p.suffix != ".crc"} == {"a.png", "a.txt", "classes.txt"}
    trees = sinks.tree_plan(spark, [str(folder / "sub"), str(folder / "none")])
    assert [r.line[:5] for r in sinks.run_log(sinks.apply_actions(trees)).collect()] == ["[DRY]"] * 2 and (folder / "sub").exists()
    assert sinks.apply_actions(spark.createDataFrame([("delete", str(folder / "sub"), None)], sinks.ACTIONS), dry_run=False).first().result == "folder"
    log = [r.line for r in sinks.run_log(sinks.apply_actions(trees, dry_run=False)).collect()]
    assert log == [f"[MISS] rmtree: {folder}/none", f"[OK] rmtree: {folder}/sub"] and not (folder / "sub").exists()


def test_counts_file_and_report(spark, tmp_path):
    share = stats.class_share(spark.createDataFrame([(0,), (2,), (2,), (10,)], "cls int"), spark.range(3), "d")
    sinks.write_counts(share, str(tmp_path / "c"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "c")).collect()]
    assert lines[0] == "label_dir,total_txt_files,total_bboxes,class_id,count,ratio" and [x.split(",")[3] for x in lines[1:]] == ["0", "2", "10"]
    assert [r.line for r in stats.count_report(share).collect()] == ["label files: 3", "boxes: 4", "class 0: 1 (25.00%)", "class 2: 2 (50.00%)", "class 10: 1 (25.00%)"]


def test_histogram_run_tells_folders_apart(spark, tmp_path):
    train, test = tmp_path / "train", tmp_path / "val"
    for d in (train, test):
        d.mkdir()
        (d / "same.txt").write_text("0 .5 .5 .2 .4\n1 .5 .5 .6 .8\n")
    (train / "same.png").write_bytes(png(8, 8))
    (train / "same.bmp").write_bytes(b"shadowed by the other extension")
    (test / "same.jpg").write_bytes(b"not an image")
    (test / "alone.txt").write_text("0 .5 .5 .2 .4\n")
    (test / "alone.JPG").write_bytes(png(8, 8))
    (test / "void.txt").write_text("0 .5 .5 .2 .4\n")
    (test / "void.png").write_bytes(b"")
    run = runs.histogram_run(spark, [str(train), str(test)], 0.5, out=str(tmp_path / "out"))
    assert run.meta.first().asDict() == {"total_txt": 4, "missing_img": 1, "bad_img": 2, "total_boxes": 2}
    assert run.hist.filter("class_id = 'ALL'").agg(F.sum("count")).first()[0] == 6 and run.shown.count() == run.hist.count()
    assert (run.outlines.count(), run.centers.count()) == (2, 2) and runs.centers(files.label_boxes(spark, [str(train)]), 1).count() == 1
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()][1] == "bin_step,0.5"


@pytest.mark.parametrize(("exact", "near"), [(True, True), (True, False), (False, True), (False, False)])
def test_duplicates_in_two_stages(spark, tmp_path, exact, near):
    src = tmp_path / "img"
    (src / "sub").mkdir(parents=True)
    rng = np.random.default_rng(3)
    for name, seed in (("a", 0), ("c", 1)):
        image = np.kron(np.random.default_rng(seed).integers(0, 256, (6, 6, 3), np.uint8), np.ones((20, 20, 1), np.uint8))
        (src / f"{name}.png").write_bytes(pixels.png_bytes(image))
        if seed == 0:
            (src / "sub" / "copy.png").write_bytes(pixels.png_bytes(image))
            (src / "sub" / "near.png").write_bytes(pixels.png_bytes((image.astype(int) + rng.integers(0, 3, image.shape)).clip(0, 255).astype(np.uint8)))
    (src / "broken.png").write_bytes(b"x")
    (src / "empty.png").write_bytes(b"")
    got = {(r.stage, r.src.rsplit("/", 1)[1]): r.dst for r in runs.duplicate_run(spark, str(src), "/out", exact, near).collect()}
    want = {("exact", "copy.png")} if exact else set()
    want |= {("near", "near.png")} | ({("near", "copy.png")} if not exact else set()) if near else set()
    assert set(got) == want
    assert all(dst == f"/out/{stage}/group_000000/sub/{name}" for (stage, name), dst in got.items())


def test_listing_of_many_folders_by_tasks(spark, tmp_path, monkeypatch):
    want = set()
    for a in range(12):
        for b in range(5):
            d = tmp_path / f"a{a}" / f"b {b}"
            d.mkdir(parents=True)
            for c in range(6):
                (d / f"f{c}.txt").write_bytes(b"x" * (c % 3))
                want.add((f"a{a}/b {b}/f{c}.txt", c % 3))
    (tmp_path / "a0" / "loop").symlink_to(tmp_path)
    sent, make = [], spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, *a, **k: sent.extend(rows) or make(rows, *a, **k))
    got = files.listing(spark, [str(tmp_path), str(tmp_path / "a3")], recursive=True).collect()
    assert sent == [(f"file:{tmp_path}",), (f"file:{tmp_path / 'a3'}",)]  # the driver names the roots only
    assert [r.path for r in got] == sorted(r.path for r in got)
    assert {(r.path.removeprefix(f"file:{tmp_path}/"), r["size"]) for r in got} == want and len(got) == len(want)
    assert files.listing(spark, str(tmp_path)).count() == 0
    assert {r.path for r in files._by_driver(spark, [f"file:{tmp_path}/a1"], True).collect()} == {r.path for r in files._by_tasks(spark, [f"file:{tmp_path}/a1"], True).collect()}


def flaky(flag, at):
    """Acts, but fails the first attempt that comes to a certain source, after acting on it."""
    from pathlib import Path

    def act(op, src, dst):
        actions._act(op, src, dst)
        if src.endswith(at) and not Path(flag).exists():
            Path(flag).write_text("failed once")
            raise RuntimeError("a lost executor")

    return act


def plan_of(spark, tmp_path, n=40):
    src = tmp_path / "src"
    src.mkdir()
    rows = []
    for i in range(n):
        (src / f"{i}.txt").write_text(str(i))
        op = ("move", "copy", "delete")[i % 3]
        rows.append((op, f"{src}/{i}.txt", None if op == "delete" else f"{tmp_path}/dst/{i}.txt"))
    rows += [("move", f"{src}/none", f"{tmp_path}/dst/none"), ("copy", f"{src}/1.txt", f"{tmp_path}/dst/1.txt")]
    return spark.createDataFrame(rows, sinks.ACTIONS)


def test_a_failed_run_of_actions_is_finished(spark, tmp_path):
    plan, journal = plan_of(spark, tmp_path), str(tmp_path / "journal")
    with pytest.raises(Exception, match="lost executor"):
        actions.carried_out(plan, journal, per_bucket=8, act=flaky(tmp_path / "flag", "/21.txt"))
    done = actions.carried_out(plan, journal, per_bucket=8, act=flaky(tmp_path / "flag", "/21.txt"))
    assert {(r.src.rsplit("/", 1)[1], r.result) for r in done.collect()} == {(f"{i}.txt", "ok") for i in range(40)} | {("none", "gone")}
    assert sorted(int(p.stem) for p in (tmp_path / "dst").iterdir()) == [i for i in range(40) if i % 3 < 2]
    assert sorted(int(p.stem) for p in (tmp_path / "src").iterdir()) == [i for i in range(40) if i % 3 == 1]
    # With a journal of its own, the plan finds things as they are.
    again = {r.src.rsplit("/", 1)[1]: r.result for r in sinks.apply_actions(plan, dry_run=False).collect()}
    assert set(again.values()) == {"gone", "exists"} and again["1.txt"] == "exists"


def test_a_retried_task_acts_once(tmp_path):
    """In a session of its own, whose tasks are tried again."""
    import subprocess
    import sys
    from pathlib import Path

    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pathlib import Path
from pyspark.sql import SparkSession
from boxlake.sources import actions
from tests.test_sources import flaky, plan_of
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
tmp = Path({str(tmp_path)!r})
done = actions.carried_out(plan_of(spark, tmp), act=flaky(tmp / "flag", "/21.txt"), per_bucket=8).collect()
print("RESULTS", sorted(set(r.result for r in done)), len(done), (tmp / "flag").exists())
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300).stdout
    assert "RESULTS ['gone', 'ok'] 41 True" in out
    assert sorted(int(p.stem) for p in (tmp_path / "dst").iterdir()) == [i for i in range(40) if i % 3 < 2]


def test_targets_taken_by_others_stay(spark, tmp_path):
    for d in ("a", "b", "c"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x").write_text(d)
    plan = spark.createDataFrame([("move", f"{tmp_path}/{d}/x", f"{tmp_path}/to/x") for d in "abc"], sinks.ACTIONS)
    results = {r.src: r.result for r in sinks.apply_actions(plan, dry_run=False).collect()}
    assert results == {f"{tmp_path}/a/x": "ok", f"{tmp_path}/b/x": "exists", f"{tmp_path}/c/x": "exists"} and (tmp_path / "to" / "x").read_text() == "a"
    with pytest.raises(Exception, match="between stores"):
        actions.carried_out(spark.createDataFrame([("move", f"{tmp_path}/b/x", "s3://bucket/x")], sinks.ACTIONS))
    assert (tmp_path / "b" / "x").exists()
    with pytest.raises(Exception, match="tasks reach no"):
        actions.carried_out(spark.createDataFrame([("delete", "viewfs://x/y", None)], sinks.ACTIONS))


def test_single_files_appear_together(spark, tmp_path):
    rows = spark.range(50).select(F.concat(F.lit("d"), F.col("id") % 3, F.lit("/"), F.col("id"), F.lit(".bin")).alias("name"), F.when(F.col("id") != 7, F.col("id").cast("string")).alias("content"))
    assert sinks.write_files(rows.repartition(5), str(tmp_path / "out")) == 50
    assert {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*.bin")} == {f"d{i % 3}/{i}.bin": "" if i == 7 else str(i) for i in range(50)}
    fails = rows.withColumn("name", F.when(F.col("id") == 30, F.lit("../x")).otherwise(F.col("name")) if "id" in rows.columns else F.when(F.col("content") == "30", F.lit("../x")).otherwise(F.col("name")))
    with pytest.raises(Exception, match="not a name below the root"):
        sinks.write_files(fails, str(tmp_path / "none"))
    assert not list((tmp_path / "none").rglob("*.bin")) and not list((tmp_path / "none").glob(".staging*"))
    assert sinks.write_files(rows.limit(0), str(tmp_path / "out")) == 0
    # Writing again replaces files, whoever wrote them.
    spark.createDataFrame([("x",)], "value string").coalesce(1).write.text(str(tmp_path / "t"))
    (part,) = (tmp_path / "t").glob("part-*")
    assert sinks.write_files(spark.createDataFrame([(part.name, "other")], "name string, content string"), str(tmp_path / "t")) == 1
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["other"]


def test_signatures_of_one_image_at_two_sizes():
    rng = np.random.default_rng(8)
    small = pixels.resized(rng.integers(0, 256, (12, 12, 3)), 128)
    large = np.kron(small, np.ones((6, 6, 1))).astype(np.uint8)
    a, b = (np.frombuffer(pixels.coarse_signature(x), np.uint8).astype(int) for x in (small.astype(np.uint8), large))
    assert np.abs(a - b).max() <= 2 and np.allclose(pixels.color_histogram(pixels.resized(large, 128)), pixels.color_histogram(small.astype(np.uint8)), atol=0.01)


@pytest.mark.parametrize("one", [True, False])
def test_replayed_sessions_save_what_the_batch_query_says(spark, tmp_path, one):
    rng = np.random.default_rng(31)
    rows = [(0 if one else int(rng.integers(0, 7)), i, str(rng.choice(["set", "set", "set", "next", "jump", "close"], p=[0.3, 0.3, 0.3, 0.05, 0.03, 0.02])), f"k{rng.integers(0, 20)}", int(rng.integers(0, 3))) for i in range(400)]
    rows += [(8, 400, "set", "never saved", 1), (9, 401, "close", None, None)]
    kind = "session long, seq long, action string, relkey string, status int"
    src = tmp_path / "events"
    for k in range(0, len(rows), 67):
        spark.createDataFrame(rows[k : k + 67], kind).repartition(2).write.mode("append").parquet(str(src / f"b={k:04d}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", sessions.PROVIDER)
    whole = tmp_path / "in"
    whole.mkdir()
    try:
        for k in range(0, len(rows), 67):  # one batch after another, each with the state that the one before left
            for f in sorted((src / f"b={k:04d}").glob("part-*.parquet")):
                (whole / f.name).write_bytes(f.read_bytes())
            out = sessions.saved_reviews(spark.readStream.schema(kind).parquet(str(whole)))
            query = out.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "saved")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    saved = spark.read.parquet(str(tmp_path / "saved"))
    got = saved.groupBy("session", "relkey").agg(F.max_by("status", "seq").alias("status"))
    want = val.saved_status(spark.createDataFrame(rows, kind), session="session")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() >= 15
    if one:
        plain = val.saved_status(spark.createDataFrame(rows[:400], kind))
        assert {(r.relkey, r.status) for r in plain.collect()} == {(r.relkey, r.status) for r in got.collect()}
    assert saved.filter("saved_at <= seq").count() == 0 and saved.filter("relkey = 'never saved'").count() == 0
