"""File listings and text of annotation folders.

Spark's readers leave out zero-byte files, so inventories come from listings that tasks make; contents come from Spark's own
readers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions import grammar as G
from boxlake.operators import parse
from boxlake.session import written
from boxlake.sources.store import reachable, store

#: Image extensions by kind of scan.
EXTENSIONS = {
    "label": (".txt",),
    "crop_source": (".jpg", ".jpeg", ".png"),
    "prediction": (".jpg", ".png"),
    "review": (".jpg", ".jpeg", ".png", ".bmp", ".webp"),
    "pose": (".jpg", ".jpeg", ".png", ".bmp"),
    "dedup": (".jpg", ".jpeg", ".png", ".bmp", ".webp"),
}
SCHEMA = "path string, name string, size long"


def listing(spark: SparkSession, roots: list[str] | str, recursive: bool = False, kind: str | None = None) -> DataFrame:
    """(path, name, size, dir, base, ext) of every file by path, empty ones too, flat or recursive; ``kind`` keeps its extensions.

    Tasks list folders, a level of the tree a job: what a folder holds is written as it is found, folders among it are the
    next level's rows, and no name passes through the driver. Nothing is opened. Missing folders give no rows; links to
    folders are not followed. For a store that tasks don't reach (``store.SCHEMES``) the driver asks Hadoop instead.
    """
    roots = [qualified(spark, r) for r in ([roots] if isinstance(roots, str) else roots)]
    out = _by_tasks(spark, roots, recursive) if all(map(reachable, roots)) else _by_driver(spark, roots, recursive)
    out = out.withColumns({"dir": parent(F.col("path")), "base": G.stem(F.col("name")), "ext": G.extension(F.col("name"))})
    return (out.filter(F.col("ext").isin(*EXTENSIONS[kind])) if kind else out).orderBy("path")


def _entries(batches: Iterator[pa.RecordBatch], most: int = 10_000) -> Iterator[pa.RecordBatch]:
    """(path, name, size, folder) of what the folders hold, ``most`` at a time."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            found = store(folder).entries(folder)
            while part := [(f"{folder.rstrip('/')}/{name}", name, size, deep) for name, size, deep in islice(found, most)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), (pa.string(), pa.string(), pa.int64(), pa.bool_()), strict=True)], names=["path", "name", "size", "folder"])


def _by_tasks(spark: SparkSession, roots: list[str], recursive: bool) -> DataFrame:
    folders = spark.createDataFrame([(r,) for r in dict.fromkeys(roots)], "path string").repartition(max(1, min(len(roots), 1000)))
    out = None
    while True:
        level = written(folders.mapInArrow(_entries, SCHEMA + ", folder boolean"), "listing")
        files = level.filter("not folder").drop("folder")
        out = files if out is None else out.unionByName(files)
        n = level.filter("folder").count() if recursive else 0
        if not n:
            return out.distinct() if recursive and len(roots) > 1 else out
        # A thousand folders a task at most, as many tasks as there are cores at least.
        folders = level.filter("folder").select("path").repartition(max(min(n, spark.sparkContext.defaultParallelism), -(-n // 1000)))


def _by_driver(spark: SparkSession, roots: list[str], recursive: bool) -> DataFrame:
    jvm, rows = spark._jvm, []
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            found = fs.listFiles(path, recursive)
            while found.hasNext():
                f = found.next()
                rows.append((f.getPath().toString(), f.getPath().getName(), f.getLen()))
    return spark.createDataFrame(rows, SCHEMA)


def parent(path: Column) -> Column:
    """The folder of a path, spelled alike whether a listing or a reader gave the path."""
    return F.regexp_replace(F.regexp_replace(path, r"^([a-z0-9+.-]+):/+", "$1:/"), r"/[^/]*$", "")


def qualified(spark: SparkSession, root: str) -> str:
    """The full path of a folder as ``parent`` spells it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^([a-z0-9+.-]+):/+", r"\1:/", full).rstrip("/")


def subdirectories(spark: SparkSession, root: str) -> DataFrame:
    """(subdir,) sorted by name."""
    root = qualified(spark, root)
    found = spark.createDataFrame([(root,)], "path string").mapInArrow(_entries, SCHEMA + ", folder boolean")
    return found.filter("folder").select(F.col("name").alias("subdir")).orderBy("subdir")


def label_lines(spark: SparkSession, roots: list[str] | str, recursive: bool = False) -> DataFrame:
    """(path, dir, base, line) of the label files of folders; lines end at LF, CR LF or CR."""
    reader = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.[tT][xX][tT]")
    lines = reader.text([roots] if isinstance(roots, str) else roots)
    path = F.col("_metadata.file_path")
    return lines.select(path.alias("path"), parent(path).alias("dir"), G.stem(F.col("_metadata.file_name")).alias("base"), F.col("value").alias("line"))


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): one row for each non-empty file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line) of small files whose order matters, such as review files: each is read whole."""
    text = whole_text(spark, path)
    return text.select("path", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line_no", "line"))


def review_map(spark: SparkSession, path: str) -> DataFrame:
    """(relkey, status) as review starts with it: unknown statuses are 0, and the last line of a key wins."""
    read = parse.parse_reviews(ordered_lines(spark, path), parse.StatusPolicy.LOAD)
    return read.groupBy("relkey").agg(F.max_by("status", "line_no").alias("status"))


def label_boxes(spark: SparkSession, folders: list[str], classes: list[int] | None = None) -> DataFrame:
    """(path, dir, base, line, cls, xc, yc, w, h): boxes of flat folders, of some classes or of all."""
    boxes = parse.parse_labels(label_lines(spark, folders), parse.Variant.LENIENT_BOX)
    return boxes if classes is None else boxes.filter(F.col("cls").isin(*classes))


def decoded_images(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    """(path, dir, base, height, width, data): pixels as BGR rows by Spark's image reader; what doesn't decode is left out."""
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", recursive).load(root).select("image.*")
    return images.select(F.col("origin").alias("path"), parent(F.col("origin")).alias("dir"), G.stem(G.basename(F.col("origin"))).alias("base"), "height", "width", "data")


def images_beside(labels: DataFrame, images: DataFrame) -> DataFrame:
    """(dir, base, image): for each label file the image of its folder and stem, by extension priority, or null.

    Extensions are compared as written: an upper-case one is no hit.
    """
    places = {e: i for i, e in enumerate(EXTENSIONS["review"])}
    written_ext = F.regexp_extract("name", r"[^.](\.[^.]*)$", 1)
    prio = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])[written_ext]
    hits = images.withColumn("prio", prio).filter("prio is not null").groupBy("dir", "base").agg(F.min_by("path", "prio").alias("image"))
    return labels.select("dir", "base").join(hits, ["dir", "base"], "left")


def contents(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, content): bytes of the files below a root; zero-byte files are missing, as in Spark's reader."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root).select("path", "content")


def image_sizes(files: DataFrame, content: str = "content") -> DataFrame:
    """Input columns without the bytes, plus img_w, img_h and state: 'ok', or 'bad' where no header is readable.

    Only headers are read: PNG, JPEG, BMP and WebP, by an Arrow-batched function over the first bytes of each segment.
    """
    from boxlake.functions.pixels import header_size

    size = header_size(F.col(content))
    out = files.withColumn("_s", size).withColumns({"img_w": F.col("_s.w"), "img_h": F.col("_s.h")})
    return out.withColumn("state", F.when((F.col("img_w") > 0) & (F.col("img_h") > 0), "ok").otherwise("bad")).drop("_s", content)
