"""File actions carried out by tasks, once each, whatever is retried.

Before a task acts, it writes down which actions it has found possible: the source is there, the target is free. A later
attempt that finds the source gone or the target taken looks there: if an attempt before it was about to act, the action is
done, and reported so; else it was never possible. Notes are small files in a journal folder, by bucket of actions, which
is also what tasks are dealt by; what an attempt reports is kept only if Spark commits that attempt.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from hashlib import sha1
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.session import shared_dir, written
from boxlake.sources.store import SCHEMES, reachable, scheme, store

ACTIONS = "op string, src string, dst string"
#: What a plan may ask for; rmtree deletes a folder with all below it, delete a file only.
OPS = ("delete", "rmtree", "move", "copy")
#: Actions that are written down at a time.
CHUNK = 256


def _key(op: str, src: str, dst: str | None) -> str:
    return sha1("\0".join((op, src, dst or "")).encode()).hexdigest()


class Journal:
    """Keys of actions that some attempt was about to carry out, by bucket."""

    def __init__(self, root: str) -> None:
        self.root, self.store = root, store(root)

    def intended(self, bucket: int) -> set[str]:
        folder = f"{self.root}/{bucket}"
        return {k for name, _, _ in self.store.entries(folder) if name.endswith(".json") for k in json.loads(self.store.read(f"{folder}/{name}"))}

    def intend(self, bucket: int, keys: list[str]) -> None:
        if keys:
            self.store.write(f"{self.root}/{bucket}/{uuid.uuid4().hex}.json", json.dumps(keys).encode())


def _blocked(op: str, src: str, dst: str | None) -> str | None:
    """Why an action isn't possible now: 'gone', 'folder', 'exists'; null if it is."""
    if op in ("move", "copy") and SCHEMES.get(scheme(src)) != SCHEMES.get(scheme(dst)):
        raise ValueError(f"{op} between stores: {src} to {dst}")
    kind = store(src).kind(src)
    if kind is None:
        return "gone"
    if op == "delete":
        return "folder" if kind == "folder" else None
    return "exists" if op in ("move", "copy") and store(dst).kind(dst) else None


def _act(op: str, src: str, dst: str | None) -> None:
    if op in ("delete", "rmtree"):
        store(src).remove(src)
    elif op == "move":
        store(src).move(src, dst)
    else:
        store(src).copy(src, dst)


def _done(op: str, src: str, dst: str | None) -> bool:
    """Whether things stand as they do after the action."""
    there = store(src).kind(src) is not None
    return (not there if op in ("delete", "rmtree") else not there and store(dst).kind(dst) is not None) if op != "copy" else store(dst).kind(dst) is not None


def _chunk(journal: Journal, bucket: int, rows: list[tuple], act) -> list[str]:
    keys = [_key(*r) for r in rows]
    blocked = [_blocked(*r) for r in rows]
    # Read after what stands in the way was seen: an attempt that caused it had written its note before.
    noted = journal.intended(bucket) if any(blocked) else set()
    journal.intend(bucket, [k for k, b in zip(keys, blocked, strict=True) if b is None])
    out = []
    for key, b, row in zip(keys, blocked, rows, strict=True):
        if b is None:
            try:
                act(*row)
                b = "ok"
            except (FileNotFoundError, FileExistsError):  # another attempt of this task, or another row, was faster
                b = "ok" if key in journal.intended(bucket) and _done(*row) else _blocked(*row) or "gone"
        elif key in noted and _done(*row):
            b = "ok"
        out.append(b)
    return out


def carried_out(plan: DataFrame, journal: str | None = None, per_bucket: int = 2048, act=_act) -> DataFrame:
    """(op, src, dst, result) of each action of a plan, carried out by tasks: 'ok', 'gone' (no source), 'exists' (target taken)
    or 'folder' (delete meant a file).

    An action named twice is one. Actions of one target are one task's, in order of source; others run in no fixed order, so a
    plan must not touch what another of its actions makes. With the ``journal`` of a run that failed, a new run finishes it
    and reports what either did; with a new one (the default) what was done before counts as gone. A plan of any size will
    do: rows stay on the executors. Moves between stores are refused.
    """
    spark = plan.sparkSession
    journal = journal or f"{shared_dir(spark)}/journal-{uuid.uuid4().hex}"
    if not reachable(journal):
        raise ValueError(f"tasks don't reach the journal {journal}")
    plan = written(plan.select("op", "src", "dst").distinct(), "plan")
    buckets = max(1, -(-plan.count() // per_bucket))
    dealt = plan.withColumn("bucket", F.pmod(F.xxhash64(F.coalesce("dst", "src")), F.lit(buckets)).cast("int")).repartition(buckets, "bucket").sortWithinPartitions("bucket", "dst", "src")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notes = Journal(journal)
        for batch in batches:
            for bucket, group in groupby(zip(*(c.to_pylist() for c in batch.columns), strict=True), key=lambda r: r[3]):
                rows = [r[:3] for r in group]
                for at in range(0, len(rows), CHUNK):
                    part = rows[at : at + CHUNK]
                    results = _chunk(notes, bucket, part, act)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (*zip(*part, strict=True), results)], names=["op", "src", "dst", "result"])

    return written(dealt.mapInArrow(run, ACTIONS + ", result string"), "results")
