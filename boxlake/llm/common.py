"""What several of these operators share: column checks, Arrow batches in bounded slices, and tokenizer files."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame

from boxlake.functions.grammar import let  # noqa: F401  for the operators

#: Most UTF-8 bytes of text that a Python worker turns into objects at a time.
SLICE_BYTES = 4 << 20


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Names like the stems that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem = f"_{stem}"
        out.append(stem)
    return out


def text_slices(batches: Iterator[pa.RecordBatch], name: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds at most about ``most`` bytes of text, or one row."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(name)).to_pylist()):
            if size and size + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def map_text(df: DataFrame, columns: list[str], make: Callable[[], Callable[[pa.RecordBatch], list[list]]], schema: str, keep: list[str] = ()) -> DataFrame:
    """Apply a per-slice function over ``columns`` (the last one holds the text); each slice gives lists by column.

    Columns of ``keep`` pass through unchanged, after the others.

    ``make`` runs once per task on the executor and returns the function, so caches live as long as the task.
    """
    kept = df.select(*columns[:-1], *keep, columns[-1])
    extra = kept.select(*keep).schema
    parts = [x.strip().split(maxsplit=1) for x in schema.split(",")]
    names = [n for n, _ in parts] + extra.fieldNames()
    types = [_arrow(t) for _, t in parts]
    schema = ", ".join([schema, *(f"{f.name} {f.dataType.simpleString()}" for f in extra)])
    first = len(columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for part in text_slices(batches, columns[-1]):
            asked = part.select([*range(first), part.num_columns - 1])
            made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(f(asked), types, strict=True)]
            yield pa.RecordBatch.from_arrays(made + part.columns[first:-1], names=names)

    return kept.mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}[kind]


def vocabulary(path: str) -> bytes:
    """Contents of a vocabulary file; it travels with the task, so executors need no copy of the file."""
    return Path(path).read_bytes()
