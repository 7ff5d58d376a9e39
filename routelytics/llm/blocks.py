"""Feeding whole texts to a vectorised function inside a map-side task.

Every per-document operator of this subpackage is a narrow ``mapInArrow``: it
needs no shuffle, holds one block of texts at a time (``block_chars`` bounds
it; a single longer text is a block of its own) and can be rerun on any
executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

BLOCK_CHARS = 3 << 20

#: Words of all contracts: runs of anything but space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def text_blocks(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their last column as a list of texts (null: empty)."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(b.num_columns - 1)), 0).to_pylist()
        lo, held = 0, 0
        for i, n in enumerate(sizes):
            if i > lo and held + n > block_chars:
                part = b.slice(lo, i - lo)
                yield part, [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                lo, held = i, 0
            held += n
        part = b.slice(lo)
        yield part, [t or "" for t in part.column(part.num_columns - 1).to_pylist()]


def map_texts(df: DataFrame, make: Callable[[], Callable[[list[str]], list]], added: StructType,
              keep: list[str], text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``keep`` columns of ``df`` (the text last) plus ``added`` columns computed from its texts.

    ``make()`` runs once per task and returns a function from a list of texts
    to one list or Arrow array per added column.  Columns of ``df`` that are
    not kept never reach Python, so extra columns cannot clash.
    """
    # the text goes last; one that is kept is not sent twice
    kept = [c for c in keep if c != text_col]
    src = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias("__text"))
    fields = [StructField(f.name, f.dataType, True) for f in src.schema.fields]
    if len(kept) == len(keep):
        fields = fields[:-1]
    else:
        fields[-1] = StructField(text_col, fields[-1].dataType, True)
    k = len(fields)
    out = StructType(fields + list(added.fields))
    arrow = to_arrow_schema(out)

    def run(batches):
        f = make()
        for part, texts in text_blocks(batches, block_chars):
            cols = [part.column(i) for i in range(k)]
            for field, values in zip(list(arrow)[k:], f(texts)):
                cols.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
            yield pa.RecordBatch.from_arrays([c if c.type == t.type else c.cast(t.type) for c, t in zip(cols, arrow)],
                                             schema=arrow)

    return src.mapInArrow(run, out)
