"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderlens.session import scratch_folder

# Words are runs of anything but these six characters.
WHITE_SPACE = " \t\n\x0b\f\r"
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that reads a projected column may get that column's expression inlined and evaluated
    per element; a lambda variable is a plain value.
    """
    return F.transform(F.array(value), body).getItem(0)


def words_of(text: Column) -> Column:
    """The words of a text; null counts as empty, an empty text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Like a checkpoint, but columnar: later passes read only the columns they need.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# For a batch of texts: the index of the text that each new row belongs to (None: one row per text
# in the given order), and the new columns.
TextFunction = Callable[[list[str]], tuple[Sequence[int] | None, dict[str, Any]]]


def map_texts(
    docs: DataFrame,
    make: Callable[[], TextFunction],
    added: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    rows_at_once: int = 500,
) -> DataFrame:
    """Apply a function of texts inside the tasks; ``make`` builds it once per task.

    The result has the columns ``keep``, untouched, and those of the schema ``added``. Null texts
    arrive as empty ones. No shuffle; a task holds one Arrow batch.
    """
    extra = T.StructType.fromDDL(added)
    schema = T.StructType([docs.schema[c] for c in keep] + extra.fields)
    arrow = to_arrow_schema(schema)
    hidden = "_text_to_map"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for whole in batches:
            for at in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(at, rows_at_once)
                index, columns = function(batch.column(len(keep)).to_pylist())
                kept = [batch.column(i) for i in range(len(keep))]
                if index is not None:
                    kept = [c.take(pa.array(index, pa.int64())) for c in kept]
                new = [pa.array(columns[f.name], arrow.field(f.name).type) for f in extra.fields]
                if len(new[0]):
                    yield pa.RecordBatch.from_arrays(
                        [c.cast(arrow.field(i).type) for i, c in enumerate(kept)] + new, schema=arrow
                    )

    picked = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(hidden))
    return picked.mapInArrow(run, schema)
