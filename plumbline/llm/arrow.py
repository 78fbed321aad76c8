"""Row-wise Arrow operators: new columns beside the ones a caller keeps."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.text import CHUNK_BYTES, chunks

TEXT = "__text"


def with_measures(
    docs: DataFrame, text_col: str, keep: list[str] | None, own: T.StructType,
    measure: Callable[[pa.Array], dict[str, object]], size: int = CHUNK_BYTES,
) -> DataFrame:
    """``keep`` columns and the columns ``own`` that ``measure`` derives from whole texts.

    ``measure`` gets the texts of a chunk of rows, about ``size`` bytes, and
    returns one sequence per column. Own columns replace kept ones of the same
    name. A text column that is kept goes to the worker once.
    """
    own_names = set(own.names)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own_names]
    source = text_col if text_col in keep else TEXT
    texts = [] if source in keep else [F.col(f"`{text_col}`").alias(TEXT)]
    carried = docs.select(*[F.col(f"`{c}`") for c in keep], *texts)
    schema = T.StructType([f for f in carried.schema.fields if f.name != TEXT] + own.fields)
    names = [f.name for f in own.fields]

    def run(batches):
        for part in chunks(batches, source, size):
            found = measure(part.column(source))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(found[n]) for n in names)], names=[*keep, *names])

    return carried.mapInArrow(run, schema)
