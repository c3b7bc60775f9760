"""Row transforms that may refuse rows: one pass, both sides kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

#: Takes a batch; gives the changed batch (as many rows) and a reason for each row, null where it is accepted.
BatchTransform = Callable[[pa.RecordBatch], tuple[pa.RecordBatch, pa.Array]]

REASON, ORIGINAL = "_reason", "_original"


def judged(df: DataFrame, transform: BatchTransform, schema: str | StructType) -> DataFrame:
    """Columns of ``schema``, and ``_reason``: null for accepted rows; refused ones have nulls and themselves as JSON in ``_original``.

    The transform sees Arrow batches; if it raises on one, its rows are given to it one by one, and those
    on which it raises again are refused with the error's text. So a row is on one side exactly, whatever the transform does.
    """
    target = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in target]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            original, rows = b.column(ORIGINAL), b.drop_columns([ORIGINAL])
            for part, at in _tried(rows, transform):
                out, reason = part if isinstance(part, tuple) else (None, pa.array([part] * at[1], pa.string()))
                text = original.slice(*at)
                ok = pc.is_null(reason)
                null = lambda n: pa.nulls(at[1], kinds[n])  # noqa: B023, E731
                cols = [pc.if_else(ok, out.column(n).cast(kinds[n]), null(n)) if out is not None else null(n) for n in names]
                yield pa.RecordBatch.from_arrays([*cols, reason.cast(pa.string()), pc.if_else(ok, pa.nulls(at[1], pa.string()), text)], [*names, REASON, ORIGINAL])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {f.name: to_arrow_type(f.dataType) for f in target}
    out = StructType([*[StructField(f.name, f.dataType, True) for f in target], StructField(REASON, StringType()), StructField(ORIGINAL, StringType())])
    return df.select("*", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(ORIGINAL)).mapInArrow(run, out)


def _tried(rows: pa.RecordBatch, transform: BatchTransform) -> Iterator[tuple]:
    try:
        yield transform(rows), (0, len(rows))
    except Exception:
        for i in range(len(rows)):
            try:
                yield transform(rows.slice(i, 1)), (i, 1)
            except Exception as error:
                yield f"{type(error).__name__}: {error}", (i, 1)


def split(judged_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and refused ones as (reason, original). Both read ``judged_rows``: write it once if it is costly."""
    names = [c for c in judged_rows.columns if c not in (REASON, ORIGINAL)]
    return judged_rows.filter(F.col(REASON).isNull()).select(*names), judged_rows.filter(F.col(REASON).isNotNull()).select(F.col(REASON).alias("reason"), F.col(ORIGINAL).alias("original"))
