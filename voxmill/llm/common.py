"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _WRITTEN, shared_folder

#: Words of the contracts, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` written once, compressed, to the folder all executors share, and read back.

    Cuts lineage: a lost executor costs its running tasks only. ``session.temporary_tables`` removes the table.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exactly(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, taken by position: others may have the same name in another case, or dots in theirs.

    A name that no column has as it is written stands for the first that has it in another case.
    """
    flat = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return flat.select(*(F.col(f"_{place_of(df, n)}").alias(n) for n in names))


def place_of(df: DataFrame, name: str) -> int:
    """Place of a column: as it is written, or else the first in another case."""
    columns = [c.lower() for c in df.columns]
    return df.columns.index(name) if name in df.columns else columns.index(name.lower())


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in (c.lower() for c in df.columns)


def quoted(names: Sequence[str]) -> list[F.Column]:
    """Columns by names that may hold dots."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def whole_text(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def batches_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Each record batch in slices whose buffers hold about ``limit`` bytes."""
    for batch in batches:
        step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
