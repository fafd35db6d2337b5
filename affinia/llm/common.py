"""What the operators share: staging, row-wise Arrow functions, and words as bytes.

Words are handled as UTF-8 bytes: ``bytes.lower`` changes A-Z alone, ``bytes.split`` separates at
the six ASCII blanks alone, and every byte of a character beyond ASCII is 0x80 or more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from affinia.plans.staging import shared_folder, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def thinned(df: DataFrame, key: Column, rows: int, want: int) -> DataFrame:
    """The rows of smallest hash ``key``, about four times as many as wanted of ``rows``.

    Whoever then takes the first ``want`` in the order of a hash sorts a bounded number of rows.
    """
    if rows <= 4 * want:
        return df
    return df.where(F.pmod(key, F.lit(1 << 40)) < int((1 << 40) * 4 * want / rows))


def packed(columns: list[str]) -> Column:
    """All ``columns`` as one struct, so that added columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in columns])


def annotate(
    docs: DataFrame,
    fn: Callable[[list], list[dict]],
    result: T.StructType,
    carry: list[str] | None = None,
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``row`` (the carried columns) and ``result`` (what ``fn`` says).

    ``fn`` gets the texts of one Arrow batch (None for null) and returns a dict for each.
    """
    carry = docs.columns if carry is None else carry
    source = docs.select(packed(carry).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([source.schema["row"], T.StructField("result", result)])
    arrow = to_arrow_type(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(fn(batch.column(1).to_pylist()), type=arrow)
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["row", "result"])

    return source.mapInArrow(run, schema)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*", "result.*")


def blank_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    return text.encode().split() if text else []


def _plain_table() -> bytes:
    keep = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
    upper = range(0x41, 0x5B)
    return bytes(b if b in keep else b + 32 if b in upper else 0x20 for b in range(256))


PLAIN = _plain_table()


def plain_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.encode().translate(PLAIN).split() if text else []
