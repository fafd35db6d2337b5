"""Packing: documents as token ids, cut into pieces that fill sequences of ``SEQUENCE`` ids.

A document of more than a sequence gives full sequences and a remainder. The histogram of remainder
lengths (at most ``SEQUENCE`` numbers, however many documents) goes to the driver, which enumerates
shallow combinations of lengths that fill a sequence, solves for the repeat count of every
combination by non-negative least squares against the histogram, and rounds down. A remainder's rank
among those of its length says which repeat of which combination it belongs to. The residual
remainders are packed greedily: laid end to end, and cut where a sequence is full. So every piece
finds its place from its rank by arithmetic, and no task sees more than its share.

Ranks are (count of the length in earlier parts) + (place within the own part), where a part is a
bounded run of documents; no window runs over all documents of a length. Cuts fall on multiples of
``GRAIN`` ids of a remainder, where the first pass has noted CRC-32 states, so that a piece's
checksum needs no second look at the text. A greedy sequence is therefore up to ``GRAIN`` - 1 ids
short of full, or, if it holds the last rows, shorter.

Defined cases: null texts are empty; an empty text is the end id alone; repeated rows are packed
each; an empty table gives no pieces; other columns are carried by the operator's own output.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from affinia.llm.common import stage
from affinia.llm.tokens import Tokens

SEQUENCE = 4096
GRAIN = 16
END_ID = 2
DEPTH = 3
PART_ROWS = 4096


def _polynomial_times(matrix: list[int], vector: int) -> int:
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector >>= 1
        k += 1
    return out


def _zero_byte_powers(n: int = 24) -> list[list[int]]:
    """Matrices that advance a CRC-32 register over 1, 2, 4, ... zero bytes."""
    matrix = [0xEDB88320, *(1 << k for k in range(31))]  # one zero bit
    for _ in range(3):
        matrix = [_polynomial_times(matrix, c) for c in matrix]
    powers = [matrix]
    for _ in range(n - 1):
        matrix = [_polynomial_times(matrix, c) for c in matrix]
        powers.append(matrix)
    return powers


_POWERS = _zero_byte_powers()


def crc_between(whole: int, head: int, tail_bytes: int) -> int:
    """CRC-32 of a tail from that of the whole, that of the head, and the tail's length."""
    k = 0
    while tail_bytes:
        if tail_bytes & 1:
            head = _polynomial_times(_POWERS[k], head)
        tail_bytes >>= 1
        k += 1
    return whole ^ head


def _first_pass(docs: DataFrame, carry: list[str], path: str, sequence: int, grain: int) -> DataFrame:
    """Per document: part, ids, CRCs of its full sequences, remainder length with CRC states."""
    result = T.StructType([
        T.StructField("part", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("full", T.ArrayType(T.LongType())),
        T.StructField("full_before", T.LongType()),
        T.StructField("rest", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("states", T.BinaryType()),
    ])
    source = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]).alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    schema = T.StructType([source.schema["row"], T.StructField("p", result)])
    arrow = to_arrow_type(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, part = TaskContext.get().partitionId(), 0
        tokens = Tokens(path, END_ID)
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                piece = batch.slice(at, PART_ROWS)
                number = (task << 16) + part
                part += 1
                out, full_before, seen = [], 0, {}
                for text in piece.column(1).to_pylist():
                    ids = memoryview(tokens.ids(text))
                    n = len(ids) // 4
                    whole = n // sequence
                    rest = n - whole * sequence
                    step = 4 * sequence
                    full = [zlib.crc32(ids[k * step:(k + 1) * step]) for k in range(whole)]
                    crc, states = 0, []
                    for k in range(whole * step, len(ids), 4 * grain):
                        crc = zlib.crc32(ids[k:k + 4 * grain], crc)
                        states.append(crc)
                    place = seen.get(rest, 0)
                    seen[rest] = place + 1
                    out.append({
                        "part": number, "doc_tokens": n, "full": full, "full_before": full_before,
                        "rest": rest, "place": place, "states": np.array(states, "<u4").tobytes(),
                    })
                    full_before += whole
                found = pa.array(out, type=arrow)
                yield pa.RecordBatch.from_arrays([piece.column(0), found], ["row", "p"])

    return source.mapInArrow(run, schema).select("row", "p.*")


def combinations(units: int, present: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Rows (one per combination) of how many of each length in units, sums being ``units``."""
    found = []
    have = np.flatnonzero(present)
    held = set(have.tolist())
    for n in range(1, depth + 1):
        for head in combinations_with_replacement(have.tolist(), n - 1):
            last = units - sum(head)
            if last in held and (not head or last >= head[-1]):
                row = np.zeros(len(present), np.int16)
                np.add.at(row, [*head, last], 1)
                found.append(row)
    return np.array(found, np.int16).reshape(-1, len(present))


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 600) -> np.ndarray:
    """argmin |a x - b|, x >= 0, by accelerated projected gradient steps."""
    x = z = np.zeros(a.shape[1])
    if not a.size:
        return x
    gram = a @ a.T
    step = 1.0 / max(1e-12, float(np.linalg.eigvalsh(gram)[-1]))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, z - step * (a.T @ (a @ z - b)))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, sequence: int = SEQUENCE, unit: int = GRAIN, depth: int = DEPTH):
    """From counts by remainder length: rows (length, from_rank, to_rank, first_sequence, slot) and
    the number of sequences. Ranks beyond the rows of a length are residual."""
    bins = sequence // unit
    of = -(-np.arange(sequence) // unit)  # a length counts as whole units
    count = np.bincount(of, histogram, bins + 1)
    combos = combinations(bins, count > 0, depth)
    repeats = np.floor(nnls(combos.T.astype(float), count) + 1e-6).astype(np.int64)
    # Rounding down can still ask for more than there is, as the fit is not exact.
    left = count.astype(np.int64)
    rows, sequences = [], 0
    taken = np.zeros(sequence, np.int64)
    for k in np.argsort(-repeats, kind="stable"):
        uses = np.flatnonzero(combos[k])
        n = int(min(repeats[k], *(left[uses] // combos[k][uses])))
        if n <= 0:
            continue
        slot = 0
        for u in uses:
            for _ in range(int(combos[k][u])):
                need, at = n, sequences
                # The lengths of a unit are used up in order, smallest first.
                for length in range(max(1, (u - 1) * unit + 1), min(sequence - 1, u * unit) + 1):
                    got = int(min(need, histogram[length] - taken[length]))
                    if got > 0:
                        rows.append((length, int(taken[length]), int(taken[length]) + got, at, slot))
                        taken[length] += got
                        need, at = need - got, at + got
                    if not need:
                        break
                slot += 1
            left[u] -= n * int(combos[k][u])
        sequences += n
    return rows, sequences, taken


def pack(
    docs: DataFrame, path: str, carry: list[str] | None = None, sequence: int = SEQUENCE,
    grain: int = GRAIN,
) -> DataFrame:
    """One row per piece: ``row`` (the carried columns of its document), start, length, ids_crc32,
    doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    first = stage(_first_pass(docs, carry, path, sequence, grain), "tokens")

    by_length = stage(first.groupBy("part", "rest").agg(F.count("*").alias("n")), "lengths")
    bases = by_length.select(
        "part", "rest",
        F.coalesce(F.sum("n").over(_before(Window.partitionBy("rest").orderBy("part"))), F.lit(0)).alias("base"),
    )

    histogram = np.zeros(sequence, np.int64)
    for r in by_length.groupBy("rest").agg(F.sum("n").alias("n")).collect():
        histogram[r.rest] = r.n
    histogram[0] = 0
    ranges, combined, taken = plan(histogram, sequence, grain)
    # Residual remainders lie end to end by length: where those of a length begin.
    residual = histogram - taken
    begins = np.concatenate(([0], np.cumsum(residual * np.arange(sequence))))[:-1]
    facts = spark.createDataFrame(
        [(int(n), int(taken[n]), int(begins[n])) for n in np.flatnonzero(histogram)],
        "rest int, taken long, begins long",
    )
    placed = spark.createDataFrame(
        ranges,
        "length_ int, from_ long, to_ long, sequence_ long, slot int",
    )

    ranked = stage(
        first.join(bases, ["part", "rest"]).withColumn("rank", F.col("base") + F.col("place")), "ranked"
    )
    start = F.size("full").cast("long") * sequence
    # Full sequences are numbered by their part, above all others: no count over all parts is needed.
    full = ranked.select(
        "row", "doc_tokens", "part", "full_before", F.posexplode("full").alias("k", "ids_crc32")
    ).select(
        "row", (F.col("k").cast("long") * sequence).alias("start"),
        F.lit(sequence).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.lit(1 << 62) + F.shiftleft("part", 24) + F.col("full_before") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    # Both tables have at most a few numbers per length below `sequence`: bounded broadcasts.
    rests = ranked.where("rest > 0").join(F.broadcast(facts), "rest")
    whole = rests.where("rank < taken").join(
        F.broadcast(placed),
        (F.col("rest") == F.col("length_")) & (F.col("rank") >= F.col("from_")) & (F.col("rank") < F.col("to_")),
    ).select(
        "row", start.alias("start"), F.col("rest").cast("long").alias("length"),
        F.lit(None).cast("long").alias("cut_from"), "states", "rest", "doc_tokens",
        (F.col("sequence_") + F.col("rank") - F.col("from_")).alias("sequence_id"),
        F.col("slot").cast("long").alias("order_"),
    )
    room = sequence - grain + 1
    position = F.col("begins") + (F.col("rank") - F.col("taken")) * F.col("rest")
    laid = rests.where("rank >= taken").withColumn("position", position)

    def piece_from(k):  # where the k-th piece of a remainder begins: at a boundary, on the grain
        boundary = (F.floor(F.col("position") / room) + k) * room
        inside = boundary - F.col("position")
        return F.when(k == 0, F.lit(0)).otherwise(
            F.least(F.col("rest"), F.greatest(F.lit(0), inside - inside % grain))
        ).cast("long")

    k = F.col("k")
    cut = (
        laid.withColumn("k", F.explode(F.sequence(
            F.lit(0), F.floor((F.col("position") + F.col("rest") - 1) / room).cast("int")
            - F.floor(F.col("position") / room).cast("int")
        )))
        .withColumn("a", piece_from(k)).withColumn("b", F.when(
            F.floor(F.col("position") / room) + k
            == F.floor((F.col("position") + F.col("rest") - 1) / room), F.col("rest").cast("long")
        ).otherwise(piece_from(k + 1)))
        .where("b > a")
        .select(
            "row", (start + F.col("a")).alias("start"), (F.col("b") - F.col("a")).alias("length"),
            F.col("a").alias("cut_from"), "states", "rest", "doc_tokens",
            (F.lit(combined) + F.floor(F.col("position") / room) + k).cast("long").alias("sequence_id"),
            F.col("position").alias("order_"),
        )
    )
    offset = F.sum("length").over(_before(Window.partitionBy("sequence_id").orderBy("order_", "start")))
    pieces = whole.union(cut).withColumn("ids_crc32", _piece_crc(grain)).select(
        "row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "order_"
    )
    return full.union(
        pieces.withColumn("offset", F.coalesce(offset, F.lit(0)))
        .select("row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _piece_crc(grain: int):
    """The CRC of a remainder's ids from ``cut_from`` (null: all of it) on, by the noted states."""

    @F.pandas_udf("long")
    def cut(states: pd.Series, cut_from: pd.Series, length: pd.Series, rest: pd.Series) -> pd.Series:
        out = []
        for s, a, n, r in zip(states, cut_from, length, rest):
            noted = np.frombuffer(s, "<u4")
            whole = int(noted[-(-(a + n) // grain) - 1])
            head = int(noted[a // grain - 1]) if a else 0
            out.append(crc_between(whole, head, 4 * n) if a else whole)
        return pd.Series(out, dtype="int64")

    return cut(
        "states", F.coalesce(F.col("cut_from"), F.lit(0).cast("long")), "length",
        F.col("rest").cast("long"),
    )
