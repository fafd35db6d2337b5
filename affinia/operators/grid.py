"""Entities compared block by block: rows are copied to block pairs, packed, and paired in numpy.

Where entities share many features, the pairs of rows that meet far exceed the rows, and moving
them costs more than moving every row to all the places where it is paired. Entities are hashed into
``SIDE`` blocks (more only beyond ``BLOCK_ROWS`` rows a block), so every row is copied to a fixed
number of block pairs, whatever the size of the input. Before they are copied, rows are packed into
arrays of the narrowest type that holds their numbers (entities, which are sorted, as differences;
features sorted inside them) and compressed byte by byte. A block pair is one group, whose memory is
that of its rows, held as narrow as they came: the pairs are listed slice by slice, entities in
order, and only what a slice finds leaves it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIDE = 8
BLOCK_ROWS = 16_000_000
#: Rows packed together, and rows that a group expands at a time.
PACK_ROWS = 1 << 19
AT_ONCE = 1 << 20


def blocks_for(rows: int, side: int = SIDE) -> int:
    return max(side, -(-rows // BLOCK_ROWS))


def block_of(code: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(code), F.lit(blocks)).cast("int")


def packed(rows: DataFrame) -> DataFrame:
    """(role, own, e, f, x): many rows (role, own, e, f, x) of a role and block as packed arrays."""

    def flushed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        role, own, e, f, x = (table.column(i).to_numpy() for i in range(5))
        order = np.lexsort((f, e, own, role))
        role, own = role[order], own[order]
        edges = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(role, prepend=-1) != 0))
        columns = [
            pa.array([pack_one(part) for part in np.split(values[order], edges[1:])], pa.binary())
            for values, pack_one in ((e, ascending), (f, narrow), (x, narrow))
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(role[edges]), pa.array(own[edges]), *columns],
            names=["role", "own", "e", "f", "x"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACK_ROWS:
                yield flushed(held)
                held, n = [], 0
        if n:
            yield flushed(held)

    placed = rows.select(
        F.col("role").cast("int"), F.col("own").cast("int"), F.col("e").cast("long"),
        F.col("f").cast("long"), F.col("x").cast("double"),
    )
    return placed.mapInArrow(pack, "role int, own int, e binary, f binary, x binary")


def narrow(values: np.ndarray) -> bytes:
    """The values, compressed, in the narrowest type that holds them exactly.

    That type's letter and the count come first. All lowest bytes precede all second ones, and so
    on, as the higher ones repeat and compress well by themselves.
    """
    small = values = np.ascontiguousarray(values)
    with np.errstate(invalid="ignore", over="ignore"):
        for kind in (np.int8, np.uint8, np.int16, np.uint16, np.int32):
            cast = values.astype(kind)
            if np.array_equal(cast, values):
                small = cast
                break
    planes = small.view(np.uint8).reshape(len(values), small.itemsize).T
    body = pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(values) else b""
    return small.dtype.char.encode() + len(values).to_bytes(8, "little") + body


def ascending(values: np.ndarray) -> bytes:
    """``narrow`` for sorted whole numbers: the first and the last one, and the differences."""
    if not len(values):
        return bytes(16) + narrow(values)
    return values[[0, -1]].astype(np.int64).tobytes() + narrow(np.diff(values, prepend=values[:1]))


def widened(blobs: list[bytes], kind: type) -> np.ndarray:
    """The values of several packed arrays, one after the other, as ``kind``."""
    return _unpacked(blobs, np.dtype(kind), sorted_ones=False)


def _unpacked(blobs: list[bytes], kind: np.dtype, sorted_ones: bool) -> np.ndarray:
    skipped = 16 if sorted_ones else 0
    counts = [int.from_bytes(b[skipped + 1:skipped + 9], "little") for b in blobs]
    values, at = np.zeros(sum(counts), kind), 0
    for blob, n in zip(blobs, counts):
        if not n:
            continue
        letter = np.dtype(chr(blob[skipped]))
        raw = pa.decompress(memoryview(blob)[skipped + 9:], n * letter.itemsize, codec="zstd")
        part = np.frombuffer(np.frombuffer(raw, np.uint8).reshape(letter.itemsize, n).T.tobytes(), letter)
        if sorted_ones:
            part = np.cumsum(part, dtype=np.int64) + np.frombuffer(blob, np.int64, 1)
        values[at:at + n] = part
        at += n
    return values


def held(batches: Iterable[pa.RecordBatch], roles: int, parts: int = 1) -> list[tuple[list, list, list]]:
    """The packed e, f and x of every role in the rows of a group, part by part of the role."""
    found = [([], [], []) for _ in range(roles * parts)]
    for batch in batches:
        role, *columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("role", "e", "f", "x"))
        part = batch.column(batch.schema.get_field_index("part")).to_pylist() if parts > 1 else [0] * len(role)
        for i, k, *blobs in zip(role, part, *columns):
            for kept, blob in zip(found[i * parts + k], blobs):
                kept.append(blob)
    return found


def opened(part: tuple[list, list, list], narrowly: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The e, f and x of one role.

    Eight bytes a number, or ``narrowly`` four where these hold e and f, and for x what it came in.
    """
    e, f, x = part

    def kind(least: type, found: set, widest: type = np.int64) -> np.dtype:
        return np.result_type(least, *found) if narrowly else np.dtype(widest)

    ends = np.array([np.frombuffer(b, np.int64, 2) for b in e])
    wide = not np.array_equal(ends, ends.astype(np.int32))
    return (
        _unpacked(e, kind(np.int64 if wide else np.int32, set()), True),
        _unpacked(f, kind(np.int32, {chr(b[0]) for b in f}), False),
        _unpacked(x, kind(np.int8, {chr(b[0]) for b in x}, np.float64), False),
    )


def read(
    batches: Iterable[pa.RecordBatch], roles: int, narrowly: bool = False
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The e, f and x of every role in the packed rows of a group, as ``opened`` gives them."""
    parts, out = held(batches, roles), []
    while parts:
        out.append(opened(parts.pop(0), narrowly))  # a role's packed rows go as they are unpacked
    return out


def places(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For row i, ``counts[i]`` rows (i, place), the places from ``starts[i]`` on."""
    skipped = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) + np.repeat(starts - skipped, counts)


def least_met(shared: np.ndarray, least1: np.ndarray, least2: np.ndarray) -> np.ndarray:
    """Whether pairs share at least the smaller of two wanted counts."""
    return shared >= np.minimum(least1, least2)


def copied(packs: DataFrame, blocks: int, parts: int = 1) -> DataFrame:
    """(block, role, part, e, f, x): packed rows at every pair of their block with a block, itself too.

    A pair is one group for both of its blocks: roles are doubled, odd ones for the larger block.
    Rows may be packed by ``parts`` finer blocks of every block, which tell the ``part``.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    packs = packs.withColumn("part", F.col("own") % parts).withColumn("own", F.floor(F.col("own") / parts).cast("int"))
    return packs.withColumn("other", every).select(
        (F.least("own", "other") * blocks + F.greatest("own", "other")).alias("block"),
        (F.col("role") * 2 + (F.col("own") > F.col("other")).cast("int")).alias("role"), "part",
        "e", "f", "x",
    )


def shared_counts(
    coded: DataFrame, rows: int, enough: Callable = least_met, side: int = SIDE
) -> DataFrame:
    """(e1, e2, shared): pairs e1 < e2 with enough common features.

    ``coded`` has distinct (e, f) and a number ``x``, constant for an entity; ``enough`` says of
    arrays of counts and of the two numbers which pairs are kept.
    """
    blocks = blocks_for(rows, side)
    packs = packed(coded.select(
        F.lit(0).alias("role"), block_of("e", blocks).alias("own"), "e", "f", "x"
    ))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        same = first.column(0)[0].as_py() % (blocks + 1) == 0
        yield from _counted(read(chain([first], batches), 2, True), same, enough)

    return (
        copied(packs, blocks).repartition(blocks * (blocks + 1), "block").groupBy("block")
        .applyInArrow(count, T.StructType([T.StructField(c, T.LongType()) for c in ("e1", "e2", "shared")]))
    )


def placed(names: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The places of values among sorted names, found slice by slice, as these need eight bytes each."""
    at = np.zeros(len(values), np.int32)
    for low in range(0, len(values), AT_ONCE):
        at[low:low + AT_ONCE] = np.searchsorted(names, values[low:low + AT_ONCE])
    return at


def _counted(sides: list[tuple], same: bool, enough: Callable) -> Iterator[pa.RecordBatch]:
    """Takes the two sides of a group (the first one only, if ``same``) out of their list."""
    right = sides.pop()
    left = sides.pop()
    right = left if same else right
    e1, f1, x1 = left
    e2, f2, x2 = right
    if not len(e1) or not len(e2):
        return
    order = np.argsort(f2, kind="stable").astype(np.int32)
    f2 = f2[order]
    start = np.append(np.flatnonzero(np.diff(f2, prepend=f2[0] - 1)), len(f2)).astype(np.int32)
    features = f2[start[:-1]]
    del f2
    names = np.unique(e2)
    other = placed(names, e2)
    many, numbers = len(names), np.zeros(len(names), x2.dtype)
    numbers[other] = x2
    other, x2 = other[order], numbers
    del e2, order, right

    at = np.minimum(placed(features, f1), len(features) - 1)
    met = np.flatnonzero(features[at] == f1).astype(np.int32)
    del f1, left
    met = met[np.argsort(e1[met], kind="stable")]
    e1, at, x1 = e1[met], at[met], x1[met]
    del met
    begin, held = start[at], start[at + 1] - start[at]
    edges = np.append(np.flatnonzero(np.diff(e1, prepend=e1[0] - 1 if len(e1) else 0)), len(e1))
    each = np.add.reduceat(held, edges[:-1], dtype=np.int64) if len(e1) else held
    total = np.append(0, np.cumsum(each))  # rows met before each entity
    entity = 0
    while entity < len(edges) - 1:
        stop = max(entity + 1, int(np.searchsorted(total, total[entity] + AT_ONCE, "right")) - 1)
        low, high = edges[entity], edges[stop]
        if stop == entity + 1 and total[stop] - total[entity] > AT_ONCE:
            counts = np.zeros(many, np.int64)
            for b, h in zip(begin[low:high], held[low:high]):
                counts[other[b:b + h]] += 1  # an entity holds a feature once
            key = np.flatnonzero(counts)
            counts = counts[key]
        else:
            row, place = places(held[low:high], begin[low:high])
            own = np.repeat(np.arange(stop - entity), np.diff(edges[entity:stop + 1]))
            key = own[row] * many + other[place]
            if (stop - entity) * many <= 4 * len(key):
                counts = np.bincount(key)
                key = np.flatnonzero(counts)
                counts = counts[key]
            else:
                key.sort()
                new = np.flatnonzero(np.diff(key, prepend=-1))
                counts = np.diff(new, append=len(key))
                key = key[new]
        one, two = edges[entity + key // many], key % many
        kept = enough(counts, x1[one].astype(np.float64), x2[two].astype(np.float64))
        one, two, counts = e1[one[kept]].astype(np.int64), names[two[kept]].astype(np.int64), counts[kept]
        if same:
            once = one < two
            one, two, counts = one[once], two[once], counts[once]
        if len(counts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(counts.astype(np.int64))],
                names=["e1", "e2", "shared"],
            )
        entity = stop

