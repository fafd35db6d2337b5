"""SimHash near-duplicates: fingerprints compared as vertical bit planes, linked into classes.

A fingerprint has a bit set where more than half of the XXH64 hashes (seed 42) of the document's
word shingles have it set. Two fingerprints link at ``RADIUS`` or fewer differing bits.

Search: 64 bits are cut into ``b`` blocks; two fingerprints within the radius agree in at least
``b - RADIUS`` of them, so they meet in the group of some choice of that many blocks (pigeonhole;
no pair is lost). ``b`` follows from the number of distinct fingerprints, so that groups stay small
at every size. A group above ``BLOCK`` members is dealt out as pairs of blocks. Within a group the
fingerprints are stored as 64 bit planes; a carry-save counter adds the differing bits of 64 pairs
per machine word, and words whose pairs all exceed the radius are abandoned. A group emits a
spanning forest of its links (at most one row per member), which keeps every connection while the
links of a group of near copies grow with its square. Classes come from rounds of joins.

Defined cases: null or blank texts have fingerprint 0, linked like any other; a null ``doc_id``
counts as larger than any other (a class of only such rows has component_id null); repeated rows
are rows like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from affinia.llm.common import annotate, stage, unpacked

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 17
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), (ends[-n:] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    set_bits = bits.sum(axis=0, dtype=np.uint32) * 2 > n
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and fp (the fingerprint as a signed long) of every row."""

    def fn(texts: list) -> list[dict]:
        values = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
        return [{"fp": v} for v in values.tolist()]

    result = T.StructType([T.StructField("fp", T.LongType())])
    return unpacked(annotate(docs, fn, result, carry=list(carry)))


def _masks(distinct: int, radius: int) -> list[int]:
    """Masks of the block choices that every pair within the radius meets in, as signed longs."""
    blocks = radius + 1
    while blocks < 16 and distinct / 2 ** (64 * (blocks - radius) // blocks) > BLOCK:
        blocks += 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _groups(distinct: DataFrame, radius: int, block: int) -> DataFrame:
    """Arrays ``fps`` of fingerprints that agree under some mask; none above two blocks."""
    masks = _masks(distinct.count(), radius)
    keyed = distinct.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
            for i, m in enumerate(masks)
        ])).alias("k"),
    ).select("fp", "k.mask", "k.part")
    large = (
        keyed.groupBy("mask", "part").count().where(F.col("count") > block)
        .select("mask", "part", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (
        keyed.join(large, ["mask", "part"], "left")
        .withColumn("own", F.coalesce(own, F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    )
    return (
        dealt.groupBy(
            "mask", "part", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
        )
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select("fps")
    )


def compare(values: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of ``values`` within the radius, inside consecutive groups of ``sizes``."""
    words = -(-sizes // 64)
    first_word = np.concatenate(([0], np.cumsum(words)))
    group = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lane = first_word[group] * 64 + within
    padded = np.zeros(first_word[-1] * 64, np.uint64)
    padded[lane] = values
    member = np.full(first_word[-1] * 64, -1, np.int64)
    member[lane] = np.arange(len(values))

    def plane(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.uint64)

    planes = [plane((padded >> np.uint64(b)) & np.uint64(1)) for b in range(64)]
    valid = plane(member >= 0)

    own_word = lane // 64
    todo = first_word[group + 1] - own_word  # words from the value's own to the group's last
    before = np.concatenate(([0], np.cumsum(todo)))
    left, right = [], []
    start = 0
    while start < len(values):
        stop = max(start + 1, int(np.searchsorted(before, before[start] + PAIRS_AT_ONCE, "right")) - 1)
        count = todo[start:stop]
        i = np.repeat(np.arange(start, stop), count)
        w = np.arange(before[stop] - before[start]) - np.repeat(before[start:stop] - before[start], count)
        w += own_word[i]
        i, w, alive = _within(values, planes, valid, i, w, radius)
        # Lanes up to the value itself are left out, as each pair is wanted once.
        alive &= np.where(w == own_word[i], ~((np.uint64(2) << (lane[i] % 64).astype(np.uint64)) - np.uint64(1)), ONES)
        rows, bits = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        left.append(i[rows])
        right.append(member[w[rows] * 64 + bits])
        start = stop
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _within(values, planes, valid, i, w, radius):
    """Of the (value, word) pairs, those with a lane within the radius, and these lanes.

    The counter of ``k`` planes starts at 2^k - radius - 1, so a carry out of it says "exceeded".
    """
    k = int(radius).bit_length()
    offset = (1 << k) - radius - 1
    counter = [np.full(len(i), ONES if offset >> c & 1 else 0, np.uint64) for c in range(k)]
    alive = valid[w]
    query = values[i]
    for b in range(64):
        carry = planes[b][w] ^ (np.uint64(0) - ((query >> np.uint64(b)) & np.uint64(1)))
        for c in range(k):
            carry, counter[c] = counter[c] & carry, counter[c] ^ carry
        alive &= ~carry
        if b % 8 == 7:
            keep = alive != 0
            if 2 * np.count_nonzero(keep) < len(keep) or b == 63:
                i, w, query, alive = i[keep], w[keep], query[keep], alive[keep]
                counter = [c[keep] for c in counter]
    return i, w, alive


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` members reaches through the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Rows (a, b) of linked fingerprints whose connections are those of all links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy()
            cut = np.concatenate(([0], np.cumsum(sizes)))
            start = 0
            while start < len(sizes):  # some groups at a time, for bounded memory
                stop = max(start + 1, int(np.searchsorted(cut, cut[start] + 4 * BLOCK, "right")) - 1)
                mine = flat[cut[start]:cut[stop]]
                i, j = compare(mine.view(np.uint64), sizes[start:stop], radius)
                if len(i):
                    root = _forest(len(mine), i, j)
                    child = np.flatnonzero(root != np.arange(len(mine)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mine[child]), pa.array(mine[root[child]])], ["a", "b"]
                    )
                start = stop

    return _groups(distinct, radius, block).mapInArrow(run, "a long, b long").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges``: the smallest node of its component.

    Each round hooks every node to its smallest neighbour, shortens the chains, and keeps only the
    edges between different results; the edges are gone after a logarithmic number of rounds.
    """
    spark = edges.sparkSession
    found = None
    edges = stage(edges.where("a != b"), "links")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = stage(
            both.groupBy("a").agg(F.min("b").alias("b"))
            .select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "hooks"
        )
        for _ in range(2):
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hook = hook.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        hook = stage(hook, "hooks")
        if found is None:
            found = hook
        else:
            step = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = stage(
                found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
                "roots",
            )
        a = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stage(
            edges.join(a, "a").join(b, "b").where("ra != rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links",
        )
    return spark.createDataFrame([], "node long, root long") if found is None else found


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, block: int = BLOCK
) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that a document reaches through links."""
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    own = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("own")), "distinct")
    found = roots(links(own.select("fp"), radius, block))
    linked = own.join(found, own.fp == found.node).select("fp", "own", "root")
    smallest = linked.groupBy("root").agg(F.min("own").alias("smallest"))
    moved = linked.join(smallest, "root").select("fp", "smallest")
    # Staged, so that the last join has plain inputs: then a fingerprint that very many documents
    # share is split at run time.
    classes = stage(own.join(moved, "fp", "left").select(
        "fp", F.coalesce("smallest", "own").alias("component_id")
    ), "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the first row by (doc_id, text), where
    a null doc_id comes last and a null text first.

    Classes are told apart by their links and not by doc_id, and rows by doc_id and text, so each
    class keeps one row where ids repeat or are null too.
    """
    text_key = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    prints = stage(
        fingerprints(docs.select("doc_id", "text", text_key.alias("text_key")), shingle, ("doc_id", "text_key")),
        "fingerprints",
    )
    own = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = roots(links(own.select("fp"), radius))
    classes = own.join(found, own.fp == found.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    # min passes over nulls, so it is null for null ids only.
    best = classes.groupBy(F.col("root").alias("class")).agg(F.min("first").alias("best_id"))
    wanted = classes.join(
        best, (F.col("root") == F.col("class")) & F.col("first").eqNullSafe(F.col("best_id"))
    ).select(F.col("fp").alias("wanted_fp"), "best_id", "class")
    keys = prints.join(
        wanted, (F.col("fp") == F.col("wanted_fp")) & F.col("doc_id").eqNullSafe(F.col("best_id"))
    ).select("best_id", "text_key", "class").distinct()
    packed_docs = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("own_id"), F.col("text").alias("own_text"), text_key.alias("own_key"),
    )
    stays = packed_docs.join(
        keys, F.col("own_id").eqNullSafe(F.col("best_id")) & (F.col("own_key") == F.col("text_key"))
    )
    nth = F.row_number().over(Window.partitionBy("class").orderBy("own_text"))
    return stays.withColumn("nth", nth).where("nth = 1").select("row.*")
