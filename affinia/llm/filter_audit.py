"""Filter interaction audit over a sparse document-term matrix.

Words of the whole corpus get dense global numbers (a dictionary), and documents become the rows of
a sparse matrix, stored as CSR shards: row starts, word numbers, counts. A task encodes documents
into shards of about ``SHARD_BYTES`` of text, whose words have numbers of their own, in the order of
a hash. The distinct words of a shard travel to buckets, ranges of that hash, which number them once
for all shards; a bucket returns the numbers in the order it got the words. So only the distinct
words of shards are shuffled, never word occurrences, packed by (bucket, shard); the number of
buckets follows from the number of words, about ``BUCKET_WORDS`` to each.

Row sums are the words of a document and the nonzero entries of its row its distinct words, which
decide filters A and B. C and D follow from the characters; E compares SHA-256 of the whole text
with the smallest doc_id that has it. The audit counts documents by (part, set of failed filters)
and joins the 32 sets with fixed rules of the 120 orders.

Hot groups: copies of one text meet their smallest doc_id by (text, doc_id), a key no two documents
share, and rows alike in everything are counted before they are shuffled; labels are joined to
counts per (doc_id, part, failed filters), so that a hot or null doc_id is few rows. A word of every
document is one word a shard.

Defined cases: a null text is an empty one, a null source the empty string; null doc_ids come after
all others and have no label; rows that repeat a doc_id are documents of their own, and do not make
each other fail E; labels that repeat a doc_id mark it if any of them does; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinia.llm.common import stage
from affinia.llm.wordarrays import bytes_of, hashes, words_of
from affinia.plans.staging import WIDE_ROWS, at_once

FILTERS = "ABCDE"
SHARD_BYTES = 8 << 20
BUCKET_WORDS = 1 << 19
#: Documents, shards, and vocabularies of shards, that one Arrow batch holds at most.
DOCUMENTS_AT_ONCE, SHARDS_AT_ONCE, VOCABULARIES_AT_ONCE = 256, 4, 16
#: Fixed limits of the filters.
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 2

_UPPER, _SYMBOL, _LATER = (np.zeros(256, bool) for _ in range(3))
_UPPER[ord("A"):ord("Z") + 1] = True
_SYMBOL[list(b"#$%&*|")] = True
_LATER[0x80:0xC0] = True  # bytes of UTF-8 characters after their first

_MATRIX = (
    "shard long, doc_ids array<long>, parts array<string>, marks array<int>, texts array<binary>, "
    "starts array<long>, words array<{0}>, counts array<int>"
)
_MATRIX_NAMES = [c.split()[0] for c in _MATRIX.split(", ")]
_LISTS = {
    "doc_ids": pa.int64(), "parts": pa.string(), "marks": pa.int32(), "texts": pa.binary(),
    "starts": pa.int64(), "words": pa.int32(), "counts": pa.int32(),
}


def marks(texts: pa.Array) -> np.ndarray:
    """The bits of filters C and D that the texts fail."""
    data, ends = bytes_of(texts)

    def count(kind: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(kind[data]), ends))

    points = np.diff(ends) - count(_LATER)
    c = 100 * count(_UPPER) > UPPER_PERCENT * points
    d = count(_SYMBOL) > 0
    return c.astype(np.int32) << FILTERS.index("C") | d.astype(np.int32) << FILTERS.index("D")


def matrix(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """vocabulary (in the order of its hashes), starts, words, counts of the documents' matrix."""
    flat, lengths = words_of(texts)
    coded = flat.dictionary_encode()
    order = np.argsort(hashes(coded.dictionary), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    size = max(1, len(order))
    entries = np.repeat(np.arange(len(texts)), lengths) * size + place[coded.indices.to_numpy()]
    entries, counts = np.unique(entries, return_counts=True)
    starts = np.searchsorted(entries, np.arange(len(texts) + 1) * size)
    return coded.dictionary.take(pa.array(order)), starts, (entries % size).astype(np.int32), counts.astype(np.int32)


def _cut(lengths: np.ndarray, room: int) -> list[tuple[int, int]]:
    """Spans of consecutive values of at most ``room`` bytes together, or one longer value."""
    total, spans, start = np.cumsum(lengths), [], 0
    while start < len(lengths):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + room, "right")))
        spans.append((start, stop))
        start = stop
    return spans


def _shards(docs: DataFrame) -> DataFrame:
    """CSR shards whose word numbers are places in their own vocabulary (joined by blanks)."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    room = SHARD_BYTES

    def shard_of(number: int, held: pa.Table) -> pa.RecordBatch:
        one = held.combine_chunks()
        doc_ids, parts, texts = (one.column(c).combine_chunks() for c in ("doc_id", "part", "text"))
        vocabulary, starts, numbers, counts = matrix(texts)
        keys = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
        columns = [doc_ids, parts, marks(texts), keys, starts, numbers, counts]
        lists = [
            pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c, t))
            for c, t in zip(columns, _LISTS.values())
        ]
        blob = b" ".join(vocabulary.to_pylist())
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *lists, pa.array([blob]), pa.array([len(vocabulary)], pa.int64())],
            [*_MATRIX_NAMES, "vocabulary", "size"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_numpy()
            for start, stop in _cut(lengths, room):
                own = int(lengths[start:stop].sum())
                if held and size + own > room:
                    yield shard_of(number, pa.Table.from_batches(held))
                    number, held, size = number + 1, [], 0
                held.append(batch.slice(start, stop - start))
                size += own
        if size or sum(b.num_rows for b in held):
            yield shard_of(number, pa.Table.from_batches(held))

    return source.mapInArrow(run, f"{_MATRIX.format('int')}, vocabulary binary, size long")


def _bucketed(shards: DataFrame, buckets: int) -> DataFrame:
    """The vocabulary of every shard cut into the buckets' ranges: bucket, shard, first, words."""
    edges = np.array([k * (1 << 64) // buckets for k in range(buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column("shard").to_pylist(), batch.column("vocabulary")):
                words = pa.array(blob.as_py().split(b" "), pa.binary()) if blob.as_py() else pa.array([], pa.binary())
                cuts = np.append(np.searchsorted(hashes(words), edges), len(words))
                used = np.flatnonzero(np.diff(cuts))
                lists = pa.ListArray.from_arrays(pa.array(np.append(cuts[used], len(words)), pa.int32()), words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), number)), pa.array(cuts[used], pa.int64()),
                     pc.binary_join(lists, b" ")],
                    ["bucket", "shard", "first", "words"],
                )

    return shards.select("shard", "vocabulary").mapInArrow(
        run, "bucket long, shard long, first long, words binary"
    )


def _numbered(bucket: pa.Table) -> pa.Table:
    """One bucket: for each shard's words their ranks among the bucket's; and the words themselves."""
    parts = [blob.split(b" ") for blob in bucket.column("words").to_pylist()]
    coded = pa.array([w for part in parts for w in part], pa.binary()).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    ends = np.concatenate(([0], np.cumsum([len(part) for part in parts])))
    ranks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rank[coded.indices.to_numpy()]))
    words = b" ".join(coded.dictionary.take(pa.array(order)).to_pylist())
    number = bucket.column("bucket")[0].as_py()
    n = len(parts)
    return pa.table({
        "bucket": pa.array([number] * (n + 1)),
        "shard": pa.array([*bucket.column("shard").to_pylist(), None], pa.int64()),
        "first": pa.array([*bucket.column("first").to_pylist(), None], pa.int64()),
        "ranks": pa.concat_arrays([ranks, pa.array([None], pa.list_(pa.int32()))]),
        "words": pa.array([None] * n + [words], pa.binary()),
        "size": pa.array([None] * n + [len(order)], pa.int64()),
    })


def _renumbered(shards: pa.Table, numbers: pa.Table) -> pa.Table:
    """One shard with global word numbers, from the pieces (first, base, ranks) of its vocabulary."""
    pieces = [
        (first, base + ranks.values.to_numpy().astype(np.int64))
        for first, base, ranks in zip(
            numbers.column("first").to_pylist(), numbers.column("base").to_pylist(), numbers.column("ranks")
        )
    ]
    lookup = np.zeros(sum(len(p) for _, p in pieces), np.int64)
    for first, piece in pieces:
        lookup[first:first + len(piece)] = piece
    words = shards.column("words").combine_chunks()
    found = pa.ListArray.from_arrays(words.offsets, pa.array(lookup[words.flatten().to_numpy()]))
    return pa.table([found if n == "words" else shards.column(n) for n in _MATRIX_NAMES], names=_MATRIX_NAMES)


def document_terms(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shards, dictionary): CSR shards with global word numbers, and (word, number).

    A shard row holds doc_ids, parts, marks (failed bits of C and D) and text digests of its
    documents, and its matrix: document i has the words ``words[starts[i]:starts[i + 1]]`` with the
    ``counts`` at the same places. Numbers are dense from 0, by bucket and then by word.
    """
    with at_once(docs.sparkSession, DOCUMENTS_AT_ONCE):
        own = stage(_shards(docs), "shards", WIDE_ROWS)
    entries = own.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = _bucketed(own, entries // BUCKET_WORDS + 1)
    with at_once(docs.sparkSession, VOCABULARIES_AT_ONCE):
        found = stage(buckets.groupBy("bucket").applyInArrow(
            _numbered, "bucket long, shard long, first long, ranks array<int>, words binary, size long"
        ), "numbers", WIDE_ROWS)
    sizes = found.where("shard IS NULL").select("bucket", "size")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "bases")
    pieces = found.where("shard IS NOT NULL").select("bucket", "shard", "first", "ranks").join(bases, "bucket")
    shards = own.select(*_MATRIX_NAMES).groupBy("shard").cogroup(pieces.groupBy("shard")).applyInArrow(
        _renumbered, _MATRIX.format("long")
    )
    words = F.posexplode(F.split(F.col("words").cast("string"), " ")).alias("rank", "word")
    dictionary = found.where("shard IS NULL").join(bases, "bucket").select("base", words).select(
        "word", (F.col("base") + F.col("rank")).alias("number")
    )
    return shards, dictionary


def _documents(shards: DataFrame) -> DataFrame:
    """doc_id, part, text_key, failed (bits of A to D) of every document, from the matrix."""
    names = ["doc_id", "part", "text_key", "failed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = {n: batch.column(n).slice(at, 1).flatten() for n in batch.schema.names}
                starts = one["starts"].to_numpy(zero_copy_only=False)
                counts = one["counts"].to_numpy(zero_copy_only=False).astype(np.int64)
                before = np.concatenate(([0], np.cumsum(counts)))
                filled = np.concatenate(([0], np.cumsum(counts != 0)))
                total, distinct = np.diff(before[starts]), np.diff(filled[starts])
                failed = one["marks"].to_numpy(zero_copy_only=False).astype(np.int32)
                failed = failed | (total < LEAST_WORDS).astype(np.int32) << FILTERS.index("A")
                failed |= (100 * distinct < DISTINCT_PERCENT * total).astype(np.int32) << FILTERS.index("B")
                yield pa.RecordBatch.from_arrays([one["doc_ids"], one["parts"], one["texts"], pa.array(failed)], names)

    needed = shards.select("doc_ids", "parts", "marks", "texts", "starts", "counts")
    return needed.mapInArrow(run, "doc_id long, part string, text_key binary, failed int")


def rules(spark: SparkSession) -> DataFrame:
    """What happens to a document that fails the filters ``failed`` at each step of each order."""
    rows = []
    for failed in range(1 << len(FILTERS)):
        fails = {f for i, f in enumerate(FILTERS) if failed >> i & 1}
        removers = Counter(next((f for f in order if f in fails), "") for order in permutations(FILTERS))
        for order in permutations(FILTERS):
            gone = next((i for i, f in enumerate(order) if f in fails), len(order))
            rows += [
                (failed, "".join(order), i + 1, int(i < gone), int(i == gone), int(gone < i and f in fails),
                 int(fails == {f}), removers[f])
                for i, f in enumerate(order)
            ]
    return spark.createDataFrame(
        rows, "failed int, filter_order string, step int, stays int, goes int, late int, alone int, share int"
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A label is good at quality 1 and toxic at toxic 1.
    """
    shards, _ = document_terms(docs)
    same = ["text_key", "doc_id", "part", "failed"]
    with at_once(docs.sparkSession, SHARDS_AT_ONCE):
        facts = stage(_documents(shards).groupBy(*same).agg(F.count("*").alias("n")), "facts")
    first = facts.groupBy(F.col("text_key").alias("key")).agg(F.min("doc_id").alias("least"))
    is_first = (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("least"))
    copy_bit = F.when(F.col("key").isNull(), F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    failed = (
        facts.join(first, is_first, "left")
        .select("doc_id", "part", "n", F.col("failed").bitwiseOR(copy_bit).alias("failed"))
        .groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n"))
    )
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("marked")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    marked = failed.join(marks, F.col("doc_id") == F.col("marked"), "left")
    counts = marked.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce(F.col("good") * F.col("n"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(F.col("toxic") * F.col("n"), F.lit(0))).alias("toxic"),
    )

    def total(rows: str, of: str = "n"):
        return F.sum(F.col(rows) * F.col(of))

    return counts.join(F.broadcast(rules(docs.sparkSession)), "failed").groupBy("part", "filter_order", "step").agg(
        total("stays").alias("kept"), total("goes").alias("removed"), total("late").alias("redundant"),
        total("alone").alias("unique_fails"), total("goes", "good").alias("good_lost"),
        total("goes", "toxic").alias("toxic_lost"), total("share").alias("shapley"),
    )
