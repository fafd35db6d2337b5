"""Benchmark decontamination: a prefix-filtered join of documents with item-sized windows.

Every benchmark item is cut into windows of ``WINDOW`` consecutive words (a shorter item is one
window). A document contains a window exactly, so it must contain the window's rarest word: by the
global order of rarity (how often the documents use the word) the necessary prefix of a window is
that one word. A document position that holds a prefix word is joined with the windows of that word;
the one place that fits the word's position in the window must lie inside the document (the
positional and length bounds), and the words of the place must be those of the window.

All of this are joins and aggregates over rows, the same for a benchmark of any size. Tasks hold
only a bitmap of ``BITS`` bits of the words that matter (of windows, then of prefixes), which passes
all of them and, while they are few, little else; what else passes finds no partner in the joins. Texts
are named by their SHA-256 inside, so copies of a text are looked up once.

Defined cases: null or wordless texts have no words and no hits; null or wordless items have no
windows; repeated items count once by their item_id; an item whose id is null is named ``null``;
repeated documents are answered row by row; empty tables give empty results or no hits; other
columns are carried or ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinia.llm.common import PLAIN, packed, plain_words, stage
from affinia.llm.wordarrays import hashes, words_of

WINDOW = 10
BITS = 1 << 22
#: Keys up to which the contaminated texts are broadcast: 64 bytes each, 64 MB at most.
FEW = 1_000_000

_HITS = T.StructType([
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (window, item): the windows' words joined by blanks."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows, names = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = plain_words(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    windows.append(b" ".join(words[i:i + window]).decode())
                    names.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.string()), pa.array(names, pa.string())], ["window", "item"]
            )

    return items.mapInArrow(run, "window string, item string").distinct()


def bitmap(words: DataFrame, bits: int = BITS) -> np.ndarray:
    """A byte for each of ``bits`` hash values, 1 where a word of ``words`` (word) has it.

    The driver gets at most ``bits`` / 64 rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = hashes(batch.column(0).cast(pa.binary())) % np.uint64(bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(place).astype(np.int64))], ["place"])

    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    places = words.select("word").mapInArrow(run, "place long")
    held = np.zeros(bits // 64, np.int64)
    for r in places.groupBy(F.expr("place div 64").alias("at")).agg(F.bit_or(bit).alias("word")).collect():
        held[r["at"]] = r["word"]
    return np.unpackbits(held.view(np.uint8), bitorder="little")


def _words(batch: pa.RecordBatch, passes: np.ndarray):
    """The words of a batch's texts coded, the number of words of each, and the codes that pass."""
    flat, lengths = words_of(batch.column("text"), PLAIN)
    coded = flat.dictionary_encode()
    good = passes[hashes(coded.dictionary) % np.uint64(len(passes))] == 1
    return flat, coded, lengths, good


def word_counts(docs: DataFrame, passes: np.ndarray) -> DataFrame:
    """(word, n): how often the documents use the words that pass the bitmap."""
    held = docs.sparkSession.sparkContext.broadcast(np.packbits(passes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(held.value)
        for batch in batches:
            _, coded, _, good = _words(batch, passes)
            chosen = np.flatnonzero(good)
            n = np.bincount(coded.indices.to_numpy(), minlength=len(good))[chosen]
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(chosen)).cast(pa.string()), pa.array(n.astype(np.int64))], ["word", "n"]
            )

    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def prefixes(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(word, place, length, window): the rarest word of every window that documents may hold."""
    members = stage(
        windows.select("window").distinct().select("window", F.split("window", " ").alias("words"))
        .select("window", F.size("words").alias("length"), F.posexplode("words").alias("place", "word")),
        "members",
    )
    counts = word_counts(docs, bitmap(members.select("word").distinct()))
    rarest = F.min(F.struct(F.col("n"), F.col("word"), F.col("place"))).alias("rarest")
    # A window with a word that no document uses has no partner; it loses that row here.
    found = members.join(counts, "word").groupBy("window", "length").agg(rarest, F.count("*").alias("known"))
    return found.where(F.col("known") == F.col("length")).select(
        "rarest.word", "rarest.place", "length", "window"
    )


def _candidates(
    docs: DataFrame, carry: list[str], passes: np.ndarray, window: int
) -> DataFrame:
    """Per document row, key (of its text), n_words, and the places of words that pass the bitmap,
    each with the words around it."""
    held = docs.sparkSession.sparkContext.broadcast(np.packbits(passes))
    reach = window - 1
    row = packed(carry) if carry else F.struct(F.lit(None).cast("int").alias("none"))
    source = docs.select(
        row.alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    place = pa.struct([("at", pa.int32()), ("before", pa.int32()), ("word", pa.string()), ("around", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(held.value)
        for batch in batches:
            flat, coded, lengths, good = _words(batch, passes)
            start = np.concatenate(([0], np.cumsum(lengths)))
            at = np.flatnonzero(good[coded.indices.to_numpy()])
            doc = np.searchsorted(start, at, "right") - 1
            low, high = np.maximum(start[doc], at - reach), np.minimum(start[doc + 1], at + reach + 1)
            found = []
            for i, first, a, b in zip(at.tolist(), start[doc].tolist(), low.tolist(), high.tolist()):
                around = flat.slice(a, b - a).to_pylist()
                found.append({
                    "at": i - first, "before": i - a, "word": around[i - a].decode(),
                    "around": b" ".join(around).decode(),
                })
            cuts = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
            keys = [hashlib.sha256(t.as_buffer()).hexdigest() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(keys), pa.array(lengths.astype(np.int64)),
                 pa.ListArray.from_arrays(cuts, pa.array(found, place))],
                ["row", "key", "n_words", "places"],
            )

    return source.mapInArrow(run, T.StructType([
        source.schema["row"], T.StructField("key", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("places", T.ArrayType(T.StructType([
            T.StructField("at", T.IntegerType()), T.StructField("before", T.IntegerType()),
            T.StructField("word", T.StringType()), T.StructField("around", T.StringType()),
        ]))),
    ]))


def _occurrences(found: DataFrame, starts: DataFrame) -> DataFrame:
    """(key, start, end, window): the windows that texts hold, one row each."""
    places = found.select("key", F.explode("places").alias("p")).select("key", "p.*").distinct()
    words = F.split("around", " ")
    inside = (F.col("place") <= F.col("before")) & (
        F.col("before") - F.col("place") + F.col("length") <= F.size(words)
    )
    held = F.array_join(F.slice(words, F.col("before") - F.col("place") + 1, F.col("length")), " ")
    start = F.col("at") - F.col("place")
    return places.join(starts, "word").where(inside).where(held == F.col("window")).select(
        "key", start.alias("start"), (start + F.col("length")).alias("end"), "window"
    )


def _merged(spans: DataFrame) -> DataFrame:
    """(key, hits): the sorted intervals of a text's spans, those that meet or overlap as one."""
    kind = _HITS["hits"].dataType
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("hits", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [
                [{"start": a, "end": b} for a, b in merged(sorted((s["start"], s["end"]) for s in mine))]
                for mine in batch.column(1).to_pylist()
            ]
            shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits, shape)], ["key", "hits"])

    spans = spans.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return spans.mapInArrow(run, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _searched(
    docs: DataFrame, benchmark: DataFrame, carry: list[str], window: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(window, item); row, key, n_words of all documents; and the occurrences, all staged."""
    windows = stage(item_windows(benchmark, window), "windows")
    starts = stage(prefixes(docs, windows), "prefixes")
    found = stage(_candidates(docs, carry, bitmap(starts.select("word").distinct()), window), "places")
    return windows, found, stage(_occurrences(found, starts), "occurrences")


def contamination(
    docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None, window: int = WINDOW
) -> DataFrame:
    """Per document ``row`` (the carried columns) and ``result``: n_words, hits (maximal intervals of
    hit words) and items (names of the items with occurring windows, sorted)."""
    carry = docs.columns if carry is None else carry
    windows, found, occurrences = _searched(docs, benchmark, carry, window)
    items = (
        occurrences.select("key", "window").distinct().join(windows, "window")
        .groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hits = stage(_merged(occurrences).join(items, "key"), "hits")
    none = {f.name: F.array().cast(f.dataType) for f in _HITS}
    return found.select("row", "key", "n_words").join(hits, "key", "left").select(
        "row", F.struct(
            "n_words", *[F.coalesce(name, empty).alias(name) for name, empty in none.items()]
        ).alias("result"),
    )


def covered(hits):
    """Words covered by intervals that do not overlap."""
    return F.aggregate(
        hits, F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"]).cast("long")
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    _, _, occurrences = _searched(docs, benchmark, [], window)
    bad = stage(occurrences.select("key").distinct(), "contaminated")
    if bad.count() <= FEW:
        bad = F.broadcast(bad)
    key = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    rows = docs.select(packed(docs.columns).alias("row"), key.alias("text_key"))
    return rows.join(bad, F.col("text_key") == F.col("key"), "left_anti").select("row.*")
