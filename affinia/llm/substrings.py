"""Substring deduplication: repeated windows of ``WINDOW`` words, merged into removal intervals.

A window is the Rabin-Karp hash (polynomial modulo 2^64 over 64-bit word hashes) of 13 consecutive
words; all windows of all documents are hashed and counted. A word is removed if a window over it
also starts in a document with a smaller doc_id.

Most windows occur once, so counting goes in two steps. Documents are dealt into chunks by a hash.
First, every chunk sends a 32-bit code of each of its distinct windows to the bucket that the top
bits of the hash name; a bucket reports the codes that it got twice or more. Second, the windows
with such codes are sent in full, with the smallest and the largest doc_id of the chunk that has
them; a bucket reports those that start in a smaller document elsewhere. A chunk sends a window
once, however often it occurs, so a passage shared by a third of all documents is one row a chunk.
The numbers of chunks and buckets grow with the corpus, and the codes with them (bucket bits + 32).
The documents are shuffled by chunk once; the three passes read the same exchange.

Windows with equal 64-bit hashes count as equal; their words are not compared. Of n different windows
about n^2 / 2^65 pairs are expected to collide: 0.7 for 5e9 windows (30 GB), 70 for ten times as many.
Each such pair may remove 13 words that do not repeat.

Defined cases: null and blank texts have no words; a text shorter than a window has none; a null
doc_id counts as larger than any other; rows that share a doc_id are one document when compared and
are answered row by row; empty tables give empty results; other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from affinia.llm.common import blank_words, packed

WINDOW = 13
CHUNK_CHARS = 4 << 20
BUCKET_WINDOWS = 1 << 20
CACHE = 300_000
BASE = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
ROW_CHARS = 64  # what a row counts for besides its text
NO_ID = np.iinfo(np.int64).max

_CODES = "bucket long, chunk long, codes binary, twice binary"
_WINDOWS = "bucket long, chunk long, keys binary, seconds binary, low binary, range binary"
_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ]))),
    T.StructField("kept", T.StringType()),
])


class WordHashes(dict):
    """64-bit hashes of words, with the latest words at hand."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, window: int = WINDOW, base: np.uint64 = BASE) -> np.ndarray:
    """The Rabin-Karp hash of every window of word hashes, with its bits mixed."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(window):
        total *= base
        total += hashes[k:k + n]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(29)
    return total


def second(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """32 bits of a rolling hash of another base."""
    return (rolling(hashes, window, SECOND) >> np.uint64(32)).astype(np.uint32)


def _windows(chunk: pa.Table, window: int, both: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of a chunk's documents, their second hashes where asked for, and the
    doc_id of each window."""
    known = WordHashes()
    texts = [known.of(blank_words(t)) for t in chunk.column("text").to_pylist()]
    found = [rolling(t, window) for t in texts]
    seconds = [second(t, window) for t in texts] if both else []
    ids = chunk.column("id").fill_null(NO_ID).to_numpy()
    return _joined(found, np.uint64), _joined(seconds, np.uint32), np.repeat(ids, [len(x) for x in found])


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def _grouped(keys: np.ndarray, seconds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of (key, second), and where in it each run of equal ones begins."""
    order = np.lexsort((seconds, keys))
    k, s = keys[order], seconds[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    return order, np.flatnonzero(new)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    first = _starts(bucket)
    for a, b in zip(first, [*first[1:], len(bucket)]):
        yield int(bucket[a]), slice(a, b)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [pa.int64() if field.endswith("long") else pa.binary() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def _read(table: pa.Table, column: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(value, kind) for value in table.column(column).to_pylist()]


def _joined(parts: list[np.ndarray], kind: str) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def sizes(chars: int, rows: int, chunk_chars: int, bucket_windows: int) -> tuple[int, int]:
    """The number of chunks, and the bits of the number of buckets."""
    bits = int(chars // (6 * bucket_windows)).bit_length()
    grown = chunk_chars * min(16, max(1, (1 << bits) >> 11))
    return (chars + ROW_CHARS * rows) // grown + 1, bits


def remove_repeats(
    docs: DataFrame, carry: list[str] | None = None, window: int = WINDOW,
    chunk_chars: int = CHUNK_CHARS, bucket_windows: int = BUCKET_WINDOWS,
) -> DataFrame:
    """Per document ``row`` (the carried columns, without text) and ``result``: n_words, n_removed,
    the removed word intervals, and the kept words joined by blanks."""
    carry = [c for c in docs.columns if c != "text"] if carry is None else carry
    chars, rows = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count("*")).first()
    chunks, bits = sizes(chars, rows, chunk_chars, bucket_windows)
    code_shift, bucket_shift = np.uint64(32 - bits), np.uint64(32)

    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"),
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"),
        packed(carry).alias("row"),
    )

    def send_codes(chunk: pa.Table) -> pa.Table:
        hashes, _, _ = _windows(chunk, window)
        codes = np.sort(hashes >> code_shift)
        first = _starts(codes)
        twice = np.diff(np.append(first, len(codes))) > 1
        codes = codes[first]
        number = chunk.column("chunk")[0].as_py()
        return _table([
            (b, number, codes[s].astype("<u4").tobytes(), twice[s].tobytes())
            for b, s in _by_bucket(codes >> bucket_shift)
        ], _CODES)

    def repeated_codes(sent: pa.Table) -> pa.Table:
        codes, twice = _read(sent, "codes", "<u4"), _read(sent, "twice", "?")
        whole = np.sort(_joined(codes, "<u4"))
        first = _starts(whole)
        often = whole[first][np.diff(np.append(first, len(whole))) > 1]
        rows = []
        bucket = sent.column("bucket")[0].as_py()
        for number, mine, flag in zip(sent.column("chunk").to_pylist(), codes, twice):
            chosen = mine[flag | np.isin(mine, often, assume_unique=True)]
            if len(chosen):
                rows.append((bucket, number, chosen.tobytes()))
        return _table(rows, "bucket long, chunk long, codes binary")

    def send_windows(chunk: pa.Table, repeated: pa.Table) -> pa.Table:
        if not chunk.num_rows or not repeated.num_rows:
            return _table([], _WINDOWS)
        wanted = np.sort(np.concatenate([
            codes.astype(np.uint64) | np.uint64(bucket << 32)
            for bucket, codes in zip(repeated.column("bucket").to_pylist(), _read(repeated, "codes", "<u4"))
        ]))
        hashes, seconds, ids = _windows(chunk, window, both=True)
        codes = hashes >> code_shift
        at = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
        hit = wanted[at] == codes
        keys, seconds, ids = hashes[hit], seconds[hit], ids[hit]
        order, first = _grouped(keys, seconds)
        if not len(first):
            return _table([], _WINDOWS)
        low, high = np.minimum.reduceat(ids[order], first), np.maximum.reduceat(ids[order], first)
        keys, seconds = keys[order][first], seconds[order][first]
        number = chunk.column("chunk")[0].as_py()
        return _table([
            (b, number, keys[s].tobytes(), seconds[s].tobytes(), low[s].tobytes(), (high[s] - low[s]).tobytes())
            for b, s in _by_bucket(keys >> code_shift >> bucket_shift)
        ], _WINDOWS)

    def repeated_windows(sent: pa.Table) -> pa.Table:
        keys, seconds = _read(sent, "keys", "<u8"), _read(sent, "seconds", "<u4")
        low, span = _read(sent, "low", "<i8"), _read(sent, "range", "<i8")
        all_low = _joined(low, "<i8")
        order, first = _grouped(_joined(keys, "<u8"), _joined(seconds, "<u4"))
        if not len(first):
            return _table([], "chunk long, keys binary, seconds binary, low binary")
        least = np.empty(len(order), np.int64)
        least[order] = np.repeat(
            np.minimum.reduceat(all_low[order], first), np.diff(np.append(first, len(order)))
        )
        rows, at = [], 0
        for number, k, s, a, r in zip(sent.column("chunk").to_pylist(), keys, seconds, low, span):
            smallest = least[at:at + len(k)]
            at += len(k)
            later = smallest < a + r
            if later.any():
                rows.append((number, k[later].tobytes(), s[later].tobytes(), smallest[later].tobytes()))
        return _table(rows, "chunk long, keys binary, seconds binary, low binary")

    out_schema = T.StructType([dealt.schema["row"], T.StructField("result", _RESULT)])
    out_arrow = to_arrow_type(_RESULT)

    def remove(chunk: pa.Table, repeated: pa.Table) -> pa.Table:
        keys, seconds, low = (
            _joined(_read(repeated, c, k), k) for c, k in (("keys", "<u8"), ("seconds", "<u4"), ("low", "<i8"))
        )
        order = np.lexsort((seconds, keys))
        keys, seconds, low = keys[order], seconds[order], low[order]
        same = np.diff(np.append(_starts(keys), len(keys))).max(initial=0)  # windows of one first hash
        known, out = WordHashes(), []
        ids = chunk.column("id").fill_null(NO_ID).to_pylist()
        for text, doc_id in zip(chunk.column("text").to_pylist(), ids):
            words = blank_words(text)
            spans: list[tuple[int, int]] = []
            if len(keys) and len(words) >= window:
                own = known.of(words)
                hashes = rolling(own, window)
                first = np.searchsorted(keys, hashes)
                gone = np.zeros(len(hashes), bool)
                other = None
                for more in range(same):
                    at = np.minimum(first + more, len(keys) - 1)
                    met = (keys[at] == hashes) & (low[at] < doc_id)
                    if met.any():
                        other = second(own, window) if other is None else other
                        gone |= met & (seconds[at] == other)
                spans = intervals(np.flatnonzero(gone), window)
            kept, end = [], 0
            for a, b in spans:
                kept += words[end:a]
                end = b
            kept += words[end:]
            out.append({
                "n_words": len(words), "n_removed": len(words) - len(kept),
                "removed": [{"start": a, "end": b} for a, b in spans],
                "kept": b" ".join(kept).decode(),
            })
        return pa.table([chunk.column("row"), pa.array(out, out_arrow)], ["row", "result"])

    by_chunk = dealt.groupBy("chunk")
    codes = by_chunk.applyInArrow(send_codes, _CODES).groupBy("bucket").applyInArrow(
        repeated_codes, "bucket long, chunk long, codes binary"
    )
    windows = by_chunk.cogroup(codes.groupBy("chunk")).applyInArrow(send_windows, _WINDOWS)
    answers = windows.groupBy("bucket").applyInArrow(
        repeated_windows, "chunk long, keys binary, seconds binary, low binary"
    )
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(remove, out_schema)


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals covered by windows that begin at the sorted ``starts``."""
    if not len(starts):
        return []
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > starts[:-1] + window)))
    last = np.append(first[1:], len(starts)) - 1
    return list(zip(starts[first].tolist(), (starts[last] + window).tolist()))
