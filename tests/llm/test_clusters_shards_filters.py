"""Clustering, sharding and the filter audit against plain definitions."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from affinia.llm import clustering, filter_audit, sharding


def bag(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("scale", [50, 1 << 23, 1 << 26])
def test_transform_and_search_are_exact(scale):
    rng = np.random.default_rng(scale)
    vectors = rng.integers(-scale, scale, (300, 64))
    matrix = np.array([[(-1) ** (i & j).bit_count() for j in range(64)] for i in range(64)])
    ordered = matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(axis=1), kind="stable")]
    assert (clustering.transformed(vectors) == vectors @ ordered.T).all()
    centroids = np.concatenate([vectors[:7], vectors[3:4]])  # the last one ties with another
    number, distance, work = clustering.nearest(vectors, centroids)
    full = ((vectors[:, None].astype(object) - centroids[None].astype(object)) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert work <= full.size * 64


def test_worse_centroids_are_dropped_early():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 64))
    near = centres[rng.integers(0, 8, 2000)] + 0.2 * rng.normal(size=(2000, 64))
    _, _, work = clustering.nearest(np.floor(1024 * near).astype(int), np.floor(1024 * centres).astype(int))
    assert work < 0.3 * 2000 * 8 * 64


VECTORS = "vec_id long, embedding array<double>, cluster int, distance long"


def test_clusters(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 5, 1) for _ in range(64)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 64) for i in range(150)]  # very many copies of one vector
    rows += [(7, [rng.gauss(0, 9) for _ in range(64)]), (7, rows[7][1])]
    rows += [(None, [1.0] * 64), (2001, None), (2002, [1.0] * 63), (2003, []), (2004, [None] + [1.0] * 63)]
    rows += [(2005, [float("nan")] + [1.0] * 63), (2006, [float("inf")] * 64), (2007, [1e30] * 64), (2008, [30_000.0] * 64)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], VECTORS).repartition(7)
    found = clustering.cluster(table).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    ).collect()
    assert bag(found) == bag(brute.lloyd(rows))


@pytest.mark.parametrize("count", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, count):
    rows = [(i, [float(i)] * 64) for i in range(count)]
    found = clustering.cluster(spark.createDataFrame([(i, v, 1, 2) for i, v in rows], VECTORS)).collect()
    assert bag(found) == bag(brute.lloyd(rows))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 1000, 1025, 65_536])
def test_permutation_of_every_row_number(n):
    places = sharding.permute(np.arange(n), n)
    assert sorted(places) == list(range(n))
    assert (sharding.unpermute(places, n) == np.arange(n)).all()
    assert n < 1000 or (places != sharding.permute(np.arange(n), n, seed=1)).any()


def test_permutation_of_very_many_rows():
    n = (1 << 45) + 12_345
    numbers = np.random.default_rng(0).integers(0, n, 5000)
    places = sharding.permute(numbers, n)
    assert (places < n).all() and (sharding.unpermute(places, n) == numbers).all()
    assert abs(np.corrcoef(numbers, places)[0, 1]) < 0.05


DOCS = "doc_id long, text string, source string, shard int, slot long, m map<string,int>"


def documents():
    rng = random.Random(9)
    rows = [(i * 7 % 301, rng.choice(["é京", "text ", "x"]) * rng.randrange(1, 300), "s") for i in range(301)]
    return rows + [(None, "same", "t")] * 150 + [(5, "", "t"), (5, None, "t"), (None, None, None)]


def test_shards_are_even_and_the_same_for_any_layout(spark, tmp_path):
    rows, layouts = documents(), []
    places = sharding.permute(np.arange(len(rows)), len(rows), 11)
    for partitions in (1, 9):
        random.Random(partitions).shuffle(rows)
        table = spark.createDataFrame([(*r, 1, 2, {"k": 1}) for r in rows], DOCS).repartition(partitions)
        made = sharding.assign(table, seed=11).cache()
        found = made.select("row.doc_id", "row.text", "size", "text_crc32", "number", "shard", "slot").collect()
        assert Counter((r.doc_id, r.text) for r in found) == Counter((d, t) for d, t, _ in rows)
        order = {r.number: r.doc_id for r in found}
        assert [order[i] for i in range(len(rows))] == sorted(order.values(), key=lambda d: (d is None, d or 0))
        slots = defaultdict(list)
        for r in found:
            data = (r.text or "").encode()
            assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
            assert places[r.number] == r.slot * 16 + r.shard
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 16
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
        layouts.append(bag((r.doc_id, r.text, r.shard, r.slot) for r in found))
    assert layouts[0] == layouts[1]
    folder = str(tmp_path / "shards")
    sharding.write(made, folder)
    back = spark.read.parquet(folder)
    assert bag(back.select("row.doc_id", "row.text", "shard", "slot").collect()) == layouts[0]


def test_shards_of_no_rows(spark):
    assert sharding.assign(spark.createDataFrame([], DOCS)).isEmpty()


AUDITED = "doc_id long, text string, source string, n_chars long, part string, failed int, step int"


def audited():
    rng = random.Random(5)
    texts = [None, "", " \n", "A$", "one two", "É" * 50]
    for _ in range(40):
        body = [rng.choice(["Aa", "bb", "cC", "京都", "x#", "The", *map(str, range(300))]) for _ in range(rng.choice([50, 250, 400]))]
        texts.append(" ".join(body if rng.random() < 0.6 else body[:3] * 90))
    texts.append(" ".join(f"w{rng.randrange(900)}" for _ in range(50_000)))  # very long
    rows = [(i, rng.choice(texts), rng.choice(["s", "t", None, ""])) for i in range(200)]
    rows += [(500 + i, texts[10], "s") for i in range(90)] + [(None, texts[10], "s")] * 40
    return rows + [(3, texts[7], "t"), (3, texts[7], "s"), (None, "alone", "u"), (None, "alone", "u")]


@pytest.mark.parametrize("room,words", [(16 << 20, 1 << 20), (2000, 50)])
def test_filter_audit(spark, room, words, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", room)
    monkeypatch.setattr(filter_audit, "BUCKET_WORDS", words)
    rows = audited()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(150)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "clash", 3, 4) for r in rows], AUDITED).repartition(3)
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    ).collect()
    assert bag(found) == bag(brute.filter_table(rows, labels))


def test_document_terms_hold_every_word(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 3000)
    monkeypatch.setattr(filter_audit, "BUCKET_WORDS", 100)
    rows = [(i, t, s) for i, (_, t, s) in enumerate(audited())]
    docs = spark.createDataFrame([(*r, 1, "clash", 3, 4) for r in rows], AUDITED).repartition(3)
    shards, dictionary = filter_audit.document_terms(docs)
    words = {r.number: r.word for r in dictionary.collect()}
    assert sorted(words) == list(range(len(set(words.values()))))
    found = {}
    for s in shards.collect():
        for k, doc in enumerate(s.doc_ids):
            span = slice(s.starts[k], s.starts[k + 1])
            found[doc] = {words[w]: n for w, n in zip(s.words[span], s.counts[span])}
    assert found == {i: dict(Counter(brute.BLANK.findall(t or ""))) for i, t, _ in rows}


def test_words_and_characters_of_texts():
    texts = ["", " a  b\x0b\x0cc\t\n a", "", "x a a", " é z \x1c a", "  ", "a", "b", "ÉÉ A", "A%"]
    array = pa.array(["drop", *texts])[1:]  # with an offset
    vocabulary, starts, words, counts = filter_audit.matrix(array)
    held = [w.decode() for w in vocabulary.to_pylist()]
    for i, text in enumerate(texts):
        span = slice(starts[i], starts[i + 1])
        assert {held[w]: n for w, n in zip(words[span], counts[span])} == Counter(brute.BLANK.findall(text))
    assert filter_audit.marks(array).tolist() == [0] * 8 + [4, 12]


def test_filter_audit_of_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], AUDITED), labels).isEmpty()
