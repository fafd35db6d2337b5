"""Operators on small tables with nulls, blanks, repeats, ties and clashing columns."""

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from affinia.llm import (
    ann, decontaminate, licenses, packing, pii, quality, queries, simhash, substrings, toxicity, warc,
)

WORDS = [f"w{i}" for i in range(40)] + ["The", "of", "É", "京都", "x-y", "..."]
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, result string, row int, fp int"


def texts(seed=0):
    rng = random.Random(seed)
    passage = " ".join(rng.choice(WORDS) for _ in range(40))
    out = [None, "", " \t\n", "one", "a b c", passage, passage, passage.upper()]
    for _ in range(50):
        body = [rng.choice(WORDS) for _ in range(rng.choice([3, 12, 13, 60, 200]))]
        if rng.random() < 0.5:
            body.insert(rng.randrange(len(body)), passage)
        out.append(rng.choice([" ", "\n", "  "]).join(body))
    out += [f"{passage} tail{i}" for i in range(12)]  # near copies
    out.append(" ".join(rng.choice(WORDS) for _ in range(30_000)))  # very long
    out.append("mail jo@ex.org and 10.0.0.1 or +1 (555) 555-0101, card 4111 1111 1111 1111")
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3 % 101, t) for i, t in enumerate(texts())]
    return out + [out[20], out[20], (None, texts()[5]), (None, "alone in here")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 1, "clash", 7, 8) for d, t in rows], DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def bag(rows):
    return sorted(map(repr, map(tuple, rows)))


def items():
    t = texts()
    return [(3, t[5]), (4, t[5]), (4, t[5]), (None, t[30]), (5, None), (6, ""), (7, "w1 W2"), (8, "京都"), (10, t[40])]


@pytest.mark.parametrize("bits", [1 << 22, 64])
def test_contamination(spark, docs, rows, bits, monkeypatch):
    """With a bitmap that nearly everything passes the joins alone decide."""
    monkeypatch.setattr(decontaminate.bitmap, "__defaults__", (bits,))

    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items()], "item_id long, text string, item int")
    found = decontaminate.contamination(docs, benchmark, ["doc_id"])
    hit = decontaminate.covered(F.col("result.hits"))
    mine = found.select(
        "row.doc_id", "result.n_words", hit, F.size("result.items"),
        F.sha2(F.array_join("result.items", ","), 256), hit > 0,
    ).collect()
    assert bag(mine) == bag(brute.contamination(rows, items()))


def test_clean_keeps_rows_and_columns(spark, docs, rows):
    benchmark = spark.createDataFrame([(1, texts()[5])], "item_id long, text string")
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    expected = [d for d, *_, bad in brute.contamination(rows, [(1, texts()[5])]) if not bad]
    assert bag((r.doc_id,) for r in kept.collect()) == bag((d,) for d in expected)


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates(docs, rows, block):
    prints = [(d, brute.fingerprint(t)) for d, t in rows]
    expected = [(d, f - 2**64 if f >> 63 else f, c) for (d, f), c in zip(prints, brute.classes(prints))]
    assert bag(simhash.near_duplicates(docs, block=block).collect()) == bag(expected)


def test_keep_one_of_each_class(docs, rows):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    prints = [(d, brute.fingerprint(t)) for d, t in rows]
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for c in brute.classes(prints) if c is not None})


def test_keep_one_where_ids_repeat_or_are_null(spark):
    rng = random.Random(3)
    a, b, c, d, e = sorted(" ".join(rng.choice(WORDS[:40]) for _ in range(60)) for _ in range(5))
    upper = str.upper  # a copy, as case does not count; upper case sorts before lower case
    rows = [(5, b), (5, a), (3, upper(a)), (7, c), (7, d), (8, upper(d)), (None, e), (None, upper(e)), (None, e), (9, None), (9, "")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag(kept) == bag([(5, b), (3, upper(a)), (7, c), (7, d), (None, upper(e)), (9, None)])


@pytest.mark.parametrize("chunk,bucket", [(4 << 20, 1 << 20), (500, 300)])
def test_repeated_passages(docs, rows, chunk, bucket):
    mine = substrings.remove_repeats(docs, ["doc_id"], chunk_chars=chunk, bucket_windows=bucket).select(
        "row.doc_id", "result.n_words", "result.n_removed", F.sha2("result.kept", 256)
    )
    assert bag(mine.collect()) == bag(brute.without_repeats(rows))


def test_windows_whose_first_hash_collides(docs, rows, monkeypatch):
    """With one value for every window the second hash alone tells them apart."""
    real = substrings.rolling

    def rolling(hashes, window=13, base=substrings.BASE):
        found = real(hashes, window, base)
        return found if base == substrings.SECOND else found & np.uint64(3)

    monkeypatch.setattr(substrings, "rolling", rolling)
    short = [(d, t) for d, t in rows if t is None or len(t) < 2000]
    spark = docs.sparkSession
    table = spark.createDataFrame(short, "doc_id long, text string")
    mine = substrings.remove_repeats(table, ["doc_id"], chunk_chars=2000).select(
        "row.doc_id", "result.n_words", "result.n_removed", F.sha2("result.kept", 256)
    )
    assert bag(mine.collect()) == bag(brute.without_repeats(short))


def test_chunks_are_bounded_in_rows_and_grow_with_the_buckets():
    assert substrings.sizes(0, 1_000_000, 4 << 20, 1 << 20)[0] >= 15
    few, bits = substrings.sizes(30 << 30, 15_000_000, 4 << 20, 1 << 20)
    windows = (30 << 30) / 6
    assert windows / few / (1 << bits) > 150  # codes of a chunk for a bucket


def test_personal_data(docs, rows):
    found = pii.find(docs, ["doc_id"], sample=3000).select("row.doc_id", "result.base", "result.redacted").collect()
    expected = [(d, [f"{k}:{a}:{b}" for k, a, b in brute.personal(t)]) for d, t in rows]
    assert bag((r.doc_id, r.base) for r in found) == bag(expected)
    clean = pii.redact(docs, sample=3000)
    assert clean.columns == docs.columns
    text = "mail <EMAIL> and <IP> or <PHONE>, card <CARD>"
    assert clean.where(F.col("text") == text).select("n_chars").first()[0] == len(text)


LOOSE = [
    ("write jo [at] ex [dot] org, ok", ["email:6:26"], "write <EMAIL>, ok"),
    ("the card 4111/1111/1111/1111, ok", ["card:9:28"], "the card <CARD>, ok"),
    ("my tel (0541) 555 0101, ok", ["phone:7:22"], "my tel <PHONE>, ok"),
    ("host 10 . 0 . 0 . 1 ok", ["ip:5:19"], "host <IP> ok"),
    ("aux 7536784127813050 4845168114407329 eai", ["card:4:20", "card:21:37"], "aux <CARD> <CARD> eai"),
    ("Des +1 (826) 555-4081 190.137.223.204 du", ["ip:22:37", "phone:4:21"], "Des <PHONE> <IP> du"),
    ("years 2001 2002 2003 2004 2005, or 7536784127813051", [], "years 2001 2002 2003 2004 2005, or 7536784127813051"),
    ("the card 4111/1111/1111/1112, the number 5550101", [], "the card 4111/1111/1111/1112, the number 5550101"),
    ("1. 2. 3. 4 and a1234567b", [], "1. 2. 3. 4 and a1234567b"),
    (None, [], None),
]


def test_personal_data_of_looser_formats_is_added(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(LOOSE)], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs, ["doc_id"]).select("row.doc_id", "result.spans", "result.redacted").collect()}
    for i, (_, spans, clean) in enumerate(LOOSE):
        assert (found[i].spans, found[i].redacted) == (spans, clean)


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(VOCABULARY)
    numbered = [(i, t) for i, (_, t) in enumerate(rows)]
    ids = {i: np.array(slow.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in numbered}
    spark = docs.sparkSession
    table = spark.createDataFrame([(i, t, 0, 0) for i, t in numbered], "doc_id long, text string, part int, rest int")
    for sequence in (4096, 64):
        pieces = packing.pack(table, VOCABULARY, ["doc_id"], sequence).select(
            "row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
        ).collect()
        assert brute.packing_faults(pieces, ids, sequence) == ""


def test_licences_of_a_table(docs, spark):
    notice = spark.createDataFrame([(1, "Released under the MIT License."), (2, None), (2, "")], "doc_id long, text string")
    found = {(r[0], tuple(r[1])) for r in licenses.scan(notice, ["doc_id"]).select("row.doc_id", "result.licences").collect()}
    assert found == {(1, ("MIT",)), (2, ())}
    assert licenses.scan(docs).count() == docs.count()


def test_archive_round_trip(spark, tmp_path):
    html = "<p>" + "é" * 100
    pages = [(5, html), (3, html), (3, html), (9, html), (None, html), (1, None), (2, ""), (4, "short"), (6, "short")]
    pages += [(100 + i, f"<p>{i} " + "x" * i * 97) for i in range(60)]
    table = spark.createDataFrame(
        [(i, None if i == 4 else f"http://h/{i} a\n", h, 0, "x") for i, h in pages],
        "page_id long, url string, html string, first int, digest string",
    )
    folder = str(tmp_path / "archive")
    warc.write(table.repartition(3), folder)
    for size in (8 << 20, 500):
        back = warc.read(spark, folder, size)
        mine = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert bag(mine) == bag(brute.archive(pages))
        blocks = back.where("record_type = 'response'").select("page_id", F.col("payload").cast("string")).collect()
        assert {(p, t) for p, t in blocks} <= {(p, h or "") for p, h in pages}


@pytest.mark.parametrize("vectors", [4096, 90])
def test_nearest(spark, vectors):
    rng = np.random.default_rng(8)
    table = [(i, rng.standard_normal(8).tolist()) for i in range(700)]
    table += [(1000 + i, [0.5] * 8) for i in range(30)] + [(1100, [0.5] * 8)]  # ties
    table += [(1200, [0.0] * 8), (1300, None), (1400, [float("nan")] * 8), (1500, [1.0, None]), (1501, []), (1600, [1.0, 2.0]), (1601, [1.0, 2.5])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in table], "vec_id long, embedding array<float>, dim int, rank int")
    found = {}
    for r in ann.nearest(df, vectors=vectors).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    expected = brute.nearest([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in table])
    assert found.keys() == {q for q, near in expected.items() if near}
    right = total = 0
    for q, near in expected.items():
        mine = [found[q][k + 1] for k in range(len(near))]
        right += len({v for _, v in mine} & {v for _, v in near})
        total += len(near)
    assert right >= 0.95 * total
    assert [v for _, v in (found[1000][k] for k in range(1, 11))] == list(range(1001, 1011))
    assert found[1600] == {1: (0.5, 1601)}


def test_scores_without_labels_and_of_blank_texts(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    untrained = quality.train(docs, labels)
    assert {r.score for r in quality.scored(docs, untrained).collect()} == {0.5}
    assert quality.keep_good(docs, labels).count() == docs.count()
    model = toxicity.train(docs, labels)
    assert all(r[0] < 1e-9 for r in toxicity.scored(docs, model).select("result.score").collect())
    some = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(101)] + [(None, 1, 1), (3, None, None)], labels.schema)
    for score in (
        quality.scored(docs, quality.train(docs, some)).select("row.doc_id", "score").collect(),
        toxicity.scored(docs, toxicity.train(docs, some)).select("row.doc_id", "result.score").collect(),
    ):
        assert len(score) == docs.count() and all(0 <= s <= 1 for _, s in score)


def test_empty_tables(spark, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, benchmark).isEmpty()
    assert simhash.near_duplicates(none).isEmpty() and simhash.keep_one(none).isEmpty()
    assert substrings.remove_repeats(none).isEmpty()
    assert pii.redact(none, sample=3000).isEmpty() and licenses.scan(none).isEmpty()
    assert packing.pack(none, VOCABULARY).isEmpty()
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).isEmpty()
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(none, labels).isEmpty()
    assert toxicity.scored(none, toxicity.train(none, labels)).isEmpty()


def test_empty_archive(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read(spark, folder).isEmpty()


@pytest.mark.parametrize("name,modulus,rest,mark", [
    ("op1_quality_rules", 4, 2, "quality"), ("op6_toxicity", 3, 1, "toxic"),
])
def test_held_out_accuracy(spark, name, modulus, rest, mark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", mark)
    rows = queries.QUERIES[name](spark, sf).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[mark] for r in held]) > 0.95
    chosen = [r for r in held if r.predicted]
    assert np.mean([r[mark] for r in chosen]) > 0.95
