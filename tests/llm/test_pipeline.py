"""The stages against plain definitions, each on what its predecessor kept."""

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from affinia.llm import quality
from affinia.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    after = [docs]
    for name, step in corpus_pipeline.STAGES:
        after.append(stage(step(spark, after[-1], SF), name))
    assert all(d.columns == docs.columns for d in after[:-1])
    texts = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d in after[:-1]]

    model = quality.train(docs, table(spark, SF, "labels"))
    good = quality.scored(docs, model).where("score >= 0.7").select("row.doc_id").collect()
    assert texts[1].keys() == {r.doc_id for r in good}

    prints = [(d, brute.fingerprint(t)) for d, t in texts[1].items()]
    assert texts[2].keys() == set(brute.classes(prints))

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    found = brute.contamination(list(texts[2].items()), items)
    assert texts[3].keys() == {d for d, *_, bad in found if not bad}

    assert texts[4].keys() == texts[3].keys()
    for doc, text in texts[3].items():
        assert not brute.personal(texts[4][doc]) and (brute.personal(text) or texts[4][doc] == text)
    assert after[4].where(F.col("n_chars") != F.length("text")).isEmpty()

    slow = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: np.array(slow.encode(t, add_special_tokens=False).ids + [2], "<u4") for d, t in texts[4].items()}
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert brute.packing_faults(after[5].select(*columns).collect(), ids) == ""
