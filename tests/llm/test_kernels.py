"""Numpy and text helpers against plain definitions."""

import re
import time
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from affinia.llm import ann, licenses, packing, pii, quality, simhash, substrings, toxicity, trees, warc
from affinia.llm.common import blank_words, plain_words
from affinia.llm.tokens import Tokens

TEXT = st.text(st.sampled_from("aAbBzZ019 \t\n\r\x0b\x0c\x1c\x85\xa0._-!é京"), max_size=60)


@given(TEXT)
def test_words(text):
    assert [w.decode() for w in blank_words(text)] == brute.BLANK.findall(text)
    assert [w.decode() for w in plain_words(text)] == brute.PLAIN.findall(brute.lower(text))
    assert simhash.fingerprint(text) == brute.fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_comparison(radius):
    rng = np.random.default_rng(radius)
    sizes = np.array([1, 2, 63, 64, 65, 300, 3])
    values = rng.integers(0, 2**63, sizes.sum(), dtype=np.uint64)
    for i in range(1, len(values)):  # most values are near the one before
        if rng.random() < 0.7:
            values[i] = values[i - 1] ^ np.uint64(sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 9)))))
    group = np.repeat(np.arange(len(sizes)), sizes)
    expected = {
        (i, j) for i in range(len(values)) for j in range(i + 1, len(values))
        if group[i] == group[j] and int(values[i] ^ values[j]).bit_count() <= radius
    }
    i, j = simhash.compare(values, sizes, radius)
    assert len(i) == len(expected) and set(zip(i.tolist(), j.tolist())) == expected


@pytest.mark.parametrize("distinct", [10, 10**8, 10**11])
def test_every_near_pair_shares_a_mask(distinct):
    masks = [m & (2**64 - 1) for m in simhash._masks(distinct, 4)]
    rng = np.random.default_rng(1)
    for _ in range(500):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(flips & m == 0 for m in masks)


@given(st.binary(max_size=90), st.binary(max_size=90))
def test_crc_of_a_tail(head, tail):
    assert packing.crc_between(zlib.crc32(head + tail), zlib.crc32(head), len(tail)) == zlib.crc32(tail)


def test_nnls_and_plan_use_no_more_than_there_is():
    rng = np.random.default_rng(0)
    histogram = rng.integers(0, 300, 4096)
    histogram[0] = 0
    rows, sequences, taken = packing.plan(histogram)
    assert (taken <= histogram).all() and taken.sum() > 0.5 * histogram.sum()
    used = np.zeros(4096, np.int64)
    load = np.zeros(sequences, np.int64)
    for length, a, b, first, _ in rows:
        assert a == used[length]
        used[length] = b
        load[first:first + b - a] += length
    assert (used == taken).all() and load.max() <= 4096 and load.min() > 4096 - 4 * 16


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aBçÉñ 's'tDon'tl19½²-_!.,\t\n\xa0<|endoftext|>京ſ"), max_size=40))
def test_token_ids(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    if not hasattr(test_token_ids, "both"):
        test_token_ids.both = Tokens(path, 2), Tokenizer.from_file(path)
    fast, slow = test_token_ids.both
    assert np.frombuffer(fast.ids(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids + [2]


def test_rolling_hash_tells_windows_apart():
    known = substrings.WordHashes()
    a, b = known.of([b"x", b"y", b"z", b"x", b"y"]), known.of([b"q", b"x", b"y", b"z"])
    ha, hb = substrings.rolling(a, 3), substrings.rolling(b, 3)
    assert ha[0] == hb[1] and len({*ha.tolist(), *hb.tolist()}) == 4
    assert substrings.intervals(np.array([0, 2, 13, 40]), 13) == [(0, 26), (40, 53)]


@settings(max_examples=300)
@given(st.text(st.sampled_from("ab.-_@+ ()0123456789é"), max_size=50))
def test_base_spans(text):
    assert pii.base_spans(text) == brute.personal(text)


def test_addresses_with_very_many_zeros():
    zeros = "0" * 5000
    for text, inside in ((f"x {zeros}.1.2.3 y", True), (f"{zeros}1.{zeros}255.0.{zeros}", True), (f"1.2.{zeros}256.4", False)):
        found = [s for s in pii.base_spans(text) if s[0] == "ip"]
        assert bool(found) == inside and found == [s for s in brute.personal(text) if s[0] == "ip"]


def test_base_spans_of_long_runs_are_fast():
    text = "a" * 200_000 + " " + "1" * 200_000 + " " + "+1" + "(" * 200_000 + "@" * 50_000
    assert pii.base_spans(text) == []


def test_candidates_of_many_addresses_are_fast():
    started = time.perf_counter()
    found = pii.candidates("abcdefghij@" * 20_000)
    assert time.perf_counter() - started < 5 and not found
    text = "a.b@c.de@f.gh x@y [at] z.org, " + "l" * 80 + "@m.no"
    spans = {text[a:b] for k, a, b in pii.candidates(text) if k == "email"}
    assert spans == {"a.b@c.de", "c.de@f.gh", "y [at] z.org", "l" * 64 + "@m.no"}


def test_candidates_are_wider_than_the_base():
    text = "write jo [at] ex [dot] org, card 4111/1111/1111/1111, tel (0541) 555 0101"
    kinds = {(k, text[a:b]) for k, a, b in pii.candidates(text)}
    assert ("email", "jo [at] ex [dot] org") in kinds and ("card", "4111/1111/1111/1111") in kinds
    assert pii.redacted("a@b.c x 1.2.3.4", pii.base_spans("a@b.c x 1.2.3.4")) == "<EMAIL> x <IP>"


def test_planted_values_and_formats_never_seen():
    """Labels come from what was planted; thresholds hold for formats that training does not use."""
    planter = pii.Planter(3)
    for _ in range(300):
        text, begin, end, true = planter.line("left ", " right", planter.rng.random() < 0.5)
        assert text.startswith("left ") and text.endswith(" right") and begin == 5 and 6 <= len(text) - end <= 7
        for kind, a, b in true:
            assert kind in pii.KINDS and begin <= a < b <= end
    places = [(f"{planter.word()} ", f" {planter.word()}") for _ in range(6000)]
    x, y, _ = pii.labelled(places[:4000], 1, unseen=False)
    model = trees.fit_boosted(x, y, rounds=40, depth=6)
    x, y, base = pii.labelled(places[4000:5000], 2, unseen=True)
    threshold = pii._threshold(model.probability(x[~base]), y[~base])
    x, y, base = pii.labelled(places[5000:], 3, unseen=True)
    accepted = model.probability(x) >= threshold
    assert y[accepted & ~base].mean() > 0.97 and accepted[(y == 1) & ~base].mean() > 0.6


def test_candidates_of_numbers_side_by_side():
    found = lambda text: {(k, text[a:b]) for k, a, b in pii.candidates(text)}
    for first, second in (("7536784127813050", "4845168114407329"), ("2353820953013749", "4550997810720808")):
        text = f"aux {first} {second} and"
        assert pii.base_spans(text) == []
        assert {("card", first), ("card", second)} <= found(text)
        assert {("card", first), ("card", second)} <= found("7 7 7 7 7 7 7 7 7 " + text[4:] + " 1" * 30)
    for phone, ip in (("+1 (826) 555-4081", "190.137.223.204"), ("+1 (843) 555-7672", "170.106.47.218")):
        assert {("phone", phone), ("ip", ip)} <= found(f"Des {phone} {ip} du")
        assert {("phone", phone), ("ip", ip)} <= found(f"Des {ip} {phone} du")
    assert ("phone", "(0541) 555 0101") in found("4111 1111 1111 1111 (0541) 555 0101")


def test_candidates_of_long_runs_are_few():
    for text in ("1 " * 10_000, "1" * 200_000, "1." * 10_000, "12(" * 10_000):
        assert len(pii.candidates(text)) <= 40 * len(re.findall("[0-9]+", text))


def test_boosted_trees_and_rules_fit():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.4)).astype(float)
    model = trees.fit_boosted(x, y)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.99
    rules = quality.fit_rules(x, y, list("abcd"))
    assert 0 < len(rules.rules) < 200
    assert quality.fit_rules(x, np.ones(3000), list("abcd")).rules == []


def test_toxicity_features_count_different_words_of_one_beginning():
    assert toxicity.features(None) == set() == toxicity.features(" .,")
    once = toxicity.features("Vileness vileness")
    assert once == {b"vileness", b"vile*", b"vilene*"}
    assert toxicity.features("vileness vilenest") - once == {b"vilenest", b"vile**", b"vilene**"}


def test_positive_unlabelled_learning():
    rng = np.random.default_rng(4)
    words = [f"w{i}".encode() for i in range(300)]
    def text(toxic):
        return {*rng.choice(words, 30).tolist(), *[b"vile"] * toxic}
    texts = [text(1) for _ in range(200)] + [text(int(i % 10 == 0)) for i in range(600)]
    names = toxicity.vocabulary(texts)
    number = {w: i for i, w in enumerate(names)}
    rows = [np.array(sorted(number[w] for w in t if w in number), np.int32) for t in texts]
    model = toxicity.fit(rows, 200, names, 0.1)
    assert toxicity.score(model.base, model.weights, "a Vile w1 w2") > 0.7
    assert toxicity.score(model.base, model.weights, "w1 w2 w3") < 0.3
    assert toxicity.vocabulary(texts, most=3) == sorted(toxicity.vocabulary(texts, most=3))[:3]


@pytest.mark.parametrize("prior, shift", [(0.1, 0.0), (0.4, 0.0), (0.6, 4.0), (0.6, -6.0)])
def test_slope_of_the_risk(prior, shift):
    """Against differences of the risk as it is defined; where the negatives' part is below 0, the
    step goes up its slope."""
    rng = np.random.default_rng(6)
    n_pos, n = 7, 20
    f = rng.standard_normal(n)
    f[:n_pos] += shift

    def parts(f):
        loss = lambda z: np.log1p(np.exp(-z))
        positive = prior * np.mean([loss(z) for z in f[:n_pos]])
        negative = np.mean([loss(-z) for z in f[n_pos:]]) - prior * np.mean([loss(-z) for z in f[:n_pos]])
        return positive, negative

    positive, negative, slope = toxicity.risk(f, n_pos, prior)
    assert np.allclose((positive, negative), parts(f))
    followed = (lambda f: sum(parts(f))) if negative >= 0 else (lambda f: -parts(f)[1])
    for i in range(n):
        step = np.eye(n)[i] * 1e-5
        assert abs(slope[i] - (followed(f + step) - followed(f - step)) / 2e-5) < 1e-7


def test_collision_counting_finds_neighbours():
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((3000, 32))
    vectors[100:200] = vectors[100]  # copies
    block = ann.Block(np.arange(3000), vectors)
    right = 0
    for q in range(0, 3000, 60):
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        d[q] = np.inf
        ids, dist = block.search(q, vectors[q], 10)
        right += len(set(ids.tolist()) & set(np.lexsort((np.arange(3000), d))[:10].tolist()))
        assert np.allclose(dist, d[ids]) and (np.diff(dist) >= 0).all()
    assert right >= 0.95 * 500


def test_member_scan_rejects_false_magic(tmp_path):
    records = [warc.record(i, f"http://x/{i} \r\n", b"x" * i * 50, "d", None if i % 3 else 0) for i in range(40)]
    noise = warc.member(b"no archive record")
    data = b"".join(warc.member(r, 0) + (warc.EMPTY_MEMBER if i % 5 == 0 else b"") for i, r in enumerate(records))
    path = tmp_path / "a"
    path.write_bytes(warc.MAGIC + b"junk" + data)
    for size in (1, 7, 100, 5000, 10**6):
        found = []
        for start in range(0, path.stat().st_size, size):
            with warc.open_file(str(path)) as file:
                end = min(path.stat().st_size, start + size)
                found += [h["warc-record-id"] for h, _ in warc.records_in(file, path.stat().st_size, start, end)]
        assert found == [f"<urn:page:{i}>" for i in range(40)]
    assert not noise.startswith(b"WARC")


@pytest.mark.parametrize("url", ["http://x/" + "a" * 600_000, "http://x/" + " é" * 150_000])
def test_member_with_a_very_long_header(tmp_path, url):
    path = tmp_path / "a"
    path.write_bytes(warc.member(b"no archive record " * 50_000) + b"".join(
        warc.member(warc.record(i, url, b"x", "d", None)) for i in range(3)
    ))
    size = path.stat().st_size
    with warc.open_file(str(path)) as file:
        for step in (size, 1000):
            found = [h for a in range(0, size, step) for h, _ in warc.records_in(file, size, a, min(size, a + step))]
            assert [h["warc-record-id"] for h in found] == [f"<urn:page:{i}>" for i in range(3)]


MIT = "\n".join([
    "// MIT License", "//", "// Permission is hereby granted, free of charge, to any person obtaining a copy",
    '// of this software and associated documentation files (the "Software"), to deal',
    "// in the Software without restriction, including without limitation the rights",
    "// to use, copy, modify, merge, publish, distribute, sublicense, and/or sell",
    "// copies of the Software, and to permit persons to whom the Software is",
    "// furnished to do so, subject to the following conditions:", "//",
    "// The above copyright notice and this permission notice shall be included in all",
    "// copies or substantial portions of the Software.",
])


HEADERS = {
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the University of Somewhere nor the names of its
   contributors may be used to endorse or promote products derived from this
   software without specific prior written permission.
""",
    "LGPL-2.1-or-later": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
""",
    "AGPL-3.0-or-later": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Affero General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
""",
    "GPL-2.0-or-later": """   This program is free software; you can redistribute it and/or modify
   it under the terms of the GNU General Public License as published by
   the Free Software Foundation; either version 2 of the License, or
   (at your option) any later version.
""",
    "GPL-2.0-only": """This program is free software; you can redistribute it and/or modify it
under the terms of the GNU General Public License version 2 as published by the
Free Software Foundation.
""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""",
    "BSL-1.0": """//          Copyright Jo Doe 2014.
// Distributed under the Boost Software License, Version 1.0.
//    (See accompanying file LICENSE_1_0.txt)
""",
    "EPL-2.0": """ * This program and the accompanying materials are made
 * available under the terms of the Eclipse Public License 2.0
 * which is available at https://www.eclipse.org/legal/epl-2.0/
""",
    "CC0-1.0": "To the extent possible under law, the author(s) have waived all copyright and related or neighboring rights to this software.\n",
}


@pytest.mark.parametrize("licence", sorted(HEADERS))
def test_headers_as_they_stand_in_files(licence):
    names = [n for _, n in licenses.sentences("int x;\n" + HEADERS[licence] + "\nint y;")]
    assert licenses.licences(names) == [licence], names


def test_spdx_lines():
    found = lambda text: licenses.licences([n for _, n in licenses.sentences(text)])
    assert found("// SPDX-License-Identifier: MIT\n") == ["MIT"]
    assert found("/* SPDX-License-Identifier: (GPL-2.0+ OR BSD-3-Clause) */") == ["BSD-3-Clause", "GPL-2.0-or-later"]
    assert found("# SPDX-License-Identifier: LGPL-2.1-only WITH x") == ["LGPL-2.1-only"]
    assert found("SPDX-License-Identifier: Unknown-1.0") == [] == found("SPDX-License-Identifier:")


def test_licence_rules():
    names = lambda text: [n for _, n in licenses.sentences(text)]
    found = lambda text: licenses.licences(names(text))
    assert found(MIT) == ["MIT"]
    assert found("Some text. Licensed under the Apache License, Version 2.0. More.") == ["Apache-2.0"]
    assert found("RELEASED under the MIT license.\nx\nLicensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0", "MIT"]
    assert found("Licensed under the Apache") == found("") == []
    # Order counts: the same sentences the other way round are no licence.
    named = {"cc0-waiver": "To the extent possible under law, Jo Doe has waived all copyright and related or neighboring rights to This Work"}
    named |= {r: f"SPDX-License-Identifier: {r[5:]}" for _, rule in licenses.RULES for r in rule if r.startswith("spdx-")}
    named |= licenses.SENTENCES
    for licence, rule in licenses.RULES:
        text = ".\n".join(named[r] for r in rule) + "."
        assert licence in found(text), (licence, names(text))
        if len(rule) > 1:
            assert licence not in found(".\n".join(named[r] for r in reversed(rule)) + ".")
    assert "BSD-2-Clause" not in found(".\n".join(licenses.SENTENCES[r] for r in licenses.RULES[7][1]) + ".")
    assert re.fullmatch("[a-z0-9 ]+", licenses.normalised("A  b-C\n(d)!"))
