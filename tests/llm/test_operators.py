"""Every operator against brute force on odd rows, and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from haulback.llm import (
    components, fingerprints, jaccard_join, language_id, licences, line_dedup, mixing, ngram_scores, packing, quality, queries, simple8b,
)
from haulback.llm.token_ids import text_encoder, tokenizer_path
from haulback.session import watch_written

UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Words that make texts of any length.
WORDS = "the quick brown fox jumps over a lazy dog and runs far into old woods where no one ever sees it again".split()


def text_of(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k * (seed + 3)) % len(WORDS)] + str((k * seed) % 13) for k in range(n))


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and ids, extra columns with clashing names."""
    long = "\n".join(text_of(k, 40) for k in range(200))
    rows = [
        (1, text_of(1, 60), "en", "a"), (2, text_of(1, 60), "en", "a"), (3, text_of(1, 60) + " more", "en", None),
        (4, None, "de", "b"), (5, "", None, "b"), (6, " \n\t ", "de", "a"), (7, "123 456 !!", "en", "a"), (8, long, "en", "a"),
        (9, "Été à la plage\nEine Zeile mit vielen Worten\n" + text_of(4, 30), "fr", "c"),
        (10, "Eine Zeile mit vielen Worten\nkurz\nEINE zeile mit vielen Worten ", "de", "c"),
        (11, text_of(5, 2), "en", "a"), (12, "one", "en", "a"), (12, "one", "en", "a"), (13, text_of(6, 30), "en", "b"), (13, text_of(7, 30), "en", "b"),
        (None, text_of(8, 30), "en", "b"), (None, text_of(1, 60), None, None), (14, " ".join(["same"] * 300), "en", "a"), (15, text_of(9, 400), "en", "z"),
        (16, "x" * 5000, "en", "a"), (17, "a" + "\n" * 50 + "b", "en", "a"),
    ]
    extra = dict(key="k", size=1, bucket=2, row="r", n=3, target=1.0, text_hash=5, copy=1, part="p", n_chars=0)
    return spark.createDataFrame(
        [Row(doc_id=i, text=t, lang=g, source=s, **extra) for i, t, g, s in rows],
        "doc_id bigint, text string, lang string, source string, key string, size int, bucket int, row string, n int, target double, text_hash int, copy int, part string, n_chars bigint",
    ).repartition(3)


@pytest.fixture(scope="module")
def no_docs(odd_docs):
    return odd_docs.filter("1 = 0")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return words((text or "").translate(UPPER_TO_LOWER))


@pytest.fixture(scope="module")
def plain(odd_docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]


def ids(text, end):
    return text_encoder(tokenizer_path())(text) + end.to_bytes(4, "little")


# --- n-gram Jaccard join


def shingles(text, size):
    w = lowered(text)
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute_groups(plain, size, num, den):
    """Per row: n_shingles, component_id, n_links."""
    sets = [shingles(t, size) for _, t, _ in plain]
    near = [[k for k, b in enumerate(sets) if k != j and a and b and den * len(a & b) >= num * len(a | b)] for j, a in enumerate(sets)]
    out = []
    for j, s in enumerate(sets):
        reach, open_ = {j}, [j]
        while open_:
            for k in near[open_.pop()]:
                if k not in reach:
                    reach.add(k)
                    open_.append(k)
        known = [plain[k][0] for k in reach if plain[k][0] is not None]
        out.append((plain[j][0], len(s), min(known) if known else None, len(near[j])))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("size", "num", "den"), [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_jaccard_join_against_all_pairs(odd_docs, plain, size, num, den):
    got = jaccard_join.similar_groups(odd_docs, size, num, den).select("doc_id", "n_shingles", "component_id", "n_links")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_groups(plain, size, num, den)


def test_jaccard_join_of_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", 7)
    monkeypatch.setattr(jaccard_join, "BLOCK_POINTS", 5)
    rng = np.random.default_rng(3)
    made = []
    for family in range(6):
        base = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(12, 160)))]
        for _ in range(12):
            text = list(base)
            for _ in range(int(rng.integers(0, 1 + len(base) // 12))):
                text[int(rng.integers(0, len(text)))] = f"e{rng.integers(0, 50)}"
            made.append((len(made), " ".join(text), "s"))
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id bigint, text string")
    for size, num, den in ((3, 90, 100), (5, 80, 100)):
        got = jaccard_join.similar_groups(docs, size, num, den).select("doc_id", "n_shingles", "component_id", "n_links")
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_groups(made, size, num, den)


def test_near_copies_without_doc_id_link(spark):
    base = text_of(1, 120)
    plain = [(1, base, ""), (None, base + " one", ""), (None, base + " one two", ""), (None, base + " one", ""), (None, text_of(9, 90), ""), (None, text_of(9, 90) + " x", ""), (2, text_of(4, 50), "")]
    docs = spark.createDataFrame([p[:2] for p in plain], "doc_id bigint, text string").repartition(3)
    got = jaccard_join.similar_groups(docs).select("doc_id", "n_shingles", "component_id", "n_links")
    want = brute_groups(plain, 3, 90, 100)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and max(r[3] for r in want) == 3
    kept = [r.doc_id for r in jaccard_join.one_of_each(docs, 3, 90, 100).collect()]
    assert sorted(kept, key=repr) == [1, 2, None]


def test_one_of_each_component_stays(odd_docs, plain):
    kept = jaccard_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    got = Counter(r["doc_id"] for r in kept.collect())
    assert got[1] == 1 and got[2] == 0 and got[3] == 0  # near copies
    assert got[12] == 1 and got[13] == 2 and got[None] == 1  # repeated row, repeated id, unnamed copy of 1
    assert all(got[k] == 1 for k in (4, 5, 6))  # no shingles


def test_count_tree_bounds_never_lose_a_pair():
    rule = jaccard_join.Threshold(80, 100, 5)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 600, n).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) for n in rng.integers(50, 800, 200)]
    sets += [np.unique(np.concatenate([s[: len(s) * 19 // 20], s[:1] + np.uint64(k)])) for k, s in enumerate(sets)]
    k = 12
    points = np.array([rule.point(s, k) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = jaccard_join.CountTree(points, sizes, sizes - points.sum(axis=1, dtype=np.int64))
    for j, s in enumerate(sets):
        found = set(tree.search(points[j], len(s), int(sizes[j] - points[j].sum(dtype=np.int64)), rule).tolist())
        similar = {i for i, t in enumerate(sets) if 100 * (x := len(np.intersect1d(s, t))) >= 80 * (len(s) + len(t) - x)}
        assert similar <= found


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 100), (7, 3), (200, 201)], "a bigint, b bigint")
    got = dict(map(tuple, components.components(edges).collect()))
    assert got == {**{k: 0 for k in range(41)}, 200: 200, 201: 200}
    assert components.components(edges.filter("1 = 0")).count() == 0


# --- packing


def test_packing_covers_every_id_once(odd_docs, plain):
    out = packing.pack(odd_docs).collect()
    expected = Counter()
    for i, t, _ in plain:
        expected[i, ids(t, 1)] += 1
    by_sequence = defaultdict(list)
    for r in out:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    got = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in out)
    want = Counter()
    for (i, all_ids), n in expected.items():
        at, total = 0, len(all_ids) // 4
        while at < total:
            length = packing.CAPACITY if total - at >= packing.CAPACITY else min(packing.PIECE, total - at)
            want[i, at, length, zlib.crc32(all_ids[4 * at : 4 * (at + length)]), total] += n
            at += length
    assert got == want


# --- fingerprints


def test_fingerprints_of_edited_and_next_texts(odd_docs, plain):
    out = fingerprints.fingerprints(odd_docs).collect()
    order = sorted(plain, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t, _) in enumerate(order):
        text, next_ = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + next_[:cut]
        own = fingerprints.fingerprint(text)
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.written(own), fingerprints.written(fingerprints.fingerprint(edited)),
                     fingerprints.containment(own, fingerprints.fingerprint(edited)), fingerprints.containment(own, fingerprints.fingerprint(next_))))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)


def test_fingerprints_meet_the_next_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_CHARS", 300)
    docs = spark.createDataFrame([(k * 3, f"text {k} " * (k % 7 + 1)) for k in range(60)], "doc_id bigint, text string").repartition(4)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(texts, reverse=True)
    for r in fingerprints.fingerprints(docs).collect():
        text, next_ = texts[r["doc_id"]], texts[order[(order.index(r["doc_id"]) + 1) % 60]]
        cut = len(text) // 3
        assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - cut] + next_[:cut]).encode()).hexdigest()


def test_chunks_are_bounded_and_resist_shifts():
    rng = np.random.default_rng(5)
    data = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    ends = fingerprints.boundaries(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= fingerprints.MOST and sizes[:-1].min() >= fingerprints.LEAST
    text = data.decode()
    moved = fingerprints.fingerprint("inserted in front " + text)
    assert fingerprints.containment(fingerprints.fingerprint(text), moved) > 0.95
    own = fingerprints.fingerprint(text)
    assert fingerprints.read_back(fingerprints.written(own)) == own
    assert fingerprints.containment({}, {}) == 1.0 and fingerprints.containment(own, {}) == 0.0


# --- line dedup


def test_lines_stay_with_their_first_document(odd_docs, plain):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(UPPER_TO_LOWER)
    for i, t, _ in plain:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(math.inf if i is None else i)
    want = []
    for i, t, _ in plain:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(h := holders.get(key(x), ())) > 1 and min(h) < (math.inf if i is None else i))]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = line_dedup.drop_lines(odd_docs).select("row.doc_id", "n_lines", "n_dropped", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()


def test_bitmaps_are_runs(spark):
    line = "a line that is long enough {}"
    docs = spark.createDataFrame([(1, "\n".join(line.format(k) for k in (0, 1, 2, 5))), (2, "\n".join(line.format(k) for k in range(7)))], "doc_id bigint, text string")
    (bitmap,) = line_dedup.line_bitmaps(docs).collect()
    assert [tuple(r) for r in bitmap["dropped"]] == [(0, 2), (5, 5)]


# --- licences


def test_licences_are_found_and_ordinary_text_is_left_alone(spark, odd_docs):
    said = ["Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."]
    families = ["CC-BY-NC", "GPL", "Apache-2.0", "MIT"]
    filler = odd_docs.select("doc_id", "text")
    made = spark.createDataFrame([(100 + k, f"some words before it\n{line}\nand after") for k, line in enumerate(said)] + [(200, f"{said[3]}\n\n{said[1]}")], "doc_id bigint, text string")
    out = licences.scan(filler.unionByName(made))
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[100 + k]["families"] for k in range(4)] == families
    assert got[200]["families"] == "GPL,MIT" and got[200]["n_licence"] == 2 and got[200]["n_paragraphs"] == 2
    assert all(got[k]["families"] == "" for k in (1, 4, 5, 6, 8, 9, 15))
    assert out.count() == filler.count() + 5


def test_repeated_rows_score_as_one(spark, odd_docs):
    lines = ["Released under the MIT License.", "a copy of the license was in the file", "the use of this library is free of charge", "distributed under the law of the land"]
    once = spark.createDataFrame([(None if k % 2 else k, x) for k, x in enumerate(lines)], "doc_id bigint, text string")
    model = licences.train(odd_docs.select("doc_id", "text").unionByName(once))
    grams = lambda docs: licences._grams(licences.paragraphs(docs), "words")
    margins = lambda docs: sorted((r["row"], r["pos"], round(r["margin"], 6)) for r in licences._scored(grams(docs), model).collect())
    copies = spark.createDataFrame([tuple(r) for r in once.collect()] * 9, once.schema).repartition(3)
    assert margins(once) and margins(copies) == margins(once)


def test_overlap_counts_every_n_gram(spark, odd_docs):
    wrapped = next(t for _, t in licences.TEMPLATES if t.startswith("Unless required")).split()
    notices = [" ".join(wrapped[k : k + 9]) for k in (0, 9, 18)] + ["licensed under the Apache License", "This program is free software under the terms of the GNU General Public License"]
    filler = [f"number {k} is in agreement with the law, of any kind, on an as yet unknown basis, under the terms, either express or mail" for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(notices)) + [(100 + k, x) for k, x in enumerate(filler)], "doc_id bigint, text string").unionByName(odd_docs.select("doc_id", "text"))
    model = licences.train(docs)
    made = spark.createDataFrame(list(enumerate(notices)), "doc_id bigint, text string")
    told = {r["row"]: r["doc_id"] for r in made.select("doc_id", F.xxhash64("doc_id", "text").alias("row")).collect()}
    got = {told[r["row"]]: r for r in licences.licence_paragraphs(made, model).collect()}

    def grams(text):
        w = re.findall(r"[^\W_]+", text.lower())
        return {tuple(w[k : k + n]) for n in (2, 3) for k in range(len(w) - n + 1)}

    families = ["Apache-2.0", "Apache-2.0", "Apache-2.0", "Apache-2.0", "GPL"]
    assert len(got) >= 4
    for k, r in got.items():
        own = grams(notices[k])
        best = max(len(own & (t := grams(x))) / min(len(own), len(t)) for f, x in licences.TEMPLATES if f == families[k])
        assert r["overlap"] == pytest.approx(best), k
        assert r["family"] in (families[k], licences.UNKNOWN) and r["confirmed"]


#: Notices in other words than the templates', by family.
NOTICES = {
    "Apache-2.0": ["This project uses the Apache License, Version 2.0; you may obtain a copy of the license online.", "released under Apache License 2.0", " * Licensed to you under the Apache License, Version 2.0 (the License)"],
    "MIT": ["Code is released as open source under the MIT License.", "MIT License - do what you want", "Permission is hereby granted, free of charge, to anyone obtaining a copy of this software"],
    "BSD": ["Use of this source code is governed by a BSD-style license", "Redistribution and use in source and binary forms, are permitted provided that these conditions are met", "this is 3-Clause BSD License software"],
    "ISC": ["available under the permissive ISC License", "Permission to use, copy, modify, and distribute this software for any purpose is hereby granted"],
    "GPL": ["GNU General Public License for more details", "this file is part of foo, released under the GNU General Public License, version 2", "foo is free software: you can redistribute it under the terms of the GNU General Public License"],
    "LGPL": ["this library is licensed under the GNU Lesser General Public License", "linking is allowed by the GNU Lesser General Public License, version 3"],
    "AGPL": ["the server is licensed under the GNU Affero General Public License, version 3", "released as GNU Affero General Public License software"],
    "MPL-2.0": ["This file is subject to the Mozilla Public License, version 2.0", "licensed: Mozilla Public License"],
    "EPL": ["released under the Eclipse Public License 2.0 by the authors"],
    "BSL-1.0": ["Use, modification and distribution are subject to the Boost Software License, Version 1.0"],
    "zlib": ["altered source versions must be plainly marked as such, and must not be misrepresented"],
    "Unlicense": ["This is free and unencumbered software released into the public domain, anyone may copy"],
    "CC0": ["the data are in the public domain by CC0 1.0 Universal", "the author has waived all copyright to this work"],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "pictures: CC BY 4.0 by the museum"],
    "CC-BY-SA": ["Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "this paper is CC BY-NC 3.0, no resale"],
    "proprietary": ["All rights reserved.", "(c) 2019 Some Press Ltd. All rights reserved.", "No part of this publication may be reproduced in any form without written permission of the publisher"],
}


@pytest.fixture(scope="module")
def licence_model(spark, odd_docs):
    rows = [(1000 + k, text_of(k, 12)) for k in range(300)]
    return licences.train(odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id bigint, text string")))


def found_licences(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    keys = {r["row"]: r["doc_id"] for r in docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row")).collect()}
    return {keys[r["row"]]: r for r in licences.licence_paragraphs(docs, model).collect()}


def test_notices_in_other_words_are_found(spark, licence_model):
    assert not {x for xs in NOTICES.values() for x in xs} & {t for _, t in licences.TEMPLATES}
    told = [(f, x) for f, xs in NOTICES.items() for x in xs] + [("proprietary", "All rights reserved.")]
    got = found_licences(spark, licence_model, [x for _, x in told])
    right = [k in got and got[k]["family"] == f for k, (f, _) in enumerate(told)]
    assert sum(right) >= 0.9 * len(told), [told[k] for k, r in enumerate(right) if not r]
    assert {f for k, (f, _) in enumerate(told) if right[k]} == set(licences.FAMILIES) and right[-1]


def test_everyday_use_of_the_same_words_is_left_alone(spark, licence_model):
    texts = ["Her license to drive was out of date.", "All seats are reserved for the public.", "The work is under way, and the terms are general.",
             "They granted the rights to the software company.", "A common source of joy is free of charge.", "He wrote a general letter to the foundation in the first version."]
    assert found_licences(spark, licence_model, texts) == {}


def test_what_no_template_confirms_is_unknown(spark, licence_model, monkeypatch):
    monkeypatch.setattr(licences, "LEAST_OVERLAP", 1.1)
    got = found_licences(spark, licence_model, ["Released under the MIT License."])
    assert got[0]["family"] == licences.UNKNOWN and not got[0]["confirmed"]


def test_margins_against_plain_sums(spark, licence_model):
    texts = [x for xs in NOTICES.values() for x in xs] + ["a line of no licence", "x " * 50_000 + "MIT License"]
    weights = {r["gram"]: r["w"] for r in licence_model.weights.collect()}
    grams = []
    for k, text in enumerate(texts):
        w = re.findall(r"[^\W_]+", text.lower())
        grams += [(k, w[j], w[j + 1], w[j + 2] if n == 3 else None) for n in (2, 3) for j in range(len(w) - n + 1)]
    hashed = spark.createDataFrame(grams, "k int, a string, b string, c string").distinct()
    two = F.xxhash64(F.xxhash64("a"), F.xxhash64("b"))
    sums = defaultdict(lambda: np.zeros(len(licence_model.intercepts)))
    for k, gram in {(r["k"], r["gram"]) for r in hashed.select("k", F.when(F.col("c").isNull(), two).otherwise(F.xxhash64(two, F.xxhash64("c"))).alias("gram")).collect()}:
        if gram in weights:
            sums[k] += weights[gram]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    keys = {r["row"]: r["doc_id"] for r in docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row")).collect()}
    scored = licences._scored(licences._grams(licences.paragraphs(docs), "words"), licence_model)
    got = {keys[r["row"]]: (r["best"], r["margin"]) for r in scored.collect()}
    names, offsets = list(licence_model.intercepts), np.array(list(licence_model.intercepts.values()))
    assert set(got) == set(sums)
    for k, total in sums.items():
        logit = total + offsets
        assert got[k][1] == pytest.approx(logit[1:].max() - logit[0]) and got[k][0] == names[1 + int(logit[1:].argmax())]


# --- quality rules


def brute_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = defaultdict(list)
    for k in range(len(w) - 7):
        windows[tuple(w[k : k + 8])].append(k)
    covered = {j for at in windows.values() if len(at) > 1 for k in at for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(odd_docs, plain):
    got = quality.judged(odd_docs)
    want = []
    for i, t, _ in plain:
        counts = brute_counts(t)
        want.append((i, *counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0]))
    assert sorted((tuple(r)[:7] for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert got.filter("base_failed and kept").count() == 0


def test_quality_verdict_is_that_of_all_rules_in_any_order(odd_docs, monkeypatch):
    verdict = lambda: sorted((r["doc_id"] or -1, r["kept"]) for r in quality.judged(odd_docs).collect())
    first = verdict()
    monkeypatch.setattr(quality, "rule_order", lambda docs: sorted(quality.rules(), reverse=True))
    assert verdict() == first


def test_quality_rules_reject(spark):
    good = " ".join(f"word{k}" for k in range(40))
    texts = [good, "&& ".join(good.split()), "\n".join(["w%d x" % (k % 9) for k in range(40)]), " ".join("1" * (k + 1) for k in range(25)), "\n".join(f"- {w} x" for w in good.split()), "\n".join(f"{w}..." for w in good.split())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["rule"] for r in quality.judged(docs).collect()}
    assert got[0] is None
    assert got[1] == "symbols" and got[2] in ("dup_lines", "base") and got[3] in ("alphabetic", "word_chars") and got[4] == "bullet_lines" and got[5] == "ellipsis_lines"


# --- language identification


def test_languages(spark, odd_docs):
    known = {"en": "the house and the garden of the old man near the river", "de": "das Haus und der Garten des alten Mannes am Fluss"}
    rows_ = [(k, " ".join(known[g].split()[(j + k) % 10] for j in range(30)), g) for k, g in enumerate(["en", "de"] * 20)]
    docs = spark.createDataFrame(rows_, "doc_id bigint, text string, lang string")
    made = language_id.train_dictionaries(docs.filter(~language_id.held_out(F.col("doc_id"))))
    assert set(made) == {"en", "de"}
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, made).collect()}
    assert got == {k: g for k, _, g in rows_}
    odd = language_id.identify(odd_docs, made)
    assert odd.count() == odd_docs.count()
    for r in odd.collect():
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (4, 5, 6, 7))
    assert {r["doc_id"] for r in language_id.keep_identified(odd_docs, made).collect()}.isdisjoint({4, 5, 6, 7})
    assert {r["lang_pred"] for r in language_id.identify(docs, {}).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = language_id.train_dictionaries(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.identify(docs, made).join(docs.select("doc_id", "lang"), "doc_id").filter(language_id.held_out(F.col("doc_id")))
    right, n = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert n > 200 and right > 0.96


def test_readme_states_the_least_margin():
    readme = (Path(__file__).resolve().parents[2] / "README.md").read_text()
    assert f"Margins under {100 * language_id.LEAST_MARGIN:g} % reject" in readme


# --- n-gram scores


def brute_scores(plain, trained):
    texts = [[*lowered(t), "\n"] for _, t, _ in plain]
    c, pairs, context, after = Counter(), Counter(), Counter(), defaultdict(set)
    for (i, _, _), t in zip(plain, texts, strict=True):
        if trained(i):
            c.update(t)
            for u, w in zip([None, *t], t):  # noqa: B905
                pairs[u, w] += 1
                context[u] += 1
                after[u].add(w)
    n, v = sum(c.values()), len(c)
    uni = lambda w: math.log10((c[w] + 1) / (n + v + 1))
    out = []
    for (i, _, _), t in zip(plain, texts, strict=True):
        score = 0.0
        for u, w in zip([None, *t], t):  # noqa: B905
            if pairs[u, w]:
                score += math.log10((pairs[u, w] - 0.75) / context[u])
            else:
                score += uni(w) + (math.log10(0.75 * len(after[u]) / context[u]) if context[u] else 0)
        out.append((i, len(t), sum(c[w] > 0 for w in t), n, sum(map(uni, t)), score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_tokens", [2_500_000, 300])
def test_scores_against_a_plain_model(odd_docs, plain, monkeypatch, shard_tokens):
    monkeypatch.setattr(ngram_scores, "SHARD_TOKENS", shard_tokens)
    got = ngram_scores.scores(odd_docs, ~ngram_scores.held_out(F.col("doc_id")))
    want = brute_scores(plain, lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=repr)
    loose = 0.02
    for a, b in zip(sorted(got, key=lambda r: repr((r[:4], round(r[4], 6)))), sorted(want, key=lambda r: repr((r[:4], round(r[4], 6)))), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9) and a[5] == pytest.approx(b[5], rel=loose, abs=0.3)


def test_split_contexts_back_off_as_whole_ones(spark, monkeypatch):
    # "hot" has few successors, so that most of its shards learn none
    texts = [" ".join(f"hot {'ab'[(k + j) % 2]}" for j in range(60)) for k in range(6)] + [" ".join(f"hot unseen{k} w{k}" for k in range(40))]
    made = list(enumerate(texts))
    docs = spark.createDataFrame(made, "doc_id bigint, text string")
    monkeypatch.setattr(ngram_scores, "SHARD_TOKENS", 60)
    got = ngram_scores.scores(docs, F.col("doc_id") < 6)
    want = brute_scores([(i, t, None) for i, t in made], lambda i: i < 6)
    for r, b in zip(sorted(got.collect(), key=lambda r: r["doc_id"]), sorted(want), strict=True):
        assert r["score"] == pytest.approx(b[5], rel=0.01)


def brute_trigrams(made, trained):
    """Per doc_id: the score by pairs, words and unigrams, each backing off to the next."""
    texts = {i: [*lowered(t), "\n"] for i, t in made}
    c, after = Counter(w for i, t in texts.items() if trained(i) for w in t), defaultdict(Counter)
    contexts = lambda t, k: [(t[k - 2] if k > 1 else None, t[k - 1])] * (k > 0) + [t[k - 1] if k else None]
    for i, t in texts.items():
        if trained(i):
            for k, w in enumerate(t):
                for u in contexts(t, k):
                    after[u][w] += 1

    def log(w, given):
        if not given:
            return math.log10((c[w] + 1) / (sum(c.values()) + len(c) + 1))
        seen = after.get(given[0], Counter())
        if seen[w]:
            return math.log10((seen[w] - 0.75) / sum(seen.values()))
        return log(w, given[1:]) + (math.log10(0.75 * len(seen) / sum(seen.values())) if seen else 0)

    return {i: sum(log(w, contexts(t, k)) for k, w in enumerate(t)) for i, t in texts.items()}


@pytest.mark.parametrize("shard_tokens", [2_500_000, 300, 60])
def test_third_order_scores_against_a_plain_model(spark, monkeypatch, shard_tokens):
    monkeypatch.setattr(ngram_scores, "SHARD_TOKENS", shard_tokens)
    made = [(k, text_of(k, 50)) for k in range(20)] + [(20 + k, " ".join(f"hot pair {'ab'[(k + j) % 2]}" for j in range(30))) for k in range(4)]
    made += [(100, " ".join(f"hot pair unseen{k} the fox pair b" for k in range(9))), (101, "hot a pair b quick hot pair pair a hot"), (102, None), (103, text_of(4, 30) + " " + text_of(9, 30)), (104, "one")]
    docs = spark.createDataFrame(made, "doc_id bigint, text string").repartition(3)
    want = brute_trigrams(made, lambda i: i < 100 and i % 5)
    out = ngram_scores.scores(docs, (F.col("doc_id") < 100) & (F.col("doc_id") % 5 != 0), order=3)
    got = {r["doc_id"]: r["score"] for r in out.collect()}
    assert got.keys() == want.keys()
    for i, score in got.items():
        assert score == pytest.approx(want[i], rel=0.01, abs=0.02), i


@pytest.mark.parametrize("block", [40, 1_000_000])
def test_blocks_of_a_shard_score_alike(spark, monkeypatch, block):
    # a block's file, and words listed with two bytes or sent whole
    monkeypatch.setattr(ngram_scores, "SHARD_TOKENS", 300)
    monkeypatch.setattr(ngram_scores, "BLOCK", block)
    monkeypatch.setattr(ngram_scores, "SENT_TOKENS", 60)
    monkeypatch.setattr(ngram_scores, "LISTED", 5)
    made = [(k, text_of(k, 50)) for k in range(20)] + [(100, "one one one one one"), (101, text_of(3, 20) + " unseen words " + text_of(8, 20)), (102, None)]
    want = brute_trigrams(made, lambda i: i < 100 and i % 5)
    docs = spark.createDataFrame(made, "doc_id bigint, text string").repartition(2)
    out = ngram_scores.scores(docs, (F.col("doc_id") < 100) & (F.col("doc_id") % 5 != 0), order=3)
    for r in out.collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=0.01, abs=0.02), r["doc_id"]


def test_sums_leave_a_task_once_for_all_its_shards(spark, monkeypatch):
    monkeypatch.setattr(ngram_scores, "SHARD_TOKENS", 200)
    docs = spark.createDataFrame([(k, text_of(k, 300)) for k in range(12)], "doc_id bigint, text string")
    sums = []
    for together in (1, 4):
        monkeypatch.setattr(ngram_scores, "TASK_SHARDS", together)
        with watch_written() as written:
            ngram_scores.scores(docs, F.lit(True), order=3)
        found = spark.read.parquet(next(path for _, path in written if "ngrams" in path))
        sums.append(found.filter("base is not null").count())
    assert sums[1] < sums[0] / 2


def test_the_query_scores_pairs(spark, monkeypatch):
    given = []
    monkeypatch.setattr(queries.ngram_scores, "scores", lambda docs, training, order=2: given.append(order) or docs.select("doc_id"))
    queries.op8_lm_scoring(spark, "/root/testdata/sf0.001")
    assert given == [3]


def test_scores_without_training(odd_docs):
    out = ngram_scores.scores(odd_docs, F.lit(False))
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in out.collect()} == {(0, 0, 0.0, 0.0)}


def test_held_out_texts_score_above_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = ngram_scores.scores(docs, ~ngram_scores.held_out(F.col("doc_id"))).filter(ngram_scores.held_out(F.col("doc_id")))
    base, score = out.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


# --- token files


def test_files_hold_ids_in_document_order(odd_docs, plain, monkeypatch):
    monkeypatch.setattr(simple8b, "FILE_IDS", 500)
    out = sorted(map(tuple, simple8b.read_ids(simple8b.write_ids(odd_docs)).collect()), key=lambda r: r[1])
    at, want = 0, []
    for i, t, _ in sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        all_ids = ids(t, 0)
        want.append((i, at, len(all_ids) // 4, zlib.crc32(all_ids)))
        at += len(all_ids) // 4
    assert out == want


# --- mixing


def test_mix_takes_each_sources_budget(odd_docs, plain):
    out = mixing.mix_plan(odd_docs).collect()
    total = sum(len(words(t)) for _, t, _ in plain)
    sizes = Counter()
    for _, t, s in plain:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, 1.5 * total, set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if 2 * sizes[s] <= level * weight[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    assert sorted((r["doc_id"] or -1, r["size"]) for r in out) == sorted((i or -1, len(words(t))) for i, t, _ in plain)
    by_source = defaultdict(int)
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source[r["target"], r["source_size"]] += r["taken"]
    for s in order:
        assert any(abs(t - target[s]) < 1e-6 and z == sizes[s] for t, z in by_source)
    for (t, _), taken in by_source.items():
        assert taken % 1 == 0 and t - taken >= -1e-6
    again = mixing.mix_plan(odd_docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_mixed_rows_hold_the_words_taken(odd_docs):
    plan = Counter()
    for r in mixing.mix_plan(odd_docs).collect():
        plan[r["doc_id"]] += r["taken"]
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    held = Counter()
    for r in out.collect():
        held[r["doc_id"]] += len(words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert held == Counter({k: n for k, n in plan.items() if n})


def test_mixing_buckets_change_nothing(odd_docs, monkeypatch):
    first = sorted(map(repr, mixing.mix_plan(odd_docs).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    assert sorted(map(repr, mixing.mix_plan(odd_docs).collect())) == first


# --- empty tables, and the pipeline


@pytest.mark.parametrize("operator", [
    lambda d: jaccard_join.similar_groups(d), lambda d: jaccard_join.one_of_each(d), lambda d: packing.pack(d), lambda d: fingerprints.fingerprints(d),
    lambda d: line_dedup.drop_lines(d), lambda d: licences.scan(d), lambda d: quality.judged(d),
    lambda d: language_id.identify(d, language_id.train_dictionaries(d)), lambda d: ngram_scores.scores(d, F.lit(True)),
    lambda d: simple8b.read_ids(simple8b.write_ids(d)), lambda d: mixing.mix_plan(d), lambda d: mixing.mixed(d),
], ids=["jaccard", "one", "pack", "fingerprints", "lines", "licences", "quality", "language", "scores", "files", "plan", "mixed"])
def test_empty_tables_give_no_rows(no_docs, operator):
    assert operator(no_docs).count() == 0


def test_pipeline_stages_keep_columns_and_take_effect(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "").cache()
        assert after.columns == docs.columns, name
        docs = after
    left = [r["doc_id"] for r in docs.collect()]
    assert not {4, 5, 6, 7} & set(left)
    packed_ = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r["doc_id"] for r in packed_.collect()} == set(left)
    assert packed_.columns[:3] == ["doc_id", "start", "length"]
