"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from haulback.llm import kd_tree, spelling


def near(a, b):
    """One inserted, deleted or replaced character apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    """Rows of (word, n, form, form_n, root, n_near) from all pairs of (word, n)."""
    out, forms = {}, {}
    for w, n in words.items():
        met = [o for o in words if near(w, o)]
        best = min(met, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None
        out[w] = len(met)
    rows = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, n, forms[w], words.get(forms[w]), root, out[w]))
    return sorted(rows)


def vocabulary(seed, size, letters="abcdé"):
    rnd = random.Random(seed)
    words = {}
    while len(words) < size:
        w = "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 8)))
        words[w] = rnd.choice([1, 2, 5, 9, 30, 200, 5000])
    return words


@pytest.mark.parametrize(("sample", "box"), [(50_000, 1024), (40, 7), (300, 12), (1, 3)])
def test_against_all_pairs(spark, monkeypatch, sample, box):
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", sample)
    monkeypatch.setattr(spelling, "BOX_WORDS", box)
    words = vocabulary(sample, 500) | {"Zebra": 7, "zebra": 1, "x" * 3000: 3, "x" * 2999 + "y": 40, "x" * 2999: 900, "123": 2, "12": 20, "日本": 1, "日本語": 9}
    df = spark.createDataFrame([(w, n, 1, "b") for w, n in words.items()], "word string, n bigint, part int, box string").repartition(3)
    got = sorted((r.word, r.n, r.form, r.form_n, r.root, r.n_near) for r in spelling.variants(df).collect())
    assert got == brute(words)


def test_pairs_come_once_in_each_order(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BOX_WORDS", 5)
    words = vocabulary(9, 200)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = [(r.word, r.other, r.other_n) for r in spelling.near_pairs(df).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b, words[b]) for a in words for b in words if near(a, b)}


def test_box_pruning_loses_no_near_point():
    words = [w for w in vocabulary(2, 900, "abcdefgh") if len(w) == 5]
    counts = kd_tree.letter_counts(kd_tree.code_points(words))
    leaves = []
    tree = kd_tree.grow(counts, len(words), 10, leaves)
    at = kd_tree.home(tree, counts)
    assert len(leaves) > 10 and set(at.tolist()) == set(range(len(leaves)))
    reach = {(int(r), leaf) for leaf, rows in kd_tree.reached(tree, counts, 1, 1) for r in rows}
    found = {(int(a), int(b)) for qs, ps in kd_tree.PointTree(counts).near(counts, 1, 1) for a, b in zip(qs, ps, strict=True)}
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            up, down = np.maximum(counts[j] - counts[i], 0).sum(), np.maximum(counts[i] - counts[j], 0).sum()
            assert ((i, j) in found) == (up <= 1 and down <= 1)
            assert not near(a, b) or ((i, j) in found and (i, int(at[j])) in reach)
    assert len(reach) < len(words) * len(leaves) / 2


def plain_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def test_words_of_odd_documents(spark):
    rnd = random.Random(3)
    pool = ["Straße", "ÉCOLES", "école×÷x", "letters", "Lettres", "windows", "abcdef", "a" * 4000, "short"]
    docs = [(k % 300, " ".join(rnd.choice(pool) for _ in range(8)) + ", x-y") for k in range(900)] + [(None, "letters windows"), (1, None), (2, ""), (3, " 12 ")]
    df = spark.createDataFrame([(i, t, "w", 3, 1) for i, t in docs], "doc_id bigint, text string, word string, n int, h int").repartition(3)
    want = plain_words(docs)
    assert any(len(w) == 5 for w in pool) and {r.word: r.n for r in spelling.corpus_words(df).collect()} == want
    got = sorted((r.word, r.n, r.form, r.form_n, r.root, r.n_near) for r in spelling.spelling_variants(df).collect())
    assert got == brute(want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.spelling_variants(docs).collect() == []
    assert spelling.spelling_variants(docs).columns == ["word", "n", "form", "form_n", "root", "n_near"]


def test_query_equals_its_sql(spark):
    import check_queries

    from haulback.llm import queries

    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES["op11_spelling_variants"](spark, sf)
    assert check_queries.compare(df, check_queries.connect(sf), spelling.ORACLE_SQL) == []
    assert df.filter("form is not null").count() > 0
