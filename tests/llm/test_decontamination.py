"""FM-indexes and decontamination against plain scans."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulback.llm import decontamination
from haulback.llm.fm_index import FmIndex, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def pieces_of(seed, n, symbols):
    rnd = random.Random(seed)
    base = [rnd.randrange(1, symbols) for _ in range(300)]
    out = []
    for _ in range(n):
        at = rnd.randrange(200)
        out.append(np.array(base[at : at + rnd.randrange(1, 100)] if rnd.random() < 0.5 else [rnd.randrange(1, symbols) for _ in range(rnd.randrange(1, 60))], dtype=np.int32))
    return out


@pytest.mark.parametrize("symbols", [2, 3, 9, 700])
def test_index_finds_what_a_scan_finds(symbols):
    pieces = pieces_of(symbols, 40, symbols)
    index, starts = FmIndex.build(pieces, symbols)
    index = FmIndex.load(**index.parts())
    rnd = random.Random(1)
    phrases = []
    for _ in range(200):
        p = rnd.choice(pieces).tolist()
        at = rnd.randrange(len(p))
        phrases.append(tuple(p[at : at + rnd.randrange(1, 6)]) if rnd.random() < 0.8 else tuple(rnd.randrange(1, symbols) for _ in range(3)))
    grid = np.zeros((len(phrases), 5), dtype=np.int64)
    for k, p in enumerate(phrases):
        grid[k, : len(p)] = p[::-1]
    low, high = index.search(grid)
    for k, phrase in enumerate(phrases):
        want = {int(s) + at for s, p in zip(starts, pieces, strict=True) for at in range(len(p)) if tuple(p[at : at + len(phrase)].tolist()) == phrase}
        assert high[k] - low[k] == len(want)
        assert set(index.locate(np.arange(low[k], high[k])).tolist()) == want


def test_suffix_array_sorts_long_repeats():
    keys = np.array(([7, 8, 9] * 200 + [0]) + ([7, 8, 9] * 150 + [1]) + [5, 2], dtype=np.int64)
    assert suffix_array(keys).tolist() == sorted(range(len(keys)), key=lambda i: keys[i:].tolist())


def brute(docs, items):
    phrases = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            phrases.setdefault(tuple(w[k : k + 10]), set()).add(item)
    widths = {len(p) for p in phrases}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for width in widths:
            for k in range(len(w) - width + 1):
                if (held := phrases.get(tuple(w[k : k + width]))) is not None:
                    hit |= set(range(k, k + width))
                    found |= held
        listed = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), listed, sorted(hit)))
    return out


def corpus():
    rnd = random.Random(4)
    pool = [f"w{k}" for k in range(30)] + ["É", "ß1"]
    text = lambda n: " ".join(rnd.choice(pool) for _ in range(n))
    items = [(k, text(rnd.randrange(12, 40))) for k in range(20)]
    items += [(100, "W1, w2!"), (101, ""), (102, None), (103, "?!"), (None, text(15)), (104, items[0][1]), (104, items[1][1]), (104, items[1][1])]
    docs = []
    for k in range(120):
        parts = [text(rnd.randrange(0, 60))]
        for _ in range(rnd.randrange(3)):
            item = words(rnd.choice(items)[1])
            a = rnd.randrange(max(1, len(item)))
            parts += ["  ".join(item[a : a + rnd.randrange(1, 30)]).upper(), text(rnd.randrange(9))]
        docs.append((k, ".\n".join(parts)))
    docs += [(200, None), (201, ""), (202, " .,\t"), (203, items[0][1]), (203, items[0][1]), (None, items[2][1]), (None, "x"), (204, docs[5][1])]
    docs.append((205, (items[3][1] + " ") * 300 + text(500) + " " + items[4][1]))
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "k", 0) for i, t in docs], "doc_id bigint, text string, row int, words string, piece int").repartition(3),
            spark.createDataFrame([(i, t, "n") for i, t in items], "item_id bigint, text string, n string"))


@pytest.mark.parametrize(("shard", "block", "part"), [(600_000, 250_000, 4096), (150, 60, 11)])
def test_against_brute_force(spark, monkeypatch, shard, block, part):
    for name, value in (("SHARD_WORDS", shard), ("BLOCK_WORDS", block), ("PART_WORDS", part)):
        monkeypatch.setattr(decontamination, name, value)
    docs, items = corpus()
    found = decontamination.contaminated(*frames(spark, docs, items)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.items, [k for s in r.spans for k in range(s.begin, s.end)]) for r in found), key=repr)
    assert got == sorted(brute(docs, items), key=repr)


def test_cut_texts_hold_no_phrase(spark):
    docs, items = corpus()
    docs_df, items_df = frames(spark, docs, items)
    clean = decontamination.decontaminated(docs_df, decontamination.contaminated(docs_df, items_df))
    assert clean.columns == docs_df.columns and clean.count() == len(docs)
    texts = {(r.doc_id, r.text) for r in clean.collect()}
    hit = {d for d, _, n, _, _ in brute(docs, items) if n}
    assert {(d, t) for d, t in docs if d not in hit} <= texts
    assert decontamination.without_spans("A b, c. D! é f", [(1, 3), (4, 5)]) == "A . D!  f"
    want = sorted((str(d), n - m) for d, n, m, _, _ in brute(docs, items))
    assert sorted((str(r.doc_id), len(words(r.text))) for r in clean.collect()) == want


def test_empty_tables(spark):
    docs, items = frames(spark, *corpus())
    assert decontamination.contaminated(docs.filter("1 = 0"), items).collect() == []
    none = decontamination.contaminated(docs, items.filter("1 = 0"))
    assert none.count() == docs.count() and none.filter("n_hit > 0 or size(items) > 0").count() == 0


def test_query_equals_its_sql(spark):
    import check_queries

    from haulback.llm import queries

    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES["op12_benchmark_decontamination"](spark, sf)
    assert check_queries.compare(df, check_queries.connect(sf), decontamination.ORACLE_SQL) == []
    assert df.filter(F.col("contaminated")).count() > 0
    clean = df.filter("n_hit = 0").first()
    assert clean.items_sha256 == hashlib.sha256(b"").hexdigest()
