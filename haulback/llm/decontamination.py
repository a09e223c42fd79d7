"""Benchmark decontamination by FM-indexes over shards of documents.

Documents are cut into shards where they are read; each shard becomes a row of an index table in the shared folder. The
benchmark's phrases are searched backwards through the wavelet ranks of every shard, block after block of phrases, so
that what is sent to tasks is bounded. Sampled positions locate the occurrences, and overlapping ones are merged into
spans of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.llm.fm_index import FmIndex
from haulback.llm.tables import batched, columns
from haulback.session import materialize

#: Consecutive words of a phrase; an item of fewer words is one phrase.
WINDOW = 10
#: Words of a shard, about; longer documents are cut into pieces that overlap by a phrase less one word.
SHARD_WORDS = 600_000
#: Words of benchmark text in a block, about, and in a part of one item, at most.
BLOCK_WORDS, PART_WORDS = 250_000, 4096

#: Fixed bytes of words: digits, a-z and all beyond ASCII; others part words.
_PARTS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def spaced(text: bytes) -> bytes:
    """UTF-8 with A-Z lower-cased and all that parts words as spaces, byte for byte."""
    return text.lower().translate(_PARTS)


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self) + 1
        return found


_DOCS = "docs array<struct<row:bigint,doc_id:bigint,text_hash:bigint,piece:int,first:bigint,words:bigint>>"
INDEX_SCHEMA = f"{_DOCS}, vocabulary binary, starts binary, counts binary, levels binary, marks binary, samples binary"
_INDEX = pa.schema([
    ("docs", pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("piece", pa.int32()), ("first", pa.int64()), ("words", pa.int64())]))),
    *((name, pa.binary()) for name in ("vocabulary", "starts", "counts", "levels", "marks", "samples")),
])


class _Shard:
    """Pieces of documents until they are indexed; equal pieces are one."""

    def __init__(self):
        self.vocabulary, self.pieces, self.known, self.docs, self.words, self.seen = _Vocabulary(), [], {}, [], 0, 0

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words))

    def add(self, row: int, doc_id: int | None, text_hash: int, ids: np.ndarray, first: int, words: int) -> None:
        """``words`` of the piece that no earlier piece of its document holds."""
        piece = -1
        if len(ids):
            piece = self.known.setdefault(ids.tobytes(), len(self.pieces))
            if piece == len(self.pieces):
                self.pieces.append(ids)
                self.words += len(ids)
        self.seen += len(ids) + 1
        self.docs.append({"row": row, "doc_id": doc_id, "text_hash": text_hash, "piece": piece, "first": first, "words": words})

    @property
    def full(self) -> bool:
        return self.words >= SHARD_WORDS or self.seen >= 4 * SHARD_WORDS

    def indexed(self) -> pa.RecordBatch:
        parts = dict.fromkeys(("counts", "levels", "marks", "samples"), b"")
        starts = np.zeros(0, dtype=np.int64)
        self.known = {}
        if self.pieces:
            index, starts = FmIndex.build(self.pieces, len(self.vocabulary) + 1)
            parts = index.parts()
        return pa.RecordBatch.from_pylist(
            [{"docs": self.docs, "vocabulary": b" ".join(self.vocabulary), "starts": starts.tobytes(), **parts}], schema=_INDEX)


def build_index(docs: DataFrame) -> DataFrame:
    """FM-indexes of shards of ``docs`` (doc_id, text), written to the shared folder; one row a shard.

    Shards are cut from the partitions as they are read, without a shuffle. ``row`` numbers the documents.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for row, doc_id, text_hash, text in columns(batches, "row", "doc_id", "text_hash", "text"):
            words = spaced(text or b"").split()
            for first in range(0, max(1, len(words) - WINDOW + 1), SHARD_WORDS):
                end = min(first + SHARD_WORDS + WINDOW - 1, len(words))
                ids = shard.ids(words[first:end])
                begins = first and first + WINDOW - 1  # what the piece before holds too isn't counted again
                shard.add(row, doc_id, text_hash, ids, first, end - begins)
                if shard.full:
                    yield shard.indexed()
                    shard = _Shard()
        if shard.docs:
            yield shard.indexed()

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(shards, INDEX_SCHEMA), "fm-index")


def phrase_parts(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, words): the items' words, one space between; long items in parts that overlap by a phrase less one word."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for item, text in columns(batches, "item", "text"):
                words = spaced(text or b"").split()
                for first in range(0, len(words) - size + 1 if len(words) >= size else min(1, len(words)), PART_WORDS):
                    part = words[first : first + PART_WORDS + size - 1]
                    yield item, b" ".join(part), len(part)

        yield from batched(rows(), pa.schema([("item", pa.string()), ("words", pa.binary()), ("n", pa.int64())]), weight=lambda r: len(r[1]))

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).distinct()
    return rows.mapInArrow(parts, "item string, words binary, n bigint")


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases of a block: ids into ``vocabulary`` from 1, last word first, padded with 0; ``items[bounds[k]:bounds[k + 1]]`` hold the k-th."""

    vocabulary: list[bytes]
    reversed_ids: np.ndarray
    widths: np.ndarray
    names: list[str | None]
    items: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[str | None, bytes]], size: int = WINDOW) -> Phrases:
        vocabulary, names, holders = _Vocabulary(), {}, {}
        for item, text in rows:
            ids = tuple(vocabulary[w] for w in text.split())
            name = names.setdefault(item, len(names))
            for k in range(max(1, len(ids) - size + 1)):
                holders.setdefault(ids[k : k + size], set()).add(name)
        reversed_ids = np.zeros((len(holders), size), dtype=np.int64)
        for k, phrase in enumerate(holders):
            reversed_ids[k, : len(phrase)] = phrase[::-1]
        sizes = [len(h) for h in holders.values()]
        return cls(list(vocabulary), reversed_ids, np.array([len(p) for p in holders], dtype=np.int64), list(names),
                   np.array([i for h in holders.values() for i in sorted(h)], dtype=np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch as one; sorted."""
    by = np.argsort(low, kind="stable")
    low, high = low[by], np.maximum.accumulate(high[by])
    opens = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]])) if len(low) else np.zeros(0, dtype=np.int64)
    return low[opens], high[np.append(opens[1:], len(low)) - 1] if len(low) else high


def search_shard(index: FmIndex, vocabulary: list[bytes], starts: np.ndarray, phrases: Phrases) -> dict[int, tuple[list, list]]:
    """By piece: its spans of words that phrases cover, from 0, and the items whose phrases occur."""
    own = {word: k for k, word in enumerate(vocabulary, 1)}
    known = np.array([0, *(own.get(w, -1) for w in phrases.vocabulary)], dtype=np.int64)
    ids = known[phrases.reversed_ids]
    there = np.flatnonzero((ids >= 0).all(axis=1))
    low, high = index.search(ids[there])
    met = high > low
    there, low, n = there[met], low[met], (high - low)[met]
    if not len(there):
        return {}
    phrase = np.repeat(there, n)
    rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    at = np.concatenate([index.locate(rows[k : k + 65_536]) for k in range(0, len(rows), 65_536)])
    piece = np.searchsorted(starts, at, side="right") - 1
    begin, end = merged(at, at + phrases.widths[phrase])
    found: dict[int, tuple[list, list]] = {int(p): ([], []) for p in np.unique(piece)}
    of = np.searchsorted(starts, begin, side="right") - 1
    for p, a, b in zip(of.tolist(), (begin - starts[of]).tolist(), (end - starts[of]).tolist(), strict=True):
        found[p][0].append((a, b))
    pairs = np.unique(np.column_stack([piece, phrase]), axis=0)
    sizes = phrases.bounds[pairs[:, 1] + 1] - phrases.bounds[pairs[:, 1]]
    places = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(phrases.bounds[pairs[:, 1]], sizes)
    for p, i in np.unique(np.column_stack([np.repeat(pairs[:, 0], sizes), phrases.items[places]]), axis=0).tolist():
        found[p][1].append(phrases.names[i])
    return found


_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_HITS = pa.schema([("row", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])
SPANS_TYPE = "array<struct<begin:bigint,end:bigint>>"


def hits(index: DataFrame, phrases: Phrases) -> DataFrame:
    """(row, spans, items) of the pieces in which phrases of one block occur."""
    sent = index.sparkSession.sparkContext.broadcast(phrases)  # bounded by BLOCK_WORDS

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k in range(batch.num_rows):
                    shard = {f.name: batch.column(i)[k] for i, f in enumerate(batch.schema)}
                    levels = shard["levels"].as_py()
                    if not levels:
                        continue
                    fm = FmIndex.load(*(shard[c].as_py() for c in ("counts", "levels", "marks", "samples")))
                    by_piece = search_shard(fm, shard["vocabulary"].as_py().split(b" "), np.frombuffer(shard["starts"].as_py(), np.int64), sent.value)
                    if not by_piece:
                        continue
                    docs = shard["docs"].values.flatten()
                    row, piece, first = docs[0], docs[3].to_numpy(), docs[4]
                    for at in np.flatnonzero(np.isin(piece, list(by_piece))).tolist():
                        spans, items = by_piece[int(piece[at])]
                        begins = first[at].as_py()
                        yield row[at].as_py(), [{"begin": a + begins, "end": b + begins} for a, b in spans], items

        yield from batched(rows(), _HITS, most=512)

    return index.mapInArrow(found, f"row bigint, spans {SPANS_TYPE}, items array<string>")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, spans (of words, merged) and items, sorted.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A word is hit if an occurrence of
    any phrase of ``benchmark`` (item_id, text) holds it: ten consecutive words of an item, or all of a shorter one. A null
    or empty text has no words. An item without words has no phrase; items that repeat an id are listed once; phrases of an
    item without id hit words but aren't listed. Repeated rows come back each; an empty table gives no row, an empty
    benchmark no hits. Other columns aren't read.
    """
    index = build_index(docs)
    parts = materialize(phrase_parts(benchmark), "phrases")
    words = parts.agg(F.sum("n")).first()[0] or 0
    blocks = -(-words // BLOCK_WORDS)
    found = index.select(F.explode("docs").alias("d")).select("d.row", "d.doc_id", "d.text_hash", F.col("d.words").alias("n_words"))
    found = found.withColumns({"spans": F.lit(None).cast(SPANS_TYPE), "items": F.lit(None).cast("array<string>")})
    for block in range(blocks):
        held = parts.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).select("item", "words").collect()
        if held:
            found = found.unionByName(hits(index, Phrases.of([(r["item"], bytes(r["words"])) for r in held])), allowMissingColumns=True)
    together = found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("text_hash").alias("text_hash"), F.sum("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text_hash, n_words, spans, items in columns(batches, "doc_id", "text_hash", "n_words", "spans", "items"):
                if not spans:
                    yield doc_id, text_hash, n_words, 0, [], []
                    continue
                begin, end = merged(np.array([s["begin"] for s in spans]), np.array([s["end"] for s in spans]))
                yield (doc_id, text_hash, n_words, int((end - begin).sum()), [{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)],
                       sorted({i for i in items if i is not None}))

        schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])
        yield from batched(rows(), schema)

    return together.mapInArrow(joined, f"doc_id bigint, text_hash bigint, n_words bigint, n_hit bigint, spans {SPANS_TYPE}, items array<string>")


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` less its words of each span, and what stands between them."""
    data = text.encode()
    flat = np.frombuffer(spaced(data), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flat, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    kept, upto = [], 0
    for a, b in spans:
        kept.append(data[upto : begins[a]])
        upto = ends[b - 1]
    return b"".join([*kept, data[upto:]]).decode()


def decontaminated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``found`` (see :func:`contaminated`) cut out of their texts; rows and other columns stay."""
    spans = found.filter("n_hit > 0").groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(F.first("spans").alias("_spans"))
    met = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_hash")), "left")

    @F.pandas_udf("string")
    def cut(text, spans):
        return text.combine(spans, lambda t, s: t if s is None or t is None else without_spans(t, [(x["begin"], x["end"]) for x in s]))

    return met.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut("text", "_spans"))).select(*docs.columns)


#: The contract's rows for DuckDB.
ORACLE_SQL = r"""
with of_docs as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
of_items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark),
phrases as (
    select distinct item_id, least(len(w), 10) as width, array_to_string(w[p : p + 9], ' ') as phrase
    from of_items, lateral (select unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p) where len(w) > 0),
windows as (
    select doc_id, p, width, array_to_string(w[p : p + width - 1], ' ') as phrase
    from of_docs, (select distinct width from phrases), lateral (select unnest(range(1, len(w) + 1)) as p) where p + width - 1 <= len(w)),
met as (select doc_id, p, width, item_id from windows join phrases using (width, phrase)),
hit as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(p, p + width)) as place from met) group by doc_id),
items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct doc_id, item_id::varchar as item from met where item_id is not null) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from of_docs left join hit using (doc_id) left join items using (doc_id)
"""
