"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes puts the chunk boundaries where the content says, so an insertion moves only the
boundaries around it. Boundaries are normalised: a harder mask before the usual length, an easier one behind it. A
fingerprint is the set of chunk digests, each weighing its chunk's bytes; the weight of the shared digests over the
weight of all measures containment.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.llm.tables import batched, columns

LEAST, USUAL, MOST = 24, 64, 256
_HARD, _EASY = np.uint32(0b1111111 << 25), np.uint32(0b11111 << 27)
#: Multiplies a byte, by position in the table, into its gear value.
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=1) for b in range(256)], dtype=np.uint32)

#: Characters of text that one range of documents holds, about.
RANGE_CHARS = 8_000_000


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; none for no bytes."""
    n = len(data)
    if not n:
        return []
    gear = _GEAR[np.frombuffer(data, np.uint8)]
    for back in (1, 2, 4, 8, 16):  # sums of gear values, doubled at each byte passed, over 2, 4, ... 32 bytes
        gear[back:] = gear[back:] + (gear[:-back] << np.uint32(back))
    places = np.flatnonzero((gear & _EASY) == 0)
    hard = ((gear[places] & _HARD) == 0).tolist()
    ends, start = [], 0
    for place, is_hard in zip((places + 1).tolist(), hard, strict=True):
        while place > start + MOST:
            start += MOST
            ends.append(start)
        if place >= start + LEAST and (is_hard or place >= start + USUAL):
            ends.append(place)
            start = place
    while n - start > MOST:
        start += MOST
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def fingerprint(text: str | None) -> dict[int, int]:
    """Length by 48-bit digest of the chunks of a text's UTF-8 bytes; empty for null or empty."""
    data = (text or "").encode()
    found, start = {}, 0
    for end in boundaries(data):
        found[xxhash.xxh3_64_intdigest(data[start:end]) >> 16] = end - start
        start = end
    return found


def written(print_: dict[int, int]) -> str:
    """A fingerprint as text: base64 of 6 bytes of digest and 2 of length for each chunk, by digest."""
    packed = np.array([(d << 16) | n for d, n in sorted(print_.items())], dtype=">u8")
    return base64.b64encode(packed.tobytes()).decode()


def read_back(text: str) -> dict[int, int]:
    packed = np.frombuffer(base64.b64decode(text), dtype=">u8")
    return {int(v) >> 16: int(v) & 0xFFFF for v in packed}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of ``a``'s weight that ``b`` holds too; 1 if both are empty, 0 if one is."""
    if not a or not b:
        return float(a == b)
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


_ROWS = pa.schema([("range", pa.int32()), ("guest", pa.bool_()), ("doc_id", pa.int64()), ("text", pa.string())])
_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def in_ranges(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) dealt into ranges of falling doc_id, each followed by its guest, the first of the next range.

    Bounds are doc_ids that occur, from one approximate-quantile aggregation, so the first document of a range is
    known without sorting all of them, and every document but those is moved once.
    """
    size = docs.agg(F.sum(F.length("text")).alias("chars"), F.max("doc_id").alias("last")).first()
    ranges = max(1, -(-(size["chars"] or 0) // RANGE_CHARS))
    bounds: list[int] = []
    if size["last"] is not None:
        inner = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 20 * ranges).alias("b")).first()["b"] if ranges > 1 else []
        bounds = sorted({size["last"], *inner})
    upward = np.array(bounds, dtype=np.int64)
    n = max(1, len(bounds))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, text = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            known = np.array(doc_id.is_valid())
            ids = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(upward, ids)  # the smallest bound that isn't below
            own = np.where(known, n - 1 - at, n - 1).astype(np.int32)
            opens = known & (upward[np.minimum(at, len(upward) - 1)] == ids) if len(upward) else ~known
            guests = np.flatnonzero(opens)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.zeros(len(own), bool)), doc_id, text.cast(pa.string())], schema=_ROWS)
            if len(guests):
                # the first of all documents follows the last
                before = np.where(own[guests] == 0, n - 1, own[guests] - 1).astype(np.int32)
                picked = pa.array(guests)
                yield pa.RecordBatch.from_arrays([pa.array(before), pa.array(np.ones(len(guests), bool)), doc_id.take(picked), text.take(picked).cast(pa.string())], schema=_ROWS)

    rows = docs.select("doc_id", "text").mapInArrow(dealt, "range int, guest boolean, doc_id bigint, text string")
    return rows.repartition(n, "range").sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its fingerprint, that of an edited text, and their likeness.

    The edited text ends in the first floor(n_chars / 3) characters, or all, of the next document instead of its own
    last ones. Next is the next smaller doc_id, the largest after the smallest; nulls count as smallest, rows of one
    doc_id follow each other in text order. ``near_edited`` and ``near_next`` are the containment of the fingerprint
    in the edited text's and in the next document's. A null text counts as empty; an empty table gives no row; other
    columns aren't read.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held = None  # range, doc_id, text, fingerprint of the document whose next is awaited
            closed = None
            for at, guest, doc_id, text in columns(batches, "range", "guest", "doc_id", "text"):
                if at == closed:
                    continue  # the range has met its guest
                text = text or ""
                own = fingerprint(text)
                if held is not None and held[0] == at:
                    yield row(*held[1:], text, own)
                held = None if guest else (at, doc_id, text, own)
                closed = at if guest else None

        def row(doc_id, text, own, next_text, next_print):
            cut = len(text) // 3
            edited = text[: len(text) - cut] + next_text[:cut]
            changed = fingerprint(edited) if edited != text else own
            return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(changed),
                    containment(own, changed), containment(own, next_print))

        yield from batched(rows(), _OUT, most=512, weight=lambda r: len(r[3]) + len(r[4]), most_weight=8 << 20)

    return in_ranges(docs).mapInArrow(
        compared, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
