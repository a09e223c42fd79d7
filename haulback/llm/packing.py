"""Packing token sequences by multiway number differencing.

Documents longer than a window are cut into whole windows; what remains is cut into pieces of at most
``PIECE`` tokens. Pieces are dealt by hash into lots of bounded size, and each lot is spread over the fewest
windows that can hold it by Karmarkar and Karp's method: every piece starts as a partition of its own, and the two
partitions with the largest imbalance are merged, the fullest window of one with the emptiest of the other, until
one is left. Its windows are nearly equal. If one exceeds the capacity, the lot gets a window more.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.llm.tables import batched, columns
from haulback.llm.token_ids import text_encoder, tokenizer_path
from haulback.session import materialize

CAPACITY = 2048
#: Longest piece of what a document has beyond whole windows. Short pieces balance well; long ones keep documents together.
PIECE = 256
#: Pieces that are balanced together, about.
LOT = 2048

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def differenced(lengths: list[int], windows: int) -> list[list[int]]:
    """Indexes of ``lengths`` spread over ``windows`` groups of nearly equal sums.

    A partition is kept as its non-empty groups, (sum, members) by falling sum, with a shared offset taken off where
    all groups are used, as only differences matter.
    """
    heap = [(-n, k, [(n, (k, None, None))]) for k, n in enumerate(lengths)]
    heapq.heapify(heap)
    ties = len(lengths)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over <= 0:
            merged = a + b
        else:  # the emptiest of one take the fullest of the other
            merged = a[: len(a) - over] + b[: len(b) - over]
            merged += [(x + y, (None, m, n)) for (x, m), (y, n) in zip(a[len(a) - over:], reversed(b[len(b) - over:]), strict=True)]
        merged.sort(key=lambda g: -g[0])
        if len(merged) == windows and (least := merged[-1][0]):
            merged = [(n - least, m) for n, m in merged]
        ties += 1
        heapq.heappush(heap, (-(merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)), ties, merged))
    return [_members(m) for _, m in heap[0][2]] if heap else []


def _members(tree) -> list[int]:
    found, open_ = [], [tree]
    while open_:
        k, a, b = open_.pop()
        if k is not None:
            found.append(k)
        else:
            open_ += [a, b]
    return found


def packed(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Indexes of ``lengths``, none above ``capacity``, in as few windows as differencing finds, none above ``capacity``."""
    windows = -(-sum(lengths) // capacity)
    while True:
        groups = differenced(lengths, windows) if windows else []
        if all(sum(lengths[k] for k in g) <= capacity for g in groups):
            return groups
        windows += 1


def cut_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens.

    Each document's ids, ``end_id`` last, are cut into whole windows and then into pieces of at most ``PIECE``.
    """
    path = tokenizer_path(tokenizer) if tokenizer else tokenizer_path()
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for doc_id, text in columns(batches, "doc_id", "text"):
                ids = text_encoder(path)(text) + end
                n, at = len(ids) // 4, 0
                while at < n:
                    length = CAPACITY if n - at >= CAPACITY else min(PIECE, n - at)
                    yield doc_id, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), n
                    at += length

        yield from batched(pieces(), _PIECES)

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """The pieces of all ``docs`` with the sequence each goes to, and its offset there.

    Every id lies in exactly one piece, and a sequence holds at most ``CAPACITY`` ids, gapless from 0. Whole windows
    are sequences of their own. A null or empty text is its end id alone; a null doc_id stays null; repeated rows
    are packed once each; an empty table gives no row; other columns are not read. The pieces are written to the
    shared folder first: texts are tokenized once, and the number of lots follows from what was written. A lot is a
    hash share of the pieces, so its size doesn't depend on any document or source.
    """
    pieces = materialize(cut_documents(docs, tokenizer, end_id), "pieces")
    # repeated rows share doc_id and start: the copy counts too, lest a lot grow with them
    pieces = pieces.withColumn("copy", F.monotonically_increasing_id())
    whole = pieces.filter(F.col("length") == CAPACITY)
    rest = pieces.filter(F.col("length") < CAPACITY)
    lots = max(1, rest.count() // LOT)
    kept = [f for f in pieces.columns if f != "copy"]

    def spread(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        window, offset = [0] * len(lengths), [0] * len(lengths)
        for w, group in enumerate(packed(lengths)):
            at = 0
            for k in group:
                window[k], offset[k] = w, at
                at += lengths[k]
        sequence = pa.array([(key[0].as_py() << 20) + w for w in window], pa.int64())
        table = table.drop_columns(["lot", "copy"])
        return table.append_column("sequence_id", sequence).append_column("offset", pa.array(offset, pa.int64()))

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    rest = rest.withColumn("lot", F.pmod(F.xxhash64("doc_id", "start", "copy"), F.lit(lots)))
    balanced = rest.groupBy("lot").applyInArrow(spread, schema)
    alone = whole.select(*kept, (-1 - F.col("copy")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return balanced.unionByName(alone)
