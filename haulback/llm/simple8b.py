"""Token ids as Simple-8b files.

Word-aligned coding: each 64-bit word holds a 4-bit selector and 60 bits of payload, into which as many ids are
packed as fit at one width. Ids of more than 60 bits follow an escape word as they are. Blocks of ``BLOCK`` ids
start on a word of their own and a table of their word offsets stands in front, so that any block is found
without reading the ones before it, and all blocks of a file are coded and decoded side by side by numpy.

A file is one binary value: header ``<4sHHQQQ`` (magic, version, ids per block, ids, documents, words), then as
little-endian arrays: word offset of each block (u8), ids of each document (u4), the words (u8). Files lie as
rows ``(part, seq, doc_ids, ids, payload)`` of a Parquet table in the shared folder: Spark's writers are what
reaches any store, and a lost task's rows are written again or not at all.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulback.llm.tables import batched, columns
from haulback.llm.token_ids import text_encoder, tokenizer_path
from haulback.session import materialize

MAGIC = b"HS8B"
BLOCK = 256
#: Ids after which a file is closed; a document is never split.
FILE_IDS = 1 << 20

# Ids held by a word, and their width in bits, by selector. Selector 0, else a run of 240 zeros, is the
# escape here: the next word is one id as it is.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 0
_LEVEL_OF_BITS = np.array([-1, *(np.searchsorted(WIDTHS[2:], n) for n in range(1, 65))], dtype=np.int8)
_LEVEL = _LEVEL_OF_BITS[np.frexp(np.arange(1 << 16, dtype=np.float64))[1]]


def _levels(values: np.ndarray) -> np.ndarray:
    """For each value the narrowest of WIDTHS[2:] that holds it; -1 for zero, 14 for more than 60 bits."""
    if values.max(initial=0) < len(_LEVEL):
        return _LEVEL[values]
    high, low = (np.frexp(part.astype(np.float64))[1] for part in (values >> np.uint64(32), values & np.uint64(0xFFFFFFFF)))
    return _LEVEL_OF_BITS[np.where(high > 0, high + 32, low)]


def _selectors(need: np.ndarray) -> np.ndarray:
    """For every place of the blocks, the selector that holds most of the values from there on in one word."""
    blocks = len(need)
    chosen = np.full(need.shape, ESCAPE, dtype=np.int8)
    ahead = np.full((blocks, BLOCK + int(COUNTS[0])), -1, dtype=np.int8)
    ahead[:, :BLOCK] = need
    held = 1
    for s in range(15, 0, -1):
        if s < 8 and not (chosen == s + 1).any():
            break
        more = int(COUNTS[s]) - held  # the widest value of a run, from two shorter runs that overlap
        ahead[:, : ahead.shape[1] - more] = np.maximum(ahead[:, : ahead.shape[1] - more], ahead[:, more:])
        held += more
        chosen[ahead[:, :BLOCK] <= s - 2] = s
    return chosen


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of unsigned integers, and the word offset of each block.

    The last word of a block may hold fewer values than its selector says; its other places are zero.
    """
    values = np.ascontiguousarray(values, dtype=np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    flat = np.zeros(blocks * BLOCK + int(COUNTS[0]), dtype=np.uint64)
    flat[: len(values)] = values
    need = _levels(flat[: blocks * BLOCK])
    need[len(values) :] = -1
    chosen = _selectors(need.reshape(blocks, BLOCK)).ravel()
    steps = np.where(chosen == ESCAPE, 1, COUNTS[chosen]).astype(np.int64)
    opens = np.zeros(blocks * BLOCK, dtype=bool)  # the values that open a word
    ends = np.minimum(np.arange(1, blocks + 1) * BLOCK, len(values))
    at = np.arange(blocks) * BLOCK
    while len(at):  # each turn opens one word of every block that isn't done
        opens[at] = True
        at = at + steps[at]
        live = at < ends
        at, ends = at[live], ends[live]
    start = np.flatnonzero(opens)
    selector = chosen[start].astype(np.int64)
    left = np.minimum((start // BLOCK + 1) * BLOCK, len(values)) - start
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        for k in range(int(COUNTS[s]) if len(mine) else 0):
            part = flat[start[mine] + k] << np.uint64(k * WIDTHS[s])
            part[left[mine] <= k] = 0
            words[mine] |= part
    escaped = np.flatnonzero(selector == ESCAPE)
    words = np.insert(words, escaped + 1, flat[start[escaped]])
    per_block = np.bincount(start // BLOCK, minlength=blocks) + np.bincount(start[escaped] // BLOCK, minlength=blocks)
    return words, (np.cumsum(per_block) - per_block).astype(np.uint64)


def _opened(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The words that open values: all but those that stand behind an escape."""
    opens = np.ones(len(words), dtype=bool)
    if (words >> np.uint64(60) == ESCAPE).any():
        at, ends = offsets, np.append(offsets[1:], len(words))
        while len(at):  # each turn passes one word of every block, or an escape with the word behind it
            escape = words[at] >> np.uint64(60) == ESCAPE
            opens[at[escape] + 1] = False
            at = at + 1 + escape
            live = at < ends
            at, ends = at[live], ends[live]
    return opens


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` integers of :func:`encode` in the blocks at ``offsets``, some or all of them in turn."""
    blocks = len(offsets)
    out = np.zeros(blocks * BLOCK + int(COUNTS[0]), dtype=np.uint64)
    if not blocks:
        return out[:0]
    words, offsets = words[int(offsets[0]) :], offsets.astype(np.int64) - int(offsets[0])
    place = np.flatnonzero(_opened(words, offsets))
    word = words[place]
    selector = (word >> np.uint64(60)).astype(np.int64)
    count = np.where(selector == ESCAPE, 1, COUNTS[selector])
    first = np.searchsorted(place, offsets)
    block = np.repeat(np.arange(blocks), np.diff(np.append(first, len(place))))
    before = np.cumsum(count) - count
    start = before - before[first][block] + block * BLOCK
    left = np.minimum((block + 1) * BLOCK, n) - start  # none for what stands behind the last block
    for s in np.unique(selector).tolist():
        mine = np.flatnonzero((selector == s) & (left > 0))
        if s == ESCAPE:
            out[start[mine]] = words[place[mine] + 1]
        elif WIDTHS[s]:
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            for k in range(int(COUNTS[s])):
                held = mine if k == 0 else mine[left[mine] > k]
                out[start[held] + k] = word[held] >> np.uint64(k * WIDTHS[s]) & mask
    return out[:n]


def write_file(doc_ids: list[bytes]) -> bytes:
    """One file of the ids (little-endian unsigned 32-bit) of some documents."""
    lengths = np.array([len(x) // 4 for x in doc_ids], dtype="<u4")
    words, offsets = encode(np.frombuffer(b"".join(doc_ids), dtype="<u4"))
    head = struct.pack("<4sHHQQQ", MAGIC, 1, BLOCK, int(lengths.sum()), len(lengths), len(words))
    return b"".join([head, offsets.astype("<u8").tobytes(), lengths.tobytes(), words.astype("<u8").tobytes()])


def read_file(payload: bytes) -> list[bytes]:
    """The documents of :func:`write_file`."""
    magic, version, block, n, n_docs, n_words = struct.unpack_from("<4sHHQQQ", payload)
    if (magic, version, block) != (MAGIC, 1, BLOCK):
        raise ValueError("not a Simple-8b file of this version")
    at = struct.calcsize("<4sHHQQQ")
    n_blocks = -(-n // BLOCK)
    offsets = np.frombuffer(payload, "<u8", n_blocks, at)
    lengths = np.frombuffer(payload, "<u4", n_docs, at + 8 * n_blocks)
    words = np.frombuffer(payload, "<u8", n_words, at + 8 * n_blocks + 4 * n_docs)
    ids = decode(words, offsets, n).astype("<u4")
    ends = np.cumsum(lengths, dtype=np.int64)
    return [ids[e - k:e].tobytes() for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]


_FILES = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("ids", pa.int64()), ("payload", pa.binary())])
_READ = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def write_ids(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the ids of all ``docs`` (doc_id, text) in ascending doc_id order, ``end_id`` after each document.

    Returns the written table of files. ``part`` ascends with doc_id, ``seq`` within ``part``. Null texts count as
    empty; a null doc_id comes first; rows of one doc_id stand in text order; an empty table gives no file. Other
    columns are not read. Documents are range-partitioned, so no task holds more than a share of the rows, and a
    file holds ``FILE_IDS`` ids, or more only where one document has more.
    """
    path = tokenizer_path(tokenizer) if tokenizer else tokenizer_path()
    end = int(end_id).to_bytes(4, "little")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def files():
            ids, held, n, seq = [], [], 0, 0
            for doc_id, text in columns(batches, "doc_id", "text"):
                ids.append(doc_id)
                held.append(text_encoder(path)(text) + end)
                n += len(held[-1]) // 4
                if n >= FILE_IDS:
                    yield part, seq, ids, n, write_file(held)
                    ids, held, n, seq = [], [], 0, seq + 1
            if held:
                yield part, seq, ids, n, write_file(held)

        yield from batched(files(), _FILES, most=1)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(encoded, "part int, seq int, doc_ids array<bigint>, ids bigint, payload binary"), "simple8b")


def read_ids(files: DataFrame) -> DataFrame:
    """Per document of the written files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Only the number of ids of each file crosses files: totals of the parts are summed up in order, then the files
    of each part.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k in range(batch.num_rows):
                    part, seq, doc_ids, _, payload = (c[k].as_py() for c in batch.columns)
                    before = 0
                    for doc_id, ids in zip(doc_ids, read_file(payload), strict=True):
                        yield part, seq, doc_id, before, len(ids) // 4, zlib.crc32(ids)
                        before += len(ids) // 4

        yield from batched(rows(), _READ)

    sizes = files.select("part", "seq", "ids")
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    parts = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("part_start"))
    in_part = F.sum("ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("ids")
    starts = sizes.withColumn("in_part", in_part).join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("in_part")).alias("file_start"))
    found = files.select("part", "seq", "doc_ids", "ids", "payload").mapInArrow(decoded, "part int, seq int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
