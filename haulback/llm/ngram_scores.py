"""N-gram language-model scores from sharded Elias-Fano tries.

A word is a 64-bit hash. The model has two tries, of words and of pairs of words as contexts, with their successors, cut
into shards by the previous word, so that neither the model nor its vocabulary ever has to fit into one task. Documents
send their n-grams to the shards, and each shard first builds its part of the tries from the training documents'
n-grams, maps it into memory from a file of the task, and then scores the n-grams of all documents. Of each trie:

* level 1: the context hashes, monotone; where each context's successors begin, monotone; their counts;
* level 2: successors as 40 bits of their hashes, made monotone by adding what the contexts before have used up, and searched
  relative to their context; beside them the smoothed log probability, quantised to 256 levels.

Smoothing is by absolute discounting: a successor seen c times after a context of count C has (c - D) / C; any other
has D * T / C (T: distinct successors) times its probability of the order below, and just that after an unknown context:
after a pair that after its second word, after a word the smoothed unigram probability. A text's first word has its
begin as context, and no pair. The unigram counts of unseen n-grams come from an ordinary join with the table of word counts.

A word that makes up more than a share of all tokens has shards of its own. Where pairs are contexts that's by
pair: each is in one shard, and the unseen n-grams meet the word's successors in a join. Else, and for a pair that is as
frequent itself, it's by successor. Each of these shards knows the counts of its own successors only; C and T are summed
over the shards afterwards, and enter the scores by how many n-grams of a document were seen after the context, and how
many not.
"""

from __future__ import annotations

import pickle
import tempfile
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.llm.elias_fano import EliasFano, encode
from haulback.llm.shingles import mixed, word_hashes
from haulback.llm.tables import batched, columns
from haulback.session import materialize

DISCOUNT = 0.75
LEVELS = 256
#: Tokens whose n-grams one shard holds, about.
SHARD_TOKENS = 800_000
#: Share of all tokens from which a word's n-grams are split, whatever the size of the table; half a shard's where that is less.
SPLIT_SHARE = 300
#: N-grams of documents that are told apart and looked up together; of a shard with more, blocks wait in a file.
BLOCK = 1_200_000
#: Shards that one task builds and asks, one after another: a document's scores of them are summed before they leave.
TASK_SHARDS = 4
#: Tokens of documents sent off together, and documents at most.
SENT_TOKENS, SENT_DOCS = 800_000, 60_000

BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"\n begin"))
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n end"))
_PART = np.uint64((1 << 48) - 1)
#: Of a successor, what is told apart within its context. With fewer than 2^23 contexts a shard, a trie's values stay below 2^63.
_RELATIVE = np.uint64((1 << 40) - 1)
#: Of a pair's first word, what is told apart before its second; the last bit says that there is one.
_EARLIER = np.uint64((1 << 32) - 1)
#: A batch of documents tells of the pairs that are at least such a part of it: those to split are many times that in most.
PAIR_SHARE = 1 / 40_000


def held_out(doc_id: Column) -> Column:
    """The documents nothing is learned from: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def word_counts(training: DataFrame, order: int = 2) -> DataFrame:
    """(word, pair, c): how often each token, the end of each text included, occurs; words as 64-bit hashes.

    Counted within each batch of documents first, then across. At order 3 also the pairs (true) that are frequent in a
    batch: their counts, from the batches where they are.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes in _grouped(((word_hashes(text), None) for (text,) in columns(batches, "text"))):
            tokens, contexts, earlier, _ = _tokens(hashes, order)
            found = [np.unique(tokens, return_counts=True)]
            if order > 2:
                pair, c = np.unique(pairs_of(contexts, earlier)[earlier > 0], return_counts=True)
                often = c > max(1, len(tokens) * PAIR_SHARE)
                found.append((pair[often], c[often]))
            for is_pair, (word, c) in enumerate(found):
                for at in range(0, len(word), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(word[part].view(np.int64)), pa.array(np.full(len(c[part]), bool(is_pair))), pa.array(c[part].astype(np.int64))], names=["word", "pair", "c"])

    return training.select("text").mapInArrow(counted, "word bigint, pair boolean, c bigint").groupBy("word", "pair").agg(F.sum("c").alias("c"))


def pairs_of(context: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """Hashes, of 48 bits, of the pairs of a context and what is kept of the word before it."""
    return mixed(context + earlier.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)


def _grouped(rows: Iterator[tuple]) -> Iterator[list]:
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[0]) + 1
        if n >= SENT_TOKENS or len(held) >= SENT_DOCS:
            yield held
            held, n = [], 0
    if held:
        yield held


class Shards:
    """Which shard holds an n-gram. ``frequent`` and ``pairs``: (hash, count) of the words and pairs to split.

    ``by_pair``: the words whose n-grams are split by pair, not by successor.
    """

    def __init__(self, tokens: int, frequent: list[tuple[int, int]], pairs: list[tuple[int, int]] = (), by_pair: frozenset[int] = frozenset()):
        self.plain = max(1, -(-tokens // SHARD_TOKENS))
        self.share = max(1, tokens // self.plain)
        self.words, self.parts, self.first, self.total = self._placed(frequent, self.plain)
        self.by_pair = np.array([int(w) in by_pair for w in self.words], dtype=bool)
        self.begin_pairs = self.total
        self.pairs, self.pair_parts, self.pair_first, self.total = self._placed(pairs, self.total)

    def _placed(self, frequent, begin: int):
        frequent = sorted(frequent)
        parts = np.array([2 * c // self.share + 1 for _, c in frequent], dtype=np.int64)
        return np.array([w for w, _ in frequent], dtype=np.uint64), parts, begin + np.cumsum(parts) - parts, int(begin + parts.sum())

    @staticmethod
    def is_frequent(tokens: int) -> tuple[int, int]:
        """Counts above which a word and a pair are split: for a pair half a shard, for a word that or ``SPLIT_SHARE``.

        So at most ``SPLIT_SHARE`` contexts, or twice as many as shards are.
        """
        half = max(1, tokens // max(1, -(-tokens // SHARD_TOKENS)) // 2)
        return max(1, min(half, tokens // SPLIT_SHARE)), half

    def __call__(self, context: np.ndarray, word: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        shard = ((context >> np.uint64(32)) * np.uint64(self.plain) >> np.uint64(32)).astype(np.int64)
        if not len(self.words):
            return shard
        at = np.minimum(np.searchsorted(self.words, context), len(self.words) - 1)
        hot = np.flatnonzero(self.words[at] == context)
        at = at[hot]
        pair = pairs_of(context[hot], earlier[hot])
        by = np.where(self.by_pair[at], pair, word[hot])
        shard[hot] = self.first[at] + (by % self.parts[at].astype(np.uint64)).astype(np.int64)
        if len(self.pairs):  # both words of a frequent pair are frequent
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            as_frequent = np.flatnonzero((self.pairs[at] == pair) & (earlier[hot] > 0))
            at = at[as_frequent]
            shard[hot[as_frequent]] = self.pair_first[at] + (word[hot[as_frequent]] % self.pair_parts[at].astype(np.uint64)).astype(np.int64)
        return shard

    def split(self, shard: int) -> tuple[int | None, bool]:
        """The context (word or pair) whose successors this shard holds a part of, and whether a word's pairs are split."""
        if shard >= self.begin_pairs:
            return int(self.pairs[np.searchsorted(self.pair_first, shard, side="right") - 1]), True
        if shard < self.plain:
            return None, False
        k = np.searchsorted(self.first, shard, side="right") - 1
        return (None, True) if self.by_pair[k] else (int(self.words[k]), False)


def _tokens(docs: list, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token of some documents: its hash, that of the context, what is kept of the word before (0: none), its document."""
    lengths = np.array([len(h) + 1 for h, _ in docs])
    tokens = np.concatenate([x for h, _ in docs for x in (h, [END])]).astype(np.uint64)
    begins = np.cumsum(lengths) - lengths
    contexts = np.empty_like(tokens)
    contexts[1:] = tokens[:-1]
    contexts[begins] = BEGIN
    earlier = np.zeros(len(tokens), np.uint64)
    if order > 2:
        earlier[1:] = (contexts[:-1] & _EARLIER) | np.uint64(1)
        earlier[begins] = 0
    return tokens, contexts, earlier, np.repeat(np.arange(len(docs)), lengths)


def _starts(*columns_: np.ndarray) -> np.ndarray:
    """Where a row of some columns differs from the one before."""
    if not len(columns_[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns_]))))


#: Which arrays of a payload are compressed: hashes and places don't get smaller; lengths and counts do.
_KINDS = (("<u8", False), ("<u4", True), ("<u2", False), ("<u4", False), ("<u2", False), ("<u2", False), ("<u4", False), ("<u2", False), ("<u4", True))
#: Codes of words that aren't listed, and of no word.
_OTHER, _NONE = 65_535, 65_534
#: Words that have a code, a text's begin besides.
LISTED = _NONE - 1


class Listed:
    """The most frequent words, that n-grams are sent with two bytes of: at most as many as two bytes can tell."""

    def __init__(self, words: list[int]):
        self.words = np.sort(np.array(words, dtype=np.uint64))

    def codes(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), _OTHER, np.uint16)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, _OTHER).astype(np.uint16)

    def words_of(self, codes: np.ndarray, others: np.ndarray) -> np.ndarray:
        found = np.zeros(len(codes), np.uint64)
        is_listed = codes < _NONE
        found[is_listed] = self.words[codes[is_listed]]
        found[codes == _OTHER] = others
        return found


def _once(tokens, contexts, earlier, doc) -> tuple[np.ndarray, np.ndarray] | None:
    """Where each n-gram of a document is first, and how often it is there; None where few of them repeat."""
    key = mixed(mixed(pairs_of(contexts, earlier) ^ tokens) + doc.astype(np.uint64))
    ordered = np.sort(key)
    if np.count_nonzero(ordered[1:] == ordered[:-1]) <= len(key) // 8:
        return None
    by = np.lexsort((doc, earlier, tokens, contexts))
    first = _starts(contexts[by], tokens[by], earlier[by], doc[by])
    return by[first], np.diff(np.append(first, len(by)))


def _pack(context, word, code, earlier, earlier_code, doc, count) -> bytes:
    """N-grams of one shard by context: contexts, their words and what is before them, places of documents."""
    ones, other = _starts(context), word[code == _OTHER] & _PART
    arrays = [
        context[ones], np.diff(np.append(ones, len(context))), code, other & np.uint64(0xFFFFFFFF), other >> np.uint64(32), earlier_code, earlier[earlier_code == _OTHER], doc, count if count.max() > 1 else count[:0]]
    packed = [zlib.compress(a.astype(kind).tobytes(), 1) if small else a.astype(kind, copy=False).tobytes() for a, (kind, small) in zip(arrays, _KINDS, strict=True)]
    return b"".join([np.array([len(p) for p in packed], "<u4").tobytes(), *packed])


def _unpack(payload: bytes, listed: Listed):
    """context, word, earlier, place of the document and count of each n-gram."""
    lengths = np.frombuffer(payload, "<u4", len(_KINDS))
    ends = 4 * len(_KINDS) + np.cumsum(lengths, dtype=np.int64)
    parts = [payload[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
    contexts, runs, code, low, high, earlier_code, before, doc, count = (
        np.frombuffer(zlib.decompress(p) if small else p, kind) for p, (kind, small) in zip(parts, _KINDS, strict=True))
    earlier = listed.words_of(earlier_code, before)
    earlier = np.where(earlier_code == _NONE, np.uint64(0), (earlier & _EARLIER) | np.uint64(1))
    word = listed.words_of(code, low | (high.astype(np.uint64) << np.uint64(32)))
    return np.repeat(contexts, runs), word, earlier, doc, count.astype(np.int32) if len(count) else np.ones(len(doc), np.int32)


class Block:
    """N-grams of one shard, a bounded number: the distinct ones in order, and of each entry its n-gram, document and count."""

    def __init__(self, parts: list[tuple], trained: np.ndarray):
        context, word, earlier, self.doc, self.count = (np.concatenate(x) for x in zip(*parts, strict=True))
        relative = word & _RELATIVE
        order = np.lexsort((earlier, relative, context))
        context, relative, earlier = context[order], relative[order], earlier[order]
        first = _starts(context, relative, earlier)
        self.context, self.relative, self.earlier, self.word = context[first], relative[first], earlier[first], word[order[first]]
        self.place = np.empty(len(order), np.int32)
        self.place[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(order))))
        self.taught = np.bincount(self.place, self.count * trained[self.doc], len(first)).astype(np.int64)
        has_pair = np.flatnonzero(self.earlier > 0)
        pair = pairs_of(self.context[has_pair], self.earlier[has_pair])
        by = np.lexsort((self.relative[has_pair], pair))
        #: the n-grams with a pair by pair and successor, and the pairs
        self.paired, self.pair = has_pair[by].astype(np.int32), pair[by]

    def learned(self) -> tuple:
        mine = self.taught > 0
        return self.context[mine], self.relative[mine], self.earlier[mine], self.taught[mine]


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``LEVELS`` values and the code of each input: equal steps over the range, each standing for its members' mean."""
    if not len(values):
        return np.zeros(1), np.zeros(0, np.uint8)
    low, span = values.min(), np.ptp(values) or 1.0
    code = np.minimum((values - low) * (LEVELS / span), LEVELS - 1).astype(np.uint8)
    members = np.bincount(code, minlength=LEVELS)
    return np.bincount(code, values, LEVELS) / np.maximum(members, 1), code


class Trie:
    """One shard of the model, read from a buffer that :meth:`build` has made."""

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, count: np.ndarray, whole: bool = True, counted: bool = True) -> bytes:
        """From distinct n-grams by context and word, words of 40 bits.

        Not ``whole``: other shards hold a part of the successors, and probabilities are still to be divided by C. Not ``counted``: without the contexts' counts.
        """
        first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(context) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(context)) if len(context) else first
        sums = np.add.reduceat(count, first) if len(first) else first
        last = word[ends - 1] if len(first) else word
        if last.astype(np.float64).sum() >= 2.0**63:
            raise ValueError("too many contexts for one shard")
        base = np.concatenate(([np.uint64(0)], np.cumsum(last[:-1] + np.uint64(1), dtype=np.uint64))) if len(first) else word
        owner = np.repeat(np.arange(len(first)), ends - first)
        exact = np.log10((count - DISCOUNT) / (sums[owner] if whole else 1)) if len(first) else np.zeros(0)
        levels, codes_of = _quantised(exact)
        spare = np.log10(np.minimum(1.0, DISCOUNT * (ends - first) / np.maximum(sums, 1))) if len(first) else np.zeros(0)
        codes = [encode(context[first]), encode(first.astype(np.uint64)), encode(base), encode(base[owner] + word)]
        arrays = [sums.astype("<i8") if counted else sums[:0].astype("<i8"), spare.astype("<f4"), levels.astype("<f8"), codes_of]
        head = np.array([len(x) for x in arrays], "<u8").tobytes()
        return head + b"".join(codes) + b"".join(a.tobytes() for a in arrays)

    def __init__(self, buffer):
        n, m, k, e = np.frombuffer(buffer, "<u8", 4).tolist()
        self.contexts = EliasFano(buffer, 32)
        self.begins = EliasFano(buffer, self.contexts.end)
        self.bases = EliasFano(buffer, self.begins.end)
        self.successors = EliasFano(buffer, self.bases.end)
        at = self.successors.end
        self.counts = np.frombuffer(buffer, "<i8", n, at)
        self.spare = np.frombuffer(buffer, "<f4", m, at + 8 * n)
        self.levels = np.frombuffer(buffer, "<f8", k, at + 8 * n + 4 * m)
        self.codes = np.frombuffer(buffer, np.uint8, e, at + 8 * (n + k) + 4 * m)

    def find(self, contexts: np.ndarray, runs: np.ndarray, word: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each context its count (0: unknown, or not counted); of each n-gram its log10 probability, and whether it was seen.

        For an unseen one that's the share left to the unigram, 0 (all of it) after an unknown context. ``place``: which of
        the trie's n-grams it is, where the caller has kept that; -1 where it is to be searched.
        """
        count, log = np.zeros(len(contexts), np.int64), np.zeros(len(word))
        seen = np.zeros(len(word), dtype=bool)
        if not self.contexts.n:
            return count, log, seen
        owner = np.repeat(np.arange(len(contexts)), runs)
        searched = np.flatnonzero(place < 0) if place is not None else np.arange(len(word))
        if place is not None:
            seen = place >= 0
            log[seen] = self.levels[self.codes[place[seen]]]
        # contexts whose counts are asked for, or some of whose n-grams are
        asked = np.ones(len(contexts), dtype=bool)
        if not len(self.counts):
            asked[:] = False
            asked[owner[searched]] = True
        asked = np.flatnonzero(asked)
        at = np.zeros(len(contexts), np.int64)
        at[asked] = np.minimum(self.contexts.successor(contexts[asked]), self.contexts.n - 1)
        known = np.zeros(len(contexts), dtype=bool)
        known[asked] = self.contexts.access(at[asked]) == contexts[asked]
        if len(self.counts):
            count[known] = self.counts[at[known]]
        wanted = searched[known[owner[searched]]]
        if not len(wanted):
            return count, log, seen
        mine, back = np.unique(at[owner[wanted]], return_inverse=True)
        target = self.bases.access(mine)[back] + word[wanted]
        begin = self.begins.access(mine).astype(np.int64)
        end = np.where(mine + 1 < self.contexts.n, self.begins.access(np.minimum(mine + 1, self.contexts.n - 1)).astype(np.int64), self.successors.n)
        found = self.successors.successor(target)
        hit = (found >= begin[back]) & (found < end[back])
        hit[hit] = self.successors.access(found[hit]) == target[hit]
        spare = self.spare[mine].astype(np.float64)[back]
        log[wanted] = np.where(hit, self.levels[self.codes[np.minimum(found, len(self.codes) - 1)]], spare)
        seen[wanted] = hit
        return count, log, seen


def _merged(parts: list[tuple]) -> list[tuple]:
    context, word, earlier, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((earlier, word, context))
    context, word, earlier, count = context[order], word[order], earlier[order], count[order]
    first = _starts(context, word, earlier)
    return [(context[first], word[first], earlier[first], np.add.reduceat(count, first) if len(first) else count)]


_SENT = pa.schema([("task", pa.int32()), ("shard", pa.int32()), ("lot", pa.int64()), ("payload", pa.binary())])
_SCORED = pa.schema([("row", pa.int64()), ("context", pa.int64()), ("word", pa.int64()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])


def scores(docs: DataFrame, training: Column, order: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words (runs without ASCII white space, A-Z lower-cased) and one end. ``n_known`` are those that
    occur in the rows of ``training``; ``base_score`` is the sum of log10((c + 1) / (N + V + 1)), ``score`` the log10
    probability of the tries, of words and, at ``order`` 3, of pairs. A null or empty text is its end alone. Where nothing is trained on, every token has
    log10 1 = 0 in both. Every row comes back once, rows that repeat others with the same scores; a null doc_id stays
    null; an empty table gives no row; other columns aren't read.

    Word counts are exact by 64-bit hashes; the words of unseen n-grams are looked up by 48 bits, and successors of one
    context told apart by 40, the words before it by 31.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order} is neither 2 nor 3")
    rows = docs.select("doc_id", "text", training.alias("training"), F.xxhash64("doc_id", "text").alias("row"))
    light = materialize(rows.select("doc_id", "row"), "row-keys")
    counted = materialize(word_counts(rows.filter("training"), order), "word-counts")
    counts = counted.filter("not pair").select("word", "c")
    sizes = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, vocabulary = sizes["n"] or 0, sizes["v"]
    ends_row = counts.filter(F.col("word") == int(END.astype(np.int64))).first()
    ends = ends_row["c"] if ends_row else 0
    # bounded: as many contexts as there are half shards, or ``SPLIT_SHARE``
    most, most_pairs = Shards.is_frequent(tokens)
    frequent = {int(np.int64(r["word"]).astype(np.uint64)): r["c"] for r in counts.filter(F.col("c") > most).collect()}
    frequent.pop(int(END), None)
    if ends > most:
        frequent[int(BEGIN)] = ends
    pairs = [(int(np.int64(r["word"]).astype(np.uint64)), r["c"]) for r in counted.filter(F.col("pair") & (F.col("c") > most_pairs)).collect()]
    shards = Shards(tokens, list(frequent.items()), pairs, frozenset(frequent) - {int(BEGIN)} if order > 2 else frozenset())
    log_all = float(np.log10(tokens + vocabulary + 1))

    # bounded by what two bytes can tell; so rare a word isn't worth a place, and what is sorted is bounded too
    listed = Listed([int(np.int64(r["word"]).astype(np.uint64)) for r in counts.filter(F.col("c") * (16 * LISTED) > tokens).orderBy(F.desc("c"), "word").limit(LISTED).collect()] + [int(BEGIN)])
    per_task = max(1, min(TASK_SHARDS, shards.total // (2 * docs.sparkSession.sparkContext.defaultParallelism)))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def payloads():
            lot = TaskContext.get().partitionId() << 32
            source = ((word_hashes(text), (row, trained)) for row, text, trained in columns(batches, "row", "text", "training"))
            for group in _grouped(source):
                lot += 1
                row = np.array([r for _, (r, _) in group], dtype="<i8")
                trained = np.array([t for _, (_, t) in group], dtype=np.uint8)
                word, context, earlier, doc = _tokens(group, order)
                code = listed.codes(word)
                # the word before the context's: two back
                earlier_code = np.concatenate((code[:2], code[:-2]))[: len(code)]
                after_begin = np.flatnonzero(context == BEGIN) + 1
                earlier_code[after_begin[after_begin < len(code)]] = listed.codes(np.array([BEGIN]))[0]
                earlier_code[earlier == 0] = _NONE
                shard = shards(context, word, earlier)
                count = np.ones(len(word), np.uint32)
                by_shard = np.argsort(context)
                once = _once(word, context, earlier, doc)
                if once is not None:
                    by_shard, count[once[0]] = once
                by_shard = by_shard[np.argsort(shard[by_shard].astype(np.uint16 if shards.total <= 1 << 16 else np.int64), kind="stable")]
                in_order = [x[by_shard] for x in (context, word, code, earlier, earlier_code, doc, count)]
                shard = shard[by_shard]
                begins = _starts(shard)
                ends = np.append(begins[1:], len(shard))
                tasks = shard[begins] // per_task
                firsts = _starts(tasks)
                for one, end in zip(firsts.tolist(), np.append(firsts[1:], len(tasks)).tolist(), strict=True):
                    # the documents of a task, once for all of its shards
                    of_task = slice(begins[one], ends[end - 1])
                    present = np.zeros(len(row), dtype=bool)
                    present[in_order[5][of_task]] = True
                    in_order[5][of_task] = (np.cumsum(present) - 1)[in_order[5][of_task]]
                    yield int(tasks[one]), -1, lot, row[present].tobytes() + trained[present].tobytes()
                    for k in range(one, end):
                        mine = slice(begins[k], ends[k])
                        yield int(tasks[one]), int(shard[begins[k]]), lot, _pack(*(x[mine] for x in in_order))

        yield from batched(payloads(), _SENT, most=64, weight=lambda r: len(r[3]), most_weight=8 << 20)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results():
            for _, of_task in groupby(columns(batches, "task", "shard", "lot", "payload"), key=lambda r: r[0]):
                lots, n_rows, rows_, trained_, sums = {}, 0, [], [], None
                for shard, of_shard in groupby(of_task, key=lambda r: r[1]):
                    if shard < 0:
                        for _, _, lot, payload in of_shard:
                            n = len(payload) // 9
                            lots[lot], n_rows = n_rows, n_rows + n
                            rows_.append(np.frombuffer(payload, "<i8", n))
                            trained_.append(np.frombuffer(payload, np.uint8, n, 8 * n))
                        row, trained = np.concatenate(rows_), np.concatenate(trained_).astype(bool)
                        sums = [np.zeros(n_rows, t) for t in (np.int64, np.int64, np.float64, np.float64)]
                    else:
                        yield from answered(shard, ((lots[lot], payload) for _, _, lot, payload in of_shard), row, trained, sums)
                if sums is not None:
                    yield from table(row, None, None, *sums)

        def answered(shard, payloads, row, trained, sums):
            parts, pending, learned, block, spool = [], 0, [], None, None
            for offset, payload in payloads:
                context, word, earlier, doc, count = _unpack(payload, listed)
                parts.append((context, word, earlier, doc.astype(np.int32) + np.int32(offset), count))
                pending += len(doc)
                if pending >= BLOCK:
                    block, parts, pending = Block(parts, trained), [], 0
                    spool = spool or tempfile.TemporaryFile()
                    pickle.dump(block, spool, protocol=5)
                    learned.append(block.learned())
                    if len(learned) > 1:
                        learned = _merged(learned)
            if spool is None:  # one block: what it has taught is in the trie in its own order
                block, parts = Block(parts, trained), []
                context, word, earlier, count = block.learned()
            else:
                if parts:
                    block, parts = Block(parts, trained), []
                    pickle.dump(block, spool, protocol=5)
                    learned.append(block.learned())
                context, word, earlier, count = _merged(learned)[0]
                learned.clear()
            split, by_pair = shards.split(shard)
            # the pairs' level; then the words', unless it's in other shards too
            if spool is None:
                by = block.paired[block.taught[block.paired] > 0]
                pair, of_pair, by_count = block.pair[block.taught[block.paired] > 0], block.relative[by], block.taught[by]
            else:
                has_pair = np.flatnonzero(earlier > 0)
                pair = pairs_of(context[has_pair], earlier[has_pair])
                by = np.lexsort((word[has_pair], pair))
                pair, of_pair, by_count = pair[by], word[has_pair][by], count[has_pair][by]
            upper = built(pair, of_pair, by_count, split is None or not by_pair, counted=False)
            del pair, of_pair, by_count, by, earlier
            first = _starts(context, word)
            context, word, count = context[first], word[first], np.add.reduceat(count, first) if len(first) else count
            if split is not None:  # T and C of this part
                yield from table([0], split, None, np.array([len(word)]), np.array([count.sum()]), None, None, of_rows=False)
            if by_pair:
                yield from table(word, context, word, count, None, None, None, of_rows=False)
                context, word, count = context[:0], word[:0], count[:0]
            lower = built(context, word, count, split is None)
            del context, word, count
            tries = [Trie(np.memmap(x, dtype=np.uint8, mode="r")) for x in (upper, lower)]
            if spool is None:
                yield from asked(split, by_pair, *tries, block, row, sums, keeps_places=True)
            else:
                size, _ = spool.tell(), spool.seek(0)
                del block
                while spool.tell() < size:
                    yield from asked(split, by_pair, *tries, pickle.load(spool), row, sums, keeps_places=False)  # noqa: S301
                spool.close()
            for x in (upper, lower):
                x.close()

        def built(context, word, count, whole, counted=True):
            levels = tempfile.TemporaryFile()
            levels.write(Trie.build(context, word, count, whole, counted))
            levels.flush()
            return levels

        def asked(split, by_pair, upper, lower, block, row, sums, keeps_places):
            ones, twos = _starts(block.context), _starts(block.context, block.relative)
            of_context = np.repeat(np.arange(len(ones)), np.diff(np.append(ones, len(block.context))))
            of_word = np.repeat(np.arange(len(twos)), np.diff(np.append(twos, len(block.context))))
            contexts, runs = block.context[ones], np.diff(np.append(np.searchsorted(twos, ones), len(twos)))
            learned = np.add.reduceat(block.taught, twos) > 0
            place = np.where(learned, np.cumsum(learned) - 1, -1) if keeps_places and not by_pair else None
            c, log, seen = lower.find(contexts, runs, block.relative[twos], place)
            if split is not None or by_pair:
                c, log = np.array([frequent[x] for x in contexts.tolist()], dtype=np.int64), np.where(seen, log, 0.0)
            log, seen = log[of_word], seen[of_word]
            # pairs first; what they haven't seen is left to the words
            if len(block.paired):
                first = _starts(block.pair)
                learned = block.taught[block.paired] > 0
                place = np.where(learned, np.cumsum(learned) - 1, -1) if keeps_places else None
                _, upper_log, upper_seen = upper.find(block.pair[first], np.diff(np.append(first, len(block.pair))), block.relative[block.paired], place)
                if split is not None and by_pair:
                    upper_log = np.where(upper_seen, upper_log, 0.0)
                log[block.paired] = np.where(upper_seen, upper_log, upper_log + log[block.paired])
                seen[block.paired] |= upper_seen
            is_word = contexts != BEGIN
            counts_of = lambda weights: np.bincount(block.doc, weights, len(row))
            n = counts_of(block.count).astype(np.int64)
            sums[0] += n
            sums[1] += counts_of(block.count * (is_word & (c > 0))[of_context][block.place]).astype(np.int64)
            sums[2] += counts_of(block.count * (is_word * np.log10(c + 1.0))[of_context][block.place])
            sums[3] += counts_of(block.count * log[block.place])
            if split is not None:
                met = counts_of(block.count * seen[block.place]).astype(np.int64)
                here = np.flatnonzero(n)
                yield from table(row[here], split, None, (n - met)[here], met[here], None, None)
            new = np.flatnonzero(~seen[block.place])
            if len(new):  # the unigrams of unseen n-grams, still to be looked up, after the successors that other shards hold too
                place = block.place[new]
                yield from table(row[block.doc[new]], block.context[place] if by_pair else None, block.word[place], block.count[new], None, None, None)

        def table(row, context, word, n, known, base, score, of_rows=True):
            for at in range(0, len(row), 1 << 15):
                part = slice(at, at + (1 << 15))
                size = len(row[part])
                held = np.broadcast_to(np.asarray(context, np.uint64), len(row)) if context is not None else None
                yield pa.RecordBatch.from_arrays([
                    pa.array(x[part].astype(f.type.to_pandas_dtype())) if x is not None else pa.nulls(size, f.type)
                    for x, f in zip((row if of_rows else None, held, word, n, known, base, score), _SCORED, strict=True)], schema=_SCORED)

        yield from results()

    ddl = "row bigint, context bigint, word bigint, n bigint, known bigint, base double, score double"
    payloads = rows.select("row", "text", "training").mapInArrow(sent, "task int, shard int, lot bigint, payload binary")
    dealt = payloads.repartitionById(-(-shards.total // per_task), "task").sortWithinPartitions("task", "shard")
    found = materialize(dealt.mapInArrow(scored, ddl), "ngrams")
    # as few as split contexts
    whole = found.filter("row is null and word is null").groupBy("context").agg(F.log10(F.sum("known")).alias("c"), F.log10(DISCOUNT * F.sum("n")).alias("t"))
    after = found.filter("row is not null and context is not null and word is null").join(F.broadcast(whole), "context")
    after = after.select("row", *[F.lit(0).cast(t).alias(x) for x, t in (("n", "long"), ("known", "long"), ("base", "double"))], (
        F.col("n") * F.least(F.lit(0.0), F.col("t") - F.col("c")) - F.col("known") * F.col("c")).alias("score"))
    sums = found.filter("row is not null and context is null and word is null").select(after.columns).unionByName(after)
    parts = sums.groupBy("row").agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.sum("base").alias("base"), F.sum("score").alias("score"))
    short = counts.groupBy(F.col("word").bitwiseAND(int(_PART)).alias("word")).agg(F.sum("c").alias("c"))
    unseen = found.filter("row is not null and context is null and word is not null").select("row", "word", "n", F.lit(0.0).alias("spare"))
    if shards.by_pair.any():
        relative = F.col("word").bitwiseAND(int(_RELATIVE)).alias("relative")
        after = found.filter("row is null and word is not null").groupBy("context", relative).agg(F.sum("n").alias("c"))
        # as few as split contexts
        spare = after.groupBy("context").agg(F.sum("c").alias("all"), F.least(F.lit(0.0), F.log10(DISCOUNT * F.count("*") / F.sum("c"))).alias("spare"))
        wanted = found.filter("row is not null and context is not null and word is not null").select("row", "context", "word", relative, "n")
        wanted = wanted.join(after, ["context", "relative"], "left").join(F.broadcast(spare), "context", "left")
        # a word that was seen after the context has its probability, and no unigram
        unseen = unseen.unionByName(wanted.select(
            "row", F.when(F.col("c").isNull(), F.col("word")).alias("word"), "n",
            F.when(F.col("c").isNull(), F.coalesce("spare", F.lit(0.0))).otherwise(F.log10((F.col("c") - DISCOUNT) / F.col("all"))).alias("spare")))
    settled = unseen.filter("word is null").select("row", (F.col("n") * F.col("spare")).alias("unigram"))
    unseen = unseen.filter("word is not null").withColumn("short", F.col("word").bitwiseAND(int(_PART))).join(short.withColumnRenamed("word", "short"), "short", "left")
    unseen = unseen.select("row", (F.col("n") * (F.col("spare") + F.log10(F.coalesce("c", F.lit(0)) + 1) - log_all)).alias("unigram"))
    unseen = unseen.unionByName(settled).groupBy("row").agg(F.sum("unigram").alias("unigrams"))
    # rows that repeat a document have sent its n-grams as often
    copies = light.groupBy("row").agg(F.count("*").alias("copies"))
    sums = parts.join(unseen, "row", "left").join(copies, "row").select("row", *[
        (F.col(x) / F.col("copies")).alias(x) for x in ("n", "known", "base", "score")],
        (F.coalesce("unigrams", F.lit(0.0)) / F.col("copies")).alias("unigrams"))
    end = float(np.log10(ends + 1.0))
    return light.join(sums, "row").select(
        "doc_id", F.col("n").cast("long").alias("n_tokens"), (F.col("known") + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + end - F.col("n") * log_all).alias("base_score"), (F.col("score") + F.col("unigrams")).alias("score"))
