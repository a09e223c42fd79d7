"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

There is a tree for each length of word. Its upper part comes from a bounded sample and deals all words into boxes; a
word is asked for in every box that one edit of it can reach, of its own length and, with a letter less, of the length
below. In a task, a tree over the box's words prunes the searches, and the order of letters verifies what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.llm.kd_tree import PointTree, code_points, grow, home, letter_counts, one_deleted, one_replaced, reached
from haulback.llm.tables import columns
from haulback.session import materialize

#: Shorter and rarer words are left out.
LEAST_LETTERS, LEAST_OCCURRENCES = 6, 5
#: A form occurs at least this many times as often.
RATIO = 5
#: One of so many runs loses a character.
DAMAGED = 199
#: Words the upper trees are grown from, and words of a box, about; a box's words are held by one task in parts of at most four times as many, about.
SAMPLE_WORDS, BOX_WORDS = 50_000, 1024
#: Words asked for at a time.
ASKED = 4096

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def corpus_words(docs: DataFrame, damaged: int = DAMAGED) -> DataFrame:
    """(word, n) of the runs of letters in ``docs`` (doc_id, text), at least ``LEAST_OCCURRENCES`` times.

    Runs are lower-cased in A-Z only. Where ``damaged`` divides the CRC-32 h of ``<doc_id>:<run>``, the run loses its
    character number h mod its length; a null doc_id counts as empty text there. Null and empty texts have no runs.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).filter(F.length("run") >= LEAST_LETTERS)
    hashed = runs.withColumn("run", F.translate("run", UPPER, LOWER)).withColumn("h", F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_OCCURRENCES)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


class Boxes:
    """The upper trees by length, their boxes numbered on; ``parts`` of each box, by its words."""

    def __init__(self, sample: list[str], counts: dict[int, int]):
        self.leaves: list[float] = []
        self.trees = {}
        for length, at in _by_length(sample):
            own = letter_counts(code_points([sample[k] for k in at]))
            self.trees[length] = grow(own, counts[length], BOX_WORDS, self.leaves)
        self.parts = np.ones(len(self.leaves) + 1, dtype=np.int64)

    def tree(self, length: int):
        return self.trees.get(length, len(self.leaves))  # lengths that the sample missed share the last box


#: What a row is for: a word at home, asked for among words of its length, or among those shorter by one.
HELD, SAME, SHORTER = 0, 1, 2
_DEALT = pa.schema([("box", pa.int32()), ("part", pa.int32()), ("task", pa.int32()), ("own", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])
_DEALT_SQL = "box int, part int, task int, own boolean, word string, n bigint"


def _homes(words: DataFrame, boxes: Boxes) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            for length, at in _by_length(held):
                leaf = home(boxes.tree(length), letter_counts(code_points([held[k] for k in at])))
                yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32))], names=["box"])

    return words.select("word").mapInArrow(found, "box int")


def dealt(words: DataFrame, boxes: Boxes) -> DataFrame:
    """Each word once at home, in a part of its box, and once for each part of each box where it is asked for.

    Of one length it is asked for in its own box and those numbered above, so that two words meet once; ``own`` tells that
    it is asked for at home.
    """

    def rows(held: list[str]) -> Iterator[tuple]:
        for length, at in _by_length(held):
            counts = letter_counts(code_points([held[k] for k in at]))
            leaf = home(boxes.tree(length), counts)
            hashes = np.array([xxhash.xxh3_64_intdigest(held[k].encode()) >> 1 for k in at], dtype=np.int64)
            yield at, leaf, hashes % boxes.parts[leaf], HELD, False
            for box, some in reached(boxes.tree(length), counts, 1, 1):
                for own, mine in ((True, some[leaf[some] == box]), (False, some[leaf[some] < box])):
                    yield from ((at[mine], box, part, SAME, own) for part in range(boxes.parts[box]))
            if length > 1:
                for box, some in reached(boxes.tree(length - 1), counts, 0, 1):
                    yield from ((at[some], box, part, SHORTER, False) for part in range(boxes.parts[box]))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = batch.column(0).cast(pa.string()), batch.column(1)
            for at, box, part, task, own in rows(word.to_pylist()):
                if len(at):
                    picked, each = pa.array(at), np.ones(len(at), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array((box * each).astype(np.int32)), pa.array((part * each).astype(np.int32)), pa.array(task * each), pa.array(each * own == 1),
                        word.take(picked), n.take(picked)], schema=_DEALT)

    return words.select("word", "n").mapInArrow(spread, _DEALT_SQL)


class _Part:
    """The words of one part of a box, by length, and their trees."""

    def __init__(self, words: tuple[str, ...], n: tuple[int, ...]):
        self.words, self.n = np.array(words, dtype=object), np.array(n, dtype=np.int64)
        self.by_length = {}
        for length, at in _by_length(words):
            points = code_points([words[k] for k in at])
            self.by_length[length] = at, points, PointTree(letter_counts(points))

    def met(self, words: list[str], task: int, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs (row of ``words``, row here); of two words at home in one box only one order."""
        up, down, shorter = (1, 1, 0) if task == SAME else (0, 1, 1)
        for length, at in _by_length(words):
            if length - shorter not in self.by_length:
                continue
            rows, points, tree = self.by_length[length - shorter]
            asked = code_points([words[k] for k in at])
            for q, p in tree.near(letter_counts(asked), up, down):
                step = max(1, (1 << 22) // length)  # pairs compared at once
                for k in range(0, len(q), step):
                    some, others = q[k : k + step], p[k : k + step]
                    near = one_deleted(asked[some], points[others]) if shorter else one_replaced(asked[some], points[others])
                    mine, theirs = at[some[near]], rows[others[near]]
                    first = np.array([not o or words[a] < self.words[b] for o, a, b in zip(own[mine], mine, theirs, strict=True)], dtype=bool)
                    if first.any():
                        yield mine[first], theirs[first]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n): every two of ``words`` (word: distinct, not null; n) that differ by one inserted, deleted or replaced character, in both orders.

    The driver holds a sample of about ``SAMPLE_WORDS`` words, a number for each length and for each box grown from the sample.
    Tasks hold one part of a box; the words asked for stream past it.
    """
    spark = words.sparkSession
    counts = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    # by hash, so that no task sends more than its share
    share = min(1.0, SAMPLE_WORDS / max(1, sum(counts.values())))
    sample = [r["word"] for r in words.select("word").filter(F.pmod(F.xxhash64("word"), F.lit(1 << 40)) < int(share * (1 << 40))).collect()]
    boxes = Boxes(sample, counts)
    for r in _homes(words, boxes).groupBy("box").count().collect():
        boxes.parts[r["box"]] = -(-r["count"] // (4 * BOX_WORDS))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, part, asked = None, [], None, []

        def answers():
            nonlocal part
            if not asked or not held:
                return
            part = part or _Part(*zip(*held, strict=True))
            for task in (SAME, SHORTER):
                some = [(w, n, own) for w, n, own, t in asked if t == task]
                for q, p in part.met([w for w, _, _ in some], task, np.array([own for _, _, own in some], dtype=bool)) if some else ():
                    a, b = [some[k][0] for k in q], part.words[p].tolist()
                    n = np.concatenate([part.n[p], np.array([some[k][1] for k in q], dtype=np.int64)])
                    yield pa.RecordBatch.from_arrays([pa.array(a + b), pa.array(b + a), pa.array(n)], names=["word", "other", "other_n"])

        for box, at, task, own, word, n in columns(batches, "box", "part", "task", "own", "word", "n"):
            if (box, at) != place:
                yield from answers()
                place, held, part, asked = (box, at), [], None, []
            if task == HELD:
                held.append((word, n))
                continue
            asked.append((word, n, own, task))
            if len(asked) >= ASKED:
                yield from answers()
                asked = []
        yield from answers()

    shuffled = dealt(words, boxes).repartition(_partitions(spark, boxes), "box", "part").sortWithinPartitions("box", "part", "task")
    return shuffled.mapInArrow(searched, "word string, other string, other_n bigint")


def _partitions(spark, boxes: Boxes) -> int:
    """Partitions for the boxes: some twenty of them each, so that their sizes even out, and no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(boxes.parts.sum()) // 20)


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, form, form_n, root, n_near) for every row of ``words`` (word: distinct, not null; n).

    ``n_near`` counts the near words. ``form`` is the one that occurs most (of equals the smallest by code points), if that
    is at least ``ratio`` times as often as the word; ``root`` is where forms lead in the end, the word itself without a
    form. Words without letters are allowed; no words give no rows.
    """
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    met = words.join(best, "word", "left")
    has_form = -F.col("best.less") >= ratio * F.col("n")
    found = materialize(met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has_form, F.col("best.other")).alias("form"), F.when(has_form, -F.col("best.less")).alias("form_n")), "forms")
    # forms occur ever more often, so their chains end; each round doubles the steps behind a root
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        stepped = materialize(roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        roots = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            break
    return found.join(roots, "word", "left").select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """:func:`variants` of the words of ``docs`` (doc_id, text), see :func:`corpus_words`. An empty table gives no row."""
    return variants(materialize(corpus_words(docs), "words"))


#: The contract's rows for DuckDB; CRC-32 by its table, which its polynomial gives.
ORACLE_SQL = r"""
with crc_table as (
    select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as t
    from range(256) r(i)),
runs as (
    select doc_id, run, count(*) as n
    from (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents)
    where length(run) >= 6 group by doc_id, run),
bytes as (
    select doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
        lambda c: case when ord(c) < 128 then [ord(c)::bigint] else [(192 + ord(c) // 64)::bigint, (128 + ord(c) % 64)::bigint] end)) as b
    from runs),
hashed as (
    select run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) as h
    from bytes, crc_table),
cut as (
    select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed),
words as (select word, sum(n)::bigint as n from cut where length(word) >= 6 group by word having sum(n) >= 5),
less as (select word, n, p, substr(word, 1, p - 1) as head, substr(word, p + 1) as tail from words, lateral (select unnest(range(1, length(word) + 1)) as p)),
pairs as (
    select a.word, b.word as other, b.n as other_n from less a join less b using (p, head, tail) where a.word <> b.word
    union
    select a.word, w.word, w.n from less a join words w on w.word = a.head || a.tail
    union
    select w.word, a.word, a.n from less a join words w on w.word = a.head || a.tail),
best as (
    select word, count(*)::bigint as n_near, max(other_n) as most, min(struct_pack(less := -other_n, other := other)) as best
    from pairs group by word),
forms as (
    select word, n, coalesce(n_near, 0)::bigint as n_near,
           case when most >= 5 * n then best.other end as form, case when most >= 5 * n then most end as form_n
    from words left join best using (word)),
recursive_roots as (
    with recursive up(word, root) as (
        select word, coalesce(form, word) from forms
        union
        select u.word, f.form from up u join forms f on f.word = u.root where f.form is not null)
    select up.word, up.root from up join forms f on f.word = up.root where f.form is null)
select word, n, form, root, n_near, form_n from forms join recursive_roots using (word)
"""
