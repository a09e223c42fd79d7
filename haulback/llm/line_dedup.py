"""Line dedup across documents, in DataFrame operations only.

Lines become 128-bit hashes. The hashes are pre-aggregated, then range-partitioned and sorted by hash and document,
so that the first holder of each hash streams past first. What comes back is, per document, a bitmap of the lines
to keep, compressed as the runs of dropped lines; texts move only when a bitmap is applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulback.session import materialize

WHITE_SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shorter keys are never dropped.
LEAST_CHARS = 10
#: Parts of a hot line's documents that are combined on their own first.
SALTS = 32


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE_SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_bitmaps(docs: DataFrame) -> DataFrame:
    """The lines each document loses: doc_id, text_hash, dropped (array of runs ``from``, ``to``), only where it loses some.

    A key held by at least two documents loses all its lines except in the smallest doc_id that holds it; a null
    doc_id counts as the largest. Rows that repeat a doc_id are one holder, each with a bitmap for its own text.
    """
    split = docs.select("doc_id", _text_hash(F.col("text")).alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = split.select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= LEAST_CHARS)
    lines = materialize(keyed.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")), "lines")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    holders = lines.groupBy("h1", "h2", salt.alias("salt")).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max(F.col("doc_id").isNull()).alias("unnamed"))
    # at most SALTS rows of any hash: the first in document order streams past, the others tell whether there is a second document
    ranged = holders.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.col("low").asc_nulls_last())
    by_hash = Window.partitionBy("h1", "h2").orderBy(F.col("low").asc_nulls_last())
    all_of_hash = by_hash.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = ranged.select(
        "h1", "h2", "low", F.row_number().over(by_hash).alias("nth"),
        F.max("high").over(all_of_hash).alias("last"), F.max("unnamed").over(all_of_hash).alias("unnamed"))
    repeated = firsts.filter((F.col("nth") == 1) & F.col("low").isNotNull() & ((F.col("last") > F.col("low")) | F.col("unnamed")))
    later = lines.join(repeated.select("h1", "h2", "low"), ["h1", "h2"]).filter(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("low")))
    dropped = later.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    starts = F.filter("at", lambda p, i: (i == 0) | (F.get("at", i - 1) < p - 1))
    ends = F.filter("at", lambda p, i: (i == F.size("at") - 1) | (F.get("at", i + 1) > p + 1))
    return dropped.select("doc_id", "text_hash", F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("from"), b.alias("to"))).alias("dropped"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` as struct ``row``, with n_lines (before), n_dropped and kept, the text without its dropped lines.

    A null or empty text is one empty line. An empty table gives no row. Every input row comes back once.
    """
    bitmaps = line_bitmaps(docs).select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "dropped")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("by_doc"), _text_hash(F.col("text")).alias("by_text"))
    met = rows.join(bitmaps, F.expr("by_doc <=> of_doc and by_text = of_text"), "left")
    lines = met.select("row", "dropped", _lines(F.col("row.text")).alias("lines"))
    gone = F.flatten(F.transform("dropped", lambda r: F.sequence(r["from"], r["to"])))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    return lines.select(
        "row", F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(kept, lambda p: F.get("lines", p)), "\n")).alias("kept"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as text, and ``n_chars``, if that is a column, to match."""
    out = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.when(F.col("row.text").isNotNull(), F.col("kept"))}
    if "n_chars" in out:
        out["n_chars"] = F.length(out["text"]).cast(docs.schema["n_chars"].dataType)
    return drop_lines(docs).select(*[out[c].alias(c) for c in docs.columns])


#: The contract's rows for DuckDB.
ORACLE_SQL = r"""
with lines as (
    select doc_id, u.pos, u.line, lower_az.key
    from documents,
         lateral (select unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos) u,
         lateral (select translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key) lower_az),
holders as (select key, min(doc_id) as first_doc from lines where length(key) >= 10 group by key having count(distinct doc_id) > 1),
judged as (
    select l.doc_id, l.pos, l.line, h.first_doc is not null and l.doc_id > h.first_doc as gone
    from lines l left join holders h on l.key = h.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""
