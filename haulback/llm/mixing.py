"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key and is range-sorted within its source: key ranges are dealt out as buckets, the
bucket totals of a source are summed up in order, and the documents of one bucket are summed up behind them. Each
source is cut at its exact budget of words; a budget above the source's size repeats the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What ends words: the six ASCII white-space characters.
SPACES = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
#: Documents that share a key range, about, over all sources.
BUCKET_ROWS = 2_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: its share by weight, at most ``most`` times its size.

    Sources by code point, null last, weigh ``weights``, repeating. What a source can't take is shared again by weight
    among the others, until none is above its bound: the bounded are those first by bound per weight, so one pass over
    the sources in that order finds them. One row per source; sources of no words get 0.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighed = sources.select("source", "source_size", weight.cast("long").alias("weight"), (most * F.col("source_size")).alias("bound"))
    order = Window.orderBy((F.col("bound") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = weighed.select(
        "*",
        F.sum("source_size").over(whole).alias("all_size"),
        F.coalesce(F.sum("bound").over(before), F.lit(0)).alias("bound_before"),
        F.sum("weight").over(from_here).alias("weight_from"),
    )
    # words per unit of weight if this source and all after it were unbounded
    level = (F.lit(share) * F.col("all_size") - F.col("bound_before")) / F.col("weight_from")
    levels = levels.select("*", level.alias("level"), (F.col("bound") / F.col("weight") <= level).alias("bounded"))
    common = F.min(F.when(~F.col("bounded"), F.col("level"))).over(whole)
    target = F.when(F.col("bounded"), F.col("bound").cast("double")).otherwise(common * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, carry: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken.

    ``size`` is the number of words (0 for null or empty texts), ``taken`` the words the mix takes of it, repeats
    counted: whole epochs of its source, then what the budget left over still covers in key order, so that the
    document at the cut is taken in part and the words of a source add up to its target rounded down. The key is the
    MD5 of doc_id (null: of the empty text), ties broken by doc_id and text, so reruns agree. A null source is a
    source of its own. An empty table gives no row. With ``carry`` the whole input row rides along as ``_row``;
    otherwise other columns aren't read, so their names never clash.
    """
    buckets = max(1, docs.count() // BUCKET_ROWS)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    text_key = F.coalesce(F.xxhash64("text"), F.lit(0))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), text_key.alias("text_key"),
                        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry else []))
    bucket = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / F.lit(2**32)).cast("long")
    sized = sized.withColumn("bucket", bucket)
    totals = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = totals.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    targets = source_targets(sources, share, most, weights).withColumnRenamed("source", "in_source")
    starts = totals.select(
        F.col("source").alias("in_source"), F.col("bucket").alias("in_bucket"),
        (F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("bucket_size")).alias("bucket_start"),
    )
    starts = starts.alias("s").join(targets.alias("t"), F.expr("s.in_source <=> t.in_source")).select(
        "s.in_source", "in_bucket", "bucket_start", "source_size", "target")
    in_order = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sized.withColumn("up_to", F.sum("size").over(in_order))
    placed = placed.join(starts, F.expr("source <=> in_source and bucket = in_bucket"))
    budget = F.floor("target").cast("long")
    left = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0)
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    before = F.col("bucket_start") + F.col("up_to") - F.col("size")
    part = F.least(F.col("size"), F.greatest(left - before, F.lit(0)))
    return placed.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"),
                         *(["_row"] if carry else []))


def mixed(docs: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: a document taken twice gives two rows.

    A document at its source's cut ends behind its last word taken, and its ``n_chars``, if that is a column, follows.
    Documents of which nothing is taken, those without words among them, are gone.
    """
    plan = mix_plan(docs, share, most, weights, carry=True).filter(F.col("taken") > 0)
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = plan.select("_row", "size", "taken", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size")).cast("int")
    text = F.col("_row.text")
    # all but the first words, after as many separators; one more where the text begins with white space
    leading = F.when(F.rlike(text, F.lit(f"^{SPACES}")), 1).otherwise(0)
    rest = F.element_at(F.split(text, f"{SPACES}+", words + leading + 1), -1)
    cut = F.rtrim(F.substr(text, F.lit(1), F.length(text) - F.length(rest)), F.lit(" \t\n\x0b\f\r"))
    rows = rows.select("_row", F.when(words == F.col("size"), text).otherwise(cut).alias("cut"))
    out = {c: F.col("_row").getField(c) for c in docs.columns} | {"text": F.col("cut")}
    if "n_chars" in out:
        out["n_chars"] = F.length("cut").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[out[c].alias(c) for c in docs.columns])


#: The contract's rows for DuckDB, worked out with one window per source.
ORACLE_SQL = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, md5(doc_id::varchar) as rand
    from documents),
weighed as (
    select source, sum(size)::bigint as source_size,
           case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight
    from sized group by source),
tried as (
    select *, 2 * source_size / weight::double as ratio, (1.5::double * sum(source_size) over ()
               - coalesce(sum(2 * source_size) over (order by 2 * source_size / weight::double, source nulls last rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (order by 2 * source_size / weight::double, source nulls last rows between current row and unbounded following) as per_weight
    from weighed),
targets as (
    select source, source_size, case when ratio <= per_weight then (2 * source_size)::double
        else (min(case when ratio > per_weight then per_weight end) over ()) * weight end as target
    from tried),
running as (
    select s.doc_id, s.size, t.source_size, t.target,
           sum(s.size) over (partition by s.source order by s.rand, s.doc_id rows between unbounded preceding and current row) - s.size as ahead
    from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (case when source_size = 0 then 0 else (floor(target)::bigint // source_size) * size
           + least(size, greatest(floor(target)::bigint % source_size - ahead, 0)) end)::bigint as taken
from running
"""
