"""Language identification by compression.

Each language gets a zstandard dictionary of raw text from labelled documents. Of texts and dictionaries only the
words count, runs of letters in lower case. A text is compressed with every dictionary, slice by slice, so that what the text itself has taught the compressor never outweighs the dictionary,
and the language of the smallest total wins. A narrow margin to the second rejects the verdict.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.llm.tables import batched, columns

#: Labelled rows that a language's dictionary is made of, about, and bytes that each gives at most.
SAMPLE_ROWS = 160
SAMPLE_BYTES = 1024
#: Characters compressed at once, of each text from its start to its end.
SLICE = 2048
LEVEL = 9
#: A verdict is rejected if the second language needs less than so much more than the first, as a share of the first.
LEAST_MARGIN = 0.002
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def plain_words(text: str) -> str:
    return " ".join(_LETTERS.findall(text.lower()))


def train_dictionaries(labelled: DataFrame) -> dict[str, bytes]:
    """Raw-content dictionaries by language from rows (doc_id, text, lang), those without lang or letters left out.

    The rows of a language are thinned by a hash of doc_id and text to ``SAMPLE_ROWS`` on average, and each gives
    ``SAMPLE_BYTES`` characters from its middle: the driver gets a bounded amount per language, whatever the input.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.rlike(F.col("text"), F.lit("\\p{L}")))
    unit = F.pmod(F.xxhash64("doc_id", "text", F.lit("dictionary")), F.lit(1 << 40)) / F.lit(1 << 40)
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, SAMPLE_ROWS / n))).otherwise(share)
    begin = F.greatest(F.lit(1), F.floor((F.length("text") - SAMPLE_BYTES) / 2).cast("int"))
    chosen = usable.filter(unit < share).select("lang", "doc_id", unit.alias("unit"), F.substr(F.col("text"), begin, F.lit(SAMPLE_BYTES)).alias("part"))
    parts: dict[str, list[str]] = {lang: [] for lang in sorted(counts)}
    for row in chosen.orderBy("lang", "unit", "doc_id", "part").collect():
        parts[row["lang"]].append(row["part"])
    return {lang: plain_words("\n".join(p[: 2 * SAMPLE_ROWS])).encode() for lang, p in parts.items()}


class Compressors:
    """The compressors of one Python task."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.by_language = {}
        for lang, content in sorted(dictionaries.items()):
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=LEVEL)
            self.by_language[lang] = zstandard.ZstdCompressor(dict_data=made, level=LEVEL, write_checksum=False, write_content_size=False)

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin: 1 - best/second and second/best - 1; ``und`` where there's no letter."""
        text = plain_words(text or "")
        if not any(map(str.isalpha, text)) or not self.by_language:  # a superscript isn't a letter
            return UNDETERMINED, 0.0, 0.0
        slices = [text[at : at + SLICE].encode() for at in range(0, len(text), SLICE)]
        sizes = sorted((sum(len(c.compress(s)) for s in slices), lang) for lang, c in self.by_language.items())
        if len(sizes) == 1:
            return sizes[0][1], 1.0, 1.0
        (best, lang), (second, _) = sizes[:2]
        return lang, 1.0 - best / second, second / best - 1.0


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, margin, rejected.

    ``lang_pred`` is ``und`` for texts that are null, empty or without a letter, and where nothing was learned; those
    are rejected, as are verdicts with a margin under ``LEAST_MARGIN``. Equal sizes go to the language first by name.
    Every row comes back once; only doc_id and text are read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64())])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(dictionaries)
        yield from batched(((doc_id, *compressors(text)) for doc_id, text in columns(batches, "doc_id", "text")), schema)

    found = docs.select("doc_id", "text").mapInArrow(predicted, "doc_id bigint, lang_pred string, score double, margin double")
    return found.withColumn("rejected", (F.col("lang_pred") == UNDETERMINED) | (F.col("margin") < LEAST_MARGIN))


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs`` whose language isn't rejected, all columns as they were."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(dictionaries)
        for batch in batches:
            found = [compressors(x.as_py()) for x in batch.column(batch.schema.get_field_index("text"))]
            yield batch.filter(pa.array([lang != UNDETERMINED and margin >= LEAST_MARGIN for lang, _, margin in found], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def held_out(doc_id: Column) -> Column:
    """The documents nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
