"""Language ID by compression: the language whose dictionary makes a text smallest.

Each language has a zstandard raw-content dictionary made of training text. A text, lower-cased and with its letters
only, is cut into blocks, each block is compressed with every dictionary, and the sizes are added up, so that the
dictionary counts in all of a long text and not at its start alone. Where the smallest two sizes are close, the
prediction is marked as rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from siftline.llm.common import frugal, map_rows, slices

UNDETERMINED = "und"
#: Bounds of what is learned from: different texts of each language, and the bytes of all languages' texts.
SAMPLE_ROWS, SAMPLE_BYTES = 32, 32 << 20
#: A dictionary's content must have so many bytes; a language with less text has it repeated.
LEAST_BYTES = 8
BLOCK, LEVEL = 4096, 6
#: Relative difference of the two smallest sizes below which a prediction is rejected.
MIN_MARGIN = 0.01
_TEMPERATURE = 0.05
#: Follows every block, so that the library doesn't store a short one as it is, in the same size under all dictionaries.
_FILLER = bytes(64)
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> str:
    """The words of letters, lower-cased; empty if there is no letter."""
    out = " ".join(_WORD.findall((text or "").lower()))
    return out if any(map(str.isalpha, out)) else ""


class Dictionaries:
    """Sizes of a text under the dictionary of each language; ties go to the language named first."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = list(samples)
        self.by = []
        for sample in samples.values():
            d = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (its share of a softmax over relative sizes), margin."""
        data = letters(text).encode()
        if not data or not self.by:
            return UNDETERMINED, 0.0, 0.0
        blocks = [data[i : i + BLOCK] + _FILLER for i in range(0, len(data), BLOCK)]
        sizes = [sum([len(c.compress(b)) for b in blocks]) for c in self.by]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        share = 1 / sum(math.exp((sizes[best] - s) / (_TEMPERATURE * sizes[best])) for s in sizes)
        second = min((s for i, s in enumerate(sizes) if i != best), default=None)
        return self.languages[best], share, 1.0 if second is None else (second - sizes[best]) / second


def learn(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> dict[str, bytes]:
    """A dictionary's content for each non-null lang of docs, the language with most different texts first.

    Only lang and text are read, and only texts with a letter count, each once, however often its row repeats. At most
    SAMPLE_ROWS texts of each language are taken, chosen by their hash: the same ones whatever the order. The languages
    have equal shares of ``sample_bytes``, so what every task gets is bounded, whatever their number; texts of more than
    a text's share come last, the shortest first, and a language that has nothing else is learned from one of them, as far
    as its share goes. A language without a letter can't be told and is left out.
    """
    known = docs.where("lang is not null").where(F.regexp_like("text", F.lit(r"\p{L}"))).select("lang", "text", F.xxhash64("text").alias("order"), F.md5("text").alias("_same"))
    counted = known.select("lang", "_same").distinct().groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counted:
        return {}
    # About twice the texts that are wanted pass the hash; only those are ranked, so no language meets in one task.
    share = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 2 * SAMPLE_ROWS / r["count"] + 50 / r["count"])) for r in counted], "lang string, share double")
    passed = (F.col("order").cast("double") / 2.0**64 + 0.5) <= F.col("share")
    some = known.join(F.broadcast(share), "lang").where(passed)
    once = some.groupBy("lang", "order", "_same").agg(F.min("text").alias("text"))
    size, most = F.octet_length("text").cast("long"), max(LEAST_BYTES, sample_bytes // len(counted))
    in_order = Window.partitionBy("lang").orderBy(F.when(size > most // SAMPLE_ROWS, size).otherwise(0), "order", "_same")
    ranked = once.withColumns({"rank": F.row_number().over(in_order), "upto": F.sum(size).over(in_order.rowsBetween(Window.unboundedPreceding, 0))})
    taken = (F.col("rank") == 1) | ((F.col("rank") <= SAMPLE_ROWS) & (F.col("upto") <= most))
    # letters are at most as many bytes as the text but for a few that have longer lower cases: the cut is by code points
    rows = ranked.where(taken).orderBy("lang", "rank").select("lang", F.substring("text", 1, min(most, 2**31 - 1)).alias("text")).collect()
    out = {r["lang"]: b"" for r in counted}
    for lang, text in rows:
        out[lang] += letters(text).encode()[:most] + b" "
    return {lang: sample * -(-LEAST_BYTES // len(sample)) for lang, sample in out.items() if sample.strip()}


def predict(docs: DataFrame, samples: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, margin, rejected per row of docs; only text is judged.

    lang_pred is the best learned language also where it is rejected; it is ``und``, rejected with score 0, for a text
    that is null or has no letter, or where no language was learned. Equal sizes: the language with more training rows,
    rejected as its margin is 0. Whole texts are read, of any length. Other columns of docs are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionaries = Dictionaries(samples)
        for part in (p for batch in batches for p in slices(batch)):
            langs, scores, margins = zip(*map(dictionaries.predict, part.column(1).to_pylist()), strict=True)
            rejected = [lang == UNDETERMINED or m < min_margin for lang, m in zip(langs, margins, strict=True)]
            arrays = [part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang_pred", "score", "margin", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(frugal(run), f"doc_id {kind}, lang_pred string, score double, margin double, rejected boolean")


def keep_identified(docs: DataFrame, samples: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of docs whose prediction is not rejected, all columns as they were.

    A null text, an empty one and one without a letter are rejected; ties have no margin and are rejected. Rows that
    repeat are judged alike. An empty table gives no rows, and where no language was learned none stay.
    """
    at = docs.columns.index("text")
    state: dict[str, Dictionaries] = {}

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state["by"] = Dictionaries(samples)
        keep = [lang != UNDETERMINED and margin >= min_margin for lang, _, margin in map(state["by"].predict, batch.column(at).to_pylist())]
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_rows(docs, docs.schema, each)
