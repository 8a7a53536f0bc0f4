"""What was known of an event at the end of each run: sets that grow over runs, as of every one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def supporters_as_of(saves: DataFrame, key: str, run: str, seq: str, items: str) -> DataFrame:
    """Q16: key, run and ``items``: what all saves up to the run's last one of that key name, in order of their first mention.

    saves: key, run, seq (unique for a key), items (an array). An item's first mention is found once, by an aggregate that
    merges before the shuffle; a run then takes the items that were first mentioned by its end, so what is joined
    is what comes out. A run without items has none. Nulls among the items are left out.
    """
    ends = saves.groupBy(key, run).agg(F.max(seq).alias("_end"))
    named = saves.select(key, seq, F.posexplode(items).alias("_pos", "_item")).where("_item is not null")
    first = named.groupBy(key, "_item").agg(F.min(F.struct(seq, "_pos")).alias("_first"))
    met = ends.join(first, key).where(F.col(f"_first.{seq}") <= F.col("_end"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("_first", "_item"))), lambda x: x["_item"])
    found = met.groupBy(key, run).agg(in_order.alias("_items"))
    kind = saves.schema[items].dataType.simpleString()
    return ends.drop("_end").join(found, [key, run], "left").select(key, run, F.coalesce("_items", F.array().cast(kind)).alias(items))


def evidence_as_of(saves: DataFrame, key: str, run: str, seq: str, evidence: str, identity: list[str]) -> DataFrame:
    """Q16: key, run and ``evidence``: each piece by its ``identity`` once, as the last save up to the run's end has it, in order of first mention.

    saves: key, run, seq (unique for a key), evidence (an array of structs with the fields of ``identity``). Of pieces with one
    identity within a save the last counts. A piece holds from its save until the next save that has it, so a run's end falls
    into one such span of each piece, and the join gives what comes out and no older versions.
    """
    ends = saves.groupBy(key, run).agg(F.max(seq).alias("_end"))
    named = saves.select(key, seq, F.posexplode(evidence).alias("_pos", "_piece")).where("_piece is not null")
    named = named.withColumn("_id", F.struct(*[F.col(f"_piece.{f}") for f in identity]))
    said = named.groupBy(key, "_id", seq).agg(F.max_by("_piece", "_pos").alias("_piece"), F.min("_pos").alias("_pos"))
    history = Window.partitionBy(key, "_id").orderBy(seq)
    spans = said.withColumn("_until", F.lead(seq).over(history)).withColumn("_first", F.first(F.struct(seq, "_pos")).over(history))
    met = ends.join(spans, key).where((F.col(seq) <= F.col("_end")) & (F.col("_until").isNull() | (F.col("_until") > F.col("_end"))))
    rank = F.transform(F.array_sort(F.collect_list(F.struct("_first", "_piece"))), lambda x: x["_piece"])
    found = met.groupBy(key, run).agg(rank.alias("_found"))
    kind = saves.schema[evidence].dataType.simpleString()
    return ends.drop("_end").join(found, [key, run], "left").select(key, run, F.coalesce("_found", F.array().cast(kind)).alias(evidence))
