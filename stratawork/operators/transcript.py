"""Transcripts: speaker labels, word markers, spoken blocks and the document of a recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratawork.operators.windows import gap_blocks

UNKNOWN = "Unknown"


def marked_word(word: Column, confidence: Column, inaudible: float = 0.2, phonetic: float = 0.5) -> Column:
    """A word as it is rendered: bracketed ones as they are, [inaudible] and [phonetic: word] up to their confidences."""
    if inaudible > phonetic:
        raise ValueError("the threshold of inaudible words is above that of phonetic ones")
    bracketed = word.startswith("[") & word.endswith("]")
    return F.when(bracketed, word).when(confidence <= inaudible, "[inaudible]").when(confidence <= phonetic, F.concat(F.lit("[phonetic: "), word, F.lit("]"))).otherwise(word)


def named(words: DataFrame, label: str, labels: DataFrame, name: str = "speaker") -> DataFrame:
    """``words`` with the name of their label, by a lookup of (label, name); Unknown without one."""
    known = labels.groupBy(F.col(label).alias("__l")).agg(F.min(name).alias("__n"))
    return words.join(known, words[label] == F.col("__l"), "left").withColumn(name, F.coalesce("__n", F.lit(UNKNOWN))).drop("__l", "__n")


def blocks(words: DataFrame, by: str, order: str, speaker: str, start: str, end: str, text: str, overlap: str, gap: float) -> DataFrame:
    """(by, block, speaker, started, reason, text): the words of each turn in order.

    A turn ends where the speaker changes or a pause reaches ``gap``; one that
    the same speaker goes on after a pause ends with [pause], one with
    overlapping words starts with [crosstalk].
    """
    cut = gap_blocks(words, [by], [order], speaker, F.col(start) - F.col(f"__prev.{end}"), gap)
    said = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("w")))), lambda x: x["w"])  # a turn's own words
    b = cut.groupBy(by, "block").agg(F.min_by(speaker, order).alias(speaker), F.min(start).alias("started"), F.min_by("reason", order).alias("reason"), said.alias("said"), F.max(F.col(overlap).cast("int")).alias("over"))
    w = W.partitionBy(by).orderBy("block")
    goes_on = (F.lead("reason").over(w) == "pause") & (F.lead(speaker).over(w) == F.col(speaker))
    b = b.withColumn("__p", F.coalesce(goes_on, F.lit(False)))
    line = F.array_join(F.when(F.col("__p"), F.concat("said", F.array(F.lit("[pause]")))).otherwise(F.col("said")), " ")
    return b.select(by, "block", speaker, "started", "reason", F.concat(F.when(F.col("over") == 1, "[crosstalk] ").otherwise(""), line).alias("text"))


def speakers(words: DataFrame, by: str, label: str, speaker: str) -> DataFrame:
    """(by, identified, unknown): the sorted names of a recording's labels, and how many labels have none."""
    each = words.select(by, label, speaker).distinct()
    known = F.array_sort(F.collect_set(F.when(F.col(speaker) != UNKNOWN, F.col(speaker))))
    return each.groupBy(by).agg(known.alias("identified"), F.count_if(F.col(speaker) == UNKNOWN).alias("unknown"))


def documents(words: DataFrame, by: str, order: str, label: str, speaker: str, start_ms: str, end_ms: str, text: str, confidence: str, overlap: str) -> DataFrame:
    """(by, document): a recording as JSON with its duration, speakers and words, times to a thousandth of a second, confidence to four places."""
    seconds = lambda c: F.round(F.col(c) / 1000, 3)
    word = F.struct(
        F.col(order).alias("o"),
        F.struct(F.col(text).alias("word"), seconds(start_ms).alias("start"), seconds(end_ms).alias("end"), F.col(speaker).alias("speaker"), F.round(confidence, 4).alias("confidence"), F.col(overlap).alias("overlap")).alias("w"),
    )
    g = words.groupBy(by).agg(F.round(F.max(end_ms) / 1000, 3).alias("duration_seconds"), F.transform(F.array_sort(F.collect_list(word)), lambda x: x["w"]).alias("words"))
    j = g.join(speakers(words, by, label, speaker), by)
    return j.select(by, F.to_json(F.struct(F.col(by).cast("string").alias("file"), "duration_seconds", F.col("identified").alias("speakers_identified"), F.col("unknown").alias("speakers_unknown"), "words")).alias("document"))
