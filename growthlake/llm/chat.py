"""Chat formatting by perspective rotation: each participant once as the assistant.

For every participant of a conversation the dialogue is rendered with that
speaker as assistant, the others as named users, system turns as they are, and
a mask that trains on the assistant's words (and its end mark) only.

A conversation is gathered in parts of ``PART_TURNS`` turn numbers, after equal
rows have been merged. A part with more rows than that (many rows of a turn
number, or without one) is cut further by rank, into rows of the same part
number and of ``PART_TURNS`` turns at most, so one row never holds an unbounded
conversation. Rows carry the characters before them, and a reader who joins
them in order of part and start has the whole. Ranks come from ranges of all
columns, counted and added up, so no task gets a hot conversation.

Cases: a null role is the participant "unknown"; null text is empty; turns are
ordered by number, then role and text; equal rows count once; rows without a
conversation id form one conversation; a null turn comes first; a conversation
of system turns alone has no participant and gives no row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.llm.common import stored

PART_TURNS = 1024
SYSTEM = "system"
UNKNOWN = "unknown"


def segment(speaker: Column, me: Column, text: Column) -> Column:
    """One turn as the perspective shows it, header, text and end mark."""
    header = F.when(speaker == SYSTEM, F.lit("system")).when(speaker == me, F.lit("assistant")).otherwise(
        F.concat(F.lit("user name="), speaker))
    return F.concat(F.lit("<|"), header, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, perspective, part, n_turns, start, rendered, spans, n_trained.

    ``spans`` lists the trained stretches as start:end in characters of
    ``rendered``, comma-joined: the text and end mark of each turn of the
    perspective. ``start`` is the number of characters in earlier rows.
    """
    turn = F.col("turn").cast("long")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.floor(turn / part_turns), F.lit(-1)).cast("long").alias("part"))
    # counted before equal rows are merged: columns are few here, and a part too many only takes the longer way
    large = stored(
        rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_turns)
        .select(F.col("conv_id").alias("of"), F.col("part").alias("of_part")), "large")
    rows = rows.distinct()
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    if large.isEmpty():
        return _with_starts(_rendered(rows.withColumn("piece", F.lit(0).cast("long")), rows)).drop("piece")
    rest = rows.join(large, same, "left_anti").withColumn("piece", F.lit(0).cast("long"))
    rendered = stored(_rendered(rest.unionByName(_pieces(rows.join(large, same, "left_semi"), part_turns)), rows), "rendered")
    # lengths alone meet in one place, not the texts of a hot conversation
    key = ["conv_id", "perspective", "part", "piece"]
    starts = _with_starts(rendered.select(*key, "chars")).select(*[F.col(c).alias(f"of_{c}") for c in key], "start")
    found = rendered.join(starts, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in key)))
    return found.select(*[c for c in rendered.columns if c not in ("chars", "piece")], "start")


def _pieces(rows: DataFrame, part_turns: int) -> DataFrame:
    """The rows with ``piece``, their rank within conversation and part over ``part_turns``."""
    order = ["conv_id", "part", "turn", "role", "text"]
    ranges = stored(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("conv_id", "part", "range").orderBy("turn", "role", "text")
    before = Window.partitionBy("of", "of_part").orderBy("of_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range and part
    offsets = (
        ranges.groupBy(F.col("conv_id").alias("of"), F.col("part").alias("of_part"), F.col("range").alias("of_range"))
        .agg(F.count(F.lit(1)).alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))))
    ranked = ranges.withColumn("rank", F.row_number().over(within) - 1).join(
        offsets, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
        & (F.col("range") == F.col("of_range")))
    return ranked.select(*rows.columns, F.floor((F.col("rank") + F.col("offset")) / part_turns).cast("long").alias("piece"))


def _rendered(pieces: DataFrame, rows: DataFrame) -> DataFrame:
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("role").alias("perspective")).distinct()
    parts = pieces.groupBy("conv_id", "part", "piece").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), "role", "text"))).alias("turns"))
    each = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    me = F.col("perspective")
    rendered = each.withColumn("segments", F.transform("turns", lambda t: F.struct(
        segment(t["role"], me, t["text"]).alias("text"), (t["role"] == me).alias("mine"),
        (F.length(t["text"]) + len("<|end|>")).alias("trained"))))
    # where each own turn's text starts and ends, from the lengths before it
    spans = F.aggregate(
        "segments",
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("found")),
        lambda done, s: F.struct(
            (done["at"] + F.length(s["text"])).alias("at"),
            (done["n"] + F.when(s["mine"], s["trained"]).otherwise(0)).alias("n"),
            F.when(s["mine"], F.concat(done["found"], F.array(F.concat_ws(
                ":", done["at"] + F.length(s["text"]) - s["trained"] - 1, done["at"] + F.length(s["text"]) - 1))))
            .otherwise(done["found"]).alias("found")))
    return rendered.withColumn("mask", spans).select(
        "conv_id", "perspective", "part", "piece", F.size("segments").cast("long").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("rendered"),
        F.array_join("mask.found", ",").alias("spans"), F.col("mask.n").cast("long").alias("n_trained"),
        F.col("mask.at").cast("long").alias("chars"))


def _with_starts(masked: DataFrame) -> DataFrame:
    before = Window.partitionBy("conv_id", "perspective").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return masked.withColumn("start", F.coalesce(F.sum("chars").over(before), F.lit(0))).drop("chars")
