"""State logs: current state, history, retries and what a rerun still has to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.functions import fixed


def state_latest(log: DataFrame, key: str, at: str = "at", seq: str = "seq") -> DataFrame:
    return log.groupBy(key).agg(F.max_by("state", F.struct(at, seq)).alias("state"), F.min(at).alias("created_at"), F.max(at).alias("updated_at"))


def state_history(log: DataFrame, key: str, at: str = "at", seq: str = "seq") -> DataFrame:
    return log.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(at, seq, "state"))), lambda x: x["state"]).alias("history"))


def retry_ceiling(failures: DataFrame, key: str, ceiling: int = fixed.MAX_RETRIES) -> DataFrame:
    """failures so far, and whether they reject the entity."""
    counts = failures.groupBy(key).agg(F.count("*").alias("failures"))
    return counts.withColumn("state", F.when(F.col("failures") >= ceiling, "REJECTED").otherwise("RETRY"))


def pending(entities: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """Entities that no terminal state has ended."""
    return entities.join(states.where(F.col("state").isin(*fixed.TERMINAL_STATES)).select(key).distinct(), key, "left_anti")


def append_transitions(log: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The log with new transitions (key, at, state, note) after it. An entity that neither has seen before starts with a row
    DISCOVERED at the time of its first transition. seq numbers the rows of an entity that share a time: the start first."""
    first = new.groupBy(key).agg(F.min("at").alias("at")).join(log.select(key).distinct(), key, "left_anti")
    start = first.select(key, "at", F.lit("DISCOVERED").alias("state"), F.lit(None).cast("string").alias("note"), F.lit(-1).cast("long").alias("seq"))
    last = log.groupBy(key).agg(F.max("seq").alias("__last"))
    order = F.row_number().over(W.partitionBy(key).orderBy("at", stage_rank(F.col("state")), "state", "note"))
    numbered = new.join(last, key, "left").withColumn("seq", (F.coalesce("__last", F.lit(-1)) + order).cast("long")).select(key, "at", "state", "note", "seq")
    return log.select(key, "at", "state", "note", "seq").unionByName(start).unionByName(numbered)


def stage_rank(state) -> Column:
    """The place of a state in the order of stages; review and rejection are past every stage."""
    chain = F.when(state.isin("NEEDS_REVIEW", "REJECTED"), 999)
    for i, s in enumerate(fixed.STAGES):
        chain = chain.when(state == s, i)
    return chain.otherwise(0)


def past_stage(df: DataFrame, stage: str, state: str = "state") -> DataFrame:
    """Rows that have reached a stage."""
    return df.where(stage_rank(F.col(state)) >= fixed.STAGES.index(stage))
