"""Rule and cached-file enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..plans.skew import CHUNK, attach_prefix, chunk_prefix, split_hot_keys

# Fixed values of the keyword-masking job: replacement text and the prefix
# of every emitted message ("message received downstream: ").
MASK = "***"
MESSAGE_PREFIX = "下游接收的消息为："


def latest_rule_asof(messages: DataFrame, rules: DataFrame, ts: str, rule_col: str,
                     default: str | None = None, tiebreak: str | None = None,
                     rows_per_chunk: int | None = None) -> DataFrame:
    """Attach to every message the latest rule with ``rule.ts <= msg.ts``.

    The rule stream is as large as it likes: rules and messages are unioned
    and one ordered scan carries ``last(rule, ignorenulls)`` forward. The
    order is global, so the scan is split into time chunks and the last rule
    of earlier chunks is carried in from a per-chunk summary (bounded by the
    chunk count). At equal time a rule applies to the message (rules sort
    first); of rules of equal time the one with the greatest ``tiebreak``
    holds if ``rules`` has that column, one without keyword only if all are. A rule without
    keyword brings ``default`` back. Output: ``messages`` columns plus ``rule_col``.
    """
    m_cols = messages.columns
    ties = [tiebreak] if tiebreak in rules.columns else []
    msg = messages.select(*m_cols, F.lit(None).cast("string").alias(rule_col),
                          F.lit(1).alias("_kind"))
    rule_rows = rules.select(
        *[F.lit(None).cast(messages.schema[c].dataType).alias(c) for c in m_cols
          if c != ts and c not in ties],
        *[F.col(c).cast(messages.schema[c].dataType).alias(c) for c in ties],
        F.col(ts), F.col(rule_col).cast("string").alias(rule_col), F.lit(0).alias("_kind"))
    rule_rows = rule_rows.select(*m_cols, rule_col, "_kind")
    both = msg.unionByName(rule_rows).withColumn("_ord", F.unix_micros(F.col(ts).cast("timestamp")))
    both = both.withColumn("_rule", F.when(F.col("_kind") == 0, F.struct(rule_col))) \
        .withColumn("_said", F.col(rule_col).isNotNull()).drop(rule_col)
    # The rules of an instant come first: a null tie.
    tie = F.when(F.col("_kind") == 1, F.col(tiebreak)) if tiebreak in m_cols and isinstance(
        messages.schema[tiebreak].dataType, NumericType) else None
    split = split_hot_keys(both, [], "_ord", rows_per_chunk, tie=tie)
    order = ["_ord", "_kind", "_said"] + ([tiebreak] if tiebreak else [])
    w = (Window.partitionBy(CHUNK).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = split.df.withColumn("_local", F.last("_rule", ignorenulls=True).over(w))
    # One summary row for *every* chunk (a chunk without rules must still
    # receive the carry from earlier chunks); message rows have a null
    # ordering, which max_by skips.
    is_rule = F.col("_kind") == 0
    summary = (split.df.groupBy(CHUNK)
               .agg(F.max_by(F.when(is_rule, F.col("_rule")),
                             F.when(is_rule, F.struct(*order))).alias("_last_rule")))
    prefix = chunk_prefix(split, summary, {"_carry": F.last("_last_rule", ignorenulls=True)})
    out = attach_prefix(scanned, split, prefix, ["_carry"])
    # not split: no carry
    before = F.col("_carry") if split.split else F.col("_local")
    chosen = F.coalesce(F.coalesce(F.col("_local"), before)[rule_col], F.lit(default).cast("string"))
    return (out.where(F.col("_kind") == 1)
            .select(*[c for c in m_cols], chosen.alias(rule_col)))


def mask_messages(df: DataFrame, text: str, keyword: str, out_col: str = "masked",
                  mask: str = MASK, prefix: str = MESSAGE_PREFIX) -> DataFrame:
    """J2 body: replace every literal occurrence of the current keyword by
    ``mask`` and prefix the message (messages without it pass unchanged)."""
    return df.withColumn(out_col, F.concat(F.lit(prefix),
                                           F.replace(F.col(text), F.col(keyword), F.lit(mask))))


def with_cached_text(df: DataFrame, cached: DataFrame, value: str, out_col: str,
                     sep: str = ": ") -> DataFrame:
    """Prefix every row with the text of a small cached file.

    ``cached`` must yield exactly one row with one string column (e.g.
    ``spark.read.text(path, wholetext=True)``). It is attached as a scalar
    subquery: evaluated once, shipped to every task as a constant, and Spark
    fails the query if it ever has more than one row, so the shipped size is
    bounded by construction (no join, no cross product).
    """
    text = cached.select(cached.columns[0]).scalar()
    return df.withColumn(out_col, F.concat(text, F.lit(sep), F.col(value).cast("string")))


def read_cached_text(spark, path: str):
    """The distributed-cache file as a one-row DataFrame (whole text)."""
    return spark.read.text(path, wholetext=True)
