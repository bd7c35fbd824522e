"""Linking operators: top-1 per group, visit→admission interval join,
short-term return detection.

Scale notes
-----------
* ``top1`` is ``row_number() = 1``; Spark plans it with a *partial*
  ``WindowGroupLimit`` before the shuffle, so every map task ships at most one
  row per key: a hot key costs one row per task, not a third of the table.
* ``interval_link`` never pairs all visits with all admissions of a patient.
  The date range ``admission_day in [visit_day, visit_day + k]`` is rewritten
  into an equi-join on ``(patient, day)`` by giving each admission its k+1
  candidate visit days.  Pairs are only formed inside one patient-day.
* ``flag_returns`` replaces the self range join by equi-joins on
  ``(patient, code, day)`` over *distinct* days (map-side pre-aggregated), so a
  patient with a third of all visits still only spreads over its days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.functions.columns import minutes_whole
from wardflow.session import materialize, spread


def _order(c: Column | str | tuple) -> Column:
    """``"x"`` → asc nulls first, ``("x", "desc")`` → desc nulls last."""
    if isinstance(c, tuple):
        name, direction = c
        col = F.col(name) if isinstance(name, str) else name
        return col.desc_nulls_last() if direction == "desc" else col.asc_nulls_first()
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_first()


def top1(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    Give a full tie-break in ``order`` for a deterministic result.
    """
    w = Window.partitionBy(*keys).orderBy(*[_order(o) for o in order])
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn"))


def interval_link(visits: DataFrame, admissions: DataFrame, *,
                  visit_id: str, visit_patient: str, visit_day: str, visit_ts: str,
                  adm_id: str, adm_patient: str, adm_ts: str,
                  max_days: int = 1) -> DataFrame:
    """Inner interval join: same patient, ``date(adm_ts)`` within
    ``[visit_day, visit_day + max_days]``; then the best visit per admission:
    smallest signed whole minutes from arrival to admission (negatives first),
    ties by visit id.

    Returns visit columns ``visit_id`` plus every admission column and
    ``link_minutes``.

    ``visits`` must hold one visit per (patient, day) — the last one, as the
    model does with ``top1`` first — so that no (patient, day) key pairs many
    visits with many admissions.
    """
    cand = admissions.withColumn(
        "__vday", F.explode(F.sequence(F.lit(0), F.lit(max_days))))
    cand = cand.withColumn("__vday", F.date_sub(F.to_date(F.col(adm_ts)), F.col("__vday")))
    v = visits.select(F.col(visit_id).alias("__vid"), F.col(visit_patient).alias("__vpat"),
                      F.col(visit_day).cast("date").alias("__vd"), F.col(visit_ts).alias("__vts"))
    joined = cand.join(
        v, (cand[adm_patient] == v["__vpat"]) & (cand["__vday"] == v["__vd"]), "inner")
    joined = joined.withColumn("link_minutes", minutes_whole(F.col(adm_ts), F.col("__vts")))
    best = top1(joined, [adm_id], ["link_minutes", "__vid"])
    return (best.withColumnRenamed("__vid", visit_id)
                .drop("__vday", "__vpat", "__vd", "__vts"))


def returning_ids(df: DataFrame, *, id_col: str, patient: str, code: str | None, day: str | Column,
                  min_days: int = 1, max_days: int = 2, mark: str = "first") -> DataFrame:
    """Distinct ``id_col`` of the rows that ``flag_returns`` flags, computed on
    a narrow projection (id, patient, code, day): joining this back by id
    keeps every shuffle of the wide table on the id.  The projection is stored: it
    is read for the days and again for the rows to flag."""
    day_col = (F.col(day) if isinstance(day, str) else day).cast("date")
    code_col = F.col(code) if code is not None else F.lit("")
    narrow = df.select(F.col(id_col).alias("__id"), F.col(patient).alias("__pp"), code_col.alias("__cc"),
                       day_col.alias("__dd"))
    narrow = materialize(narrow, "returns")
    flagged = flag_returns(narrow, patient="__pp", code="__cc", day="__dd", flag="__f",
                           min_days=min_days, max_days=max_days, mark=mark)
    return flagged.where(F.col("__f") == 1).select(F.col("__id").alias(id_col)).distinct()


def flag_returns(df: DataFrame, *, patient: str, code: str | None, day: str | Column,
                 flag: str = "fl_retorno_48h", min_days: int = 1, max_days: int = 2,
                 mark: str = "first") -> DataFrame:
    """Flag rows by short-term returns of the same patient (and the same code,
    unless ``code`` is None) ``min_days..max_days`` calendar days apart.

    ``mark="first"`` (the model's semantics) flags the earlier visit, the one
    that is followed by a return; ``mark="return"`` flags the later visit, the
    one that came back.  NULL patient or NULL code never match (join
    semantics).
    """
    if mark not in ("first", "return"):
        raise ValueError("mark must be 'first' or 'return'")
    day_col = (F.col(day) if isinstance(day, str) else day).cast("date")
    code_col = F.col(code) if code is not None else F.lit("")
    days = (df.select(F.col(patient).alias("__p"), code_col.alias("__c"), day_col.alias("__d"))
              .where(F.col("__p").isNotNull() & F.col("__c").isNotNull() & F.col("__d").isNotNull()))
    # most patients, codes and days occur once
    days = spread(days, "__p", "__c", "__d", rows=df.count()).distinct()
    # a visit on day v marks the other end of the pair: v-k (first) or v+k (return)
    shifted = days.withColumn("__k", F.explode(F.sequence(F.lit(min_days), F.lit(max_days))))
    moved = F.date_sub("__d", F.col("__k")) if mark == "first" else F.date_add("__d", F.col("__k"))
    other = (shifted.select("__p", "__c", moved.alias("__d")).distinct().withColumn(flag, F.lit(1)))
    out = df.join(other,
                  (df[patient] == other["__p"]) & (code_col == other["__c"]) & (day_col == other["__d"]),
                  "left")
    return (out.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))
               .drop("__p", "__c", "__d"))
