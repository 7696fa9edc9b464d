"""Contract keys and coverage/claims classes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions import dates, ids
from closebook.functions.money import member
from closebook.params import CloseParams

COVERAGE, CLAIMS = "LRC", "LIC"


def derive_contract(
    df: DataFrame, form: str, source: str = "I17REFOBJID", with_life: bool = True
) -> DataFrame:
    """Contract key in the asked form, segment and life flag from the id.

    The id is cut once; its stem and segment part are steps that all keys read.
    """
    ref, base, part = F.col(source), F.col("_stem"), F.col("_segment_part")
    columns = {"contract": ids.CONTRACT_FORMS[form](ref, base, part), "ri_rh": ids.segment_of(part)}
    if with_life:
        columns["zivot_nezivot"] = ids.life_of(part)
    return _cut(df, source).withColumns(columns).drop("_stem", "_segment_part")


def derive_key(df: DataFrame, form: str, source: str = "I17REFOBJID", name: str = "contract") -> DataFrame:
    """The contract key alone."""
    key = ids.CONTRACT_FORMS[form](F.col(source), F.col("_stem"), F.col("_segment_part"))
    return _cut(df, source).withColumn(name, key).drop("_stem", "_segment_part")


def _cut(df: DataFrame, source: str) -> DataFrame:
    df = df.withColumn("_stem", ids.stem(F.col(source)))
    return df.withColumn("_segment_part", ids.segment_part(F.col("_stem")))


def class_by_date(df: DataFrame, calculation_date: dt.date) -> DataFrame:
    """Incurred (as given, not aligned) by the calculation date -> claims."""
    past = dates.on_or_before(F.col("I17INCURREDDATE"), calculation_date)
    label = F.when(past, F.lit(CLAIMS))
    return df.withColumn("lrc_lic", label.otherwise(F.lit(COVERAGE)))


def class_by_code(
    df: DataFrame, params: CloseParams, first_quarter_is_claim: bool | Column
) -> DataFrame:
    """``date_select`` is the incurred or the settlement bucket, by code.

    Codes of neither list have none and count as coverage. The past bucket is
    a claim; in a closing run the first quarter is one too. Where rows of both
    runs are one table, a column tells the closing ones.
    """
    code = F.col("I17COSTREVENUE")
    chosen = F.when(
        member(code, params.settlement_codes), F.col("settlement")
    ).when(member(code, params.incurred_codes), F.col("incurred"))
    past = F.col("date_select") == params.past_label
    label = F.when(past, F.lit(CLAIMS))
    if first_quarter_is_claim is not False:
        early = F.col("date_select") == "Q1"
        if first_quarter_is_claim is not True:
            early = early & first_quarter_is_claim
        label = label.when(early, F.lit(CLAIMS))
    return df.withColumn("date_select", chosen).withColumn(
        "lrc_lic", label.otherwise(F.lit(COVERAGE))
    )
