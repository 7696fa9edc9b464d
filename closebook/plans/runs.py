"""Opening and closing runs on cash flows, and checks on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions import ids
from closebook.operators.classify import derive_contract
from closebook.operators.grouping import fill_missing, group_sum
from closebook.operators.valuation import (
    npr_columns,
    present_values,
    rounded_present_values,
    shift_correction,
    with_aligned_date,
    with_factors,
    with_periods,
    with_rate,
    with_rate_by,
    with_rate_by_exposure,
)
from closebook.params import CLOSING_EXPOSURE, OPENING_EXPOSURE, CloseParams

# Tags of the runs, where the rows of both are one table.
OPENING, CLOSING = "opening", "closing"
# How often a row counts, where equal rows of several books are one row.
COPIES = "copies"
RUN_KEYS = [
    "contract", "I17EXPCHANGE", "I17COSTREVENUE", "I17KEYDATE", "I17ESTCURR",
    "settlement", "incurred",
]
REDUCTION_KEYS = ["I17REFOBJID", *RUN_KEYS[1:]]
# Names of the five curves.
TYC, YEAR_END = "tyc", "ycu_31_12"
TYC_SHIFT, YEAR_END_SHIFT = "tyc_shift", "ycu_31_12_shift"
QUARTER_END = "ycu_31_03"
OPENING_CURVES = [TYC, YEAR_END, TYC_SHIFT, YEAR_END_SHIFT]
CLOSING_CURVES = [*OPENING_CURVES, QUARTER_END]
UNSHIFTED = {TYC_SHIFT: TYC, YEAR_END_SHIFT: YEAR_END}


def discount_columns(names: Sequence[str]) -> list[str]:
    return [f"discount_{n}{s}" for s in ("", "_original_CCY") for n in names]


def run_measures(names: Sequence[str]) -> list[str]:
    return ["nominal", "nominal_original_CCY", *discount_columns(names)]


def valued_rows(
    bcm: DataFrame,
    rates: DataFrame,
    curves: DataFrame,
    names: Sequence[str],
    params: CloseParams,
) -> DataFrame:
    """Cash flows with period buckets and rounded present values, row by row."""
    df = with_periods(bcm, params, by="window")
    df = with_rate(df, rates, params.base_currency)
    df = with_factors(df, curves, names, params.opening)
    df = rounded_present_values(df, names, params)
    df = df.withColumn("contract", F.col("I17REFOBJID"))
    return fill_missing(df, keys=RUN_KEYS)


def opening_rows(
    opening: DataFrame,
    new: DataFrame,
    rates: DataFrame,
    curves: DataFrame,
    params: CloseParams,
) -> DataFrame:
    """Opening book plus opening-exposure rows of the new book, not yet summed."""
    late = new.filter(F.col("I17EXPCHANGE") == OPENING_EXPOSURE)
    both = opening.unionByName(late, allowMissingColumns=True)
    return opening_rows_of(both, rates, curves, params)


def opening_rows_of(
    both: DataFrame, rates: DataFrame, curves: DataFrame, params: CloseParams
) -> DataFrame:
    """The same where one table holds the rows of both books; a column ``copies`` tells how
    often a row counts."""
    df = valued_rows(both, rates, curves, OPENING_CURVES, params)
    df = shift_correction(df, UNSHIFTED)
    return df.select(*RUN_KEYS, *_times(df, run_measures(OPENING_CURVES)))


def _times(df: DataFrame, measures: Sequence[str]) -> list[Column]:
    """Measures as often as the row counts. A row is valued, and rounded, once."""
    if COPIES not in df.columns:
        return [F.col(m) for m in measures]
    return [(F.col(m) * F.col(COPIES)).alias(m) for m in measures]


def opening_rollforward(opening, new, rates, curves, params: CloseParams) -> DataFrame:
    """The opening run: both sources summed on seven keys in one shuffle."""
    return summed_opening(opening_rows(opening, new, rates, curves, params), params)


def summed_opening(rows: DataFrame, params: CloseParams) -> DataFrame:
    summed = group_sum(rows, RUN_KEYS, run_measures(OPENING_CURVES))
    # The charge uses unshifted curves only, which the correction leaves alone.
    return npr_columns(summed, [TYC, YEAR_END], params)


def closing_rows(new, rates, curves, params: CloseParams) -> DataFrame:
    """Closing-exposure rows of the new book, not yet summed.

    The factor override uses the opening date here as well.
    """
    df = new.filter(F.col("I17EXPCHANGE") == CLOSING_EXPOSURE)
    df = valued_rows(df, rates, curves, CLOSING_CURVES, params)
    df = shift_correction(df, UNSHIFTED)
    shown = [TYC_SHIFT, YEAR_END_SHIFT, QUARTER_END]
    return df.select(*RUN_KEYS, *run_measures(shown))


def closing_run(new, rates, curves, params: CloseParams) -> DataFrame:
    """The closing run: three discounts and the quarter-end charge."""
    shown = [TYC_SHIFT, YEAR_END_SHIFT, QUARTER_END]
    rows = closing_rows(new, rates, curves, params)
    return npr_columns(
        group_sum(rows, RUN_KEYS, run_measures(shown)), [QUARTER_END], params
    )


def tagged_rows(
    rows: DataFrame,
    opening_rates: DataFrame,
    closing_rates: DataFrame,
    curves: DataFrame,
    params: CloseParams,
) -> DataFrame:
    """Rows of both runs, tagged in ``run``, valued in one pass and not yet summed.

    Each run has its own rates; dates, buckets, factors and corrections are
    the same. ``closing_rates`` are currency and rate of one type. A column
    ``copies`` tells how often a row counts.
    """
    df = with_periods(rows, params, by="window")
    rates = {OPENING: opening_rates, CLOSING: closing_rates}
    df = with_rate_by(df, rates, "run", params.base_currency)
    df = with_factors(df, curves, CLOSING_CURVES, params.opening)
    df = rounded_present_values(df, CLOSING_CURVES, params)
    df = fill_missing(df.withColumn("contract", F.col("I17REFOBJID")), keys=RUN_KEYS)
    df = shift_correction(df, UNSHIFTED)
    return df.select("run", *RUN_KEYS, *_times(df, run_measures(CLOSING_CURVES)))


def bcm_reduction(bcm, opening_rates, closing_rates, curves, params: CloseParams) -> DataFrame:
    """Cash flows reduced to year/quarter buckets with three discounts.

    Rates follow the exposure; missing rates and factors are skipped.
    """
    names = ["locked_in", "tyc", "current"]
    df = with_periods(bcm, params, by="year")
    df = with_rate_by_exposure(df, opening_rates, closing_rates, params)
    df = present_values(with_factors(df, curves, names, params.closing), names)
    measures = ["nominal_original_CCY", "nominal", *[f"discount_{n}" for n in names]]
    return group_sum(df, REDUCTION_KEYS, measures)


def ungrouped_detail(new, rates, curves, params: CloseParams) -> DataFrame:
    """Opening-exposure cash flows one by one, without buckets or sums."""
    df = with_aligned_date(new.filter(F.col("I17EXPCHANGE") == OPENING_EXPOSURE), params)
    df = df.withColumn("contract", F.col("I17REFOBJID"))
    df = with_rate(df, rates, params.base_currency)
    df = with_factors(df, curves, OPENING_CURVES, params.opening)
    df = npr_columns(present_values(df, OPENING_CURVES), [TYC, YEAR_END], params)
    return df.select(
        "contract", "I17EXPCHANGE", "I17COSTREVENUE", "I17KEYDATE", "I17INCURREDDATE",
        "I17SETTLEMDATE", "I17ESTCURR", *run_measures(OPENING_CURVES),
        f"npr_{TYC}", f"npr_{YEAR_END}",
    )


def onerous_check(
    new: DataFrame,
    rates: DataFrame,
    curves: DataFrame,
    names: Sequence[str],
    params: CloseParams,
) -> DataFrame:
    """Contracts whose ON/NO marker disagrees with the sign of their margin.

    Margin, discount and charge are sums of row values, so one shuffle to
    contract grain is enough.
    """
    df = new.filter(F.col("I17EXPCHANGE") == OPENING_EXPOSURE)
    df = valued_rows(df, rates, curves, names, params)
    df = npr_columns(derive_contract(df, "tail3", with_life=False), names, params)
    df = df.withColumns(
        {
            f"csm_{n}": F.col("nominal") + F.col(f"discount_{n}") + F.col(f"npr_{n}")
            for n in names
        }
    )
    summed = group_sum(df, ["ri_rh", "contract"], [f"csm_{n}" for n in names])
    ceded = F.col("ri_rh") == "RI"
    marked = summed.withColumn("on_no", ids.onerous_marker(F.col("contract"))).withColumns(
        {
            f"on_no_should_be_{n}": F.when(
                ceded & (F.col(f"csm_{n}") < 0), F.lit("ON")
            ).otherwise(F.lit("NO"))
            for n in names
        }
    )
    differs = F.lit(False)
    for n in names:
        differs = differs | ~F.col(f"on_no_should_be_{n}").eqNullSafe(F.col("on_no"))
    return marked.filter(differs)
