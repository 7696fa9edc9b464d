"""Profit-and-loss movements between the opening and the closing run.

The inputs may be the summed runs or their rows before summing: every measure
is a sum and every class a function of the run keys. Given rows, a movement
needs a single shuffle from cash flow to result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions import dates
from closebook.functions.money import divide, member, zero_if_null
from closebook.operators.classify import class_by_code, derive_key
from closebook.operators.grouping import combine_runs, group_sum
from closebook.operators.lookups import left_lookup
from closebook.operators.valuation import average_rates, with_rate
from closebook.params import CloseParams
from closebook.plans.runs import CLOSING, TYC, TYC_SHIFT, YEAR_END, YEAR_END_SHIFT

FIRST_QUARTER = "Q1"
MOVEMENT_KEYS = ["contract", "I17COSTREVENUE", "lrc_lic", "I17ESTCURR"]


def _original(name: str) -> str:
    return f"discount_{name}_original_CCY"


def classify_run(run: DataFrame, params: CloseParams, closing: bool | Column) -> DataFrame:
    """Class, selecting period and short contract key of a run's rows."""
    short = derive_key(run, "segment_tail", source="contract")
    return class_by_code(short, params, first_quarter_is_claim=closing)


def by_date(flows: DataFrame, periods: list[str], params: CloseParams) -> DataFrame:
    """Cash flows whose selecting date lies in the given periods (the past, the first quarter).

    The rows that ``_selected`` would leave, told by integer ranges before anything is looked
    up or valued: they reach the file scan. Movements of such rows are ``chosen``.
    """
    code = F.col("I17COSTREVENUE")
    settled = dates.in_past_or_first_quarter(F.col("I17SETTLEMDATE"), periods, params)
    incurred = dates.in_past_or_first_quarter(F.col("I17INCURREDDATE"), periods, params)
    return flows.filter(
        (code.isin(*params.settlement_codes) & settled) | (code.isin(*params.incurred_codes) & incurred)
    )


def _selected(
    run: DataFrame, periods: list[str], params: CloseParams, inside: bool = True
) -> DataFrame:
    """Rows whose selecting period is one of the given ones, or is not.

    A row without a selecting period counts as outside. The period stands for
    the class as well: claims are exactly the past period and, in a closing
    run, the first quarter.
    """
    code = F.col("I17COSTREVENUE")
    hit = (member(code, params.settlement_codes) & member(F.col("settlement"), periods)) | (
        member(code, params.incurred_codes) & member(F.col("incurred"), periods)
    )
    return run.filter(hit if inside else ~hit)


def _to_base(df: DataFrame, rates: DataFrame, columns: dict[str, str], params) -> DataFrame:
    """EUR columns from original-currency ones at average rates."""
    rated = with_rate(df, average_rates(rates, params))
    return rated.withColumns(
        {new: divide(F.col(old), F.col("EXCHANGE_RATE")) for new, old in columns.items()}
    )


def movement_ir(
    ir: DataFrame, accounts: DataFrame, rates: DataFrame, params: CloseParams, chosen: bool = False
) -> DataFrame:
    """Release of the opening run: past and first-quarter rows, negated.

    ``chosen`` rows are those periods' alone, see ``by_date``.
    """
    df = classify_run(ir, params, closing=False)
    if not chosen:
        df = _selected(df, [params.past_label, FIRST_QUARTER], params)
    df = left_lookup(df, accounts, ["I17COSTREVENUE"], ["account"])
    keys = ["account", *MOVEMENT_KEYS]
    originals = ["nominal_original_CCY", _original(TYC), _original(YEAR_END)]
    summed = group_sum(df, keys, originals)
    # Rates go by currency, which is a key: one division per group suffices.
    valued = _to_base(
        summed,
        rates,
        {
            "nominal": "nominal_original_CCY",
            f"discount_{TYC}": _original(TYC),
            f"discount_{YEAR_END}": _original(YEAR_END),
        },
        params,
    )
    euros = ["nominal", f"discount_{TYC}", f"discount_{YEAR_END}"]
    valued = valued.withColumns({c: zero_if_null(F.col(c)) for c in euros})
    return valued.select(*keys, (-F.col("nominal")).alias("amount"), *euros, *originals)


# Result name -> measure of the closing and of the opening run.
_LRC = {
    "amount_original_CCY": ("nominal_original_CCY", "nominal_original_CCY"),
    _original(TYC_SHIFT): (_original(TYC_SHIFT), _original(TYC_SHIFT)),
    _original(YEAR_END_SHIFT): (_original(YEAR_END_SHIFT), _original(YEAR_END_SHIFT)),
}
_LRC_BASE = {
    "amount": "amount_original_CCY",
    f"discount_{TYC_SHIFT}": _original(TYC_SHIFT),
    f"discount_{YEAR_END_SHIFT}": _original(YEAR_END_SHIFT),
}
_LIC_PAST = {
    "amount_original_CCY": ("nominal_original_CCY", "nominal_original_CCY"),
    f"discount_{TYC}_change_original_CCY": (_original(TYC_SHIFT), _original(TYC)),
    f"discount_{YEAR_END}_change_original_CCY": (_original(YEAR_END_SHIFT), _original(YEAR_END)),
}
_LIC_PAST_BASE = {
    "amount": "amount_original_CCY",
    f"discount_{TYC}_change": f"discount_{TYC}_change_original_CCY",
    f"discount_{YEAR_END}_change": f"discount_{YEAR_END}_change_original_CCY",
}


def _run_change(
    ir: DataFrame, sm: DataFrame, periods: list[str], inside: bool, measures: dict, params: CloseParams
) -> DataFrame:
    """Closing less opening, from two runs."""
    opening = _selected(classify_run(ir, params, closing=False), periods, params, inside)
    closing = _selected(classify_run(sm, params, closing=True), periods, params, inside)
    return combine_runs(closing, opening, MOVEMENT_KEYS, measures, sign=-1)


def _tagged_change(
    rows: DataFrame, periods: list[str] | None, inside: bool, measures: dict, params: CloseParams
) -> DataFrame:
    """The same from one table of both runs' rows: one pass, opening rows with the other sign."""
    closing = F.col("run") == CLOSING
    own = classify_run(rows, params, closing)
    own = own if periods is None else _selected(own, periods, params, inside)
    signed = own.select(
        *MOVEMENT_KEYS,
        *[F.when(closing, F.col(c)).otherwise(-F.col(o)).alias(m) for m, (c, o) in measures.items()],
    )
    return group_sum(signed, MOVEMENT_KEYS, list(measures))


def movement_lrc(
    ir: DataFrame, sm: DataFrame, accounts: DataFrame, rates: DataFrame, params: CloseParams
) -> DataFrame:
    """Coverage: closing less opening, first-quarter opening rows left out."""
    change = _run_change(ir, sm, [params.past_label, FIRST_QUARTER], False, _LRC, params)
    return _posted(change, accounts, rates, _LRC_BASE, params)


def movement_lrc_of(
    rows: DataFrame, accounts: DataFrame, rates: DataFrame, params: CloseParams
) -> DataFrame:
    """``movement_lrc`` of the tagged rows of both runs."""
    change = _tagged_change(rows, [params.past_label, FIRST_QUARTER], False, _LRC, params)
    return _posted(change, accounts, rates, _LRC_BASE, params)


def movement_lic_past(
    ir: DataFrame, sm: DataFrame, accounts: DataFrame, rates: DataFrame, params: CloseParams
) -> DataFrame:
    """Past claims: closing on shifted curves less opening on unshifted ones."""
    change = _run_change(ir, sm, [params.past_label], True, _LIC_PAST, params)
    return _posted(change, accounts, rates, _LIC_PAST_BASE, params)


def movement_lic_past_of(
    rows: DataFrame, accounts: DataFrame, rates: DataFrame, params: CloseParams, chosen: bool = False
) -> DataFrame:
    """``movement_lic_past`` of the tagged rows of both runs; of the past alone if ``chosen``."""
    change = _tagged_change(rows, None if chosen else [params.past_label], True, _LIC_PAST, params)
    return _posted(change, accounts, rates, _LIC_PAST_BASE, params)


def movement_lic_current(
    sm: DataFrame, accounts: DataFrame, rates: DataFrame, params: CloseParams, chosen: bool = False
) -> DataFrame:
    """Claims of the first quarter: closing rows as they are, of that quarter alone if ``chosen``."""
    closing = classify_run(sm, params, closing=True)
    closing = closing if chosen else _selected(closing, [FIRST_QUARTER], params)
    originals = ["nominal_original_CCY", _original(TYC_SHIFT), _original(YEAR_END_SHIFT)]
    summed = group_sum(closing, MOVEMENT_KEYS, originals).withColumnRenamed(
        "nominal_original_CCY", "amount_original_CCY"
    )
    columns = {
        "amount": "amount_original_CCY",
        f"discount_{TYC_SHIFT}": _original(TYC_SHIFT),
        f"discount_{YEAR_END_SHIFT}": _original(YEAR_END_SHIFT),
    }
    return _posted(summed, accounts, rates, columns, params)


def _posted(change, accounts, rates, columns: dict[str, str], params) -> DataFrame:
    """Average rates and account by code; unmatched rows keep a null account."""
    valued = _to_base(change, rates, columns, params)
    placed = left_lookup(valued, accounts, ["I17COSTREVENUE"], ["account"])
    return placed.select("account", *MOVEMENT_KEYS, *columns, *columns.values())
