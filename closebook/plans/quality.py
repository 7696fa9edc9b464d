"""What a balance leaves out: counted in the pass that values the cash flows.

Counts and amounts are measures of the one sum over the cash flows, like the values
themselves. They need no second scan, and an executor that is lost and its tasks that
run again do not count twice, as accumulators would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions.money import zero_if_null
from closebook.operators.classify import class_by_date, derive_contract
from closebook.operators.grouping import group_sum
from closebook.operators.valuation import (
    RATE,
    has_rate_set,
    present_values,
    rated_by_exposure,
    with_aligned_date,
    with_factors,
)
from closebook.params import CloseParams
from closebook.plans.balances import CONTRACT_GRAIN, OPEN_ACCOUNT_GRAIN, OPEN_BCM, map_to_account
from closebook.sources.tables import hand_off

AMOUNT = "I17ESTAMOUNT"
#: Found on the cash flow, and on its lookups.
ROW_CHECKS = ("other_exposure", "missing_rate", "zero_rate", "missing_factor")
LOOKUP_CHECKS = ("no_portfolio", "no_account")


def row_checks(factor: str) -> dict[str, Column]:
    """Conditions on a valued cash flow; a row without a rate set is no candidate for the others."""
    kept, rate = has_rate_set(F.col("I17EXPCHANGE")), F.col(RATE)
    return {
        "rows": F.lit(True),
        "kept": kept,
        "other_exposure": ~kept,
        "missing_rate": kept & rate.isNull(),
        "zero_rate": kept & F.coalesce(rate == 0, F.lit(False)),
        "missing_factor": kept & F.col(factor).isNull(),
    }


def flagged_flows(
    bcm: DataFrame,
    curves: DataFrame,
    opening_rates: DataFrame,
    closing_rates: DataFrame,
    params: CloseParams,
    curve: str,
) -> DataFrame:
    """Cash flows at the rates of their exposure, summed to contract grain with their checks.

    ``n_<check>`` and ``amount_<check>`` are the rows and amounts a check concerns. Null
    keys stay: what they hide is part of the account.
    """
    df = rated_by_exposure(with_aligned_date(bcm, params), opening_rates, closing_rates, params)
    df = with_factors(df, curves, [curve], params.opening)
    df = present_values(df, [curve]).withColumnRenamed(f"discount_{curve}", "discount")
    df = derive_contract(class_by_date(df, params.opening), "segment")
    checks = row_checks(f"factor_{curve}")
    df = df.withColumns({f"_{name}": condition for name, condition in checks.items()})
    sums = [F.sum(F.when(F.col("_kept"), F.col(m))).alias(m) for m in OPEN_BCM]
    for name in checks:
        sums.append(F.count_if(F.col(f"_{name}")).alias(f"n_{name}"))
        sums.append(zero_if_null(F.sum(F.when(F.col(f"_{name}"), F.col(AMOUNT)))).alias(f"amount_{name}"))
    return df.groupBy(*CONTRACT_GRAIN).agg(*sums)


def checked_balance(
    flows: DataFrame, portfolios: DataFrame, accounts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The balance of ``flagged_flows`` by account, and its checks: check, n and amount.

    The summed flows are handed over once; balance and checks read them.
    """
    mapped = map_to_account(hand_off(flows), portfolios, accounts)
    lost = {"no_portfolio": F.col("local_portfolio").isNull(), "no_account": F.col("account").isNull()}
    sums, pairs = [], []
    for name in ("rows", *ROW_CHECKS, *LOOKUP_CHECKS):
        of, here = (f"{name}", F.lit(True)) if name not in lost else ("kept", lost[name])
        n = F.coalesce(F.sum(F.when(here, F.col(f"n_{of}"))), F.lit(0))
        amount = zero_if_null(F.sum(F.when(here, F.col(f"amount_{of}"))))
        sums.append(F.struct(F.lit(name).alias("check"), n.alias("n"), amount.alias("amount")).alias(name))
        pairs.append(F.col(name))
    checks = mapped.agg(*sums).select(F.inline(F.array(*pairs)))
    return group_sum(mapped, OPEN_ACCOUNT_GRAIN, OPEN_BCM), checks
