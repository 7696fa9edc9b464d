"""Account balances: cash flows, actuals, margin, risk charge, and their total.

Each component is valued row by row in the scan stage, summed to contract
grain (the one shuffle that sees the full data), and only then mapped to
portfolio and account, so all lookups by contract run on summed rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.functions.money import divide
from closebook.operators.classify import (
    CLAIMS,
    COVERAGE,
    class_by_date,
    derive_contract,
)
from closebook.operators.grouping import (
    align,
    control_total,
    group_sum,
    group_sum_sets,
    union_books,
    with_total,
)
from closebook.operators.lookups import checked, left_lookup, tag_members
from closebook.operators.valuation import (
    balance_rates,
    npr_amount,
    present_values,
    with_aligned_date,
    with_factors,
    with_rate,
)
from closebook.params import CLOSING_EXPOSURE, CloseParams

CONTRACT_GRAIN = ["ri_rh", "zivot_nezivot", "contract", "I17COSTREVENUE", "lrc_lic"]
OPEN_ACCOUNT_GRAIN = ["ri_rh", "zivot_nezivot", "local_portfolio", "account"]
OPEN_CODE_GRAIN = [
    "ri_rh", "zivot_nezivot", "I17COSTREVENUE", "local_portfolio", "lrc_lic",
]
CLOSE_ACCOUNT_GRAIN = ["origin", "ri_rh", "zivot_nezivot", "I17COSTREVENUE", "account"]
CLOSE_CODE_GRAIN = ["origin", *OPEN_CODE_GRAIN]
BY_CLASS = ["I17COSTREVENUE", "ri_rh", "lrc_lic"]
BY_SEGMENT = ["I17COSTREVENUE", "ri_rh"]

OPEN_BCM = ["nominal_original_CCY", "nominal", "discount"]
CLOSE_BCM = ["nominal_original_CCY", "nominal", "discount_locked_in", "discount_current"]
ACTUALS = ["actuals_CCY", "actuals"]
OPEN_PARTS = ["nominal", "discount", "actuals", "trv", "npr"]
CLOSE_PARTS = ["nominal", "discount_current", "actuals", "npr"]


def map_to_account(
    df: DataFrame,
    portfolios: DataFrame,
    accounts: DataFrame,
    account_keys: Sequence[str] = BY_CLASS,
) -> DataFrame:
    """Summed rows -> local portfolio (by contract) -> account (by code).

    A code has one account: a second one stops the job. Pass ``checked`` portfolios to refuse a
    second portfolio of a contract as well; that sums the whole list of contracts.
    """
    placed = left_lookup(df, portfolios, ["contract"], ["local_portfolio"])
    return left_lookup(placed, checked(accounts, account_keys), account_keys, ["account"])


# --- cash flows -----------------------------------------------------------


def opening_cash_flows(
    bcm: DataFrame, curves: DataFrame, rates: DataFrame, params: CloseParams, curve: str
) -> DataFrame:
    """Cash flows valued with one curve, summed to contract grain.

    Rates come from the table for every currency, the base one included.
    """
    df = with_rate(with_aligned_date(bcm, params), rates)
    df = with_factors(df, curves, [curve], params.opening)
    df = derive_contract(class_by_date(df, params.opening), "segment")
    df = present_values(df, [curve]).withColumnRenamed(f"discount_{curve}", "discount")
    return group_sum(df, CONTRACT_GRAIN, OPEN_BCM)


def origin_discounts(df: DataFrame) -> DataFrame:
    """New contracts have no locked-in curve: the current one stands in."""
    locked = F.when(F.col("origin") == "old", F.col("discount_locked_in"))
    return df.withColumn(
        "discount_locked_in", locked.otherwise(F.col("discount_current"))
    )


def closing_cash_flows(
    bcm: DataFrame,
    curves: DataFrame,
    rates: DataFrame,
    old_contracts: DataFrame,
    params: CloseParams,
) -> DataFrame:
    """Closing-exposure cash flows with locked-in and current discounts.

    Origin depends on the contract alone, so both discounts are summed per
    contract first and the list of old contracts meets the summed rows only.
    """
    df = with_aligned_date(bcm.filter(F.col("I17EXPCHANGE") == CLOSING_EXPOSURE), params)
    df = with_rate(df, balance_rates(rates), params.base_currency)
    df = with_factors(df, curves, ["locked_in", "current"], params.closing)
    df = derive_contract(class_by_date(df, params.closing), "tail2")
    df = group_sum(
        present_values(df, ["locked_in", "current"]), CONTRACT_GRAIN, CLOSE_BCM
    )
    return origin_discounts(tag_members(df, old_contracts, "contract"))


def bcm_balance_open(
    bcm: DataFrame,
    curves: DataFrame,
    rates: DataFrame,
    portfolios: DataFrame,
    accounts: DataFrame,
    params: CloseParams,
    curve: str = "tyc",
    grain: Sequence[str] = OPEN_ACCOUNT_GRAIN,
) -> DataFrame:
    """Opening cash-flow balance, by account (default) or by code."""
    flows = opening_cash_flows(bcm, curves, rates, params, curve)
    return group_sum(map_to_account(flows, portfolios, accounts), grain, OPEN_BCM)


def bcm_balance_close(
    bcm: DataFrame,
    curves: DataFrame,
    rates: DataFrame,
    old_contracts: DataFrame,
    portfolios: DataFrame,
    accounts: DataFrame,
    params: CloseParams,
    grain: Sequence[str] = CLOSE_ACCOUNT_GRAIN,
) -> DataFrame:
    """Closing cash-flow balance, by account (default) or by code."""
    flows = closing_cash_flows(bcm, curves, rates, old_contracts, params)
    return group_sum(map_to_account(flows, portfolios, accounts), grain, CLOSE_BCM)


def bcm_balance_grains(
    bcm: DataFrame,
    curves: DataFrame,
    rates: DataFrame,
    portfolios: DataFrame,
    accounts: DataFrame,
    params: CloseParams,
    curve: str = "tyc",
) -> DataFrame:
    """Opening cash-flow balance by account and by code, from one valuation; ``grain`` tells which."""
    flows = opening_cash_flows(bcm, curves, rates, params, curve)
    mapped = map_to_account(flows, portfolios, accounts)
    return group_sum_sets(mapped, {"account": OPEN_ACCOUNT_GRAIN, "code": OPEN_CODE_GRAIN}, OPEN_BCM)


# --- actuals --------------------------------------------------------------


def _actual_rows(act: DataFrame, form: str) -> DataFrame:
    df = act.withColumnsRenamed({"I17PORTID": "I17REFOBJID", "I17CFTYPE": "I17COSTREVENUE"})
    return derive_contract(df, form).withColumns(
        {"actuals_CCY": -F.col("I17VALUE"), "actuals": -F.col("I17FUNCTVALUE")}
    )


def opening_actuals(act: DataFrame, portfolios: DataFrame, accounts: DataFrame) -> DataFrame:
    """Actual payments are always claims in the opening balance."""
    df = _actual_rows(act, "segment").withColumn("lrc_lic", F.lit(CLAIMS))
    return map_to_account(group_sum(df, CONTRACT_GRAIN, ACTUALS), portfolios, accounts)


def closing_actuals(
    act: DataFrame, old_contracts: DataFrame, portfolios: DataFrame, accounts: DataFrame
) -> DataFrame:
    grain = [key for key in CONTRACT_GRAIN if key != "lrc_lic"]
    df = group_sum(_actual_rows(act, "tail2"), grain, ACTUALS)
    df = tag_members(df, old_contracts, "contract")
    return map_to_account(df, portfolios, accounts, BY_SEGMENT)


def actuals_balance_open(act, portfolios, accounts) -> DataFrame:
    return group_sum(
        opening_actuals(act, portfolios, accounts), OPEN_ACCOUNT_GRAIN, ACTUALS
    )


def actuals_balance_close(act, old_contracts, portfolios, accounts) -> DataFrame:
    mapped = closing_actuals(act, old_contracts, portfolios, accounts)
    return group_sum(mapped, CLOSE_ACCOUNT_GRAIN, ACTUALS)


# --- service margin -------------------------------------------------------


def margins(
    books: Sequence[DataFrame],
    rates: DataFrame,
    portfolios: DataFrame,
    accounts: DataFrame,
    name: str = "csm",
) -> DataFrame:
    """Margin of all books in both currencies, always coverage.

    Rates are joined as given: with several rate types in the table each
    amount counts once per type.
    """
    df = with_rate(union_books(books), rates)
    df = derive_contract(df, "from_segment").withColumns(
        {
            f"{name}_original_CCY": F.col("I17ESTAMOUNT"),
            name: divide(F.col("I17ESTAMOUNT"), F.col("EXCHANGE_RATE")),
            "lrc_lic": F.lit(COVERAGE),
        }
    )
    summed = group_sum(df, CONTRACT_GRAIN, [f"{name}_original_CCY", name])
    return map_to_account(summed, portfolios, accounts)


def csm_balance(books, rates, portfolios, accounts, name: str = "csm") -> DataFrame:
    mapped = margins(books, rates, portfolios, accounts, name)
    return group_sum(mapped, OPEN_ACCOUNT_GRAIN, [f"{name}_original_CCY", name])


# --- non-performance risk -------------------------------------------------


def npr_charge(
    by_code: DataFrame,
    charge_accounts: DataFrame,
    params: CloseParams,
    grain: Sequence[str],
    discount: str = "discount",
    segments: Sequence[str] | None = None,
) -> DataFrame:
    """Charge on the code-grain balance, account by coverage/claims class."""
    df = by_code.withColumn("npr", npr_amount(params, discount)).filter(
        F.col("I17COSTREVENUE").isin(*params.npr_codes)
    )
    if segments is not None:
        df = df.filter(F.col("ri_rh").isin(*segments))
    if "account" in df.columns:
        df = df.drop("account")
    placed = left_lookup(df, charge_accounts, ["lrc_lic"], ["account"])
    return group_sum(placed, grain, ["npr"])


def with_charge_rows(
    mapped: DataFrame,
    charge_accounts: DataFrame,
    params: CloseParams,
    code_grain: Sequence[str],
    measures: Sequence[str],
    discount: str,
) -> DataFrame:
    """Cash-flow rows plus one charge row for each chargeable one.

    The charge is linear in the amounts and its code grain is coarser than the
    mapped rows, so both components leave one pass over the mapped rows; a
    separate charge branch would value all cash flows a second time.
    """
    chargeable = F.col("I17COSTREVENUE").isin(*params.npr_codes)
    for key in code_grain:
        chargeable = chargeable & F.col(key).isNotNull()
    kinds = F.when(chargeable, F.array(F.lit("flow"), F.lit("charge"))).otherwise(
        F.array(F.lit("flow"))
    )
    rows = mapped.withColumn("_kind", F.explode(kinds))
    is_charge = F.col("_kind") == "charge"
    keyed = rows.withColumn("_class", F.when(is_charge, F.col("lrc_lic")))
    dim = charge_accounts.select(
        F.col("lrc_lic").alias("_class"), F.col("account").alias("_charge_account")
    )
    placed = left_lookup(keyed, dim, ["_class"])
    charge = npr_amount(params, discount)
    columns = {
        "npr": F.when(is_charge, charge).otherwise(F.lit(0.0)),
        "account": F.when(is_charge, F.col("_charge_account")).otherwise(F.col("account")),
    }
    for measure in measures:
        columns[measure] = F.when(is_charge, F.lit(0.0)).otherwise(F.col(measure))
    return placed.withColumns(columns).drop("_kind", "_class", "_charge_account")


# --- totals ---------------------------------------------------------------


def portfolio_balance_open(components: Sequence[DataFrame]) -> DataFrame:
    """All components by portfolio and account, with their total."""
    return with_total(align(components, OPEN_ACCOUNT_GRAIN, OPEN_PARTS), OPEN_PARTS)


def portfolio_balance_close(components: Sequence[DataFrame]) -> DataFrame:
    """All components by origin, account and code, with their total.

    The alignment grain also holds segment and life flag; rows that lack one
    of those drop out, and the sum over them is taken in the same shuffle.
    """
    parts = ["nominal_original_CCY", *CLOSE_PARTS]
    keys = ["origin", "account", "I17COSTREVENUE"]
    required = ["ri_rh", "zivot_nezivot"]
    return with_total(align(components, keys, parts, required), CLOSE_PARTS)


def component_balances(components: Sequence[DataFrame]) -> list[DataFrame]:
    """Each component by itself, summed by portfolio and account."""
    return [align([df], OPEN_ACCOUNT_GRAIN, OPEN_PARTS) for df in components]


def control_totals(components: Sequence[DataFrame], balance: DataFrame) -> DataFrame:
    """Grand totals of the components before, and of the balance after their alignment.

    The two rows differ if the alignment doubled a row or lost a key.
    ``components`` are summed one by one; hand them over first, as the balance
    made of them reads them as well.
    """
    each = [control_total(df, OPEN_PARTS) for df in components]
    before = control_total(union_books(each), OPEN_PARTS).withColumn("stage", F.lit("before"))
    after = control_total(balance, OPEN_PARTS).withColumn("stage", F.lit("after"))
    return with_total(before.unionByName(after), OPEN_PARTS)


def sign_flags(balance: DataFrame) -> DataFrame:
    """Portfolios whose total has the wrong sign for their segment."""
    totals = group_sum(balance, ["ri_rh", "local_portfolio"], ["total_balance"])
    total = F.col("total_balance")
    wrong = ((F.col("ri_rh") == "RH") & (total < 0)) | (
        (F.col("ri_rh") == "RI") & (total > 0)
    )
    return totals.select(
        "ri_rh", "local_portfolio", F.coalesce(wrong, F.lit(False)).alias("mapping_change_flag")
    )


def sign_flag_remap(
    balance: DataFrame,
    counter_accounts: DataFrame,
    flag_keys: Sequence[str] = ("local_portfolio",),
) -> DataFrame:
    """Flagged rows move to the counter-account; then one total per account.

    With the default key a portfolio held by both segments meets two flags
    and counts under each; pass ``("ri_rh", "local_portfolio")`` to match the
    flag's own grain. Flagged rows without a counter-account drop out. The
    balance is read twice: hand over one that is costly to compute.
    """
    flags = sign_flags(balance).select(*flag_keys, "mapping_change_flag")
    flagged = left_lookup(balance, flags, list(flag_keys))
    flagged = left_lookup(flagged, counter_accounts, ["account"], ["counter_account"])
    account = F.when(F.col("mapping_change_flag"), F.col("counter_account"))
    moved = flagged.withColumn("account", account.otherwise(F.col("account")))
    return group_sum(moved, ["account"], ["total_balance"])
