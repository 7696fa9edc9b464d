"""Named queries. Each takes (spark, folder) and returns a DataFrame.

Results are shaped for comparison with SQL: money is rounded after the sum,
charges to six digits, whole numbers are 64-bit, dates are ``YYYYMMDD``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook import schemas
from closebook.catalog.inputs import CODES, CURVES, PARAMS, StarInputs
from closebook.functions import dates, ids, money
from closebook.operators import classify, dictionary, fill, grouping, lookups, valuation
from closebook.params import WHOLE_EUR_CURRENCIES
from closebook.plans import balances, ledger, movements, quality, runs
from closebook.session import fresh_path
from closebook.sources import delimited, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Callable[[StarInputs], DataFrame]) -> Callable[[StarInputs], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return shaped(function(StarInputs(spark, folder)))

    REGISTRY[function.__name__] = run
    return function


def shaped(df: DataFrame) -> DataFrame:
    """Round doubles (charges to 6 digits, factors to 9, money to 2), widen ints."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind == "double":
            digits = 6 if field.name.startswith("npr") else 2
            digits = 9 if field.name.startswith(("factor", "EXCHANGE_RATE")) else digits
            column = F.round(column, digits)
        elif kind == "integer":
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def counted(df: DataFrame, keys: Sequence[str], measures: Sequence[str] = ()) -> DataFrame:
    """Row count and sums per key, nulls kept as a group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[money.zero_if_null(F.sum(m)).alias(m) for m in measures],
    )


# --- keys, dates, classes -------------------------------------------------


@query
def contract_keys(given: StarInputs) -> DataFrame:
    # Keys depend on the id alone, so ids are summed first and parsed once each.
    ref = F.col("I17REFOBJID")
    summed = counted(given.bcm(), ["I17REFOBJID"], ["I17ESTAMOUNT"])
    return summed.withColumns(
        {f"contract_{form}": ids.contract(ref, form) for form in ids.CONTRACT_FORMS if form != "whole"}
    ).withColumns(
        {
            "zivot_nezivot": ids.life_flag(ref),
            "ri_rh": ids.segment(ref),
            "on_no": ids.onerous_marker(F.col("contract_tail3")),
        }
    )


@query
def month_end_align(given):
    df = valuation.with_aligned_date(given.bcm(), PARAMS)
    summed = counted(df, ["I17SETTLEMDATE", "date_adjusted"], ["I17ESTAMOUNT"])
    return summed.withColumn("date_adjusted", dates.to_int(F.col("date_adjusted")))


def _buckets(given: StarInputs, by: str) -> DataFrame:
    df = valuation.with_buckets(given.bcm(), PARAMS, by)
    return counted(df, ["settlement", "incurred"], ["I17ESTAMOUNT"])


@query
def period_bucket_year(given):
    return _buckets(given, "year")


@query
def period_bucket_window(given):
    return _buckets(given, "window")


@query
def value_map(given):
    """Month ends of the plan year -> quarter by a value map, others unchanged."""
    day = dates.align_month_end(dates.from_int(F.col("I17SETTLEMDATE")))
    df = given.bcm().withColumn("period", F.date_format(day, "yyyyMMdd"))
    mapping = {
        dates_text: f"Q{(month + 2) // 3}"
        for month, dates_text in _plan_month_ends().items()
    }
    return counted(lookups.map_values(df, "period", mapping), ["period"], ["I17ESTAMOUNT"])


def _plan_month_ends() -> dict[int, str]:
    from closebook.params import shift_month_end

    return {
        m: shift_month_end(PARAMS.opening, m).strftime("%Y%m%d") for m in range(1, 13)
    }


@query
def lrc_lic_by_date(given):
    df = classify.class_by_date(given.bcm(), PARAMS.opening)
    return counted(df, ["lrc_lic", "I17COSTREVENUE"], ["I17ESTAMOUNT"])


@query
def lrc_lic_by_code(given):
    df = valuation.with_buckets(given.bcm(), PARAMS)
    keys = ["I17COSTREVENUE", "settlement", "incurred"]
    summed = counted(df, keys, ["I17ESTAMOUNT"])
    opening = classify.class_by_code(summed, PARAMS, first_quarter_is_claim=False)
    opening = opening.withColumnRenamed("lrc_lic", "lrc_lic_opening")
    return classify.class_by_code(opening, PARAMS, first_quarter_is_claim=True)


@query
def null_safe_not_equal(given):
    """Rows whose selecting period is not the first quarter, null ones kept."""
    df = valuation.with_buckets(given.bcm(), PARAMS)
    df = classify.class_by_code(df, PARAMS, first_quarter_is_claim=False)
    kept = df.filter(~F.col("date_select").eqNullSafe(F.lit("Q1")))
    return counted(kept, ["I17COSTREVENUE", "date_select"], ["I17ESTAMOUNT"])


# --- rates, curves, present values ----------------------------------------


@query
def fx_convert(given):
    amount, rate = F.col("I17ESTAMOUNT"), F.col("EXCHANGE_RATE")
    # The rate goes by currency, a key here: convert the sums.
    summed = counted(given.bcm(), ["I17ESTCURR"], ["I17ESTAMOUNT"])
    table = valuation.with_rate(summed, given.rates_open())
    table = table.withColumn("nominal_table", money.divide(amount, rate)).drop("EXCHANGE_RATE")
    balance = valuation.balance_rates(given.rates_close())
    return valuation.with_rate(table, balance, PARAMS.base_currency).withColumn(
        "nominal_forced", money.divide(amount, rate)
    )


@query
def fx_by_exposure(given):
    df = valuation.with_rate_by_exposure(
        given.bcm(), given.rates_open(), given.rates_close(), PARAMS
    )
    df = df.withColumn("nominal", money.divide(F.col("I17ESTAMOUNT"), F.col("EXCHANGE_RATE")))
    return counted(df, ["I17EXPCHANGE", "I17ESTCURR"], ["I17ESTAMOUNT", "nominal"])


@query
def fx_average_set(given):
    rates = valuation.average_rates(given.rates_close(), PARAMS)
    summed = counted(given.bcm(), ["I17ESTCURR"], ["I17ESTAMOUNT"])
    return valuation.with_rate(summed, rates).withColumn(
        "nominal", money.divide(F.col("I17ESTAMOUNT"), F.col("EXCHANGE_RATE"))
    )


@query
def wide_curves(given):
    return given.curve_files().withColumn("date_adjusted", dates.to_int(F.col("date_adjusted")))


@query
def discount_pv(given):
    names = list(CURVES)
    df = valuation.with_aligned_date(given.bcm(), PARAMS)
    df = valuation.with_rate(df, given.rates_open(), PARAMS.base_currency)
    df = valuation.with_factors(df, given.curves(), names, PARAMS.opening)
    df = valuation.present_values(df, names).withColumn("year", F.year("date_adjusted"))
    return grouping.group_sum(df, ["I17ESTCURR", "year"], runs.run_measures(names))


@query
def ccy_rounding(given):
    names = list(CURVES)
    df = valuation.with_aligned_date(given.bcm(), PARAMS)
    df = valuation.with_rate(df, given.rates_open(), PARAMS.base_currency)
    df = valuation.with_factors(df, given.curves(), names, PARAMS.opening)
    df = valuation.rounded_present_values(df, names, PARAMS)
    df = df.withColumn("year", F.year("date_adjusted"))
    return grouping.group_sum(df, ["I17ESTCURR", "year"], runs.run_measures(names))


def _valued(given: StarInputs) -> DataFrame:
    return runs.valued_rows(
        given.bcm(), given.rates_open(), given.curves(), runs.OPENING_CURVES, PARAMS
    )


@query
def npr_inline(given):
    names = runs.OPENING_CURVES
    df = valuation.npr_columns(_valued(given), names, PARAMS)
    keys = ["I17COSTREVENUE", "I17ESTCURR", "settlement"]
    return grouping.group_sum(df, keys, [f"npr_{n}" for n in names])


@query
def shift_correction(given):
    df = valuation.shift_correction(_valued(given), runs.UNSHIFTED)
    keys = ["I17COSTREVENUE", "I17ESTCURR", "settlement"]
    return grouping.group_sum(df, keys, runs.discount_columns(runs.OPENING_CURVES))


# --- origin and mapping ---------------------------------------------------


@query
def tag_origin(given):
    paid = dictionary.once(given.bcm(), ["I17REFOBJID"], ["I17ESTAMOUNT"])
    parsed = classify.derive_contract(paid, "tail2", with_life=False)
    summed = parsed.groupBy("contract", "ri_rh").agg(
        F.sum(dictionary.ROWS).alias("n"), money.zero_if_null(F.sum("I17ESTAMOUNT")).alias("I17ESTAMOUNT")
    )
    tagged = lookups.tag_members(summed, given.old_contracts(), "contract")
    return tagged.groupBy("origin", "ri_rh").agg(
        F.count("contract").alias("contracts"),
        F.sum("n").alias("n"),
        F.sum("I17ESTAMOUNT").alias("I17ESTAMOUNT"),
    )


@query
def semi_anti_split(given):
    """Contracts that a table lists, and all others: summed first, split in one pass."""
    df = classify.derive_contract(given.bcm(), "tail2")
    summed = counted(df, ["contract"], ["I17ESTAMOUNT"])
    return lookups.tag_members(summed, given.old_contracts(), "contract", "side", "semi", "anti")


def _closing_curves(given: StarInputs) -> DataFrame:
    return given.curves(locked_in="tyc_shift", current="ycu_31_03")


@query
def origin_discount(given):
    flows = balances.closing_cash_flows(
        given.bcm(), _closing_curves(given), given.rates_close(), given.old_contracts(), PARAMS
    )
    return grouping.group_sum(flows, ["origin", "contract", "lrc_lic"], balances.CLOSE_BCM)


@query
def map_to_account(given):
    df = classify.class_by_date(given.bcm(), PARAMS.opening)
    by_id = dictionary.once(df, ["I17REFOBJID", "I17COSTREVENUE", "lrc_lic"], ["I17ESTAMOUNT"])
    parsed = dictionary.with_parsed(
        by_id, "I17REFOBJID", lambda listed: classify.derive_contract(listed, "segment")
    )
    summed = grouping.group_sum(parsed, balances.CONTRACT_GRAIN, ["I17ESTAMOUNT"])
    mapped = balances.map_to_account(summed, given.portfolios(), given.accounts_by_class())
    return grouping.group_sum(mapped, balances.OPEN_ACCOUNT_GRAIN, ["I17ESTAMOUNT"])


@query
def fanout_lookup(given):
    """Code -> account: one code has two accounts, one has none."""
    summed = counted(given.bcm(), ["I17COSTREVENUE"], ["I17ESTAMOUNT"])
    return lookups.left_lookup(summed, given.accounts_by_code(), ["I17COSTREVENUE"])


def _by_account(given: StarInputs) -> DataFrame:
    """Cash flows summed by code and currency, then by their accounts."""
    summed = counted(given.bcm(), ["I17COSTREVENUE", "I17ESTCURR"], ["I17ESTAMOUNT"])
    return lookups.left_lookup(summed, given.accounts_by_code(), ["I17COSTREVENUE"])


@query
def group_sum_dropnull(given):
    """Unmatched accounts leave the sum; the diagnostic row says how much."""
    return grouping.group_sum(_by_account(given), ["account", "I17ESTCURR"], ["I17ESTAMOUNT"])


@query
def dropped_amounts(given):
    keys = ["account", "I17ESTCURR"]
    return grouping.dropped_by_null_key(_by_account(given), keys, ["I17ESTAMOUNT"], rows="n")


# --- balances -------------------------------------------------------------


def _opening(given: StarInputs, grain) -> DataFrame:
    return balances.bcm_balance_open(
        given.bcm(), given.curves(), given.rates_open(), given.portfolios(),
        given.accounts_by_class(), PARAMS, grain=grain,
    )


@query
def bcm_balance_open(given):
    return _opening(given, balances.OPEN_ACCOUNT_GRAIN)


@query
def bcm_balance_open_by_code(given):
    return _opening(given, balances.OPEN_CODE_GRAIN)


def _closing(given: StarInputs, grain) -> DataFrame:
    return balances.bcm_balance_close(
        given.bcm(), _closing_curves(given), given.rates_close(), given.old_contracts(),
        given.portfolios_by_tail(), given.accounts_by_class(), PARAMS, grain=grain,
    )


@query
def bcm_balance_close(given):
    return _closing(given, balances.CLOSE_ACCOUNT_GRAIN)


@query
def bcm_balance_close_by_code(given):
    return _closing(given, balances.CLOSE_CODE_GRAIN)


@query
def actuals_balance_open(given):
    return balances.actuals_balance_open(
        given.act(), given.portfolios(), given.accounts_by_class()
    )


@query
def actuals_balance_close(given):
    return balances.actuals_balance_close(
        given.act(), given.old_contracts(), given.portfolios_by_tail(),
        given.accounts_by_segment(),
    )


@query
def csm_balance(given):
    return balances.csm_balance(
        [given.csm()], given.rates_close(), given.portfolios(), given.accounts_by_class()
    )


@query
def trv_balance_open(given):
    return balances.csm_balance(
        [given.csm()], given.rates_open(), given.portfolios(), given.accounts_by_class(), "trv"
    )


@query
def npr_grouped(given):
    return balances.npr_charge(
        _opening(given, balances.OPEN_CODE_GRAIN), given.charge_accounts(), PARAMS,
        balances.OPEN_ACCOUNT_GRAIN,
    )


@query
def npr_grouped_close(given):
    return balances.npr_charge(
        _closing(given, balances.CLOSE_CODE_GRAIN), given.charge_accounts(), PARAMS,
        balances.CLOSE_ACCOUNT_GRAIN, discount="discount_current",
    )


def _open_components(given: StarInputs) -> list[DataFrame]:
    portfolios, accounts = given.portfolios(), given.accounts_by_class()
    flows = balances.opening_cash_flows(
        given.bcm(), given.curves(tyc="tyc"), given.rates_open(), PARAMS, "tyc"
    )
    charged = balances.with_charge_rows(
        balances.map_to_account(flows, portfolios, accounts), given.charge_accounts(),
        PARAMS, balances.OPEN_CODE_GRAIN, ["nominal", "discount"], "discount",
    )
    return [
        charged,
        balances.opening_actuals(given.act(), portfolios, accounts),
        balances.margins([given.csm()], given.rates_open(), portfolios, accounts, "trv"),
    ]


@query
def portfolio_balance_open(given):
    return balances.portfolio_balance_open(_open_components(given))


@query
def control_totals(given):
    # Each component is read by itself and by the balance: handed over once.
    each = [tables.hand_off(c) for c in balances.component_balances(_open_components(given))]
    return balances.control_totals(each, balances.portfolio_balance_open(each))


@query
def sign_flag_remap(given):
    # Flags and rows both read the balance. Adaptive execution does not share
    # its last shuffle between them, so the small balance is handed over once.
    balance = tables.hand_off(balances.portfolio_balance_open(_open_components(given)))
    return balances.sign_flag_remap(balance, given.counter_accounts())


@query
def portfolio_balance_close(given):
    old, portfolios = given.old_contracts(), given.portfolios_by_tail()
    flows = balances.closing_cash_flows(
        given.bcm(), _closing_curves(given), given.rates_close(), old, PARAMS
    )
    charged = balances.with_charge_rows(
        balances.map_to_account(flows, portfolios, given.accounts_by_class()),
        given.charge_accounts(), PARAMS, balances.CLOSE_CODE_GRAIN,
        ["nominal_original_CCY", "nominal", "discount_current"], "discount_current",
    )
    actuals = balances.closing_actuals(given.act(), old, portfolios, given.accounts_by_segment())
    return balances.portfolio_balance_close([charged, actuals])


@query
def rowwise_total(given):
    """Row total over columns of which some are null in some rows."""
    summed = (
        given.bcm()
        .groupBy("I17REFOBJID")
        .agg(
            *[
                F.sum(F.when(F.col("I17EXPCHANGE") == e, F.col("I17ESTAMOUNT"))).alias(f"exposure_{e}")
                for e in (10, 60)
            ]
        )
    )
    return grouping.with_total(summed, ["exposure_10", "exposure_60"])


@query
def bcm_balance_open_grains(given):
    return balances.bcm_balance_grains(
        given.bcm(), given.curves(), given.rates_open(), given.portfolios(),
        given.accounts_by_class(), PARAMS,
    )


@query
def data_quality(given):
    """What the opening balance leaves out, counted in the pass that values it."""
    flows = quality.flagged_flows(
        given.bcm(), given.curves(tyc="tyc"), given.rates_open(), given.rates_close(), PARAMS, "tyc"
    )
    return quality.checked_balance(flows, given.portfolios(), given.accounts_by_class())[1]


@query
def checked_balance(given):
    """The balance those checks belong to, at the rates of each exposure."""
    flows = quality.flagged_flows(
        given.bcm(), given.curves(tyc="tyc"), given.rates_open(), given.rates_close(), PARAMS, "tyc"
    )
    return quality.checked_balance(flows, given.portfolios(), given.accounts_by_class())[0]


@query
def exact_totals(given):
    """Totals by currency added as whole numbers: the same bits on any partitioning."""
    amount = money.exact_sum(F.col("I17ESTAMOUNT"))
    return given.bcm().groupBy("I17ESTCURR").agg(amount.alias("I17ESTAMOUNT"))


# --- runs and movements ---------------------------------------------------


@query
def bcm_reduction(given):
    curves = given.curves(locked_in="tyc_shift", tyc="tyc", current="ycu_31_03")
    return runs.bcm_reduction(
        given.bcm(), given.rates_open(), given.rates_close(), curves, PARAMS
    )


def _ir(given: StarInputs) -> DataFrame:
    return runs.opening_rows_of(
        given.bcm_opening_run(), given.rates_open(), given.curves(), PARAMS
    )


def _both_runs(given: StarInputs, periods: list[str] | None = None) -> DataFrame:
    flows, balance = given.bcm_runs(), valuation.balance_rates(given.rates_close())
    if periods is not None:
        flows = movements.by_date(flows, periods, PARAMS)
    return runs.tagged_rows(flows, given.rates_open(), balance, given.curves(), PARAMS)


def _sm(given: StarInputs, make) -> DataFrame:
    balance = valuation.balance_rates(given.rates_close())
    return make(given.bcm_new(), balance, given.curves(), PARAMS)


@query
def ir_rollforward(given):
    return runs.summed_opening(_ir(given), PARAMS)


@query
def sm_closing(given):
    return _sm(given, runs.closing_run)


@query
def bcm_detail(given):
    return runs.ungrouped_detail(given.bcm_new(), given.rates_open(), given.curves(), PARAMS)


@query
def onerous_check(given):
    names = [runs.TYC_SHIFT, runs.YEAR_END_SHIFT, runs.QUARTER_END]
    return runs.onerous_check(given.bcm(), given.rates_open(), given.curves(), names, PARAMS)


@query
def pl_movement_ir(given):
    return movements.movement_ir(
        _ir(given), given.accounts_by_code("IR"), given.rates_close(), PARAMS
    )


@query
def pl_movement_lrc(given):
    return movements.movement_lrc_of(
        _both_runs(given), given.accounts_by_code("LRC"), given.rates_close(), PARAMS
    )


@query
def pl_movement_lic_past(given):
    return movements.movement_lic_past_of(
        _both_runs(given, [PARAMS.past_label]), given.accounts_by_code("LIC"),
        given.rates_close(), PARAMS, chosen=True,
    )


@query
def pl_movement_lic_current(given):
    return movements.movement_lic_current(
        _sm(given, runs.closing_rows), given.accounts_by_code("LICQ1"),
        given.rates_close(), PARAMS,
    )


# --- ledger ---------------------------------------------------------------


@query
def ledger_totals(given):
    return ledger.ledger_totals(given.ledger_a())


@query
def ledger_reconcile(given):
    return ledger.ledger_reconcile(given.ledger_a(), given.ledger_b())


@query
def outer_recon(given):
    """The same two extracts by account and segment."""
    keys = ["G/L Account", "NewGL Segment"]
    return grouping.reconcile(given.ledger_a(), given.ledger_b(), keys, ledger.AMOUNT)


def _raw_extract(given: StarInputs) -> DataFrame:
    """Orders under technical field names, amounts as text with trailing minus."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    plain = F.concat(
        (cents / 100).cast("bigint").cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    amount = F.when(F.col("o_orderkey") % 2 == 1, F.concat(plain, F.lit("-"))).otherwise(plain)
    known = {
        "/BA1/K5SAMBAL": amount,
        "/BA1C/BTTRAMTC": amount,
        "AARIGLAC": F.concat(F.lit("I"), (F.col("o_custkey") % 99).cast("string")),
        "/BA1C/BTPOSTDT": F.date_format("o_orderdate", "yyyyMMdd"),
        "/BA1/BIL_CURR": F.lit("EUR"),
    }
    return given.table("orders").select(
        *[known.get(f, F.lit(None).cast("string")).alias(f) for f in schemas.LEDGER_FIELDS]
    )


def _field_dictionary(spark: SparkSession) -> DataFrame:
    named = {
        "/BA1/K5SAMBAL": schemas.FUNCTIONAL_AMOUNT,
        "/BA1C/BTTRAMTC": schemas.TRANSACTION_AMOUNT,
        "AARIGLAC": "G/L Account",
        "/BA1C/BTPOSTDT": "Posting Date",
        "/BA1/BIL_CURR": "Currency",
    }
    rows = ", ".join(
        f"('{f}', '{named.get(f, 'Field ' + f)}', {i})" for i, f in enumerate(schemas.LEDGER_FIELDS)
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(Field, Name, Position)")


def _extract_totals(raw: DataFrame, given: StarInputs) -> DataFrame:
    named = ledger.ledger_extract(raw, _field_dictionary(given.spark))
    return named.groupBy(F.col("`G/L Account`").alias("account")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(f"`{schemas.FUNCTIONAL_AMOUNT}`").alias("functional"),
        F.sum(f"`{schemas.TRANSACTION_AMOUNT}`").alias("transaction"),
    )


@query
def trailing_minus_parse(given):
    return _extract_totals(_raw_extract(given), given)


@query
def headerless_scan(given):
    """The extract through headerless files, names from the field dictionary."""
    path = fresh_path(given.spark, "extract")
    _raw_extract(given).write.csv(path, sep=";", header=False)
    names = delimited.field_names(_field_dictionary(given.spark))
    return _extract_totals(delimited.read_headerless(given.spark, path, names), given)


@query
def ledger_project(given):
    """Wanted columns of the files, written to one folder by file name and read back."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    path = fresh_path(given.spark, "by-source")
    delimited.write_by_source(ledger.ledger_project(given.table("orders"), columns), path)
    schema = "src string, o_orderkey bigint, o_custkey bigint, o_totalprice double"
    files = delimited.read_delimited(given.spark, path, schema, decimal=".")
    return files.groupBy("src", (F.col("o_custkey") % 99).alias("account")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("amount")
    )


def _assigned(df: DataFrame, source: str, *kept: str) -> DataFrame:
    """Portfolio-lookup input: the assigned portfolio is null for suffixed ids."""
    ref, number = F.col(source), F.substring_index(ids.stem(F.col(source)), "_", -1).cast("int")
    bare = F.concat(F.lit("CZR_ACP_"), ids.contract(ref, "segment"))
    return df.select(
        F.when(~F.contains(ref, F.lit("/")) & (number % 2 == 0), bare).alias(
            "Assigned Portfolio (Profit Recognition)"
        ),
        ref.alias("Contract/Portfolio"),
        F.concat(F.lit("LP"), (number % 7).cast("string")).alias("Local Portfolio"),
        *kept,
    )


@query
def portfolio_lookup(given):
    """Payments counted by contract, then placed; pairs of contract and portfolio are distinct.

    Ids are reduced to different ones before anything is made of them.
    """
    listed = dictionary.once(given.bcm(), ["I17REFOBJID"])
    found = ledger.portfolio_lookup(_assigned(listed, "I17REFOBJID"))
    paid = dictionary.once(given.act(), ["I17PORTID"])
    placed = ledger.enrich_with_portfolio(_assigned(paid, "I17PORTID", dictionary.ROWS).drop("Local Portfolio"), found)
    return placed.groupBy("contract", "local_portfolio").agg(F.sum(dictionary.ROWS).alias("n"))


@query
def code_totals(given):
    return ledger.code_totals(given.bcm())


@query
def contract_totals(given):
    return ledger.contract_totals(given.bcm())


@query
def single_contract(given):
    chosen = ledger.single_contract(given.bcm(), "CZR_ACP_PRI_P500_1998_NO_80")
    return counted(
        chosen, ["I17REFOBJID", "I17COSTREVENUE", "I17ESTCURR", "I17EXPCHANGE"], ["I17ESTAMOUNT"]
    )


# --- primitives -----------------------------------------------------------


@query
def distinct_pairs(given):
    df = classify.derive_contract(given.bcm(), "segment")
    placed = lookups.left_lookup(
        grouping.distinct_pairs(df, ["contract", "I17COSTREVENUE"]), given.portfolios(), ["contract"]
    )
    return grouping.distinct_pairs(placed, ["local_portfolio", "I17COSTREVENUE"])


@query
def union_books(given):
    """Cash flows and actual payments; the payments lack the currency."""
    flows = given.bcm().select("I17COSTREVENUE", "I17ESTCURR", "I17ESTAMOUNT")
    paid = given.act().select(
        F.col("I17CFTYPE").alias("I17COSTREVENUE"), F.col("I17VALUE").alias("I17ESTAMOUNT")
    )
    books = grouping.union_books([flows, paid])
    return counted(books, ["I17COSTREVENUE", "I17ESTCURR"], ["I17ESTAMOUNT"])


@query
def sample_scan(given):
    """The first 1,000 order rows by key, as a trial sample."""
    return tables.first_rows(
        given.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), 1000, "o_orderkey"
    )


@query
def ffill(given):
    """Order rows with blanked labels, filled along the order key."""
    key = F.col("o_orderkey")
    df = given.table("orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 5).alias("grp"),
        F.when(key % 7 == 0, F.col("o_orderpriority")).alias("label"),
        F.when(key % 11 == 0, F.col("o_totalprice")).alias("amount"),
    )
    sliced = fill.with_slices(df, "o_orderkey")
    whole = fill.fill_slices(sliced, "o_orderkey", ["label"])
    return fill.fill_slices(whole, "o_orderkey", ["amount"], ["grp"]).drop("_slice")


@query
def ffill_ties(given):
    """Filled along the order date, on which many orders fall: the order key decides between them."""
    df = given.table("orders").select(
        "o_orderkey",
        "o_orderdate",
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderpriority")).alias("label"),
        F.when(F.col("o_orderkey") % 11 == 0, F.col("o_totalprice")).alias("amount"),
    )
    return fill.forward_fill(df, ["o_orderdate", "o_orderkey"], ["label", "amount"]).drop("o_orderdate")


def _comma_files(given: StarInputs) -> str:
    path = fresh_path(given.spark, "cashflows")
    delimited.write_delimited(given.bcm(), path)
    return path


@query
def scan_decimal_comma(given):
    """Cash flows through semicolon files with decimal comma, then by code."""
    read = delimited.read_delimited(given.spark, _comma_files(given), schemas.CASH_FLOWS)
    return ledger.code_totals(read).withColumnRenamed("I17ESTAMOUNT", "amount")


@query
def csv_sink_roundtrip(given):
    """A result table written as delimited text and read back unchanged."""
    path = fresh_path(given.spark, "balance")
    delimited.write_delimited(bcm_balance_open(given), path)
    schema = "ri_rh string, zivot_nezivot string, local_portfolio string, account string, " + ", ".join(
        f"{m} double" for m in balances.OPEN_BCM
    )
    return delimited.read_delimited(given.spark, path, schema)


@query
def scan_decimal_point(given):
    """The same through comma files with decimal point."""
    path = fresh_path(given.spark, "cashflows")
    delimited.write_delimited(given.bcm(), path, sep=",", decimal=".")
    read = delimited.read_delimited(given.spark, path, schemas.CASH_FLOWS, sep=",", decimal=".")
    return ledger.code_totals(read).withColumnRenamed("I17ESTAMOUNT", "amount")


@query
def decimal_scan(given):
    """Ledger amounts as exact decimals, through files with decimal comma."""
    amount = F.col("o_totalprice").cast("decimal(18,2)").alias("amount")
    posted = given.table("orders").select(_account().alias("account"), amount)
    path = fresh_path(given.spark, "decimals")
    delimited.write_delimited(posted, path)
    read = delimited.read_delimited(given.spark, path, "account string, amount decimal(18,2)")
    return read.groupBy("account").agg(F.sum("amount").cast("double").alias("amount"))


def _account() -> Column:
    return F.concat(F.lit("I"), (F.col("o_custkey") % 99).cast("string"))


@query
def nan_as_null(given):
    """Every fifth amount of an extract is the text NaN; sums leave it out."""
    amount = F.when(F.col("o_orderkey") % 5 == 0, F.lit("NaN")).otherwise(
        F.translate(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), ".", ",")
    )
    path = fresh_path(given.spark, "nan")
    posted = given.table("orders").select(_account().alias("account"), amount.alias("amount"))
    posted.write.csv(path, sep=";", header=True)
    read = delimited.read_delimited(given.spark, path, "account string, amount double")
    return grouping.group_sum(read, ["account"], ["amount"])


@query
def result_table_roundtrip(given):
    """A balance as result table in one folder for each segment, and read back."""
    path = fresh_path(given.spark, "result")
    tables.write_result(bcm_balance_open(given), path, partition_by=["ri_rh"])
    read = tables.read_result(given.spark, path)
    return read.select("ri_rh", *[c for c in read.columns if c != "ri_rh"])


@query
def ccy_rounding_base(given):
    """The second currency set: whole base-currency amounts for four currencies."""
    rated = valuation.with_rate(given.bcm(), given.rates_open(), PARAMS.base_currency)
    nominal = money.divide(F.col("I17ESTAMOUNT"), F.col("EXCHANGE_RATE"))
    whole = valuation.round_currencies(
        rated.withColumn("nominal", nominal), WHOLE_EUR_CURRENCIES, ["nominal"]
    )
    return grouping.group_sum(whole, ["I17ESTCURR"], ["nominal"])


@query
def run_hand_off(given):
    """Both runs summed and handed over once, then read by a movement."""
    keys = ["run", *runs.RUN_KEYS]
    summed = grouping.group_sum(_both_runs(given), keys, runs.run_measures(runs.CLOSING_CURVES))
    held = tables.hand_off(summed)
    ir, sm = (held.filter(F.col("run") == name) for name in (runs.OPENING, runs.CLOSING))
    return movements.movement_lrc(
        ir, sm, given.accounts_by_code("LRC"), given.rates_close(), PARAMS
    )
