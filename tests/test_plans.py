"""Valuation, balances, runs and movements on small worked examples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from closebook import schemas
from closebook.operators import classify, valuation
from closebook.params import CloseParams
from closebook.plans import balances, ledger, movements, runs

PARAMS = CloseParams()
FIRST = "CZR_ACP_PRI_P500_2020_NO_320"
SECOND = "CZR_ACP_LRH_L510_2021_ON_10260/1"
NAMES = runs.CLOSING_CURVES


def flow(ref=FIRST, exposure=60, code="Y204", ccy="EUR", incurred=20220215, settled=20220415, amount=100.0):
    return (exposure, 20220331, ref, code, ccy, incurred, settled, amount)


@pytest.fixture
def book(frame):
    return lambda *flows: frame(list(flows), schemas.CASH_FLOWS)


@pytest.fixture
def rates(frame):
    return frame([("CZK", 4.0), ("TWD", 8.0), ("HUF", 5.0)], schemas.OPENING_RATES)


@pytest.fixture
def closing_rates(frame):
    return frame(
        [("CZK", 5.0, "M"), ("CZK", 2.0, "AVG"), ("TWD", 8.0, "M"), ("TWD", 4.0, "AVG")],
        schemas.CLOSING_RATES,
    )


@pytest.fixture
def curves(frame):
    """Factor 0.9 for curve 1, 0.8 for curve 2 and so on, at two month ends."""
    files = {}
    for k, name in enumerate(NAMES, 1):
        factor = 1 - k / 10
        if k % 2:
            nodes = [(day, c, factor) for day in (20220331, 20211231) for c in ("EUR", "CZK", "TWD", "HUF")]
            files[name] = frame(nodes, schemas.CURVE_INT_DATES)
        else:
            nodes = [(day, c, factor) for day in ("31.03.2022", "31.12.2021") for c in ("EUR", "CZK", "TWD", "HUF")]
            files[name] = frame(nodes, schemas.CURVE_TEXT_DATES)
    return valuation.wide_curves(files)


def test_wide_curves(frame, curves, rows):
    assert curves.count() == 8
    row = curves.filter("I17ESTCURR = 'CZK' AND date_adjusted = DATE'2022-03-31'").first()
    assert [round(row[f"factor_{n}"], 9) for n in NAMES] == [0.9, 0.8, 0.7, 0.6, 0.5]
    twice = frame([(20220331, "EUR", 0.9), (20220331, "EUR", 0.8)], schemas.CURVE_INT_DATES)
    with pytest.raises(Exception, match="duplicate date and currency"):
        valuation.wide_curves({"tyc": twice}).collect()


def _valued(book, rates, curves, names, rounded=False, date=PARAMS.opening):
    df = valuation.with_rate(valuation.with_aligned_date(book, PARAMS), rates, "EUR")
    df = valuation.with_factors(df, curves, names, date)
    return valuation.rounded_present_values(df, names, PARAMS) if rounded else valuation.present_values(df, names)


def test_present_value_and_override(book, rates, curves):
    # 15 April goes back to 31 March (factor .9); 30 December to 30 November (none);
    # 31 December is the calculation date (factor 1).
    flows = book(flow(ccy="CZK"), flow(settled=20211230), flow(settled=20211231))
    found = {r.I17SETTLEMDATE: r for r in _valued(flows, rates, curves, ["tyc"]).collect()}
    assert (found[20220415].nominal, round(found[20220415].discount_tyc, 9)) == (25.0, -2.5)
    assert round(found[20220415].discount_tyc_original_CCY, 9) == -10.0
    assert found[20211230].discount_tyc is None
    assert found[20211231].discount_tyc == 0.0


def test_missing_values_count_as_zero_when_rounded(book, rates, curves):
    flows = book(flow(settled=20211130), flow(ccy="XXX"))
    found = {r.I17ESTCURR: r for r in _valued(flows, rates, curves, ["tyc"], rounded=True).collect()}
    assert (found["EUR"].nominal, found["EUR"].discount_tyc) == (100.0, -100.0)
    assert (found["XXX"].nominal, found["XXX"].discount_tyc) == (0.0, 0.0)
    assert found["XXX"].discount_tyc_original_CCY == -100.0


def test_rounding_order(book, rates, curves):
    flows = book(flow(ccy="TWD", amount=100.5), flow(ccy="HUF", amount=12.5), flow(ccy="CZK", amount=12.5))
    found = {r.I17ESTCURR: r for r in _valued(flows, rates, curves, ["ycu_31_03"], rounded=True).collect()}
    twd = found["TWD"]  # factor .5: EUR nominal unrounded, original 100, cash 50, EUR cash 6.25 -> 6
    assert (twd.nominal, twd.nominal_original_CCY) == (12.5625, 100.0)
    assert (twd.discount_ycu_31_03_original_CCY, twd.discount_ycu_31_03) == (-50.0, 6 - 12.5625)
    huf = found["HUF"]  # cash 6.25 -> 6 in HUF, EUR from the unrounded 6.25
    assert (huf.discount_ycu_31_03_original_CCY, huf.discount_ycu_31_03) == (-6.5, -1.25)
    assert found["CZK"].discount_ycu_31_03_original_CCY == -6.25


def test_rates_by_exposure_and_sets(book, rates, closing_rates, rows):
    flows = book(flow(ccy="CZK", exposure=10), flow(ccy="CZK"), flow(ccy="EUR"), flow(ccy="CZK", exposure=20))
    rated = valuation.with_rate_by_exposure(flows, rates, closing_rates, PARAMS)
    assert rows(rated.select("I17EXPCHANGE", "I17ESTCURR", "EXCHANGE_RATE")) == [
        (10, "CZK", 4.0), (60, "CZK", 5.0), (60, "EUR", 1.0),
    ]
    assert rows(valuation.average_rates(closing_rates, PARAMS)) == [("CZK", 2.0), ("EUR", 1.0), ("TWD", 4.0)]


def test_classes(book, frame, rows):
    flows = book(flow(incurred=20211231), flow(incurred=20220101))
    by_date = classify.class_by_date(flows, PARAMS.opening)
    assert rows(by_date.select("I17INCURREDDATE", "lrc_lic")) == [(20211231, "LIC"), (20220101, "LRC")]
    past = PARAMS.past_label
    run = frame(
        [("Y204", past, "Q1"), ("Y204", "Q1", past), ("Y100", past, "Q1"), ("Y100", "Q1", "Q2"), ("Y999", past, past)],
        "I17COSTREVENUE string, settlement string, incurred string",
    )
    select = ["I17COSTREVENUE", "settlement", "date_select", "lrc_lic"]
    opening = classify.class_by_code(run, PARAMS, False).select(*select)
    assert rows(opening) == [
        ("Y100", "Q1", "Q1", "LRC"), ("Y100", past, past, "LIC"),
        ("Y204", "Q1", past, "LIC"), ("Y204", past, "Q1", "LRC"), ("Y999", past, None, "LRC"),
    ]
    closing = classify.class_by_code(run, PARAMS, True).select(*select)
    assert [r[3] for r in rows(closing)] == ["LIC", "LIC", "LIC", "LIC", "LRC"]


def test_whole_unit_helper_and_npr(frame):
    df = frame([("HUF", 2.5), ("CZK", 2.5)], "I17ESTCURR string, nominal double")
    out = valuation.round_currencies(df, ["HUF"], ["nominal"]).orderBy("I17ESTCURR").collect()
    assert [r.nominal for r in out] == [2.5, 2.0]
    df = frame(
        [("Y103", 100.0, -10.0), ("Z103", 100.0, -10.0), (None, 1.0, 1.0)],
        "I17COSTREVENUE string, nominal double, discount_a double",
    )
    found = [round(r.npr_a, 9) for r in valuation.npr_columns(df, ["a"], PARAMS).collect()]
    assert found == [-0.27, 0.0, 0.0]


def test_shift_correction(frame):
    schema = "settlement string, " + ", ".join(
        f"discount_{n}{s} double" for n in ("a", "b") for s in ("", "_original_CCY")
    )
    df = frame([("Q1", 1.0, 2.0, 3.0, 4.0), ("Q2", 1.0, 2.0, 3.0, 4.0), (None, 1.0, 2.0, 3.0, 4.0)], schema)
    out = valuation.shift_correction(df, {"b": "a"}).collect()
    assert [(r.discount_b, r.discount_b_original_CCY) for r in out] == [(1.0, 2.0), (3.0, 4.0), (3.0, 4.0)]


# --- balances -----------------------------------------------------------------


@pytest.fixture
def lookups(frame):
    portfolios = frame(
        [("RI", "PRI_2020_NO_320", "LP1"), ("RH", "LRH_2021_ON_10260", "LP1"), ("x", "NO_320", "LP1"), ("x", "ON_10260", "LP2")],
        "s string, contract string, local_portfolio string",
    ).drop("s")
    accounts = frame(
        [("Y204", s, c, f"{s}{c}") for s in ("RI", "RH") for c in ("LRC", "LIC")], schemas.ACCOUNT_BY_CLASS
    )
    charges = frame([("LRC", "RILRC"), ("LIC", "N")], schemas.ACCOUNT_OF_CHARGE)
    old = frame([("NO_320",)], schemas.OLD_CONTRACTS)
    return portfolios, accounts, charges, old


def test_opening_balance_and_charge(book, rates, curves, lookups, rows):
    portfolios, accounts, charges, _ = lookups
    flows = book(
        flow(ccy="CZK"), flow(ccy="CZK", incurred=20211201), flow(ref=SECOND, ccy="CZK"),
        flow(code="Y999", ccy="CZK"), flow(ref="CZR_ACP_PRI_P500_2020_NO_1", ccy="CZK"), flow(ccy="XXX"),
    )
    args = (flows, curves, rates, portfolios, accounts, PARAMS)
    balance = balances.bcm_balance_open(*args)
    assert [r[:6] for r in rows(balance)] == [
        ("RH", "zivot", "LP1", "RHLRC", 100.0, 25.0),
        ("RI", "nezivot", "LP1", "RILIC", 100.0, 25.0),
        ("RI", "nezivot", "LP1", "RILRC", 200.0, 25.0),
    ]
    codes = balances.bcm_balance_open(*args, grain=balances.OPEN_CODE_GRAIN)
    separate = balances.npr_charge(codes, charges, PARAMS, balances.OPEN_ACCOUNT_GRAIN)
    mapped = balances.map_to_account(
        balances.opening_cash_flows(flows, curves, rates, PARAMS, "tyc"), portfolios, accounts
    )
    one_pass = balances.with_charge_rows(
        mapped, charges, PARAMS, balances.OPEN_CODE_GRAIN, ["nominal", "discount"], "discount"
    )
    total = balances.portfolio_balance_open([one_pass])
    kept = total.filter("npr <> 0").select(*balances.OPEN_ACCOUNT_GRAIN, F.round("npr", 9).alias("npr"))
    assert rows(kept) == rows(separate.withColumn("npr", F.round("npr", 9)))
    assert {round(r[4], 6) for r in rows(separate)} == {round(-0.003 * 22.5, 6)}
    only_rh = balances.npr_charge(codes, charges, PARAMS, balances.OPEN_ACCOUNT_GRAIN, segments=["RH"])
    assert [r[0] for r in rows(only_rh)] == ["RH"]
    each = balances.component_balances([one_pass])
    good = balances.portfolio_balance_open(each)

    def totals(balance):
        found = balances.control_totals(each, balance).collect()
        return {r.stage: r.total_balance for r in found}

    stages = totals(good)
    assert stages["before"] == pytest.approx(stages["after"]) and stages["before"] != 0
    # A lookup row that is there twice, or a key that gets lost, shows.
    doubled = totals(good.unionByName(good.limit(1)))
    assert doubled["before"] != pytest.approx(doubled["after"])
    twice = balances.portfolio_balance_open([*each, each[0]])
    assert totals(twice)["before"] != pytest.approx(totals(twice)["after"])
    lost = totals(good.filter(F.col("account") != good.first().account))
    assert lost["before"] != pytest.approx(lost["after"])


def test_closing_balance_by_origin(book, closing_rates, frame, lookups, rows):
    portfolios, accounts, _, old = lookups
    day = [(20220430, "CZK", 0.9)]
    curves = valuation.wide_curves(
        {"locked_in": frame(day, schemas.CURVE_INT_DATES), "current": frame([(20220430, "CZK", 0.6)], schemas.CURVE_INT_DATES)}
    )
    flows = book(
        flow(ccy="CZK", settled=20220430), flow(ref=SECOND, ccy="CZK", settled=20220430),
        flow(ccy="CZK", settled=20220430, exposure=10),
    )
    out = balances.bcm_balance_close(flows, curves, closing_rates, old, portfolios, accounts, PARAMS)
    assert [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(out)] == [
        ("new", "RH", "zivot", "Y204", "RHLIC", 100.0, 20.0, -8.0, -8.0),
        ("old", "RI", "nezivot", "Y204", "RILIC", 100.0, 20.0, -2.0, -8.0),
    ]


def test_actuals_and_margin(frame, lookups, closing_rates, rows):
    portfolios, accounts, _, old = lookups
    act = frame([(FIRST, "Y204", 10.0, 2.0), (SECOND, "Y204", 1.0, 1.0)], schemas.ACTUALS)
    assert rows(balances.actuals_balance_open(act, portfolios, accounts)) == [
        ("RH", "zivot", "LP1", "RHLIC", -1.0, -1.0), ("RI", "nezivot", "LP1", "RILIC", -10.0, -2.0),
    ]
    by_segment = accounts.filter("lrc_lic = 'LIC'").drop("lrc_lic")
    closing = balances.actuals_balance_close(act, old, portfolios, by_segment)
    assert [r[0] for r in rows(closing)] == ["new", "old"]
    csm = frame([("CZR_ACP_PRI_2020_NO_320", "Y204", "CZK", 20.0)], schemas.MARGINS)
    out = balances.csm_balance([csm], closing_rates, portfolios, accounts)
    # Two rate types in the table: the amount counts under both.
    assert rows(out) == [("RI", "nezivot", "LP1", "RILRC", 40.0, 14.0)]


def test_sign_flags_fan_out(frame, rows):
    balance = frame(
        [("RI", "z", "LP1", "A", 10.0), ("RH", "z", "LP1", "B", 5.0), ("RI", "z", "LP2", "A", -1.0), ("RI", "z", "LP3", "D", 2.0)],
        "ri_rh string, zivot_nezivot string, local_portfolio string, account string, total_balance double",
    )
    counters = frame([("A", "CA"), ("B", "CB")], schemas.COUNTER_ACCOUNTS)
    # LP1 has a flagged and an unflagged segment, so its rows count under both.
    assert rows(balances.sign_flag_remap(balance, counters)) == [
        ("A", 9.0), ("B", 5.0), ("CA", 10.0), ("CB", 5.0),
    ]
    own = balances.sign_flag_remap(balance, counters, ("ri_rh", "local_portfolio"))
    assert rows(own) == [("A", -1.0), ("B", 5.0), ("CA", 10.0)]


# --- runs and movements ---------------------------------------------------------


@pytest.fixture
def two_runs(book, rates, closing_rates, curves):
    opening = book(flow(exposure=10, incurred=20211115, settled=20211231), flow(exposure=10, ccy="CZK"))
    new = book(
        flow(exposure=10, ccy="CZK"), flow(ccy="CZK", incurred=20211001), flow(code="Y100"),
        flow(code="Y999", ccy="TWD", incurred=20230101), flow(ref=SECOND, code="Y103", settled=20220228),
        flow(code=None),
    )
    balance = valuation.balance_rates(closing_rates)
    both = opening.withColumn("run", F.lit(runs.OPENING)).unionByName(
        new.withColumn("run", F.when(F.col("I17EXPCHANGE") == 10, runs.OPENING).otherwise(runs.CLOSING))
    )
    return {
        "tagged": runs.tagged_rows(both, rates, balance, curves, PARAMS),
        "ir": runs.opening_rollforward(opening, new, rates, curves, PARAMS),
        "ir_rows": runs.opening_rows(opening, new, rates, curves, PARAMS),
        "sm": runs.closing_run(new, balance, curves, PARAMS),
        "sm_rows": runs.closing_rows(new, balance, curves, PARAMS),
    }


def test_runs(two_runs):
    ir = {(r.I17ESTCURR, r.settlement): r for r in two_runs["ir"].collect()}
    assert set(ir) == {("EUR", PARAMS.past_label), ("CZK", "Q1")}
    both = ir[("CZK", "Q1")]  # opening row plus late row
    assert (both.nominal, both.nominal_original_CCY) == (50.0, 200.0)
    assert both.discount_tyc_shift == both.discount_tyc
    assert both.npr_tyc == pytest.approx(-0.003 * 45)
    sm = two_runs["sm"].collect()
    assert {r.I17COSTREVENUE for r in sm} == {"Y204", "Y100", "Y999", "Y103", "0"}
    assert all(r.I17EXPCHANGE == 60 for r in sm)


@pytest.mark.parametrize("name", ["ir", "lrc", "lic_past", "lic_current"])
def test_movements_from_rows_equal_those_from_runs(two_runs, frame, closing_rates, rows, name):
    accounts = frame(
        [("Y204", "A"), ("Y204", "B"), ("Y100", "C"), ("Y103", "D")], schemas.ACCOUNT_BY_CODE
    )
    def make(ir, sm):
        if name == "ir":
            return movements.movement_ir(ir, accounts, closing_rates, PARAMS)
        if name == "lic_current":
            return movements.movement_lic_current(sm, accounts, closing_rates, PARAMS)
        chosen = movements.movement_lrc if name == "lrc" else movements.movement_lic_past
        return chosen(ir, sm, accounts, closing_rates, PARAMS)

    def rounded(df):
        return rows(df.select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in df.dtypes]))

    summed = rounded(make(two_runs["ir"], two_runs["sm"]))
    assert summed and summed == rounded(make(two_runs["ir_rows"], two_runs["sm_rows"]))
    if name in ("lrc", "lic_past"):
        chosen = movements.movement_lrc_of if name == "lrc" else movements.movement_lic_past_of
        assert summed == rounded(chosen(two_runs["tagged"], accounts, closing_rates, PARAMS))


def test_movement_values(two_runs, frame, closing_rates):
    accounts = frame([("Y204", "A"), ("Y204", "B"), ("Y100", "C")], schemas.ACCOUNT_BY_CODE)
    past = movements.movement_lic_past(two_runs["ir"], two_runs["sm"], accounts, closing_rates, PARAMS)
    found = {(r.account, r.I17ESTCURR): r for r in past.collect()}
    assert set(found) == {(a, c) for a in "AB" for c in ("EUR", "CZK")}
    assert found[("A", "CZK")].amount == 50.0  # 100 CZK at the average rate 2
    assert found[("A", "EUR")].amount == -100.0  # only in the opening run
    lrc = movements.movement_lrc(two_runs["ir"], two_runs["sm"], accounts, closing_rates, PARAMS)
    codes = {r.I17COSTREVENUE: r for r in lrc.collect()}
    assert codes["Y999"].account is None and codes["Y999"].amount == 25.0
    assert "Y204" not in codes


def test_reduction_and_detail(book, rates, closing_rates, curves):
    flows = book(flow(ccy="CZK", exposure=10), flow(ccy="CZK"), flow(settled=20211015))
    wide = curves.withColumnsRenamed({"factor_tyc_shift": "factor_locked_in", "factor_ycu_31_03": "factor_current"})
    out = {(r.I17EXPCHANGE, r.settlement): r for r in runs.bcm_reduction(flows, rates, closing_rates, wide, PARAMS).collect()}
    assert set(out) == {(10, "Q1"), (60, "Q1"), (60, "2021")}
    assert (out[(10, "Q1")].nominal, out[(60, "Q1")].nominal) == (25.0, 20.0)
    assert out[(60, "Q1")].discount_tyc == 0.0  # settled at the calculation date
    assert out[(60, "2021")].discount_tyc == 0.0  # no factor: skipped
    detail = runs.ungrouped_detail(flows, rates, curves, PARAMS).collect()
    assert len(detail) == 1 and detail[0].npr_tyc == pytest.approx(-0.003 * 22.5)


def test_onerous(book, rates, curves):
    flows = book(
        flow(exposure=10, amount=-100.0), flow(exposure=10, ref=FIRST.replace("NO", "ON"), amount=-50.0),
        flow(exposure=10, ref=SECOND), flow(exposure=10, ref=FIRST.replace("320", "321")),
    )
    found = {r.contract: r for r in runs.onerous_check(flows, rates, curves, ["tyc"], PARAMS).collect()}
    assert set(found) == {"2020_NO_320", "2021_ON_10260"}
    assert found["2020_NO_320"].on_no_should_be_tyc == "ON"
    assert found["2020_NO_320"].csm_tyc == pytest.approx(-90 + 0.27)
    assert found["2021_ON_10260"].on_no_should_be_tyc == "NO"


# --- ledger -------------------------------------------------------------------------


def test_portfolio_lookup(frame, rows):
    schema = "`Assigned Portfolio (Profit Recognition)` string, `Contract/Portfolio` string, `Local Portfolio` string"
    source = frame(
        [
            (None, SECOND, "LP1"), (None, FIRST, "LP2"), ("CZR_ACP_LRI_2021_NO_5", SECOND, "LP3"),
            (None, FIRST, "LP2"), (None, None, "LP4"), (None, FIRST, None),
        ],
        schema,
    )
    lookup = ledger.portfolio_lookup(source)
    assert rows(lookup) == [("LRH_2021_ON_10260", "LP1"), ("LRI_2021_NO_5", "LP3"), ("PRI_2020_NO_320", "LP2")]
    assert ledger.enrich_with_portfolio(source, lookup).filter("local_portfolio IS NULL").count() == 1


def test_ledger_zero_sum_and_code_totals(frame, book, rows):
    posted = frame(
        [("20220331", "Y1", "S1", "A", 10.0), ("20220331", "Y1", "S2", "B", -10.0), ("20220331", "Y1", "S2", None, 1.0)],
        schemas.LEDGER,
    )
    assert rows(ledger.ledger_totals(posted)) == [("A", "S1", 10.0), ("B", "S2", -10.0)]
    both = ledger.ledger_reconcile(posted, posted).agg(F.sum("amount_x"), F.sum("amount_y")).first()
    assert tuple(both) == (0.0, 0.0)
    flows = book(flow(), flow(amount=1.0), flow(ref=SECOND))
    assert rows(ledger.code_totals(flows)) == [("Y204", 201.0)]
    assert ledger.contract_totals(ledger.single_contract(flows, FIRST)).first()[1] == 101.0


def test_rows_chosen_by_date_are_those_of_the_labels(spark, book, rates, closing_rates, curves, frame, rows, tmp_path):
    days = [20191231, 20211230, 20211231, 20220130, 20220131, 20220315, 20220429, 20220430, 20221231, 20230601]
    flows = [
        flow(code=code, exposure=exposure, incurred=a, settled=b, amount=float(i + 1))
        for i, (a, b) in enumerate((a, b) for a in days for b in days)
        for code in ("Y204", "Y100", "Y999", None) for exposure in (10, 60)
    ]
    book(*flows).write.parquet(str(tmp_path / "flows"))
    stored = spark.read.parquet(str(tmp_path / "flows"))
    accounts = frame([("Y204", "A1"), ("Y100", "A2")], "I17COSTREVENUE string, account string")
    single = valuation.balance_rates(closing_rates)
    past, early = PARAMS.past_label, movements.FIRST_QUARTER

    def opening(df):
        return runs.opening_rows_of(df.filter("I17EXPCHANGE = 10"), rates, curves, PARAMS)

    def closing(df):
        return runs.closing_rows(df, single, curves, PARAMS)

    def both(df):
        tagged = df.withColumn("run", F.when(F.col("I17EXPCHANGE") == 10, runs.OPENING).otherwise(runs.CLOSING))
        return runs.tagged_rows(tagged, rates, single, curves, PARAMS)

    for make, movement, periods in (
        (opening, movements.movement_ir, [past, early]),
        (both, movements.movement_lic_past_of, [past]),
        (closing, movements.movement_lic_current, [early]),
    ):
        labelled = movement(make(stored), accounts, closing_rates, PARAMS)
        cut = movements.by_date(stored, periods, PARAMS)
        chosen = movement(make(cut), accounts, closing_rates, PARAMS, chosen=True)
        cents = [[F.round(c, 2).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes] for df in (chosen, labelled)]
        assert rows(chosen.select(*cents[0])) == rows(labelled.select(*cents[1])) and chosen.count() > 0
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        pushed = plan[plan.index("PushedFilters:"):].split("ReadSchema")[0]
        assert "LessThan(I17SETTLEMDATE" in pushed and "LessThan(I17INCURREDDATE" in pushed
    with pytest.raises(ValueError, match="single range"):
        movements.by_date(stored, ["Q3"], PARAMS)
