"""SQL statement for each named query, written from the accounting rules.

The statements spell the rules out literally: successive joins, full outer
joins and repeated grouping, where the Spark plans use unions and one sum.
"""

from __future__ import annotations

STATEMENTS: dict[str, str] = {}

_ALIGNED = "CAST(date_trunc('month', CAST({0} AS DATE) + INTERVAL 1 DAY) - INTERVAL 1 DAY AS DATE)"
_CODES = (
    "['Y204','Z204','Y220','Z220','Y600','Z600','Z400','Y400',"
    "'Z303','Y303','Y100','Z100','Y103','Z103','Y999','Y500']"
)
_SEGMENTS = "['PRI','PRH','LRI','LRH']"
_CURRENCIES = "['EUR','CZK','HUF','TWD','JPY','KRW','ISK','USD','XXX']"
_INCURRED = "('Y204','Z204','Y220','Z220','Y600','Z600','Z400','Y400','Z303','Y303')"
_SETTLEMENT = "('Y100','Z100','Y103','Z103')"
_NPR = "('Y103','Y204','Y220')"
_PAST, _FUTURE = "till 31.12.1997", "from 1.1.1999"
_OPENING, _CLOSING = "DATE '1997-12-31'", "DATE '1998-03-31'"
_CURVES = ("tyc", "ycu_31_12", "tyc_shift", "ycu_31_12_shift", "ycu_31_03")


def _ymd(x: str) -> str:
    return f"CAST(year({x})*10000 + month({x})*100 + day({x}) AS BIGINT)"


def _money(x: str, digits: int = 2) -> str:
    """Rounded; adding zero turns a negative zero into a plain one."""
    return f"(round(CAST({x} AS DOUBLE), {digits}) + 0)"


def _sum(x: str, name: str | None = None, digits: int = 2) -> str:
    return f"{_money(f'coalesce(sum({x}), 0)', digits)} AS {name or x}"


def _stem(x: str) -> str:
    return f"split_part({x}, '/', 1)"


def _form_segment(x: str) -> str:
    parts = f"string_split({_stem(x)}, '_')"
    return f"({parts}[3] || '_' || array_to_string({parts}[5:7], '_'))"


def _form_tail(x: str, n: int) -> str:
    return f"array_to_string(string_split({_stem(x)}, '_')[-{n}:], '_')"


def _ri_rh(x: str) -> str:
    return f"substr(split_part({x}, '_', 3), 2, 2)"


def _life(x: str) -> str:
    return f"CASE WHEN substr(split_part({x}, '_', 3), 1, 1) = 'L' THEN 'zivot' ELSE 'nezivot' END"


# --- shared views -----------------------------------------------------------

_VIEWS: dict[str, str] = {}

_VIEWS["bcm0"] = f"""
SELECT
  CASE WHEN l_orderkey % 197 <> 3 THEN
    'CZR_ACP_' || ({_SEGMENTS})[l_suppkey % 4 + 1] || '_P' || (500 + l_partkey % 5) || '_' || year(o_orderdate)
    || '_' || CASE WHEN l_returnflag = 'R' THEN 'ON' ELSE 'NO' END || '_' || (l_partkey % 200)
    || CASE WHEN l_linenumber % 3 = 0 THEN '/1' ELSE '' END END AS I17REFOBJID,
  CASE WHEN l_orderkey % 181 = 11 THEN 70 WHEN l_linestatus = 'F' THEN 10 ELSE 60 END AS I17EXPCHANGE,
  CASE WHEN l_orderkey % 193 <> 5 THEN ({_CODES})[l_partkey % 16 + 1] END AS I17COSTREVENUE,
  year(o_orderdate) * 10000 + 1231 AS I17KEYDATE,
  CASE WHEN l_orderkey % 191 <> 7 THEN ({_CURRENCIES})[s_nationkey % 9 + 1] END AS I17ESTCURR,
  {_ymd('o_orderdate')} AS I17INCURREDDATE,
  {_ymd('l_shipdate')} AS I17SETTLEMDATE,
  l_extendedprice * (1 - 2 * (l_linenumber % 2)) AS I17ESTAMOUNT,
  CAST(o_orderdate AS DATE) AS incurred_day,
  {_ALIGNED.format('l_shipdate')} AS date_adjusted,
  {_ALIGNED.format('o_orderdate')} AS incurred_adjusted
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""


def _bucket(day: str) -> str:
    return (
        f"CASE WHEN year({day}) < 1998 THEN '{_PAST}' WHEN year({day}) > 1998 THEN '{_FUTURE}' "
        f"WHEN month({day}) <= 3 THEN 'Q1' WHEN month({day}) <= 6 THEN 'Q2' "
        f"WHEN month({day}) <= 9 THEN 'Q3' ELSE 'Q4' END"
    )


def _year_bucket(day: str) -> str:
    return (
        f"CASE WHEN year({day}) <> 1998 THEN CAST(year({day}) AS VARCHAR) "
        f"ELSE 'Q' || CAST(quarter({day}) AS VARCHAR) END"
    )


_VIEWS["bcm"] = f"""
SELECT *, {_bucket('date_adjusted')} AS settlement, {_bucket('incurred_adjusted')} AS incurred,
  CASE WHEN I17COSTREVENUE IN {_INCURRED} THEN {_bucket('incurred_adjusted')}
       WHEN I17COSTREVENUE IN {_SETTLEMENT} THEN {_bucket('date_adjusted')} END AS date_select
FROM bcm0"""

_VIEWS["nodes"] = f"""
SELECT day, ccy FROM (
  SELECT DISTINCT {_ALIGNED.format('l_shipdate')} AS day FROM lineitem
) CROSS JOIN (SELECT unnest({_CURRENCIES}) AS ccy) WHERE month(day) <> 11"""

for _k, _name in enumerate(_CURVES, 1):
    _VIEWS[f"curve_{_name}"] = f"""
SELECT day, ccy, CAST(997 AS DOUBLE) / (997 + 2 * {_k} * (12 * year(day) + month(day) - 23976)) AS factor
FROM nodes"""

_VIEWS["fx_base"] = """
SELECT * FROM (VALUES ('EUR',1.0::DOUBLE),('CZK',5.0::DOUBLE),('HUF',7.0::DOUBLE),('TWD',9.0::DOUBLE),
  ('JPY',11.0::DOUBLE),('KRW',13.0::DOUBLE),('ISK',15.0::DOUBLE),('USD',17.0::DOUBLE)) AS t(ccy, rate)"""
_VIEWS["fx_open"] = "SELECT ccy, CASE WHEN ccy = 'USD' THEN 0 ELSE rate END AS rate FROM fx_base"
_VIEWS["fx_close"] = """
SELECT ccy, base_rate + 2 AS rate, 'M' AS type FROM (SELECT ccy, rate AS base_rate FROM fx_base WHERE ccy <> 'EUR')
UNION ALL
SELECT ccy, rate + 4, 'AVG' FROM fx_base WHERE ccy <> 'EUR'"""
_VIEWS["fx_avg"] = """
SELECT ccy, rate FROM fx_close WHERE type = 'AVG' UNION ALL SELECT 'EUR', 1"""

_VIEWS["codes"] = f"SELECT unnest({_CODES}) AS code"
_VIEWS["by_class"] = """
SELECT code, ri_rh, lrc_lic, 'I' || code || ri_rh || lrc_lic AS account
FROM codes, (VALUES ('RI'),('RH')) a(ri_rh), (VALUES ('LRC'),('LIC')) b(lrc_lic) WHERE code <> 'Y999'"""
_VIEWS["by_segment"] = """
SELECT code, ri_rh, 'I' || code || ri_rh || 'LIC' AS account
FROM codes, (VALUES ('RI'),('RH')) a(ri_rh) WHERE code <> 'Y999'"""
_VIEWS["charges"] = """
SELECT * FROM (VALUES ('LRC','IY500RILRC'),('LIC','NPRLIC')) AS t(lrc_lic, account)"""
_VIEWS["counters"] = """
SELECT account, 'C' || account AS counter_account FROM by_class WHERE code <> 'Y500'
UNION ALL SELECT 'NPRLIC', 'CNPRLIC'"""
_VIEWS["numbers"] = """
SELECT n, marker FROM range(200) t(n), (VALUES ('ON'),('NO')) m(marker)"""
_VIEWS["portfolios"] = f"""
SELECT seg || '_' || y || '_' || marker || '_' || n AS contract, 'LP' || (n % 7) AS local_portfolio
FROM numbers, (SELECT unnest({_SEGMENTS}) AS seg), (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
WHERE n % 11 <> 0"""
_VIEWS["tail_portfolios"] = """
SELECT marker || '_' || n AS contract, 'LP' || (n % 7) AS local_portfolio FROM numbers WHERE n % 11 <> 0"""
_VIEWS["old"] = "SELECT marker || '_' || n AS contract FROM numbers WHERE n % 3 = 0"

_VIEWS["act0"] = f"""
SELECT 'CZR_ACP_' || ({_SEGMENTS})[o_custkey % 4 + 1] || '_P' || (500 + o_custkey % 5) || '_' || year(o_orderdate)
    || '_' || CASE WHEN o_orderstatus = 'F' THEN 'ON' ELSE 'NO' END || '_' || (o_custkey % 200)
    || CASE WHEN o_orderkey % 3 = 0 THEN '/1' ELSE '' END AS id,
  ({_CODES})[o_custkey % 16 + 1] AS code,
  o_totalprice * (1 - 2 * (o_orderkey % 2)) AS v FROM orders"""
_VIEWS["csm0"] = f"""
SELECT 'CZR_ACP_' || ({_SEGMENTS})[o_custkey % 4 + 1] || '_' || year(o_orderdate)
    || '_' || CASE WHEN o_orderstatus = 'F' THEN 'ON' ELSE 'NO' END || '_' || (o_custkey % 200) AS id,
  ({_SEGMENTS})[o_custkey % 4 + 1] || '_' || year(o_orderdate)
    || '_' || CASE WHEN o_orderstatus = 'F' THEN 'ON' ELSE 'NO' END || '_' || (o_custkey % 200) AS contract,
  ({_CODES})[o_custkey % 16 + 1] AS code, ({_CURRENCIES})[o_custkey % 9 + 1] AS ccy, o_totalprice AS v
FROM orders"""

for _name, _account in (
    ("ledger_a", "CASE WHEN o_custkey % 99 >= 96 THEN 'S0' ELSE 'I' || (o_custkey % 99) END"),
    ("ledger_b", "CASE WHEN o_custkey % 99 < 3 THEN 'S1' ELSE 'I' || (o_custkey % 99) END"),
):
    _VIEWS[_name] = f"""
SELECT {_account} AS account, ({_SEGMENTS})[o_orderkey % 4 + 1] AS seg,
  o_totalprice * (1 - 2 * (o_orderkey % 2)) AS amount FROM orders"""


def _pv(names: tuple[str, ...], rates: str, date: str, base: bool, source: str, curves=None) -> str:
    """Present values by successive curve joins; missing values stay null."""
    curves = curves or {n: n for n in names}
    rate = "CASE WHEN I17ESTCURR = 'EUR' THEN 1 ELSE nullif(f.rate, 0) END" if base else "nullif(f.rate, 0)"
    joins = "".join(
        f"\nLEFT JOIN curve_{curves[n]} c_{n} ON c_{n}.day = b.date_adjusted AND c_{n}.ccy = b.I17ESTCURR"
        for n in names
    )
    factors = "".join(
        f", CASE WHEN b.date_adjusted = {date} THEN 1 ELSE c_{n}.factor END AS f_{n}" for n in names
    )
    values = "".join(
        f", f_{n} * I17ESTAMOUNT / xr - I17ESTAMOUNT / xr AS discount_{n}"
        f", f_{n} * I17ESTAMOUNT - I17ESTAMOUNT AS discount_{n}_original_CCY"
        for n in names
    )
    return (
        f"SELECT *, I17ESTAMOUNT AS nominal_original_CCY, I17ESTAMOUNT / xr AS nominal{values} FROM ("
        f"SELECT b.*, {rate} AS xr{factors} FROM {source} b LEFT JOIN {rates} f ON f.ccy = b.I17ESTCURR{joins})"
    )


def _rounded_pv(names: tuple[str, ...], rates: str, source: str) -> str:
    """Present values with whole-unit currencies, missing values as zero."""
    twd, units = "I17ESTCURR = 'TWD'", "I17ESTCURR IN ('TWD','HUF','ISK','JPY','KRW')"
    joins = "".join(
        f"\nLEFT JOIN curve_{n} c_{n} ON c_{n}.day = b.date_adjusted AND c_{n}.ccy = b.I17ESTCURR" for n in names
    )
    factors = "".join(
        f", CASE WHEN b.date_adjusted = {_OPENING} THEN 1 ELSE c_{n}.factor END AS f_{n}" for n in names
    )
    step1 = (
        f"SELECT b.*, CASE WHEN I17ESTCURR = 'EUR' THEN 1 ELSE nullif(f.rate, 0) END AS xr{factors} "
        f"FROM {source} b LEFT JOIN {rates} f ON f.ccy = b.I17ESTCURR{joins}"
    )
    step2 = (
        "SELECT *, coalesce(I17ESTAMOUNT / xr, 0) AS nominal, "
        f"coalesce(CASE WHEN {twd} THEN round_even(I17ESTAMOUNT, 0) ELSE I17ESTAMOUNT END, 0) AS nominal_original_CCY "
        f"FROM ({step1})"
    )
    step3 = "SELECT *" + "".join(f", f_{n} * nominal_original_CCY AS o_{n}" for n in names) + f" FROM ({step2})"
    step4 = "SELECT *" + "".join(
        f", coalesce(CASE WHEN {units} THEN round_even(o_{n}, 0) ELSE o_{n} END, 0) AS d_{n}"
        f", coalesce(CASE WHEN {twd} THEN round_even(o_{n} / xr, 0) ELSE o_{n} / xr END, 0) AS e_{n}"
        for n in names
    ) + f" FROM ({step3})"
    return "SELECT *" + "".join(
        f", e_{n} - nominal AS discount_{n}, d_{n} - nominal_original_CCY AS discount_{n}_original_CCY" for n in names
    ) + f" FROM ({step4})"


_VIEWS["bcm_open"] = "SELECT * REPLACE (10 AS I17EXPCHANGE) FROM bcm"
_VIEWS["bcm_new"] = "SELECT * FROM bcm"
_OPEN4 = _CURVES[:4]


def _measures(names: tuple[str, ...]) -> list[str]:
    return ["nominal", "nominal_original_CCY"] + [
        f"discount_{n}{s}" for s in ("", "_original_CCY") for n in names
    ]


_RUN = "I17REFOBJID, I17EXPCHANGE, I17COSTREVENUE, I17KEYDATE, I17ESTCURR, settlement, incurred"


def _shifted(source: str, names: tuple[str, ...]) -> str:
    fixes = []
    for shifted, plain in (("tyc_shift", "tyc"), ("ycu_31_12_shift", "ycu_31_12")):
        for s in ("", "_original_CCY"):
            fixes.append(
                f"CASE WHEN settlement = 'Q1' THEN discount_{plain}{s} ELSE discount_{shifted}{s} END AS discount_{shifted}{s}"
            )
    return f"SELECT * REPLACE ({', '.join(fixes)}) FROM ({source})"


def _grouped(source: str, keys: str, measures: list[str]) -> str:
    sums = ", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in measures)
    whole = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"SELECT {keys}, {sums} FROM ({source}) WHERE {whole} GROUP BY {keys}"


def _filled(source: str) -> str:
    """Rows of a run: a missing id, code or currency becomes the key '0'."""
    keys = ("I17REFOBJID", "I17COSTREVENUE", "I17ESTCURR")
    return f"SELECT * REPLACE ({', '.join(f"coalesce({k}, '0') AS {k}" for k in keys)}) FROM ({source})"


_VIEWS["ir_opening"] = _grouped(_filled(_rounded_pv(_OPEN4, "fx_open", "bcm_open")), _RUN, _measures(_OPEN4))
_VIEWS["bcm_new10"] = "SELECT * FROM bcm_new WHERE I17EXPCHANGE = 10"
_VIEWS["bcm_new60"] = "SELECT * FROM bcm_new WHERE I17EXPCHANGE = 60"
_VIEWS["ir_late"] = _grouped(_filled(_rounded_pv(_OPEN4, "fx_open", "bcm_new10")), _RUN, _measures(_OPEN4))
_VIEWS["fx_m"] = "SELECT ccy, rate FROM fx_close WHERE type = 'M'"
_VIEWS["ir"] = _shifted(
    "SELECT " + ", ".join(f"coalesce(x.{k}, y.{k}) AS {k}" for k in _RUN.split(", ")) + ", "
    + ", ".join(f"coalesce(x.{m}, 0) + coalesce(y.{m}, 0) AS {m}" for m in _measures(_OPEN4))
    + " FROM ir_opening x FULL OUTER JOIN ir_late y ON "
    + " AND ".join(f"x.{k} = y.{k}" for k in _RUN.split(", ")),
    _OPEN4,
)
_VIEWS["sm"] = _shifted(
    _grouped(_filled(_rounded_pv(_CURVES, "fx_m", "bcm_new60")), _RUN, _measures(_CURVES)), _CURVES
)

# The key '0' of a missing id has no parts.
_SHORT = (
    f"CASE WHEN I17REFOBJID <> '0' THEN split_part({_stem('I17REFOBJID')}, '_', 3) || '_' "
    f"|| {_form_tail('I17REFOBJID', 3)} END"
)
_SELECT = (
    f"CASE WHEN I17COSTREVENUE IN {_INCURRED} THEN incurred "
    f"WHEN I17COSTREVENUE IN {_SETTLEMENT} THEN settlement END"
)
_VIEWS["ir_class"] = f"""
SELECT *, {_SHORT} AS contract, {_SELECT} AS date_select,
  CASE WHEN {_SELECT} = '{_PAST}' THEN 'LIC' ELSE 'LRC' END AS lrc_lic FROM ir"""
_VIEWS["sm_class"] = f"""
SELECT *, {_SHORT} AS contract, {_SELECT} AS date_select,
  CASE WHEN {_SELECT} IN ('{_PAST}', 'Q1') THEN 'LIC' ELSE 'LRC' END AS lrc_lic FROM sm"""

# --- opening and closing balances as views ----------------------------------

_VIEWS["open_pv"] = _pv(("tyc",), "fx_open", _OPENING, False, "bcm")
_VIEWS["open_pre"] = f"""
SELECT {_ri_rh('I17REFOBJID')} AS ri_rh, {_life('I17REFOBJID')} AS zivot_nezivot,
  {_form_segment('I17REFOBJID')} AS contract, I17COSTREVENUE,
  CASE WHEN incurred_day <= {_OPENING} THEN 'LIC' ELSE 'LRC' END AS lrc_lic,
  coalesce(sum(nominal_original_CCY), 0) AS nominal_original_CCY, coalesce(sum(nominal), 0) AS nominal,
  coalesce(sum(discount_tyc), 0) AS discount, coalesce(sum(I17ESTAMOUNT), 0) AS I17ESTAMOUNT
FROM open_pv GROUP BY ALL"""


def _mapped(source: str, portfolios: str, accounts: str, by_class: bool) -> str:
    extra = " AND a.lrc_lic = m.lrc_lic" if by_class else ""
    return (
        f"SELECT m.*, p.local_portfolio, a.account FROM {source} m LEFT JOIN {portfolios} p ON p.contract = m.contract "
        f"LEFT JOIN {accounts} a ON a.code = m.I17COSTREVENUE AND a.ri_rh = m.ri_rh{extra}"
    )


_VIEWS["open_mapped"] = _mapped("open_pre", "portfolios", "by_class", True)
_OPEN_GRAIN = "ri_rh, zivot_nezivot, local_portfolio, account"
_OPEN_CODES = "ri_rh, zivot_nezivot, I17COSTREVENUE, local_portfolio, lrc_lic"
_OPEN_M = ["nominal_original_CCY", "nominal", "discount"]
_VIEWS["bcm_o"] = _grouped(
    "SELECT * FROM open_mapped WHERE local_portfolio IS NOT NULL AND account IS NOT NULL", _OPEN_GRAIN, _OPEN_M
)
_VIEWS["codes_o"] = _grouped(
    "SELECT * FROM open_mapped WHERE local_portfolio IS NOT NULL", _OPEN_CODES, _OPEN_M
)
_VIEWS["npr_o"] = f"""
SELECT ri_rh, zivot_nezivot, local_portfolio, c.account, sum((nominal + discount) * 0.003 * -1) AS npr
FROM codes_o m LEFT JOIN charges c ON c.lrc_lic = m.lrc_lic
WHERE I17COSTREVENUE IN {_NPR} AND c.account IS NOT NULL GROUP BY ALL"""
_VIEWS["act_pre"] = f"""
SELECT {_ri_rh('id')} AS ri_rh, {_life('id')} AS zivot_nezivot, {_form_segment('id')} AS contract,
  code AS I17COSTREVENUE, 'LIC' AS lrc_lic, sum(-v) AS actuals_CCY, sum(-(v / 7)) AS actuals FROM act0 GROUP BY ALL"""
_VIEWS["act_mapped"] = _mapped("act_pre", "portfolios", "by_class", True)
_VIEWS["act_o"] = _grouped(
    "SELECT * FROM act_mapped WHERE local_portfolio IS NOT NULL AND account IS NOT NULL",
    _OPEN_GRAIN, ["actuals_CCY", "actuals"],
)
for _name, _rates in (("trv", "fx_open"), ("csm", "fx_close")):
    _VIEWS[f"{_name}_pre"] = f"""
SELECT {_ri_rh('id')} AS ri_rh, {_life('id')} AS zivot_nezivot, contract, code AS I17COSTREVENUE, 'LRC' AS lrc_lic,
  coalesce(sum(v), 0) AS {_name}_original_CCY, coalesce(sum(v / nullif(f.rate, 0)), 0) AS {_name}
FROM csm0 LEFT JOIN {_rates} f ON f.ccy = csm0.ccy GROUP BY ALL"""
    _VIEWS[f"{_name}_mapped"] = _mapped(f"{_name}_pre", "portfolios", "by_class", True)
    _VIEWS[f"{_name}_o"] = _grouped(
        f"SELECT * FROM {_name}_mapped WHERE local_portfolio IS NOT NULL AND account IS NOT NULL",
        _OPEN_GRAIN, [f"{_name}_original_CCY", _name],
    )
_VIEWS["open_aligned"] = """
SELECT *, coalesce(nominal, 0) + coalesce(discount, 0) + coalesce(actuals, 0) + coalesce(trv, 0) + coalesce(npr, 0) AS total_balance
FROM bcm_o FULL OUTER JOIN act_o USING (ri_rh, zivot_nezivot, local_portfolio, account)
FULL OUTER JOIN trv_o USING (ri_rh, zivot_nezivot, local_portfolio, account)
FULL OUTER JOIN npr_o USING (ri_rh, zivot_nezivot, local_portfolio, account)"""

_VIEWS["bcm60"] = f"""
SELECT *, {_form_tail('I17REFOBJID', 2)} AS contract FROM bcm WHERE I17EXPCHANGE = 60"""
_VIEWS["bcm60_old"] = "SELECT * FROM bcm60 WHERE contract IN (SELECT contract FROM old)"
_VIEWS["bcm60_new"] = "SELECT * FROM bcm60 WHERE contract NOT IN (SELECT contract FROM old)"
_CLOSE_M = ["nominal_original_CCY", "nominal", "discount_locked_in", "discount_current"]
_VIEWS["close_rows"] = (
    "SELECT 'old' AS origin, * FROM (SELECT * FROM ("
    + _pv(("locked_in", "current"), "fx_m", _CLOSING, True, "bcm60_old",
          {"locked_in": "tyc_shift", "current": "ycu_31_03"})
    + ")) UNION ALL BY NAME SELECT 'new' AS origin, *, discount_current AS discount_locked_in FROM ("
    + _pv(("current",), "fx_m", _CLOSING, True, "bcm60_new", {"current": "ycu_31_03"})
    + ")"
)
_VIEWS["close_pre"] = f"""
SELECT origin, {_ri_rh('I17REFOBJID')} AS ri_rh, {_life('I17REFOBJID')} AS zivot_nezivot, contract, I17COSTREVENUE,
  CASE WHEN incurred_day <= {_CLOSING} THEN 'LIC' ELSE 'LRC' END AS lrc_lic,
  {', '.join(f'coalesce(sum({m}), 0) AS {m}' for m in _CLOSE_M)}
FROM close_rows GROUP BY ALL"""
_VIEWS["close_mapped"] = _mapped("close_pre", "tail_portfolios", "by_class", True)
_CLOSE_GRAIN = "origin, ri_rh, zivot_nezivot, I17COSTREVENUE, account"
_CLOSE_CODES = "origin, ri_rh, zivot_nezivot, I17COSTREVENUE, local_portfolio, lrc_lic"
_VIEWS["bcm_c"] = _grouped("SELECT * FROM close_mapped WHERE account IS NOT NULL", _CLOSE_GRAIN, _CLOSE_M)
_VIEWS["codes_c"] = _grouped(
    "SELECT * FROM close_mapped WHERE local_portfolio IS NOT NULL", _CLOSE_CODES, _CLOSE_M
)
_VIEWS["npr_c"] = f"""
SELECT origin, ri_rh, zivot_nezivot, I17COSTREVENUE, c.account, sum((nominal + discount_current) * 0.003 * -1) AS npr
FROM codes_c m LEFT JOIN charges c ON c.lrc_lic = m.lrc_lic
WHERE I17COSTREVENUE IN {_NPR} AND c.account IS NOT NULL GROUP BY ALL"""
_VIEWS["act_close_pre"] = f"""
SELECT CASE WHEN o.contract IS NOT NULL THEN 'old' ELSE 'new' END AS origin, a.* FROM (
  SELECT {_ri_rh('id')} AS ri_rh, {_life('id')} AS zivot_nezivot, {_form_tail('id', 2)} AS contract,
    code AS I17COSTREVENUE, sum(-v) AS actuals_CCY, sum(-(v / 7)) AS actuals FROM act0 GROUP BY ALL
) a LEFT JOIN old o ON o.contract = a.contract"""
_VIEWS["act_close_mapped"] = _mapped("act_close_pre", "tail_portfolios", "by_segment", False)
_VIEWS["act_c"] = _grouped(
    "SELECT * FROM act_close_mapped WHERE account IS NOT NULL", _CLOSE_GRAIN, ["actuals_CCY", "actuals"]
)
_VIEWS["close_aligned"] = """
SELECT *, coalesce(nominal, 0) + coalesce(discount_current, 0) + coalesce(actuals, 0) + coalesce(npr, 0) AS total_balance
FROM bcm_c FULL OUTER JOIN act_c USING (origin, ri_rh, zivot_nezivot, I17COSTREVENUE, account)
FULL OUTER JOIN npr_c USING (origin, ri_rh, zivot_nezivot, I17COSTREVENUE, account)"""


def _needs(text: str, found: set[str]) -> None:
    import re

    words = set(re.findall(r"[A-Za-z_0-9]+", text))
    for name in _VIEWS:
        if name in words and name not in found:
            found.add(name)
            _needs(_VIEWS[name], found)


def _state(key: str, body: str) -> None:
    """Register a statement with the views it uses, in definition order."""
    found: set[str] = set()
    _needs(body, found)
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in _VIEWS if name in found)
    STATEMENTS[key] = f"WITH {ctes}\n{body}" if ctes else body


def _count(keys: str, measures=("I17ESTAMOUNT",), source="bcm", where="", extra="") -> str:
    sums = "".join(f", {_sum(m)}" for m in measures)
    names = keys
    return f"SELECT {names}, count(*) AS n{sums}{extra} FROM {source} {where} GROUP BY ALL"


# --- statements ---------------------------------------------------------------

_state("contract_keys", f"""
SELECT I17REFOBJID, count(*) AS n, {_sum('I17ESTAMOUNT')},
  {_form_segment('I17REFOBJID')} AS contract_segment, {_form_tail('I17REFOBJID', 3)} AS contract_tail3,
  {_form_tail('I17REFOBJID', 2)} AS contract_tail2, {_SHORT} AS contract_segment_tail,
  array_to_string(string_split({_stem('I17REFOBJID')}, '_')[3:], '_') AS contract_from_segment,
  array_to_string(string_split(I17REFOBJID, '_')[3:6], '_') AS contract_portfolio,
  {_life('I17REFOBJID')} AS zivot_nezivot, {_ri_rh('I17REFOBJID')} AS ri_rh,
  split_part(I17REFOBJID, '_', 6) AS on_no
FROM bcm GROUP BY I17REFOBJID""")
_state("month_end_align", _count(f"I17SETTLEMDATE, {_ymd('date_adjusted')} AS date_adjusted"))
_state("period_bucket_year", _count(
    f"{_year_bucket('date_adjusted')} AS settlement, {_year_bucket('incurred_adjusted')} AS incurred", source="bcm0"))
_state("period_bucket_window", _count("settlement, incurred"))
_state("value_map", _count(
    "CASE WHEN year(date_adjusted) = 1998 THEN 'Q' || quarter(date_adjusted) "
    "ELSE strftime(date_adjusted, '%Y%m%d') END AS period"))
_state("lrc_lic_by_date", _count(
    f"CASE WHEN incurred_day <= {_OPENING} THEN 'LIC' ELSE 'LRC' END AS lrc_lic, I17COSTREVENUE"))
_state("lrc_lic_by_code", _count(
    f"I17COSTREVENUE, settlement, incurred, date_select, "
    f"CASE WHEN date_select = '{_PAST}' THEN 'LIC' ELSE 'LRC' END AS lrc_lic_opening, "
    f"CASE WHEN date_select IN ('{_PAST}', 'Q1') THEN 'LIC' ELSE 'LRC' END AS lrc_lic"))
_state("null_safe_not_equal", _count(
    "I17COSTREVENUE, date_select", where="WHERE date_select IS DISTINCT FROM 'Q1'"))

_state("fx_convert", f"""
SELECT I17ESTCURR, count(*) AS n, {_sum('I17ESTAMOUNT')},
  {_money('sum(I17ESTAMOUNT / nullif(o.rate, 0))')} AS nominal_table,
  CASE WHEN I17ESTCURR = 'EUR' THEN 1 ELSE max(m.rate) END AS EXCHANGE_RATE,
  {_money("sum(I17ESTAMOUNT / CASE WHEN I17ESTCURR = 'EUR' THEN 1 ELSE m.rate END)")} AS nominal_forced
FROM bcm LEFT JOIN fx_open o ON o.ccy = I17ESTCURR LEFT JOIN fx_m m ON m.ccy = I17ESTCURR GROUP BY I17ESTCURR""")
_state("fx_by_exposure", f"""
SELECT CAST(I17EXPCHANGE AS BIGINT) AS I17EXPCHANGE, I17ESTCURR, count(*) AS n, {_sum('I17ESTAMOUNT')}, {_sum('x', 'nominal')} FROM (
  SELECT b.*, I17ESTAMOUNT / CASE WHEN I17ESTCURR = 'EUR' THEN 1 ELSE nullif(f.rate, 0) END AS x
  FROM bcm b LEFT JOIN fx_open f ON f.ccy = I17ESTCURR WHERE I17EXPCHANGE = 10
  UNION ALL
  SELECT b.*, I17ESTAMOUNT / CASE WHEN I17ESTCURR = 'EUR' THEN 1 ELSE nullif(f.rate, 0) END AS x
  FROM bcm b LEFT JOIN fx_m f ON f.ccy = I17ESTCURR WHERE I17EXPCHANGE = 60) GROUP BY ALL""")
_state("fx_average_set", f"""
SELECT I17ESTCURR, count(*) AS n, {_sum('I17ESTAMOUNT')}, max(rate) AS EXCHANGE_RATE,
  {_money('sum(I17ESTAMOUNT / rate)')} AS nominal
FROM bcm LEFT JOIN fx_avg ON ccy = I17ESTCURR GROUP BY I17ESTCURR""")
_state("wide_curves", f"""
SELECT {_ymd('t.day')} AS date_adjusted, t.ccy AS I17ESTCURR, {', '.join(f'round(t.factor, 9) AS factor_{n}' if n == 'tyc' else f'round({n}.factor, 9) AS factor_{n}' for n in _CURVES)}
FROM curve_tyc t {' '.join(f'JOIN curve_{n} {n} ON {n}.day = t.day AND {n}.ccy = t.ccy' for n in _CURVES[1:])}""")
_by_year = "I17ESTCURR, CAST(year(date_adjusted) AS BIGINT) AS year"
_state("discount_pv", f"""
SELECT {_by_year}, {', '.join(_sum(m) for m in _measures(_CURVES))}
FROM ({_pv(_CURVES, 'fx_open', _OPENING, True, 'bcm')}) WHERE I17ESTCURR IS NOT NULL GROUP BY ALL""")
_state("ccy_rounding", f"""
SELECT {_by_year}, {', '.join(_sum(m) for m in _measures(_CURVES))}
FROM ({_rounded_pv(_CURVES, 'fx_open', 'bcm')}) WHERE I17ESTCURR IS NOT NULL GROUP BY ALL""")
_npr_col = "CASE WHEN I17COSTREVENUE IN " + _NPR + " THEN (nominal + discount_{0}) * -1 * 0.003 ELSE 0 END"
_state("npr_inline", f"""
SELECT I17COSTREVENUE, I17ESTCURR, settlement, {', '.join(_sum(_npr_col.format(n), f'npr_{n}', 6) for n in _OPEN4)}
FROM ({_filled(_rounded_pv(_OPEN4, 'fx_open', 'bcm'))}) GROUP BY ALL""")
_state("shift_correction", f"""
SELECT I17COSTREVENUE, I17ESTCURR, settlement, {', '.join(_sum(m) for m in _measures(_OPEN4)[2:])}
FROM ({_filled(_shifted(_rounded_pv(_OPEN4, 'fx_open', 'bcm'), _OPEN4))}) GROUP BY ALL""")

_state("tag_origin", f"""
SELECT CASE WHEN o.contract IS NOT NULL THEN 'old' ELSE 'new' END AS origin, {_ri_rh('I17REFOBJID')} AS ri_rh,
  count(DISTINCT b.contract) AS contracts, count(*) AS n, {_sum('I17ESTAMOUNT')}
FROM (SELECT *, {_form_tail('I17REFOBJID', 2)} AS contract FROM bcm) b LEFT JOIN old o ON o.contract = b.contract GROUP BY 1, 2""")
_state("semi_anti_split", f"""
SELECT CASE WHEN contract IN (SELECT contract FROM old) THEN 'semi' ELSE 'anti' END AS side, contract,
  count(*) AS n, {_sum('I17ESTAMOUNT')} FROM (SELECT *, {_form_tail('I17REFOBJID', 2)} AS contract FROM bcm) GROUP BY ALL""")
_state("origin_discount", f"""
SELECT origin, contract, lrc_lic, {', '.join(_sum(m) for m in _CLOSE_M)} FROM close_pre
WHERE contract IS NOT NULL AND I17COSTREVENUE IS NOT NULL GROUP BY ALL""")
_state("map_to_account", f"""
SELECT {_OPEN_GRAIN}, {_sum('I17ESTAMOUNT')} FROM open_mapped
WHERE local_portfolio IS NOT NULL AND account IS NOT NULL GROUP BY ALL""")
_VIEWS["a_accounts"] = """
SELECT code, 'A' || code AS account FROM codes WHERE code <> 'Y999' UNION ALL SELECT 'Y204', 'AY204B'"""
_state("fanout_lookup", f"""
SELECT I17COSTREVENUE, account, count(*) AS n, {_sum('I17ESTAMOUNT')}
FROM bcm LEFT JOIN a_accounts ON code = I17COSTREVENUE GROUP BY ALL""")
_state("group_sum_dropnull", f"""
SELECT account, I17ESTCURR, {_sum('I17ESTAMOUNT')}
FROM bcm JOIN a_accounts ON code = I17COSTREVENUE WHERE I17ESTCURR IS NOT NULL GROUP BY ALL""")
_state("dropped_amounts", f"""
SELECT count(*) AS rows_dropped, {_sum('I17ESTAMOUNT')} FROM bcm LEFT JOIN a_accounts ON code = I17COSTREVENUE
WHERE account IS NULL OR I17ESTCURR IS NULL""")

_state("bcm_balance_open", f"SELECT {_OPEN_GRAIN}, {', '.join(f'{_money(m)} AS {m}' for m in _OPEN_M)} FROM bcm_o")
_state("bcm_balance_open_by_code", f"SELECT {_OPEN_CODES}, {', '.join(f'{_money(m)} AS {m}' for m in _OPEN_M)} FROM codes_o")
_state("bcm_balance_open_grains", f"""
SELECT 'account' AS grain, ri_rh, zivot_nezivot, local_portfolio, account, NULL AS I17COSTREVENUE, NULL AS lrc_lic,
  {', '.join(f'{_money(m)} AS {m}' for m in _OPEN_M)} FROM bcm_o
UNION ALL
SELECT 'code', ri_rh, zivot_nezivot, local_portfolio, NULL, I17COSTREVENUE, lrc_lic,
  {', '.join(f'{_money(m)} AS {m}' for m in _OPEN_M)} FROM codes_o""")
_VIEWS["flagged"] = f"""
SELECT b.*, coalesce(I17EXPCHANGE IN (10, 60), false) AS kept,
  CASE WHEN I17ESTCURR = 'EUR' THEN 1 WHEN I17EXPCHANGE = 10 THEN o.rate WHEN I17EXPCHANGE = 60 THEN m.rate END AS rate,
  CASE WHEN date_adjusted = {_OPENING} THEN 1 ELSE c.factor END AS factor,
  {_ri_rh('I17REFOBJID')} AS ri_rh, {_life('I17REFOBJID')} AS zivot_nezivot, {_form_segment('I17REFOBJID')} AS contract,
  CASE WHEN incurred_day <= {_OPENING} THEN 'LIC' ELSE 'LRC' END AS lrc_lic
FROM bcm b LEFT JOIN fx_open o ON o.ccy = I17ESTCURR LEFT JOIN fx_m m ON m.ccy = I17ESTCURR
LEFT JOIN curve_tyc c ON c.day = date_adjusted AND c.ccy = I17ESTCURR"""
_VIEWS["flagged_mapped"] = _mapped("flagged", "portfolios", "by_class", True)
_state("data_quality", " UNION ALL ".join(
    f"SELECT '{name}' AS check, count(*) AS n, {_sum('I17ESTAMOUNT', 'amount')} FROM flagged_mapped WHERE {condition}"
    for name, condition in (
        ("rows", "true"),
        ("other_exposure", "NOT kept"),
        ("missing_rate", "kept AND rate IS NULL"),
        ("zero_rate", "kept AND rate = 0"),
        ("missing_factor", "kept AND factor IS NULL"),
        ("no_portfolio", "kept AND local_portfolio IS NULL"),
        ("no_account", "kept AND account IS NULL"),
    )
))
_state("checked_balance", f"""
SELECT {_OPEN_GRAIN}, {_sum('I17ESTAMOUNT', 'nominal_original_CCY')}, {_sum('I17ESTAMOUNT / nullif(rate, 0)', 'nominal')},
  {_sum('factor * I17ESTAMOUNT / nullif(rate, 0) - I17ESTAMOUNT / nullif(rate, 0)', 'discount')}
FROM (SELECT * REPLACE (CASE WHEN kept THEN I17ESTAMOUNT END AS I17ESTAMOUNT) FROM flagged_mapped)
WHERE ri_rh IS NOT NULL AND local_portfolio IS NOT NULL AND account IS NOT NULL GROUP BY ALL""")
_state("exact_totals", f"SELECT I17ESTCURR, {_money('sum(I17ESTAMOUNT)')} AS I17ESTAMOUNT FROM bcm GROUP BY I17ESTCURR")
_state("bcm_balance_close", f"SELECT {_CLOSE_GRAIN}, {', '.join(f'{_money(m)} AS {m}' for m in _CLOSE_M)} FROM bcm_c")
_state("bcm_balance_close_by_code", f"SELECT {_CLOSE_CODES}, {', '.join(f'{_money(m)} AS {m}' for m in _CLOSE_M)} FROM codes_c")
_state("actuals_balance_open", f"SELECT {_OPEN_GRAIN}, {_money('actuals_CCY')} AS actuals_CCY, {_money('actuals')} AS actuals FROM act_o")
_state("actuals_balance_close", f"SELECT {_CLOSE_GRAIN}, {_money('actuals_CCY')} AS actuals_CCY, {_money('actuals')} AS actuals FROM act_c")
_state("csm_balance", f"SELECT {_OPEN_GRAIN}, {_money('csm_original_CCY')} AS csm_original_CCY, {_money('csm')} AS csm FROM csm_o")
_state("trv_balance_open", f"SELECT {_OPEN_GRAIN}, {_money('trv_original_CCY')} AS trv_original_CCY, {_money('trv')} AS trv FROM trv_o")
_state("npr_grouped", f"SELECT {_OPEN_GRAIN}, {_money('npr', 6)} AS npr FROM npr_o")
_state("npr_grouped_close", f"SELECT {_CLOSE_GRAIN}, {_money('npr', 6)} AS npr FROM npr_c")
_PARTS = ["nominal", "discount", "actuals", "trv"]


def _parts(names: list[str], wrap: str = "coalesce({0}, 0)") -> str:
    return ", ".join(
        f"{_money(wrap.format(m), 6 if m == 'npr' else 2)} AS {m}" for m in names
    )


_state("portfolio_balance_open",
       f"SELECT {_OPEN_GRAIN}, {_parts([*_PARTS, 'npr', 'total_balance'])} FROM open_aligned")
_VIEWS["before_totals"] = """
SELECT 'before' AS stage, (SELECT sum(nominal) FROM bcm_o) AS nominal, (SELECT sum(discount) FROM bcm_o) AS discount,
  (SELECT sum(actuals) FROM act_o) AS actuals, (SELECT sum(trv) FROM trv_o) AS trv, (SELECT sum(npr) FROM npr_o) AS npr"""
_VIEWS["after_totals"] = """
SELECT 'after' AS stage, sum(nominal) AS nominal, sum(discount) AS discount, sum(actuals) AS actuals,
  sum(trv) AS trv, sum(npr) AS npr FROM open_aligned"""
_state("control_totals", f"""
SELECT stage, {_parts([*_PARTS, 'npr'])}, {_money('nominal + discount + actuals + trv + npr')} AS total_balance
FROM (SELECT * FROM before_totals UNION ALL SELECT * FROM after_totals)""")
_VIEWS["flags"] = """
SELECT local_portfolio, (ri_rh = 'RH' AND sum(total_balance) < 0) OR (ri_rh = 'RI' AND sum(total_balance) > 0) AS flag
FROM open_aligned GROUP BY ri_rh, local_portfolio"""
_state("sign_flag_remap", f"""
SELECT account, {_sum('total_balance')} FROM (
  SELECT a.account, a.total_balance FROM open_aligned a JOIN flags f ON f.local_portfolio = a.local_portfolio WHERE NOT flag
  UNION ALL
  SELECT c.counter_account, a.total_balance FROM open_aligned a JOIN flags f ON f.local_portfolio = a.local_portfolio
  LEFT JOIN counters c ON c.account = a.account WHERE flag)
WHERE account IS NOT NULL GROUP BY account""")
_state("portfolio_balance_close", f"""
SELECT origin, account, I17COSTREVENUE,
  {_parts(['nominal_original_CCY', 'nominal', 'discount_current', 'actuals', 'npr', 'total_balance'], 'coalesce(sum({0}), 0)')}
FROM close_aligned GROUP BY ALL""")
_state("rowwise_total", f"""
SELECT I17REFOBJID, {_money('sum(I17ESTAMOUNT) FILTER (I17EXPCHANGE = 10)')} AS exposure_10,
  {_money('sum(I17ESTAMOUNT) FILTER (I17EXPCHANGE = 60)')} AS exposure_60, {_sum('I17ESTAMOUNT) FILTER (I17EXPCHANGE IN (10, 60)', 'total_balance')}
FROM bcm GROUP BY I17REFOBJID""")

_RED = ("locked_in", "tyc", "current")
_RED_CURVES = {"locked_in": "tyc_shift", "tyc": "tyc", "current": "ycu_31_03"}
_VIEWS["bcm_y"] = (
    f"SELECT * REPLACE ({_year_bucket('date_adjusted')} AS settlement, {_year_bucket('incurred_adjusted')} AS incurred) FROM bcm"
)
_VIEWS["bcm_y10"] = "SELECT * FROM bcm_y WHERE I17EXPCHANGE = 10"
_VIEWS["bcm_y60"] = "SELECT * FROM bcm_y WHERE I17EXPCHANGE = 60"
_KEYS_OUT = (
    "CAST(I17EXPCHANGE AS BIGINT) AS I17EXPCHANGE, I17COSTREVENUE, CAST(I17KEYDATE AS BIGINT) AS I17KEYDATE, "
    "I17ESTCURR, settlement, incurred"
)
_state("bcm_reduction", f"""
SELECT I17REFOBJID, {_KEYS_OUT}, {', '.join(_sum(m) for m in ['nominal_original_CCY', 'nominal', *[f'discount_{n}' for n in _RED]])}
FROM ({_pv(_RED, 'fx_open', _CLOSING, True, 'bcm_y10', _RED_CURVES)} UNION ALL
{_pv(_RED, 'fx_m', _CLOSING, True, 'bcm_y60', _RED_CURVES)})
WHERE I17REFOBJID IS NOT NULL AND I17COSTREVENUE IS NOT NULL AND I17ESTCURR IS NOT NULL GROUP BY ALL""")


def _run_out(names: tuple[str, ...], npr: tuple[str, ...]) -> str:
    return (
        f"I17REFOBJID AS contract, {_KEYS_OUT}, "
        + ", ".join(f"{_money(m)} AS {m}" for m in _measures(names))
        + "".join(f", {_money(_npr_col.format(n), 6)} AS npr_{n}" for n in npr)
    )


_state("ir_rollforward", f"SELECT {_run_out(_OPEN4, ('tyc', 'ycu_31_12'))} FROM ir")
_state("sm_closing", f"SELECT {_run_out(('tyc_shift', 'ycu_31_12_shift', 'ycu_31_03'), ('ycu_31_03',))} FROM sm")
_state("bcm_detail", f"""
SELECT I17REFOBJID AS contract, CAST(I17EXPCHANGE AS BIGINT) AS I17EXPCHANGE, I17COSTREVENUE, CAST(I17KEYDATE AS BIGINT) AS I17KEYDATE,
  I17INCURREDDATE, I17SETTLEMDATE, I17ESTCURR, {', '.join(f'{_money(m)} AS {m}' for m in _measures(_OPEN4))},
  {', '.join(f"{_money(_npr_col.format(n), 6)} AS npr_{n}" for n in ('tyc', 'ycu_31_12'))}
FROM ({_pv(_OPEN4, 'fx_open', _OPENING, True, 'bcm_new10')})""")
_CHECK = ("tyc_shift", "ycu_31_12_shift", "ycu_31_03")
_VIEWS["bcm10"] = "SELECT * FROM bcm WHERE I17EXPCHANGE = 10"
_by_code = _grouped(
    f"SELECT *, {_ri_rh('I17REFOBJID')} AS ri_rh, {_form_tail('I17REFOBJID', 3)} AS contract "
    f"FROM (SELECT * REPLACE (coalesce(I17COSTREVENUE, '0') AS I17COSTREVENUE) FROM ({_rounded_pv(_CHECK, 'fx_open', 'bcm10')}))",
    "ri_rh, contract, I17COSTREVENUE", ["nominal", *[f"discount_{n}" for n in _CHECK]],
)
_margins = ", ".join(
    f"sum(nominal + discount_{n} + {_npr_col.format(n)}) AS csm_{n}" for n in _CHECK
)
_should = "CASE WHEN ri_rh = 'RI' AND csm_{0} < 0 THEN 'ON' ELSE 'NO' END"
_state("onerous_check", f"""
SELECT ri_rh, contract, {', '.join(f'{_money(f"csm_{n}")} AS csm_{n}' for n in _CHECK)}, on_no,
  {', '.join(f'{_should.format(n)} AS on_no_should_be_{n}' for n in _CHECK)}
FROM (SELECT ri_rh, contract, split_part(contract, '_', 2) AS on_no, {_margins} FROM ({_by_code}) GROUP BY ri_rh, contract)
WHERE {' OR '.join(f'({_should.format(n)}) <> on_no' for n in _CHECK)}""")


# --- movements ----------------------------------------------------------------

for _prefix in ("IR", "LRC", "LIC", "LICQ1"):
    _VIEWS[f"acc_{_prefix}"] = f"""
SELECT code, '{_prefix}' || code AS account FROM codes WHERE code <> 'Y999'
UNION ALL SELECT 'Y204', '{_prefix}Y204B'"""
_MOVE = "contract, I17COSTREVENUE, lrc_lic, I17ESTCURR"
_state("pl_movement_ir", f"""
SELECT account, {_MOVE}, {_sum('-(nominal_original_CCY / rate)', 'amount')}, {_sum('nominal_original_CCY / rate', 'nominal')},
  {_sum('discount_tyc_original_CCY / rate', 'discount_tyc')}, {_sum('discount_ycu_31_12_original_CCY / rate', 'discount_ycu_31_12')},
  {_sum('nominal_original_CCY')}, {_sum('discount_tyc_original_CCY')}, {_sum('discount_ycu_31_12_original_CCY')}
FROM (SELECT m.*, a.account, f.rate FROM ir_class m LEFT JOIN acc_IR a ON a.code = m.I17COSTREVENUE
  LEFT JOIN fx_avg f ON f.ccy = m.I17ESTCURR WHERE date_select IN ('{_PAST}', 'Q1'))
WHERE account IS NOT NULL AND contract IS NOT NULL GROUP BY ALL""")


def _difference(key: str, ir_filter: str, sm_filter: str, pairs: list[tuple[str, str, str]], accounts: str) -> None:
    """Closing groups full-outer-joined to opening groups, then subtracted."""
    left = _grouped(f"SELECT * FROM sm_class WHERE {sm_filter}", _MOVE, [p[1] for p in pairs])
    right = _grouped(f"SELECT * FROM ir_class WHERE {ir_filter}", _MOVE, [p[2] for p in pairs])
    keys = _MOVE.split(", ")
    joined = (
        "SELECT " + ", ".join(f"coalesce(x.{k}, y.{k}) AS {k}" for k in keys) + ", "
        + ", ".join(f"coalesce(x.{a}, 0) - coalesce(y.{b}, 0) AS {name}" for name, a, b in pairs)
        + f" FROM ({left}) x FULL OUTER JOIN ({right}) y ON " + " AND ".join(f"x.{k} = y.{k}" for k in keys)
    )
    _state(key, _posted_sql(joined, [p[0] for p in pairs], accounts))


def _posted_sql(source: str, originals: list[str], accounts: str) -> str:
    euros = ", ".join(
        f"{_money(f'd.{o} / f.rate')} AS {o.replace('_original_CCY', '')}" for o in originals
    )
    plain = ", ".join(f"{_money(f'd.{o}')} AS {o}" for o in originals)
    return (
        f"SELECT a.account, {', '.join('d.' + k for k in _MOVE.split(', '))}, {euros}, {plain} FROM ({source}) d "
        f"LEFT JOIN fx_avg f ON f.ccy = d.I17ESTCURR LEFT JOIN {accounts} a ON a.code = d.I17COSTREVENUE"
    )


_O = "_original_CCY"
_LRC_PAIRS = [
    ("amount" + _O, "nominal" + _O, "nominal" + _O),
    ("discount_tyc_shift" + _O, "discount_tyc_shift" + _O, "discount_tyc_shift" + _O),
    ("discount_ycu_31_12_shift" + _O, "discount_ycu_31_12_shift" + _O, "discount_ycu_31_12_shift" + _O),
]
for _key in ("pl_movement_lrc", "run_hand_off"):
    _difference(_key, "lrc_lic = 'LRC' AND date_select IS DISTINCT FROM 'Q1'", "lrc_lic = 'LRC'", _LRC_PAIRS, "acc_LRC")
_difference(
    "pl_movement_lic_past", "lrc_lic = 'LIC'", "lrc_lic = 'LIC' AND date_select IS DISTINCT FROM 'Q1'",
    [
        ("amount" + _O, "nominal" + _O, "nominal" + _O),
        ("discount_tyc_change" + _O, "discount_tyc_shift" + _O, "discount_tyc" + _O),
        ("discount_ycu_31_12_change" + _O, "discount_ycu_31_12_shift" + _O, "discount_ycu_31_12" + _O),
    ],
    "acc_LIC",
)
_state("pl_movement_lic_current", _posted_sql(
    f"SELECT {_MOVE}, sum(nominal{_O}) AS amount{_O}, sum(discount_tyc_shift{_O}) AS discount_tyc_shift{_O}, "
    f"sum(discount_ycu_31_12_shift{_O}) AS discount_ycu_31_12_shift{_O} "
    "FROM sm_class WHERE lrc_lic = 'LIC' AND date_select = 'Q1' AND contract IS NOT NULL GROUP BY ALL",
    ["amount" + _O, "discount_tyc_shift" + _O, "discount_ycu_31_12_shift" + _O], "acc_LICQ1"))

# --- ledger and primitives ------------------------------------------------------

_state("ledger_totals", f"""
SELECT account AS "G/L Account", seg AS "NewGL Segment", {_sum('amount', '"Amount in Functional Currency"')}
FROM ledger_a GROUP BY ALL""")
_state("ledger_reconcile", f"""
SELECT coalesce(a.account, b.account) AS "G/L Account", {_money('a.amount')} AS amount_x, {_money('b.amount')} AS amount_y
FROM (SELECT account, sum(amount) AS amount FROM ledger_a GROUP BY account) a
FULL OUTER JOIN (SELECT account, sum(amount) AS amount FROM ledger_b GROUP BY account) b ON a.account = b.account""")
_state("outer_recon", f"""
SELECT coalesce(a.account, b.account) AS "G/L Account", coalesce(a.seg, b.seg) AS "NewGL Segment",
  {_money('a.amount')} AS amount_x, {_money('b.amount')} AS amount_y
FROM (SELECT account, seg, sum(amount) AS amount FROM ledger_a GROUP BY ALL) a
FULL OUTER JOIN (SELECT account, seg, sum(amount) AS amount FROM ledger_b GROUP BY ALL) b
ON a.account = b.account AND a.seg = b.seg""")
for _key in ("trailing_minus_parse", "headerless_scan"):
    _state(_key, f"""
SELECT 'I' || (o_custkey % 99) AS account, count(*) AS n,
  {_sum('CASE WHEN o_orderkey % 2 = 1 THEN -o_totalprice ELSE o_totalprice END', 'functional')},
  {_sum('CASE WHEN o_orderkey % 2 = 1 THEN -o_totalprice ELSE o_totalprice END', 'transaction')}
FROM orders GROUP BY 1""")
_state("ledger_project", f"""
SELECT 'orders' AS src, o_custkey % 99 AS account, count(*) AS n, {_sum('o_totalprice', 'amount')} FROM orders GROUP BY ALL""")
_number = "CAST(split_part({0}, '_', -1) AS INTEGER)"


def _assigned(source: str, ref: str) -> str:
    number = _number.format(_stem(ref))
    return (
        f"SELECT CASE WHEN {ref} LIKE '%/%' OR {number} % 2 <> 0 THEN {_form_segment(ref)} "
        f"ELSE array_to_string(string_split('CZR_ACP_' || {_form_segment(ref)}, '_')[3:6], '_') END AS contract, "
        f"'LP' || ({number} % 7) AS local_portfolio FROM {source}"
    )


_state("portfolio_lookup", f"""
SELECT r.contract, l.local_portfolio, count(*) AS n FROM ({_assigned('act0', 'id')}) r
LEFT JOIN (SELECT DISTINCT * FROM ({_assigned('bcm', 'I17REFOBJID')})) l ON l.contract = r.contract GROUP BY ALL""")
_state("code_totals", f"SELECT I17COSTREVENUE, {_sum('I17ESTAMOUNT')} FROM bcm WHERE I17COSTREVENUE IS NOT NULL GROUP BY ALL")
_state("contract_totals", f"SELECT I17REFOBJID, {_sum('I17ESTAMOUNT')} FROM bcm WHERE I17REFOBJID IS NOT NULL GROUP BY ALL")
_state("single_contract", _count(
    "I17REFOBJID, I17COSTREVENUE, I17ESTCURR, CAST(I17EXPCHANGE AS BIGINT) AS I17EXPCHANGE",
    where="WHERE I17REFOBJID = 'CZR_ACP_PRI_P500_1998_NO_80'"))
_state("distinct_pairs", f"""
SELECT DISTINCT local_portfolio, I17COSTREVENUE
FROM (SELECT *, {_form_segment('I17REFOBJID')} AS contract FROM bcm) b JOIN portfolios p ON p.contract = b.contract
WHERE I17COSTREVENUE IS NOT NULL""")
_state("union_books", f"""
SELECT I17COSTREVENUE, I17ESTCURR, count(*) AS n, {_sum('I17ESTAMOUNT')} FROM (
  SELECT I17COSTREVENUE, I17ESTCURR, I17ESTAMOUNT FROM bcm UNION ALL SELECT code, NULL, v FROM act0)
GROUP BY I17COSTREVENUE, I17ESTCURR""")
_state("sample_scan", """
SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000""")
_state("ffill", """
SELECT o_orderkey, o_custkey % 5 AS grp,
  last_value(CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority END IGNORE NULLS) OVER (ORDER BY o_orderkey
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label,
  last_value(CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice END IGNORE NULLS) OVER (PARTITION BY o_custkey % 5
    ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount
FROM orders""")
_state("ffill_ties", f"""
SELECT o_orderkey,
  last_value(CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority END IGNORE NULLS) OVER above AS label,
  {_money("last_value(CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice END IGNORE NULLS) OVER above")} AS amount
FROM orders WINDOW above AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
_state("scan_decimal_comma", f"SELECT I17COSTREVENUE, {_sum('I17ESTAMOUNT', 'amount')} FROM bcm WHERE I17COSTREVENUE IS NOT NULL GROUP BY I17COSTREVENUE")
STATEMENTS["csv_sink_roundtrip"] = STATEMENTS["bcm_balance_open"]
STATEMENTS["scan_decimal_point"] = STATEMENTS["scan_decimal_comma"]
STATEMENTS["result_table_roundtrip"] = STATEMENTS["bcm_balance_open"]
_state("decimal_scan", """
SELECT 'I' || (o_custkey % 99) AS account, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS amount
FROM orders GROUP BY account""")
_state("nan_as_null", f"""
SELECT 'I' || (o_custkey % 99) AS account,
  {_sum('CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END', 'amount')}
FROM orders GROUP BY account""")
_state("ccy_rounding_base", f"""
SELECT I17ESTCURR, {_sum("CASE WHEN I17ESTCURR IN ('HUF','ISK','JPY','KRW') THEN round_even(nominal, 0) ELSE nominal END", 'nominal')}
FROM (SELECT I17ESTCURR, I17ESTAMOUNT / CASE WHEN I17ESTCURR = 'EUR' THEN 1 ELSE nullif(rate, 0) END AS nominal
      FROM bcm LEFT JOIN fx_open ON ccy = I17ESTCURR) WHERE I17ESTCURR IS NOT NULL GROUP BY I17ESTCURR""")
