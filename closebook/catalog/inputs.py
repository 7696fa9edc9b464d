"""Ledger inputs derived from the star-schema tables.

Cash flows are line items with their order and supplier, actual payments and
margins are orders, ledger postings are orders by account. Every table is
used whole. Calendars are literal, so building an input starts no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.functions import dates
from closebook.functions.money import null_if_nan
from closebook.operators.valuation import wide_curves, widen_curves
from closebook.params import CLOSING_EXPOSURE, OPENING_EXPOSURE, CloseParams
from closebook.plans import runs
from closebook.session import apply_settings

PARAMS = CloseParams.for_closing("31.03.1998")

# Fixed values of the derived inputs.
SEGMENTS = ("PRI", "PRH", "LRI", "LRH")
CODES = (
    "Y204", "Z204", "Y220", "Z220", "Y600", "Z600", "Z400", "Y400",
    "Z303", "Y303", "Y100", "Z100", "Y103", "Z103", "Y999", "Y500",
)
CURRENCIES = ("EUR", "CZK", "HUF", "TWD", "JPY", "KRW", "ISK", "USD", "XXX")
CURVES = ("tyc", "ycu_31_12", "tyc_shift", "ycu_31_12_shift", "ycu_31_03")
NUMBERS = 200
#: First month end and number of months of the curves; first and last year of portfolios.
FIRST_MONTH, MONTHS = "1991-12-31", 240
FIRST_YEAR, LAST_YEAR = 1990, 2011
UNMAPPED_CODE = "Y999"
#: Lines without id, code or currency, and with an exposure that is neither opening nor
#: closing: remainders of the order key. The opening rate of one currency is zero.
ODD_LINES = {"id": (197, 3), "code": (193, 5), "currency": (191, 7), "exposure": (181, 11)}
OTHER_EXPOSURE, ZERO_RATE = 70, "USD"
DOUBLE_CODE = "Y204"

TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def _some(what: str) -> str:
    divisor, rest = ODD_LINES[what]
    return f"l_orderkey % {divisor} = {rest}"


def _pick(values: tuple[str, ...], number: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({number} % {len(values)} + 1 AS INT))"


def _ymd(day: str) -> str:
    return f"year({day}) * 10000 + month({day}) * 100 + day({day})"


def _values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A literal table with an exact size estimate."""

    def cell(value) -> str:
        return f"'{value}'" if isinstance(value, str) else f"CAST({value} AS DOUBLE)"

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


class StarInputs:
    """All inputs of the close for one folder of star-schema tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table; NaN in a double counts as no value."""
        df = self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
        doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
        return df.withColumns({c: null_if_nan(F.col(c)) for c in doubles})

    # --- facts ------------------------------------------------------------

    def _bcm(self, lines: DataFrame) -> DataFrame:
        joined = lines.join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        ).join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        return joined.selectExpr(
            f"if({_some('id')}, NULL, concat('CZR_ACP_', {_pick(SEGMENTS, 'l_suppkey')}, '_P', "
            "500 + l_partkey % 5, '_', year(o_orderdate), '_', if(l_returnflag = 'R', 'ON', 'NO'), '_', "
            f"l_partkey % {NUMBERS}, if(l_linenumber % 3 = 0, '/1', ''))) AS I17REFOBJID",
            f"if({_some('exposure')}, {OTHER_EXPOSURE}, if(l_linestatus = 'F', 10, 60)) AS I17EXPCHANGE",
            f"if({_some('code')}, NULL, {_pick(CODES, 'l_partkey')}) AS I17COSTREVENUE",
            "year(o_orderdate) * 10000 + 1231 AS I17KEYDATE",
            f"if({_some('currency')}, NULL, {_pick(CURRENCIES, 's_nationkey')}) AS I17ESTCURR",
            f"{_ymd('o_orderdate')} AS I17INCURREDDATE",
            f"{_ymd('l_shipdate')} AS I17SETTLEMDATE",
            "l_extendedprice * (1 - 2 * (l_linenumber % 2)) AS I17ESTAMOUNT",
        )

    def bcm(self) -> DataFrame:
        return self._bcm(self.table("lineitem"))

    def bcm_open(self) -> DataFrame:
        """The opening book: all lines, at opening exposure."""
        return self.bcm().withColumn("I17EXPCHANGE", F.lit(OPENING_EXPOSURE))

    def bcm_new(self) -> DataFrame:
        """The new book: all lines."""
        return self.bcm()

    def bcm_opening_run(self) -> DataFrame:
        """The rows of the opening run, each line once.

        A line is a row of the opening book, and once more where its own exposure makes it an
        opening row of the new book: the same row twice, counted in ``copies``.
        """
        return self.bcm().withColumns({"I17EXPCHANGE": F.lit(OPENING_EXPOSURE), runs.COPIES: self._opening_copies()})

    def bcm_runs(self) -> DataFrame:
        """The rows of both runs from one scan, tagged in ``run``; only closing lines are two rows."""
        closing = F.col("I17EXPCHANGE") == CLOSING_EXPOSURE
        books = F.array(
            F.struct(F.lit(runs.OPENING).alias("run"), F.lit(OPENING_EXPOSURE).alias("exposure")),
            F.struct(F.when(closing, F.lit(runs.CLOSING)).alias("run"), F.lit(CLOSING_EXPOSURE).alias("exposure")),
        )
        counted = self.bcm().withColumn(runs.COPIES, self._opening_copies())
        tagged = counted.withColumn("_book", F.explode(books)).filter("_book.run IS NOT NULL")
        return tagged.withColumns({"run": F.col("_book.run"), "I17EXPCHANGE": F.col("_book.exposure")}).drop("_book")

    @staticmethod
    def _opening_copies():
        return F.when(F.col("I17EXPCHANGE") == OPENING_EXPOSURE, F.lit(2.0)).otherwise(F.lit(1.0))

    def act(self) -> DataFrame:
        value = "o_totalprice * (1 - 2 * (o_orderkey % 2))"
        return self.table("orders").selectExpr(
            f"concat('CZR_ACP_', {_pick(SEGMENTS, 'o_custkey')}, '_P', 500 + o_custkey % 5, '_', "
            "year(o_orderdate), '_', if(o_orderstatus = 'F', 'ON', 'NO'), '_', "
            f"o_custkey % {NUMBERS}, if(o_orderkey % 3 = 0, '/1', '')) AS I17PORTID",
            f"{_pick(CODES, 'o_custkey')} AS I17CFTYPE",
            f"{value} AS I17VALUE",
            f"{value} / 7 AS I17FUNCTVALUE",
        )

    def csm(self) -> DataFrame:
        return self.table("orders").selectExpr(
            f"concat('CZR_ACP_', {_pick(SEGMENTS, 'o_custkey')}, '_', year(o_orderdate), '_', "
            f"if(o_orderstatus = 'F', 'ON', 'NO'), '_', o_custkey % {NUMBERS}) AS I17REFOBJID",
            f"{_pick(CODES, 'o_custkey')} AS I17COSTREVENUE",
            f"{_pick(CURRENCIES, 'o_custkey')} AS I17ESTCURR",
            "o_totalprice AS I17ESTAMOUNT",
        )

    def _ledger(self, account: str) -> DataFrame:
        return self.table("orders").selectExpr(
            "date_format(o_orderdate, 'yyyyMMdd') AS `Posting Date`",
            f"{_pick(CODES, 'o_custkey')} AS `Cost or Revenue Element`",
            f"{_pick(SEGMENTS, 'o_orderkey')} AS `NewGL Segment`",
            f"{account} AS `G/L Account`",
            "o_totalprice * (1 - 2 * (o_orderkey % 2)) AS `Amount in Functional Currency`",
        )

    def ledger_a(self) -> DataFrame:
        """First extract; its accounts 96 to 98 are posted as suspense ``S0``."""
        return self._ledger("if(o_custkey % 99 >= 96, 'S0', concat('I', o_custkey % 99))")

    def ledger_b(self) -> DataFrame:
        """Second extract; its accounts 0 to 2 are posted as suspense ``S1``."""
        return self._ledger("if(o_custkey % 99 < 3, 'S1', concat('I', o_custkey % 99))")

    # --- curves and rates -------------------------------------------------

    def _nodes(self, months: DataFrame | None = None) -> DataFrame:
        """Month end and currency of the curves; November has no factors.

        The months are a literal calendar unless given.
        """
        if months is None:
            months = self.spark.range(MONTHS).selectExpr(
                f"last_day(add_months(DATE'{FIRST_MONTH}', CAST(id AS INT))) AS day"
            )
        listed = ", ".join(f"'{c}'" for c in CURRENCIES)
        return months.filter("month(day) <> 11").selectExpr(
            "day", f"explode(array({listed})) AS I17ESTCURR"
        )

    @staticmethod
    def _factor(k: int | str) -> str:
        return f"997D / (997 + 2 * {k} * (12 * year(day) + month(day) - 23976)) AS I17DISCFACT"

    def _curve(self, name: str, months: DataFrame | None = None) -> DataFrame:
        """One curve as its file would hold it: integer or dotted-text dates."""
        k = CURVES.index(name) + 1
        shown = _ymd("day") if k in (1, 3) else "date_format(day, 'dd.MM.yyyy')"
        return self._nodes(months).selectExpr(
            f"{shown} AS I17DISCDATE", "I17ESTCURR", self._factor(k)
        )

    def curve_files(self) -> DataFrame:
        """The wide table from five separate curves over the months of the line items."""
        month = dates.align_month_end(F.to_date("l_shipdate"))
        months = self.table("lineitem").select(month.alias("day")).distinct()
        return wide_curves({name: self._curve(name, months) for name in CURVES})

    def curves(self, **names: str) -> DataFrame:
        """Wide curve table from stacked curves; ``alias=curve`` pairs, all five
        by their own names if none are given."""
        chosen = names or {name: name for name in CURVES}
        pairs = ", ".join(
            f"named_struct('name', '{alias}', 'k', {CURVES.index(c) + 1})"
            for alias, c in chosen.items()
        )
        stacked = (
            self._nodes()
            .selectExpr("*", f"explode(array({pairs})) AS item")
            .selectExpr(
                "day AS date_adjusted", "I17ESTCURR", "item.name AS curve", self._factor("item.k")
            )
        )
        return widen_curves(stacked, list(chosen))

    def rates_open(self) -> DataFrame:
        rows = [(c, 2.0 * i + 3) for i, c in enumerate(CURRENCIES) if c not in ("EUR", "XXX")]
        rows = [(c, 0.0 if c == ZERO_RATE else rate) for c, rate in rows]
        return _values(self.spark, [("EUR", 1.0), *rows], "FROM_CURRENCY, EXCHANGE_RATE")

    def rates_close(self) -> DataFrame:
        rows = []
        for i, currency in enumerate(CURRENCIES):
            if currency not in ("EUR", "XXX"):
                rows.append((currency, 2.0 * i + 5, "M"))
                rows.append((currency, 2.0 * i + 7, "AVG"))
        return _values(self.spark, rows, "FROM_CURRENCY, EXCHANGE_RATE, type")

    # --- lookups ----------------------------------------------------------

    def accounts_by_class(self) -> DataFrame:
        rows = [
            (code, side, part, f"I{code}{side}{part}")
            for code in CODES if code != UNMAPPED_CODE
            for side in ("RI", "RH")
            for part in ("LRC", "LIC")
        ]
        return _values(self.spark, rows, "I17COSTREVENUE, ri_rh, lrc_lic, account")

    def accounts_by_segment(self) -> DataFrame:
        rows = [
            (code, side, f"I{code}{side}LIC")
            for code in CODES if code != UNMAPPED_CODE
            for side in ("RI", "RH")
        ]
        return _values(self.spark, rows, "I17COSTREVENUE, ri_rh, account")

    def accounts_by_code(self, prefix: str = "A") -> DataFrame:
        rows = [(code, f"{prefix}{code}") for code in CODES if code != UNMAPPED_CODE]
        rows.append((DOUBLE_CODE, f"{prefix}{DOUBLE_CODE}B"))
        return _values(self.spark, rows, "I17COSTREVENUE, account")

    def charge_accounts(self) -> DataFrame:
        return _values(
            self.spark, [("LRC", "IY500RILRC"), ("LIC", "NPRLIC")], "lrc_lic, account"
        )

    def counter_accounts(self) -> DataFrame:
        rows = [
            (f"I{code}{side}{part}", f"CI{code}{side}{part}")
            for code in CODES if code not in (UNMAPPED_CODE, "Y500")
            for side in ("RI", "RH")
            for part in ("LRC", "LIC")
        ]
        return _values(self.spark, [*rows, ("NPRLIC", "CNPRLIC")], "account, counter_account")

    def portfolios(self) -> DataFrame:
        """Contract (segment form) -> local portfolio; every eleventh is missing."""
        segments = ", ".join(f"'{s}'" for s in SEGMENTS)
        listed = (
            self.spark.range(FIRST_YEAR, LAST_YEAR)
            .selectExpr("id AS year", f"explode(array({segments})) AS seg")
            .selectExpr("*", "explode(array('ON', 'NO')) AS marker")
            .selectExpr("*", f"explode(sequence(0, {NUMBERS - 1})) AS n")
        )
        return self._placed(listed, "concat(seg, '_', year, '_', marker, '_', n)")

    def portfolios_by_tail(self) -> DataFrame:
        """The same for the two-part contract key of the closing balance."""
        return self._placed(self._numbers(), "concat(marker, '_', n)")

    def old_contracts(self) -> DataFrame:
        return self._numbers().filter("n % 3 = 0").selectExpr("concat(marker, '_', n) AS contract")

    def _numbers(self) -> DataFrame:
        return self.spark.range(NUMBERS).selectExpr("id AS n", "explode(array('ON', 'NO')) AS marker")

    @staticmethod
    def _placed(listed: DataFrame, contract: str) -> DataFrame:
        return listed.filter("n % 11 <> 0").selectExpr(
            f"{contract} AS contract", "concat('LP', n % 7) AS local_portfolio"
        )
