"""Posted ledger: totals, reconciliation, extracts and derived lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.functions import ids
from closebook.functions.money import trailing_minus
from closebook.operators.classify import derive_key
from closebook.operators.dictionary import once
from closebook.operators.grouping import distinct_pairs, group_sum, reconcile
from closebook.operators.lookups import left_lookup
from closebook.schemas import (
    FUNCTIONAL_AMOUNT,
    LEDGER_COLUMNS,
    LEDGER_FIELDS,
    TRANSACTION_AMOUNT,
)
from closebook.sources.delimited import rename_by_dictionary, with_source

ACCOUNT, SEGMENT = "G/L Account", "NewGL Segment"
AMOUNT = "Amount in Functional Currency"


def ledger_totals(ledger: DataFrame, by_segment: bool = True) -> DataFrame:
    keys = [ACCOUNT, SEGMENT] if by_segment else [ACCOUNT]
    return group_sum(ledger, keys, [AMOUNT])


def ledger_reconcile(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both extracts by account; files of an extract are summed in one step."""
    return reconcile(first, second, [ACCOUNT], AMOUNT)


def ledger_extract(
    raw: DataFrame, dictionary: DataFrame, fields: Sequence[str] = LEDGER_FIELDS
) -> DataFrame:
    """Technical columns -> business names, both amounts to numbers."""
    named = rename_by_dictionary(raw.select(*[F.col(f"`{f}`") for f in fields]), dictionary)
    return named.withColumns(
        {
            name: trailing_minus(F.col(f"`{name}`"))
            for name in (FUNCTIONAL_AMOUNT, TRANSACTION_AMOUNT)
        }
    )


def ledger_project(
    files: DataFrame, columns: Sequence[str] = LEDGER_COLUMNS, prefix: int = 6
) -> DataFrame:
    """Wanted columns with the first characters of the file name as ``src``."""
    return with_source(files, prefix).select("src", *columns)


ASSIGNED, OWN = "Assigned Portfolio (Profit Recognition)", "Contract/Portfolio"


def portfolio_contracts(df: DataFrame) -> DataFrame:
    """Contract key from the assigned portfolio, or from the contract itself."""
    own = derive_key(df, "segment", source=OWN, name="_own")
    key = F.when(F.col(ASSIGNED).isNull(), F.col("_own")).otherwise(
        ids.CONTRACT_FORMS["portfolio"](F.col(ASSIGNED), None, None)
    )
    return own.withColumn("contract", key).drop("_own")


def portfolio_lookup(source: DataFrame) -> DataFrame:
    """Distinct (contract, local portfolio) pairs; each different source row is parsed once."""
    named = source.select(ASSIGNED, OWN, F.col("Local Portfolio").alias("local_portfolio"))
    pairs = portfolio_contracts(once(named, [ASSIGNED, OWN, "local_portfolio"]))
    return distinct_pairs(pairs, ["contract", "local_portfolio"])


def enrich_with_portfolio(results: DataFrame, lookup: DataFrame) -> DataFrame:
    return left_lookup(portfolio_contracts(results), lookup, ["contract"])


def code_totals(bcm: DataFrame, measures: Sequence[str] = ("I17ESTAMOUNT",)) -> DataFrame:
    return group_sum(bcm, ["I17COSTREVENUE"], measures)


def contract_totals(bcm: DataFrame, measures: Sequence[str] = ("I17ESTAMOUNT",)) -> DataFrame:
    return group_sum(bcm, ["I17REFOBJID"], measures)


def single_contract(df: DataFrame, contract_id: str) -> DataFrame:
    """All rows of one contract id; the filter reaches the scan."""
    return df.filter(F.col("I17REFOBJID") == contract_id)
