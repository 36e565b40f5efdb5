"""Report of missing deliveries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import business_date_list
from ledgerline.operators import deliveries as ops


def exceptions_report(
    brokers: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    customers: DataFrame,
    daily: DataFrame,
    as_of: dt.date | None = None,
    lookback_days: int = 2,
    process_server: str = "",
    *,
    mode: str = "calendar",
    holidays: Iterable[dt.date] = (),
    active_since: dt.date | None = None,
    by_day: bool = False,
) -> DataFrame:
    """Deliveries expected on the recent business dates before ``as_of`` that never came.

    Columns ``ProcessServer``, ``BrokerName``, ``BusinessDate``, ``CompanyName``, in order of date,
    broker and company. One processed account clears its whole broker/customer pair for a date. Only
    pairs with an account active since the earliest date (or ``active_since``) are expected.
    """
    dates = business_date_list(brokers.sparkSession, as_of, lookback_days, mode, holidays)
    missing = ops.missing_deliveries(
        brokers, accounts, users, customers, daily, dates, active_since, by_day
    )
    return missing.select(
        F.lit(process_server).alias("ProcessServer"),
        F.col("brokerage").alias("BrokerName"),
        F.col("business_date").alias("BusinessDate"),
        F.col("customer").alias("CompanyName"),
    ).orderBy("BusinessDate", "BrokerName", "CompanyName")
