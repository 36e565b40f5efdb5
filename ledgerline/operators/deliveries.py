"""Expected and processed deliveries per broker, customer and business date.

Tables and columns: brokers(PrimaryGUID, BrokerName), accounts(AccountGUID, ForeignGUID,
LastProcessed), users(PrimaryGUID, ForeignGUID), customers(PrimaryGUID, CompanyName),
daily(AccountGUID, DateOfData). The dates are a short list of values, so every test on them is part
of a scan filter and no join with a date table is needed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.idmap import normal_id
from ledgerline.scale import skew_join, stage

PAIR = ("brokerage", "customer")


def _guid(frame: DataFrame, column: str, name: str) -> Column:
    """An id column in the form in which ids are compared."""
    return normal_id(F.col(column), frame.schema[column].dataType).alias(name)


def _at(dates: Sequence[dt.date], frame: DataFrame, column: str) -> list[Column]:
    """The dates as literals of the type of a column, so that comparisons reach the scan."""
    return [F.lit(d).cast(frame.schema[column].dataType) for d in sorted(dates)]


def active_accounts(
    accounts: DataFrame, dates: Sequence[dt.date], active_since: dt.date | None = None
) -> DataFrame:
    """Accounts processed on or after the earliest date; none if there is no date."""
    narrow = accounts.select("AccountGUID", "ForeignGUID", "LastProcessed")
    if active_since is None and not dates:
        return narrow.filter(F.lit(False))
    since = _at([active_since or min(dates)], accounts, "LastProcessed")[0]
    return narrow.filter(F.col("LastProcessed") >= since)


def _account_owners(
    accounts: DataFrame, dates: Sequence[dt.date], active_since: dt.date | None
) -> DataFrame:
    active = active_accounts(accounts, dates, active_since)
    return active.select(
        _guid(active, "AccountGUID", "accountguid"), _guid(active, "ForeignGUID", "owner")
    )


def broker_customers(brokers: DataFrame, users: DataFrame, customers: DataFrame) -> DataFrame:
    """Broker and customer names by the id that accounts refer to: ``owner``, ``brokerage``,
    ``customer``."""
    names = brokers.select(
        _guid(brokers, "PrimaryGUID", "owner"), F.col("BrokerName").alias("brokerage")
    )
    firms = users.select(_guid(users, "PrimaryGUID", "owner"), _guid(users, "ForeignGUID", "firm"))
    companies = stage(
        customers.select(
            _guid(customers, "PrimaryGUID", "firm"), F.col("CompanyName").alias("customer")
        ),
        "companies",
        gather=True,
    )
    # Many users may belong to one firm, so the firm is the key that can be hot.
    return skew_join(names.join(firms, "owner"), companies, ["firm"], "inner").select("owner", *PAIR)


def active_broker_accounts(
    brokers: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    customers: DataFrame,
    dates: Sequence[dt.date],
    active_since: dt.date | None = None,
) -> DataFrame:
    """Active accounts with broker and customer name: ``brokerage``, ``customer``, ``accountguid``.

    The names are staged, so that they are broadcast if small and hot brokers are spread otherwise.
    """
    names = stage(broker_customers(brokers, users, customers), "broker-customers")
    active = _account_owners(accounts, dates, active_since)
    return skew_join(active, names, ["owner"], "inner").select(*PAIR, "accountguid")


def expected_deliveries(
    brokers: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    customers: DataFrame,
    dates: Sequence[dt.date],
    active_since: dt.date | None = None,
) -> DataFrame:
    """Each broker/customer pair with an active account, on each date.

    Accounts shrink to their distinct owners before any join, and dates come last.
    """
    owners = _account_owners(accounts, dates, active_since).select("owner").distinct()
    pairs = (
        owners.join(broker_customers(brokers, users, customers), "owner").select(*PAIR).distinct()
    )
    every = F.array(*[F.lit(d) for d in sorted(dates)]).cast("array<date>")
    return pairs.select(*PAIR, F.explode(every).alias("business_date"))


def _flags(dates: Sequence[dt.date]) -> list[str]:
    """A column per date that tells whether there is data for it."""
    return [f"__day{i}" for i in range(len(dates))]


def _any(dates: Sequence[dt.date]) -> list[Column]:
    """The flags of a group: set where one of its rows has them set."""
    return [F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in _flags(dates)]


def _days(dates: Sequence[dt.date], value: bool, keep: Column | None = None) -> Column:
    """The dates whose flag is ``value``, or all where ``keep`` holds, as an array."""
    chosen = []
    for flag, day in zip(_flags(dates), sorted(dates), strict=True):
        wanted = F.col(flag) == F.lit(value)
        chosen.append(F.when(wanted if keep is None else wanted | keep, F.lit(day)))
    return F.array_compact(F.array(*chosen)).cast("array<date>")


def _days_by_account(daily: DataFrame, dates: Sequence[dt.date], by_day: bool) -> DataFrame:
    """One row per account with daily data on a wanted date: a flag per date."""
    moment = F.col("DateOfData")
    if not dates:
        wanted = F.lit(False)
    elif by_day:
        first = _at([min(dates)], daily, "DateOfData")[0]
        beyond = _at([max(dates) + dt.timedelta(days=1)], daily, "DateOfData")[0]
        in_days = F.to_date(moment).isin(*[F.lit(d) for d in sorted(dates)])
        wanted = (moment >= first) & (moment < beyond) & in_days
    else:
        wanted = moment.isin(*_at(dates, daily, "DateOfData"))
    day = F.to_date(moment)
    flags = [F.bool_or(day == F.lit(d)).alias(f) for f, d in zip(_flags(dates), sorted(dates), strict=True)]
    rows = daily.filter(wanted).withColumn("__account", _guid(daily, "AccountGUID", "__account"))
    return (
        rows.groupBy("__account")
        .agg(F.count(F.lit(1)).alias("rows"), *flags)
        .select(F.col("__account").alias("accountguid"), *_flags(dates))
    )


def _owners_by_account(
    accounts: DataFrame, dates: Sequence[dt.date], active_since: dt.date | None
) -> DataFrame:
    """Account ids with their owners, each combination once."""
    return _account_owners(accounts, dates, active_since).distinct()


def _named() -> Column:
    return F.col("brokerage").isNotNull() & F.col("customer").isNotNull()


def processed_deliveries(
    brokers: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    customers: DataFrame,
    daily: DataFrame,
    dates: Sequence[dt.date],
    active_since: dt.date | None = None,
    by_day: bool = False,
) -> DataFrame:
    """Expected pairs and dates for which some account of the pair has daily data.

    A date counts if ``DateOfData`` is exactly that midnight, or with ``by_day`` anywhere in the
    day. Expected rows are all pairs times all dates, so joining them again to the accounts of the
    same pair only drops pairs with a null name; that is done as a filter. Daily rows shrink to one
    row per account id with a flag per date before they meet the accounts, and the result to one row
    per owner before names are joined, so no hot account, broker or customer is carried row by row.
    """
    owners = _owners_by_account(accounts, dates, active_since)
    by_owner = (
        owners.join(_days_by_account(daily, dates, by_day), "accountguid")
        .groupBy("owner")
        .agg(F.count(F.lit(1)).alias("rows"), *_any(dates))
    )
    named = broker_customers(brokers, users, customers).filter(_named())
    by_pair = by_owner.drop("rows").join(named, "owner").groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("rows"), *_any(dates)
    )
    return by_pair.select(*PAIR, F.explode(_days(dates, True)).alias("business_date"))


def unprocessed_deliveries(expected: DataFrame, processed: DataFrame) -> DataFrame:
    """Expected rows that were not processed; nulls count as equal, the result is distinct."""
    columns = [*PAIR, "business_date"]
    return expected.select(*columns).subtract(processed.select(*columns))


def missing_deliveries(
    brokers: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    customers: DataFrame,
    daily: DataFrame,
    dates: Sequence[dt.date],
    active_since: dt.date | None = None,
    by_day: bool = False,
) -> DataFrame:
    """``expected_deliveries`` without ``processed_deliveries``, in one pass over the accounts.

    Each active account brings a flag per date it has data for; flags are united per owner and then
    per pair of names, and the dates without one are missing. A pair with a null name is never
    processed.
    """
    owners = _owners_by_account(accounts, dates, active_since)
    by_owner = (
        owners.join(_days_by_account(daily, dates, by_day), "accountguid", "left")
        .groupBy("owner")
        .agg(F.count(F.lit(1)).alias("rows"), *_any(dates))
        .drop("rows")
    )
    by_pair = (
        by_owner.join(broker_customers(brokers, users, customers), "owner")
        .groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("rows"), *_any(dates))
    )
    return by_pair.select(*PAIR, F.explode(_days(dates, False, ~_named())).alias("business_date"))
