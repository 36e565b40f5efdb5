"""Merge of identifiers over trades, daily process, archive and holdings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import idmap, merging
from ledgerline.operators.merging import Matched
from ledgerline.sinks.versions import write_version

COMMITTED = "COMMITTED"
NOT_COMMITTED = "DID NOT COMMIT"


@dataclass(frozen=True)
class MergeResult:
    """Tables after the merge, and what happened to them.

    ``audit`` has one row per table: ``table_name``, ``map_entries``, ``rows_in``, ``updated``,
    ``deleted``, ``rows_out``. ``version`` names the written version, or is None.
    """

    trades: DataFrame
    daily: DataFrame
    archive: DataFrame
    holdings: DataFrame
    audit: DataFrame
    map_entries: int
    result: str
    version: str | None = None


# How each table changes.
CHANGES = {
    "trades": "repoint",
    "daily_process": "balances",
    "archive": "repoint",
    "holdings": "remove",
}


def merge_audit(
    matched: Mapping[str, Matched], map_entries: int, balance: str = "Balance"
) -> DataFrame:
    """Counts per table; each table is scanned for its key (and balance) only."""
    counted = [merging.audit(m, name, CHANGES[name], balance) for name, m in matched.items()]
    return reduce(DataFrame.unionByName, counted).select(
        "table_name",
        F.lit(map_entries).cast("long").alias("map_entries"),
        *merging.AUDIT_COLUMNS,
    )


def merge_ids(
    trades: DataFrame,
    daily: DataFrame,
    archive: DataFrame,
    holdings: DataFrame,
    id_map: DataFrame,
    *,
    commit: bool = False,
    out: str | None = None,
    key: str = "GUID",
    balance: str = "Balance",
    allow_self: bool = False,
) -> MergeResult:
    """Move old identifiers to new ones by a sequential map (``seq``, ``old_id``, ``new_id``).

    Trades and archive are re-pointed. Daily rows with a balance are re-pointed, those with balance
    0 deleted, those with a null balance kept. Holdings of old ids are deleted. By default nothing
    is written. With ``commit`` the four tables go to a new version under ``out``, which readers see
    only once all four are complete; the inputs are never overwritten.
    """
    if commit and not out:
        raise ValueError("commit needs an output folder")
    entries = idmap.stage_entries(id_map, allow_self)
    resolved = idmap.resolve_entries(entries)
    matched = {
        name: merging.match(table, resolved, key)
        for name, table in zip(CHANGES, (trades, daily, archive, holdings))
    }
    tables = _changed(matched, balance)
    version = None
    if commit:
        # What is written is counted on its way, so the tables are joined to the map once.
        watched = {name: merging.observed(m, CHANGES[name], balance) for name, m in matched.items()}
        version = write_version(_changed({n: m for n, (m, _) in watched.items()}, balance), out)
        rows = [
            (name, entries.rows, seen.get["rows_in"], seen.get["updated"], seen.get["deleted"])
            for name, (_, seen) in watched.items()
        ]
        schema = "table_name string, map_entries long, rows_in long, updated long, deleted long"
        counts = trades.sparkSession.createDataFrame(rows, schema).withColumn(
            "rows_out", F.col("rows_in") - F.col("deleted")
        )
    else:
        counts = merge_audit(matched, entries.rows, balance)
    return MergeResult(
        **tables,
        audit=counts,
        map_entries=entries.rows,
        result=COMMITTED if commit else NOT_COMMITTED,
        version=version,
    )


def _changed(matched: Mapping[str, Matched], balance: str) -> dict[str, DataFrame]:
    return {
        "trades": merging.repoint(matched["trades"]),
        "daily": merging.repoint_balances(matched["daily_process"], balance),
        "archive": merging.repoint(matched["archive"]),
        "holdings": merging.remove(matched["holdings"]),
    }
