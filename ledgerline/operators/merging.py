"""Applying a resolved identifier map to tables: re-point, delete, count."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.operators.idmap import normal_id
from ledgerline.scale import Staged, skew_join

_ID = "__id"
_FINAL = "__final"
_HIT = "__hit"
AUDIT_COLUMNS = ("rows_in", "updated", "deleted", "rows_out")


@dataclass(frozen=True)
class Matched:
    """A table joined to a resolved map: its rows with whether the key is an old id, and its final id.

    The flag is needed beside the id because an id may become null.
    """

    table: DataFrame
    rows: DataFrame
    key: str

    def with_key(self, changes: Column, keep: Column | None = None) -> DataFrame:
        """The table in its own shape, with the final id as key where ``changes`` holds.

        Text keys come out in the form in which ids are compared, all of them, so that an id has one
        spelling after the merge.
        """
        kind = self.table.schema[self.key].dataType
        own = normal_id(F.col(self.key), kind)
        new = F.when(changes, F.col(_FINAL).cast(kind)).otherwise(own).alias(self.key)
        kept = self.rows if keep is None else self.rows.filter(keep)
        return kept.select(*[new if c == self.key else F.col(c) for c in self.table.columns])


def match(table: DataFrame, resolved: Staged, key: str = "GUID") -> Matched:
    """Look up the key of every row; a row without an old id stays."""
    renamed = Staged(
        resolved.df.select(
            F.col("old_id").alias(_ID), F.col("final_id").alias(_FINAL), F.lit(True).alias(_HIT)
        ),
        resolved.rows,
        resolved.bytes,
    )
    keyed = table.withColumn(_ID, normal_id(F.col(key), table.schema[key].dataType))
    joined = skew_join(keyed, renamed, [_ID], "left")
    return Matched(table, joined.withColumn(_HIT, F.coalesce(_HIT, F.lit(False))), key)


def _zero(balance: str) -> Column:
    return F.coalesce(F.col(balance) == 0, F.lit(False))


def _not_zero(balance: str) -> Column:
    return F.coalesce(F.col(balance) != 0, F.lit(False))


def repoint(matched: Matched) -> DataFrame:
    """Replace old ids by their final ids; all other columns pass through."""
    return matched.with_key(F.col(_HIT))


def repoint_balances(matched: Matched, balance: str = "Balance") -> DataFrame:
    """Re-point rows with a balance, delete old-id rows with balance 0, keep null balances."""
    hit = F.col(_HIT)
    return matched.with_key(hit & _not_zero(balance), ~(hit & _zero(balance)))


def remove(matched: Matched) -> DataFrame:
    """Delete the rows whose key is an old id."""
    return matched.with_key(F.lit(False), ~F.col(_HIT))


def audit(matched: Matched, name: str, change: str, balance: str = "Balance") -> DataFrame:
    """One row of counts for a table: rows in, updated, deleted, out. Reads key and balance only.

    ``change`` is ``repoint``, ``balances`` or ``remove``.
    """
    counted = matched.rows.agg(*_counts(change, balance))
    return counted.select(
        F.lit(name).alias("table_name"),
        "rows_in",
        "updated",
        "deleted",
        (F.col("rows_in") - F.col("deleted")).alias("rows_out"),
    )


def _counts(change: str, balance: str) -> list[Column]:
    hit = F.col(_HIT)
    never = F.lit(False)
    updated, deleted = {
        "repoint": (hit, never),
        "balances": (hit & _not_zero(balance), hit & _zero(balance)),
        "remove": (never, hit),
    }[change]
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(updated).alias("updated"),
        F.count_if(deleted).alias("deleted"),
    ]


def observed(matched: Matched, change: str, balance: str = "Balance") -> tuple[Matched, Observation]:
    """The same rows, counted like ``audit`` while whatever is made of them is written."""
    seen = Observation()
    return replace(matched, rows=matched.rows.observe(seen, *_counts(change, balance))), seen
