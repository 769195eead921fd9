"""Batch maintenance of a log table with unique keys.

Every change set is first reduced to one row per key with map-side aggregation, so
a key repeated in a third of the batch is one row before any join. The reduced set
is written, counted, and broadcast only within a checked size: then the store is
scanned without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentry.session import broadcast_if_small, pin
from logsentry.sources.schemas import STORE_KEY


def _prefixed(df: DataFrame, key: list[str], prefix: str = "_k_") -> DataFrame:
    return df.select(*[F.col(k).alias(prefix + k) for k in key], *[c for c in df.columns if c not in key])


def _same(key: list[str]) -> Column:
    """Key equality where a missing part equals a missing part."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key])


def list_store(store: DataFrame) -> DataFrame:
    return store


def _present(store: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Which of the (few, unique) ``keys`` the store holds: reads only the key columns."""
    return store.select(*key).join(broadcast_if_small(_prefixed(keys.select(*key), key)), _same(key), "left_semi").distinct()


def first_arrivals(batch: DataFrame, arrival: str, key: list[str]) -> DataFrame:
    """The first row of each key by the unique column ``arrival``, written once."""
    return pin(
        batch.groupBy(*key).agg(F.min_by(F.struct(*batch.columns), arrival).alias("row")).select("row.*"), "insert"
    )


def merged_patches(patches: DataFrame, seq: str, supplied: str, key: list[str]) -> tuple[DataFrame, list[str]]:
    """One row per key: for each patched field f its last value ``_p_f`` and whether it was supplied, ``_s_f``; and the fields."""
    fields = [c for c in patches.columns if c not in (*key, seq, supplied)]
    given = {f: F.array_contains(supplied, f) for f in fields}
    return pin(patches.groupBy(*key).agg(
        *[F.max_by(F.when(given[f], F.col(f)), F.when(given[f], F.col(seq))).alias(f"_p_{f}") for f in fields],
        *[F.bool_or(given[f]).alias(f"_s_{f}") for f in fields],
    ), "update"), fields


def insert_if_absent(
    store: DataFrame, batch: DataFrame, arrival: str, key: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(store with new rows, rejected rows). The first arrival of a new key wins; ``arrival`` is unique."""
    key = key or STORE_KEY
    first = first_arrivals(batch, arrival, key)
    known = _prefixed(_present(store, first, key), key)
    accepted = first.join(known, _same(key), "left_anti")
    rejected = batch.join(accepted.select(arrival), arrival, "left_anti")
    return store.unionByName(accepted.drop(*[c for c in [arrival] if c not in store.columns])), rejected


def update_by_key(
    store: DataFrame, patches: DataFrame, seq: str, supplied: str = "supplied", key: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(patched store, keys not found).

    ``supplied`` lists the fields a patch sets, so a patch may set NULL. Later
    patches (by ``seq``) win field by field. Fields new to the store are added.
    """
    key = key or STORE_KEY
    merged, fields = merged_patches(patches, seq, supplied, key)
    joined = store.join(broadcast_if_small(_prefixed(merged, key)), _same(key), "left")
    old = lambda f: F.col(f) if f in store.columns else F.lit(None)
    new = {f: F.when(F.col(f"_s_{f}"), F.col(f"_p_{f}")).otherwise(old(f)).alias(f) for f in fields}
    patched = joined.select(
        *[new.get(c, F.col(c)) for c in store.columns], *[new[f] for f in fields if f not in store.columns]
    )
    keys = merged.select(*key)
    return patched, keys.join(_prefixed(_present(store, keys, key), key), _same(key), "left_anti")


def delete_by_key(store: DataFrame, keys: DataFrame, key: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(store without the keys, keys not found)."""
    key = key or STORE_KEY
    gone = pin(keys.select(*key).distinct(), "delete")
    left = store.join(broadcast_if_small(_prefixed(gone, key)), _same(key), "left_anti")
    return left, gone.join(_prefixed(_present(store, gone, key), key), _same(key), "left_anti")


def append_row(df: DataFrame, row: DataFrame) -> DataFrame:
    return df.unionByName(row)
