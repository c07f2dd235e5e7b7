"""Update by key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.names import quote_column
from ferryline.shared import materialize, stored

_ORDER, _HASH = "_order", "_hash"


def _col(name: str) -> Column:
    return F.col(quote_column(name))


def _free(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    used = {c.lower() for c in taken}
    while name in used:
        name = "_" + name
    return name


def one_row_per_key(
    changes: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Changes with unique keys.

    Without ``order_by`` a repeated key fails the job. With it the row that is
    last in that order wins; different rows that tie for last fail the job, so
    no row is ever picked at random. Changes with a NULL key match nothing and
    are left out. Aggregates on the map side, so a key with very many changes
    sends one row per task. Whole rows are the aggregate's buffers, so each task sorts
    its changes by key before it reduces them; changes are few beside the target.
    """
    keys, order_by = list(keys), list(order_by)
    for key in keys:
        changes = changes.where(_col(key).isNotNull())
    kept, count, high, low = (_free(n, keys) for n in ("_row", "_count", "_high", "_low"))
    by_key = [_col(k) for k in keys]
    payload = [c for c in changes.columns if c not in keys and c not in order_by]
    row = F.struct(*[_col(c) for c in (payload or keys)])
    if not order_by:
        grouped = changes.groupBy(*by_key).agg(
            F.first(row).alias(kept), F.count(F.lit(1)).alias(count)
        )
        broken, reason = F.col(count) > 1, "several changes for one key"
    else:
        order = F.struct(*[_col(c) for c in order_by])
        hashed = F.xxhash64(*[_col(c) for c in (payload or keys)])
        # Largest and smallest hash among the rows that are last: they differ
        # exactly when unlike rows tie. ~x reverses the order of longs.
        grouped = changes.groupBy(*by_key).agg(
            F.max_by(row, F.struct(order, hashed)).alias(kept),
            F.max(F.struct(order.alias(_ORDER), hashed.alias(_HASH))).alias(high),
            F.max(F.struct(order.alias(_ORDER), F.bitwise_not(hashed).alias(_HASH))).alias(low),
        )
        broken = F.col(high)[_HASH] != F.bitwise_not(F.col(low)[_HASH])
        reason = "changes for one key tie in order"
    checked = F.when(broken, F.raise_error(F.lit(reason))).otherwise(F.col(kept))
    return grouped.select(*by_key, checked.alias(kept)).select(
        *by_key, *[F.col(kept).getField(c).alias(c) for c in payload]
    )


def update_by_key(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``target`` with the matching rows' columns set from ``changes``.

    Updates only, never inserts; a NULL in a change sets NULL, as in SQL. Columns
    that ``changes`` lacks stay as they are.

    The deduplicated changes are stored first. Both join inputs are then plain
    exchanges, for which adaptive execution can broadcast the changes when their
    measured size allows it and otherwise split the partitions of a hot key.
    """
    values = _values(target, changes, keys, order_by)
    return _applied(target, materialize(one_row_per_key(changes, keys, order_by), "changes"),
                    list(keys), values)


@contextmanager
def updated_by_key(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> Iterator[DataFrame]:
    """:func:`update_by_key` for a ``with`` block, which deletes the stored changes at its end.

    Write the rows inside the block; the plan cannot be run after it.
    """
    values = _values(target, changes, keys, order_by)
    with stored(one_row_per_key(changes, keys, order_by), "changes") as unique:
        yield _applied(target, unique, list(keys), values)


def unique_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """:func:`one_row_per_key` after the checks of an update."""
    _values(target, changes, keys, order_by)
    return one_row_per_key(changes, keys, order_by)


def updated_rows(target: DataFrame, unique: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the values of changes that are unique by key already."""
    return _applied(target, unique, list(keys), [c for c in unique.columns if c not in keys])


def _values(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> list[str]:
    """The columns to set."""
    keys = list(keys)
    values = [c for c in changes.columns if c not in keys and c not in order_by]
    unknown = set(values + keys) - set(target.columns)
    if unknown:
        raise ValueError(f"columns not in the target: {sorted(unknown)}")
    if not values:
        raise ValueError("no columns to update besides the keys")
    return values


def _applied(
    target: DataFrame, unique: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    row =_free("_row", target.columns)
    new = unique.select(*[_col(k) for k in keys], F.struct(*[_col(c) for c in values]).alias(row))

    def updated(name: str) -> Column:
        if name not in values:
            return _col(name)
        value = F.col(row).getField(name).cast(target.schema[name].dataType)
        return F.when(F.col(row).isNotNull(), value).otherwise(_col(name)).alias(name)

    return target.join(new, keys, "left").select(*[updated(c) for c in target.columns])
