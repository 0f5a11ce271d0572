"""Keyed changes as plans: DataFrame in, DataFrame out, nothing written.

None of these carries a broadcast hint.  Spark knows the size of a stored change
set and broadcasts it when it is under ``spark.sql.autoBroadcastJoinThreshold``;
above that the joins shuffle both sides on the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..spec import COMMIT_TIME, DELETE, EVENT_TIME, TableSpec
from .precombine import precombine

DELETED = "_deleted"
# set on a change that wins whatever its ordering value is
FORCED = "_forced"


def _newest(changes: DataFrame, spec: TableSpec) -> DataFrame:
    return precombine(changes, spec.identity, spec.order_by, spec.tie_breakers)


def upsert(
    base: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    policy: str | None = None,
    deduplicated: bool = False,
) -> DataFrame:
    """Replace matched rows, add unmatched ones, keep the rest.

    ``changes`` may have columns the base lacks; older rows show NULL there.
    ``deduplicated`` skips the precombine step for a change set already unique.
    """
    policy = policy or spec.policy
    if policy == DELETE:
        return hard_delete(base, changes, spec.identity)
    incoming = changes if deduplicated else _newest(changes, spec)
    if policy == EVENT_TIME:
        incoming = _not_older(base, incoming, spec)
    kept = base.join(incoming.select(*spec.identity), list(spec.identity), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def _not_older(base: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """Incoming rows that are not beaten by a stored row with a larger ordering value."""
    on = list(spec.identity)
    stored = base.select(*on, F.struct(*spec.order_by).alias("_stored"))
    offered = incoming.select(*on, offered_order(incoming, spec).alias("_offered"))
    beaten = stored.join(offered, on).filter("_stored > _offered").select(*on)
    return incoming.join(beaten, on, "left_anti")


def offered_order(changes: DataFrame, spec: TableSpec) -> Column:
    """The ordering value a change competes with; NULL, which nothing beats, when it is forced."""
    order = F.struct(*spec.order_by)
    return F.when(~F.col(FORCED), order) if FORCED in changes.columns else order


def hard_delete(base: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the list; repeated or unknown keys do no harm."""
    return base.join(keys.select(*on), list(on), "left_anti")


def delete_where(base: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true (NULL keeps the row)."""
    return base.filter(~F.coalesce(predicate, F.lit(False)))


def delete_candidates(base: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join with a list of ids; an id listed twice returns its rows twice."""
    return base.alias("a").join(ids.select(*on).alias("b"), list(on)).select("a.*")


def delete_candidates_semi(base: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    """The same rows once each, however often an id is listed."""
    return base.join(ids.select(*on), list(on), "left_semi")


def blank_values(
    df: DataFrame, spec: TableSpec, values: Mapping[str, object] | None = None
) -> dict[str, Column]:
    """Column -> replacement for a soft delete; without a map, NULL for every free column.

    Key, partition and ordering columns stay as they are.
    """
    protected = {*spec.keys, *spec.partition_by, *spec.order_by}
    if values is None:
        values = {c: None for c in df.columns if c not in protected and not c.startswith("_")}
    clash = sorted(protected.intersection(values))
    if clash:
        raise ValueError(f"cannot blank key, partition or ordering columns: {', '.join(clash)}")
    types = {f.name: f.dataType for f in df.schema.fields}
    return {c: F.lit(v).cast(types[c]) for c, v in values.items()}


def soft_delete(
    base: DataFrame,
    keys: DataFrame,
    spec: TableSpec,
    values: Mapping[str, object] | None = None,
    on: Sequence[str] | None = None,
) -> DataFrame:
    """The table with the listed records kept but their fields blanked; one pass over it."""
    on = list(on or spec.identity)
    listed = keys.select(*on).distinct().withColumn("_listed", F.lit(True))
    return (
        base.join(listed, on, "left")
        .withColumns(
            {
                c: F.when(F.col("_listed"), blank).otherwise(F.col(c))
                for c, blank in blank_values(base, spec, values).items()
            }
        )
        .select(*base.columns)
    )


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """SET columns on the rows where the predicate holds."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            c: F.when(predicate, value.cast(types[c])).otherwise(F.col(c))
            for c, value in assignments.items()
        }
    )


def newest_delta(delta: DataFrame, spec: TableSpec) -> DataFrame:
    """One pending change per key: the last commit wins, or the largest ordering value.

    A delete ends what came before it.  It carries no ordering value, so under
    ``event_time`` it, and whatever follows it, is marked as winning over the base.
    """
    if DELETED not in delta.columns:
        delta = delta.withColumn(DELETED, F.lit(False))
    commit = (COMMIT_TIME,) if COMMIT_TIME in delta.columns else ()
    if spec.policy != EVENT_TIME:
        latest = precombine(delta, spec.identity, (*commit, *spec.order_by), spec.tie_breakers)
        return latest.withColumn(FORCED, F.lit(False))
    if commit:
        # at most one row per key and commit reaches this window
        deleted_at = F.max(F.when(F.col(DELETED), F.col(COMMIT_TIME))).over(Window.partitionBy(*spec.identity))
        delta = delta.withColumn("_deleted_at", deleted_at)
        delta = delta.filter(F.col("_deleted_at").isNull() | (F.col(COMMIT_TIME) >= F.col("_deleted_at")))
        delta = delta.withColumn(FORCED, F.col("_deleted_at").isNotNull()).drop("_deleted_at")
    else:
        delta = delta.withColumn(FORCED, F.col(DELETED))
    return precombine(delta, spec.identity, spec.order_by, (*commit, *spec.tie_breakers))


def merge_on_read(base: DataFrame, delta: DataFrame, spec: TableSpec) -> DataFrame:
    """Base with its pending changes applied; rows flagged as deleted drop out.

    Only the delta is aggregated.  The base is filtered by an anti-join, which is
    a broadcast join, with no shuffle of the base, while the delta is small.
    """
    flagged = base.withColumns({DELETED: F.lit(False), FORCED: F.lit(False)})
    merged = upsert(flagged, newest_delta(delta, spec), spec, deduplicated=True)
    return merged.filter(~F.col(DELETED)).drop(DELETED, FORCED)


def pending_changes(base: DataFrame, delta: DataFrame, spec: TableSpec, column: str) -> DataFrame:
    """Where the base is behind: the stored and the pending value of one column.

    A new record has no old value, a pending delete no new one.
    """
    on = list(spec.identity)
    latest = newest_delta(delta, spec)
    if spec.policy == EVENT_TIME:
        latest = _not_older(base, latest, spec)
    new = latest.select(
        *on,
        F.when(~F.col(DELETED), F.col(column)).alias(f"new_{column}"),
        DELETED,
    )
    stored = base.select(*on, F.col(column).alias(f"old_{column}"))
    matched = stored.join(new, on)
    added = (
        new.filter(~F.col(DELETED))
        .join(matched.select(*on), on, "left_anti")
        .withColumn(f"old_{column}", F.lit(None).cast(base.schema[column].dataType))
    )
    changed = matched.filter(
        F.col(DELETED) | ~F.col(f"old_{column}").eqNullSafe(F.col(f"new_{column}"))
    )
    return changed.unionByName(added).select(*on, f"old_{column}", f"new_{column}")


def pending_actions(base: DataFrame, delta: DataFrame, spec: TableSpec) -> DataFrame:
    """How many keys the pending changes would insert, update and delete: one row, from a key-only join with the base.

    A stored row that an ordering value protects is none of them, nor is a delete of a key that is not stored.
    """
    on = list(spec.identity)
    wanted = [c for c in dict.fromkeys((*on, *spec.order_by, *spec.tie_breakers, COMMIT_TIME, DELETED)) if c in delta.columns]
    latest = newest_delta(delta.select(*wanted), spec)
    if spec.policy == EVENT_TIME:
        latest = _not_older(base, latest, spec)
    # a repeated stored key is one key
    stored = base.select(*on).distinct().withColumn("_stored", F.lit(True))
    met = latest.select(*on, DELETED).join(stored, on, "left")
    is_stored = F.col("_stored").isNotNull()
    return met.agg(
        F.count_if(~F.col(DELETED) & ~is_stored).alias("n_insert"),
        F.count_if(~F.col(DELETED) & is_stored).alias("n_update"),
        F.count_if(F.col(DELETED) & is_stored).alias("n_delete"),
    )
