"""Compare an incoming frame with a stored table's schema, and bring it into line."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.keys import lowercase_columns
from ..spec import METADATA_COLUMNS


class SchemaMismatch(ValueError):
    """The incoming schema cannot be written to the table as it is."""


def without_metadata(schema: StructType) -> StructType:
    return StructType([f for f in schema.fields if f.name not in METADATA_COLUMNS])


@dataclass(frozen=True)
class SchemaDiff:
    added: tuple[StructField, ...]
    missing: tuple[StructField, ...]
    retyped: tuple[tuple[StructField, StructField], ...]  # (stored, incoming)
    renullable: tuple[str, ...]
    reordered: bool

    @property
    def same(self) -> bool:
        """Same names, types and order.  Nullability is reported, not enforced."""
        return not (self.added or self.missing or self.retyped or self.reordered)

    def describe(self) -> str:
        parts = [f"added {f.name} {f.dataType.simpleString()}" for f in self.added]
        parts += [f"missing {f.name} {f.dataType.simpleString()}" for f in self.missing]
        parts += [
            f"retyped {old.name} {old.dataType.simpleString()} -> {new.dataType.simpleString()}"
            for old, new in self.retyped
        ]
        if self.reordered:
            parts.append("reordered")
        return "; ".join(parts)


def diff_schemas(incoming: StructType, stored: StructType) -> SchemaDiff:
    """Differences by name, in a stable order; metadata columns are left out."""
    incoming, stored = without_metadata(incoming), without_metadata(stored)
    new = {f.name: f for f in incoming.fields}
    old = {f.name: f for f in stored.fields}
    common = [f.name for f in stored.fields if f.name in new]
    return SchemaDiff(
        added=tuple(f for f in incoming.fields if f.name not in old),
        missing=tuple(f for f in stored.fields if f.name not in new),
        retyped=tuple(
            (old[c], new[c]) for c in common if old[c].dataType != new[c].dataType
        ),
        renullable=tuple(c for c in common if old[c].nullable != new[c].nullable),
        reordered=common != [f.name for f in incoming.fields if f.name in old],
    )


def _uncastable(diff: SchemaDiff):
    """Number of incoming values that would not survive a cast to the stored types."""
    total = F.lit(0).cast("bigint")
    for stored, _ in diff.retyped:
        lost = F.col(stored.name).isNotNull() & F.col(stored.name).try_cast(stored.dataType).isNull()
        total = total + F.count_if(lost)
    return total


def validate(df: DataFrame, stored: StructType) -> DataFrame:
    """One-row report: ok, what differs, and how many values a cast would lose.

    The values are counted in one pass that reads the retyped columns only.
    """
    diff = diff_schemas(df.schema, stored)
    return df.agg(_uncastable(diff).alias("n_uncastable")).select(
        F.lit(diff.same).alias("ok"),
        F.lit(len(diff.added)).cast("bigint").alias("n_added"),
        F.lit(len(diff.missing)).cast("bigint").alias("n_missing"),
        F.lit(len(diff.retyped)).cast("bigint").alias("n_retyped"),
        "n_uncastable",
    )


def is_valid(df: DataFrame, stored: StructType, exact: bool = False) -> bool:
    """True when the schemas agree; ``exact`` compares nullability as well.  Runs no job."""
    diff = diff_schemas(df.schema, stored)
    return diff.same and not (exact and diff.renullable)


def changes_report(df: DataFrame, stored: StructType) -> DataFrame:
    """One row per differing column: column, change, and how many incoming rows fill it."""
    diff = diff_schemas(df.schema, stored)
    changes = [(f.name, "added") for f in diff.added]
    changes += [(f.name, "missing") for f in diff.missing]
    changes += [(f.name, "retyped") for f, _ in diff.retyped]
    if not changes:
        return df.sparkSession.createDataFrame([], "column string, change string, n_values bigint")
    counts = df.agg(
        *[
            (F.lit(0).cast("bigint") if change == "missing" else F.count(F.col(name))).alias(f"_{i}")
            for i, (name, change) in enumerate(changes)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(change).alias("change"),
                F.col(f"_{i}").alias("n_values"),
            )
            for i, (name, change) in enumerate(changes)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def evolve(
    df: DataFrame, stored: StructType, strict: bool = False, force_cast: bool = True
) -> tuple[bool, DataFrame]:
    """Project an incoming frame onto the stored schema.

    Stored columns come first, in stored order; a missing one becomes a typed
    NULL and new columns go last, in incoming order.  ``force_cast`` casts
    retyped columns back, turning values that do not cast into NULL.  ``strict``
    refuses any difference: ``(False, df)``.
    """
    df = lowercase_columns(df)
    diff = diff_schemas(df.schema, stored)
    if diff.same:
        return True, df
    if strict:
        return False, df
    missing = {f.name for f in diff.missing}
    retyped = {f.name for f, _ in diff.retyped}
    columns = []
    for field in without_metadata(stored).fields:
        if field.name in missing:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif field.name in retyped and force_cast:
            columns.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            columns.append(F.col(field.name))
    return True, df.select(*columns, *[F.col(f.name) for f in diff.added])


def fill_missing(df: DataFrame, stored: StructType) -> DataFrame:
    """Add a typed NULL for every stored column the frame lacks."""
    missing = diff_schemas(df.schema, stored).missing
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def conform(df: DataFrame, stored: StructType, partial: Sequence[str] = ()) -> DataFrame:
    """Ready a change set for writing: match by name, fill what is missing, keep what is new.

    A retyped column raises before anything is written.
    """
    df = lowercase_columns(df)
    diff = diff_schemas(df.schema, stored)
    if diff.retyped:
        raise SchemaMismatch(f"incoming types differ from the table: {diff.describe()}")
    lost = [f.name for f in diff.missing if f.name in partial]
    if lost:
        raise SchemaMismatch(f"change set lacks {', '.join(lost)}")
    return evolve(df, stored, force_cast=False)[1]


def widen(stored: StructType, incoming: StructType) -> StructType:
    """The stored schema with the incoming frame's new columns at the end, all nullable."""
    added = [StructField(f.name, f.dataType, True) for f in diff_schemas(incoming, stored).added]
    return StructType([*stored.fields, *added])
