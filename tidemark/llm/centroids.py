"""Centroid clustering by Lloyd's rounds over vectors that are sharded by dimension.

A shard is a block of components. Its tasks read that block alone and know that slice of the centroids alone; they give
exact partial squared distances, whose sums over the blocks choose the nearest centroid. Each shard then updates its own
slice from the assignments. All arithmetic is in integers, so that the result does not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Components up to this size give squared distances below 2^63 with 64 of them.
LARGEST = 1 << 27


def _usable(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def _partial(part: np.ndarray, keys: tuple[str, str]):
    """Maps (row, id, block of components) to the squared distances from each centroid's slice."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, part.shape[1])
            apart = [pa.array(((values - slice_) ** 2).sum(axis=1)) for slice_ in part]
            names = [*keys, *[f"d{j}" for j in range(len(part))]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *apart], names=names)

    return measure


def _assign(shards: DataFrame, slices: list[np.ndarray], label: str) -> DataFrame:
    """row, id, cluster, distance: partial distances of all blocks, added by row; the smaller number wins a tie."""
    k = len(slices[0])
    id_type = shards.schema["id"].dataType.simpleString()
    schema = f"row long, id {id_type}, " + ", ".join(f"d{j} long" for j in range(k))
    partial = None
    for b, part in enumerate(slices):
        block = shards.select("row", "id", f"s{b}").mapInArrow(_partial(part, ("row", "id")), schema)
        partial = block if partial is None else partial.union(block)
    summed = partial.groupBy("row", "id").agg(*[F.sum(f"d{j}").alias(f"d{j}") for j in range(k)])
    all_of = F.array(*[f"d{j}" for j in range(k)])
    nearest = summed.withColumn("distance", F.array_min(all_of))
    return stage(nearest.select("row", "id", (F.array_position(all_of, F.col("distance")) - 1).cast("int").alias("cluster"), "distance"), label)


def _updated(shards: DataFrame, assigned: DataFrame, slices: list[np.ndarray]) -> list[np.ndarray]:
    """Each block's slice of the new centroids: floors of the exact means; a centroid without vectors stays.

    What comes to the driver is a row of sums for each block and cluster.
    """
    sums = None
    for b, part in enumerate(slices):
        width = part.shape[1]
        block = shards.select("row", f"s{b}").join(assigned.select("row", "cluster"), "row")
        block = block.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*[F.sum(F.col(f"s{b}")[i]) for i in range(width)]).alias("sums"))
        block = block.select(F.lit(b).alias("block"), "cluster", "n", "sums")
        sums = block if sums is None else sums.union(block)
    fresh = [part.copy() for part in slices]
    for r in sums.collect():
        fresh[r["block"]][r["cluster"]] = [total // r["n"] for total in r["sums"]]
    return fresh


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    blocks: int = 2,
    seed: str = "1",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Columns id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row for each usable vector.

    Vectors with another number of components, or with a null or non-finite one, are left out. A component x counts as
    floor(scale * x). The first centroids are the k vectors whose ids have the smallest SHA-256 after ``seed``, in that
    order; of equal ids the one with the smaller components comes first, null ids come last. With fewer vectors there are
    fewer centroids. Each of ``rounds`` assigns every vector to the nearest centroid (of equals the smaller number) and
    replaces it by the floor of its vectors' mean; at the end vectors are assigned once more.

    Repeated rows are vectors of their own. An empty table gives an empty result. Other columns are not looked at.
    Components over 2^27 after scaling raise an error, as squared distances would not be exact in 63 bits.
    """
    spark = vectors.sparkSession
    vector = F.col(f"`{vector_col}`")
    kept = vectors.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector")).filter(_usable(F.col("vector"), dims))
    whole = F.transform("vector", lambda x: F.floor(scale * x.cast("double")).cast("long"))
    kept = kept.select(F.monotonically_increasing_id().alias("row"), "id", whole.alias("whole"))
    width = -(-dims // blocks)
    edges = [(b, min(width, dims - b * width)) for b in range(blocks) if b * width < dims]
    shards = kept.select("row", "id", *[F.slice("whole", b * width + 1, n).alias(f"s{b}") for b, n in edges])
    # One column for each block: Parquet keeps them apart, and tasks of a block read no other.
    shards = stage(shards, "shards")
    columns = [f"s{b}" for b, _ in edges]
    out = [id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    extent = shards.agg(F.max(F.greatest(*[F.greatest(F.array_max(c), -F.array_min(c)) for c in columns], F.lit(0).cast("long")))).first()[0]
    if extent is None:
        none = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
        return shards.select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in none.items()]).select(out)
    if extent > LARGEST:
        raise ValueError(f"a component is {extent} after scaling; at most {LARGEST} can be told apart exactly")

    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = shards.orderBy(draw.asc_nulls_last(), *columns, "row").limit(k).select(*columns).collect()
    slices = [np.array([r[c] for r in first], np.int64) for c in columns]
    for turn in range(rounds):
        slices = _updated(shards, _assign(shards, slices, f"assigned-{turn}"), slices)
    assigned = _assign(shards, slices, "assigned")

    lines = [",".join(map(str, np.concatenate(parts).tolist())) for parts in zip(*slices)]
    inertia = {r["cluster"]: int(r["inertia"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    total = sum(inertia.values())
    # Sums that are too large for a long become null.
    per_cluster = F.create_map(*[F.lit(v) for c, n in inertia.items() for v in (c, str(n))])
    digests = F.sha2(F.element_at(F.array(*[F.lit(x) for x in lines]), F.col("cluster") + 1), 256)
    return assigned.select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        F.element_at(per_cluster, F.col("cluster")).try_cast("long").alias("cluster_inertia"),
        F.lit(str(total)).try_cast("long").alias("inertia"),
        digests.alias("centroid_sha256"),
    )
