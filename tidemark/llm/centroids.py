"""Centroid clustering over blocks of neighbouring vectors with zone maps.

Vectors are scaled to integers, ordered along a Hilbert curve through their
coarse cells, and cut into blocks that carry the least and greatest value of
every component. Of a centroid and a box, the nearest and the farthest point of
the box bound the distances of all vectors in the block: a centroid whose
nearest point is farther than the best centroid's farthest point can be nearest
to none of them. Only the others are compared, exactly, in integers. So each
round reads the blocks once and shuffles one row of sums per task and cluster.

On data without structure the boxes overlap and most centroids stay candidates;
results are the same, with the comparison of all.

* Vectors of another length, null vectors and those with a null, NaN or infinite
  component are left out. A null id is kept; as a seed its digits are missing.
* Components beyond 2**27 after scaling are set to that bound: a greater one
  would leave no room for a squared distance in 64 bits.
* Ties go to the smaller cluster number; rows repeated are vectors of their own.
* With fewer vectors than clusters each is a centroid; an empty table gives none.
* Columns other than id and vector are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import Steps

#: Vectors of a block; boxes are tighter with fewer.
BLOCK = 128
#: Greatest size of a scaled component.
BOUND = 1 << 27
#: Coarse cells of the curve: quartiles of a normal component, so two bits each.
QUARTILE, CELL_BITS = 0.6745, 2

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Shape:
    """Columns and form of the vectors."""

    id: str = "vec_id"
    vector: str = "embedding"
    dims: int = 64
    scale: float = 256.0


def whole_vectors(frame: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Id and vector of the rows that can be clustered."""
    sound = F.forall(shape.vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return frame.select(shape.id, shape.vector).where(
        (F.size(shape.vector) == shape.dims) & F.coalesce(sound, F.lit(False)))


def scaled(column: pa.Array, shape: Shape) -> np.ndarray:
    """Rows of floor(scale * x) as int32."""
    flat = np.asarray(column.flatten(), np.float64).reshape(-1, shape.dims)
    return np.clip(np.floor(shape.scale * flat), -BOUND, BOUND).astype(np.int32)


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of cells, 0 to 2**bits - 1 a component, on the Hilbert curve, as sortable bytes.

    Bits are undone from the greatest down: where a component has the bit, the
    lower bits of the first component turn over, else they change places with
    the component's; a Gray code of the bits is left.
    """
    x = cells.T.astype(np.uint32).copy()
    for bit in range(bits - 1, 0, -1):
        high, low = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for i in range(len(x)):
            swap = np.where(x[i] & high, np.uint32(0), (x[0] ^ x[i]) & low)
            turn = np.where(x[i] & high, low, np.uint32(0))
            x[0] ^= swap | turn
            x[i] ^= swap
    np.bitwise_xor.accumulate(x, axis=0, out=x)
    carry = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        carry ^= np.where(x[-1] & np.uint32(1 << bit), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= carry
    planes = np.stack([(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)])
    packed = np.packbits(planes.astype(np.uint8).reshape(-1, x.shape[1]).T, axis=1)
    return [row.tobytes() for row in packed]


def _moments(frame: DataFrame, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each component over all vectors; they only shape the blocks."""
    def sums(batches: Batches) -> Batches:
        total = np.zeros((2, shape.dims))
        n = 0
        for batch in batches:
            x = scaled(batch.column(0), shape).astype(np.float64)
            n += len(x)
            total += np.stack([x.sum(0), (x * x).sum(0)])
        yield pa.record_batch({"n": [n] * shape.dims, "dim": np.arange(shape.dims), "s": total[0], "q": total[1]})
    rows = (frame.select(shape.vector).mapInArrow(sums, "n long, dim long, s double, q double")
            .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).collect())
    moments = np.array([[r["s"], r["q"], max(r["n"], 1)] for r in sorted(rows, key=lambda r: r["dim"])])
    mean = moments[:, 0] / moments[:, 2]
    return mean, np.sqrt(np.maximum(moments[:, 1] / moments[:, 2] - mean ** 2, 0))


def zone_blocks(steps: Steps, vectors: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Blocks of neighbours on the curve: ids, vectors as packed int32, and their box.

    The range shuffle breaks ties of the curve by a number of the row, so that
    vectors that equal each other share no task by necessity.
    """
    if vectors.isEmpty():
        mean = spread = np.zeros(shape.dims)
    else:
        mean, spread = _moments(vectors, shape)
    cuts = np.stack([mean - QUARTILE * spread, mean, mean + QUARTILE * spread])
    id_type = vectors.schema[shape.id].dataType.simpleString()

    def keyed(batches: Batches) -> Batches:
        for batch in batches:
            x = scaled(batch.column(1), shape)
            cells = (x[None] > cuts[:, None]).sum(0)
            yield pa.record_batch({
                "key": pa.array(hilbert_keys(cells, CELL_BITS), pa.binary()), "row": batch.column(2),
                "id": batch.column(0), "v": pa.array([r.tobytes() for r in x], pa.binary())})

    def cut(batches: Batches) -> Batches:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            whole = pa.Table.from_batches([*rest, batch]).combine_chunks()
            full = whole.num_rows // BLOCK * BLOCK
            if full:
                yield _block_rows(whole.slice(0, full), shape)
            rest = whole.slice(full).to_batches()
        if rest and sum(r.num_rows for r in rest):
            yield _block_rows(pa.Table.from_batches(rest).combine_chunks(), shape)

    ordered = (vectors.withColumn("row", F.monotonically_increasing_id())
               .mapInArrow(keyed, f"key binary, row long, id {id_type}, v binary")
               .repartitionByRange("key", "row").sortWithinPartitions("key", "row"))
    return steps.keep(ordered.select("id", "v").mapInArrow(
        cut, f"ids array<{id_type}>, vectors binary, lo binary, hi binary"))


def _block_rows(rows: pa.Table, shape: Shape) -> pa.RecordBatch:
    ids = rows.column("id").combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    starts = np.r_[np.arange(0, rows.num_rows, BLOCK), rows.num_rows].astype(np.int32)
    x = np.frombuffer(b"".join(rows.column("v").to_pylist()), np.int32).reshape(-1, shape.dims)
    parts = [x[a:b] for a, b in zip(starts, starts[1:])]
    binary = {"vectors": [p.tobytes() for p in parts], "lo": [p.min(0).tobytes() for p in parts],
              "hi": [p.max(0).tobytes() for p in parts]}
    return pa.record_batch({"ids": pa.ListArray.from_arrays(pa.array(starts), ids),
                            **{name: pa.array(cells, pa.binary()) for name, cells in binary.items()}})


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector of the box."""
    near = np.maximum(np.maximum(lo - centroids, centroids - hi), 0)
    far = np.maximum(np.abs(centroids - lo), np.abs(hi - centroids))
    return np.flatnonzero((near * near).sum(1) <= (far * far).sum(1).min())


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest centroid, exact; the first of equals.

    Whole numbers whose sums stay below 2**53 are exact as doubles, which multiply faster.
    """
    size = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    kind = np.float64 if 4 * vectors.shape[1] * int(size) ** 2 < 1 << 53 else np.int64
    x, c = vectors.astype(kind), centroids.astype(kind)
    distances = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    best = distances.argmin(1)
    return best, distances[np.arange(len(x)), best].astype(np.int64)


def _assigned(batches: Batches, centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    dims = centroids.shape[1]
    for batch in batches:
        for row in range(batch.num_rows):
            ids, vectors, lo, hi = (batch.column(i)[row] for i in range(4))
            x = np.frombuffer(vectors.as_py(), np.int32).reshape(-1, dims).astype(np.int64)
            box = [np.frombuffer(side.as_py(), np.int32).astype(np.int64) for side in (lo, hi)]
            chosen = candidates(*box, centroids)
            best, distance = nearest(x, centroids[chosen])
            yield ids.values, x, chosen[best], distance


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floored means, exact; a centroid without vectors stays."""
    k, dims = centroids.shape

    def sums(batches: Batches) -> Batches:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x, cluster, _ in _assigned(batches, centroids):
            present = np.unique(cluster)
            for c in present:
                total[c] += x[cluster == c].sum(0)
            n += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(n)
        yield pa.record_batch({"cluster": some, "n": n[some], "s": pa.array(list(total[some]), pa.list_(pa.int64()))})

    exact = "decimal(38,0)"
    rows = (blocks.mapInArrow(sums, "cluster long, n long, s array<long>")
            .select("cluster", "n", F.posexplode("s").alias("dim", "s"))
            .groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(exact)).alias("s")).collect())
    after = centroids.copy()
    for r in rows:
        after[r["cluster"], r["dim"]] = int(r["s"]) // r["n"]
    return after


def seeds(vectors: DataFrame, k: int, seed: int, shape: Shape = Shape()) -> np.ndarray:
    """The k vectors whose ids hash least, in that order; equal ids go by their vectors."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(shape.id).cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("key"), F.col(shape.vector).alias("v")).orderBy("key", "v").limit(k).collect()
    flat = pa.array([r["v"] for r in rows], pa.list_(pa.float64()))
    return scaled(flat, shape).astype(np.int64)


def fit(blocks: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after some rounds; a round that moves none is the last, as later ones would not either."""
    for _ in range(rounds):
        before, centroids = centroids, moved(blocks, centroids)
        if np.array_equal(before, centroids):
            break
    return centroids


def assignments(blocks: DataFrame, centroids: np.ndarray, shape: Shape = Shape()) -> DataFrame:
    """Id, cluster and squared distance of every vector."""
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()

    def assign(batches: Batches) -> Batches:
        for ids, _, cluster, distance in _assigned(batches, centroids):
            yield pa.record_batch({shape.id: ids, "cluster": cluster.astype(np.int32), "distance": distance})
    return blocks.mapInArrow(assign, f"`{shape.id}` {id_type}, cluster int, distance long")


def pruned_share(blocks: DataFrame, centroids: np.ndarray) -> float:
    """Share of the pairs of vector and centroid that the boxes rule out."""
    k, dims = centroids.shape

    def count(batches: Batches) -> Batches:
        for batch in batches:
            left = [len(candidates(*(np.frombuffer(batch.column(i)[r].as_py(), np.int32).astype(np.int64)
                                     for i in (2, 3)), centroids)) for r in range(batch.num_rows)]
            sizes = [len(batch.column(1)[r].as_py()) // (4 * dims) for r in range(batch.num_rows)]
            yield pa.record_batch({"left": np.multiply(left, sizes).astype(np.int64),
                                   "pairs": (np.array(sizes) * k).astype(np.int64)})
    found = blocks.mapInArrow(count, "left long, pairs long").agg(F.sum("left"), F.sum("pairs")).first()
    return 1 - found[0] / found[1] if found[1] else 0.0


def clusters(frame: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, shape: Shape = Shape()) -> DataFrame:
    """Cluster, squared distance, the sums of the distances and the centroid's hash for every vector.

    Sums beyond 64 bits are null. The driver holds k centroids and k sums.
    """
    steps = Steps(frame.sparkSession, "centroids")
    vectors = whole_vectors(frame, shape)
    blocks = zone_blocks(steps, vectors, shape)
    centroids = fit(blocks, seeds(vectors, k, seed, shape), rounds) if not blocks.isEmpty() else np.zeros(
        (0, shape.dims), np.int64)
    assigned = steps.keep(assignments(blocks, centroids, shape))
    found = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    sums = {r["cluster"]: int(r["d"]) for r in found}
    inside = lambda total: total if total < 1 << 63 else None
    rows = [(c, inside(sums[c]), inside(sum(sums.values())),
             hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in sorted(sums)]
    about = frame.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(
        shape.id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64) -> str:
    """The same in SQL, each round a pair of tables: the assignment and the moved centroids."""
    parts = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), cells AS MATERIALIZED (
  SELECT row, dim, floor(256 * embedding[dim]::DOUBLE)::BIGINT AS x
  FROM kept, (SELECT unnest(range(1, {dims + 1})) AS dim)
), first AS (
  SELECT row, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), embedding) - 1 AS c
  FROM kept
), c0 AS MATERIALIZED (SELECT c, dim, x FROM first JOIN cells USING (row) WHERE c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT row, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT row, c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS d FROM cells v JOIN c{i} m USING (dim) GROUP BY row, c)
  GROUP BY row
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT old.c, old.dim, coalesce((s - ((s % n) + n) % n) // n, old.x) AS x
  FROM c{i} old LEFT JOIN (
    SELECT best.c AS c, dim, sum(x) AS s, count(*) AS n FROM a{i} JOIN cells USING (row) GROUP BY ALL) new
  ON old.c = new.c AND old.dim = new.dim
)""")
    return ",\n".join(parts) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
  sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
  centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN (
  SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h
ON h.c = best.c
"""


ORACLE = oracle()
