"""Near-duplicate groups of embeddings by randomised-rotation binary codes.

A unit vector o is rotated by a fixed random orthogonal matrix; its code is the
sign of each coordinate (the unit vector x), stored with the correction factor
f = <x, o>.  For another rotated unit vector q, <x, q> / f estimates <o, q>
without bias, with an error of about sqrt((1 - f^2) / f^2 / (d - 1)); and the
angles of a triangle give the certain bound f s + sqrt(1 - f^2) sqrt(1 - s^2),
s = <x, q>.  Only pairs whose bound (the smaller of both, ``epsilon`` errors
wide) reaches the threshold are recomputed in double precision.

Pairs meet in buckets of equal label and equal ``bits`` code bits, in ``tables``
tables of independent rotations; a pair is counted in the first table it shares.
At cosine 0.93 a pair shares a bit with probability 0.88, so the defaults find
over 0.99 of the pairs at the threshold itself and nearly all closer ones; take
more bits and tables when labels hold over 10^6 distinct vectors.  Equal vectors
are one row before that.  Hot buckets are cut into bounded blocks; a block
reports counts and a spanning forest, never its pairs.

Defined results: a vector without id, label, or with null, zero, non-finite or
missing components links with nothing (own component; null id: component null);
vectors of different length do not link; rows that repeat an id are vectors of
their own: each has the links and the component of its own vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, chunk_pairs, component_roots, smallest_labels, sorted_groups


def rotation(dim: int, seed: int) -> np.ndarray:
    """Random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, +-1 codes and correction factors of unit rows."""
    rotated = unit @ rotation(unit.shape[1], seed)
    codes = np.where(rotated >= 0, 1.0, -1.0)
    return rotated, codes, np.abs(rotated).sum(axis=1) / np.sqrt(unit.shape[1])


def upper_bounds(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of <o, q> and their upper confidence bounds, rows = stored codes, columns = queries."""
    dim = codes.shape[1]
    f = np.minimum(factors, 1.0)[:, None]
    s = np.clip(codes @ queries.T / np.sqrt(dim), -1.0, 1.0)
    estimate = s / f
    error = epsilon * np.sqrt((1 - f * f) / (f * f) / max(dim - 1, 1))
    certain = np.where(s >= f, 1.0, f * s + np.sqrt((1 - f * f) * (1 - s * s)))
    return estimate, np.minimum(estimate + error, certain) + 1e-9


def bucket_keys(unit: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """One integer per row and table: sign bits under rotations of their own."""
    dim, need = unit.shape[1], tables * bits
    signs = np.hstack([unit @ rotation(dim, 1000 + k) >= 0 for k in range(-(-need // dim))])[:, :need]
    return signs.reshape(len(unit), tables, bits) @ (1 << np.arange(bits))


def _keyed(tables: int, bits: int):
    def run(batches):
        for batch in batches:
            lists, ids = batch["embedding"], batch["id"].to_numpy()
            labels, copies = batch["label"].to_numpy(), batch["copies"].to_numpy()
            offsets = lists.offsets.to_numpy()
            lengths, flat = np.diff(offsets), lists.values.to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                rows = np.flatnonzero(lengths == dim)
                vectors = flat[offsets[rows][:, None] + np.arange(dim)].astype(float)
                unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                keys = bucket_keys(unit, tables, bits)
                yield pa.RecordBatch.from_pydict({
                    "id": ids[rows], "label": labels[rows], "copies": copies[rows],
                    "dim": np.full(len(rows), dim, np.int32), "keys": list(keys.astype(np.int32)),
                    "vector": [v.tobytes() for v in vectors.astype("<f8" if flat.dtype == np.float64 else "<f4")],
                }, schema=pa.schema([("id", pa.int64()), ("label", pa.int64()), ("copies", pa.int64()), ("dim", pa.int32()),
                                     ("keys", pa.list_(pa.int32())), ("vector", pa.binary())]))

    return run


def _links(unit, ids, copies, keys, table, side, block, threshold, epsilon, rows=512):
    """Counts per row and a spanning forest of one block (i, j).

    A pair inside one chunk belongs to the first block of that chunk; pairs that
    share an earlier table are left to it.
    """
    n = len(unit)
    rotated, codes, factors = encode(unit)
    counts = np.zeros(n, np.int64)
    near = np.zeros((n, n), bool)
    for lo in range(0, n, rows):
        hi = min(n, lo + rows)
        bound = upper_bounds(codes[lo:hi], factors[lo:hi], rotated, epsilon)[1]
        maybe = bound >= threshold
        if block != (0, 0):
            own = side[lo:hi, None] == side[None, :]
            inner = (side[lo:hi, None] == block[1]) & (block[0] == 0) | (side[lo:hi, None] == 0) & (block == (0, 1))
            maybe &= ~own | inner
        a, b = np.nonzero(maybe)
        a += lo
        a, b = a[a != b], b[a != b]
        exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
        a, b = a[exact], b[exact]
        near[a, b] = near[b, a] = True
    a, b = np.nonzero(np.triu(near, 1))
    for at in range(0, len(a), 1 << 18):
        x, y = a[at:at + (1 << 18)], b[at:at + (1 << 18)]
        fresh = ~(keys[x, :table] == keys[y, :table]).any(axis=1)
        np.add.at(counts, x[fresh], copies[y[fresh]])
        np.add.at(counts, y[fresh], copies[x[fresh]])
    label = smallest_labels(n, lambda lo, hi: near[lo:hi])
    moved = np.flatnonzero(label != np.arange(n))
    return counts, ids[moved], ids[label[moved]]


def _compare(threshold: float, epsilon: float):
    def run(batches):
        for rows, bounds in sorted_groups(batches, ["bucket", "label", "dim", "t", "i", "j"]):
            ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
            dims, table, chunk = rows["dim"].to_numpy(), rows["t"].to_numpy(), rows["c"].to_numpy()
            first, second = rows["i"].to_numpy(), rows["j"].to_numpy()
            vectors, keys = rows["vector"], np.stack(rows["keys"].combine_chunks().to_numpy(zero_copy_only=False))
            ends = np.append(bounds[1:], rows.num_rows) if bounds[-1] < rows.num_rows else bounds[1:]
            out = [[], [], []]
            for start, end in zip(bounds[: len(ends)], ends):
                if end - start < 2:
                    continue
                raw = [vectors[k].as_buffer() for k in range(start, end)]
                kind = "<f8" if raw[0].size == 8 * dims[start] else "<f4"
                own = np.frombuffer(b"".join(raw), kind).reshape(-1, dims[start]).astype(float)
                own /= np.linalg.norm(own, axis=1, keepdims=True)
                block = (int(first[start]), int(second[start]))
                counts, a, b = _links(own, ids[start:end], copies[start:end], keys[start:end], table[start],
                                      chunk[start:end], block, threshold, epsilon)
                found = np.flatnonzero(counts)
                out[0] += [a, ids[start:end][found]]
                out[1] += [b, ids[start:end][found]]
                out[2] += [np.zeros(len(a), np.int64), counts[found]]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["a", "b", "n"])

    return run


def links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
          threshold: float = 0.93, epsilon: float = 4.0, tables: int = 16, bits: int = 10, chunk: int = 1024) -> DataFrame:
    """One row per vector: id, ``n_links`` (copies counted), ``component_id``, ``kept``."""
    scratch = Scratch(vectors.sparkSession, "embed")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists(
        "embedding", lambda x: x != 0)
    rows = rows.withColumn("good", F.coalesce(usable, F.lit(False))).withColumn("h", F.xxhash64("label", "embedding"))
    rows = scratch.save(rows, "rows")
    good = rows.where("good")
    classes = good.groupBy("h", "label", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    # a class is named by a number of its own: ids may repeat
    classes = classes.withColumns({"label_key": F.xxhash64(F.col("label").cast("string")), "class": F.monotonically_increasing_id()})
    classes = scratch.save(classes, "classes")
    keyed = classes.select(F.col("class").alias("id"), "embedding", F.col("label_key").alias("label"), "copies").mapInArrow(
        _keyed(tables, bits), "id long, label long, copies long, dim int, keys array<int>, vector binary")
    keyed = scratch.save(keyed, "codes")
    bucketed = keyed.select("*", F.posexplode("keys").alias("t", "k")).withColumn("bucket", F.xxhash64("label", "dim", "t", "k"))
    counts = bucketed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = bucketed.join(scratch.save(counts, "counts"), "bucket")
    blocked = chunk_pairs(shared, F.xxhash64("id", "vector"), chunk)
    ordered = blocked.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "label", "dim", "t", "i", "j")
    found = scratch.save(ordered.mapInArrow(_compare(threshold, epsilon), "a long, b long, n long"), "found")
    roots = component_roots(found.where("n = 0").select("a", "b"), scratch).withColumnRenamed("node", "class")
    members = classes.select("class", "rep").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    lows = scratch.save(members.groupBy("root").agg(F.min("rep").alias("component_id")), "lows")
    near = found.where("n > 0").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("near"))
    results = members.select("class", "root").join(lows, "root").join(scratch.save(near, "near"), "class", "left")
    results = classes.select("class", "h", "label", "embedding", "copies").join(results, "class").select(
        "h", "label", "embedding", "component_id", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    counted = good.join(scratch.save(results, "results"), ["h", "label", "embedding"]).select("id", "n_links", "component_id")
    counted = counted.unionByName(rows.where("not good").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return counted.select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
