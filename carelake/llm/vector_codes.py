"""Codes of vectors: product quantisation whose assignments are bounded as by Drake and Hamerly.

A vector becomes integers floor(``scale`` * x) and is cut into ``parts`` equal
consecutive parts.  Every part position has a codebook of ``entries`` entries, at
first those parts of the vectors with the smallest ids; a round assigns every part
to its nearest entry (squared Euclidean distance, ties to the lower index) and
replaces each entry by the componentwise floor of the mean of its parts (an entry
without parts stays).  After the last round parts are assigned once more.

The first assignment measures all entries.  It stores, with every part, its ``b``
closest entries in order, one lower bound for each (of the distance to it and to
all that follow) and one outer bound for the entries that are not stored.  Later,
bounds sink by how far their entries moved (the outer one by the largest move).
The distance to the current entry is taken anew: bounds above it rule out all that
follows; only entries before the first such bound are compared in integers, and
all of them if the outer bound does not hold.  ``b`` shrinks to what 99 % of the parts needed, an eighth of the
entries at least.  Bounds are stored in 16 bits, rounded down; every decision that
is not certain by a margin is made in integers, so codes equal those of full search.

A codebook passes the driver: parts * entries rows, whatever the input.  Sums are
combined in tasks and by a grouping of that many keys.

Defined results: vectors that are null or hold null or non-finite components have
no row; so have those whose length is not the most frequent multiple of ``parts``
(smallest of equals).  Components beyond 2^14 in size count as 2^14, so that
distances and their order fit a long.  Rows without id come after all others where ids are
compared; rows that repeat an id are vectors of their own, ordered by components.
Fewer rows than ``entries`` make a smaller codebook; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch

LIMIT = 1 << 22
PIECE = 4096
STATE = "id {id}, label {label}, ints array<int>, nearest binary, bounds binary, outer binary, needs binary"


@dataclass
class Codes:
    """``rows``: id, label, code, error of every kept vector; ``codebooks``: integers by part, entry, position."""

    rows: DataFrame
    codebooks: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def distances(own: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared integer distances, rows = parts, columns = entries."""
    return (own * own).sum(axis=1)[:, None] - 2 * (own @ book.T) + (book * book).sum(axis=1)


def rounded_down(bounds: np.ndarray) -> np.ndarray:
    """Lower bounds in 16 bits, none above the given one."""
    clipped = np.clip(bounds, 0, 65504.0)
    half = clipped.astype(np.float16)
    return np.where(half.astype(float) > clipped, np.nextafter(half, np.float16(0)), half).astype(np.float16)


def full_search(own: np.ndarray, book: np.ndarray, b: int):
    """Order of the ``b`` closest entries, their bounds, the outer bound, and the least squared distance."""
    square = distances(own, book)
    order = np.argsort(square, axis=1, kind="stable")
    root = np.sqrt(np.take_along_axis(square, order, axis=1).astype(float))
    outer = root[:, b] if b < len(book) else np.full(len(own), np.inf)
    return order[:, :b], root[:, :b], outer, np.take_along_axis(square, order[:, :1], axis=1)[:, 0]


def bounded_search(own: np.ndarray, book: np.ndarray, moved: np.ndarray, order: np.ndarray, bounds: np.ndarray, outer: np.ndarray):
    """As ``full_search`` from the state of the last assignment; adds how many stored entries had to be known."""
    n, b = order.shape
    order, bounds = order.copy(), bounds - moved[order]
    outer = outer - moved.max()
    bounds[:, -1] = np.minimum(bounds[:, -1], outer)
    bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
    best = ((own - book[order[:, 0]]) ** 2).sum(axis=1)
    reach = np.sqrt(best.astype(float)) * (1 + 1e-9) + 1e-6
    beyond = np.concatenate([bounds[:, 1:], outer[:, None]], axis=1) > reach[:, None]
    needs = np.where(beyond.any(axis=1), beyond.argmax(axis=1) + 1, b + 1)
    bounds[:, 0] = np.minimum(np.sqrt(best.astype(float)), bounds[:, 1] if b > 1 else outer)

    some = np.flatnonzero((needs > 1) & (needs <= b))
    if len(some):
        exact = ((own[some, None, :] - book[order[some]]) ** 2).sum(axis=2)
        known = np.arange(b) < needs[some, None]
        # by distance, then index; entries that need no comparison keep their places behind
        rank = np.where(known, exact * len(book) + order[some], np.iinfo(np.int64).max)
        turn = np.argsort(rank, axis=1, kind="stable")
        root = np.where(known, np.sqrt(exact.astype(float)), bounds[some])
        root = np.take_along_axis(root, turn, axis=1)
        order[some] = np.take_along_axis(order[some], turn, axis=1)
        bounds[some] = np.minimum(np.minimum.accumulate(root[:, ::-1], axis=1)[:, ::-1], outer[some, None])
        best[some] = np.take_along_axis(exact, turn[:, :1], axis=1)[:, 0]
    every = np.flatnonzero(needs > b)
    if len(every):
        order[every], bounds[every], outer[every], best[every] = full_search(own[every], book, b)
    return order, bounds, outer, best, needs


def _shrunk(order, bounds, outer, b: int):
    """State with ``b`` stored entries; the outer bound takes over the rest."""
    if order.shape[1] > b:
        outer = np.minimum(outer, bounds[:, b])
    return order[:, :b], bounds[:, :b], outer


def _ints(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    values = batch["ints"]
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(values), parts, -1)


def _pieces(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def _matrix(column: pa.Array, dtype, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), parts, -1)


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def _search(batch, book, moved, b):
    """Searches of all parts of a batch: with ``moved`` from the stored state, else in full."""
    parts, own = len(book), _ints(batch, len(book))
    old = None
    if moved is not None:
        old = [_matrix(batch[c], t, parts) for c, t in (("nearest", np.uint8), ("bounds", np.float16), ("outer", np.float16))]
    out = []
    for p in range(parts):
        if old is None:
            order, bounds, outer, best = full_search(own[:, p], book[p], b)
            needs = np.ones(len(own), np.int64)
        else:
            order, bounds, outer = _shrunk(old[0][:, p].astype(np.int64), old[1][:, p].astype(float), old[2][:, p, 0].astype(float), b)
            order, bounds, outer, best, needs = bounded_search(own[:, p], book[p], moved[p], order, bounds, outer)
        out.append((order, bounds, outer, best, needs))
    return [np.stack(x, axis=1) for x in zip(*out)]


def _assign(book: np.ndarray, moved: np.ndarray | None, b: int):
    def run(batches):
        for batch in _pieces(batches):
            order, bounds, outer, _, needs = _search(batch, book, moved, b)
            yield pa.RecordBatch.from_arrays([
                batch["id"], batch["label"], batch["ints"], _binary(order.astype(np.uint8)), _binary(rounded_down(bounds)),
                _binary(rounded_down(outer)), _binary(np.minimum(needs, 255).astype(np.uint8)),
            ], names=["id", "label", "ints", "nearest", "bounds", "outer", "needs"])

    return run


def _final(book: np.ndarray, moved: np.ndarray, b: int):
    def run(batches):
        for batch in _pieces(batches):
            order, _, _, best, _ = _search(batch, book, moved, b)
            codes = [row.tobytes().hex() for row in order[:, :, 0].astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], pa.array(codes), pa.array(best.sum(axis=1))], names=["id", "label", "code", "error"])

    return run


def _sums(parts: int, entries: int):
    """Per task: count and component sums of each (part, entry), and part -1: how many parts needed how many entries."""

    def run(batches):
        total, count, needed = None, np.zeros((parts, entries), np.int64), np.zeros(256, np.int64)
        for batch in _pieces(batches):
            own = _ints(batch, parts)
            first = _matrix(batch["nearest"], np.uint8, parts)[:, :, 0]
            if total is None:
                total = np.zeros((parts, entries, own.shape[2]), np.int64)
            for p in range(parts):
                np.add.at(total[p], first[:, p], own[:, p])
                count[p] += np.bincount(first[:, p], minlength=entries)
            needed += np.bincount(_matrix(batch["needs"], np.uint8, parts).ravel(), minlength=256)
        if total is None:
            return
        part, entry = np.nonzero(count)
        need = np.flatnonzero(needed)
        part, entry = np.concatenate([part, np.full(len(need), -1)]), np.concatenate([entry, need])
        sums = [total[p, e].tolist() if p >= 0 else [0] * total.shape[2] for p, e in zip(part, entry)]
        n = [int(count[p, e] if p >= 0 else needed[e]) for p, e in zip(part, entry)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"])

    return run


def _updated(state: DataFrame, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New codebooks, and the histogram of stored entries that were needed."""
    parts, entries, width = book.shape
    local = state.select("ints", "nearest", "needs").mapInArrow(_sums(parts, entries), "part int, entry int, n long, sums array<long>")
    wide = local.select("part", "entry", "n", *[F.col("sums")[k].alias(f"s{k}") for k in range(width)])
    total = wide.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(width)])
    new, needed = book.copy(), np.zeros(256, np.int64)
    for row in total.collect():  # parts * entries + 256 rows at most
        if row["part"] < 0:
            needed[row["entry"]] = row["n"]
        else:
            new[row["part"], row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(width)]
    return new, needed


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16,
           entries: int = 64, rounds: int = 2, scale: int = 256, stored: int = 16) -> Codes:
    """Codes of all usable vectors, and the codebooks after ``rounds`` rounds."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    scratch = Scratch(vectors.sparkSession, "codes")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(finite & (F.size("v") > 0) & (F.size("v") % parts == 0))
    whole = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    rows = scratch.save(rows.select("id", "label", whole.alias("ints")), "rows")
    types = dict(rows.dtypes)
    size = F.size("ints")
    length = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), "size").first()
    if length is None:
        empty = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(empty, np.zeros((parts, 0, 0), np.int64))
    rows = rows.where(size == length["size"])
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).collect()
    book = np.array([r["ints"] for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    b = min(stored, len(seeds))
    state, moved = rows, None
    schema = STATE.format(**types)
    for k in range(rounds):
        state = scratch.save(state.mapInArrow(_assign(book, moved, b), schema), f"state-{k}")
        new, needed = _updated(state, book)
        moved = np.sqrt(((new - book) ** 2).sum(axis=2).astype(float)) + 1e-6
        if k:
            enough = int(np.searchsorted(np.cumsum(needed), 0.99 * needed.sum()))
            b = min(b, max(enough, len(seeds) // 8, 1))
        book = new
    if moved is None:
        state, moved = scratch.save(rows.mapInArrow(_assign(book, None, b), schema), "state"), np.zeros(book.shape[:2])
    coded = state.mapInArrow(_final(book, moved, b), f"id {types['id']}, label {types['label']}, code string, error long")
    return Codes(scratch.save(coded, "codes"), book)


def digests(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", **options) -> DataFrame:
    """id, ``code``, ``error``, ``label_error`` (of all vectors of the label, nulls together), ``codebooks_sha256``."""
    found = encode(vectors, id_col=id_col, label_col=label_col, **options)
    scratch = Scratch(vectors.sparkSession, "code-errors")
    sums = scratch.save(found.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    joined = found.rows.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(found.sha256()).alias("codebooks_sha256"))
