"""Repeated cross-validation in shared passes.

A 5 x 10 resampling run fits fifty models for every point of a tuning grid,
and all of them read the same rows; they differ only in the rows left out.
So nothing is fitted one by one.  The model matrix is packed once into row
blocks (:func:`fold_blocks`: design values, label and one fold number for
each repeat, as bytes), and every step of every fit is one pass over them:

* logit and elastic net: a pass gives X'WX and X'Wz of all fits, each with its
  own weights, which are zero on the rows it leaves out.  Newton steps, or
  coordinate descent along a falling path of lambda, go on from these sums on
  the driver (:func:`fit_logits`, :func:`fit_elastic_nets`);
* component-wise boosting: a pass gives X'u of all fits; a path of 250 steps is
  250 passes for any number of resamples (:func:`fit_boosted_logits`).

The fit of all rows is one more member of the same passes, so the best point
of a grid is refitted for nothing.  Held-out ROC, sensitivity and specificity
of all fits come from one more pass: distinct scores and their counts are
merged for each (fit, fold, score range), so no group grows with the data.

What reaches the driver is a number of sums that follows from terms, grid and
resamples, never from rows.
"""

from __future__ import annotations

import math
import uuid
import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dichot.functions.hashing import hash_bits32
from dichot.functions.linalg import add_vectors, aliased_columns, x_cols
from dichot.operators import sampling
from dichot.operators.glm import INTERCEPT, Design
from dichot.session import delete_folder, ensure_checkpoint_dir

#: rows packed into one block
BLOCK_ROWS = 4096
#: rows that one task passes over, and rows worth a task of their own
TASK_ROWS, LEAST_ROWS = 64 * BLOCK_ROWS, 1024
#: rows of a block that one step of a pass works on, so that its arrays stay in the cache
STEP_ROWS = 512
#: distinct scores of one (fit, fold), or rows of one repeat's fold numbering, that one task takes
RANGE_ROWS = 1_000_000
#: scores that a task holds before it sends them to their ranges
HELD_SCORES = 4_000_000
#: scores of all tasks that are on their way to their ranges at once
LOT_SCORES = 300_000_000
MAX_STEPS = 25
#: repeat number of the fit that leaves no rows out
ALL_ROWS = -1


# ------------------------------------------------------------------ blocks

@dataclass
class FoldBlocks:
    """Rows packed into blocks: ``n, x, y, f`` (columns as :func:`_packed` gives them, uint8 folds)."""
    design: Design
    packed: DataFrame
    k: int
    repeats: int
    tasks: int
    path: str

    @property
    def blocks(self) -> DataFrame:
        """The blocks with ``x`` and ``y`` as plain float64 bytes, row by row."""
        width, repeats = self.width, self.repeats

        def plain(batches):
            for batch in batches:
                for x, y, f in _opened(batch, width, repeats):
                    yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int64()), *(
                        pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (x[:, 1:], y, f))], names=["n", "x", "y", "f"])
        return self.packed.mapInArrow(plain, BLOCK_SCHEMA)

    @property
    def width(self) -> int:
        return len(self.design.columns)

    def resamples(self) -> list[tuple[int, int]]:
        return [(r, f) for r in range(self.repeats) for f in range(self.k)]

    def unpersist(self) -> None:
        self.packed.unpersist()
        delete_folder(self.packed.sparkSession, self.path)


def _packed(columns: Sequence[np.ndarray]) -> bytes:
    """Columns of doubles one after the other, without loss: one of zeros and ones as bits."""
    flags, out = [], []
    for v in columns:
        v = np.ascontiguousarray(v, np.float64)
        bits = bool(((v == 1) | ((v == 0) & ~np.signbit(v))).all())
        flags.append(bits)
        out.append(np.packbits(v == 1).tobytes() if bits else v.tobytes())
    return bytes(flags) + b"".join(out)


def _unpacked(buffer, out: np.ndarray) -> np.ndarray:
    """The columns of :func:`_packed` into those of ``out``."""
    n, width = out.shape
    flags, at, bits = np.frombuffer(buffer, np.uint8, width), width, -(-n // 8)
    for j, flag in enumerate(flags):
        if flag:
            out[:, j] = np.unpackbits(np.frombuffer(buffer, np.uint8, bits, at), count=n)
            at += bits
        else:
            # np.frombuffer reads doubles at any place
            out[:, j] = np.frombuffer(buffer, np.float64, n, at)
            at += 8 * n
    return out


def _packed_ints(v: np.ndarray) -> bytes:
    """Whole numbers as their least one, the bytes of each, and what they have beyond it."""
    v = np.ascontiguousarray(v, np.int64)
    least = v.min(initial=np.iinfo(np.int64).max) if len(v) else np.int64(0)
    beyond = v.view(np.uint64) - np.array([least], np.int64).view(np.uint64)
    kind = np.min_scalar_type(beyond.max(initial=0))
    return np.array([least, kind.itemsize], np.int64).tobytes() + beyond.astype(kind).tobytes()


def _unpacked_ints(buffer: bytes) -> np.ndarray:
    least, size = np.frombuffer(buffer, np.int64, 2)
    beyond = np.frombuffer(buffer, f"u{size}", offset=16).astype(np.uint64)
    return (beyond + np.array([least], np.int64).view(np.uint64)).view(np.int64)


def _opened(batch: pa.RecordBatch, width: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(x with a leading 1, y, fold numbers)`` of every block of a batch."""
    for i in range(batch.num_rows):
        n = batch.column("n")[i].as_py()
        x = np.ones((n, width + 1))
        _unpacked(batch.column("x")[i].as_buffer(), x[:, 1:])
        yield (x, _unpacked(batch.column("y")[i].as_buffer(), np.empty((n, 1)))[:, 0],
               np.frombuffer(batch.column("f")[i].as_buffer(), np.uint8).reshape(n, repeats))


def fold_blocks(df: DataFrame, label_col: str, design: Design, key_cols: Sequence[str], k: int = 5,
                repeats: int = 10, seed: int = 1234) -> FoldBlocks:
    """Complete cases of the model frame with ``repeats`` stratified k-fold
    assignments (R06), packed and persisted."""
    if not 2 <= k <= 255:
        raise ValueError("folds are numbered in one byte: 2 <= k <= 255")
    width, key_cols = len(design.columns), list(key_cols)
    matrix = design.matrix(df, label_col, keep_cols=key_cols, persist=False)
    # every pass runs in this many tasks: all cores where each has LEAST_ROWS rows, TASK_ROWS rows each on large tables
    rows = matrix.count()
    tasks = max(1, math.ceil(rows / TASK_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / LEAST_ROWS)))
    if len(key_cols) == 1 and isinstance(matrix.schema[key_cols[0]].dataType, T.IntegralType):
        numbered, rough = _numbered_blocks(matrix, key_cols[0], width, k, repeats, seed, rows, tasks)
        out = _persisted(numbered, design, k, repeats, tasks)
        delete_folder(df.sparkSession, rough)
        return out
    folds = [f"fold_{r}" for r in range(1, repeats + 1)]
    frame = sampling.repeated_kfold(matrix, "y", key_cols, k, repeats, seed)
    frame = frame.repartition(tasks, *key_cols).select(*x_cols(width), "y", *folds)

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                columns = [c.to_numpy(zero_copy_only=False) for c in part.columns]
                f = np.column_stack(columns[width + 1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int64())]
                    + [pa.array([v], pa.binary()) for v in (_packed(columns[:width]), _packed(columns[width:width + 1]),
                                                           np.ascontiguousarray(f, np.uint8).tobytes())], names=["n", "x", "y", "f"])

    return _persisted(frame.mapInArrow(pack, BLOCK_SCHEMA), design, k, repeats, tasks)


BLOCK_SCHEMA = "n long, x binary, y binary, f binary"
#: removes the shuffle files of a query when it has ended
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _persisted(packed: DataFrame, design: Design, k: int, repeats: int, tasks: int) -> FoldBlocks:
    # written once, so that hundreds of passes neither carry nor repeat the lineage of the folds
    spark = packed.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/folds-{uuid.uuid4().hex}"
    # its shuffles hold the rows of all repeats: they go as soon as the blocks are written
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        packed.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    # all passes have the same fixed shape: a session that does not re-plan each of them
    passes = spark.newSession()
    passes.conf.set("spark.sql.adaptive.enabled", "false")
    passes.conf.set("spark.sql.shuffle.partitions", str(tasks))
    passes.conf.set(SHUFFLE_CLEANUP, "true")
    blocks = passes.read.schema(BLOCK_SCHEMA).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
    return FoldBlocks(design, blocks, k, repeats, tasks, path)


def _numbered_blocks(matrix: DataFrame, key: str, width: int, k: int, repeats: int, seed: int, rows: int, tasks: int) -> tuple[DataFrame, str]:
    """Blocks with the folds of :func:`sampling.repeated_kfold` for one integer key.

    A row's hashes, key and class travel in packed arrays: the rows of one
    repeat and hash range meet in one group, are numbered there, and a byte for
    each goes back to the block it came from.  As in ``repeated_kfold``, rows that
    share a key get the largest of their folds.  Also returns the folder of the rows,
    which is of no use when the blocks have been written."""
    spark = matrix.sparkSession
    ranges = max(1, math.ceil(rows / RANGE_ROWS))
    hashes = [hash_bits32(seed + r, [key]).alias(f"u_{r}") for r in range(1, repeats + 1)]
    frame = matrix.repartition(tasks, key).select(*x_cols(width), "y", F.col(key).cast("long").alias("key"), *hashes)

    def binary(values, kind):
        return pa.array([np.ascontiguousarray(v, kind).tobytes() for v in values], pa.binary())

    def pack(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                columns = [c.to_numpy(zero_copy_only=False) for c in part.columns[:width + 1]]
                keys = part.column("key")
                valid = keys.is_valid().to_numpy(zero_copy_only=False)
                u = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns[width + 2:]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 32 | number], pa.int64()), pa.array([part.num_rows], pa.int64()),
                     *(pa.array([v], pa.binary()) for v in (_packed(columns[:width]), _packed(columns[width:]),
                                                            _packed_ints(keys.fill_null(0).to_numpy(zero_copy_only=False)))),
                     binary([valid], np.uint8), binary([u], np.uint32)],
                    names=["id", "n", "x", "y", "key", "valid", "u"])
                number += 1

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    rough_schema = "id long, n long, x binary, y binary, key binary, valid binary, u binary"
    frame.mapInArrow(pack, rough_schema).write.parquet(path)
    rough = spark.read.schema(rough_schema).parquet(path)

    def ranged(batch):
        """(block number, its class values, keys, validity, hashes of all repeats, ranges of them)"""
        for i in range(batch.num_rows):
            valid = np.frombuffer(batch.column("valid")[i].as_buffer(), np.uint8)
            y = _unpacked(batch.column("y")[i].as_buffer(), np.empty((len(valid), 1)))[:, 0]
            key = _unpacked_ints(batch.column("key")[i].as_py())
            u = np.frombuffer(batch.column("u")[i].as_buffer(), np.uint32).reshape(len(y), repeats)
            yield batch.column("id")[i].as_py(), y, key, valid, u, (u.astype(np.uint64) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)

    def tally(batches):
        for batch in batches:
            for _, y, _, _, _, at in ranged(batch):
                values, cls = np.unique(y, return_inverse=True)
                place = ((np.arange(repeats) * ranges + at) * len(values) + cls[:, None]).ravel()
                count = np.bincount(place, minlength=repeats * ranges * len(values))
                full = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(full // len(values), pa.int64()), pa.array(values[full % len(values)]),
                                                  pa.array(count[full], pa.int64())], names=["part", "cls", "c"])

    slim = rough.select("id", "y", "key", "valid", "u")
    # rows of the class in earlier ranges of the repeat: (repeats x ranges x classes) numbers
    counts = slim.mapInArrow(tally, "part long, cls double, c long").groupBy("part", "cls").agg(F.sum("c").alias("c"))
    before, seen = {}, {}
    for r in sorted(counts.collect(), key=lambda r: r["part"]):
        known = (r["part"] // ranges, r["cls"])
        before[r["part"], r["cls"]] = seen.get(known, 0)
        seen[known] = seen.get(known, 0) + r["c"]
    classes = np.array(sorted({c for _, c in before}))

    def deal(batches):
        for batch in batches:
            out = {c: [] for c in ("part", "id", "pos", "cls", "key", "nulls", "u")}
            for number, y, key, valid, u, at in ranged(batch):
                for r in range(repeats):
                    order = np.argsort(at[:, r], kind="stable")
                    held, first = np.unique(at[order, r], return_index=True)
                    for to, rows_of in zip(held, np.split(order, first[1:])):
                        out["part"].append(r * ranges + int(to))
                        out["id"].append(number)
                        nulls = np.flatnonzero(valid[rows_of] == 0)
                        for c, v in (("pos", rows_of.astype(np.uint16).tobytes()),
                                     ("cls", np.searchsorted(classes, y[rows_of]).astype(np.min_scalar_type(len(classes))).tobytes()),
                                     ("key", _packed_ints(key[rows_of])), ("nulls", nulls.astype(np.uint16).tobytes()),
                                     ("u", u[rows_of, r].astype(np.uint32).tobytes())):
                            out[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if c in ("part", "id") else pa.binary()) for c, v in out.items()], names=list(out))

    def number(group: pa.Table) -> pa.Table:
        def column(c, t):
            return [np.frombuffer(v, t) for v in group.column(c).to_pylist()]
        part = group.column("part")[0].as_py()
        pieces = column("cls", np.min_scalar_type(len(classes)))
        y, u = np.concatenate(pieces), np.concatenate(column("u", np.uint32))
        key = np.concatenate([_unpacked_ints(v) for v in group.column("key").to_pylist()])
        valid = np.ones(len(y), np.uint8)
        for start, nulls in zip(np.cumsum([0, *map(len, pieces)]), column("nulls", np.uint16)):
            valid[start + nulls.astype(int)] = 0
        # by (hash, null keys first, key): ranks inside each class follow from it
        order = np.lexsort((key, valid, u))
        fold = np.zeros(len(y), np.uint8)
        for cls in np.unique(y):
            mine = order[y[order] == cls]
            fold[mine] = (before[part, float(classes[cls])] + np.arange(len(mine))) % k
        u, valid, key = u[order], valid[order], key[order]
        first = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (valid[1:] != valid[:-1]) | (key[1:] != key[:-1])))
        if len(first) < len(order):
            fold[order] = np.repeat(np.maximum.reduceat(fold[order], first), np.diff(np.append(first, len(order))))
        cut = np.cumsum([len(p) for p in pieces])[:-1]
        return pa.table({"id": group.column("id"), "r": pa.array([part // ranges] * len(pieces), pa.int32()), "pos": group.column("pos"),
                         "fold": pa.array([v.tobytes() for v in np.split(fold, cut)], pa.binary())})

    dealt = slim.mapInArrow(deal, "part long, id long, pos binary, cls binary, key binary, nulls binary, u binary")
    numbered = dealt.groupBy("part").applyInArrow(number, "id long, r int, pos binary, fold binary")

    def assemble(block: pa.Table, folds: pa.Table) -> pa.Table:
        f = np.zeros((block.column("n")[0].as_py(), repeats), np.uint8)
        for r, pos, fold in zip(*(folds.column(c).to_pylist() for c in ("r", "pos", "fold"))):
            f[np.frombuffer(pos, np.uint16), r] = np.frombuffer(fold, np.uint8)
        return pa.table({**{c: block.column(c) for c in ("n", "x", "y")}, "f": pa.array([f.tobytes()], pa.binary())})

    whole = rough.select("id", "n", "x", "y").groupBy("id").cogroup(numbered.groupBy("id")).applyInArrow(assemble, BLOCK_SCHEMA)
    return whole.repartition(tasks), path


def sum_blocks(data: FoldBlocks, work: Callable, length: int) -> np.ndarray:
    """The sum of ``work(x, y, f)`` over all blocks: one Spark job."""
    width, repeats = data.width, data.repeats

    def run(batches):
        total = None
        for batch in batches:
            for x, y, f in _opened(batch, width, repeats):
                for at in range(0, len(y), STEP_ROWS):
                    part = work(x[at:at + STEP_ROWS], y[at:at + STEP_ROWS], f[at:at + STEP_ROWS])
                    total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])
    return add_vectors(data.packed.mapInArrow(run, "v array<double>"), length, data.tasks)


@dataclass
class Moments:
    """Sums over the training rows of every member (the resamples, then all rows)."""
    n: np.ndarray            # (m,)
    y: np.ndarray            # (m,)
    x: np.ndarray            # (m, p)
    xx: np.ndarray           # (m, p): squares
    xy: np.ndarray           # (m, p)
    gram: np.ndarray         # (p + 1, p + 1) of all rows

    def sd(self) -> np.ndarray:
        mean = self.x / self.n[:, None]
        return np.sqrt(np.maximum(self.xx / self.n[:, None] - mean * mean, 0))


def moments(data: FoldBlocks) -> Moments:
    """One pass: sums by (repeat, fold); training sums are the total less the fold's."""
    p, k, members = data.width, data.k, len(data.resamples())
    per, repeats = 2 + 3 * p, data.repeats

    def work(x, y, f):
        v = np.hstack([np.ones((len(y), 1)), y[:, None], x[:, 1:], x[:, 1:] ** 2, x[:, 1:] * y[:, None]])
        sums = [v[f[:, r] == i].sum(0) for r in range(repeats) for i in range(k)]
        return np.concatenate([*sums, (x.T @ x).ravel()])

    got = sum_blocks(data, work, members * per + (p + 1) ** 2)
    by_fold = got[:members * per].reshape(members, per)
    whole = by_fold[:k].sum(0)
    train = np.vstack([whole - by_fold, whole])
    return Moments(train[:, 0], train[:, 1], train[:, 2:2 + p], train[:, 2 + p:2 + 2 * p], train[:, 2 + 2 * p:],
                   got[members * per:].reshape(p + 1, p + 1))


def _members(data: FoldBlocks) -> tuple[np.ndarray, np.ndarray]:
    """Repeat and fold left out of every member; the last leaves nothing out."""
    rep, fold = zip(*data.resamples(), (ALL_ROWS, 0))
    return np.array(rep), np.array(fold)


def _trains(f: np.ndarray, rep: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """(rows, members): whether a row is in the training part of a member."""
    # no fold has the number 255
    return np.take(f, np.maximum(rep, 0), axis=1) != np.where(rep < 0, 255, fold).astype(np.uint8)


# ------------------------------------------------------------------ logit and elastic net

def _working_sums(data: FoldBlocks, beta: np.ndarray, rep: np.ndarray, fold: np.ndarray):
    """X'WX, X'Wz and deviance of every fit at its coefficients: one pass."""
    m, q = beta.shape
    upper = np.triu_indices(q)
    t = len(upper[0])

    def work(x, y, f):
        eta = x @ beta.T
        keep = _trains(f, rep, fold)
        e = np.exp(-np.abs(eta))
        mu = 1 / (1 + e)
        mu = np.clip(np.where(eta < 0, 1 - mu, mu), 1e-15, 1 - 1e-15)
        w = mu * (1 - mu)
        w *= keep
        z = y[:, None] - mu
        z *= keep
        z += w * eta
        e += 1
        dev = np.log(e, out=e)
        dev += np.maximum(eta, 0) - y[:, None] * eta
        dev *= keep
        return np.concatenate([(w.T @ (x[:, upper[0]] * x[:, upper[1]])).ravel(), (z.T @ x).ravel(), 2 * dev.sum(0)])

    got = sum_blocks(data, work, m * (t + q + 1))
    gram = np.zeros((m, q, q))
    gram[:, upper[0], upper[1]] = gram[:, upper[1], upper[0]] = got[:m * t].reshape(m, t)
    return gram, got[m * t:m * (t + q)].reshape(m, q), got[m * (t + q):]


def _newton(gram: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solutions, with zero for columns that depend on earlier ones."""
    out = np.zeros_like(rhs)
    for i, (g, b) in enumerate(zip(gram, rhs)):
        gone = set(aliased_columns(g))
        at = [j for j in range(len(b)) if j not in gone]
        out[i, at] = np.linalg.solve(g[np.ix_(at, at)], b[at])
    return out


def fit_logits(data: FoldBlocks, tol: float = 1e-8) -> np.ndarray:
    """Coefficients (members, p + 1) of the maximum likelihood logit of
    every resample and of all rows; one pass a Newton step.  The fit of all rows
    comes first, and every resample starts from it."""
    rep, fold = _members(data)
    beta = np.zeros((len(rep), data.width + 1))
    last = np.full(len(rep), np.inf)
    for live in (np.array([len(rep) - 1]), np.arange(len(rep) - 1)):
        beta[live] = beta[-1]
        for _ in range(MAX_STEPS + 1):
            gram, rhs, dev = _working_sums(data, beta[live], rep[live], fold[live])
            more = np.abs(dev - last[live]) > tol * (np.abs(dev) + 0.1)
            last[live] = dev
            live, gram, rhs = live[more], gram[more], rhs[more]
            if not len(live):
                break
            beta[live] = _newton(gram, rhs)
        else:
            warnings.warn(f"{len(live)} of {len(rep)} logits did not converge in {MAX_STEPS} steps (separated classes?)", stacklevel=2)
    return beta


def _descend(gram: np.ndarray, rhs: np.ndarray, start: np.ndarray, l1: np.ndarray, l2: np.ndarray, tol: float) -> np.ndarray:
    """Coordinate descent on centred sums of all fits at once: the minimum of
    b'Ab/2 - c'b + sum l1 |b| + sum l2 b^2 / 2, the intercept left free."""
    a00, a0 = gram[:, 0, 0], gram[:, 0, 1:]
    a = gram[:, 1:, 1:] - a0[:, :, None] * a0[:, None, :] / a00[:, None, None]
    c = rhs[:, 1:] - a0 * (rhs[:, 0] / a00)[:, None]
    b = start[:, 1:].copy()
    diag = np.einsum("mjj->mj", a)
    scale = np.sqrt(np.maximum(diag, 0))
    while True:
        change = 0.0
        for j in range(b.shape[1]):
            free = c[:, j] - np.einsum("mk,mk->m", a[:, j], b) + diag[:, j] * b[:, j]
            under = diag[:, j] + l2[:, j]
            new = np.where(under > 1e-12, np.sign(free) * np.maximum(np.abs(free) - l1[:, j], 0) / np.maximum(under, 1e-12), 0)
            change = max(change, float(np.max(scale[:, j] * np.abs(new - b[:, j]), initial=0)))
            b[:, j] = new
        if change < tol:
            break
    return np.column_stack([(rhs[:, 0] - np.einsum("mk,mk->m", a0, b)) / a00, b])


def elastic_grid(data: FoldBlocks, mom: Moments, length: int = 5) -> list[tuple[float, float]]:
    """(alpha, lambda) as ``tuneLength`` gives them: alphas evenly from 0.1
    to 1 and the inner points of a path of ``length + 2`` lambdas for alpha =
    0.5, from the least that empties the model of all rows down by 10,000."""
    n, sd = mom.n[-1], mom.sd()[-1]
    score = np.abs(mom.xy[-1] - mom.x[-1] * mom.y[-1] / n) / n
    top = float(np.max(np.divide(score, sd, out=np.zeros_like(sd), where=sd > 0), initial=0)) / 0.5
    least = 1e-4 if n > data.width else 1e-2
    path = np.exp(np.linspace(math.log(max(top, 1e-12)), math.log(max(top, 1e-12) * least), length + 2))[1:-1]
    return [(float(a), float(v)) for a in np.linspace(0.1, 1, length) for v in path]


def fit_elastic_nets(data: FoldBlocks, grid: Sequence[tuple[float, float]], mom: Moments | None = None,
                     tol: float = 1e-7, sample_sd: bool = False) -> np.ndarray:
    """Coefficients (grid, members, p + 1) of the elastic net logit, columns
    standardised inside every training part (so M09's centring and scaling is
    part of it).  Along the falling lambdas of the grid the fits of all rows
    start from their last ones, and every resample starts from the fit of all
    rows, which it is close to; all alphas and resamples share the passes."""
    mom = mom or moments(data)
    rep, fold = _members(data)
    m, q = len(rep), data.width + 1
    alphas = sorted({a for a, _ in grid})
    lambdas = sorted({v for _, v in grid}, reverse=True)
    # members of one pass: every alpha with every resample
    mean = np.clip(mom.y / mom.n, 1e-12, 1 - 1e-12)
    beta = np.zeros((len(alphas), m, q))
    beta[:, :, 0] = np.log(mean / (1 - mean))
    sd = mom.sd() * (np.sqrt(mom.n / (mom.n - 1))[:, None] if sample_sd else 1)
    found = {}
    for v in lambdas:
        for own in ([m - 1], range(m - 1)):
            live = [(i, j) for i in range(len(alphas)) for j in own]
            beta[:, own] = beta[:, -1:]
            for _ in range(4 * MAX_STEPS):
                ai, mj = map(np.array, zip(*live))
                now = beta[ai, mj]
                gram, rhs, _ = _working_sums(data, now, rep[mj], fold[mj])
                n = mom.n[mj]
                alpha = np.array(alphas)[ai][:, None]
                new = _descend(gram / n[:, None, None], rhs / n[:, None], now, v * alpha * sd[mj], v * (1 - alpha) * sd[mj] ** 2, tol / 10)
                beta[ai, mj] = new
                step = np.max(np.abs(new - now)[:, 1:] * sd[mj], axis=1, initial=0) + np.abs(new - now)[:, 0] * 1e-2
                live = [x for x, s in zip(live, step) if s > tol]
                if not live:
                    break
            else:
                warnings.warn(f"{len(live)} elastic nets did not converge at lambda {v}", stacklevel=2)
        found[v] = beta.copy()
    return np.array([found[v][alphas.index(a)] for a, v in grid])


# ------------------------------------------------------------------ boosted logit

def fit_boosted_logits(data: FoldBlocks, mstops: Sequence[int], nu: float = 0.1, mom: Moments | None = None) -> np.ndarray:
    """Coefficients (mstops, members, p + 1), on the logit scale, of
    component-wise boosting with centred linear base learners; one pass a step.

    As in :class:`dichot.operators.models.GLMBoost`: the half-log-odds loss,
    the intercept a candidate like any column, each step the candidate with
    the largest drop of the residual sum of squares times ``nu``."""
    mom = mom or moments(data)
    rep, fold = _members(data)
    m, p = len(rep), data.width
    mean = mom.x / mom.n[:, None]
    squares = np.column_stack([mom.n, mom.n[:, None] * mom.sd() ** 2])
    # a column without variance is no candidate; its rounding must not divide
    usable = squares > 1e-10 * np.column_stack([mom.n, np.maximum(mom.xx, 1e-300)])
    share = mom.y / mom.n
    offset = 0.5 * np.log(share / (1 - share))
    beta = np.zeros((m, p + 1))                       # of centred columns

    def plain() -> np.ndarray:
        """Coefficients of f on the columns as they are."""
        return np.column_stack([offset + beta[:, 0] - np.einsum("mj,mj->m", mean, beta[:, 1:]), beta[:, 1:]])

    out = {}
    for step in range(1, max(mstops) + 1):
        coef = plain()

        def work(x, y, f, coef=coef):
            # 2 (y - p) on the training rows, in place
            u = x @ coef.T
            u *= -2
            with np.errstate(over="ignore"):
                np.exp(u, out=u)
            u += 1
            np.divide(-2, u, out=u)
            u += 2 * y[:, None]
            u *= _trains(f, rep, fold)
            return (u.T @ x).ravel()

        xu = sum_blocks(data, work, m * (p + 1)).reshape(m, p + 1)
        xu[:, 1:] -= mean * xu[:, :1]
        gain = np.where(usable, xu * xu / np.where(usable, squares, 1), -np.inf)
        best = np.argmax(gain, axis=1)
        at = np.arange(m)
        beta[at, best] += nu * xu[at, best] / squares[at, best]
        if step in mstops:
            out[step] = 2 * plain()
    return np.array([out[s] for s in mstops])


# ------------------------------------------------------------------ held-out figures

def _ranges(rows: float, k: int) -> int:
    return max(1, math.ceil(rows / k / RANGE_ROWS))


def _merge_range(group: pa.Table) -> pa.Table:
    """AUC parts of one (fit, fold, range): distinct scores are merged."""
    pieces = [np.frombuffer(b) for b in group.column("s").to_pylist()]
    score = np.concatenate(pieces)
    times = np.concatenate([np.frombuffer(b, np.int32) for b in group.column("c").to_pylist()])
    one = np.repeat(group.column("one").combine_chunks().to_numpy(zero_copy_only=False), [len(p) for p in pieces])
    order = np.argsort(score, kind="stable")
    score, times, one = score[order], times[order].astype(np.float64), one[order]
    first = np.flatnonzero(np.append(True, score[1:] != score[:-1]))
    pos, neg = np.add.reduceat(times * one, first), np.add.reduceat(times * ~one, first)
    below = np.cumsum(neg) - neg
    up = score[first] > 0
    c, f, bucket = (group.column(x)[0].as_py() for x in ("fit", "fold", "range"))
    return pa.table({"fit": pa.array([c], pa.int32()), "fold": pa.array([f], pa.int32()), "range": pa.array([bucket], pa.int32()),
                     "pos": [float(pos.sum())], "neg": [float(neg.sum())], "u": [float((pos * (below + neg / 2)).sum())],
                     "tp": [float(pos[up].sum())], "tn": [float(neg[~up].sum())]})


def held_out_scores(blocks: DataFrame, opened: Callable, grid: int, repeats: int, k: int, rows: float,
                    centre: np.ndarray | None = None, spread: np.ndarray | None = None) -> list[dict]:
    """ROC (exact, ties one half), Sens and Spec (score above zero) of every
    grid point and resample on the rows it left out.

    ``opened(batch)`` yields ``(y, f, score)`` for each block, ``score(member,
    at, points)`` being the (rows, points) scores of the rows ``at``.  A score's range is
    a monotone function of it (its distance from ``centre`` by ``spread``, both
    (grid, members)), and there are as many ranges as keep one task's share
    of a fold bounded.

    Large tables are done in lots of repeats, or of grid points of one repeat, of
    about ``LOT_SCORES`` scores each: the files of one lot go before the next begins."""
    ranges = _ranges(rows, k)
    share = max(1, int(LOT_SCORES / max(rows, 1)))          # scores of a row in one lot
    if share >= grid:
        step = share // grid
        lots = [(range(r, min(repeats, r + step)), range(grid)) for r in range(0, repeats, step)]
    else:
        lots = [(range(r, r + 1), range(g, min(grid, g + share))) for r in range(repeats) for g in range(0, grid, share)]
    got = [row for some_repeats, points in lots for row in _lot(blocks, opened, some_repeats, points, repeats, k, ranges, centre, spread)]

    def part(a, b):
        return a / b if b else float("nan")
    return sorted(({"grid_index": r["fit"] // repeats, "repeat": r["fit"] % repeats + 1, "fold": r["fold"],
                    "ROC": part(r["u"], r["pos"] * r["neg"]), "Sens": part(r["tp"], r["pos"]), "Spec": part(r["tn"], r["neg"])}
                   for r in got), key=lambda r: (r["grid_index"], r["repeat"], r["fold"]))


def _lot(blocks: DataFrame, opened: Callable, some_repeats: range, points: range, repeats: int, k: int, ranges: int,
         centre: np.ndarray | None, spread: np.ndarray | None) -> list:
    """Sums for the AUC of some grid points over some repeats, by (fit, fold)."""
    def sent(held):
        """The distinct scores that were held, with their counts, by (fit, fold, class, range)."""
        out = {name: [] for name in ("fit", "fold", "range", "one", "s", "c")}
        for (r, i, one), pieces in held.items():
            scores = np.concatenate(pieces)
            for i_g, g in enumerate(points):
                s = np.sort(scores[:, i_g])
                first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
                s, c = s[first], np.diff(np.append(first, len(s))).astype(np.int32)
                held_by, cut = [0], [0, len(s)]
                if ranges > 1:
                    # ascending with the score, so that each range is a slice
                    member = r * k + i
                    z = np.clip((s - centre[g, member]) / spread[g, member], -30, 30)
                    to = np.minimum((ranges / (1 + np.exp(-1.7 * z))).astype(np.int32), ranges - 1)
                    held_by, cut = np.unique(to, return_index=True)
                    cut = [*cut.tolist(), len(s)]
                for b, lo, hi in zip(held_by, cut, cut[1:]):
                    for name, v in (("fit", g * repeats + r), ("fold", i), ("range", int(b)), ("one", one),
                                    ("s", s[lo:hi].tobytes()), ("c", c[lo:hi].tobytes())):
                        out[name].append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in (
            ("fit", pa.int32()), ("fold", pa.int32()), ("range", pa.int32()), ("one", pa.bool_()), ("s", pa.binary()), ("c", pa.binary()))],
            names=list(out))

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for y, f, score in opened(batch):
                for r in some_repeats:
                    for i in range(k):
                        for one in (True, False):
                            at = np.flatnonzero((f[:, r] == i) & ((y > 0.5) == one))
                            if len(at):
                                held.setdefault((r, i, one), []).append(score(r * k + i, at, points))
                size += len(y) * len(some_repeats) * len(points)
                if size >= HELD_SCORES:
                    yield sent(held)
                    held, size = {}, 0
        if held:
            yield sent(held)

    scores = blocks.mapInArrow(run, "fit int, fold int, range int, one boolean, s binary, c binary")
    merged = scores.groupBy("fit", "fold", "range").applyInArrow(
        _merge_range, "fit int, fold int, range int, pos double, neg double, u double, tp double, tn double")
    before = Window.partitionBy("fit", "fold").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return merged.withColumn("under", F.coalesce(F.sum("neg").over(before), F.lit(0.0))).groupBy("fit", "fold").agg(
        F.sum(F.col("u") + F.col("pos") * F.col("under")).alias("u"), *(F.sum(c).alias(c) for c in ("pos", "neg", "tp", "tn"))).collect()


def held_out(data: FoldBlocks, beta: np.ndarray, mom: Moments) -> list[dict]:
    """:func:`held_out_scores` of linear scores; ``beta`` is (grid, members, p + 1)."""
    mean = mom.gram[0] / mom.gram[0, 0]
    cov = mom.gram / mom.gram[0, 0] - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.einsum("gmi,ij,gmj->gm", beta, cov, beta), 1e-300))
    width, repeats = data.width, data.repeats

    def opened(batch):
        for x, y, f in _opened(batch, width, repeats):
            yield y, f, lambda member, at, points, x=x: x[at] @ beta[points.start:points.stop, member].T

    return held_out_scores(data.packed, opened, len(beta), repeats, data.k, mom.n[-1], beta @ mean, spread)


# ------------------------------------------------------------------ train()

@dataclass
class Tuned:
    """What ``train()`` returns: figures of every resample, the best point and
    the model refitted with it on all rows."""
    method: str
    design: Design
    grid: list[dict]
    results: list[dict]
    coefs: np.ndarray = field(repr=False)            # (grid, p + 1) of the fits of all rows

    def means(self, metric: str = "ROC") -> np.ndarray:
        return np.array([np.mean([r[metric] for r in self.results if r["grid_index"] == g]) for g in range(len(self.grid))])

    @property
    def best_index(self) -> int:
        """The first point (the simplest by the grid's order) of the largest mean ROC."""
        return int(np.argmax(np.round(self.means(), 12)))

    @property
    def best(self) -> dict:
        return self.grid[self.best_index]

    @property
    def coef(self) -> dict[str, float]:
        """Logit-scale coefficients of the refitted best point."""
        return dict(zip([INTERCEPT, *self.design.columns], self.coefs[self.best_index].tolist()))

    def table(self, spark, metrics: Sequence[str] = ("ROC", "Sens", "Spec")) -> DataFrame:
        """Mean and sd of every metric at every point of the grid."""
        rows = []
        for g, point in enumerate(self.grid):
            params = ", ".join(f"{n}={v:.6g}" for n, v in sorted(point.items()))
            for metric in metrics:
                v = np.array([r[metric] for r in self.results if r["grid_index"] == g])
                rows.append((g, params, metric, float(v.mean()), float(v.std(ddof=1)) if len(v) > 1 else None, len(v), g == self.best_index))
        return spark.createDataFrame(rows, "grid_index long, params string, metric string, mean double, sd double, "
                                           "resamples long, best boolean")


def train(data: FoldBlocks, method: str, length: int = 5, grid: Sequence[dict] | None = None,
          sample_sd: bool = False) -> Tuned:
    """Tune ``glm``, ``glmnet`` or ``glmboost`` over the
    resamples of ``data`` and refit the best point on all rows.

    Without a ``grid``, ``length`` is ``tuneLength``: that many alphas and
    lambdas, or boosting lengths 50, 100, ...  ``sample_sd``: the elastic net's
    columns are scaled by the sample sd (M09's preprocessing), not the
    population sd of its own standardisation."""
    mom = moments(data)
    if method == "glm":
        points, beta = [{}], fit_logits(data)[None]
    elif method == "glmnet":
        points = list(grid) if grid else [{"alpha": a, "lambda": v} for a, v in elastic_grid(data, mom, length)]
        beta = fit_elastic_nets(data, [(p["alpha"], p["lambda"]) for p in points], mom, sample_sd=sample_sd)
    elif method == "glmboost":
        points = list(grid) if grid else [{"mstop": 50 * i} for i in range(1, length + 1)]
        beta = fit_boosted_logits(data, [p["mstop"] for p in points], mom=mom)
    else:
        raise ValueError(f"unknown method {method}")
    return Tuned(method, data.design, points, held_out(data, beta, mom), beta[:, -1])
