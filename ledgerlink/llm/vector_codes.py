"""Vector compression by product codebooks, refined in exact integers with norm-of-sum bounds.

A vector becomes whole numbers and is cut into parts; each part is named by the
nearest of at most 256 entries of its position's codebook, and every round moves
each entry to the floored mean of its parts.

Between rounds a part keeps, for every group of entries, a lower bound of its
distance to them and the round that the bound was measured in. All codebooks so
far are kept, so the bound is later lessened by how far the group's entries are
from where they were in that round: the norm of the summed moves, never more
than the sum of their norms. Only groups whose bound then does not exceed the
distance to the part's own entry are scanned again, exactly. Bounds only spare
work: squared distances that decide are whole numbers, and ties go to the lower
index.

State is one row per vector, written once a round in the shared folder; the round
before it is then removed. The driver holds the codebooks alone (rounds x
entries x components, whatever the number of vectors), and tasks hand over sums
by part and entry, which are combined before they are shuffled.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import saved, work_folder

#: Entries of a codebook that share a bound.
_GROUP = 32
#: Slack of compared distances, far above the rounding of double precision.
_SLACK = 1e-9
SCALE = 1024


def scaled(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v): floor(1024 * x) of every vector without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return rows.where(F.col(vector).isNotNull() & ~bad).select(
        F.col(key).alias("vec_id"), F.col(label).alias("label"), whole.alias("v")
    )


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x) x (entries), as float64 or int64 whole numbers."""
    most = max(int(np.abs(a).max(initial=0)) for a in (x, entries))
    room = 4 * max(1, x.shape[1]) * (most + 1) ** 2
    if room < 1 << 53:  # every product and sum is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    if room >= 1 << 63:
        raise ValueError("vector components are too large for exact distances")
    out = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        out += (x[:, k, None] - entries[None, :, k]) ** 2
    return out


def _below(root: np.ndarray) -> np.ndarray:
    """Single-precision numbers that are surely not above ``root``."""
    return np.nextafter((root * (1 - _SLACK)).astype(np.float32), np.float32(-1)).clip(0)


class Assigner:
    """Nearest entries of one part position, given its codebooks of all rounds so far."""

    def __init__(self, history: np.ndarray) -> None:
        self.history, self.now = history, len(history) - 1
        self.entries = history[-1]
        self.groups = -(-len(self.entries) // _GROUP)
        starts = np.arange(0, len(self.entries), _GROUP)
        moved = history[-1][None].astype(np.float64) - history  # (round, entry, component)
        net = np.sqrt((moved * moved).sum(axis=2)) * (1 + _SLACK)
        self.net = np.maximum.reduceat(net, starts, axis=1)  # (round, group)
        self.scanned = 0

    def assign(self, x: np.ndarray, own: np.ndarray, low: np.ndarray, stamp: np.ndarray):
        """(entry, squared distance, bounds, stamps) of the rows of ``x``.

        ``own`` is the entry of the round before, ``low`` and ``stamp`` are
        (rows, groups). A bound holds for all entries of its group but the own.
        """
        here = _own_squared(x, self.entries[own])
        bound = low - self.net[stamp, np.arange(self.groups)[None, :]]
        limit = np.sqrt(here.astype(np.float64)) * (1 + _SLACK) + _SLACK
        open_ = bound <= limit[:, None]
        best, code = here.copy(), own.copy()
        bound = np.maximum(bound, 0)
        second = bound.copy()
        for g in range(self.groups):
            asked = np.flatnonzero(open_[:, g])
            if not len(asked):
                continue
            first = g * _GROUP
            found = squared(x[asked], self.entries[first : first + _GROUP])
            self.scanned += found.size
            as_float = found.astype(np.float64)
            mine = own[asked] - first
            inside = np.flatnonzero((mine >= 0) & (mine < found.shape[1]))
            as_float[inside, mine[inside]] = np.inf
            nearest = _first_least(found, inside, mine[inside])
            d = found[np.arange(len(asked)), nearest]
            index = nearest + first
            alone = np.isinf(as_float).all(axis=1)  # the group holds the own entry only
            wins = ~alone & ((d < best[asked]) | ((d == best[asked]) & (index < code[asked])))
            best[asked[wins]], code[asked[wins]] = d[wins], index[wins]
            two = np.sort(np.partition(as_float, min(1, found.shape[1] - 1), axis=1)[:, :2], axis=1)
            bound[asked, g] = np.sqrt(two[:, 0])
            second[asked, g] = np.sqrt(two[:, -1]) if two.shape[1] > 1 else np.inf
        changed = np.flatnonzero(code != own)
        bound[changed, code[changed] // _GROUP] = second[changed, code[changed] // _GROUP]
        left = own[changed] // _GROUP  # the entry that was left counts in its group again
        bound[changed, left] = np.minimum(bound[changed, left], np.sqrt(here[changed].astype(np.float64)))
        touched = open_.copy()
        touched[changed, left] = True
        new_low = np.where(touched, _below(bound), low).astype(np.float32)
        return code, best, new_low, np.where(touched, self.now, stamp).astype(np.uint8)


def _own_squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    most = max(int(np.abs(a).max(initial=0)) for a in (x, entries))
    if 4 * max(1, x.shape[1]) * (most + 1) ** 2 >= 1 << 63:
        raise ValueError("vector components are too large for exact distances")
    return ((x - entries) ** 2).sum(axis=1)


def _first_least(found: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The first least column of each row, leaving out one column of the named rows."""
    top = np.iinfo(np.int64).max if found.dtype == np.int64 else np.inf
    held = found[rows, columns]
    found[rows, columns] = top
    nearest = found.argmin(axis=1)
    found[rows, columns] = held
    return nearest


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """The (rows, ``length``) numbers of a list column."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes.min() != length or sizes.max() != length):
        raise ValueError(f"all vectors must have the same length, here {length}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(sizes), length)


def _bytes(column: pa.Array, kind, width: int) -> np.ndarray:
    """The (rows, ``width``) numbers of a binary column whose values are all as long."""
    size = width * np.dtype(kind).itemsize
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    flat = np.frombuffer(column.buffers()[2] or b"", np.uint8)[start : start + size * len(column)]
    return flat.view(kind).reshape(len(column), width)


def _packed(values: np.ndarray) -> pa.Array:
    """A binary column of the bytes of each row."""
    data = np.ascontiguousarray(values)
    offsets = np.arange(len(data) + 1, dtype=np.int32) * np.int32(data.dtype.itemsize * data.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _state_schema(vectors: DataFrame, *more: tuple[str, T.DataType]) -> T.StructType:
    kept = [T.StructField(f.name, f.dataType) for f in vectors.schema if f.name in ("vec_id", "label")]
    return T.StructType(kept + [T.StructField(n, t) for n, t in more])


def _assigned(rows: DataFrame, history: np.ndarray, last: bool) -> DataFrame:
    """One pass over the state: new codes, bounds and stamps; only codes and errors if ``last``.

    ``history`` is (round, part, entry, component). Rows without codes start
    at entry 0 with bounds of nothing.
    """
    parts, depth = history.shape[1], history.shape[3]
    fresh = "codes" not in rows.columns
    groups = -(-history.shape[2] // _GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigners = [Assigner(history[:, p]) for p in range(parts)]
        for batch in batches:
            x = _matrix(batch.column("v"), parts * depth)
            n = len(x)
            if fresh:
                codes, low = np.zeros((n, parts), np.uint8), np.zeros((n, parts, groups), np.float32)
                stamp = np.zeros((n, parts, groups), np.uint8)
            else:
                codes = _bytes(batch.column("codes"), np.uint8, parts).copy()
                low = _bytes(batch.column("low"), "<f4", parts * groups).reshape(n, parts, groups).copy()
                stamp = _bytes(batch.column("stamp"), np.uint8, parts * groups).reshape(n, parts, groups).copy()
            error = np.zeros(n, np.int64)
            for p, assigner in enumerate(assigners):
                code, best, low[:, p], stamp[:, p] = assigner.assign(
                    x[:, p * depth : (p + 1) * depth], codes[:, p].astype(np.int64), low[:, p], stamp[:, p]
                )
                codes[:, p] = code
                error += best.astype(np.int64)
            out = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "codes": _packed(codes)}
            if last:
                out["error"] = pa.array(error)
            else:
                out |= {
                    "v": batch.column("v"), "low": _packed(low.astype("<f4").reshape(n, -1)),
                    "stamp": _packed(stamp.reshape(n, -1)),
                }
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    codes = ("codes", T.BinaryType())
    if last:
        return rows.mapInArrow(run, _state_schema(rows, codes, ("error", T.LongType())))
    vector = ("v", T.ArrayType(T.LongType()))
    return rows.mapInArrow(run, _state_schema(rows, codes, vector, ("low", T.BinaryType()), ("stamp", T.BinaryType())))


def _moved(state: DataFrame, entries: np.ndarray) -> np.ndarray:
    """The codebooks moved to the floored means of their parts; unused entries stay."""
    parts, size, depth = entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, size, depth), np.int64), np.zeros((parts, size), np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), parts * depth)
            codes = _bytes(batch.column("codes"), np.uint8, parts).astype(np.int64)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                used, starts, n = np.unique(codes[order, p], return_index=True, return_counts=True)
                if len(used):
                    total[p, used] += np.add.reduceat(x[order, p * depth : (p + 1) * depth], starts, axis=0)
                    count[p, used] += n
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    partial = state.select("v", "codes").mapInArrow(sums, "part long, entry long, n long, sums array<long>")
    means = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(depth)]).alias("sums")
    )
    new = entries.copy()
    for row in means.collect():  # at most parts x 256 rows
        new[row.part, row.entry] = [total // row.n for total in row.sums]
    return new


@dataclass
class CompressedVectors:
    """``rows``: vec_id, label, codes (a byte per part), error; ``codebooks``: (part, entry, component)."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        """sha256 of the codebooks' decimal components, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()

    def approximated(self, codes: str = "codes") -> Column:
        """The vector that codes stand for: the entries of its parts one after another, unscaled."""
        books = self.codebooks / SCALE

        @F.arrow_udf("array<double>")
        def decode(column: pa.Array) -> pa.Array:
            picked = _bytes(column, np.uint8, len(books))
            whole = np.concatenate([books[p][picked[:, p]] for p in range(len(books))], axis=1)
            return pa.array(list(whole), pa.list_(pa.float64()))

        return decode(codes)


def compress_vectors(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> CompressedVectors | None:
    """Codes of :func:`scaled` vectors by codebooks refined ``rounds`` times; None if there are none.

    The first codebooks are the parts of the first ``entries`` rows by vec_id
    (null ids last, equal ids by vector), fewer if there are fewer rows. Every
    row is coded, repeated ones each for itself. All vectors must have one
    length, a multiple of ``parts``, and components small enough for exact
    64-bit squared distances (about 2**28 in whole numbers): anything else is
    an error that says so.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: entries must be 1 to 256")
    spark = vectors.sparkSession
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not first:
        return None
    length = len(first[0].v)
    if length % parts or any(len(r.v) != length for r in first):
        raise ValueError(f"all vectors must have the same length, a multiple of {parts}")
    start = np.array([r.v for r in first], np.int64).reshape(len(first), parts, length // parts)
    history = start.transpose(1, 0, 2)[None]  # (round, part, entry, component)
    folder = f"{work_folder(spark)}/vector-codes-{uuid.uuid4().hex}"
    state = vectors
    for number in range(rounds):
        done = _assigned(state, history, last=False)
        path = f"{folder}/{number}"
        done.write.parquet(path)
        state = spark.read.schema(done.schema).parquet(path)
        if number:
            _remove(spark, f"{folder}/{number - 1}")
        history = np.concatenate([history, _moved(state, history[-1])[None]])
    coded = saved(_assigned(state, history, last=True), "vector-codes")
    if rounds:
        _remove(spark, folder)
    return CompressedVectors(coded, history[-1])


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def code_digests(rows: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    Vectors that are null or hold null or non-finite components are left out;
    null ids and labels are kept, null labels form one group. Other columns are
    ignored, an empty table gives an empty result. ``label_error`` is summed
    per label with map-side combine and joined back.
    """
    vectors = scaled(rows)
    made = compress_vectors(vectors)
    if made is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
        )
    totals = made.rows.groupBy("label").agg(F.sum("error").alias("label_error")).alias("t")
    return (
        made.rows.alias("r").join(totals, F.expr("r.label <=> t.label"))
        .select(
            "r.vec_id", F.lower(F.hex("r.codes")).alias("code"), "r.error", "t.label_error",
            F.lit(made.digest()).alias("codebooks_sha256"),
        )
    )
