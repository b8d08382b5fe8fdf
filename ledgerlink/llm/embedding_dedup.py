"""Near-duplicate vectors by sorted projection passes.

Equal vectors of a label collapse first. In every pass the distinct vectors of
a label, less the label's mean direction, are ordered by a 64-bit code of the
signs of random projections, read as one number, and each is compared with the
next ``window`` ones. Pairs of the wanted cosine from all passes are united. The
number of passes grows with the label's size and mean cosine, without a cap. A
label so alike that its passes would compare no fewer pairs than it has is
compared wholly, in cells. The window bounds what a pass compares, not what is
counted: the links of a vector are counted exactly among all vectors of its
component, copies by their number.

Passes sort keys alone. Blocks of the order then fetch vectors in 16 bits a
component, whose error is bounded: pairs too close to the wanted cosine to tell
are compared in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import components, partitions_for, saved

COSINE = 0.98
#: At cosine 0.98 two codes agree in the first b bits with probability 0.936**b.
#: Passes are the least of a label; :func:`passes_for` has what larger labels take.
PASSES, WINDOW = 12, 48
#: Chance to miss a pair exactly at the cosine, by which passes are counted.
MISSED = 1e-3
#: Full scale of a component of a unit vector in 16 bits.
_SCALE = 32767
#: Means of labels up to this size travel to every task; above, they are joined.
_BROADCAST_BYTES = 32 << 20
_BLOCK = 4096
_CELL = 4096
_ROWS_AT_ONCE = 512
_SORT_ROWS = 50_000


def usable_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, size, packed) of rows that can link, one per id.

    Left out are null ids and labels, vectors that are null, empty, zero or
    hold null or non-finite components. Of rows that repeat an id the smallest
    (vector, label) counts.
    """
    one = rows.select("vec_id", "label", "embedding").where("vec_id is not null")
    if not one.groupBy("vec_id").count().where("count > 1").isEmpty():
        one = one.groupBy("vec_id").agg(F.min(F.struct("embedding", "label")).alias("r")).select(
            "vec_id", "r.label", "r.embedding"
        )
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    fit = one.where("label is not null and embedding is not null").where(~bad & ~zero)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int32)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # no negative zeros
            ends = np.cumsum(sizes)
            packed = [flat[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(sizes), pa.array(packed, pa.binary())],
                names=["vec_id", "label", "size", "packed"],
            )

    return fit.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, size int, packed binary")


def _unit(packed: list[bytes]) -> np.ndarray:
    """Unit vectors in double precision; scaling first keeps huge and tiny components finite."""
    v = np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def codes(vectors: np.ndarray, number: int) -> np.ndarray:
    """The sign codes of pass ``number``; signed integers in the order of the bits."""
    planes = np.random.default_rng((number, vectors.shape[1])).standard_normal((vectors.shape[1], 64))
    bits = (vectors @ planes > 0).astype(np.uint64)
    shifts = np.arange(63, -1, -1, dtype=np.uint64)
    return ((bits << shifts).sum(axis=1, dtype=np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def passes_for(n: int, alike: float, cosine: float = COSINE, least: int = PASSES, window: int = WINDOW) -> int:
    """Passes for ``n`` distinct vectors of a label whose mean cosine is ``alike``; 0: compare it wholly.

    One pass compares all of a group that fits its window. Otherwise a pair is
    sure to meet if its codes share the first log2(n / window) bits. The more
    alike a label, the less the signs tell a link from any other pair; passes
    that would compare half as many pairs as ``n`` squared are not worth it.
    """
    if n <= window + 1:
        return 1
    rest = (cosine - alike) / (1 - alike) if alike < cosine else 0.0
    met = (1 - np.arccos(min(rest, 1.0)) / np.pi) ** np.log2(n / window)
    passes = 1 if met >= 1 else int(np.ceil(np.log(MISSED) / np.log1p(-met)))
    return 0 if passes > least and 2 * passes * window >= n else max(least, passes)


def _groups(vectors: DataFrame, cosine: float, least: int, window: int) -> DataFrame:
    """(label, size, n, passes, mean) of the distinct vectors of a label and length."""
    kind = vectors.schema["label"].dataType.simpleString()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                names = part.column("label").dictionary_encode()
                which = names.indices.to_numpy()
                sums = np.zeros((len(names.dictionary), size))
                np.add.at(sums, which, _unit(part.column("packed").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        names.dictionary, pa.array(np.full(len(sums), size, np.int32)),
                        pa.array(np.bincount(which, minlength=len(sums))), pa.array(list(sums), pa.list_(pa.float64())),
                    ],
                    names=["label", "size", "n", "mean"],
                )

    def whole(table: pa.Table) -> pa.Table:
        n = int(np.sum(table.column("n").to_numpy()))
        mean = np.stack(table.column("mean").to_pylist()).sum(axis=0) / n
        alike = max(0.0, (n * float(mean @ mean) - 1) / max(1, n - 1))
        return pa.table({
            "label": table.column("label").slice(0, 1), "size": table.column("size").slice(0, 1), "n": pa.array([n]),
            "passes": pa.array([passes_for(n, alike, cosine, least, window)], pa.int32()), "mean": pa.array([mean.tolist()], pa.list_(pa.float64())),
        })

    parts = vectors.select("label", "size", "packed").mapInArrow(partial, f"label {kind}, size int, n long, mean array<double>")
    return parts.groupBy("label", "size").applyInArrow(whole, f"label {kind}, size int, n long, passes int, mean array<double>")


def _coded(vectors: DataFrame) -> DataFrame:
    """(pass, code, vec_id, label, size), once per pass, from (vec_id, label, size, packed, passes, mean) rows."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                passes = part.column("passes").to_numpy()
                mean = part.column("mean").flatten().to_numpy().reshape(len(part), -1)
                unit = _unit(part.column("packed").to_pylist()) - mean
                part = part.select(["vec_id", "label", "size"])
                for number in range(passes.max()):
                    on = passes > number
                    rows = part.filter(pa.array(on))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), number, np.int32)), pa.array(codes(unit[on], number)), *rows.columns],
                        names=["pass", "code", *rows.schema.names],
                    )

    return vectors.mapInArrow(run, f"pass int, code long, vec_id {kinds['vec_id']}, label {kinds['label']}, size int")


def _ranked(coded: DataFrame, rows: int) -> DataFrame:
    """Rows in the order (pass, label, size, code, vec_id) with their rank in it.

    A range sort, written once; the rank is the place in a partition plus the
    rows of the partitions before it, of which there is one number each.
    """
    parts = partitions_for(rows, _SORT_ROWS)
    order = ["pass", "label", "size", "code", "vec_id"]
    ordered = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    written = saved(
        ordered.drop("code").withColumn("part", F.shiftright(place, 33)).withColumn(
            "at", place.bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "sorted",
    )
    counts = sorted((r["part"], r["n"]) for r in written.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    begins = written.sparkSession.createDataFrame(starts, "part long, begin long")
    return written.join(begins, "part").withColumn("rank", F.col("at") + F.col("begin"))


def _short(vectors: DataFrame) -> DataFrame:
    """(vec_id, short): unit vectors in 16 bits a component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                q = np.rint(_unit(part.column("packed").to_pylist()) * _SCALE).astype("<i2")
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array([row.tobytes() for row in q], pa.binary())], names=["vec_id", "short"]
                )

    return vectors.select("vec_id", "size", "packed").mapInArrow(run, f"vec_id {kind}, short binary")


def slack_of(size: int) -> float:
    """How far the dot product of two short vectors may lie from their cosine.

    A component is off by half a step at most, a vector by ``off``; the rest covers the rounding of sums.
    """
    off = 0.5 / _SCALE * np.sqrt(size)
    return float(2 * off + off * off + 1e-12 * size)


def _neighbours(ranked: DataFrame, vectors: DataFrame, window: int, cosine: float) -> DataFrame:
    """Verified pairs (a, b) within the window; blocks overlap by it, so none is missed."""
    block = F.floor(F.col("rank") / _BLOCK).cast("long")
    halo = (F.col("rank") % _BLOCK < window) & (F.col("rank") >= _BLOCK)
    blocks = F.when(halo, F.array(block, block - 1)).otherwise(F.array(block))
    dealt = ranked.withColumn("block", F.explode(blocks)).select(
        "block", "rank", "pass", "label", "size", "vec_id"
    ).join(_short(vectors), "vec_id")
    kind = ranked.schema["vec_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        group = np.stack([table.column(c).to_numpy() for c in ("pass", "label", "size")])
        ids, short = table.column("vec_id").to_numpy(), table.column("short").to_pylist()
        edges = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        left, right, sure = [ids[:0]], [ids[:0]], [np.zeros(0, bool)]
        for lo, hi in zip([0, *edges], [*edges, len(ids)], strict=True):
            v = np.frombuffer(b"".join(short[lo:hi]), "<i2").reshape(hi - lo, -1) / _SCALE
            slack = slack_of(v.shape[1])
            for step in range(1, min(window, hi - lo - 1) + 1):
                dots = np.einsum("ij,ij->i", v[:-step], v[step:])
                near = np.flatnonzero(dots >= cosine - slack)
                left.append(ids[lo + near])
                right.append(ids[lo + near + step])
                sure.append(dots[near] >= cosine + slack)
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b), "sure": np.concatenate(sure)})

    found = dealt.groupBy("block").applyInArrow(run, f"a {kind}, b {kind}, sure boolean").distinct()
    found = saved(found, "neighbours")
    return found.where("sure").select("a", "b").union(_compared(found.where("not sure").select("a", "b"), vectors, cosine))


def _compared(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """The ``pairs`` of the wanted cosine in double precision."""
    kind = pairs.schema["a"].dataType.simpleString()
    first = vectors.select(F.col("vec_id").alias("a"), "size", F.col("packed").alias("of_a"))
    second = vectors.select(F.col("vec_id").alias("b"), F.col("packed").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                one, two = (_unit(part.column(c).to_pylist()) for c in ("of_a", "of_b"))
                yield part.select(["a", "b"]).filter(pa.array(np.einsum("ij,ij->i", one, two) >= cosine))

    return pairs.join(first, "a").join(second, "b").mapInArrow(run, f"a {kind}, b {kind}")


def _cells(members: DataFrame) -> DataFrame:
    """(component, vec_id, packed, weight) rows dealt to cells of bounded size.

    A component of up to one cell is one piece, many such per group. A larger
    one is cut into parts by hash, and every two parts meet in a cell: vectors
    are sent once per part.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    parts = F.ceil(F.col("members") / _CELL).cast("int")
    groups = partitions_for(members.count(), 4 * _CELL)
    known = members.join(sizes, "component").withColumn("parts", parts)
    own = F.when(F.col("parts") == 1, 0).otherwise(F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    return (
        known.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .withColumn(
            "cell",
            F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(groups)))
            .otherwise(F.xxhash64("component", "i", "j")),
        )
        .select("cell", "component", "i", "j", "own", "vec_id", "packed", "weight")
    )


def _pieces(table: pa.Table) -> tuple[pa.Table, Iterator[tuple[int, int]]]:
    """A group of cells in order, and the rows of each cell in it."""
    keys = ["component", "i", "j"]
    table = table.sort_by([(c, "ascending") for c in keys])
    at = np.stack([table.column(c).to_numpy() for c in keys])
    edges = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
    return table, zip([0, *edges], [*edges, table.num_rows], strict=True)


def forest(unit: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (from, to) that hold together what all links of the rows hold together, one per row reached."""
    left, right = [np.zeros(0, int)], [np.zeros(0, int)]
    away = np.arange(len(unit))
    while len(away):
        reached, away = [away[0]], away[1:]
        while reached and len(away):
            now, reached = np.array(reached[:_ROWS_AT_ONCE]), reached[_ROWS_AT_ONCE:]
            near = unit[now] @ unit[away].T >= cosine
            hit = near.any(axis=0)
            left.append(now[near.argmax(axis=0)[hit]])
            right.append(away[hit])
            reached.extend(away[hit])
            away = away[~hit]
    return np.concatenate(left), np.concatenate(right)


def _whole_links(vectors: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b) that hold the components of wholly compared labels, at most one per vector and cell.

    Every pair meets in a cell, and a cell hands on a forest of its links, never all of them.
    """
    of_label = vectors.groupBy("label", "size").agg(F.min("vec_id").alias("component"))
    members = vectors.join(of_label, ["label", "size"]).select("component", "vec_id", "packed", F.lit(1).cast("long").alias("weight"))
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table, pieces = _pieces(table)
        ids, packed = table.column("vec_id").to_numpy(), table.column("packed").to_pylist()
        left, right = [ids[:0]], [ids[:0]]
        for lo, hi in pieces:
            a, b = forest(_unit(packed[lo:hi]), cosine)
            left.append(ids[lo + a])
            right.append(ids[lo + b])
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return _cells(members).groupBy("cell").applyInArrow(run, f"a {kind}, b {kind}")


def _link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """(vec_id, n_links) among (component, vec_id, packed, weight) rows, by cells of bounded size.

    A link counts as often as the other vector's weight says.

    Pairs are counted and never listed.
    """
    kind = members.schema["vec_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table, pieces = _pieces(table)
        ids, packed = table.column("vec_id").to_numpy(), table.column("packed").to_pylist()
        own, weight = table.column("own").to_numpy(), table.column("weight").to_numpy()
        i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
        counts = np.zeros(len(ids), np.int64)
        for lo, hi in pieces:
            unit = _unit(packed[lo:hi])
            first = np.flatnonzero(own[lo:hi] == i[lo])
            second = np.flatnonzero(own[lo:hi] == j[lo])
            for start in range(0, len(first), _ROWS_AT_ONCE):
                rows = first[start : start + _ROWS_AT_ONCE]
                near = unit[rows] @ unit[second].T >= cosine
                if i[lo] == j[lo]:
                    near[np.arange(len(rows)), start + np.arange(len(rows))] = False
                else:
                    counts[lo + second] += weight[lo + rows] @ near
                counts[lo + rows] += near @ weight[lo + second]
        return pa.table({"vec_id": ids, "n": counts})

    counted = _cells(members).groupBy("cell").applyInArrow(run, f"vec_id {kind}, n long")
    return counted.groupBy("vec_id").agg(F.sum("n").alias("n_links"))


def near_vectors(rows: DataFrame, cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per id.

    Vectors that cannot link (see :func:`usable_vectors`) have no links and are
    their own component; rows without id come back with a null component and
    are kept. An empty table gives an empty result.
    """
    vectors = saved(usable_vectors(rows), "vectors")
    same = ["label", "size", "packed"]
    distinct = saved(vectors.groupBy(*same).agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight")), "distinct")
    groups = saved(_groups(distinct, cosine, passes, window), "groups")
    totals = groups.agg(F.sum(F.col("n") * F.col("passes")), F.sum(F.col("size").cast("long") * 8 + 64), F.count_if(F.col("passes") == 0)).first()
    known = groups.select("label", "size", "passes", "mean")
    if (totals[1] or 0) <= _BROADCAST_BYTES:
        known = F.broadcast(known)
    planned = distinct.select("vec_id", *same).join(known, ["label", "size"])
    pairs = _neighbours(_ranked(_coded(planned), totals[0] or 0), distinct, window, cosine)
    if totals[2]:
        pairs = pairs.union(_whole_links(planned.where("passes = 0"), cosine))
    named = saved(components(pairs).withColumnRenamed("node", "vec_id"), "components")
    members = named.join(distinct.select("vec_id", "packed", "weight"), "vec_id")
    counts = _link_counts(members, cosine)
    answers = saved(
        distinct.join(named, "vec_id", "left").join(counts, "vec_id", "left").select(
            "vec_id", *same, "weight", F.coalesce("component", "vec_id").alias("component"),
            (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ),
        "answers",
    )
    copies = vectors.join(answers.where("weight > 1").drop("vec_id", "weight"), same)
    columns = ["vec_id", "component", "n_links"]
    linked = answers.where("weight = 1").select(*columns).union(copies.select(*columns))
    ids = rows.where("vec_id is not null").select("vec_id").distinct()
    found = ids.join(linked, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").cast("long").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
    without = rows.where("vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast(T.LongType()).alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return found.unionByName(without)
