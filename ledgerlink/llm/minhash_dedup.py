"""Near-duplicates by minhash signatures and a multi-index Hamming join.

A document is the set of its 5-word shingles, its signature 64 minima of
independent hashes, of which 16 bits are kept. Signatures are cut into 16
chunks of 4 symbols. If two signatures differ in at most 31 symbols, some chunk
differs in at most one, so listing every chunk with each one symbol left out
finds all pairs up to that distance, and most beyond it. Whatever pair shares a
key is judged by its sizes and full shingle sets alone, however far its
signatures are apart: a pair of similarity exactly 0.75 is lost only if it is
beyond the distance (once in 70,000) and no chunk agrees either.

Equal sets collapse first. Every member of a key's group is then compared with
the group's hub only, its member of most companions, which among near copies is
the text that they were made from; what this links is one component. Only
members of different components of a key are paired in a second round, so a
large group of near copies costs its size, not its square, and no link is lost.
Before the full sets of such a pair are fetched, counts of its shingles by hash
bucket bound their intersection from above (see :func:`most_common`); a bound
cannot reject a link. Links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.anchors import _M1, _mix
from ledgerlink.llm.byte_bpe import small_batches
from ledgerlink.llm.common import components, keyed_texts, one_row_each, partitions_for, saved
from ledgerlink.llm.lz_dedup import word_hashes

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
SYMBOLS, CHUNK = 64, 4
#: Distance up to which all pairs of signatures share a key: each chunk may lose one symbol.
GUARANTEED = 2 * (SYMBOLS // CHUNK) - 1
#: Least and most buckets that a document's shingles are counted in; about one a shingle.
LEAST_BUCKETS, MOST_BUCKETS = 256, 4096
_rng = np.random.default_rng(7)
_A = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.int64).astype(np.uint64)
_BLOCK = 4096
_CELL = 512


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; of all words if there are fewer than five."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    one = np.array(word_hashes(words), np.uint64)
    run = one
    for k in range(1, SHINGLE):
        run = _mix(run[: len(one) - k] * _M1 + one[k:])
    return np.unique(run)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low 16 bits of the 64 minima, mixed."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        block = shingles[at : at + _BLOCK]
        low = np.minimum(low, (block[None, :] * _A[:, None] + _B[:, None]).min(axis=1))
    return (_mix(low) & np.uint64(0xFFFF)).astype(np.uint16)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """(documents, keys): every chunk with each of its symbols left out."""
    chunks = signatures.reshape(len(signatures), -1, CHUNK).astype(np.uint64)
    keys = []
    for gone in range(CHUNK):
        kept = np.delete(chunks, gone, axis=2)
        packed = kept[:, :, 0] | kept[:, :, 1] << np.uint64(16) | kept[:, :, 2] << np.uint64(32)
        which = np.arange(chunks.shape[1], dtype=np.uint64) * np.uint64(CHUNK) + np.uint64(gone)
        keys.append(packed | which[None, :] << np.uint64(48))
    return np.concatenate(keys, axis=1).view(np.int64)


def _signatures(texts: DataFrame) -> DataFrame:
    """(doc_id, n, digest, symbols, counts) of every text; ``counts`` as :func:`bucket_counts`."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                sets = [shingle_set(t) for t in part.column("text").to_pylist()]
                signs = np.stack([signature(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([s.astype("<u2").tobytes() for s in signs], pa.binary()),
                        pa.array([bucket_counts(s).tobytes() for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n", "digest", "symbols", "counts"],
                )

    return texts.mapInArrow(run, f"doc_id {kind}, n long, digest binary, symbols binary, counts binary")


def _keys(reps: DataFrame) -> DataFrame:
    """(key, id): one row per document and index key."""
    kind = reps.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            signs = np.frombuffer(b"".join(batch.column("symbols").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            keys = index_keys(signs)
            which = pa.array(np.repeat(np.arange(len(signs)), keys.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), batch.column("id").take(which)], names=["key", "id"]
            )

    return reps.select("id", "symbols").mapInArrow(run, f"key long, id {kind}")


def bucket_counts(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each hash bucket, 255 meaning that or more; a power of two of buckets."""
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (max(1, len(shingles)) - 1).bit_length()))
    counts = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8)


def _folded(counts: np.ndarray, buckets: int) -> np.ndarray:
    """The counts in fewer buckets."""
    return counts.reshape(-1, buckets).sum(axis=0, dtype=np.int32)


def most_common(a: np.ndarray, b: np.ndarray) -> int | None:
    """A bound that the intersection cannot exceed: in each bucket at most the smaller count.

    None if a count is full, when nothing can be said.
    """
    if a.max() == 255 or b.max() == 255:
        return None
    buckets = min(len(a), len(b))
    return int(np.minimum(_folded(a, buckets), _folded(b, buckets)).sum())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _beside(pairs: DataFrame, rows: DataFrame, values: list[str]) -> DataFrame:
    """The saved ``pairs`` (a, b) with the ``values`` of both: of a by their names, of b with a 2 added.

    Only rows that occur as b are shuffled: their ids are few pairs' worth, and
    the engine broadcasts them, or the pairs, if they are small enough.
    """
    left = rows.select(F.col("id").alias("a"), *values)
    right = rows.select(F.col("id").alias("b"), *[F.col(v).alias(f"{v}2") for v in values])
    right = right.join(pairs.select("b").distinct(), "b", "left_semi")
    return pairs.join(left, "a").join(right, "b").select("a", "b", *values, *[f"{v}2" for v in values])


def _unrejected(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sizes and bucket counts allow to link."""
    kind = pairs.schema["a"].dataType.simpleString()
    sizes = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * PERCENT
    rows = _beside(pairs, signed.withColumnRenamed("doc_id", "id"), ["n", "counts"]).where(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n1, c1, n2, c2 = (batch.column(c) for c in ("a", "b", "n", "counts", "n2", "counts2"))
            keep = []
            for i in range(len(batch)):
                most = most_common(*(np.frombuffer(c[i].as_buffer(), np.uint8) for c in (c1, c2)))
                keep.append(most is None or may_link(most, n1[i].as_py(), n2[i].as_py()))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = _beside(pairs, texts.withColumnRenamed("doc_id", "id"), ["text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = object(), None
        for batch in batches:
            for part in small_batches(batch, "text"):
                keep = []
                ids = part.column("b").to_pylist()
                for i, text in enumerate(part.column("text").to_pylist()):
                    if ids[i] != last:  # rows arrive by b, so its set is made once
                        last, of_last = ids[i], shingle_set(part.column("text2")[i].as_py())
                    keep.append(linked(shingle_set(text), of_last))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], names=["a", "b"]
                )

    return rows.mapInArrow(run, f"a {kind}, b {kind}")


def _across_components(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) that may link and have different components, among (grp, id, n, component, counts) rows.

    A group holds the members of all keys with the same smallest component.
    Groups are dealt to cells; one of more rows than a cell is cut into parts
    by hash, and every two parts meet, so no task holds a whole hot group.
    Cells are many to a task, in a number of tasks that follows their number.
    """
    kind = rows.schema["id"].dataType.simpleString()
    total = rows.count()
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("rows"))
    groups = partitions_for(total, 2 * _CELL)
    known = rows.join(sizes, "grp").withColumn("parts", F.ceil(F.col("rows") / _CELL).cast("int"))
    dealt = (
        known.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .withColumn(
            "cell",
            F.when(F.col("parts") == 1, F.pmod(F.xxhash64("grp"), F.lit(groups))).otherwise(F.xxhash64("grp", "i", "j")),
        )
        .select("cell", "grp", "i", "j", "own", "id", "n", "component", "counts")
    )
    tasks = partitions_for(total, 2 * _CELL, rows.sparkSession.sparkContext.defaultParallelism)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("i", "ascending"), ("j", "ascending")])
        grp, i, j, own, ids, n, component = (
            table.column(c).to_numpy() for c in ("grp", "i", "j", "own", "id", "n", "component")
        )
        counts = [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]
        coarse = np.stack([_folded(c, LEAST_BUCKETS) for c in counts])
        full = np.array([c.max() == 255 for c in counts])
        left, right = [], []
        at = np.arange(len(ids))
        for step in range(1, len(ids)):
            at = at[at + step < len(ids)]
            at = at[(grp[at] == grp[at + step]) & (i[at] == i[at + step]) & (j[at] == j[at + step])]
            if not len(at):
                break
            to = at + step
            fits = (component[at] != component[to]) & ((i[at] == j[at]) | (own[at] != own[to]))
            fits &= np.minimum(n[at], n[to]) * 100 >= np.maximum(n[at], n[to]) * PERCENT
            one, two = at[fits], to[fits]
            near = may_link(np.minimum(coarse[one], coarse[two]).sum(axis=1), n[one], n[two]) | full[one] | full[two]
            for x, y in zip(one[near].tolist(), two[near].tolist(), strict=True):
                most = most_common(counts[x], counts[y])
                if most is None or may_link(most, n[x], n[y]):
                    left.append(x)
                    right.append(y)
        a, b = ids[np.array(left, np.int64)], ids[np.array(right, np.int64)]
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return dealt.repartition(tasks, "cell").groupBy("cell").applyInArrow(run, f"a {kind}, b {kind}").distinct()


def may_link(most, n1, n2):
    """Whether an intersection of at most ``most`` can make sets of these sizes similar enough."""
    return (100 + PERCENT) * most >= PERCENT * (n1 + n2)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Texts that are null or without words have no shingles and link with
    nothing. Repeated ids are one document with the smallest text; rows without
    id come back with no component and are kept.
    """
    texts = keyed_texts(docs)
    signed = saved(_signatures(texts), "signatures")
    classes = (
        signed.where("n > 0").groupBy("n", "digest")
        .agg(F.min(F.struct("doc_id", "symbols")).alias("r"))
        .select(F.col("r.doc_id").alias("id"), "n", "digest", "r.symbols")
    )
    reps = saved(classes, "classes")
    keys = _keys(reps)
    groups = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = saved(keys.join(groups, "key"), "shared")
    companions = shared.groupBy("id").agg(F.sum("members").alias("companions"))
    hub = F.min(F.struct((-F.col("companions")).alias("order"), "id")).alias("hub")
    hubs = shared.select("key", "id").join(companions, "id").groupBy("key").agg(hub)
    meetings = (
        shared.join(hubs, "key").where("hub.id <> id")
        .select(F.greatest("id", "hub.id").alias("a"), F.least("id", "hub.id").alias("b")).distinct()
    )
    tried = saved(meetings, "tried")
    first = saved(_confirmed(saved(_unrejected(tried, signed), "allowed"), texts), "links")
    named = shared.select("key", "id").join(
        components(first).withColumnRenamed("node", "id"), "id", "left"
    ).withColumn("component", F.coalesce("component", "id"))
    named = saved(named, "named")
    split = named.groupBy("key").agg(F.min("component").alias("grp"), F.max("component").alias("hi")).where("grp <> hi")
    members = saved(named.join(split, "key").select("grp", "id", "component").distinct(), "members")
    sketches = signed.select(F.col("doc_id").alias("id"), "n", "counts")
    across = _across_components(members.join(sketches, "id")).join(tried, ["a", "b"], "left_anti")
    second = saved(_confirmed(saved(across, "across"), texts), "links")
    merged = components(first.union(second))
    named_classes = reps.select("n", "digest", "id").join(
        merged.withColumnRenamed("node", "id"), "id", "left"
    ).select("n", "digest", F.coalesce("component", "id").alias("component_id"))
    result = signed.select("doc_id", "n", "digest").join(named_classes, ["n", "digest"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
    without_id = docs.where("doc_id is null").select("doc_id", "text")
    return result.withColumn("kept", F.col("doc_id") == F.col("component_id")).unionByName(
        _signatures(without_id).select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
        )
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that represent their group, and all without id, unchanged.

    Of rows that repeat an id, which are one document, only that with the
    smallest text stays (see :func:`ledgerlink.llm.common.one_row_each`).
    """
    docs = one_row_each(docs)
    gone = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
