"""Anchors: places, chosen by content, at which equal windows of any texts meet.

A window of W symbols (bytes or words) is owned by the leftmost of its k-grams
with the smallest hash. Equal windows own equal k-grams at equal offsets, so
texts that share a window share an anchor hash. Consecutive windows with one
anchor form a piece: the windows' starts and the symbols they cover. Two pieces
can only hold a common window if their anchors are equal.

Everything that later compares texts works on pieces grouped by anchor. Pieces
equal in all symbols collapse before that, as only the first one matters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.byte_bpe import small_batches
from ledgerlink.llm.common import keyed_texts, saved

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_M3 = np.uint64(0x165667B19E3779F9)
_LOW = np.uint64(0xFFFFFFFF)
_CHUNK_BYTES = 2 << 20
#: An anchor with more different pieces than this is compared window by window.
HOT_PIECES = 4_000

PIECES = "anchor long, content long, doc_id {id}, start int, n int"


@dataclass(frozen=True)
class Windows:
    """What is compared: window length, k-gram length (a power of two) and the symbols' reader.

    ``symbols`` turns texts into (hash of every symbol, symbols per text);
    ``across`` tells whether only earlier documents count or also earlier
    places of the same document. A task compares about ``bucket_symbols`` of
    pieces at a time.
    """

    length: int
    gram: int
    symbols: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    across: bool
    bucket_symbols: int = 1 << 20

    @property
    def reach(self) -> int:
        return self.length - self.gram + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= _M3
    x ^= x >> np.uint64(32)
    return x


def gram_hashes(symbols: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hashes of all runs of each length (powers of two), by doubling."""
    out, now, size = {}, symbols, 1
    while size <= max(lengths):
        if size in lengths:
            out[size] = now
        if len(now) <= size:
            out |= {n: now[:0] for n in lengths if n > size}
            break
        now = _mix(now[:-size] * _M1 + now[size:])
        size *= 2
    return out


def owners(grams: np.ndarray, reach: int) -> np.ndarray:
    """For each start, the position of the leftmost smallest of the next ``reach`` hashes."""
    if len(grams) < reach:
        return np.zeros(0, np.int64)
    low = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= reach:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < reach:
        low = np.minimum(low[: len(low) - (reach - size)], low[reach - size :])
    return (low & _LOW).astype(np.int64)


def pieces(symbols: np.ndarray, counts: np.ndarray, windows: Windows):
    """(text, start in the text, windows, anchor, content) of all pieces of several texts."""
    top = 1 << (windows.length.bit_length() - 1)
    top = top if top <= windows.length else top // 2
    hashes = gram_hashes(symbols, (windows.gram, top))
    owner = owners(hashes[windows.gram], windows.reach)
    ends = np.cumsum(counts)
    starts = ends - counts
    text_of = np.repeat(np.arange(len(counts)), counts)[: len(owner)]
    inside = np.arange(len(owner)) + windows.length <= ends[text_of]
    owner = np.where(inside, owner, -1)
    cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    run = np.diff(np.append(cut, len(owner)))
    real = owner[cut] >= 0
    cut, run = cut[real], run[real]
    span = run - 1 + windows.length - top  # from the first to the last long gram
    long = hashes[top]
    content = long[cut] * _M1 + long[cut + span // 2] * _M2 + long[cut + span] * _M3 + run.astype(np.uint64)
    text = text_of[cut]
    return text, cut - starts[text], run, hashes[windows.gram][owner[cut]], _mix(content)


def _merged(text: np.ndarray, start: np.ndarray, run: np.ndarray):
    """Runs of adjacent pieces of a text as one (text, start, windows)."""
    order = np.lexsort((start, text))
    text, start, run = text[order], start[order], run[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + run[:-1])
    first = np.flatnonzero(new)
    return text[first], start[first], np.add.reduceat(run, first) if len(first) else run


def find_pieces(texts: DataFrame, windows: Windows) -> DataFrame:
    """(anchor, content, doc_id, start, n) of the pieces of all texts.

    Within one batch of a task, a piece that repeats an earlier one is already
    known to be a repeat: such rows have a null anchor and are merged runs. So
    a passage of a hot group leaves each batch once.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text", _CHUNK_BYTES):
                ids = part.column("doc_id")
                symbols, counts = windows.symbols([t or "" for t in part.column("text").to_pylist()])
                text, start, n, anchor, content = pieces(symbols, counts, windows)
                if not len(text):
                    continue
                rank = np.argsort(np.argsort(np.array(ids.to_pylist(), dtype=object), kind="stable"), kind="stable")[text]
                order = np.lexsort((start, rank, content, anchor))
                same = np.zeros(len(order), bool)
                same[1:] = (anchor[order][1:] == anchor[order][:-1]) & (content[order][1:] == content[order][:-1])
                if windows.across:  # a place in the first document is no repeat
                    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
                    same &= rank[order] != rank[order][leader]
                first, later = order[~same], order[same]
                t2, s2, n2 = _merged(text[later], start[later], n[later])
                none = pa.nulls(len(t2), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(anchor[first].view(np.int64)), none]),
                        pa.concat_arrays([pa.array(content[first].view(np.int64)), none]),
                        ids.take(pa.array(np.concatenate([text[first], t2]))),
                        pa.array(np.concatenate([start[first], s2]).astype(np.int32)),
                        pa.array(np.concatenate([n[first], n2]).astype(np.int32)),
                    ],
                    names=["anchor", "content", "doc_id", "start", "n"],
                )

    return texts.where("doc_id is not null").mapInArrow(run, PIECES.format(id=kind))


def repeated_runs(
    texts: DataFrame,
    windows: Windows,
    cut: Callable[[list[str], np.ndarray, np.ndarray], list[bytes]],
    compare: Callable[[DataFrame], DataFrame],
    hot_pieces: int = HOT_PIECES,
) -> DataFrame:
    """(doc_id, start, n): runs of window starts of which an equal window comes earlier.

    ``cut`` gives the symbols of pieces as bytes, ``compare`` finds repeated
    windows among (bucket, anchor, doc_id, start, n, piece) rows.

    1. Pieces of all texts, written once.
    2. Anchors that occur once anywhere are dropped by a count and a join.
    3. Equal pieces collapse to their first place; all other places are repeats.
    4. Anchors with several different pieces go to ``compare``, in buckets of
       bounded size. Anchors with more than ``hot_pieces`` pieces, such as those
       at the edges of a very common passage, are compared by the digest of each
       window, an aggregation with map-side combine: same answer for any number.
    """
    found = saved(find_pieces(texts, windows), "pieces")
    single = found.where("anchor is not null")
    often = single.groupBy("anchor").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("anchor")
    places = saved(single.join(often, "anchor"), "places")
    place = F.struct("doc_id", "start", "n")
    firsts = saved(places.groupBy("anchor", "content").agg(F.min(place).alias("first")), "firsts")
    earlier = F.col("first.doc_id") < F.col("doc_id")
    if not windows.across:
        earlier = earlier | ((F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.start") < F.col("start")))
    copies = places.join(firsts, ["anchor", "content"]).where(earlier).select("doc_id", "start", "n")

    variants = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    chosen = firsts.join(variants, "anchor")
    if windows.across:  # other places in the first document share the first place's fate
        same_doc = places.join(firsts, ["anchor", "content"]).where("first.doc_id = doc_id")
        chosen = same_doc.join(variants, "anchor").select("anchor", "variants", place.alias("first"))
    chosen = saved(chosen.select("anchor", (F.col("variants") > hot_pieces).alias("hot"), "first.*"), "chosen")
    size = chosen.where("not hot").agg(F.sum(F.col("n") + windows.length)).first()[0] or 0
    buckets = max(1, int(size // windows.bucket_symbols))
    lists = chosen.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "start", "n", "hot")).alias("wanted"))
    cut_out = _cut_pieces(texts.join(lists, "doc_id", "left"), windows, cut, buckets)
    compared = compare(cut_out.where("bucket is not null"))
    hot = _by_window(cut_out.where("bucket is null"), windows) if chosen.where("hot").limit(1).count() else None
    runs = found.where("anchor is null").select("doc_id", "start", "n").unionByName(copies).unionByName(compared)
    return runs if hot is None else runs.unionByName(hot)


def _cut_pieces(rows: DataFrame, windows: Windows, cut, buckets: int) -> DataFrame:
    """Rows (bucket, anchor, doc_id, start, n, piece); hot ones one per window, without a bucket."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["bucket", "anchor", "doc_id", "start", "n", "piece"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.compute.is_valid(batch.column("wanted")))
            for part in small_batches(batch, "text", _CHUNK_BYTES):
                wanted = part.column("wanted")
                flat = wanted.flatten()
                text = np.repeat(np.arange(len(part)), pa.compute.list_value_length(wanted).to_numpy())
                anchor, start, n, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                single = np.ones_like(n)
                times = np.where(hot, n, 1)
                which = np.repeat(np.arange(len(n)), times)
                inner = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                start2, n2 = start[which] + inner, np.where(hot[which], single[which], n[which])
                got = cut(part.column("text").to_pylist(), text[which], start2, n2 - 1 + windows.length)
                bucket = (anchor[which].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket, pa.int64(), mask=hot[which].astype(bool)),
                        pa.array(anchor[which]),
                        part.column("doc_id").take(pa.array(text[which])),
                        pa.array(start2.astype(np.int32)),
                        pa.array(n2.astype(np.int32)),
                        pa.array(got, pa.binary()),
                    ],
                    names=names,
                )

    return rows.mapInArrow(run, f"bucket long, anchor long, doc_id {kind}, start int, n int, piece binary")


def _by_window(rows: DataFrame, windows: Windows) -> DataFrame:
    """Repeats among single windows, by digest: no window group ever meets in one task."""
    digests = rows.select(F.unhex(F.sha2("piece", 256)).alias("digest"), "doc_id", "start", "n")
    first = digests.groupBy("digest").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    met = digests.join(first, "digest")
    if windows.across:
        return met.where("first.doc_id < doc_id").select("doc_id", "start", "n")
    return met.where("first.doc_id < doc_id or (first.doc_id = doc_id and first.start < start)").select("doc_id", "start", "n")


def with_runs(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """``texts`` with the (start, n) runs of each as ``runs``, null if it has none."""
    per_doc = runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    return texts.join(per_doc, "doc_id", "left")


def covered(size: int, starts: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``size`` symbols lie in a window that starts in one of the runs."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, np.clip(starts, 0, size), 1)
    np.add.at(change, np.clip(starts + counts - 1 + length, 0, size), -1)
    return np.cumsum(change[:-1]) > 0


def all_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one row per id, and every row without one."""
    return keyed_texts(docs).union(docs.where("doc_id is null").select("doc_id", "text"))


def group_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Rows of a bucket in the order of (doc_id, start): their order, starts, counts and pieces."""
    order = pa.compute.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("start", "ascending")])
    table = table.take(order)
    return table, table.column("start").to_numpy(), table.column("n").to_numpy(), table.column("piece").to_pylist()
