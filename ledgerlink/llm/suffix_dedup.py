"""Removal of repeated byte strings by suffix arrays of two-stage sorting.

Texts meet at anchors (see :mod:`ledgerlink.llm.anchors`); the pieces of a
bucket are joined into one string whose suffixes are sorted. Only suffixes
smaller than their successor are sorted directly. One scan over the buckets of
first bytes induces all others. Neighbours in the suffix array then give the
common prefixes, and windows with a common prefix of full length are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlink.llm.anchors import Windows, all_texts, covered, group_arrays, repeated_runs, with_runs
from ledgerlink.llm.byte_bpe import small_batches
from ledgerlink.llm.common import keyed_texts

LENGTH = 100
_BYTE_HASH = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

_POWERS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def byte_symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = [t.encode() for t in texts]
    counts = np.array([len(d) for d in data], np.int64)
    return _BYTE_HASH[np.frombuffer(b"".join(data), np.uint8)], counts


def _cut_bytes(texts: list[str], which: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    data = [t.encode() for t in texts]
    return [data[w][a : a + n] for w, a, n in zip(which.tolist(), starts.tolist(), sizes.tolist(), strict=True)]


def _eight_bytes(text: np.ndarray) -> np.ndarray:
    """The next eight bytes of every position as one big-endian number, zeros past the end."""
    word = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        word = (word[: -size] << np.uint64(8 * size)) | word[size:]
    return word[: len(text)]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of a byte string by their suffixes, exact in the first ``depth`` bytes.

    Two-stage sorting. Suffixes smaller than their successor are sorted by
    eight-byte words, ties only being refined up to ``depth``. Then first-byte
    buckets are scanned upwards: each entry's predecessor, if it is larger than
    its successor, takes the next free place of its bucket.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    value = text.astype(np.int16)
    differs = np.sign(np.diff(value, append=-1))  # the end is smaller than all
    at = np.where(differs != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    small = differs[nearest] > 0  # smaller than its successor
    direct = _sorted_directly(text, np.flatnonzero(small), depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        large = waiting[c]
        fresh = np.concatenate(large) if large else np.zeros(0, np.int64)
        scanned = [fresh]
        while len(fresh):  # predecessors with the same byte follow in the same bucket
            before = fresh[fresh > 0] - 1
            fresh = before[text[before] == c]
            scanned.append(fresh)
        scanned.append(direct[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(scanned)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            edges = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            for a, b in zip(edges, np.append(edges[1:], len(before)), strict=True):
                waiting[first[a]].append(before[a:b])
    return np.concatenate(out)


def _sorted_directly(text: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    words = np.concatenate([_eight_bytes(text), np.zeros(depth + 8, np.uint64)])
    order = np.argsort(words[positions], kind="stable")
    positions = positions[order]
    tied = _ties(words[positions])
    group = np.cumsum(~tied[0]) if len(positions) else np.zeros(0, np.int64)
    for offset in range(8, depth, 8):
        open_ = np.flatnonzero(tied[0] | tied[1])
        if not len(open_):
            break
        key = words[positions[open_] + offset]
        order = np.lexsort((key, group[open_]))
        positions[open_] = positions[open_][order]
        key = key[order]
        same = np.zeros(len(open_), bool)
        same[1:] = (key[1:] == key[:-1]) & (group[open_][1:] == group[open_][:-1])
        begins = np.ones(len(positions), bool)
        begins[open_] = ~same
        group = np.cumsum(begins)
        tied = _ties(group)
    return positions


def _ties(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(equal to the one before, equal to the one after)."""
    same = keys[1:] == keys[:-1]
    return np.concatenate([[False], same])[: len(keys)], np.concatenate([same, [False]])[: len(keys)]


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix and the one before it, counted up to ``most`` bytes."""
    words = np.concatenate([_eight_bytes(text), np.zeros(most + 8, np.uint64)])
    out = np.zeros(len(suffixes), np.int64)
    going = np.arange(1, len(suffixes))
    for offset in range(0, most, 8):
        differs = words[suffixes[going] + offset] ^ words[suffixes[going - 1] + offset]
        equal = differs == 0
        ended = going[~equal]
        # leading zero bytes of the difference are equal bytes
        out[ended] = offset + 7 - np.searchsorted(_POWERS, differs[~equal], side="right")
        going = going[equal]
        out[going] = offset + 8
    return np.minimum(out, most)


def repeated_windows(pieces: list[bytes], counts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For pieces in order of place: which of their windows repeat an earlier window.

    Returns one flag per window, piece after piece.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    text = np.frombuffer(b"".join(pieces), np.uint8)
    suffixes = suffix_array(text, length)
    place = np.full(len(text), -1, np.int64)  # number of the window that starts here
    begin = np.repeat(np.cumsum(sizes) - sizes, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place[begin] = np.arange(len(begin))
    ordered = suffixes[place[suffixes] >= 0]
    equal = common_prefixes(text, ordered, length) >= length
    first = np.minimum.reduceat(place[ordered], np.flatnonzero(~equal)) if len(ordered) else place[:0]
    flags = np.zeros(len(begin), bool)
    flags[place[ordered]] = place[ordered] > first[np.cumsum(~equal) - 1]
    return flags


def flagged_runs(flags: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first window, windows) of the runs of set flags within each piece."""
    piece = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(flags)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = flags & ~np.concatenate([[False], flags[:-1] & (piece[1:] == piece[:-1])])
    at = np.flatnonzero(starts)
    run = np.add.reduceat(flags, at, dtype=np.int64) if len(at) else at
    return piece[at], inner[at], run


def _compare(rows: DataFrame) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table, starts, counts, pieces = group_arrays(table)
        piece, inner, run = flagged_runs(repeated_windows(pieces, counts), counts)
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(piece)),
            "start": pa.array((starts[piece] + inner).astype(np.int32)),
            "n": pa.array(run.astype(np.int32)),
        })

    return rows.groupBy("bucket").applyInArrow(run, f"doc_id {kind}, start int, n int")


WINDOWS = Windows(LENGTH, 32, byte_symbols, across=False)


def repeated_bytes(texts: DataFrame, hot_pieces: int | None = None) -> DataFrame:
    """(doc_id, text, runs) with the runs of 100-byte windows that start earlier elsewhere."""
    limit = {} if hot_pieces is None else {"hot_pieces": hot_pieces}
    return with_runs(texts, repeated_runs(texts, WINDOWS, _cut_bytes, _compare, **limit))


def removed_mask(data: bytes, runs) -> np.ndarray:
    if not runs:
        return np.zeros(len(data), bool)
    starts = np.array([r["start"] for r in runs], np.int64)
    counts = np.array([r["n"] for r in runs], np.int64)
    return covered(len(data), starts, counts, LENGTH)


def spans(mask: np.ndarray) -> int:
    return int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())


def dedup_digests(docs: DataFrame, hot_pieces: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    A null text counts as empty; texts under 100 bytes lose nothing. Rows
    without id are neither changed nor compared; repeated ids are one document
    with the smallest text.
    """
    texts = all_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                rows = []
                for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist(), strict=True):
                    data = (text or "").encode()
                    gone = removed_mask(data, runs)
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    rows.append((len(data), int(gone.sum()), spans(gone), hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    out = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeated_bytes(texts, hot_pieces).mapInArrow(run, out)


def with_kept_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row) and ``kept``: the text with repeated bytes removed; bytes of cut characters are dropped.

    ``docs`` has one row per id, and any without id; ``row`` holds other columns,
    so that texts need not be shuffled again to meet them.
    """
    runs = repeated_runs(keyed_texts(docs), WINDOWS, _cut_bytes, _compare)
    shape = T.StructType([*docs.schema.fields, T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                kept = []
                for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist(), strict=True):
                    if text is None or not runs:
                        kept.append(text)
                        continue
                    data = text.encode()
                    left = np.frombuffer(data, np.uint8)[~removed_mask(data, runs)].tobytes()
                    kept.append(left.decode(errors="ignore"))
                columns = [part.column(name) for name in shape.names[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.string())], names=shape.names)

    return with_runs(docs, runs).mapInArrow(run, shape)
