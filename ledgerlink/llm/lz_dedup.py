"""Removal of repeated word passages by relative Lempel-Ziv parsing.

A reference block holds the word pieces of all documents that share its anchors
(see :mod:`ledgerlink.llm.anchors`), indexed by a suffix array. Every piece is
parsed greedily against the part of its block that belongs to earlier
documents: each factor is the longest run of words that occurs there. Factors of
50 words and more are duplicate spans, and windows across a factor boundary are
checked one by one. Any passage an earlier document shares lies in a block that
both are routed to, so this equals parsing against every block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ledgerlink.llm.anchors import Windows, all_texts, covered, group_arrays, repeated_runs, with_runs
from ledgerlink.llm.byte_bpe import REMEMBERED, small_batches
from ledgerlink.llm.suffix_dedup import flagged_runs

LENGTH = 50
_known: dict[bytes, int] = {}


def split_words(text: str) -> list[bytes]:
    """Words between spaces and the control characters 9 to 13."""
    return text.encode().split()


def word_hashes(words: list[bytes]) -> list[int]:
    if len(_known) > REMEMBERED:
        _known.clear()
    for w in set(words).difference(_known):
        _known[w] = xxhash.xxh3_64_intdigest(w)
    return list(map(_known.__getitem__, words))


def word_symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    split = [split_words(t) for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    return np.array([h for s in split for h in word_hashes(s)], np.uint64), counts


def _cut_words(texts: list[str], which: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    hashed: dict[int, bytes] = {}
    out = []
    for w, a, n in zip(which.tolist(), starts.tolist(), sizes.tolist(), strict=True):
        if w not in hashed:
            hashed[w] = np.array(word_hashes(split_words(texts[w])), "<u8").tobytes()
        out.append(hashed[w][8 * a : 8 * (a + n)])
    return out


def block_index(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(suffixes in order, common prefix with the one before, ranks by doubled length) of a block.

    ``ends`` are the positions after the pieces; runs never match across them.
    """
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)  # words to the piece's end
    levels, size = [rank], 1
    while size < left.max(initial=0):
        follow = np.full(n, -1, np.int64)
        has = left > size
        follow[has] = rank[np.flatnonzero(has) + size]
        short = np.where(has, 0, np.minimum(left, size))
        # a run cut short by the end sorts before longer ones
        key = np.where(has, follow + size + 1, short - size)
        order = np.lexsort((key, rank))
        new = np.ones(n, bool)
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        levels.append(rank)
        size *= 2
    suffixes = np.lexsort((np.arange(n), rank))
    common = np.zeros(n, np.int64)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    limit = np.minimum(left[a], left[b]) if n > 1 else np.zeros(0, np.int64)
    got = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        fits = got + step <= limit
        at = np.flatnonzero(fits)
        same = levels[level][a[at] + got[at]] == levels[level][b[at] + got[at]]
        got[at[same]] += step
    # a step may fit again at the lowest level after a refusal higher up
    common[1:] = got
    return suffixes, common, levels


def longest_earlier(suffixes: np.ndarray, common: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each position, the longest match with a position of a smaller ``owner``.

    The best partners are the nearest suffixes of a smaller owner on either
    side; both are found by binary lifting over minima of owners and prefixes.
    """
    n = len(suffixes)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    for turned in (False, True):
        own = owner[suffixes][::-1] if turned else owner[suffixes]
        # gap[i]: common prefix of neighbours i - 1 and i in this direction
        gap = np.concatenate([[0], common[1:][::-1]]) if turned else common
        owners, gaps = [own], [gap]
        while 1 << len(owners) <= n:
            half = 1 << (len(owners) - 1)
            low, cut = owners[-1].copy(), gaps[-1].copy()
            low[half:] = np.minimum(low[half:], owners[-1][:-half])
            cut[half:] = np.minimum(cut[half:], gaps[-1][:-half])
            owners.append(low)
            gaps.append(cut)
        at = np.arange(n)  # entries at .. i are no partners
        reach = np.full(n, np.iinfo(np.int64).max)
        for level in range(len(owners) - 1, -1, -1):
            step = 1 << level
            fits = np.flatnonzero(at >= step)
            skip = fits[owners[level][at[fits] - 1] >= own[fits]]
            reach[skip] = np.minimum(reach[skip], gaps[level][at[skip]])
            at[skip] -= step
        reach = np.where(at > 0, np.minimum(reach, gap[at]), 0)
        reach = reach[::-1] if turned else reach
        out[suffixes] = np.maximum(out[suffixes], reach)
    return out


def greedy_factors(longest: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the factors of all pieces, parsed side by side; unmatched words count one."""
    at = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    stop = ends.astype(np.int64)
    starts, lengths = [], []
    while True:
        open_ = at < stop
        at, stop = at[open_], stop[open_]
        if not len(at):
            break
        step = np.maximum(1, longest[at])
        starts.append(at)
        lengths.append(step)
        at = at + step
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(lengths)


def duplicate_starts(pieces: list[np.ndarray], owner: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Flags by position of all pieces: does the window that starts here come in a smaller owner?"""
    words = np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    suffixes, common, _ = block_index(words, ends)
    longest = longest_earlier(suffixes, common, np.repeat(owner, sizes))
    start, factor = greedy_factors(longest, ends)
    change = np.zeros(len(words) + 1, np.int64)
    long = factor >= length
    np.add.at(change, start[long], 1)
    np.add.at(change, start[long] + factor[long] - length + 1, -1)
    flags = np.cumsum(change[:-1]) > 0
    # windows that start within a factor and go beyond its end
    across = np.zeros(len(words) + 1, np.int64)
    np.add.at(across, np.maximum(start, start + factor - length + 1), 1)
    np.add.at(across, start + factor, -1)
    return flags | ((np.cumsum(across[:-1]) > 0) & (longest >= length))


def _compare(rows: DataFrame) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table, starts, counts, packed = group_arrays(table)
        ids = table.column("doc_id").to_pylist()
        owner = np.cumsum([i > 0 and ids[i] != ids[i - 1] for i in range(len(ids))]).astype(np.int64)
        pieces = [np.frombuffer(p, "<u8") for p in packed]
        flags = duplicate_starts(pieces, owner)
        sizes = np.array([len(p) for p in pieces], np.int64)
        inner = np.arange(len(flags)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = flags[inner < np.repeat(counts, sizes)]  # windows of another anchor are judged there
        piece, first, run = flagged_runs(own, counts)
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(piece)),
            "start": pa.array((starts[piece] + first).astype(np.int32)),
            "n": pa.array(run.astype(np.int32)),
        })

    return rows.groupBy("bucket").applyInArrow(run, f"doc_id {kind}, start int, n int")


#: Finding longest matches takes some 400 bytes a word, hence smaller buckets than for bytes.
WINDOWS = Windows(LENGTH, 8, word_symbols, across=True, bucket_symbols=1 << 17)


def repeated_words(texts: DataFrame, hot_pieces: int | None = None) -> DataFrame:
    """(doc_id, text, runs) with the runs of 50-word windows that an earlier document has."""
    limit = {} if hot_pieces is None else {"hot_pieces": hot_pieces}
    return with_runs(texts, repeated_runs(texts, WINDOWS, _cut_words, _compare, **limit))


def dedup_digests(docs: DataFrame, hot_pieces: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document.

    A null text has no words; texts under 50 words lose nothing. Rows without
    id are neither changed nor compared; repeated ids are one document with the
    smallest text.
    """
    texts = all_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                rows = []
                for text, runs in zip(part.column("text").to_pylist(), part.column("runs").to_pylist(), strict=True):
                    words = split_words(text or "")
                    gone = removed_mask(len(words), runs)
                    kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                    rows.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*rows, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:2]], pa.array(columns[2], pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    out = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    return repeated_words(texts, hot_pieces).mapInArrow(run, out)


def removed_mask(size: int, runs) -> np.ndarray:
    if not runs:
        return np.zeros(size, bool)
    starts = np.array([r["start"] for r in runs], np.int64)
    counts = np.array([r["n"] for r in runs], np.int64)
    return covered(size, starts, counts, LENGTH)
