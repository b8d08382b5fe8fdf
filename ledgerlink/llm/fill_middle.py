"""Fill-in-the-middle: a text is cut into prefix, middle and suffix and put in a new order.

Texts are never decoded. The UTF-8 bytes of a batch are viewed as 64-bit words;
arithmetic on whole words marks the bytes that end a unit (a line, or a code
point), ``bitwise_count`` counts the marks of a word and a running sum of these
counts is searched for the word that holds the k-th mark. The mark itself is
found inside that word. One pass without a shuffle; the pieces are put together
by the engine, on bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ONES = np.uint64(0x0101010101010101)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)
_U1, _U3 = np.uint64(1), np.uint64(3)

#: Prefix, suffix and middle sentinels.
SENTINELS = ("<P>", "<S>", "<M>")


def byte_marks(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of each byte of ``words`` that equals ``byte``; no carry crosses bytes."""
    x = words ^ (_ONES * np.uint64(byte))
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def start_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that begins a code point, that is not of the form 10xxxxxx."""
    return ~(words & ~(words << _U1)) & _HIGH


class Marks:
    """Rank and select over marked bytes; positions and ranks are arrays."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many marked bytes lie before position ``at``."""
        word, inside = at >> 3, (at & 7).astype(np.uint64)
        below = (_U1 << (inside << _U3)) - _U1
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The position of the ``k``-th marked byte, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        rest, left = k - self.before[word], self.marks[word]
        for step in range(7):  # drop the lowest mark as often as the rank asks
            left = np.where(rest > step, left & (left - _U1), left)
        lowest = left & (~left + _U1)
        return (word << 3) + (np.bitwise_count(lowest - _U1) >> 3)


def cut_texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, draws: list[np.ndarray], unit: str):
    """(units, end of prefix, end of middle, code points of both) of each text of a batch.

    ``data`` holds the bytes of all texts, text i from ``starts[i]`` to
    ``ends[i]``. Cuts are the draws modulo (units + 1); positions are relative
    to the text.
    """
    words = np.zeros((len(data) >> 3) + 1, np.uint64)  # also holds the position after the last byte
    words.view(np.uint8)[: len(data)] = data
    codes = Marks(start_marks(words))
    sizes = ends - starts
    if unit == "char":
        n = codes.rank(ends) - codes.rank(starts)
    else:
        lines = Marks(byte_marks(words, 0x0A))
        first = lines.rank(starts)
        n = lines.rank(ends) - first
        full = n.copy()  # lines that a line feed ends
        n += (sizes > 0) & (words.view(np.uint8)[np.maximum(ends - 1, 0)] != 0x0A)
    drawn = [(d % (n + 1).astype(np.uint64)).astype(np.int64) for d in draws]
    cuts = []
    for k in (np.minimum(*drawn), np.maximum(*drawn)):
        if unit == "char":
            inner = (k > 0) & (k < n)  # the cut lies before the first byte of code point k
            at = np.where(k == n, sizes, 0)
            at[inner] = codes.select((codes.rank(starts) + k)[inner]) - starts[inner]
        else:
            inner = (k > 0) & (k <= full)  # the cut lies after the k-th line feed
            at = np.where(k > full, sizes, 0)
            at[inner] = lines.select((first + k - 1)[inner]) + 1 - starts[inner]
        cuts.append(at)
    low, high = (starts + at for at in cuts)
    heads = codes.rank(low) - codes.rank(starts)
    middles = codes.rank(high) - codes.rank(low)
    return n, cuts[0], cuts[1], heads, middles


def _cutter(unit: str):
    @F.arrow_udf("struct<n:bigint,low:bigint,high:bigint,prefix_chars:bigint,middle_chars:bigint>")
    def cut(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        text = text.cast(pa.large_binary())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        begin, stop = (int(ends[0]), int(ends[-1])) if len(text) else (0, 0)
        held = text.buffers()[2]
        data = np.frombuffer(held, np.uint8)[begin:stop] if held is not None else np.zeros(0, np.uint8)
        draws = [h.to_numpy(zero_copy_only=False).astype(np.uint64) for h in (h1, h2)]
        found = cut_texts(data, ends[:-1] - begin, ends[1:] - begin, draws, unit)
        names = ["n", "low", "high", "prefix_chars", "middle_chars"]
        return pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in found], names)

    return cut


def _check(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must be found again without doubt: none holds or overlaps another."""
    for a in sentinels:
        for b in sentinels:
            overlap = any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b)))
            if not a or (a != b and a in b) or overlap:
                raise ValueError("sentinels must not be empty, equal or overlap one another")
    if len(set(sentinels)) < 3:
        raise ValueError("sentinels must differ")


def draws(key: Column, seed: int = 7, n: int = 4) -> list[Column]:
    """Independent unsigned 32-bit draws of a key: 8-digit groups of sha256('seed:key')."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(n)]


def fill_in_middle(
    docs: DataFrame,
    unit: str = "line",
    share: int = 100,
    spm_share: int = 50,
    seed: int = 7,
    sentinels: tuple[str, str, str] = SENTINELS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``unit`` is ``line`` (a line feed ends one, the last may lack it) or
    ``char`` (a code point); n counts them. ``share`` per cent of the texts are
    turned, ``spm_share`` per cent of these with the suffix first (spm), the
    others with the prefix first (psm). The rest is ``plain``, as are empty
    texts and those that hold a sentinel; ``output`` is then the text itself and
    the lengths are null. A null text is empty. The draws depend on the key
    alone, so rows with equal keys (all null keys are equal) get equal draws.
    Repeated rows give repeated results; other columns are ignored; an empty
    table gives an empty result.
    """
    if unit not in ("line", "char"):
        raise ValueError("unit must be line or char")
    _check(sentinels)
    p, s, m = (F.lit(mark.encode()) for mark in sentinels)
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))
    h1, h2, h3, h4 = draws(F.col(key), seed)
    held = F.lit(False)
    for mark in (p, s, m):
        held = held | F.contains("bytes", mark)
    form = (
        F.when((F.octet_length("bytes") == 0) | held | (h3 % 100 >= share), "plain")
        .when(h4 % 100 < spm_share, "spm").otherwise("psm")
    )
    cut = rows.withColumn("cut", _cutter(unit)("bytes", h1, h2)).withColumn("form", form)

    def piece(start: Column, end: Column) -> Column:
        return F.substring("bytes", (start + 1).cast("int"), (end - start).cast("int"))

    low, high = F.col("cut.low"), F.col("cut.high")
    prefix, middle = piece(F.lit(0), low), piece(low, high)
    suffix = piece(high, F.octet_length("bytes").cast("bigint"))
    output = (
        F.when(F.col("form") == "plain", F.col("bytes"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
    )
    turned = F.col("form") != "plain"
    return cut.select(
        key, F.col("cut.n").alias("n"), "form",
        F.when(turned, F.col("cut.prefix_chars")).alias("prefix_chars"),
        F.when(turned, F.col("cut.middle_chars")).alias("middle_chars"),
        output.cast("string").alias("output"),
    )


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made of, from output and form alone."""
    p, s, m = sentinels

    def between(after: str, before: str | None) -> Column:
        head = output if before is None else F.substring_index(output, before, 1)
        return F.substring_index(head, after, -1)

    return (
        F.when(form == "psm", F.concat(between(p, s), between(m, None), between(s, m)))
        .when(form == "spm", F.concat(between(p, m), between(m, None), between(s, p)))
        .otherwise(output)
    )


def fim_digests(docs: DataFrame) -> DataFrame:
    """The line form of every document with digests of its output and of the text rebuilt from it.

    One row per input row: doc_id, n, form, prefix_chars, middle_chars,
    output_sha256, restored_sha256. Nulls, empty texts, repeated rows and empty
    tables as in :func:`fill_in_middle`.
    """
    made = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
