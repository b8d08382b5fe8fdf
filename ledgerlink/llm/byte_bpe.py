"""Byte-level BPE through a sentencepiece model built straight from the vocabulary.

A rank file is the whole model: each token's bytes are written with one
printable character per byte, and its score is the negative rank, so that the
best merge is the one of lowest rank. The protobuf message is serialised here,
nothing is trained, and normalisation is the identity. Pre-tokens are encoded
one by one; decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens remembered by a worker; beyond it the memory starts anew.
REMEMBERED = 60_000
#: A larger vocabulary file is refused, as its model goes to every executor.
LARGEST_FILE = 64 << 20
_BATCH_BYTES = 4 << 20


def byte_alphabet() -> list[str]:
    """One printable character per byte: itself if printable Latin-1, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(plain))
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in rank order."""
    with open(path, "rb") as file:
        data = file.read(LARGEST_FILE + 1)
    if len(data) > LARGEST_FILE:
        raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    ranks = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, data.splitlines()))
    if [r for r, _ in ranks] != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in ranks]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: an integer, a 32-bit float or a length-delimited value."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The serialised model: every token a piece whose id is its rank, then <unk>.

    Field numbers are those of the public sentencepiece_model.proto.
    """
    letters = byte_alphabet()
    normal, unknown, bpe = 1, 2, 2
    pieces = [
        _field(1, _field(1, "".join(letters[b] for b in t).encode()) + _field(2, float(-rank)) + _field(3, normal))
        for rank, t in enumerate(tokens)
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder of whole texts over a model of :func:`sentencepiece_model`."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        self._letters = {b: letter for b, letter in enumerate(byte_alphabet())}
        self._tokens = tokens
        self._ids = {t: i for i, t in enumerate(tokens)}
        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._split = regex.compile(pattern).findall
        self._known: dict[str, tuple[int, ...]] = {}

    def _pieces(self, pre_tokens: Iterable[str]) -> None:
        """Encode pre-tokens that are not remembered yet."""
        new = list(pre_tokens)
        mapped = []
        for token in new:
            raw = token.encode()
            if raw in self._ids:  # a whole token is its own id, as in the rank rule
                self._known[token] = (self._ids[raw],)
            else:
                mapped.append((token, raw.decode("latin-1").translate(self._letters)))
        if mapped:
            found = self._model.encode([m for _, m in mapped], out_type=int, num_threads=1)
            for (token, _), ids in zip(mapped, found, strict=True):
                self._known[token] = tuple(ids)

    def encode(self, text: str) -> list[int]:
        tokens = self._split(text)
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known = self._known
        new = set(tokens).difference(known)
        if new:
            self._pieces(new)
        return list(chain.from_iterable(map(known.__getitem__, tokens)))

    def decode(self, ids: Iterable[int]) -> bytes:
        tokens = self._tokens
        return b"".join(map(tokens.__getitem__, ids))


_workers: dict[str, ByteBpe] = {}


def _worker(digest: str, tokens: list[bytes], model: bytes, pattern: str) -> ByteBpe:
    """The encoder of this Python process, built once."""
    if digest not in _workers:
        _workers.clear()
        _workers[digest] = ByteBpe(tokens, model, pattern)
    return _workers[digest]


def _coder(spark, path: str, pattern: str):
    tokens = read_ranks(path)
    model = sentencepiece_model(tokens)
    digest = hashlib.sha256(model + pattern.encode()).hexdigest()
    return spark.sparkContext.broadcast((digest, tokens, model, pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of token ids) and ``decoded`` (bytes), replacing such columns.

    A null text counts as empty; an empty text has no ids. One row per input row.
    """
    return _mapped(docs, path, pattern, text, {"ids": "array<int>", "decoded": "binary"}, _full)


def encoding_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per input row.

    Digests are made where the text is encoded, so ids never leave the task.
    """
    kinds = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return _mapped(docs.select("doc_id", "text"), path, pattern, "text", kinds, _digests).select("doc_id", *kinds)


def _full(coder: ByteBpe, texts: list[str | None]) -> list[list]:
    ids = [coder.encode(t or "") for t in texts]
    return [ids, [coder.decode(i) for i in ids]]


def _digests(coder: ByteBpe, texts: list[str | None]) -> list[list]:
    n, of_ids, of_bytes = [], [], []
    for t in texts:
        ids = coder.encode(t or "")
        n.append(len(ids))
        of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        of_bytes.append(hashlib.sha256(coder.decode(ids)).hexdigest())
    return [n, of_ids, of_bytes]


def _mapped(docs: DataFrame, path: str, pattern: str, text: str, kinds: dict[str, str], work) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = docs.select(*[c for c in docs.columns if c not in kinds])
    shape = kept.select("*", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()]).schema
    arrow, names = to_arrow_schema(shape), kept.columns
    shared = _coder(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker(*shared.value)
        for batch in batches:
            for part in small_batches(batch, text):
                new = work(coder, part.column(text).to_pylist())
                columns = [part.column(c) for c in names]
                columns += [pa.array(v, arrow.field(c).type) for c, v in zip(kinds, new, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return kept.mapInArrow(run, shape)


def small_batches(batch: pa.RecordBatch, text: str, most: int = _BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``most`` bytes of text each, or a single row."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)
