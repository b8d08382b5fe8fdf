"""Queries of this subpackage on a whole small table against plain versions of them."""

import math
import os
import struct
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from conftest import SF_DIR
from tokenizers import Tokenizer

from ledgerlink.llm import byte_bpe, token_counts
from ledgerlink.llm.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
TABLES = SF_DIR.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").toPandas()


def result(spark, name):
    return QUERIES[name](spark, TABLES).toPandas()


def score(doc_id, shard):
    """Weight 1 over the logarithm of a uniform number of the key and the shard."""
    key = xxhash.xxh64_intdigest(str(doc_id).encode(), 42)
    bits = xxhash.xxh64_intdigest(struct.pack("<i", shard), xxhash.xxh64_intdigest(struct.pack("<Q", key), 42))
    return -1 / math.log(((bits >> 11) + 0.5) / (1 << 53))


def test_sharding_of_a_table(spark, table):
    rows = result(spark, "op1_sharding")
    assert sorted(rows.doc_id) == sorted(table.doc_id)
    texts = {i: (t or "").encode() for i, t in zip(table.doc_id, table.text)}
    for r in rows.itertuples():
        scores = [score(r.doc_id, s) for s in range(41)]
        assert (r.size, r.text_crc32, r.law) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]), "key")
        assert r.shard == int(np.argmax(scores[:40])) and r.grown_shard == int(np.argmax(scores))
    for _, slots in rows.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_byte_bpe_of_a_table(spark, table):
    tokens = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ranks = {t: i for i, t in enumerate(tokens)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = result(spark, "op4_byte_bpe").set_index("doc_id")
    assert len(got) == len(table)
    for i, t in zip(table.doc_id, table.text):
        ids = library.encode_ordinary(t or "")
        want = (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t or ""))
        assert tuple(got.loc[i, ["n_tokens", "ids_sha256", "decoded_sha256"]]) == want


def test_token_counts_of_a_table(spark, table):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = result(spark, "op5_token_counts").set_index("doc_id")
    assert len(got) == len(table)
    for i, t in zip(table.doc_id, table.text):
        n = len(library.encode(t or "", add_special_tokens=False))
        assert tuple(got.loc[i, ["n_bytes", "n_tokens", "over_limit"]]) == (len((t or "").encode()), n, n > 512)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_truncation_and_padding_of_a_file_do_not_count(name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    text = "The quick brown fox jumps over the lazy dog. " * 9
    want = len(library.encode(text, add_special_tokens=False))
    library.enable_truncation(8)
    library.enable_padding(length=2000)
    counter = token_counts.TokenCounter(library.to_str().encode(), public_tokenizers.PATTERN)
    assert (counter.count(text), counter.count("")) == (want, 0)


def test_near_vectors_of_a_table(spark):
    rows = spark.read.parquet(f"{TABLES}/embeddings.parquet").toPandas()
    got = result(spark, "op8_embedding_dedup").set_index("vec_id")
    assert len(got) == len(rows)
    seen = 0
    for _, part in rows.groupby("label"):
        fit = part[[v is not None and np.isfinite(v).all() and np.any(v) for v in part.embedding]]
        vectors = np.stack(fit.embedding.to_list()).astype(float)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        linked = vectors @ vectors.T >= 0.98
        np.fill_diagonal(linked, False)
        ids = fit.vec_id.to_numpy()
        component = ids.copy()
        while True:
            least = np.where(linked, component[None, :], component[:, None]).min(axis=1)
            if (least == component).all():
                break
            component = least
        assert (got.loc[ids, "n_links"].to_numpy() == linked.sum(axis=1)).all()
        assert (got.loc[ids, "component_id"].to_numpy() == component).all()
        seen += len(ids)
    assert seen > 0 and (got.kept == (got.component_id == got.index)).all()
