"""Operators over texts against plain versions, on awkward rows and on the small tables."""

import os
import random

import brute
import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR
from tokenizers import Tokenizer

from ledgerlink.llm import (
    byte_bpe,
    decontaminate,
    lz_dedup,
    minhash_dedup,
    quality,
    sharding,
    suffix_dedup,
    token_counts,
)
from ledgerlink.llm.common import components
from ledgerlink.llm.oracles import ORACLES
from ledgerlink.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, runs string, n long, hits string, shard string"
PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(words))


def awkward():
    """Copies, near copies, shared passages, periodic, empty, null, long and odd texts."""
    passage, base = prose(1, 70), prose(2, 120)
    words = base.split()
    texts = [
        base, base, " ".join(words[:60] + ["other"] + words[61:]), base.upper(), "", None, "short", "short", "a b c d",
        "A b\tc d", prose(3, 40) + " " + passage + " " + prose(4, 30), passage, prose(5, 5) + "\n" + passage + prose(6, 3),
        "be " * 90, "be " * 200, "x" * 450, "\x00\x01" * 80, "日本語 " * 60, "   \n\t ", prose(7, 6000), passage + " " + passage,
        "<|endoftext|> a <|endoftext|>", "| | |\n!!\n\n", prose(8, 50) + " " + prose(2, 60),
    ]
    texts += [prose(9, 20) + f" {k} " + passage for k in range(30)]
    return {i * 3: t for i, t in enumerate(texts)}


@pytest.fixture(scope="module")
def texts():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None, "s", None, "r", 1, "h", "x") for i, t in texts.items()]
    rows.append((None, texts[0], "en", None, 3, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame, *columns):
    rows = [(r["doc_id"], tuple(r[c] for c in columns)) for r in frame.collect()]
    assert len({k for k, _ in rows}) == len(rows)
    return dict(rows)


def far_pair(seed):
    """Two texts of similarity 12 / 16; the seeds were picked by the distance of their signatures."""
    rng = random.Random(seed)
    w = [f"w{rng.randrange(10**6)}" for _ in range(20)]
    return " ".join(w[:18]), " ".join(w[:16] + w[18:])


def test_links_of_far_signatures(spark):
    """Pairs at exactly the threshold whose signatures differ in more symbols than are guaranteed."""
    rows = []
    for n, seed in enumerate((10673, 67064, 100808, 100876)):
        a, b = far_pair(seed)
        signs = np.stack([minhash_dedup.signature(minhash_dedup.shingle_set(t)) for t in (a, b)])
        keys = minhash_dedup.index_keys(signs)
        assert (signs[0] != signs[1]).sum() > minhash_dedup.GUARANTEED and np.isin(keys[0], keys[1]).any()
        rows += [(2 * n, a), (2 * n + 1, b)]
    got = by_id(minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "component_id")
    assert got == {i: (i - i % 2,) for i in range(8)}


def test_bucket_counts_never_reject_a_link():
    rng = np.random.default_rng(3)
    for n in (1, 7, 60, 300, 2000, 9000):
        for share in (0.75, 0.8, 0.5):
            union = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            both = int(np.ceil(share * len(union)))
            middle = both + (len(union) - both) // 2
            a, b = union[:middle], np.concatenate([union[:both], union[middle:]])
            most = minhash_dedup.most_common(minhash_dedup.bucket_counts(a), minhash_dedup.bucket_counts(b))
            assert most >= both
            assert not minhash_dedup.linked(np.sort(a), np.sort(b)) or minhash_dedup.may_link(most, len(a), len(b))
    full = np.arange(0, 300 * 4096, 4096, dtype=np.uint64)  # all in one bucket
    assert minhash_dedup.most_common(minhash_dedup.bucket_counts(full), minhash_dedup.bucket_counts(full[:9])) is None


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute.groups({x for p in pairs if p[0] != p[1] for x in p}, pairs)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot_pieces", [None, 1])
def test_suffix_dedup(docs, texts, empty, hot_pieces):
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = by_id(suffix_dedup.dedup_digests(docs, hot_pieces), *columns)
    alone = got.pop(None)
    assert alone == (len(texts[0].encode()), 0, 0, brute.sha(texts[0]))
    assert got == brute.repeated_bytes(texts)
    assert suffix_dedup.dedup_digests(empty).count() == 0


@pytest.mark.parametrize("hot_pieces", [None, 1])
def test_lz_dedup(docs, texts, empty, hot_pieces):
    got = by_id(lz_dedup.dedup_digests(docs, hot_pieces), "n_words", "n_removed", "kept_sha256")
    assert got.pop(None)[1] == 0
    assert got == brute.repeated_words(texts)
    assert lz_dedup.dedup_digests(empty).count() == 0


def test_minhash_dedup(docs, texts, empty):
    got = by_id(minhash_dedup.near_duplicates(docs), "n_shingles", "component_id", "kept")
    assert got.pop(None) == (len(brute.shingles(texts[0])), None, True)
    assert got == brute.near_groups(texts)
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_signature_index_finds_all_pairs_in_reach():
    import numpy as np

    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (200, minhash_dedup.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(minhash_dedup.SYMBOLS, minhash_dedup.GUARANTEED, replace=False)
        row[at] ^= 1
    ka, kb = minhash_dedup.index_keys(a), minhash_dedup.index_keys(b)
    assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist()))


@pytest.mark.parametrize("broadcast_windows", [50_000, 0])
def test_decontamination(spark, docs, texts, empty, broadcast_windows):
    words = texts[0].split()
    items = [
        (1, " ".join(words[20:45])), (2, "A B! c, d"), (3, ""), (4, None), (20, " ".join(words[25:36])), (2, "short"),
        (7, texts[33].upper()), (None, "short"), (8, "日本語 日本語 日本語"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = by_id(decontaminate.contamination(docs, benchmark, broadcast_windows=broadcast_windows), *columns)
    assert got.pop(None)[1:3] == (0, 0)
    assert got == brute.contamination(texts, [x for x in items if x[0] is not None])
    nothing = decontaminate.contamination(docs, benchmark.limit(0))
    assert {r["n_hit"] for r in nothing.collect()} == {0}
    assert decontaminate.contamination(empty, benchmark).count() == 0
    kept = {r["doc_id"] for r in decontaminate.without_contaminated(docs, benchmark).collect()}
    assert kept == {None, *(i for i, v in brute.contamination(texts, [x for x in items if x[0] is not None]).items() if not v[4])}


def test_repeated_ids_are_one_document(spark):
    rows = spark.createDataFrame([(1, "b " * 80), (1, "a " * 80), (1, None), (2, "a " * 80)], "doc_id long, text string")
    got = by_id(suffix_dedup.dedup_digests(rows), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.repeated_bytes({1: "a " * 80, 2: "a " * 80})
    assert by_id(minhash_dedup.near_duplicates(rows), "component_id") == {1: (1,), 2: (1,)}


def test_byte_bpe(docs, texts, empty):
    tokens = byte_bpe.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rows = byte_bpe.encode_documents(docs, PATH, PATTERN).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert r["ids"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    digests = by_id(byte_bpe.encoding_digests(docs, PATH, PATTERN), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, t in texts.items():
        ids = library.encode_ordinary(t or "")
        assert digests[i] == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t or ""))
    assert byte_bpe.encoding_digests(empty, PATH, PATTERN).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_and_their_cache(spark, docs, texts, empty, tmp_path, name):
    path, cache = public_tokenizers.path(name), str(tmp_path / "cache")
    library = Tokenizer.from_file(path)
    want = {i: len(library.encode(t or "", add_special_tokens=False)) for i, t in texts.items()}
    count = lambda rows: token_counts.count_tokens(rows, path, PATTERN, cache)
    got = by_id(count(docs), "n_bytes", "n_tokens", "over_limit")
    got.pop(None)
    assert got == {i: (len((texts[i] or "").encode()), n, n > 512) for i, n in want.items()}
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for t in texts.values()})
    more = docs.unionByName(spark.createDataFrame([(901, "new text")], "doc_id long, text string"), allowMissingColumns=True)
    assert len(by_id(count(more), "n_tokens")) == len(texts) + 2
    assert spark.read.parquet(cache).count() == stored + 1  # only the miss was added
    assert count(empty).count() == 0


def test_sharding(docs, texts, empty, spark):
    rows = sharding.shard_documents(docs, 7).collect()
    assert len(rows) == len(texts) + 1
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 7)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs, 8).collect()}
    assert all(again[r["doc_id"]] == r["grown_shard"] for r in rows)
    assert sharding.shard_documents(empty, 7).count() == 0
    many = spark.range(40_000).withColumnRenamed("id", "doc_id")
    dealt = {r[0]: r[1] for r in sharding.shard_by_key(many, {0: 1.0, 1: 3.0}).groupBy("shard").count().collect()}
    assert 2.8 < dealt[1] / dealt[0] < 3.2
    with pytest.raises(ValueError):
        sharding.shard_by_key(many, {})


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(SF_DIR.replace("sf0.001", "sf0.1") + f"/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs, model).join(labels, "doc_id").where(quality.held_out(labels["doc_id"])).toPandas()
    assert len(rows) > 500 and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.5) == rows.quality).mean() > 0.98


def test_quality_of_awkward_rows(spark, docs, texts, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in texts] + [(0, 1, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == len(texts) + 1 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(empty, quality.train(empty, labels.limit(0))).count() == 0
    assert {r["score"] for r in quality.score_quality(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}


def test_quality_learns_from_all_lines_of_a_text(spark, monkeypatch):
    import numpy as np

    text = "\n".join([f"A good line number {i}." for i in range(250)] + ["## || 00 ||"] * 150)
    docs = spark.createDataFrame([(i, text if i == 1 else "Short text.") for i in range(1, 9)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i > 1)) for i in range(1, 9)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "held_out", lambda doc_id: doc_id < 0)
    monkeypatch.setattr(quality, "fit", lambda features, sizes, counts, labels: seen.append((features, counts)))
    quality.train(docs, labels)
    features, counts = seen[0]
    want, _, _ = quality.document_lines([text])
    assert sorted(counts) == [1] * 7 + [400]
    assert np.array_equal(features[:400], want)


def test_line_marginals_against_enumeration():
    from itertools import product

    import numpy as np

    rng = np.random.default_rng(2)
    scores, transitions, counts = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([3, 0, 4])
    got, pairs = quality.marginals(scores, transitions, counts)
    want, total_pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        weights = {}
        for path in product((0, 1), repeat=int(n)):
            energy = sum((1 if y else -1) * scores[at + k] / 2 for k, y in enumerate(path))
            weights[path] = np.exp(energy + sum(transitions[a, b] for a, b in zip(path, path[1:])))
        z = sum(weights.values())
        want += [sum(w for p, w in weights.items() if p[k]) / z for k in range(n)]
        for p, w in weights.items():
            for a, b in zip(p, p[1:]):
                total_pairs[a, b] += w / z
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, total_pairs)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.sql(f"create view {name.removesuffix('.parquet')} as from '{SF_DIR}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, database, name):
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), database.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    order = lambda f: f[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)


@pytest.mark.parametrize("name, plain, columns", [
    ("op2_suffix_dedup", brute.repeated_bytes, ("n_bytes", "n_removed", "n_spans", "kept_sha256")),
    ("op7_minhash_dedup", brute.near_groups, ("n_shingles", "component_id", "kept")),
    ("op9_lz_dedup", brute.repeated_words, ("n_words", "n_removed", "kept_sha256")),
])
def test_query_equals_brute_force(spark, name, plain, columns):
    table = pd.read_parquet(f"{SF_DIR}/documents.parquet").set_index("doc_id").text.to_dict()
    assert by_id(QUERIES[name](spark, SF_DIR), *columns) == plain(table)
