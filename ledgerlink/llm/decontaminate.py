"""Benchmark decontamination with DataFrame functions only.

The benchmark becomes a set of hashed word windows. If the set is small it
travels inside the plan as a hash set and documents are scanned in one
projection; each hit is then compared with the benchmark's own words. A larger
set is joined to the documents' windows on their hash instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import ascii_lower, keyed_texts, saved

WINDOW = 10
#: Windows above this number are joined, not sent to every task (8 bytes each).
BROADCAST_WINDOWS = 50_000
#: Fixed by the contract: everything that is no ASCII letter or digit, within ASCII.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def contract_words(text: Column) -> Column:
    """Lower-cased words of ``text``; a null text has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), _GAPS)
    return F.filter(parts, lambda w: w != "")


def _windows(hashes: Column, length: int) -> Column:
    """Hash of every ``length`` consecutive words, by first position from 0."""
    last = F.size(hashes) - length
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(hashes, i + 1, length))),
    ).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, length, gram, hash): the distinct windows of every item.

    An item with fewer words than ``window`` is one window; one without words
    has none. Rows that repeat an item_id add up, rows without one are left out.
    """
    words = benchmark.where(F.col("item_id").isNotNull()).select(
        "item_id", contract_words(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    grams = words.select(
        "item_id",
        length.alias("length"),
        F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("gram"),
    )
    return grams.select(
        "item_id",
        "length",
        F.array_join("gram", " ").alias("gram"),
        F.xxhash64(F.transform("gram", lambda w: F.xxhash64(w))).alias("hash"),
    ).distinct()


def _spans(length: int) -> Column:
    """(hash, pos) of every window of ``length`` words."""
    return F.transform(
        _windows(F.col("hashes"), length), lambda h, i: F.struct(h.alias("hash"), i.alias("pos"))
    )


def _with_words(spans: Column, length: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["hash"].alias("hash"), s["pos"].alias("pos"), F.lit(length).alias("length"),
            F.array_join(F.slice("words", s["pos"] + 1, length), " ").alias("gram"),
        ),
    )


def _in_set(spans: Column, hashes: list[int]) -> Column:
    return F.filter(spans, lambda s: s["hash"].isin(hashes))


def _scanned_by_set(words: DataFrame, sets: dict[int, list[int]]) -> DataFrame:
    """(doc_id, n_words, hits) with the hits of ``sets`` looked up inside the projection."""
    found = [_with_words(_in_set(_spans(n), hashes), n) for n, hashes in sorted(sets.items())]
    return words.select("doc_id", F.size("words").alias("n_words"), F.concat(*found).alias("hits"))


def _scanned_by_join(words: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """The same rows by a join of window hashes, for any number of benchmark windows."""
    spans = F.concat(*[_with_words(_spans(n), n) for n in lengths])
    wanted = grams.select("length", "hash").distinct()
    hits = (
        words.select("doc_id", F.explode(spans).alias("w")).select("doc_id", "w.*")
        .join(wanted, ["length", "hash"], "left_semi")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("hash", "pos", "length", "gram")).alias("hits"))
    )
    return words.select("doc_id", F.size("words").alias("n_words")).join(hits, "doc_id", "left")


def _scanned(
    docs: DataFrame, benchmark: DataFrame, window: int, broadcast_windows: int
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words, hits) of every document with the hits by hash, and the benchmark's windows."""
    grams = saved(item_windows(benchmark, window), "grams")
    sizes = {r["length"]: r["n"] for r in grams.groupBy("length").agg(F.countDistinct("hash").alias("n")).collect()}
    words = keyed_texts(docs).select("doc_id", contract_words(F.col("text")).alias("words"))
    hashed = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    if sum(sizes.values()) <= broadcast_windows:
        sets: dict[int, list[int]] = {n: [] for n in sizes or [window]}
        for row in grams.select("length", "hash").distinct().collect():
            sets[row["length"]].append(row["hash"])
        return saved(_scanned_by_set(hashed, sets), "scanned"), grams
    return saved(_scanned_by_join(hashed, grams, sorted(sizes)), "scanned"), grams


def _confirmed(scanned: DataFrame, grams: DataFrame) -> DataFrame:
    """(doc_id, pos, length, gram) of the hits whose words are the benchmark's, however many items hold them."""
    return (
        scanned.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.pos", "h.length", "h.gram")
        .join(grams.select("length", "gram").distinct(), ["length", "gram"], "left_semi")
    )


def _with_positions(scanned: DataFrame, confirmed: DataFrame) -> DataFrame:
    hits = confirmed.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "length")).alias("hits"))
    return scanned.select("doc_id", "n_words").join(hits, "doc_id", "left")


def hit_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """(doc_id, n_words, hits) of every document; hits are (pos, length), null if there are none.

    Every hit of the hash set is compared with the benchmark's words before it
    counts. A document's hits are at most its words times the window's length, as
    no item ids travel with them. Documents without id are left out here; repeated ids
    are one document.
    """
    scanned, grams = _scanned(docs, benchmark, window, broadcast_windows)
    return _with_positions(scanned, _confirmed(scanned, grams))


def hit_items(confirmed: DataFrame, grams: DataFrame) -> DataFrame:
    """(doc_id, item_ids): the sorted ids, as text, of the items that a document holds windows of.

    Windows meet items as rows, each window of a document once; only the
    distinct ids of one document are listed.
    """
    return (
        confirmed.select("doc_id", "length", "gram").distinct()
        .join(grams.select("length", "gram", F.col("item_id").cast("string").alias("item_id")), ["length", "gram"])
        .select("doc_id", "item_id").distinct()
        .groupBy("doc_id").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    )


def covered_positions(hits: Column) -> Column:
    """Distinct word positions inside the hits."""
    return F.array_distinct(
        F.flatten(F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["length"] - 1)))
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words; a document without id is returned as
    uncontaminated, with its words counted. An empty benchmark hits nothing.
    """
    scanned, grams = _scanned(docs, benchmark, window, broadcast_windows)
    confirmed = _confirmed(scanned, grams)
    spans = _with_positions(scanned, confirmed).join(hit_items(confirmed, grams), "doc_id", "left")
    none = F.col("hits").isNull()
    result = spans.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.when(none, 0).otherwise(F.size(covered_positions(F.col("hits")))).cast("long").alias("n_hit"),
        F.when(none, 0).otherwise(F.size("item_ids")).cast("long").alias("n_items"),
        F.sha2(F.when(none, "").otherwise(F.array_join("item_ids", ",")), 256).alias("items_sha256"),
        (~none).alias("contaminated"),
    )
    without_id = docs.where(F.col("doc_id").isNull()).select(
        "doc_id",
        F.size(contract_words(F.col("text"))).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.lit(0).cast("long").alias("n_items"),
        F.sha2(F.lit(""), 256).alias("items_sha256"),
        F.lit(False).alias("contaminated"),
    )
    return result.unionByName(without_id)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, unchanged."""
    dirty = hit_spans(docs, benchmark, **how).where("hits is not null").select("doc_id")
    return docs.join(dirty, "doc_id", "left_anti").select(*docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """(doc_id, text): hit words removed, the rest as normalised words joined by a space.

    Documents without hits keep their text as it is.
    """
    spans = hit_spans(docs, benchmark, **how).select("doc_id", covered_positions(F.col("hits")).alias("gone"))
    kept = F.filter(contract_words(F.col("text")), lambda w, i: ~F.array_contains(F.col("gone"), i))
    return (
        keyed_texts(docs).join(spans, "doc_id")
        .select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, " ")).alias("text"))
    )
