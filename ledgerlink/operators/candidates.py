"""Candidate stage: the best plausible statement rows of each ledger row.

A pair is plausible when the names share a token or the amounts lie within the
band. Both conditions run as equality joins (on the token, and on amount
buckets of one band width). Groups too large to pair directly go through
``nearest_in_groups``, which finds the same best rows without listing pairs; the
amount band goes through ``nearest_in_runs`` as a whole. Also groups of middle size
are searched when together they have many pairs a row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.config import AMOUNT_BAND, ReconConfig
from ledgerlink.functions.scoring import (
    MONEY_UNITS,
    candidate_score,
    date_gap,
    from_units,
    gross_amount,
    in_units,
    name_part,
    settled_amount,
)
from ledgerlink.functions.text import name_tokens
from ledgerlink.operators.nearest import nearest_in_groups, nearest_in_runs
from ledgerlink.schemas import MONEY
from ledgerlink.session import cut_lineage

# Kinds of join keys.
TOKEN, BAND = "t", "b"


def ledger_features(ledger: DataFrame, config: ReconConfig) -> DataFrame:
    """What matching needs of a ledger row; rows without id or amount drop out.

    Amounts are whole numbers of money units and records are known by their
    order, so that pairs stay a few numbers wide.
    """
    return ledger.where(F.col("erp_id").isNotNull() & F.col("amount").isNotNull()).select(
        "run_id",
        F.col("row_ord").alias("erp_ord"),
        name_tokens(F.col("merchant_name"), config.fold_case).alias("erp_tokens"),
        in_units(gross_amount(F.col("amount"), F.col("tax_line_item"))).alias("gross"),
        "date",
    )


def statement_features(statement: DataFrame, config: ReconConfig) -> DataFrame:
    """What matching needs of a statement row.

    Rows alike in tokens, amount and date score alike against every ledger row,
    so only the first few of them by file order can be among the best.
    """
    rows = statement.where(
        F.col("bank_ref").isNotNull() & F.col("net_amount").isNotNull()
    ).select(
        "run_id",
        F.col("row_ord").alias("bank_ord"),
        name_tokens(F.col("description"), config.fold_case).alias("bank_tokens"),
        in_units(settled_amount(F.col("net_amount"), F.col("fee_deducted"))).alias("settled"),
        "settlement_date",
    )
    alike = Window.partitionBy(
        "run_id", "bank_tokens", "settled", "settlement_date"
    ).orderBy("bank_ord")
    return (
        rows.withColumn("copy", F.row_number().over(alike))
        .where(F.col("copy") <= config.max_candidates)
        .drop("copy")
    )


_BAND_UNITS = int(AMOUNT_BAND * MONEY_UNITS)
#: Pairs that may be listed for every key of a ledger row, or as many as so many groups of ``hot_group_rows`` have.
#: A row has three keys of the band, and its search asks once for all of them.
_PAIRS_A_ROW, _FEW_LARGE_GROUPS = {TOKEN: 32, BAND: 8}, 20


def _bucket(units: str) -> Column:
    """Number of the band-wide bucket that holds the amount."""
    return F.expr(f"({units} - pmod({units}, {_BAND_UNITS}L)) div {_BAND_UNITS}L")


def _keyed(
    rows: DataFrame, tokens: str, amount: str, reach: int, ways: tuple[str, ...]
) -> DataFrame:
    """One row per join key: the row's name tokens and its amount buckets.

    Keys begin with their kind, so that a single join serves both.
    """
    keys = []
    if TOKEN in ways:
        keys.append(F.transform(tokens, lambda word: F.concat(F.lit(TOKEN), word)))
    if BAND in ways:
        near = [_bucket(amount) + step for step in range(-reach, reach + 1)]
        keys.append(F.array(*[F.concat(F.lit(BAND), b.cast("string")) for b in near]))
    return rows.select("*", F.explode(F.concat(*keys)).alias("key"))


def _group_sizes(erp_keys: DataFrame, bank_keys: DataFrame) -> DataFrame:
    """(run_id, key, n, n_erp): rows of either side, of the keys that both sides have."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("run_id", "key").agg(F.count("*").alias(name))

    return counted(erp_keys, "n_erp").join(counted(bank_keys, "n"), ["run_id", "key"])


def _hot_groups(erp_keys: DataFrame, bank_keys: DataFrame, limit: int) -> DataFrame:
    """Keys whose pairing would explode.

    What a ledger row meets is the statement's group, so that side must be
    large; and there must be more pairs than a group of ``limit`` rows on either
    side has, or searching would cost more than pairing. If what then is left to
    pair is more than :data:`_PAIRS_A_ROW` of its kind in all, the larger of these
    groups are searched as well, by powers of two of their statement rows.
    """
    sizes = cut_lineage(_group_sizes(erp_keys, bank_keys))
    pairs = F.col("n").cast("double") * F.col("n_erp")
    hot = (F.col("n") > limit) & (pairs > float(limit) * limit)
    kind = F.substring("key", 1, 1)
    size = F.ceil(F.log2("n")).cast("int")
    classes = sizes.where(~hot).groupBy(kind.alias("kind"), size.alias("size")).agg(
        F.sum(pairs).alias("pairs"), F.sum("n_erp").alias("rows")
    ).collect()  # at most 64 a kind
    for name in {c.kind for c in classes}:
        own = sorted((c for c in classes if c.kind == name), key=lambda c: c.size)
        left = max(_PAIRS_A_ROW[name] * sum(c.rows for c in own), _FEW_LARGE_GROUPS * limit * limit)
        for c in own:
            left -= c.pairs
            if left < 0:
                hot = hot | ((kind == name) & (size >= c.size))
                break
    return sizes.where(hot).select("run_id", "key")


def _in_band() -> Column:
    return F.abs(F.col("gross") - F.col("settled")) <= _BAND_UNITS


def score_pairs(pairs: DataFrame, *kept: str) -> DataFrame:
    """Add overlap, delta_units, days and score to ledger/statement feature pairs; other columns only if ``kept``."""
    return (
        pairs.withColumn("overlap", F.size(F.array_intersect("erp_tokens", "bank_tokens")))
        .withColumn("delta_units", F.abs(F.col("gross") - F.col("settled")))
        .withColumn("days", date_gap(F.col("date"), F.col("settlement_date")))
        .select(
            *kept,
            "run_id",
            "erp_ord",
            "bank_ord",
            "overlap",
            "delta_units",
            "days",
            _score(F.size("erp_tokens")).alias("score"),
        )
    )


def _score(n_tokens: Column) -> Column:
    return candidate_score(F.col("overlap"), n_tokens, from_units(F.col("delta_units")), F.col("days"))


def rank_pairs(scored: DataFrame, k: int) -> DataFrame:
    """The k best pairs per ledger row; ties keep the statement's file order.

    A pair may arrive by several keys, with the same score. Ranks are dense,
    so that repeated pairs share one, and repeats are adjacent in rank order.
    """
    best_first = Window.partitionBy("run_id", "erp_ord").orderBy(
        F.col("score").desc(), F.col("bank_ord")
    )
    before = F.lag("bank_ord").over(best_first)
    return (
        scored.withColumn("rank", F.dense_rank().over(best_first))
        .where(F.col("rank") <= k)
        .withColumn("before", before)
        .where(F.col("before").isNull() | (F.col("before") != F.col("bank_ord")))
        .withColumn(
            "amount_delta",
            (F.col("delta_units").cast("decimal(18,0)") * F.expr("0.0001BD")).cast(MONEY),
        )
        .drop("before", "delta_units")
    )


def plausible_pairs(
    erp: DataFrame,
    bank: DataFrame,
    config: ReconConfig,
    ways: tuple[str, ...] = (TOKEN, BAND),
) -> DataFrame:
    """Scored plausible pairs: among them the best ones of each ledger row.

    ``ways`` picks what makes a pair plausible: a shared token, the amount band.
    """
    erp_keys = _keyed(erp, "erp_tokens", "gross", 1, ways)
    bank_keys = _keyed(bank, "bank_tokens", "settled", 0, ways)
    hot = cut_lineage(_hot_groups(erp_keys, bank_keys, config.hot_group_rows))
    kinds = {row.kind for row in hot.select(F.substring("key", 1, 1).alias("kind")).distinct().collect()}
    if not kinds:
        return score_pairs(_paired(erp_keys, bank_keys))
    if BAND not in kinds:
        return _paired_or_searched(erp, bank, erp_keys, bank_keys, hot, config).drop("n_tokens")
    near = _nearest_in_band(erp_keys, bank_keys, hot, erp, bank, config)
    erp_keys = _keyed(erp, "erp_tokens", "gross", 1, (TOKEN,))
    bank_keys = _keyed(bank, "bank_tokens", "settled", 0, (TOKEN,))
    band = None
    if TOKEN not in ways:  # pairs that share a token count here too, if they lie in the band
        hot, band = cut_lineage(_hot_groups(erp_keys, bank_keys, config.hot_group_rows)), AMOUNT_BAND
    named = _paired_or_searched(erp, bank, erp_keys, bank_keys, hot, config, band)
    return _best_scored(named.unionByName(near))


def _paired_or_searched(
    erp: DataFrame,
    bank: DataFrame,
    erp_keys: DataFrame,
    bank_keys: DataFrame,
    hot: DataFrame,
    config: ReconConfig,
    band: Decimal | None = None,
) -> DataFrame:
    """Scored pairs by key, the best of every key; with ``band`` only those within it."""
    near = F.lit(True) if band is None else _in_band()
    rest = _paired(erp_keys.join(hot, ["run_id", "key"], "left_anti"), bank_keys).where(near)
    rest = _best_of_keys(rest, config.max_candidates)
    if hot.where(F.col("key").startswith(TOKEN)).isEmpty():
        return rest
    searched = _nearest_by_tokens(erp, bank, erp_keys, bank_keys, hot, config, band).where(near)
    return rest.unionByName(score_pairs(_with_size(searched), "n_tokens"))


def _with_size(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("n_tokens", F.size("erp_tokens"))


def _best_of_keys(pairs: DataFrame, k: int) -> DataFrame:
    """Scored pairs, of each ledger row the k best of every key: its k best of all are among them.

    The pairs of a key already lie together, so nothing is shuffled for it.
    """
    best_first = Window.partitionBy("run_id", "key", "erp_ord").orderBy(F.col("score").desc(), F.col("bank_ord"))
    scored = score_pairs(_with_size(pairs), "n_tokens", "key").withColumn("place", F.dense_rank().over(best_first))
    return scored.where(F.col("place") <= k).drop("place", "key")


def _best_scored(pairs: DataFrame) -> DataFrame:
    """Each pair once, with its higher score: the search by amount leaves names out.

    Pairs of one ledger row meet in one shuffle, which the ranking needs as well.
    Scores, the widest column in the files, are left out and computed again behind it.
    """
    together = pairs.drop("score").repartition("run_id", "erp_ord").withColumn("score", _score(F.col("n_tokens")))
    best = F.max(F.struct("score", "overlap", "delta_units", "days")).alias("best")
    return together.groupBy("run_id", "erp_ord", "bank_ord").agg(best).select(
        "run_id", "erp_ord", "bank_ord", "best.overlap", "best.delta_units", "best.days", "best.score"
    )


def _paired(erp_keys: DataFrame, bank_keys: DataFrame) -> DataFrame:
    """Plausible pairs of rows with a common key; a pair may have several."""
    by_token = F.col("key").startswith(TOKEN)
    return erp_keys.join(bank_keys, ["run_id", "key"]).where(by_token | _in_band())


def _hot_names(keys: DataFrame, hot: DataFrame, row: str) -> DataFrame:
    """(run_id, row, name): the hot tokens of each row that has any, each once and in order, as one text."""
    tokens = hot.where(F.col("key").startswith(TOKEN))
    return keys.join(tokens, ["run_id", "key"], "left_semi").groupBy("run_id", row).agg(
        F.array_join(F.sort_array(F.collect_set("key")), " ").alias("name")
    )


def _shared_tokens(erp_names: DataFrame, bank_names: DataFrame) -> DataFrame:
    """(run_id, name, grp, shared): how many hot tokens a ledger and a statement name have in common.

    Only the distinct names that occur meet, through their tokens.
    """
    word = F.explode(F.split("name", " ")).alias("word")
    left = erp_names.select("run_id", "name").distinct().select("run_id", "name", word)
    right = bank_names.select("run_id", "name").distinct().select("run_id", F.col("name").alias("grp"), word)
    return left.join(right, ["run_id", "word"]).groupBy("run_id", "name", "grp").agg(
        F.count(F.lit(1)).alias("shared")
    )


def _nearest_by_tokens(
    erp: DataFrame,
    bank: DataFrame,
    erp_keys: DataFrame,
    bank_keys: DataFrame,
    hot: DataFrame,
    config: ReconConfig,
    max_delta: Decimal | None = None,
) -> DataFrame:
    """Search the statement rows of each hot name, a set of hot tokens, as one group.

    Rows of one hot name share equally many hot tokens with a ledger row. Any
    number of hot tokens may meet: only sets that occur are groups, those that
    share most are searched first and bound the others. Rows that share a
    further, rarer token are paired by it, and score at least what they are
    searched with.
    """
    erp_names = cut_lineage(_hot_names(erp_keys, hot, "erp_ord"))
    bank_names = cut_lineage(_hot_names(bank_keys, hot, "bank_ord"))
    queries = (
        erp.join(erp_names, ["run_id", "erp_ord"])
        .join(_shared_tokens(erp_names, bank_names), ["run_id", "name"])
        .select(
            "run_id", "grp", "erp_ord", name_part(F.col("shared"), F.size("erp_tokens")).alias("base"), "gross", "date"
        )
    )
    members = bank.join(bank_names, ["run_id", "bank_ord"]).select(
        "run_id", F.col("name").alias("grp"), "bank_ord", "settled", "settlement_date"
    )
    near = nearest_in_groups(queries, members, config.max_candidates, max_delta)
    return _with_features(near, erp, bank)


def _nearest_in_band(
    erp_keys: DataFrame,
    bank_keys: DataFrame,
    hot: DataFrame,
    erp: DataFrame,
    bank: DataFrame,
    config: ReconConfig,
) -> DataFrame:
    """Scored pairs within the band, names left out: the best of each ledger row, whatever its bucket.

    A pair whose names share a token scores more than here. It cannot push out
    another one that belongs to the best, as it belongs before that one anyway.
    """
    near = nearest_in_runs(
        erp.select("run_id", "erp_ord", "gross", "date"),
        bank.select("run_id", "bank_ord", "settled", "settlement_date"),
        config.max_candidates, AMOUNT_BAND,
    )
    return near.select(
        "run_id", "erp_ord", "bank_ord", F.lit(0).alias("overlap"), F.lit(0).alias("n_tokens"), "delta_units", "days"
    ).withColumn("score", _score(F.col("n_tokens")))


def _with_features(pairs: DataFrame, erp: DataFrame, bank: DataFrame) -> DataFrame:
    return (
        pairs.select("run_id", "erp_ord", "bank_ord")
        .distinct()
        .join(erp, ["run_id", "erp_ord"])
        .join(bank, ["run_id", "bank_ord"])
    )


def top_candidates(
    ledger: DataFrame, statement: DataFrame, config: ReconConfig | None = None
) -> DataFrame:
    """The best plausible statement rows of each ledger row, ranked.

    The features of both sides are written once: the sizes of the groups are
    counted on them before the pairs are formed.
    """
    config = config or ReconConfig()
    erp = cut_lineage(ledger_features(ledger, config))
    bank = cut_lineage(statement_features(statement, config))
    return rank_pairs(plausible_pairs(erp, bank, config), config.max_candidates)
