"""Exact stage: an identifier in the statement text plus an equal amount."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.text import ID_CHAR, id_pieces, id_runs
from ledgerlink.session import cut_lineage


_CARRIED = ["run_id", "row_ord", "bank_ref", "net_amount"]


def _spelled_ids(ledger: DataFrame) -> DataFrame:
    """Identifiers in upper case, since text is searched without case.

    Blank ones never match. ``n_pieces`` and ``first`` say where they can be in
    a text: so many pieces that begin with that one. One run of identifier
    characters is one piece; any other identifier is ``odd``.
    """
    plain = F.col("erp_id").rlike(f"^{ID_CHAR}+$")
    pieces = id_pieces(F.col("erp_id"))
    return ledger.where(F.length("erp_id") > 0).select(
        "run_id",
        "row_ord",
        F.upper("erp_id").alias("id_key"),
        (~plain).alias("odd"),
        F.when(plain, 1).otherwise(F.size(pieces)).alias("n_pieces"),
        F.upper(F.when(plain, F.col("erp_id")).otherwise(F.get(pieces, F.lit(0)))).alias("first"),
    )


def _id_shape(spelled: DataFrame):
    """One row of bounds that every plain identifier satisfies (cheap text prefilter)."""
    plain = F.when(~F.col("odd"), F.col("id_key"))
    return spelled.agg(
        F.coalesce(F.bool_or("odd"), F.lit(False)).alias("any_odd"),
        F.min(F.length(plain)).alias("shortest"),
        F.max(F.length(plain)).alias("longest"),
        F.bool_and(plain.rlike("[0-9]")).alias("has_digit"),
    ).first()


def _plausible(piece: Column, shape) -> Column:
    """Whether a run of a text can be one of the plain identifiers."""
    fits = F.length(piece).between(F.lit(shape.shortest or 0), F.lit(shape.longest or 0))
    return fits & piece.rlike("[0-9]") if shape.has_digit else fits


def _is_run(piece: Column) -> Column:
    return F.coalesce(piece.rlike(ID_CHAR), F.lit(False))


def found_ids(ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """All identifier occurrences per statement row, compared without case.

    Texts are cut once. In a run of plain identifiers every text run is looked
    up as it is. In a run that has others, a piece is looked up among the first
    pieces of identifiers, and only the lengths that go on from there are
    spelled out and compared: a tree of two levels, spread by first piece.
    """
    spelled = _spelled_ids(ledger)
    shape = _id_shape(spelled)
    text = F.coalesce("description", F.lit(""))
    known = spelled.groupBy("run_id", "id_key", "n_pieces").agg(F.min("row_ord").alias("id_ord"))
    if not shape.any_odd:
        runs = statement.select(*_CARRIED, F.posexplode(id_runs(text)).alias("start", "text"))
        return (
            runs.withColumn("id_key", F.upper("text")).where(_plausible(F.col("id_key"), shape))
            .join(known, ["run_id", "id_key"]).select(*_CARRIED, "start", "id_key", "text")
        )
    odd_runs = spelled.where("odd").select("run_id", F.lit(True).alias("odd")).distinct()
    marked = statement.join(odd_runs, "run_id", "left").select(
        *_CARRIED, F.coalesce("odd", F.lit(False)).alias("odd"), text.alias("whole")
    )
    parts = F.when(F.col("odd"), id_pieces(F.col("whole"))).otherwise(id_runs(F.col("whole")))
    starts = (
        marked.select(*_CARRIED, "odd", parts.alias("parts"))
        .select(*_CARRIED, "odd", F.when(F.col("odd"), F.col("parts")).alias("pieces"), F.posexplode("parts").alias("start", "piece"))
        .withColumn("first", F.upper("piece"))
        .where(F.col("odd") | _plausible(F.col("first"), shape))
    )
    branches = spelled.groupBy("run_id", "first").agg(F.collect_set("n_pieces").alias("sizes"))
    end = F.col("start") + F.col("n_pieces")
    spans = (
        starts.join(branches, ["run_id", "first"])
        .select("*", F.explode("sizes").alias("n_pieces"))
        .where(~F.col("odd") | (end <= F.size("pieces")))
        .select(
            *_CARRIED, "odd", "start", "n_pieces", end.alias("end"),
            F.when(F.col("odd"), F.array_join(F.slice("pieces", F.col("start") + 1, F.col("n_pieces")), ""))
            .otherwise(F.col("piece")).alias("text"),
            _is_run(F.get("pieces", F.col("start") - 1)).alias("run_before"),
            _is_run(F.get("pieces", end)).alias("run_after"),
        )
        .withColumn("id_key", F.upper("text"))
    )
    hits = (
        spans.join(known, ["run_id", "id_key", "n_pieces"])
        .where(~(F.col("run_before") & ~F.col("id_key").rlike(f"^{ID_CHAR}")))
        .where(~(F.col("run_after") & ~F.col("id_key").rlike(f"{ID_CHAR}$")))
    )
    return _without_overlaps(hits, _CARRIED)


def _without_overlaps(hits: DataFrame, carried: list[str]) -> DataFrame:
    """Keep occurrences as a left-to-right scan finds them.

    At one position the identifier listed first in the ledger wins, and the
    scan goes on behind it. The occurrences of one text are bounded by its length.
    """
    found = F.sort_array(
        F.collect_list(F.struct("start", "id_ord", "end", "id_key", "text"))
    )
    nothing = F.struct(
        F.lit(0).alias("cursor"),
        F.array()
        .cast("array<struct<start:int,id_key:string,text:string>>")
        .alias("kept"),
    )

    def scan(state: Column, hit: Column) -> Column:
        taken = F.struct(
            hit.end.alias("cursor"),
            F.concat(
                state.kept,
                F.array(
                    F.struct(
                        hit.start.alias("start"),
                        hit.id_key.alias("id_key"),
                        hit.text.alias("text"),
                    )
                ),
            ).alias("kept"),
        )
        return F.when(hit.start >= state.cursor, taken).otherwise(state)

    return (
        hits.groupBy(*carried)
        .agg(found.alias("found"))
        .select(*carried, F.inline(F.aggregate("found", nothing, scan).kept))
    )


def id_counts(ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """Per statement row naming any identifier: how many distinct, and the last."""
    return (
        found_ids(ledger, statement)
        .groupBy("run_id", "row_ord", "bank_ref", "net_amount")
        .agg(
            F.count_distinct("id_key").alias("n_ids"),
            F.max_by("text", "start").alias("id_text"),
        )
    )


def extracted_ids(ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """The identifier of each statement row that names exactly one.

    The spelling is that of the last occurrence; it is compared with case later.
    """
    return (
        found_ids(ledger, statement)
        .groupBy("run_id", "row_ord", "bank_ref", "net_amount")
        .agg(
            F.min("id_key").alias("first_key"),
            F.max("id_key").alias("last_key"),
            F.max_by("text", "start").alias("id_text"),
        )
        .where(F.col("first_key") == F.col("last_key"))
        .drop("first_key", "last_key")
    )


def key_multiplicity(ledger: DataFrame, ids: DataFrame) -> DataFrame:
    """How often each (identifier, amount) key occurs on either side."""
    erp = ledger.groupBy("run_id", "erp_id", "amount").agg(
        F.count("*").alias("n"), F.min("row_ord").alias("row_ord")
    )
    bank = ids.groupBy(
        "run_id", F.col("id_text").alias("erp_id"), F.col("net_amount").alias("amount")
    ).agg(
        F.count("*").alias("n"),
        F.min("row_ord").alias("row_ord"),
        F.min("bank_ref").alias("bank_ref"),
    )
    return erp.select(
        F.lit("erp").alias("side"), "*", F.lit(None).cast("string").alias("bank_ref")
    ).unionByName(bank.select(F.lit("bank").alias("side"), "*"))


def exact_matches(ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """Pairs whose (identifier, amount) key is unique on both sides.

    The keys are counted with map-side aggregation, so a key that fills a third
    of a table costs one row per task, and the final join is one-to-one.
    """
    keys = key_multiplicity(ledger, extracted_ids(ledger, statement))
    unique = keys.where(F.col("n") == 1)
    erp = unique.where(F.col("side") == "erp").select(
        "run_id", "erp_id", "amount", F.col("row_ord").alias("erp_ord")
    )
    bank = unique.where(F.col("side") == "bank").select(
        "run_id", "erp_id", "amount", "bank_ref", F.col("row_ord").alias("bank_ord")
    )
    return erp.join(bank, ["run_id", "erp_id", "amount"]).select(
        "run_id", "erp_id", "bank_ref", "amount", "erp_ord", "bank_ord"
    )


def unresolved_ledger(ledger: DataFrame, exact: DataFrame) -> DataFrame:
    matched = exact.select("run_id", F.col("erp_ord").alias("row_ord"))
    return ledger.join(matched, ["run_id", "row_ord"], "left_anti")


def unresolved_statement(statement: DataFrame, exact: DataFrame) -> DataFrame:
    matched = exact.select("run_id", F.col("bank_ord").alias("row_ord"))
    return statement.join(matched, ["run_id", "row_ord"], "left_anti")


def available_statement(statement: DataFrame, exact: DataFrame) -> DataFrame:
    """Statement rows whose reference no exact pair has taken."""
    return without_keys(statement, exact, ["run_id", "bank_ref"])


def without_keys(rows: DataFrame, taken: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` whose key does not occur in ``taken``.

    The keys that both have are written first. They are few where rows are known by
    their keys, so Spark sends them to all tasks and no whole row is shuffled.
    """
    both = rows.select(*key).join(taken.select(*key), key, "left_semi").distinct()
    return rows.join(cut_lineage(both), key, "left_anti")


def exact_false_positives(
    exact: DataFrame, truth: DataFrame, ledger: DataFrame, statement: DataFrame
) -> DataFrame:
    """Exact pairs that the truth does not list as exact, with what triggered them."""
    expected = truth.where(F.col("match_type") == "exact").select(
        "run_id", "erp_id", "bank_ref"
    )
    wrong = exact.join(expected, ["run_id", "erp_id", "bank_ref"], "left_anti")
    erp = ledger.select(
        "run_id", F.col("row_ord").alias("erp_ord"), F.col("amount").alias("erp_amount")
    )
    bank = statement.select(
        "run_id", F.col("row_ord").alias("bank_ord"), "description", "net_amount"
    )
    return (
        wrong.join(erp, ["run_id", "erp_ord"])
        .join(bank, ["run_id", "bank_ord"])
        .select(
            "run_id",
            "erp_id",
            "bank_ref",
            "erp_amount",
            "description",
            "net_amount",
            F.col("erp_id").alias("trigger_id"),
            F.col("amount").alias("trigger_amount"),
        )
    )


def duplicate_keys(ledger: DataFrame, statement: DataFrame) -> DataFrame:
    """Record identifiers used by more than one row of a side."""
    erp = ledger.select("run_id", F.lit("erp").alias("dataset"), F.col("erp_id").alias("record_id"))
    bank = statement.select(
        "run_id", F.lit("bank").alias("dataset"), F.col("bank_ref").alias("record_id")
    )
    return (
        erp.unionByName(bank)
        .groupBy("run_id", "dataset", "record_id")
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
