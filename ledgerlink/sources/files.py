"""Readers: ledger, statement, truth, decision log and earlier reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.schemas import (
    DECISION_LOG,
    EXCEPTIONS,
    LEDGER_COLUMNS,
    MATCHED,
    METRICS,
    MONEY,
    STATEMENT_COLUMNS,
    TRUTH,
    require_columns,
)

DEFAULT_RUN = "run"
# The file names an intake accepts.
LEDGER_FILE = "erp_ledger.csv"
STATEMENT_FILE = "bank_statement.csv"


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


# Date styles that are read besides ISO dates and timestamps, tried in this order:
# the month comes first where both orders make a date, the day where only that one does.
DATE_STYLES = (
    "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "M.d.yyyy", "d.M.yyyy", "yyyy.M.d", "MMM d, yyyy",
    "MMM d yyyy", "d MMM yyyy", "d-MMM-yyyy", "MMMM d, yyyy", "MMMM d yyyy", "d MMMM yyyy",
)
_CORRUPT = "_malformed"


def csv_reader(spark: SparkSession, header: tuple[str, ...], multi_line: bool = False):
    """A reader of all columns as text, with quotes doubled inside quotes (RFC 4180).

    Records of another width than the header show up in the column
    ``_malformed``. ``multi_line`` reads quoted line breaks, at the price that
    a file is no longer split among tasks.
    """
    fields = [T.StructField(c, T.StringType()) for c in (*header, _CORRUPT)]
    options = {
        "header": True, "quote": '"', "escape": '"', "multiLine": multi_line,
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT,
    }
    return spark.read.schema(T.StructType(fields)).options(**options)


def _raw_csv(
    spark: SparkSession, path, required, name: str, multi_line: bool, header=None
) -> DataFrame:
    """All columns as text; a malformed record raises when read.

    Every file must have the header of the first one, unless the caller has
    checked the headers and passes their ``header``.
    """
    paths = _paths(path)
    if header is None:
        first = spark.read.option("header", True).option("escape", '"').csv(paths[0])
        header = tuple(first.columns)
    require_columns(header, required, name)
    rows = csv_reader(spark, header, multi_line).csv(paths)
    broken = F.raise_error(F.concat(F.lit(f"{name}: malformed record: "), F.col(_CORRUPT)))
    whole = F.when(F.col(_CORRUPT).isNull(), F.col(required[0])).otherwise(broken.cast("string"))
    return rows.withColumn(required[0], whole).drop(_CORRUPT)


def _in_file_order(rows: DataFrame) -> DataFrame:
    """Number rows by file path and position, as ``row_ord``.

    Rows are numbered inside their input split; each split starts where the
    splits before it end. Sizes of splits come from a pass of their own, so the
    input itself is never copied. The running total is one task over one row
    per split, and the offsets go to every task: they are as many as the splits
    that the driver hands out, and no row is shuffled for them.
    """
    tagged = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    before = Window.orderBy("_file", "_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = (
        tagged.groupBy("_file", "_start")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    return tagged.join(F.broadcast(splits), ["_file", "_start"]).withColumn(
        "row_ord", F.col("_offset") + F.col("_id") - F.col("_first")
    )


def day(text: Column) -> Column:
    """Text to a date: ISO, or one of ``DATE_STYLES``; null if it is none of them."""
    return F.coalesce(F.try_to_date(text), *[F.try_to_date(F.trim(text), style) for style in DATE_STYLES])


def is_money(text: Column) -> Column:
    """Whether :func:`money` reads ``text``; missing and blank text counts."""
    fits = text.try_cast(T.DecimalType(38, 12)) == text.try_cast(MONEY)
    return text.isNull() | (F.trim(text) == "") | F.coalesce(fits, F.lit(False))


def money(text: Column) -> Column:
    """Text to money. Anything but a number of at most four decimals raises.

    Blank text counts as missing. The check does not rely on the ANSI mode.
    """
    message = F.concat(F.lit("not an amount of at most four decimals: "), text)
    return F.when(is_money(text), text.try_cast(MONEY)).otherwise(
        F.raise_error(message).cast(MONEY)
    )


def normalize_ledger(rows: DataFrame) -> DataFrame:
    """Trim identifiers and type the columns; ``date_text`` keeps the date as given."""
    require_columns(rows.columns, LEDGER_COLUMNS, "Dataset A")
    return rows.withColumns(
        {
            "erp_id": F.trim(F.col("erp_id").cast("string")),
            "date": day(F.col("date").cast("string")),
            "date_text": F.col("date").cast("string"),
            "amount": money(F.col("amount").cast("string")),
            "tax_line_item": money(F.col("tax_line_item").cast("string")),
        }
    )


def normalize_statement(rows: DataFrame) -> DataFrame:
    """Blank missing descriptions and type the columns; extra columns stay.

    ``settlement_date_text`` keeps the date as given.
    """
    require_columns(rows.columns, STATEMENT_COLUMNS, "Dataset B")
    return rows.withColumns(
        {
            "settlement_date": day(F.col("settlement_date").cast("string")),
            "settlement_date_text": F.col("settlement_date").cast("string"),
            "description": F.coalesce(F.col("description").cast("string"), F.lit("")),
            "net_amount": money(F.col("net_amount").cast("string")),
            "fee_deducted": money(F.col("fee_deducted").cast("string")),
        }
    )


def _with_keys(rows: DataFrame, run_id: str | Column) -> DataFrame:
    """Add the keys. A ``run_id`` column may refer to the file path as ``_file``."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    numbered = _in_file_order(rows).withColumn("run_id", run)
    kept = [c for c in numbered.columns if not c.startswith("_")]
    first = ["run_id", "row_ord"]
    return numbered.select(*first, *[c for c in kept if c not in first])


def read_ledger(
    spark: SparkSession,
    path,
    run_id: str | Column = DEFAULT_RUN,
    multi_line: bool = False,
    header: tuple[str, ...] | None = None,
) -> DataFrame:
    raw = _raw_csv(spark, path, LEDGER_COLUMNS, "Dataset A", multi_line, header)
    return normalize_ledger(_with_keys(raw, run_id))


def read_statement(
    spark: SparkSession,
    path,
    run_id: str | Column = DEFAULT_RUN,
    multi_line: bool = False,
    header: tuple[str, ...] | None = None,
) -> DataFrame:
    raw = _raw_csv(spark, path, STATEMENT_COLUMNS, "Dataset B", multi_line, header)
    return normalize_statement(_with_keys(raw, run_id))


def ledger_from_table(table: DataFrame, order_key: str, run_id: str = DEFAULT_RUN) -> DataFrame:
    """A ledger from any table; ``order_key`` is the column that orders its rows."""
    keyed = table.withColumn("row_ord", F.col(order_key).cast("bigint"))
    return normalize_ledger(keyed.withColumn("run_id", F.lit(run_id))).select(
        "run_id", "row_ord", *LEDGER_COLUMNS, "date_text"
    )


def statement_from_table(
    table: DataFrame, order_key: str, run_id: str = DEFAULT_RUN
) -> DataFrame:
    keyed = table.withColumn("row_ord", F.col(order_key).cast("bigint"))
    return normalize_statement(keyed.withColumn("run_id", F.lit(run_id))).select(
        "run_id", "row_ord", *STATEMENT_COLUMNS, "settlement_date_text"
    )


def read_truth(
    spark: SparkSession, path: str, run_id: str = DEFAULT_RUN
) -> tuple[DataFrame, DataFrame]:
    """Truth document as (pairs, exceptions). A missing file is an error."""
    return explode_truth(
        spark.read.schema(TRUTH).option("multiLine", True).json(path), F.lit(run_id)
    )


def explode_truth(documents: DataFrame, run_id: Column) -> tuple[DataFrame, DataFrame]:
    pairs = documents.select(run_id.alias("run_id"), F.inline("matches")).withColumn(
        "match_type", F.coalesce("match_type", F.lit("exact"))
    )

    def unmatched(dataset: str, field: str) -> DataFrame:
        return documents.select(
            run_id.alias("run_id"),
            F.lit(dataset).alias("dataset"),
            F.explode(f"exceptions.{field}").alias("record_id"),
        )

    return pairs, unmatched("erp", "erp_only").unionByName(unmatched("bank", "bank_only"))


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The objects of files that each hold one JSON array, read by as many tasks as a file has splits.

    A file is cut at its closing braces. Whether a cut lies in a string, and how
    deep, follows from the quotes and braces before it: those of a split are
    counted for both cases, then a running total over one row per split tells
    which case holds. Pieces of an object meet by its number in the file, so it
    may span splits. Rows are those of Spark's reader of whole documents. A file
    that is no array, or is cut off, is an error, as are elements that are no objects.
    """
    pieces = spark.read.option("lineSep", "}").text(path)
    folders = [c for c in pieces.columns if c != "value"]
    tagged = pieces.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    split = ["_file", "_start"]
    in_split = Window.partitionBy(*split).orderBy("_id")
    earlier = in_split.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_split.rowsBetween(Window.unboundedPreceding, 0)
    splits_before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)

    def count(text: Column, letter: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))

    def total(column, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # What a piece opens, less its own closing brace, if it begins outside (0) or inside (1) a string.
    unescaped = F.regexp_replace("value", r"(?s)\\.", "")
    known = tagged.withColumn("_quotes", count(unescaped, '"'))
    for case in (0, 1):
        code = F.regexp_replace(F.concat(F.lit('"' * case), unescaped), r'"[^"]*("|\z)', "")
        closes = 1 - (F.col("_quotes") + case) % 2
        known = known.withColumn(f"_from{case}", F.struct((count(code, "{") - closes).alias("step"), (closes == 1).alias("closes")))
    counted = known.select(
        *split, "_id", "_quotes", "_from0", "_from1",
        F.regexp_like("value", F.lit(r"\A\uFEFF?\s*\[")).alias("_opens"),
        F.regexp_like("value", F.lit(r"\A\uFEFF?\s*\[?\s*\]\s*\z")).alias("_ends"),
    )

    def of_case(case) -> Column:
        return F.when(case % 2 == 0, F.col("_from0")).otherwise(F.col("_from1"))

    odd = counted.withColumn("_odd", total("_quotes", earlier) % 2)
    splits = (
        odd.groupBy(*split)
        .agg(
            F.sum("_quotes").alias("_quotes"),
            F.sum(of_case(F.col("_odd")).step).alias("_if0"), F.sum(of_case(F.col("_odd") + 1).step).alias("_if1"),
            F.min_by("_opens", "_id").alias("_opens"), F.max_by("_ends", "_id").alias("_ends"),
        )
        .withColumn("_case", total("_quotes", splits_before) % 2)
        .withColumn("_depth", total(F.when(F.col("_case") == 0, F.col("_if0")).otherwise(F.col("_if1")), splits_before))
    )
    whole = splits.groupBy("_file").agg(
        (F.min_by("_opens", "_start") & F.max_by("_ends", "_start")).alias("_whole")
    )
    places = splits.select(*split, "_case", "_depth").join(whole, "_file")

    def placed(rows: DataFrame) -> DataFrame:
        """Rows with the number of objects that end before them in their split, and whether one ends here."""
        here = of_case(total("_quotes", earlier) + F.col("_case"))
        return (
            rows.join(places, split).withColumn("_here", here)
            .withColumn("_after", F.col("_depth") + F.sum("_here.step").over(so_far))
            .withColumn("_last", (F.col("_here.closes") & (F.col("_after") == 0)).cast("long"))
            .withColumn("_at", total("_last", earlier))
        )

    ended = placed(counted).groupBy(*split).agg(F.sum("_last").alias("_n"))
    offsets = ended.select(*split, total("_n", splits_before).alias("_offset"))
    parts = placed(known).join(offsets, split)
    objects = parts.groupBy("_file", (F.col("_offset") + F.col("_at")).alias("_ord")).agg(
        F.array_sort(F.collect_list(F.struct("_start", "_id", "value"))).alias("_pieces"),
        F.max("_last").alias("_complete"), F.first("_whole").alias("_whole"),
        *[F.first(c).alias(c) for c in folders],
    )
    text = F.concat(F.array_join(F.col("_pieces.value"), "}"), F.lit("}"))
    lead = F.when(F.col("_ord") == 0, r"\A\uFEFF?\s*\[\s*\{").otherwise(r"\A\s*,\s*\{")
    broken = F.raise_error(F.concat(F.lit("not a whole JSON array of objects: "), F.col("_file"))).cast("string")
    sound = F.when(F.col("_whole") & ((F.col("_complete") == 0) | F.regexp_like(text, lead)), text).otherwise(broken)
    body = F.from_json(F.regexp_replace("_text", r"\A[^{]*", ""), schema).alias("_row")
    read = objects.select(sound.alias("_text"), "_complete", *folders)
    # Checked before filtering: what is left after the last object is nothing but the closing bracket.
    return read.where(F.when(F.col("_text").isNotNull(), F.col("_complete") == 1)).select(body, *folders).select("_row.*", *folders)


def read_decision_log(
    spark: SparkSession, path: str, run_id: str = DEFAULT_RUN, lines: bool = False
) -> DataFrame:
    """A decision log; empty if there is none.

    A log is one JSON array per file, or one JSON object per line (``lines``),
    which is how this package writes it. Both are read in parallel.
    """
    def read() -> DataFrame:
        return spark.read.schema(DECISION_LOG).json(path) if lines else read_json_array(spark, path, DECISION_LOG)

    return _or_empty(spark, read, DECISION_LOG, run_id)


def _report_csv(spark: SparkSession, path: str, schema: T.StructType, run_id: str):
    def read() -> DataFrame:
        options = {"header": True, "quote": '"', "escape": '"', "enforceSchema": False}
        return spark.read.schema(schema).options(**options).csv(path)

    return _or_empty(spark, read, schema, run_id)


def read_matched_report(spark, path: str, run_id: str = DEFAULT_RUN) -> DataFrame:
    return _report_csv(spark, path, MATCHED, run_id)


def read_exceptions(spark, path: str, run_id: str = DEFAULT_RUN) -> DataFrame:
    return _report_csv(spark, path, EXCEPTIONS, run_id)


def _or_empty(spark, read, schema: T.StructType, run_id: str) -> DataFrame:
    try:
        rows = read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    if run_id is None:  # written by run: the folder names say whose rows they are
        return rows if "run_id" in rows.columns else rows.select(F.lit(None).cast("string").alias("run_id"), "*")
    return rows.drop("run_id").select(F.lit(run_id).alias("run_id"), "*")


def read_metrics(spark: SparkSession, path: str) -> DataFrame | None:
    """The written metrics, one row per run, or None if there are none."""
    try:
        return spark.read.schema(METRICS).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def intake_gate(
    files: DataFrame, allowed: tuple[str, ...], max_bytes: int
) -> DataFrame:
    """Accept or reject arriving files by name and size.

    ``files`` has ``path`` and ``length``, as the binary file source lists them;
    the contents are not read.
    """
    name = F.regexp_extract("path", "([^/]+)$", 1)
    reason = (
        F.when(~name.isin(*allowed), f"Expected {' and '.join(allowed)}")
        .when(F.col("length") > max_bytes, "File exceeds upload size limit")
        .otherwise("")
    )
    return files.select(
        "path",
        name.alias("file_name"),
        F.col("length").alias("n_bytes"),
        (reason == "").alias("accepted"),
        reason.alias("reason"),
    )
