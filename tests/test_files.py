import hashlib
import json
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlink import reconcile
from ledgerlink.operators import audit, decide, evaluate, metrics
from ledgerlink.plans import queries
from ledgerlink.plans.evaluation import evaluate_artifacts
from ledgerlink.schemas import DECISION_LOG
from ledgerlink.sources import derived, files, sinks
from ledgerlink.streaming import intake
from ledgerlink.streaming.intake import start_intake
from test_pipeline import BANK, ERP

LEDGER_HEADER = "erp_id,date,merchant_name,amount,currency,tax_line_item"
BANK_HEADER = "bank_ref,settlement_date,description,net_amount,fee_deducted"


def text(rows):
    return [",".join("" if v is None else str(v) for v in row) for row in rows]


def write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def test_ledger_is_typed_trimmed_and_in_file_order(spark, tmp_path):
    for number in range(3):
        rows = [f" E{number}{i} ,2024-01-0{i + 1},m,{i}.5,INR,0.25,x" for i in range(4)]
        write(tmp_path / f"part-{number}.csv", LEDGER_HEADER + ",note", rows)
    got = files.read_ledger(spark, str(tmp_path)).orderBy("row_ord").collect()
    assert [r.row_ord for r in got] == list(range(12))
    assert [r.erp_id for r in got] == [f"E{n}{i}" for n in range(3) for i in range(4)]
    assert got[1].amount == Decimal("1.5") and got[1].date == date(2024, 1, 2)
    assert got[0].note == "x" and got[0].run_id == "run"


def test_missing_fields(spark, tmp_path):
    path = write(tmp_path / "b.csv", BANK_HEADER, ["B1,not a date,,1,", "B2,,x,2,0"])
    first, second = files.read_statement(spark, path).orderBy("row_ord").collect()
    assert first.description == "" and first.settlement_date is None
    assert first.fee_deducted is None and second.settlement_date is None


def test_missing_columns_are_named(spark, tmp_path):
    path = write(tmp_path / "l.csv", "erp_id,amount,date", ["E1,1,2024-01-01"])
    with pytest.raises(ValueError, match="Dataset A is missing required columns: currency, merchant"):
        files.read_ledger(spark, path)


@pytest.mark.parametrize("amount", ["ten", "1.00001"])
def test_bad_amounts_raise(spark, tmp_path, amount):
    path = write(tmp_path / "l.csv", LEDGER_HEADER, [f"E1,2024-01-01,m,{amount},INR,0"])
    with pytest.raises(PySparkException):
        files.read_ledger(spark, path).collect()


def test_truth_document(spark, tmp_path):
    path = tmp_path / "truth.json"
    document = {
        "seed": 1,
        "record_counts": {"erp": 2, "bank": 2, "matched_pairs": 1},
        "matches": [
            {"erp_id": "e", "bank_ref": "b", "match_type": "exact", "expected_fee_deducted": 0.5}
        ],
        "exceptions": {"erp_only": ["e2"], "bank_only": ["b2", "b3"]},
    }
    path.write_text(json.dumps(document, indent=2))
    pairs, unmatched = files.read_truth(spark, str(path))
    assert [tuple(r) for r in pairs.collect()] == [("run", "e", "b", "exact", 0.5)]
    got = {(r.dataset, r.record_id) for r in unmatched.collect()}
    assert got == {("erp", "e2"), ("bank", "b2"), ("bank", "b3")}
    with pytest.raises(PySparkException):
        files.read_truth(spark, str(tmp_path / "none.json"))


def test_reports_are_written_and_read_back(spark, tmp_path, ledger, statement):
    out, run = str(tmp_path / "out"), reconcile(ledger(ERP), statement(BANK))
    for _ in range(2):  # writing again replaces
        sinks.write_all(run, out, {"deterministic": 0.12345, "total": 1})
    again = files.read_matched_report(spark, f"{out}/{sinks.REPORT}/run_id=run")
    assert sorted(again.columns) == sorted(run.matched.columns)
    assert {tuple(r) for r in again.select(run.matched.columns).collect()} == {
        tuple(r) for r in run.matched.collect()
    }
    back = files.read_exceptions(spark, f"{out}/{sinks.EXCEPTIONS}/run_id=run")
    assert {(r.record_id, r.reason, r.details) for r in back.collect()} == {
        (r.record_id, r.reason, r.details) for r in run.exceptions.collect()
    }
    log = files.read_decision_log(spark, f"{out}/{sinks.DECISIONS}/run_id=run", lines=True)
    assert log.count() == run.log.count()
    (document,) = spark.read.json(f"{out}/{sinks.METRICS}").collect()
    assert document.deterministic_time_seconds == 0.1235
    assert document.deterministic_match_percent == 33.33
    assert document.categorized_exceptions.amount_currency_mismatch == 2


def test_decision_log_as_an_array(spark, tmp_path):
    rows = [{"erp_id": f"e{i}", "is_match": True, "confidence_score": 0.5} for i in range(3)]
    (tmp_path / "log.json").write_text(json.dumps(rows, indent=2))
    log = files.read_decision_log(spark, str(tmp_path / "log.json"))
    assert [r.erp_id for r in log.orderBy("erp_id").collect()] == ["e0", "e1", "e2"]


def _array_of_objects(n):
    """Objects with braces, quotes, escapes and brackets in strings, nested objects, and one long text."""
    odd = ['}', '{"', '\\', '\\"}', '[', 'é😀}', '],[', "\n}\t", "", "}" * 40, "x" * 9000]
    return [
        {"erp_id": f"e{i}{odd[i % len(odd)]}", "is_match": i % 3 == 0, "confidence_score": i / 7, "reasoning": odd[(i * 5) % len(odd)],
         "extra": {"a": [{"b": odd[i % 7]}, {}], "c": {}}, "rank": i}
        for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("block", [1 << 10, 1 << 16, 1 << 27])
def test_an_array_over_many_blocks(spark, tmp_path, indent, block):
    path = str(tmp_path / "log.json")
    for name, n in (("log.json", 400), ("other.json", 7), ("none.json", 0)):
        (tmp_path / name).write_text(json.dumps(_array_of_objects(n), indent=indent, ensure_ascii=indent is None) + " \n")
    plain = spark.read.schema(DECISION_LOG).option("multiLine", True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        tasks = spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions()
        assert tasks > 3 or block > 1 << 10
        for paths in (path, str(tmp_path)):
            got = files.read_json_array(spark, paths, DECISION_LOG).collect()
            assert sorted(got, key=str) == sorted(plain.json(paths).collect(), key=str) and len(got) >= 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", ['[{"rank": 1}, {"rank": 2', '[{"rank": 1}, {"rank": 2}', '{"rank": 1}', '[1, {"rank": 1}]', '[{"rank": 1} {"rank": 2}]', '[{"rank": 1}'])
def test_broken_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "log.json").write_text(text)
    with pytest.raises(Exception, match="not a whole JSON array of objects"):
        files.read_json_array(spark, str(tmp_path / "log.json"), DECISION_LOG).collect()


def test_absent_reports_are_empty(spark, tmp_path):
    for read in (files.read_matched_report, files.read_exceptions, files.read_decision_log):
        assert read(spark, str(tmp_path / "none")).count() == 0


def test_evaluation_summary(spark, tmp_path, ledger, statement):
    run = reconcile(ledger(ERP), statement(BANK))
    truth = spark.createDataFrame(
        [("run", "E1", "B1", "exact"), ("run", "E2", "B2", "fuzzy_name")],
        "run_id string, erp_id string, bank_ref string, match_type string",
    )
    unmatched = spark.createDataFrame(
        [("run", "erp", "E4")], "run_id string, dataset string, record_id string"
    )
    summary = sinks.evaluation_summary(
        evaluate.overall_prf(run.pairs, truth),
        evaluate.category_prf(run.pairs, truth),
        evaluate.exception_prf(run.exceptions, unmatched),
        metrics.throughput_fallback(run.pairs, 2.0),
        run.exceptions,
        evaluate.confidence_calibration(run.log, truth),
        evaluate.audit_complete(run.pairs, run.ledger),
    )
    sinks.write_summary(summary, str(tmp_path))
    (row,) = spark.read.json(f"{tmp_path}/{sinks.SUMMARY}").collect()
    assert row.overall.precision == 66.67 and row.overall.recall == 100.0
    assert row.category_metrics.true_exception.fp == 5
    assert row.confidence_calibration["0.8-1.0"].total == 2
    assert row.throughput_breakdown.llm_time_seconds == 2.0
    assert row.audit_trail_ok is True


def test_only_the_folders_of_the_asked_jobs_are_read(spark, tmp_path):
    path, odd = str(tmp_path / "status"), ["j", "a b", "a/b:c=d", "50%", "é{x}[y]^*?", 'q"\'#\\', "t\tn\n", "\x7f~!@$&()+,;<>|`"]
    rows = spark.createDataFrame([(j, i) for i, j in enumerate([*odd, *(f"job-{n}" for n in range(30))])], "job_id string, seq int")
    assert audit.stored_rows(rows, path, odd) is None
    rows.write.partitionBy("job_id").parquet(path)
    stored = audit.stored_rows(rows, path, [*odd, "none"])
    assert {(r.job_id, r.seq) for r in stored.collect()} == {(j, i) for i, j in enumerate(odd)}
    assert len(stored.inputFiles()) == len(odd) and len(audit.stored_rows(rows, path).inputFiles()) == len(odd) + 30
    assert audit.stored_rows(rows, path, ["none"]) is None


def test_two_writers_of_a_job_store_each_hash_once(spark, tmp_path):
    path, columns = str(tmp_path / "audit"), "job_id string, transaction_hash string, decision string, created_at timestamp_ntz"
    assert audit.unique_rows(spark.createDataFrame([], columns), path, audit.AUDIT_KEY) is None

    def rows(keys, decision, hour):
        return spark.createDataFrame(
            [(job, key, decision, None) for job, key in keys], columns
        ).withColumn("created_at", F.expr(f"timestamp_ntz'2024-01-01 {hour:02}:00:00'"))

    first, second = rows([("j", "a"), ("j", "b"), ("k", "a")], "first", 2), rows([("j", "b"), ("j", "c")], "second", 1)
    seen = [audit.new_rows(r, path, audit.AUDIT_KEY) for r in (first, second)]
    for fresh in seen:  # both looked before either wrote
        audit.write_attempt(fresh, path)
    audit.append_new(rows([("j", "a"), ("j", "d")], "third", 0), path, audit.AUDIT_KEY)
    assert audit.stored_rows(first, path).count() == 6
    got = {(r.job_id, r.transaction_hash): r.decision for r in audit.unique_rows(first, path, audit.AUDIT_KEY).collect()}
    assert got == {("j", "a"): "first", ("j", "b"): "second", ("j", "c"): "second", ("j", "d"): "third", ("k", "a"): "first"}
    same = rows([("j", "z")], "x", 3)
    for _ in range(2):
        audit.write_attempt(same, path)
    assert audit.unique_rows(first, path, audit.AUDIT_KEY).where("transaction_hash = 'z'").count() == 1


def test_hashes_are_shuffled_as_bytes_and_read_back_as_they_were(spark):
    texts = ["ab" * 32, "AB" * 32, "ab", "abc", "ab\n", "h\u00ab", "t", "", "\u00e9", None]
    rows = spark.createDataFrame([("j", t) for t in texts], "job_id string, transaction_hash string")
    packed = audit._packed(rows)
    assert packed.select("transaction_hash").distinct().count() == len(texts)
    assert packed.where(F.octet_length("transaction_hash") == 33).count() == 1
    assert {r.transaction_hash for r in audit._unpacked(packed).collect()} == set(texts)


def test_rows_known_to_be_unique_are_not_shuffled_to_find_repeats(spark, tmp_path):
    rows = spark.createDataFrame([("j", "a"), ("j", "b")], "job_id string, transaction_hash string")
    plans = [
        audit.new_rows(rows, str(tmp_path), audit.AUDIT_KEY, ["j"], unique)._jdf.queryExecution().executedPlan().toString()
        for unique in (False, True)
    ]
    assert ["Exchange" in plan for plan in plans] == [True, False]


def test_audit_rows_are_appended_once(spark, tmp_path, ledger, statement):
    run = reconcile(ledger(ERP), statement(BANK))
    rows, path = audit.audit_rows(run.pairs, run.exceptions, 5), str(tmp_path / "audit")
    for _ in range(2):
        audit.append_new(rows, path, audit.AUDIT_KEY)
    stored = audit.stored_rows(rows, path)
    assert stored.count() == 3 + 6
    hashes = {r.transaction_hash for r in stored.collect()}
    assert hashlib.sha256(b"E1:B1").hexdigest() in hashes
    assert hashlib.sha256(b"erp:E4").hexdigest() in hashes


def request(folder, requests, job, erp=None):
    row = {
        "job_id": job,
        "user_id": "u",
        "erp_key": erp or str(folder / files.LEDGER_FILE),
        "bank_key": str(folder / files.STATEMENT_FILE),
    }
    requests.mkdir(exist_ok=True)
    (requests / f"{job}.json").write_text(json.dumps(row))


def test_intake_stream(spark, tmp_path):
    requests, out = tmp_path / "requests", str(tmp_path / "out")

    def run_stream(**knobs):
        stream = start_intake(spark, str(requests), out, str(tmp_path / "checkpoint"), **knobs)
        stream.awaitTermination()

    good, bad, cut = tmp_path / "good", tmp_path / "bad", tmp_path / "cut"
    for folder in (good, bad, cut):
        write(folder / files.LEDGER_FILE, LEDGER_HEADER, text(ERP))
        write(folder / files.STATEMENT_FILE, BANK_HEADER, text(BANK))
    write(bad / files.STATEMENT_FILE, BANK_HEADER, ["B1,2024-01-01,x,much,0"])
    write(cut / files.LEDGER_FILE, "erp_id,amount", ["E1,1"])
    request(good, requests, "j-good")
    request(bad, requests, "j-bad")
    request(cut, requests, "j-cut")
    request(good, requests, "j-key", erp=str(good / "other.csv"))
    run_stream()
    assert spark.read.option("header", True).csv(f"{out}/{sinks.REPORT}").count() == 3
    letters = {r.job_id: r.error_message for r in spark.read.parquet(f"{out}/failed_jobs").collect()}
    assert letters["j-bad"] == "bank_statement.csv: net_amount is not a number: much"
    assert letters["j-cut"].startswith("Dataset A is missing required columns: currency")
    assert letters["j-key"] == "Invalid input object keys"

    # A later request is taken in alone; a finished job asked for again is skipped.
    request(good, requests, "j-next")
    (requests / "again.json").write_text((requests / "j-good.json").read_text())
    run_stream()
    report = spark.read.option("header", True).csv(f"{out}/{sinks.REPORT}")
    assert {r.run_id: r["count"] for r in report.groupBy("run_id").count().collect()} == {
        "j-good": 3,
        "j-next": 3,
    }
    audited = spark.read.parquet(f"{out}/transaction_audit").groupBy("job_id").count()
    assert {r.job_id: r["count"] for r in audited.collect()} == {"j-good": 9, "j-next": 9}
    events = spark.read.parquet(f"{out}/job_status")
    latest = {r.job_id: r.status for r in audit.job_status_latest(events).collect()}
    assert latest == {
        "j-good": "success",
        "j-next": "success",
        "j-bad": "failed",
        "j-cut": "failed",
        "j-key": "failed",
    }
    assert events.where("job_id = 'j-good'").count() == 3
    timings = spark.read.parquet(f"{out}/stage_timings")
    assert {r.job_id: r["count"] for r in timings.groupBy("job_id").count().collect()} == {"j-good": 3, "j-next": 3}
    assert timings.where("duration_ms <= 0 or created_at is null").count() == 0

    # Too large, and failing a second time.
    request(good, requests, "j-large")
    (requests / "bad-again.json").write_text((requests / "j-bad.json").read_text())
    run_stream(max_bytes=10)
    letters = spark.read.parquet(f"{out}/failed_jobs")
    (large,) = letters.where("job_id = 'j-large'").collect()
    assert "File exceeds upload size limit" in large.error_message
    retries = letters.where("job_id = 'j-bad'").orderBy("retry_count").collect()
    assert [r.retry_count for r in retries] == [0, 1]


def test_broken_compressed_file_and_failing_job_beside_a_good_one(spark, tmp_path):
    requests, out = tmp_path / "requests", str(tmp_path / "out")
    good, torn = tmp_path / "good", tmp_path / "torn"
    for folder in (good, torn):
        write(folder / files.LEDGER_FILE, LEDGER_HEADER, text(ERP))
        write(folder / files.STATEMENT_FILE, BANK_HEADER, text(BANK))
    (torn / files.LEDGER_FILE).unlink()
    (torn / files.LEDGER_FILE).mkdir()
    (torn / files.LEDGER_FILE / "part-0.csv.gz").write_bytes(b"\x1f\x8b\x08\x00 no stream at all" * 9)
    request(good, requests, "j-good")
    request(torn, requests, "j-torn")
    request(good, requests, "j-scheme", erp=f"nosuch://host/{files.LEDGER_FILE}")
    start_intake(spark, str(requests), out, str(tmp_path / "checkpoint")).awaitTermination()
    latest = {r.job_id: r.status for r in audit.job_status_latest(spark.read.parquet(f"{out}/job_status")).collect()}
    assert latest == {"j-good": "success", "j-torn": "failed", "j-scheme": "failed"}
    letters = {r.job_id: r.error_message for r in spark.read.parquet(f"{out}/failed_jobs").collect()}
    assert set(letters) == {"j-torn", "j-scheme"} and all(letters.values())


def test_intake_gate(spark):
    listed = spark.createDataFrame(
        [("s3://b/x/erp_ledger.csv", 5), ("/y/erp_ledger.csv", 50), ("/y/ledger.csv", 5)],
        "path string, length long",
    )
    gated = files.intake_gate(listed, (files.LEDGER_FILE, files.STATEMENT_FILE), 10)
    assert [(r.accepted, r.reason) for r in gated.collect()] == [
        (True, ""),
        (False, "File exceeds upload size limit"),
        (False, "Expected erp_ledger.csv and bank_statement.csv"),
    ]


def test_long_keys_stay_apart(spark, tmp_path):
    keys = [3, 9_999_999, 12_345_678, 123_456_780, 1_234_567_890, 1_234_567_891]
    rows = [(k, k, 100.0 + k % 1000, "2024-01-01") for k in keys]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, day string")
    orders = orders.selectExpr("o_orderkey", "o_custkey", "o_totalprice", "cast(day AS timestamp_ntz) AS o_orderdate")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    ledger = derived.derived_ledger(spark, str(tmp_path))
    assert ledger.select("erp_id").distinct().count() == len(keys)
    assert ledger.select("merchant_name").distinct().count() == len(keys)
    run = reconcile(ledger, derived.derived_statement(spark, str(tmp_path)))
    assert {(r.erp_id[4:], r.bank_ref[4:]) for r in run.exact.collect()} == {
        (str(k).zfill(7), str(k).zfill(7)) for k in keys if k % 8 != 7 and k % 3 == 0
    }


ODD_NAMES = ['ACME "GOLD" LTD, E1', "back\\slash\\", 'ends with \\"', "plain"]
ODD_DATES = ["05/01/2024", "2024/01/05", "Jan 5 2024", "2024-01-05"]


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def test_quotes_backslashes_and_dates_survive(spark, tmp_path):
    rows = [f"E{i},{d},{quoted(n)},10.00,INR,0" for i, (n, d) in enumerate(zip(ODD_NAMES, ODD_DATES))]
    path = write(tmp_path / "l.csv", LEDGER_HEADER, rows)
    got = files.read_ledger(spark, path).orderBy("row_ord").collect()
    assert [r.merchant_name for r in got] == ODD_NAMES
    assert [r.date_text for r in got] == ODD_DATES
    assert [r.date for r in got] == [date(2024, 5, 1), *[date(2024, 1, 5)] * 3]
    bank = write(tmp_path / "b.csv", BANK_HEADER, [f"B0,{ODD_DATES[0]},{quoted('paid E0')},10.00,0"])
    run = reconcile(files.read_ledger(spark, path), files.read_statement(spark, bank))
    assert [(r.date, r.settlement_date) for r in run.matched.collect()] == [("05/01/2024", "05/01/2024")]
    details = {json.loads(r.details)["erp_id"]: json.loads(r.details) for r in run.exceptions.where("dataset = 'erp'").collect()}
    assert details["E2"]["date"] == "Jan 5 2024" and details["E1"]["merchant_name"] == ODD_NAMES[1]
    assert "date_text" not in details["E2"]


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "l.csv", LEDGER_HEADER, ['E1,2024-01-01,"two', 'lines",1.00,INR,0', "E2,2024-01-01,m,2.00,INR,0"])
    got = files.read_ledger(spark, path, multi_line=True).orderBy("row_ord").collect()
    assert [(r.erp_id, r.merchant_name) for r in got] == [("E1", "two\nlines"), ("E2", "m")]
    with pytest.raises(PySparkException, match="malformed record"):
        files.read_ledger(spark, path).collect()


def test_rows_are_numbered_across_splits_without_a_copy(spark, tmp_path):
    rows = [f"E{i},2024-01-01,m,1.00,INR,0" for i in range(3000)]
    path = write(tmp_path / "l.csv", LEDGER_HEADER, rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        read = files.read_ledger(spark, path)
        got = read.select("row_ord", "erp_id").collect()
        plan = read._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.row_ord: r.erp_id for r in got} == {i: f"E{i}" for i in range(3000)}
    assert "ExistingRDD" not in plan


def test_a_rewritten_run_without_rows_leaves_none(spark, tmp_path, ledger, statement):
    folder = str(tmp_path)
    open_rows = reconcile(ledger([("E1", "2024-01-01", "m", 1, "INR", 0)]), statement([]))
    sinks.write_all(open_rows, folder)
    assert files.read_exceptions(spark, folder + "/" + sinks.EXCEPTIONS).count() == 1
    matched = reconcile(
        ledger([("E1", "2024-01-01", "m", 1, "INR", 0)]), statement([("B1", "2024-01-01", "paid E1", 1, 0)])
    )
    seconds = sinks.write_all(matched, folder)
    assert files.read_exceptions(spark, folder + "/" + sinks.EXCEPTIONS).count() == 0
    assert files.read_matched_report(spark, folder + "/" + sinks.REPORT).count() == 1
    assert min(seconds.values()) > 0 and seconds["total"] >= seconds["llm"]


def test_decision_log_keeps_its_order(spark, tmp_path, ledger, statement):
    run = reconcile(ledger(ERP), statement(BANK))
    sinks.write_decision_log(run.log, str(tmp_path))
    back = files.read_decision_log(spark, f"{tmp_path}/{sinks.DECISIONS}", lines=True)
    key = ("erp_ord", "rank", "erp_id", "bank_ref")
    assert sorted(map(tuple, back.select(*key).collect())) == sorted(map(tuple, run.log.select(*key).collect()))


def test_the_audit_check_reads_only_the_batchs_jobs(spark, tmp_path, ledger, statement):
    run = reconcile(ledger(ERP), statement(BANK))
    rows = audit.audit_rows(run.matched, run.exceptions)
    audit.append_new(rows, str(tmp_path), audit.AUDIT_KEY)
    jobs = spark.createDataFrame([("run",)], "job_id string")
    plan = audit.new_rows(rows.join(jobs, "job_id"), str(tmp_path), audit.AUDIT_KEY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(job_id" in plan and "= run)" in plan.split("PartitionFilters")[1].split("]")[0] + ")"


BAD_JOBS = {
    "tax": ("ledger", ["E1,2024-01-01,m,1.00,INR,n/a"], None, "tax_line_item is not a number: n/a"),
    "decimals": ("ledger", ["E1,2024-01-01,m,10.00001,INR,0"], None, "amount is not a number: 10.00001"),
    "oversized": ("bank", ["B1,2024-01-01,x,100000000000000,0"], None, "net_amount is not a number: 1000"),
    "fee": ("bank", ["B1,2024-01-01,x,1,free"], None, "fee_deducted is not a number: free"),
    "torn": ("bank", ['B1,2024-01-01,"two', 'lines",1,0'], None, "malformed record: "),
    "headers": ("ledger", ["E1,2024-01-01,m,1.00,INR,0"], LEDGER_HEADER + ",note", "Dataset A: files differ in their headers"),
}


def test_bad_jobs_do_not_stop_a_good_one(spark, tmp_path):
    requests, out = tmp_path / "requests", str(tmp_path / "out")
    for job in ["good", *BAD_JOBS]:
        folder = tmp_path / job
        side, rows, other, _ = BAD_JOBS.get(job, (None, None, None, None))
        erp, bank = text(ERP), text(BANK)
        write(folder / files.LEDGER_FILE / "1.csv", LEDGER_HEADER, rows if side == "ledger" else erp)
        if other:
            write(folder / files.LEDGER_FILE / "2.csv", other, [rows[0] + ",x"])
        write(folder / files.STATEMENT_FILE, BANK_HEADER, rows if side == "bank" else bank)
        line = {"job_id": job, "user_id": "u-" + job, "erp_key": str(folder / files.LEDGER_FILE), "bank_key": str(folder / files.STATEMENT_FILE)}
        requests.mkdir(exist_ok=True)
        (requests / f"{job}.json").write_text(json.dumps(line))
    for _ in range(2):  # again on the same checkpoint
        start_intake(spark, str(requests), out, str(tmp_path / "checkpoint")).awaitTermination()
    letters = {r.job_id: r.error_message for r in spark.read.parquet(f"{out}/failed_jobs").collect()}
    assert set(letters) == set(BAD_JOBS)
    for job, (_, _, _, message) in BAD_JOBS.items():
        assert message in letters[job]
    latest = {r.job_id: r for r in audit.job_status_latest(spark.read.parquet(f"{out}/job_status")).collect()}
    assert {j: r.status for j, r in latest.items()} == {"good": "success", **{j: "failed" for j in BAD_JOBS}}
    good = latest["good"]
    record = json.loads(good.result)
    assert good.user_id == "u-good" and good.erp_key.endswith(files.LEDGER_FILE)
    assert record["matched_count"] == 3 and record["duration_ms"] > 0 and record["report_uri"].endswith("run_id=good")
    assert files.read_matched_report(spark, record["report_uri"]).count() == 3


@pytest.mark.parametrize("text, found", [
    ("15/01/2024", "2024-01-15"), ("01/15/2024", "2024-01-15"), ("02/03/2024", "2024-02-03"), ("31-12-2023", "2023-12-31"),
    ("15.1.2024", "2024-01-15"), ("2024.1.15", "2024-01-15"), ("15 January 2024", "2024-01-15"), ("March 3, 2024", "2024-03-03"),
    ("32/01/2024", None), ("13/13/2024", None), ("", None), (None, None),
])
def test_days_and_months_in_either_order(spark, text, found):
    row = spark.createDataFrame([(text,)], "t string").select(files.day(F.col("t")).cast("string")).first()
    assert row[0] == found


def _small_orders(spark, folder) -> str:
    rows = [(k, k % 5, 100.0 + k, f"1997-01-{1 + k % 28:02d}") for k in range(40)]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double, day string")
    orders.withColumn("o_orderdate", F.to_timestamp_ntz("day")).drop("day").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_compressed_products_are_read_back(spark, tmp_path, ledger, statement):
    run, found = reconcile(ledger(ERP), statement(BANK)), []
    for codec in (None, "gzip"):
        out = tmp_path / str(codec)
        sinks.write_all(run, str(out), {"total": 1}, compression=codec)
        parts = list(out.rglob("part-*"))
        assert parts and all((p.suffix == ".gz") == (codec == "gzip") for p in parts)
        rows = [
            files.read_matched_report(spark, f"{out}/{sinks.REPORT}", None),
            files.read_exceptions(spark, f"{out}/{sinks.EXCEPTIONS}", None),
            files.read_decision_log(spark, f"{out}/{sinks.DECISIONS}", None, lines=True),
            files.read_metrics(spark, f"{out}/{sinks.METRICS}").drop("categorized_exceptions"),
        ]
        found.append([sorted(map(str, r.collect())) for r in rows])
    assert found[0] == found[1] and all(found[0])


def test_products_and_arrays_only_read_back_are_compressed(spark, tmp_path, monkeypatch):
    data, made = _small_orders(spark, tmp_path / "in"), []
    monkeypatch.setattr(queries, "_scratch", lambda _, name: made.append(tmp_path / name) or str(made[-1]))
    report = queries.report_roundtrip(spark, data)
    arrays = queries.log_array_roundtrip(spark, data)
    run = queries._pipeline(spark, data)
    assert report.count() == run.matched.count() > 0
    assert arrays.count() == run.log.count() > 0
    for folder in made:
        parts = list(folder.rglob("part-*"))
        assert parts and all(p.suffix == ".gz" for p in parts)


def test_evaluators_are_sent_no_scores(spark, tmp_path):
    data = _small_orders(spark, tmp_path)
    rows = queries._evaluated(spark, data, decide.BatchEvaluator(queries._agreeing_frames))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "overlap#" not in plan
    assert rows.count() == queries._pipeline(spark, data).candidates.count() > 0


def test_offsets_of_splits_shuffle_no_rows(spark, tmp_path):
    path = write(tmp_path / files.LEDGER_FILE, LEDGER_HEADER, text(ERP))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = files.read_ledger(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_batch_reads_each_side_once(spark, tmp_path, monkeypatch):
    rows, seen, whole = [], [], intake.reconcile
    for job in ("a", "b"):
        erp = write(tmp_path / job / files.LEDGER_FILE, LEDGER_HEADER, text(ERP))
        bank = write(tmp_path / job / files.STATEMENT_FILE, BANK_HEADER, text(BANK))
        rows.append((job, "u", erp, bank))

    def watched(ledger, statement, *rest):
        for side in (ledger, statement):
            seen.append((side._jdf.queryExecution().executedPlan().toString(), side.inputFiles()))
        return whole(ledger, statement, *rest)

    monkeypatch.setattr(intake, "reconcile", watched)
    intake.process_requests(spark.createDataFrame(rows, intake.REQUEST_SCHEMA), str(tmp_path / "out"))
    assert len(seen) == 2
    for plan, kept in seen:
        assert "FileScan csv" not in plan and "Exchange" not in plan
        assert kept and not any(Path(f.removeprefix("file:")).exists() for f in kept)  # removed with the batch
    for job in ("a", "b"):
        assert files.read_matched_report(spark, f"{tmp_path}/out/{sinks.REPORT}/run_id={job}").count() == 3
    audited = spark.read.parquet(f"{tmp_path}/out/transaction_audit").groupBy("job_id", "stage").count()
    assert {tuple(r) for r in audited.where("stage = 'reconciliation'").collect()} == {(j, "reconciliation", 3) for j in ("a", "b")}


def test_a_single_run_is_written_as_its_rows_lie(spark, tmp_path, ledger, statement):
    rows = spark.range(0, 4000, 1, 4).selectExpr("if(id % {0} = 0, 'b', 'a') AS run_id".format(10**9), "id AS x")
    for name, runs, n_files in (("one", ["a"], 4), ("more", ["a", "b"], 2)):
        sinks._writer(rows.where("run_id = 'a'") if name == "one" else rows, f"{tmp_path}/{name}", runs).json(f"{tmp_path}/{name}")
        assert len(list((tmp_path / name).rglob("part-*"))) == n_files


def test_a_summary_parses_the_products_once(spark, tmp_path, ledger, statement):
    sinks.write_all(reconcile(ledger(ERP), statement(BANK)), str(tmp_path), {"total": 1})
    pairs = spark.createDataFrame([("run", "E1", "B1", "exact")], "run_id string, erp_id string, bank_ref string, match_type string")
    open_ = spark.createDataFrame([], "run_id string, dataset string, record_id string")
    summary = evaluate_artifacts(spark, str(tmp_path), pairs, open_)
    assert "FileScan csv" not in summary._jdf.queryExecution().executedPlan().toString()
    assert summary.count() == 1


def test_tokens_of_a_pair_are_found_once(spark):
    pair = spark.createDataFrame([("Green Shop", "GREEN shop x")], "m string, d string")
    share = pair.select(decide.identity_share(F.col("m"), F.col("d")).alias("share"))
    assert share.first().share == 1.0
    assert share._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") <= 2
