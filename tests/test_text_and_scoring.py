import pytest
from pyspark.sql import functions as F

from ledgerlink.config import ReconConfig
from ledgerlink.functions.scoring import candidate_score, date_gap
from ledgerlink.functions.text import identity_tokens, name_tokens
from ledgerlink.operators.decide import identity_share


@pytest.mark.parametrize(
    "text, as_written, folded",
    [
        ("Razorpay Software", ["azorpay", "oftware"], ["razorpay", "software"]),
        ("RZPAY PVT LTD", [], ["rzpay"]),
        ("acme ltd payout acme", ["acme"], ["acme"]),
        ("ab abc 12 123", ["123", "abc"], ["123", "abc"]),
        ("", [], []),
        (None, [], []),
    ],
)
def test_name_tokens(spark, text, as_written, folded):
    row = (
        spark.createDataFrame([(text,)], "t string")
        .select(name_tokens(F.col("t")), name_tokens(F.col("t"), True))
        .first()
    )
    assert list(row) == [as_written, folded]


@pytest.mark.parametrize(
    "merchant, description, share",
    [
        ("Razorpay Software", "RZPAY PVT LTD / CARD PAYOUT", 1.0),
        ("Northstar Electronics", "NORTHSTAR ELEC SETTLEMENT", 1.0),
        ("Acme Retail India", "ACME FOODS SETTLEMENT", 0.5),
        ("Acme Retail", "UNKNOWN MERCHANT 01", 0.0),
        ("Acme", "", 0.0),
        (None, "ACME", 0.0),
    ],
)
def test_identity_share(spark, merchant, description, share):
    row = spark.createDataFrame([(merchant, description)], "m string, d string")
    assert row.select(identity_share(F.col("m"), F.col("d"))).first()[0] == share


def test_aliases_and_descriptors(spark):
    row = spark.createDataFrame([("RZPAY Razorpay card",)], "t string")
    assert row.select(identity_tokens(F.col("t"))).first()[0] == ["razorpay"]


def test_score_and_date_gap(spark):
    row = spark.createDataFrame([(1, 2, 0.25)], "o int, n int, d double")
    score = candidate_score(F.col("o"), F.col("n"), F.col("d"), F.lit(3))
    got = row.select(score, date_gap(F.lit(None).cast("date"), F.current_date())).first()
    assert got[0] == pytest.approx(0.275 + 0.24 + 0.0375)
    assert got[1] == 30


def test_settings_are_checked():
    for knobs in (
        {"confidence_threshold": 0.7},
        {"max_candidates": 0},
        {"hot_group_rows": 0},
        {"assignment_rounds": 0},
    ):
        with pytest.raises(ValueError):
            ReconConfig(**knobs)
