"""Cleaning, flags, deduplication and the event contract on hand-written rows."""

from datetime import datetime

from pyspark.sql import functions as F

from basketry import functions as fn
from basketry import schemas
from basketry.operators import cleaning, contract, dedup

EVENT = (
    "event_id string, customer_id string, event_type string, device string, region string, timestamp string, "
    "total_amount double, price double, refund_amount double"
)


def rows(spark, *data):
    return spark.createDataFrame(list(data), EVENT)


def test_times_with_zone_fraction_and_nonsense(spark):
    texts = ["2024-01-01T10:00:00", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00.250", " 2024-01-01 10:00:00 ",
             "2024-01-01T12:00:00+02:00", "2024-13-01T10:00:00", "2024", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(fn.parse_event_time(F.col("t"))).collect()]
    ten = datetime(2024, 1, 1, 10)
    assert got == [ten, ten, ten.replace(microsecond=250000), ten, ten, None, None, None, None]


def test_device_variants(spark):
    df = spark.createDataFrame([(x,) for x in ("mobile", "APP", " Desktop", "TABLET", "tv", None)], "d string")
    got = [r[0] for r in df.select(fn.canonical_device(F.col("d"))).collect()]
    assert got == ["Mobile", "Mobile", "Desktop", "Tablet", "Unknown", "Unknown"]


def test_stream_cleaning_flags_the_sign_before_it_is_lost(spark):
    df = rows(
        spark,
        ("e1", " c1 ", "purchase ", "app", "tamil nadu", "2024-01-01T10:00:00Z", -5.0, -1.0, None),
        ("e2", "", None, None, None, "bad", None, None, None),
        ("e3", "c3", "login", "tablet", "delhi", "2030-01-01T00:00:00", 1.0, None, None),
    )
    out = cleaning.quality_flags(cleaning.clean_stream(df, "2024-02-01"), "2024-02-01").orderBy("event_id").collect()
    first, second, third = out
    assert (first.customer_id, first.event_type, first.device, first.region) == ("C1", "PURCHASE", "Mobile", "Tamil Nadu")
    assert first.total_amount == 5.0 and first.price == 1.0 and first.dq_negative_amount and not first.dq_passed
    assert second.dq_missing_customer_id and second.dq_missing_event_type and second.dq_invalid_timestamp
    assert not second.dq_negative_amount and not second.dq_passed
    assert third.dq_future_timestamp and third.dq_passed


def test_batch_cleaning_and_its_report_agree(spark):
    df = rows(
        spark,
        ("e1", "c1", "login", "app", "x", "2024-01-01T10:00:00", -5.0, -1.0, -2.0),
        ("e1", "c1", "login", "app", "x", "2024-01-01T10:00:00", -5.0, -1.0, -2.0),
        ("e1", "c1", "login", "app", "x", "2024-01-01T09:00:00", 4.0, 1.0, 2.0),
        ("e2", None, "login", "app", "x", "2024-01-01T10:00:00", None, None, None),
        ("e3", "c3", "login", "app", "x", "nonsense", None, None, None),
        (None, "c4", "login", "app", "x", "2024-01-01T10:00:00", None, None, None),
        (None, "c5", "login", "app", "x", "2024-01-01T11:00:00", None, None, None),
    )
    out = cleaning.clean_batch(df, "2024-02-01").orderBy("event_timestamp").collect()
    # rows without an id are no copies of each other
    assert [(r.event_id, r.total_amount) for r in out] == [("e1", 4.0), (None, None), (None, None)]
    report = cleaning.cleaning_report(df).first()
    assert (report.rows_in, report.incomplete, report.copies, report.undated, report.rows_out) == (7, 1, 2, 1, 3)
    assert report.removed == 4 and not report.is_empty


def test_a_copy_with_a_broken_time_never_displaces_a_good_one(spark):
    row = lambda i, t: (i, "c1", "login", "app", "x", t, None, None, None)
    df = rows(spark, row("e1", "01/02/2024"), row("e1", "2024-01-01T00:00:00"), row("e2", "bad"), row("e2", "worse"),
              row(None, "2024-01-03T00:00:00"), row(None, "2024-01-03T00:00:00"), row(None, "bad"))
    out = cleaning.clean_batch(df, "2024-02-01").collect()
    assert sorted((str(r.event_id), r.event_timestamp.day) for r in out) == [("None", 3), ("None", 3), ("e1", 1)]
    report = cleaning.cleaning_report(df).first()
    assert (report.rows_in, report.incomplete, report.copies, report.undated, report.rows_out) == (7, 0, 2, 2, 3)
    assert report.rows_in == report.incomplete + report.copies + report.undated + report.rows_out


def test_report_of_an_empty_table(spark):
    report = cleaning.cleaning_report(rows(spark)).first()
    assert (report.rows_in, report.rows_out, report.is_empty) == (0, 0, True)


def test_dedup_is_the_same_on_any_partitioning(spark):
    data = [("a", 1, "x"), ("a", 1, "w"), ("a", 2, "v"), ("b", 3, "u"), (None, 1, "n1"), (None, 2, "n2")]
    df = spark.createDataFrame(data, "event_id string, event_timestamp int, v string")
    want = {("a", 1, "w"), ("b", 3, "u"), (None, 1, "n1"), (None, 2, "n2")}
    for parts in (1, 3, 6):
        assert {tuple(r) for r in dedup.dedup_batch(df.repartition(parts)).collect()} == want


def test_an_undated_copy_comes_last(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", 5, "y"), ("b", None, "z")], "event_id string, event_timestamp int, v string")
    assert {tuple(r) for r in dedup.dedup_batch(df).collect()} == {("a", 5, "y"), ("b", None, "z")}


def test_duplicate_rows_leave_null_keys_out(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "event_id string")
    assert dedup.duplicate_rows(df).count() == 3
    assert tuple(dedup.duplicate_row_count(df).first()) == (6, 3)
    assert tuple(dedup.duplicate_row_count(df.limit(0)).first()) == (0, 0)


def test_contract_accepts_login_and_purchase_and_names_what_is_missing(spark):
    base = dict(
        event_id="e", customer_id="C1", session_id="s", device="Mobile", region="r", country="c", city="t",
        ip_address="i", user_agent="u", timestamp="2024-01-01T00:00:00Z",
    )
    login = dict(base, event_type="LOGIN", login_method="otp", success=True)
    bought = dict(
        base, event_type="PURCHASE", order_id="o", product_ids=["P1"], total_amount=1.0, discount_amount=0.0,
        tax_amount=0.0, payment_method="upi", items_count=1,
    )
    bad = {"event_id": "only"}
    odd = dict(bought, event_type="PURCHASE", payment_method="gold", device="Toaster")
    df = spark.createDataFrame([login, bought, bad, odd], schemas.PAYLOAD)
    out = [(r.contract_valid, r.contract_reasons) for r in contract.validate_event_contract(df).collect()]
    assert out[0] == (True, []) and out[1] == (True, [])
    assert not out[2][0] and "missing customer_id" in out[2][1] and "missing event_type" in out[2][1]
    assert out[3][1] == ["unknown device", "unknown payment_method"]


def test_payload_parsing_survives_broken_json(spark):
    df = spark.createDataFrame(
        [('{"event_id": "e1", "categories": ["a", "b"], "price": 1.5}', "t", 0, 1), ("{oops", "t", 0, 2)],
        "value string, topic string, partition int, offset long",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    good, broken = cleaning.parse_payload(df, schemas.PAYLOAD).orderBy("offset").collect()
    assert (good.event_id, good.categories, good.price) == ("e1", ["a", "b"], 1.5)
    assert broken.event_id is None and broken.offset == 2


def test_elapsed_days_round_down(spark):
    df = spark.createDataFrame([("2024-01-02 22:00:00", "2024-01-01 23:00:00"), ("2024-01-01", "2024-01-01 00:00:01")],
                               "a string, b string")
    got = [r[0] for r in df.select(
        fn.elapsed_days(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))).collect()]
    assert got == [0, -1]


def test_ratio_and_clip(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (1, 0), (None, 3)], "a int, b int")
    got = [r[0] if r[0] is None else float(r[0]) for r in df.select(fn.ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [0.13, -0.13, None, None]
    clipped = spark.createDataFrame([(-0.5,), (0.5,), (2.0,), (None,)], "x double").select(fn.clip01(F.col("x")))
    assert [r[0] for r in clipped.collect()] == [0.0, 0.5, 1.0, None]
