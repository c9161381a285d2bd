import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars, web


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()[0]


def test_surrogate_key(spark):
    assert one(spark, scalars.surrogate_key(F.lit("a"))) == "0cc175b9c0f1b6a831c399e269772661"
    text = F.lit(None).cast("string")
    assert one(spark, scalars.surrogate_key(text, text, text)) == "2fa5491950d66d153d23cfbcfea4e164"
    assert one(spark, scalars.surrogate_key(text, nulls_as_empty=True)) == hashlib.md5(b"").hexdigest()


def test_hash(spark):
    want = hashlib.sha256(b"salt-1:x").hexdigest()
    assert one(spark, scalars.salted_hash(F.lit("x"), "salt-1")) == want


@pytest.mark.parametrize(
    "mail, masked",
    [("analyst@example.com", "a*****t@example.com"), ("ab@x.org", "**@x.org"), ("a@x.org", "*@x.org"),
     ("@x.org", "@x.org"), ("nodomain", "***"), ("nodomain@", "***"), ("a@b@c", "*@b@c"), (None, None)],
)
def test_mask_email(spark, mail, masked):
    assert one(spark, scalars.mask_email(F.lit(mail).cast("string"))) == masked


def test_protect(spark):
    df = spark.createDataFrame([("Ann Lee", "ann@x.org", "C1", 7)], "full_name string, email string, customer_id string, n int")
    logs = scalars.protect(df, "s", "logs").head()
    assert logs.email == "a*n@x.org" and logs.customer_id == "C1" and len(logs.full_name) == 64
    exports = scalars.protect(df, "s", "exports").head()
    assert len(exports.email) == 64 and len(exports.customer_id) == 64 and exports.n == 7


def test_money_keeps_bad_text_as_null(spark):
    assert one(spark, scalars.money(F.lit("abc"))) is None
    assert one(spark, scalars.money(F.lit("2.675"))) == Decimal("2.68")
    assert one(spark, scalars.cents_to_amount(F.lit(1234))) == 12.34


def test_safe_arithmetic(spark):
    null = F.lit(None).cast("int")
    assert one(spark, scalars.safe_add(F.lit(1), null, F.lit(3))) == 4
    assert one(spark, scalars.safe_subtract(F.lit(10), F.lit(3), null)) == 7
    assert one(spark, scalars.safe_divide(F.lit(10), F.lit(5))) == 2
    assert one(spark, scalars.safe_divide(F.lit(10), F.lit(0))) is None
    assert one(spark, scalars.safe_divide(null, null)) is None


@pytest.mark.parametrize(
    "amount, bucket",
    [(190000, 0), (290000, 1), (320000, 2), (399999.99, 2), (400000, 3), (470000, 3), (510000, 4), (610000, 5)],
)
def test_width_bucket(spark, amount, bucket):
    assert one(spark, scalars.width_bucket(F.lit(float(amount)), 200000, 600000, 4)) == bucket


def test_haversine(spark):
    place = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(one(spark, scalars.haversine(*place, unit="km"))) == 430
    assert round(one(spark, scalars.haversine(*place))) == 267
    with pytest.raises(ValueError):
        scalars.haversine(*place, unit="yards")


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("https://www.google.co.uk/search?q=x", "www.google.co.uk", "search"),
        ("www.google.co.uk?utm_source=feed", "www.google.co.uk", ""),
        ("android-app://com.app/a/b", "com.app", "/com.app/a/b"),
        ("http://example.com", "example.com", "example.com"),
        (None, None, None),
    ],
)
def test_url_parts(spark, url, host, path):
    c = F.lit(url).cast("string")
    assert one(spark, web.url_host(c)) == host
    assert one(spark, web.url_path(c)) == path


def test_url_parameter(spark):
    c = F.lit("http://h.org/p?utm_medium=a&utm_source=feed&x=")
    assert one(spark, web.url_parameter(c, "utm_medium")) == "a"
    assert one(spark, web.url_parameter(c, "utm_source")) == "feed"
    assert one(spark, web.url_parameter(c, "x")) is None
    assert one(spark, web.url_parameter(c, "absent")) is None


@pytest.mark.parametrize("score, band", [(80, "HIGH"), (79, "MEDIUM"), (50, "MEDIUM"), (49, "LOW"), (None, "LOW")])
def test_risk_band(spark, score, band):
    assert one(spark, scalars.risk_band(F.lit(score).cast("int"))) == band
