import pytest
from pyspark.sql import functions as F

from faremill import PAYMENT_CODES, RATECODES, VENDOR_CODES, CodeMap
from faremill.functions import daypart, decode, money_label, month_label, period_text, share
from faremill.functions.text import sql_text


@pytest.mark.parametrize("codes", [VENDOR_CODES, RATECODES, PAYMENT_CODES], ids=lambda c: c.desc_col)
def test_decode_known_unknown_and_null(spark, codes):
    values = [*codes.entries, 99, -1, None]
    df = spark.createDataFrame([(v,) for v in values], f"{codes.code_col} bigint")
    got = {r[0]: r[1] for r in df.select(codes.code_col, decode(codes)).collect()}
    assert got == {**codes.entries, 99: "Outro/Inválido: 99", -1: "Outro/Inválido: -1", None: None}


def test_numbered_decode(spark):
    df = spark.createDataFrame([(0,), (4,), (9,), (None,)], "payment_type bigint")
    got = [r[0] for r in df.select(decode(PAYMENT_CODES, numbered=True)).collect()]
    assert got == ["0 - Flex Fare trip", "4 - Dispute", "Outro/Inválido: 9", None]


def test_decode_takes_any_map_and_quotes(spark):
    codes = CodeMap("c", "d", {1: "driver's \\ own"}, unknown_prefix="it's ")
    df = spark.createDataFrame([(1,), (2,)], "c int")
    assert [r[0] for r in df.select(decode(codes)).collect()] == ["driver's \\ own", "it's 2"]


@pytest.mark.parametrize("text", ["plain", "it's", "a\\b", "a\\'b", "", "ção – ’"])
def test_sql_text_round_trip(spark, text):
    assert spark.sql(f"SELECT {sql_text(text)}").first()[0] == text


def test_month_label_beyond_may_is_null(spark):
    df = spark.createDataFrame([(m,) for m in (1, 2, 3, 4, 5, 6, 12, None)], "month int")
    got = [r[0] for r in df.select(month_label("month")).collect()]
    assert got == ["Jan", "Fev", "Mar", "Abr", "Mai", None, None, None]


def test_money_label_has_no_padding(spark):
    df = spark.range(1)
    labels = df.select(money_label(F.lit(90.249), 1, "M"), money_label(F.lit(28.2), 2), money_label(F.lit(2.5), 0)).first()
    assert tuple(labels) == ("$90.2M", "$28.2", "$3.0")


def test_dayparts(spark):
    df = spark.createDataFrame([(h,) for h in range(24)], "h int")
    got = [r[0] for r in df.select(daypart(F.col("h"))).collect()]
    assert got == ["Madrugada (00–04)"] * 5 + ["Manhã cedo (05–07)"] * 3 + ["Dia e tarde (08–23)"] * 16


def test_share_of_nothing_is_null(spark):
    df = spark.range(1)
    assert tuple(df.select(share(F.lit(1), F.lit(3), 4), share(F.lit(0), F.lit(0), 2)).first()) == (33.3333, None)


def test_period_text(spark):
    df = spark.createDataFrame([(2023, 1), (2023, 12)], "y int, m int")
    assert [r[0] for r in df.select(period_text(F.col("y"), F.col("m"))).collect()] == ["2023-01", "2023-12"]
