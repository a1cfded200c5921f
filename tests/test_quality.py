import pytest
from pyspark.sql import functions as F

from stratagauge.config import PERCENT_RANGE, YEAR_RANGE
from stratagauge.operators import quality

RANGES = {"taxa": PERCENT_RANGE, "ano": YEAR_RANGE}
SCHEMA = "k string, ano int, taxa double"


def reasons(df, *columns):
    return {r[0]: r[1] for r in df.select(*columns, quality.REASON_TEXT).collect()}


def test_closed_ranges_ignore_null(spark):
    values = [-0.1, 0.0, 100.0, 100.1, None]
    df = spark.createDataFrame([(str(i), 2020, v) for i, v in enumerate(values)], SCHEMA)
    good, bad = quality.evaluate(df, ["k"], RANGES)
    assert reasons(bad, "k") == {"0": "taxa_fora_da_faixa", "3": "taxa_fora_da_faixa"}
    assert {r.k for r in good.collect()} == {"1", "2", "4"}
    years = [2018, 2019, 2030, 2031, None]
    df = spark.createDataFrame([(str(i), v, 1.0) for i, v in enumerate(years)], SCHEMA)
    assert set(reasons(quality.evaluate(df, ["k"], RANGES)[1], "k")) == {"0", "3"}


def test_every_row_of_a_repeated_key_is_marked_also_null(spark, rows):
    df = spark.createDataFrame(
        [(None, 2020, 1.0), (None, 2020, 2.0), ("a", 2020, 3.0), ("a", 2020, 101.0), ("b", 2020, 5.0)], SCHEMA
    )
    good, bad = quality.evaluate(df, ["k"], RANGES)
    assert rows(bad, "taxa", quality.REASON_TEXT) == [
        (1.0, "chave_nula:k; chave_duplicada"),
        (101.0, "chave_duplicada; taxa_fora_da_faixa"),
        (2.0, "chave_nula:k; chave_duplicada"),
        (3.0, "chave_duplicada"),
    ]
    assert good.columns == df.columns and bad.columns == [*df.columns, quality.REASON_TEXT]
    assert rows(good) == [("b", 2020, 5.0)]


def test_without_keys_and_rules_everything_passes(spark):
    df = spark.createDataFrame([(None, 1, -5.0)], SCHEMA)
    good, bad = quality.evaluate(df, [])
    assert (good.count(), bad.count()) == (1, 0)
    assert quality.summary("t", df, []).first().aprovados == 1


def test_key_columns_that_do_not_exist_are_ignored(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("b", 2020, 1.0)], SCHEMA)
    assert quality.evaluate(df, ["k", "serie"])[1].count() == 0


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_nothing_is_lost_and_the_summary_agrees(spark, partitions):
    df = spark.range(2000).select(
        F.when(F.col("id") % 5 != 0, (F.col("id") % 900).cast("string")).alias("k"),
        (F.lit(2017) + F.col("id") % 15).cast("int").alias("ano"),
        (F.col("id") % 130 - 10.0).alias("taxa"),
    )
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        good, bad = quality.evaluate(df, ["k", "ano"], RANGES)
        row = quality.summary("t", df, ["k", "ano"], RANGES).first()
        assert (row.total, row.aprovados, row.quarentena) == (2000, good.count(), bad.count())
        assert row.pct_qualidade == pytest.approx(100 * row.aprovados / 2000, abs=0.005)
        histogram = quality.reason_histogram(bad).collect()
        assert sum(r.qtd for r in histogram) == row.quarentena
        assert [r.qtd for r in histogram] == sorted((r.qtd for r in histogram), reverse=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_summary_of_an_empty_table(spark):
    row = quality.summary("t", spark.createDataFrame([], SCHEMA), ["k"], RANGES).first()
    assert tuple(row) == ("t", 0, 0, 0, None)


def test_extra_checks(spark):
    df = spark.createDataFrame([("12345678",), ("1234567",), ("99",)], "id_municipio string")
    directory = spark.createDataFrame([("12345678",), ("1234567",), ("1234567",)], "id_municipio string")
    checked = quality.unknown_reference(df, "id_municipio", directory)
    assert checked.count() == 3
    scored = quality.score(
        checked, ["id_municipio"], extra=[F.col("_reference"), quality.oversized_id("id_municipio")]
    )
    assert reasons(scored, "id_municipio") == {
        "12345678": "id_municipio_longo_demais",
        "1234567": "",
        "99": "id_municipio_sem_referencia",
    }
