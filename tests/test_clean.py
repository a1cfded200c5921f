from pyspark.sql import functions as F

from stratagauge.operators import clean
from stratagauge.plans.silver import add_state
from stratagauge.sources.bronze import stamp


def test_ids_are_padded_and_long_ones_keep_all_characters(spark, rows):
    df = spark.createDataFrame([("1302603",), ("12",), (None,), ("35503081",)], "id_municipio string")
    assert rows(clean.normalize_keys(df)) == [("0000012",), ("1302603",), ("35503081",), (None,)]
    assert rows(clean.oversized_ids(df)) == [("35503081",)]
    as_number = spark.createDataFrame([(1302603,)], "id_municipio long")
    assert rows(clean.normalize_keys(as_number)) == [("1302603",)]


def test_categories_states_and_years(spark, rows):
    df = spark.createDataFrame(
        [(" sp ", " 2 ", "abc", "\t3 "), ("RJ", "2", "2023", None)],
        "sigla_uf string, rede string, ano string, serie string",
    )
    assert rows(clean.normalize_keys(df)) == [("RJ", "2", 2023, None), ("SP", "2", None, "\t3")]


def test_only_present_columns_are_touched(spark):
    df = spark.createDataFrame([(1, "x")], "valor int, nome string")
    assert clean.clean(df).columns == ["valor", "nome"]
    assert clean.clean(df).schema == df.schema


def test_ingest_columns_are_dropped(spark):
    df = stamp(spark.range(1), "t")
    assert df.columns == ["id", "data_ingestao", "data_ingestao_dt", "fonte", "tipo_ingestao"]
    assert clean.clean(df).columns == ["id"]


def test_categories_are_filled_and_measures_are_not(spark, rows):
    df = spark.createDataFrame([(None, None), ("A", 1.0)], "rede_desc string, taxa double")
    filled = clean.fill_category(df, ["rede_desc", "serie_desc"])
    assert rows(filled) == [("A", 1.0), ("Não informado", None)]


def test_state_of_the_prefix(spark, rows):
    df = spark.createDataFrame(
        [("3550308", "XX"), ("9912345", "XX"), (None, "XX")], "id_municipio string, sigla_uf string"
    )
    assert rows(add_state(df)) == [("3550308", "SP"), ("9912345", None), (None, None)]
    assert add_state(df).columns == df.columns
