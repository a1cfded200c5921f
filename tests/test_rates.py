from pyspark.sql import functions as F

from stratagauge.operators import profile, rates

SCHEMA = "id_municipio string, ano int, rede string, proficiencia double, peso_aluno double"


def test_weighted_rate_counts_the_cutoff_and_missing_weights(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", 2023, "1", 743.0, 2.0),
            ("a", 2023, "1", 742.9, 1.0),
            ("a", 2023, "1", 800.0, None),
            ("a", 2023, "1", None, 5.0),
            ("a", 2023, "1", float("nan"), 5.0),
        ],
        SCHEMA,
    )
    result = rates.weighted_rate(df)
    assert result.columns == [
        "id_municipio", "ano", "rede", "taxa_alfabetizacao_calc", "peso_total", "qtd_alunos",
    ]
    assert rows(result) == [("a", 2023, "1", 75.0, 4.0, 3)]
    assert dict(result.dtypes)["qtd_alunos"] == "bigint"


def test_zero_weight_gives_no_rate(spark, rows):
    df = spark.createDataFrame([("a", 2023, "1", 743.0, 0.0)], SCHEMA)
    assert rows(rates.weighted_rate(df)) == [("a", 2023, "1", None, 0.0, 1)]


def test_merged_partial_sums_equal_one_aggregation(spark, rows):
    df = spark.range(5000).select(
        (F.col("id") % 3).cast("string").alias("id_municipio"),
        F.lit(2023).alias("ano"),
        (F.col("id") % 2).cast("string").alias("rede"),
        (F.col("id") % 1000).cast("double").alias("proficiencia"),
        (F.col("id") * 0.000123 + 0.1).alias("peso_aluno"),
        (F.col("id") % 50).alias("escola"),
    )
    by = ["id_municipio", "ano", "rede"]
    fine = rates.partial_sums(df, [*by, "escola"])
    assert rows(rates.rates_from_sums(rates.merge_sums(fine, by), by)) == rows(rates.weighted_rate(df))


def test_result_does_not_depend_on_partitioning(spark, rows):
    df = spark.range(3000).select(
        (F.col("id") % 7).cast("string").alias("id_municipio"),
        F.lit(2023).alias("ano"),
        F.lit("1").alias("rede"),
        (F.col("id") % 1500).cast("double").alias("proficiencia"),
        (F.sin("id") + 1.5).alias("peso_aluno"),
    )
    results = []
    for partitions in (1, 4, 200):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(rows(rates.weighted_rate(df.repartition(partitions))))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1] == results[2]


def test_tiny_huge_and_infinite_weights(spark, rows):
    df = spark.createDataFrame(
        [("a", 2023, "1", 743.0, 4e-7), ("a", 2023, "1", 1.0, 4e-7), ("b", 2023, "1", 743.0, 1e13),
         ("b", 2023, "1", 1.0, 3e13), ("c", 2023, "1", 743.0, float("inf")), ("c", 2023, "1", 743.0, 1.0)],
        SCHEMA,
    )
    assert rows(rates.weighted_rate(df)) == [
        ("a", 2023, "1", 50.0, 0.0, 2), ("b", 2023, "1", 25.0, 4e13, 2), ("c", 2023, "1", 100.0, 1.0, 1),
    ]


def test_mean_of_small_huge_and_infinite_values(spark, rows):
    df = spark.createDataFrame(
        [("a", 0.04999), ("a", 0.05), ("b", 1e15), ("c", float("inf")), ("c", 2.0)], "sigla_uf string, taxa_alfabetizacao double"
    )
    assert rows(profile.mean_by(df)) == [("a", 2, 0.0), ("b", 1, 1e15), ("c", 2, 2.0)]
