"""A tiny consistent set of source tables."""

from pyspark.sql import functions as F

PUBLIC = "Pública (Estadual e Municipal)"


def source_tables(spark):
    """All batch tables by name, with the flaws that cleaning and quality have to catch."""
    dictionary = [
        (table, column, key, label, "2023(1)2024")
        for table in ("uf", "municipio", "alunos")
        for column, key, label in [
            ("rede", "2", "Estadual"), ("rede", "3", "Municipal"), ("rede", "5", PUBLIC),
            ("serie", "2", "2º ano"),
        ]
    ]
    targets = {f"meta_alfabetizacao_{year}": 60.0 + year - 2024 for year in range(2024, 2031)}

    def with_targets(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return df.withColumns({name: F.lit(value) for name, value in targets.items()})

    return {
        "dicionario": spark.createDataFrame(
            dictionary,
            "id_tabela string, nome_coluna string, chave string, valor string, cobertura_temporal string",
        ),
        "uf": spark.createDataFrame(
            [(" sp ", 2024, "5", "2", 58.0), ("SP", 2024, "2", "2", 59.0), ("RJ", 2023, "5", "2", 50.0)],
            "sigla_uf string, ano long, rede string, serie string, taxa_alfabetizacao double",
        ),
        "municipio": spark.createDataFrame(
            [
                (3550308, 2024, "3", "2", 62.0),
                (3550308, 2023, "3", "2", 61.0),
                (3304557, 2024, "3", "2", 40.0),
                (3304557, 2024, "2", "2", 140.0),  # out of range
                (2304400, 2024, "3", "2", 70.0),  # repeated key
                (2304400, 2024, "3", "2", 71.0),
                (2304400, 2023, "9", "2", float("nan")),  # unknown network, no value
            ],
            "id_municipio long, ano long, rede string, serie string, taxa_alfabetizacao double",
        ),
        "alunos": spark.createDataFrame(
            [
                ("a1", 3550308, 2024, "2", "3", 2.0, 743.0),
                ("a2", 3550308, 2024, "2", "3", 1.0, 700.0),
                ("a3", 3550308, 2024, "2", "3", None, 800.0),
                ("a4", 3550308, 2024, "2", "3", 5.0, None),
            ],
            "id_aluno string, id_municipio long, ano long, serie string, rede string,"
            "peso_aluno double, proficiencia double",
        ),
        "meta_alfabetizacao_brasil": with_targets([(2023, "Pública")], "ano long, rede string"),
        "meta_alfabetizacao_uf": with_targets(
            [("SP", 2023, "Pública")], "sigla_uf string, ano long, rede string"
        ),
        "meta_alfabetizacao_municipio": with_targets(
            [(3550308, 2023, "Municipal"), (3550308, 2024, "Municipal"), (3304557, 2023, "Municipal")],
            "id_municipio long, ano long, rede string",
        ),
    }


def event(number, time="2024-05-01T10:00:00", city="3550308", rate=60.0):
    return (str(number), city, "SP", 2024, "municipal", "2", rate, time)


EVENT_COLUMNS = (
    "evento_id string, id_municipio string, sigla_uf string, ano int, rede string, serie string,"
    "taxa_alfabetizacao double, timestamp_evento string"
)
