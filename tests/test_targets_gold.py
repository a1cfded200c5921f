import pytest

from stratagauge.operators.latest import deduplicate_events, latest_measurement
from stratagauge.operators.targets import with_trajectory
from stratagauge.plans import gold

CITY = "3550308"


@pytest.fixture
def results(spark):
    rows = [
        (CITY, 2024, "3", "Municipal", "2", 60.0),
        (CITY, 2024, "2", "Estadual", "2", 70.0),
        (CITY, 2023, "3", "Municipal", "2", 55.0),
        (CITY, 2024, "4", "Privada", "2", None),
    ]
    return spark.createDataFrame(
        rows,
        "id_municipio string, ano int, rede string, rede_desc string, serie string,"
        "taxa_alfabetizacao double",
    )


@pytest.fixture
def targets(spark):
    rows = [
        (CITY, 2023, "Municipal", 2024, 65.0),
        (CITY, 2024, "Municipal", 2024, 70.0),
        (CITY, 2023, "Municipal", 2025, 75.0),
        (CITY, 2023, "Estadual", 2024, 70.0),
        (CITY, 2024, "Privada", 2024, 70.0),
        (None, 2024, "Municipal", 2024, 1.0),
    ]
    return spark.createDataFrame(
        rows, "id_municipio string, ano int, rede string, ano_meta int, valor_meta double"
    )


def test_gap_and_flag_with_the_latest_edition(results, targets, rows):
    df = gold.municipality_indicator(results, targets)
    assert df.columns == [
        "id_municipio", "ano", "rede", "rede_desc", "serie", "taxa_realizada", "sigla_uf",
        "meta_ano", "gap_pp", "atingiu_meta",
    ]
    found = rows(df, "ano", "rede_desc", "sigla_uf", "meta_ano", "gap_pp", "atingiu_meta")
    assert found == [
        (2023, "Municipal", "SP", None, None, None),
        (2024, "Estadual", "SP", 70.0, 0.0, True),
        (2024, "Municipal", "SP", 70.0, 10.0, False),
        (2024, "Privada", "SP", 70.0, None, None),
    ]


def test_trajectory_matches_the_edition_and_fans_out(results, targets, rows):
    df = with_trajectory(results, targets)
    assert rows(df, "ano", "rede_desc", "ano_meta", "meta_taxa_alfabetizacao") == [
        (2023, "Municipal", 2024, 65.0),
        (2023, "Municipal", 2025, 75.0),
        (2024, "Estadual", None, None),
        (2024, "Municipal", 2024, 70.0),
        (2024, "Privada", 2024, 70.0),
    ]


def test_evolution_joins_both_series(results, targets, rows):
    df = gold.municipality_evolution(results, targets)
    assert df.columns == ["id_municipio", "sigla_uf", "rede_desc", "ano_ref", "valor", "tipo"]
    assert rows(df.filter("tipo = 'meta'"), "rede_desc", "ano_ref", "valor", "sigla_uf") == [
        ("Estadual", 2024, 70.0, "SP"),
        ("Municipal", 2024, 1.0, None),
        ("Municipal", 2024, 70.0, "SP"),
        ("Municipal", 2025, 75.0, "SP"),
        ("Privada", 2024, 70.0, "SP"),
    ]
    assert df.filter("tipo = 'realizado'").count() == 4


def test_state_targets_hold_for_the_public_network_only(spark, rows):
    public = "Pública (Estadual e Municipal)"
    states = spark.createDataFrame(
        [("SP", 2024, "5", public, 60.0), ("SP", 2024, "2", "Estadual", 61.0), ("RJ", 2024, "5", public, 50.0)],
        "sigla_uf string, ano int, rede string, rede_desc string, taxa_alfabetizacao double",
    )
    targets = spark.createDataFrame(
        [
            ("SP", 2023, "Pública", 2024, 64.0),
            ("SP", 2024, "Pública", 2024, 65.5),
            ("SP", 2024, "Estadual", 2024, 99.0),
        ],
        "sigla_uf string, ano int, rede string, ano_meta int, valor_meta double",
    )
    df = gold.state_indicator(states, targets)
    assert df.columns == [
        "sigla_uf", "ano", "rede", "rede_desc", "taxa_realizada", "meta_ano", "gap_pp",
    ]
    assert rows(df, "sigla_uf", "rede_desc", "meta_ano", "gap_pp") == [
        ("RJ", public, None, None),
        ("SP", "Estadual", None, None),
        ("SP", public, 65.5, 5.5),
    ]


EVENTS = "evento_id string, id_municipio string, timestamp_evento timestamp, taxa_alfabetizacao double"


def test_latest_measurement_breaks_ties_and_puts_missing_times_last(spark, rows):
    import datetime

    early, late = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("1", "a", late, 1.0), ("2", "a", late, 2.0), ("9", "a", early, 9.0), ("3", "b", None, 3.0),
         ("4", "b", early, 4.0), ("5", None, early, 5.0)],
        EVENTS,
    )
    assert rows(latest_measurement(df), "id_municipio", "evento_id") == [("a", "2"), ("b", "4"), (None, "5")]
    plan = latest_measurement(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_events_are_deduplicated_by_id(spark, rows):
    import datetime

    early, late = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("1", "a", early, 1.0), ("1", "a", late, 2.0), ("1", "a", late, 3.0), ("2", "a", early, 4.0)], EVENTS
    )
    assert rows(deduplicate_events(df), "evento_id", "taxa_alfabetizacao") == [("1", 3.0), ("2", 4.0)]


def test_events_without_id_are_no_copies(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0), (None, 2.0), ("1", 3.0), ("1", 3.0)], "evento_id string, taxa_alfabetizacao double")
    df = df.selectExpr("*", "timestamp '2024-01-01' as timestamp_evento")
    assert deduplicate_events(df).count() == 4
