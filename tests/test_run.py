import pytest
from pyspark.sql import functions as F

from stratagauge.config import QUALITY_SPECS, Layers, QualitySpec
from stratagauge.operators import profile, trend
from stratagauge.plans import run
from stratagauge.sources.landing import land_events
from stratagauge.sources.tables import read_table, write_table
from tests.domain import EVENT_COLUMNS, PUBLIC, event, source_tables


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    layers = Layers(str(tmp_path_factory.mktemp("layers")))
    source = source_tables(spark)
    run.load_bronze(spark, source.__getitem__, layers)
    events = [event(1), event(1), event(2, "2024-05-02T10:00:00", rate=70.0), event(3, "bad time")]
    land_events(spark.createDataFrame(events, EVENT_COLUMNS), layers.landing)
    run.drain_events(spark, layers)
    layers_rows = run.write_silver(spark, layers)
    report = run.check_quality(spark, layers)
    gold_rows = run.write_gold(spark, layers)
    return layers, layers_rows, report, gold_rows


def test_silver(spark, layers, rows):
    layers, written, _, _ = layers
    assert written == {
        "uf": 3, "municipio": 7, "alunos": 4, "indicador_stream": 2, "meta_brasil": 7, "meta_uf": 7,
        "meta_municipio": 21, "taxa_alunos_calc": 1, "indicador_municipio": 19,
    }
    municipality = read_table(spark, layers.silver("municipio"))
    assert rows(municipality.filter("id_municipio = '2304400' and ano = 2023"), "rede", "rede_desc", "serie_desc", "taxa_alfabetizacao") == [
        ("9", "Não informado", "2º ano", None)
    ]
    assert rows(read_table(spark, layers.silver("taxa_alunos_calc")), "taxa_alfabetizacao_calc", "peso_total", "qtd_alunos") == [
        (75.0, 4.0, 3)
    ]
    integrated = read_table(spark, layers.silver("indicador_municipio"))
    audit = profile.null_audit(integrated)
    assert audit.columns == ["id_municipio_nulo", "ano_nulo", "sigla_uf_nula"] and rows(audit) == [(0, 0, 0)]


def test_quality_report_and_quarantine(spark, layers):
    layers, _, report, _ = layers
    counts = {r.tabela: (r.total, r.aprovados, r.quarentena, r.pct_qualidade) for r in report.collect()}
    assert counts["municipio"] == (7, 4, 3, 57.14)
    assert counts["uf"] == (3, 3, 0, 100.0)
    assert counts["indicador_stream"] == (2, 2, 0, 100.0)
    bad = read_table(spark, layers.quarantine("municipio"))
    assert {r.motivo_quarentena for r in bad.collect()} == {"chave_duplicada", "taxa_alfabetizacao_fora_da_faixa"}
    empty = read_table(spark, layers.quarantine("uf"))
    assert empty.count() == 0 and "motivo_quarentena" in empty.columns
    rejected = read_table(spark, layers.quarantine("eventos_rejeitados"))
    assert [r.registro_invalido for r in rejected.collect()] == ["bad time"]


def test_gold_holds_approved_rows_only(spark, layers, rows):
    layers, _, _, written = layers
    assert written["indicador_municipio"] == 4 and written["indicador_stream_recente"] == 1
    indicator = read_table(spark, layers.gold("indicador_municipio"))
    assert rows(indicator.filter("ano = 2024"), "id_municipio", "sigla_uf", "meta_ano", "gap_pp", "atingiu_meta") == [
        ("3304557", "RJ", 60.0, 20.0, False), ("3550308", "SP", 60.0, -2.0, True),
    ]
    plan = indicator.filter("ano = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan
    states = read_table(spark, layers.gold("indicador_uf"))
    assert rows(states, "sigla_uf", "rede_desc", "meta_ano", "gap_pp") == [
        ("RJ", PUBLIC, None, None), ("SP", "Estadual", None, None), ("SP", PUBLIC, 60.0, 2.0),
    ]
    assert rows(read_table(spark, layers.gold("indicador_stream_recente")), "evento_id") == [("2",)]
    assert run.read_approved(spark, layers, "municipio").columns == read_table(spark, layers.silver("municipio")).columns


def test_inequality_risk_and_alerts_are_gold_tables(spark, layers, rows):
    layers, _, _, written = layers
    assert {"desigualdade_regional", "risco_meta", "alertas_queda"} <= set(written)
    spread = read_table(spark, layers.gold("desigualdade_regional"))
    assert rows(spread, "regiao", "ano", "rede_desc", "amplitude_pp")[0] == ("Nordeste", 2023, "Não informado", None)
    assert ("Sudeste", 2024, "Municipal", 22.0) in rows(spread, "regiao", "ano", "rede_desc", "amplitude_pp")
    risk = read_table(spark, layers.gold("risco_meta")).filter("id_municipio = '3550308'")
    assert rows(risk, "anos", "projecao", "meta", "em_risco") == [(2, 68.0, 66.0, False)]
    # From 60 to 70 there is no fall.
    assert read_table(spark, layers.gold("alertas_queda")).count() == 0


def test_a_weight_that_does_not_fit_is_quarantined(spark, tmp_path):
    layers = Layers(str(tmp_path))
    students = [("a1", "3550308", 2024, 700.0, 1.0), ("a2", "3550308", 2024, 700.0, float("inf")), ("a3", "9999999", 2024, 1700.0, -1.0)]
    write_table(spark.createDataFrame(students, "id_aluno string, id_municipio string, ano int, proficiencia double, peso_aluno double"), layers.silver("alunos"))
    write_table(spark.createDataFrame([("3550308",)], "id_municipio string"), layers.silver("municipio"))
    run.check_quality(spark, layers, {"alunos": QUALITY_SPECS["alunos"]})
    bad = {r.id_aluno: r.motivo_quarentena for r in read_table(spark, layers.quarantine("alunos")).collect()}
    assert bad == {"a2": "peso_aluno_fora_da_faixa", "a3": "proficiencia_fora_da_faixa; peso_aluno_fora_da_faixa; id_municipio_sem_referencia"}


def test_references_and_oversized_ids(spark, layers):
    layers = layers[0]
    spec = QualitySpec(("id_municipio", "ano", "rede", "serie"), reference=("id_municipio", "meta_municipio"))
    report = run.check_quality(spark, layers, {"municipio": spec}).first()
    assert (report.total, report.aprovados, report.quarentena) == (7, 4, 3)
    bad = read_table(spark, layers.quarantine("municipio")).filter("id_municipio = '2304400'")
    assert {r.motivo_quarentena for r in bad.collect()} == {
        "id_municipio_sem_referencia", "chave_duplicada; id_municipio_sem_referencia",
    }
    counts = {r.tabela: r.linhas for r in run.oversized_ids(spark, layers).collect()}
    assert counts == {"municipio": 0, "meta_alfabetizacao_municipio": 0, "alunos": 0}
    run.check_quality(spark, layers, {"municipio": QUALITY_SPECS["municipio"]})


def test_gold_in_one_lazy_plan_equals_the_unfiltered_stages(spark, layers, rows):
    layers = layers[0]
    lazy = run.build_gold(run._bronze_reader(spark, layers), lambda: run._bronze_events(spark, layers))
    staged = run.write_gold(spark, layers, only_approved=False)
    assert set(staged) - set(lazy) == {"alertas_queda"}  # a stage of its own
    assert {name: staged[name] for name in lazy} == {name: df.count() for name, df in lazy.items()}
    for name, df in lazy.items():
        assert rows(read_table(spark, layers.gold(name)), *df.columns) == rows(df)
    run.write_gold(spark, layers)


def test_reports_over_gold(spark, layers, rows):
    indicator = read_table(spark, layers[0].gold("indicador_municipio"))
    assert rows(profile.attainment(indicator, 2024, "Municipal")) == [(False, 1), (True, 1)]
    assert [r.gap_pp for r in profile.largest_gaps(indicator, 2024, 1).collect()] == [20.0]
    stream = read_table(spark, layers[0].silver("indicador_stream"))
    assert rows(profile.mean_by(stream)) == [("SP", 2, 65.0)]


def test_risk_of_missing_the_target(spark, layers, rows):
    evolution = read_table(spark, layers[0].gold("evolucao_municipio"))
    risk = trend.target_risk(evolution)
    # 61 in 2023 and 62 in 2024 lead to 68 in 2030, where the target is 66
    assert rows(risk, "id_municipio", "anos", "projecao", "meta", "gap_pp", "em_risco") == [
        ("2304400", 0, None, None, None, None),
        ("3304557", 1, None, 66.0, None, None),
        ("3550308", 2, 68.0, 66.0, -2.0, False),
    ]
