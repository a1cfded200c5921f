"""The registered queries: the operators of this package over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratagauge.config import INGEST_DATE, QUALITY_SPECS, STREAM_TABLE, Layers, QualitySpec
from stratagauge.functions import keys, measures
from stratagauge.operators import (
    alerts,
    clean,
    distribution,
    joins,
    latest,
    lookup,
    profile,
    quality,
    rates,
    reshape,
    sample,
    targets,
    trend,
)
from stratagauge.plans import gold, incremental, run, silver, star
from stratagauge.plans.star import Star
from stratagauge.session import scratch_dir, tune
from stratagauge.sources import bronze, keyindex, landing, snapshots, tables, upserts, warehouse
from stratagauge.streaming import bronze as stream
from stratagauge.streaming import live

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_NAMES = {"id_municipio": "territory_id", "ano": "yr", "rede": "network", "serie": "grade"}

WORDING = quality.Wording(
    null_key="null_key:{}",
    duplicate_key="duplicate_key",
    out_of_range="{}_out_of_range",
    unknown_reference="{}_unknown",
)
LINE_KEYS = ("l_orderkey", "l_linenumber")
QUANTITY_RANGE = {"l_quantity": (2, 49)}
LINE_RANGES = {**QUANTITY_RANGE, "year": (1996, 2000)}

STREAM_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _query(run: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(Star(tune(spark), sf_dir))
    return run


def _territory(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(_NAMES)


# --- Cleaning, decoding, reshaping ----------------------------------------------------------


@_query
def clean_keys(data):
    customers = data.table("customer").select(
        F.col("c_custkey").alias("id_municipio"),
        F.col("c_mktsegment").alias("sigla_uf"),
        F.col("c_nationkey").alias("ano"),
    )
    return clean.clean(bronze.stamp(customers, "customer")).withColumnsRenamed(
        {"id_municipio": "territory_id", "sigla_uf": "segment", "ano": "nation"}
    )


@_query
def fill_category(data):
    documents = data.table("documents").select("doc_id")
    labels = data.table("labels").select("doc_id", "quality")
    joined = joins.left_lookup(documents, labels, {"doc_id": "doc_id"})
    return clean.fill_category(joined, ["quality"], "Not informed")


@_query
def unpivot_targets(data):
    return data.long_targets.select(
        F.col("id_municipio").alias("territory_id"),
        F.col("rede").alias("network"),
        F.col("ano").alias("edition"),
        F.col("ano_meta").alias("target_year"),
        F.col("valor_meta").alias("target_value"),
    )


@_query
def state_from_prefix(data):
    state = keys.by_prefix(F.col("id_municipio"), star.STATE_NAMES)
    return _territory(
        data.realized.select(*star.TERRITORY_KEYS, state.alias("state"))
    )


@_query
def decode_network(data):
    results = data.realized.drop("rede_desc")
    decoded = lookup.decode(results, star.dictionary(data.spark), "rede", "lineitem")
    filled = clean.fill_category(decoded, ["rede_desc"], "Not informed")
    return _territory(
        filled.withColumnsRenamed({"taxa_alfabetizacao": "rate", "rede_desc": "network_desc"})
    )


@_query
def silver_results(data):
    """A stamped result table through the whole silver cleaning."""
    raw = bronze.stamp(data.realized.drop("rede_desc"), "lineitem")
    padded = raw.withColumns({"rede": F.concat(F.lit(" "), "rede"), "ano": F.col("ano").cast("string")})
    return _territory(silver.results(padded, star.dictionary(data.spark), "lineitem")).withColumnsRenamed(
        {"taxa_alfabetizacao": "rate", "rede_desc": "network_desc", "serie_desc": "grade_desc"}
    )


@_query
def national_targets(data):
    long = reshape.unpivot_targets(clean.clean(data.national_targets), star.TARGET_COLUMNS)
    return long.select(
        F.col("rede").alias("network"),
        F.col("ano").alias("edition"),
        F.col("ano_meta").alias("target_year"),
        F.col("valor_meta").alias("target_value"),
    )


# --- Results and targets --------------------------------------------------------------------


@_query
def actual_with_trajectory(data):
    joined = targets.with_trajectory(data.shared.realized, data.shared.long_targets)
    return _territory(joined.drop("rede_desc")).withColumnsRenamed(
        {
            "taxa_alfabetizacao": "rate",
            "ano_meta": "target_year",
            "meta_taxa_alfabetizacao": "target_value",
        }
    )


def _indicator(data):
    return gold.municipality_indicator(data.shared.realized, data.shared.long_targets)


@_query
def target_vs_actual(data):
    return _territory(_indicator(data).drop("rede_desc", "sigla_uf")).withColumnsRenamed(
        {"taxa_realizada": "rate", "meta_ano": "target_value", "atingiu_meta": "attained"}
    )


@_query
def latest_targets(data):
    kept = targets.latest_targets(
        data.long_targets, ["id_municipio", "rede", "ano_meta"]
    )
    return _territory(kept).withColumnsRenamed({"ano_meta": "target_year", "valor_meta": "target_value"})


@_query
def state_target_vs_actual(data):
    compared = gold.state_indicator(
        data.shared.state_results, data.shared.state_targets("A"), "A", "A"
    )
    return compared.select(
        F.col("sigla_uf").alias("state"),
        F.col("ano").alias("yr"),
        F.col("rede").alias("network"),
        F.col("taxa_realizada").alias("rate"),
        F.col("meta_ano").alias("target_value"),
        "gap_pp",
    )


@_query
def evolution(data):
    series = gold.municipality_evolution(
        data.shared.realized, data.shared.long_targets
    )
    kind = F.when(F.col("tipo") == "realizado", "actual").otherwise("target")
    return series.select(
        F.col("id_municipio").alias("territory_id"),
        F.col("rede_desc").alias("network"),
        F.col("ano_ref").alias("ref_year"),
        F.col("valor").alias("value"),
        kind.alias("kind"),
    )


@_query
def weighted_rate(data):
    return _weighted_rate(data)


def _weighted_rate(data, lineitem=None):
    by = ["id_municipio", "ano", "rede"]
    sums = data.territory_sums if lineitem is None else data.sums(lineitem)
    sums = rates.merge_sums(sums, by)
    return _territory(
        rates.rates_from_sums(
            sums, by, rate="rate", total="weight_total", rows="students", digits=star.DIGITS
        )
    )


@_query
def exact_rates(data):
    """Rates over weights of many digits, which no unit of the source is known for."""
    lines = data.table("lineitem").select(
        F.col("l_returnflag").alias("rede"),
        F.col("l_linestatus").alias("serie"),
        F.col("l_quantity").alias("proficiencia"),
        (F.col("l_extendedprice") * F.col("l_discount") / F.lit(1e5)).alias("peso_aluno"),
    )
    return _territory(rates.weighted_rate(lines, ["rede", "serie"], star.CUTOFF)).withColumnsRenamed(
        {"taxa_alfabetizacao_calc": "rate", "peso_total": "weight_total", "qtd_alunos": "students"}
    )


# --- Reports --------------------------------------------------------------------------------


@_query
def stream_profile(data):
    events = data.table("events")
    return profile.mean_by(events, "event_type", "value", "events", "mean_value")


@_query
def attainment_count(data):
    return profile.attainment(_indicator(data), 1998).withColumnsRenamed(
        {"atingiu_meta": "attained", "qtd_municipios": "territories"}
    )


@_query
def null_key_audit(data):
    documents = data.table("documents").select("doc_id")
    labels = data.table("labels").select("doc_id", "quality")
    joined = joins.left_lookup(documents, labels, {"doc_id": "doc_id"})
    return profile.null_audit(joined, {"doc_id": "doc_id_null", "quality": "quality_null"})


@_query
def top_gap(data):
    return profile.largest_gaps(_indicator(data), 1998, 15).select(
        F.col("id_municipio").alias("territory_id"),
        F.col("rede_desc").alias("network"),
        F.col("serie").alias("grade"),
        "gap_pp",
    )


@_query
def ordered_sample(data):
    series = evolution(data)
    return profile.first_rows(series, ["territory_id", "kind", "ref_year", "network", "value"], 20)


@_query
def row_counts(data):
    names = ("customer", "supplier", "orders", "lineitem", "events", "documents", "labels")
    return profile.row_counts({name: data.table(name) for name in names})


@_query
def regional_inequality(data):
    nation = data.table("nation")
    results = data.realized
    number = F.substring("id_municipio", 1, 2).cast("int")
    located = results.join(nation, number == nation["n_nationkey"]).withColumnRenamed(
        "n_regionkey", "region"
    )
    return profile.spread(located, ["region", "ano"], "taxa_alfabetizacao").withColumnsRenamed(
        {"ano": "yr", "maximo": "max_rate", "minimo": "min_rate", "amplitude_pp": "spread_pp"}
    )


@_query
def trend_projection(data):
    by = ["id_municipio", "rede", "serie"]
    projected = trend.project(
        data.realized, by, at=2005, origin=1995, year="ano", value="taxa_alfabetizacao"
    )
    return _territory(projected).withColumnsRenamed({"anos": "years", "projecao": "projected_2005"})


@_query
def target_risk(data):
    """Trend of each territory and network, carried on to 2001 and compared with that target."""
    series = gold.municipality_evolution(data.shared.realized, data.shared.long_targets)
    return trend.target_risk(series, at=2001, origin=1995).select(
        F.col("id_municipio").alias("territory_id"),
        F.col("rede_desc").alias("network"),
        F.col("anos").alias("years"),
        F.col("projecao").alias("projected_2001"),
        F.col("meta").alias("target_2001"),
        "gap_pp",
        F.col("em_risco").alias("at_risk"),
    )


def _located(data):
    """Results with the region of their nation."""
    nation = data.table("nation").select("n_nationkey", F.col("n_regionkey").alias("region"))
    number = F.substring("id_municipio", 1, 2).cast("int")
    return data.realized.join(nation, number == nation["n_nationkey"])


@_query
def rate_distribution(data):
    """Percentiles and inequality of the rates of each region and year."""
    path = scratch_dir(data.spark, "rate-distribution")
    found = distribution.distribution(_located(data), ["region", "ano"], "taxa_alfabetizacao", path)
    return found.withColumnsRenamed({"ano": "yr", "linhas": "results"})


@_query
def sketched_distribution(data):
    """Medians from sketches per network, merged by region and year: the rank of each is within the stated error."""
    rows = _located(data).filter("taxa_alfabetizacao is not null")
    parts = distribution.sketches(rows, ["region", "ano", "rede"], "taxa_alfabetizacao")
    merged = distribution.merge_sketches(parts, ["region", "ano"])
    medians = distribution.sketched_percentiles(merged, ["region", "ano"], [50]).withColumnRenamed("linhas", "results")
    # Rows that are below the sketched median, and those that are not above it.
    value, median = F.col("taxa_alfabetizacao"), F.col("p50")
    ranks = joins.left_lookup(rows, medians, {"region": "region", "ano": "ano"}).groupBy("region", "ano").agg(
        F.max("results").alias("results"),
        (F.count_if(value < median) / F.count(F.lit(1))).alias("low"),
        (F.count_if(value <= median) / F.count(F.lit(1))).alias("high"),
    )
    error = distribution.SKETCH_ERROR
    within = (F.col("low") <= 0.5 + error) & (F.col("high") >= 0.5 - error)
    return ranks.select("region", F.col("ano").alias("yr"), "results", within.alias("within_error"))


@_query
def regional_spread(data):
    """The regional gold table: regions are named by the first digit of the territory."""
    found = gold.regional_inequality(data.realized)
    return found.withColumnsRenamed(
        {"regiao": "region", "ano": "yr", "rede_desc": "network", "maximo": "max_rate", "minimo": "min_rate", "amplitude_pp": "spread_pp"}
    )


@_query
def stable_sample(data):
    """A tenth of the users with all of their events, the same on every run."""
    events = data.table("events").select("event_id", "user_id", "ts", "value")
    return sample.stable_sample(events, ["user_id"], 10)


@_query
def stratified_sample(data):
    """Twenty events of each type, chosen by the hash of their id."""
    events = data.table("events").select("event_id", "event_type", "value")
    return sample.bottom_k(events, ["event_type"], ["event_id"], 20)


@_query
def lazy_gold(data):
    """Silver and gold as one lazy plan over the source tables, as it is published."""
    sources = data.source_tables()
    events = data.source_events().withColumn(stream.REJECTED, F.lit(None).cast("string"))
    indicator = run.build_gold(sources.__getitem__, lambda: events)["indicador_municipio"]
    return _territory(
        indicator.withColumn("ano", F.col("ano") - star.YEAR_SHIFT).drop("rede_desc", "sigla_uf")
    ).withColumnsRenamed(
        {"taxa_realizada": "rate", "meta_ano": "target_value", "atingiu_meta": "attained"}
    )


# --- Quality --------------------------------------------------------------------------------


def _lines(data):
    lines = data.table("lineitem").select(
        *LINE_KEYS, "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    return lines.withColumn("year", F.year("l_shipdate")).drop("l_shipdate")


def _scored_lines(data, ranges):
    return quality.score(_lines(data), LINE_KEYS, ranges, WORDING)


@_query
def duplicate_count(data):
    lines = data.table("lineitem").select(*LINE_KEYS, "l_partkey", "l_suppkey")
    return quality.duplicate_count(lines, LINE_KEYS)


@_query
def quarantine(data):
    failed = quality.quarantined(_scored_lines(data, LINE_RANGES))
    return failed.withColumnRenamed(quality.REASON_TEXT, "reason").drop("year")


@_query
def approved(data):
    return quality.approved(_scored_lines(data, LINE_RANGES))


@_query
def quality_summary(data):
    counts = quality.summary("lineitem", _lines(data), LINE_KEYS, LINE_RANGES)
    return counts.withColumnsRenamed(
        {
            "tabela": "tbl",
            "aprovados": "approved",
            "quarentena": "quarantined",
            "pct_qualidade": "pct_quality",
        }
    )


@_query
def reason_histogram(data):
    failed = quality.quarantined(_scored_lines(data, QUANTITY_RANGE))
    return quality.reason_histogram(failed).withColumnsRenamed(
        {quality.REASON_TEXT: "reason", "qtd": "qty"}
    )


@_query
def referential_violations(data):
    documents = data.table("documents").select("doc_id")
    return joins.missing_in(documents, "doc_id", data.table("labels"))


@_query
def null_key_quarantine(data):
    """A key that is missing in most rows and repeated in all of them."""
    documents = data.table("documents").select("doc_id")
    labels = data.table("labels").select("doc_id", "quality")
    joined = joins.left_lookup(documents, labels, {"doc_id": "doc_id"})
    failed = quality.quarantined(quality.score(joined, ["quality"], wording=WORDING))
    return failed.withColumnRenamed(quality.REASON_TEXT, "reason")


@_query
def reference_quarantine(data):
    """Documents whose id is not among the labels, with the reason."""
    documents = data.table("documents").select("doc_id")
    checked = quality.unknown_reference(documents, "doc_id", data.table("labels"), WORDING)
    scored = quality.score(checked, ["doc_id"], extra=[F.col(quality.REFERENCE)], wording=WORDING)
    failed = quality.quarantined(scored.drop(quality.REFERENCE))
    return failed.withColumnRenamed(quality.REASON_TEXT, "reason")


@_query
def oversized_quarantine(data):
    """Customers of which a seventh has an id beyond the format: those are quarantined, whole."""
    long_id = F.concat(F.col("c_custkey").cast("string"), F.lit("12345678"))
    some = F.when(F.col("c_custkey") % 7 == 0, long_id).otherwise(F.col("c_custkey").cast("string"))
    ids = clean.normalize_keys(data.table("customer").select(some.alias("id_municipio"))).toDF("territory_id")
    checked = quality.score(ids, ["territory_id"], wording=WORDING, extra=[quality.oversized_id("territory_id")])
    return quality.quarantined(checked).withColumnRenamed(quality.REASON_TEXT, "reason")


@_query
def rate_of_approved(data):
    """Rates from the rows that pass the quality rules."""
    lines = data.table("lineitem").select(
        *LINE_KEYS, "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate", F.year("l_shipdate").alias("year"),
    )
    passed = quality.approved(quality.score(lines, LINE_KEYS, LINE_RANGES, WORDING))
    return _weighted_rate(data, passed)


@_query
def filtered_violations(data):
    """The same rows as `referential_violations`, most of them told by a key filter before any shuffle."""
    documents = data.table("documents").select("doc_id")
    return joins.missing_behind_filter(documents, "doc_id", data.table("labels"))


@_query
def student_quarantine(data):
    """Students by the rules of their table: key, proficiency, year and weight."""
    spec = QUALITY_SPECS["alunos"]
    students = data.source_tables()["alunos"].withColumns(
        {
            "proficiencia": F.col("proficiencia") * 25,
            "peso_aluno": F.when(F.col("proficiencia") == 7, F.lit(1e18)).otherwise(F.col("peso_aluno")),
        }
    )
    cleaned = clean.clean(students).select("id_aluno", "id_municipio", "ano", "proficiencia", "peso_aluno")
    failed = quality.quarantined(quality.score(cleaned, spec.keys, spec.ranges))
    return failed.select(
        F.col("id_aluno").alias("student_id"),
        F.col("id_municipio").alias("territory_id"),
        (F.col("ano") - star.YEAR_SHIFT).alias("yr"),
        F.col(quality.REASON_TEXT).alias("reason"),
    )


@_query
def quality_report(data):
    """The quality stage of a run over a stored silver table with a reference, and its report."""
    layers = _layers(data.spark, "quality-report")
    later = data.shared.realized.withColumn("ano", F.col("ano") + star.YEAR_SHIFT)
    tables.write_table(later, layers.silver("municipio"), partition="ano")
    directory = data.territories.filter("l_suppkey % 5 <> 0").select("id_municipio")
    tables.write_table(directory, layers.silver("diretorio"))
    keys_ = QUALITY_SPECS["municipio"].keys
    spec = QualitySpec(keys_, {"taxa_alfabetizacao": (10, 60)}, ("id_municipio", "diretorio"))
    report = run.check_quality(data.spark, layers, {"municipio": spec})
    return report.withColumnsRenamed(
        {"tabela": "tbl", "aprovados": "approved", "quarentena": "quarantined", "pct_qualidade": "pct_quality"}
    )


# --- Sources and sinks ----------------------------------------------------------------------


def _layers(spark, purpose):
    return Layers(scratch_dir(spark, purpose))


@_query
def limited_scan(data):
    return profile.row_counts(
        {"orders": tables.scan(data.spark, f"{data.sf_dir}/orders.parquet", columns=["o_orderkey"], limit=1000)}
    )


@_query
def bronze_ingest(data):
    """A load written to bronze and read back with its ingest columns."""
    path = _layers(data.spark, "bronze-ingest").bronze("orders")
    bronze.write_bronze(data.table("orders"), "orders", path)
    return bronze.read_bronze(data.spark, path).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        F.col("fonte").alias("source"),
        F.col("tipo_ingestao").alias("ingest_type"),
    )


@_query
def ingest_report(data):
    """Several loads and the row counts observed while writing; line items with five columns only."""
    columns = {
        "lineitem": ["l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_extendedprice"]
    }

    def source(name):
        return tables.scan(data.spark, f"{data.sf_dir}/{name}.parquet", columns=columns.get(name))

    report = bronze.ingest(
        data.spark, source, _layers(data.spark, "ingest-report"), ["customer", "supplier", "lineitem"]
    )
    return report.drop("destino")


@_query
def partitioned_layer(data):
    """A rate table written to silver by year; one year is read back from its partition."""
    path = _layers(data.spark, "partitioned-layer").silver("taxa")
    tables.write_table(weighted_rate(data), path, partition="yr")
    return tables.read_table(data.spark, path).filter(F.col("yr") == 1998)


@_query
def table_versions(data):
    """A table that was replaced once: the version before stays readable, with its own schema."""
    path = _layers(data.spark, "table-versions").silver("taxa")
    rates_ = weighted_rate(data)
    tables.write_table(rates_, path, partition="yr")
    tables.write_table(rates_.filter("yr = 1998").select("yr", "rate"), path, partition="yr")
    counted = [
        snapshots.read(data.spark, path, found).groupBy("yr").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(found.version).cast("int").alias("version"), F.lit(len(found.schema)).alias("n_columns"), "yr", "n_rows"
        )
        for found in snapshots.versions(data.spark, path)
    ]
    return counted[0].unionByName(counted[1])


@_query
def quarantine_sink(data):
    """Quarantined rows written unpartitioned, then counted by reason."""
    path = _layers(data.spark, "quarantine-sink").quarantine("lineitem")
    tables.write_table(quarantine(data), path, rebalance=True)
    stored = tables.read_table(data.spark, path).withColumnRenamed("reason", quality.REASON_TEXT)
    return quality.reason_histogram(stored).withColumnsRenamed(
        {quality.REASON_TEXT: "reason", "qtd": "qty"}
    )


def _key_index(data, purpose, rows):
    """Line items kept with an index of their keys; two loads, and the second comes twice."""
    buckets = keyindex.buckets_for(rows.count())
    index = keyindex.KeyIndex(scratch_dir(data.spark, purpose), LINE_KEYS, buckets)
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("date")
    for name, part in {"early": F.coalesce(~late, F.lit(True)), "late": late}.items():
        keyindex.load(data.spark, index, rows.where(part), name)
    keyindex.load(data.spark, index, rows.where(late), "late")
    return keyindex.with_copies(data.spark, index)


@_query
def indexed_duplicates(data):
    """`duplicate_count` from an index of keys: the rows stay in their buckets."""
    lines = data.table("lineitem").select(*LINE_KEYS, "l_partkey", "l_suppkey", "l_shipdate")
    return _key_index(data, "indexed-duplicates", lines).drop("l_shipdate")


@_query
def indexed_quarantine(data):
    """`quarantine` with the copies counted from an index of keys."""
    lines = data.table("lineitem").select(*LINE_KEYS, "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    counted = _key_index(data, "indexed-quarantine", lines).withColumn("year", F.year("l_shipdate"))
    scored = quality.score(counted.drop("l_shipdate"), LINE_KEYS, LINE_RANGES, WORDING, counted="dup")
    return quality.quarantined(scored).withColumnRenamed(quality.REASON_TEXT, "reason").drop("year")


@_query
def published_tables(data):
    """Result tables published without a hop over the driver, and the counts the writers saw."""
    results = {
        "target_vs_actual": target_vs_actual(data),
        "evolution": evolution(data),
    }
    target = _layers(data.spark, "published").base + "/{}"
    return warehouse.publish(data.spark, results, target).drop("destino")


# --- Streaming ------------------------------------------------------------------------------


def _streamed(spark, events, purpose):
    """Events landed as JSON lines and drained through the bronze stream."""
    layers = _layers(spark, purpose)
    landing.land_events(events, layers.landing)
    stream.start_bronze_stream(
        spark,
        layers.landing,
        layers.bronze("events"),
        layers.stream_checkpoint,
        "events",
        schema=STREAM_SCHEMA,
        time="ts",
        time_type="timestamp_ntz",
    ).awaitTermination()
    return stream.good_events(spark.read.parquet(layers.bronze("events")))


@_query
def stream_bronze(data):
    events = data.table("events")
    return _streamed(data.spark, events, "stream-bronze").select(
        "event_id", "user_id", "ts", "event_type", "value",
        F.col("fonte").alias("source"),
        F.col("tipo_ingestao").alias("ingest_type"),
    )


@_query
def stream_deduplicated(data):
    """Every event landed twice, streamed and reduced to one row per id."""
    events = data.table("events").drop("props")
    streamed = _streamed(data.spark, events.unionByName(events), "stream-deduplicated")
    cleaned = clean.drop_ingest_columns(streamed).drop("props")
    return latest.deduplicate_events(cleaned, "event_id", "ts")


def _arrivals(data, parts, jitter_days):
    """Events dealt into `parts` loads by a time of arrival that is up to some days after their own."""
    events = data.table("events").select("event_id", "user_id", "ts", "event_type", "value")
    late = F.pmod(F.xxhash64("event_id"), F.lit(jitter_days * 86400))
    day = F.unix_timestamp(F.col("ts").cast("timestamp")) + late
    first, last = F.lit(1704067200), F.lit((31 + jitter_days) * 86400)
    part = F.least(F.floor((day - first) * parts / last), F.lit(parts - 1))
    return [events.filter(part == i) for i in range(parts)]


def _live_layers(data, purpose, loads):
    """The loads through the bronze stream, one after the other; gives each time the bronze table as a stream."""
    layers = _layers(data.spark, purpose)
    path = layers.bronze("events")
    for load in loads:
        landing.land_events(load.withColumn("props", F.lit(None).cast("string")), layers.landing)
        stream.start_bronze_stream(
            data.spark, layers.landing, path, layers.stream_checkpoint, "events", schema=STREAM_SCHEMA, time="ts"
        ).awaitTermination()
        events = live.bronze_events(data.spark, path, data.spark.read.parquet(path).schema)
        yield layers, events.select("event_id", "user_id", "ts", "event_type", "value")


def _plain_time(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@_query
def live_deduplicated(data):
    """Every event landed twice, out of order, and written once by the running stream, which is restarted after each load."""
    parts = _arrivals(data, 2, 3)
    for layers, events in _live_layers(data, "live-deduplicated", [parts[0].unionByName(parts[0]), parts[1].unionByName(parts[0])]):
        path, checkpoint = layers.silver("events"), f"{layers.stream_checkpoint}-live"
        live.start_deduplicated(data.spark, events, path, checkpoint, "40 days", "event_id", "ts").awaitTermination()
    return _plain_time(data.spark.read.parquet(path))


@_query
def live_latest(data):
    """The latest event of each user, merged load by load into a keyed table while events come in out of order."""
    for layers, events in _live_layers(data, "live-latest", _arrivals(data, 3, 5)):
        path, checkpoint = layers.gold("latest"), f"{layers.stream_checkpoint}-latest"
        live.start_latest(data.spark, events, path, checkpoint, "user_id", "ts", "event_id", buckets=8).awaitTermination()
    return _plain_time(upserts.read_upserts(data.spark, path))


@_query
def live_alerts(data):
    """Falls by more than 100, found by the running stream although events come up to a day late and out of order."""
    end = data.table("events").limit(0).select("event_id", "user_id", "ts", "event_type", "value")
    last = data.spark.range(1).select(
        F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"),
        F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"),
    )
    loads = [*_arrivals(data, 3, 1), end.unionByName(last)]
    for layers, events in _live_layers(data, "live-alerts", loads):
        path, checkpoint = layers.gold("alerts"), f"{layers.stream_checkpoint}-alerts"
        names = {"key": "user_id", "time": "ts", "tie_break": "event_id", "value": "value"}
        live.start_alerts(data.spark, events, 100, path, checkpoint, "2 days", **names).awaitTermination()
    return data.spark.read.parquet(path).select("event_id", "user_id", F.col("queda").alias("drop_by"))


@_query
def incremental_events(data):
    """Silver events after three loads, each merged alone: new events, repeated ones and later copies."""
    layers = _layers(data.spark, "incremental-events")
    events = data.source_events().withColumn(stream.REJECTED, F.lit(None).cast("string"))
    number = F.col("evento_id").cast("long")
    later = events.filter(number % 5 == 0).withColumns(
        {"timestamp_evento": F.col("timestamp_evento") + F.expr("interval 1 hour"), "taxa_alfabetizacao": F.col("taxa_alfabetizacao") + 1}
    )
    first, second = events.filter(number % 2 == 0), events.filter(number % 2 != 0)
    for day, load in enumerate((first, second.unionByName(first.filter(number % 3 == 0)), later), 1):
        stamped = bronze.stamp(load, "events", "streaming").withColumn(INGEST_DATE, F.to_date(F.lit(f"2024-06-0{day}")))
        stamped.write.mode("append").partitionBy(INGEST_DATE).parquet(layers.bronze(STREAM_TABLE))
        incremental.update_events(data.spark, layers, buckets=8)
    return tables.read_table(data.spark, layers.silver(incremental.EVENTS)).select(
        F.col("evento_id").alias("event_id"),
        F.col("id_municipio").alias("territory_id"),
        F.col("timestamp_evento").alias("ts"),
        F.col("taxa_alfabetizacao").alias("value"),
    )


@_query
def events_without_id(data):
    """Events of which a tenth lost its id, delivered twice: copies go, events without id all stay."""
    kept = F.when(F.pmod("event_id", F.lit(10)) != 0, F.col("event_id"))
    events = data.table("events").select(kept.alias("event_id"), "user_id", "ts", "value")
    return latest.deduplicate_events(events.unionByName(events), "event_id", "ts")


@_query
def latest_measurement(data):
    events = data.table("events").drop("props")
    return latest.latest_measurement(events, "user_id", "ts", "event_id")


@_query
def drop_alert(data):
    events = data.table("events")
    path = scratch_dir(data.spark, "drop-alert")
    fallen = alerts.drops(events, 100, path, "user_id", "ts", "event_id", "value")
    return fallen.select("event_id", "user_id", F.col("queda").alias("drop_by"))


@_query
def gold_from_layers(data):
    """All stages of a run over the test tables: bronze, stream, silver, quality, gold."""
    layers = _layers(data.spark, "layers")
    sources = data.stored_sums(scratch_dir(data.spark, "territory-sums")).source_tables()
    run.load_bronze(data.spark, sources.__getitem__, layers)
    landing.land_events(data.source_events(), layers.landing)
    run.drain_events(data.spark, layers)
    run.write_silver(data.spark, layers)
    run.check_quality(data.spark, layers)
    run.write_gold(data.spark, layers)
    indicator = tables.read_table(data.spark, layers.gold("indicador_municipio"))
    return _territory(
        indicator.withColumn("ano", F.col("ano") - star.YEAR_SHIFT).drop("rede_desc", "sigla_uf")
    ).withColumnsRenamed(
        {"taxa_realizada": "rate", "meta_ano": "target_value", "atingiu_meta": "attained"}
    )
