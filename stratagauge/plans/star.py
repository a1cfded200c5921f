"""The star-schema test tables seen as indicator tables.

A line item is a student: quantity is the proficiency, extended price the weight, return flag the
network and line status the grade. A supplier is a municipality whose id starts with its nation.
Targets are derived from the mean discount and come in two editions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.config import PUBLIC_NETWORK, STATE_TARGET_NETWORK
from stratagauge.functions import keys, measures
from stratagauge.operators import rates
from stratagauge.operators.reshape import unpivot_targets

CUTOFF = 25
DIGITS = 2  # of prices and discounts
TARGET_YEARS = range(1996, 2002)
EDITIONS = (1995, 1996)
TARGET_COLUMNS = [f"target_{year}" for year in TARGET_YEARS]
STATE_NAMES = {f"{number:02d}": f"NATION_{number}" for number in range(25)}
NETWORK_LABELS = {"A": PUBLIC_NETWORK, "N": "Municipal", "R": "Estadual"}
YEAR_SHIFT = 28  # moves 1995..2002 to 2023..2030
TERRITORY_KEYS = ["id_municipio", "ano", "rede", "serie"]

_STUDENT_KEYS = ["l_suppkey", "ano", "rede", "serie"]
_DISCOUNT = "_discount"


def students(lineitem: DataFrame, *more: Column) -> DataFrame:
    return lineitem.select(
        *more,
        "l_suppkey",
        F.year("l_shipdate").alias("ano"),
        F.col("l_returnflag").alias("rede"),
        F.col("l_linestatus").alias("serie"),
        F.col("l_quantity").alias("proficiencia"),
        F.col("l_extendedprice").alias("peso_aluno"),
        measures.units(F.col("l_discount"), DIGITS).alias("discount"),
    )


def _discount_target(year: int | None = None) -> Column:
    """1000 * mean discount, of one year if given."""
    chosen = F.lit(True) if year is None else F.col("ano") == year
    total = F.sum(F.when(chosen, F.col(_DISCOUNT))) / F.lit(10.0**DIGITS)
    rows = F.sum(F.when(chosen, F.col("_rows")))
    return F.round(F.try_divide(F.lit(1000) * total, rows), 1)


class Star:
    """The tables of one folder; each is listed and opened once, however often a plan uses it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._opened: dict[str, DataFrame] = {}
        self._share_sums = False

    @cached_property
    def shared(self) -> Star:
        """For plans that read `territory_sums` twice: the line items are scanned and shuffled once.

        Spark reuses a shuffle only between equal plans, but prunes the columns of each branch. A
        condition that is always true and names every sum keeps the branches equal.
        """
        star = Star(self.spark, self.sf_dir)
        star._opened = self._opened
        star._share_sums = True
        return star

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]

    @cached_property
    def territories(self) -> DataFrame:
        """(l_suppkey, id_municipio, state)"""
        nation, supplier = self.table("nation"), self.table("supplier")
        number, suffix = keys.padded(F.col("s_nationkey"), 2), keys.padded(F.col("s_suppkey"), 5)
        return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(
            F.col("s_suppkey").alias("l_suppkey"),
            F.concat(number, suffix).alias("id_municipio"),
            F.col("n_name").alias("state"),
        )

    def sums(self, lineitem: DataFrame) -> DataFrame:
        """Partial sums per supplier, year, network and grade, with the supplier's territory.

        Line items are summed before the join, so the large table is shuffled once, already
        reduced, and a supplier with very many line items is no hot key.
        """
        sums = rates.partial_sums(
            students(lineitem),
            _STUDENT_KEYS,
            CUTOFF,
            digits=DIGITS,
            extra=[F.sum("discount").alias(_DISCOUNT)],
        )
        if self._share_sums:
            names = [name for name in sums.columns if name not in _STUDENT_KEYS]
            sums = sums.filter((F.col("_rows") > 0) | (F.xxhash64(*names) == 0))
        return sums.join(self.territories, "l_suppkey")

    @cached_property
    def territory_sums(self) -> DataFrame:
        return self.sums(self.table("lineitem"))

    def stored_sums(self, path: str) -> Star:
        """For runs that write several tables made from `territory_sums`: the line items are scanned and summed once.

        The sums are written to `path`, whose owner is the caller.
        """
        self.territory_sums.write.parquet(path)
        star = Star(self.spark, self.sf_dir)
        star._opened = self._opened
        star.territory_sums = self.spark.read.schema(self.territory_sums.schema).parquet(path)
        return star

    @cached_property
    def realized(self) -> DataFrame:
        """A result table: rate per territory, year, network and grade; labels equal the codes."""
        return self._rates(TERRITORY_KEYS, self.territory_sums)

    @cached_property
    def state_results(self) -> DataFrame:
        sums = self.territory_sums.withColumnRenamed("state", "sigla_uf")
        return self._rates(["sigla_uf", "ano", "rede"], sums)

    @staticmethod
    def _rates(keys: list[str], sums: DataFrame) -> DataFrame:
        merged = rates.merge_sums(sums, keys)
        rated = rates.rates_from_sums(merged, keys, rate="taxa_alfabetizacao", digits=DIGITS)
        return rated.select(*keys, F.col("rede").alias("rede_desc"), "taxa_alfabetizacao")

    def _targets_by(self, *keys: str) -> DataFrame:
        return self.territory_sums.groupBy(*keys).agg(
            *[_discount_target(year).alias(name) for year, name in zip(TARGET_YEARS, TARGET_COLUMNS)]
        )

    @cached_property
    def national_targets(self) -> DataFrame:
        """A wide target table of one edition: one row per network."""
        return self._targets_by("rede").withColumn("ano", F.lit(EDITIONS[0]))

    @cached_property
    def wide_targets(self) -> DataFrame:
        """A wide target table: one row per territory, network and edition."""
        by_network = self._targets_by("id_municipio", "rede")
        editions = by_network.withColumn("ano", F.explode(F.array(*[F.lit(e) for e in EDITIONS])))
        shifted = {
            name: F.round(F.col(name) + F.col("ano") - EDITIONS[0], 1) for name in TARGET_COLUMNS
        }
        ends_in_zero = F.substring("id_municipio", -1, 1) == "0"
        shifted["target_1998"] = F.when(~ends_in_zero, shifted["target_1998"])
        return editions.withColumns(shifted)

    @cached_property
    def long_targets(self) -> DataFrame:
        return unpivot_targets(self.wide_targets, TARGET_COLUMNS)

    def source_tables(self) -> dict[str, DataFrame]:
        """The tables as the seven batch sources of a full run, with years moved into their range."""
        targets = {f"target_{y}": f"meta_alfabetizacao_{y + YEAR_SHIFT}" for y in TARGET_YEARS}
        later = (F.col("ano") + YEAR_SHIFT).alias("ano")
        state = F.col("state").alias("sigla_uf")
        label = F.create_map(*[F.lit(part) for pair in NETWORK_LABELS.items() for part in pair])

        def wide(df: DataFrame, *keys: Column) -> DataFrame:
            return df.select(*keys, later, *[F.col(old).alias(new) for old, new in targets.items()])

        labelled = label[F.col("rede")].alias("rede")
        states = self._targets_by("state").withColumn("ano", F.lit(EDITIONS[0]))
        lines = self.table("lineitem")
        student = students(lines, F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id_aluno"))
        codes = [
            (table, "rede", code, name)
            for table in ("uf", "municipio", "alunos")
            for code, name in NETWORK_LABELS.items()
        ]
        schema = "id_tabela string, nome_coluna string, chave string, valor string"
        return {
            "uf": self.state_results.select("sigla_uf", later, "rede", "taxa_alfabetizacao"),
            "municipio": self.realized.select(
                "id_municipio", later, "rede", "serie", "taxa_alfabetizacao"
            ),
            "meta_alfabetizacao_brasil": wide(self.national_targets, labelled),
            "meta_alfabetizacao_uf": wide(states, state, F.lit(STATE_TARGET_NETWORK).alias("rede")),
            "meta_alfabetizacao_municipio": wide(self.wide_targets, F.col("id_municipio"), labelled),
            "alunos": student.join(self.territories, "l_suppkey").select(
                "id_aluno", "id_municipio", later, "rede", "serie", "proficiencia", "peso_aluno"
            ),
            "dicionario": self.spark.createDataFrame(codes, schema),
        }

    def source_events(self) -> DataFrame:
        """Events as measurements of a municipality."""
        return self.table("events").select(
            F.col("event_id").cast("string").alias("evento_id"),
            F.col("user_id").cast("string").alias("id_municipio"),
            F.lit("sp").alias("sigla_uf"),
            F.lit(2024).alias("ano"),
            F.col("event_type").alias("rede"),
            F.lit("2").alias("serie"),
            F.col("value").alias("taxa_alfabetizacao"),
            F.col("ts").alias("timestamp_evento"),
        )

    def state_targets(self, network: str) -> DataFrame:
        """Targets per state and year, for one network."""
        return (
            self.territory_sums.groupBy(F.col("state").alias("sigla_uf"), F.col("ano").alias("ano_meta"))
            .agg(_discount_target().alias("valor_meta"))
            .withColumns({"ano": F.lit(EDITIONS[0]), "rede": F.lit(network)})
        )


def dictionary(spark: SparkSession) -> DataFrame:
    """Labels: a padded code, a code of another table, and none for network R and grade O."""
    return spark.sql(
        """
        SELECT * FROM VALUES
            ('lineitem', 'rede', 'A', 'State'),
            ('lineitem', 'rede', ' N ', 'Municipal'),
            ('other', 'rede', 'A', 'Private'),
            ('lineitem', 'serie', 'F', 'First')
        AS dictionary(id_tabela, nome_coluna, chave, valor)
        """
    )
