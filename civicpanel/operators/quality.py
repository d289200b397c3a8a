"""Data quality and reconciliation over tables (Q1-Q12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from civicpanel.operators.aggregate import money
from civicpanel.operators.joins import full_join
from civicpanel.operators.reshape import union_all
from civicpanel.operators.territory import COUNTRY_ID
from civicpanel.operators.windows import with_total
from civicpanel.sizing import small_side, within


def _counts(frames: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One row per frame, in the given order: its name and row count."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("linhas")).select(
                F.lit(number).alias("ordem"), F.lit(key).alias(name), "linhas"
            )
            for number, (key, df) in enumerate(frames.items(), start=1)
        ]
    )


def compare_counts(environments: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of a table in each environment, and the gap to the first one."""
    counts = _counts(environments, "ambiente")
    # One row per environment.
    first = F.first("linhas").over(Window.orderBy("ordem"))
    return counts.withColumn("diferenca", F.col("linhas") - first).drop("ordem")


def row_loss_guard(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Rows after each step and the rows that the step lost (negative: added)."""
    counts = _counts(steps, "etapa")
    # One row per step.
    before = F.lag("linhas").over(Window.orderBy("ordem"))
    return counts.withColumn("perda", F.coalesce(before, F.col("linhas")) - F.col("linhas"))


class ObservedSteps:
    """Row counts of the steps of one job, taken in the pass that writes its result.

    Wrap the frame after each step with :meth:`step`, write the last one, then read
    :meth:`losses`.  A step inside a join that Spark broadcasts or repeats is counted
    as often as it is computed, so wrap the side that streams through the job.
    """

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def step(self, df: DataFrame, name: str) -> DataFrame:
        seen = self._seen[name] = Observation(f"etapa {len(self._seen) + 1}")
        return df.observe(seen, F.count(F.lit(1)).alias("linhas"))

    def losses(self, spark: SparkSession) -> DataFrame:
        """The rows of :func:`row_loss_guard`; the result must have been written."""
        rows, before = [], None
        for number, (name, seen) in enumerate(self._seen.items(), start=1):
            count = seen.get["linhas"]
            rows.append((number, name, count, (count if before is None else before) - count))
            before = count
        return spark.createDataFrame(rows, "ordem int, etapa string, linhas bigint, perda bigint")


def reconcile(
    metrics: DataFrame, expected: DataFrame, metric: str, value: str, published: str, tolerance: float
) -> DataFrame:
    """Computed against published values: difference, relative difference, verdict.

    ``expected`` has one row per metric.  A metric missing on either side fails.
    """
    joined = full_join(metrics, small_side(expected), [metric])
    gap = F.col(value) - F.col(published)
    relative = F.try_divide(F.abs(gap), F.abs(published))
    return joined.withColumns({"diferenca": gap, "diferenca_relativa": relative}).withColumn(
        "confere",
        F.coalesce((F.col("diferenca_relativa") <= tolerance) | (F.col("diferenca") == 0), F.lit(False)),
    )


def components_add_up(
    df: DataFrame, parts: Sequence[str], total: str, tolerance: float = 0.0
) -> DataFrame:
    """The sum of the parts, its gap to the total, and whether both agree."""
    added = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in parts])
    return df.withColumn("diferenca", added - F.col(total)).withColumn(
        "confere", F.coalesce(F.abs("diferenca") <= tolerance, F.lit(False))
    )


def null_profile(df: DataFrame, by: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Percentage of NULL per group and column, one row each."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    names = df.select(*keys).columns
    shares = df.groupBy(*keys).agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("coluna"),
                    (F.count_if(F.col(name).isNull()) / F.count(F.lit(1)) * 100).alias("pct_nulo"),
                )
                for name in columns
            ]
        ).alias("_shares")
    )
    return shares.select(*names, F.inline("_shares"))


def level_overlap_check(df: DataFrame, id_column: str, measure: str) -> DataFrame:
    """Rows and sum of each territorial level stored in one table.

    When the levels agree, the table repeats the same facts and must not be
    summed as a whole; ``soma_indevida`` is what such a sum would give.
    """
    ident = F.col(id_column)
    level = (
        F.when(ident == COUNTRY_ID, "pais").when(F.length(ident) == 2, "estado").otherwise("municipio")
    )
    levels = df.groupBy(level.alias("nivel")).agg(
        F.count(F.lit(1)).alias("linhas"), money(measure).alias("_soma")
    )
    compared = with_total(
        levels,
        {
            "soma_indevida": F.sum("_soma").cast("double"),
            "niveis_conferem": F.max("_soma") == F.min("_soma"),
        },
    )
    return compared.withColumn("soma", F.col("_soma").cast("double")).drop("_soma")


def dq_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule (a rule that is unknown is broken), in one scan."""
    counts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("regra"),
                    F.count_if(~F.coalesce(rule, F.lit(False))).alias("violacoes"),
                    F.count(F.lit(1)).alias("linhas"),
                )
                for name, rule in rules.items()
            ]
        ).alias("_rules")
    )
    return counts.select(F.inline("_rules"))


def string_nullable(column: str, required: bool) -> Column:
    """Rule: text is never blank, and never NULL if ``required``."""
    filled = F.trim(F.col(column)) != ""
    return filled if required else F.col(column).isNull() | filled


def valid_date_format(column: str, pattern: str) -> Column:
    """Rule: NULL or a date in ``pattern``."""
    return F.col(column).isNull() | F.try_to_date(F.col(column), pattern).isNotNull()


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1")


def diagnose_zeros(
    territory: DataFrame, panel: DataFrame, source: DataFrame, on: str, value: str
) -> DataFrame:
    """Why a municipality shows nothing: a true zero, a loss on the way, or no source.

    ``panel`` has at most one row per place, ``source`` any number.
    """
    places = territory.where(F.length("id") == 7).select(F.col("id").alias(on), "municipio")
    shown = panel.select(on, F.col(value).alias("_value"), F.lit(True).alias("_shown"))
    fed = source.select(on).distinct().withColumn("_fed", F.lit(True))
    joined = places.join(within(shown, places, on), on, "left").join(within(fed, places, on), on, "left")
    verdict = (
        F.when(F.col("_fed").isNull(), "sem fonte")
        .when(F.col("_shown").isNull() | F.col("_value").isNull(), "perda no pipeline")
        .when(F.col("_value") == 0, "zero real")
        .otherwise("com valor")
    )
    return joined.select(on, "municipio", verdict.alias("diagnostico"))


def edition_guard(df: DataFrame, entity: str, edition: str | Column, amount: str) -> DataFrame:
    """Entities in several editions, and the amount that ignoring the edition adds.

    The excess is the entity's total less the total of its largest edition.
    """
    key = F.col(edition) if isinstance(edition, str) else edition
    per_edition = df.groupBy(entity, key.alias("_edicao")).agg(money(amount).alias("_soma"))
    grouped = per_edition.groupBy(entity).agg(
        F.count(F.lit(1)).alias("edicoes"),
        F.sum("_soma").cast("double").alias("total"),
        (F.sum("_soma") - F.max("_soma")).cast("double").alias("excedente"),
    )
    return grouped.where("edicoes > 1")


def fanout_guard(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join keys that multiply left rows: multiplicity and the rows they would add."""
    keys = list(keys)
    repeated = unique_key(right, keys).withColumnRenamed("linhas", "multiplicidade")
    hit = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas_esquerda"))
    added = F.col("linhas_esquerda") * (F.col("multiplicidade") - 1)
    return hit.join(repeated, keys).withColumn("linhas_extras", added)


def migrated_entities(df: DataFrame, person: str, state: str) -> DataFrame:
    """How far the sum over states exceeds the distinct people, as one row.

    Every person is reduced to a number of states first, which is the only shuffle
    on people.
    """
    pairs = df.where(F.col(person).isNotNull() & F.col(state).isNotNull())
    people = pairs.select(state, person).distinct().groupBy(person).agg(
        F.count(F.lit(1)).alias("_states")
    )
    return people.agg(
        F.sum("_states").alias("soma_estados"),
        F.count(F.lit(1)).alias("pessoas"),
        F.count_if(F.col("_states") > 1).alias("em_varios_estados"),
        (F.sum("_states") - F.count(F.lit(1))).alias("excedente"),
    )


