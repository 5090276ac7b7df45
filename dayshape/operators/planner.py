"""Planner queries as SQL text over the star, with named parameter markers.

A value never becomes part of the text: it is bound to its marker and only ever compared. Names of
tables and columns come from the star and the ``Spec``, never from whoever asks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayshape.operators.star import Star, quoted
from dayshape.spec import Spec


def rounded(value: str, places: int) -> str:
    """SQL for half-up rounding through a decimal."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, {places + 4})), {places}) AS DOUBLE)"


def whole(value: object, marker: str) -> int:
    """A number for a marker. Text is refused, whatever it holds, and so are fractions."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{marker} takes a whole number, not {value!r}")
    return value


class Planner:
    """The queries a planner asks of one star.

    The star's tables are registered as views under names of their own, so several planners can
    live in one session; `close` drops the views and nothing else.
    """

    def __init__(self, spark: SparkSession, star: Star, spec: Spec, flow: str | None = None) -> None:
        self.spark, self.spec, self.flow = spark, spec, flow
        self.views: dict[str, str] = {}
        for name, table in star.tables().items():
            view = f"{name}_{uuid.uuid4().hex}"
            table.createOrReplaceTempView(view)
            self.views[name] = view
        self.kind = star.profile.schema[spec.entity].dataType.simpleString()

    def close(self) -> None:
        for view in self.views.values():
            self.spark.catalog.dropTempView(view)

    def ask(self, text: str, args: Mapping[str, object]) -> DataFrame:
        """Run a text in which {table} and {column} roles are named and values are markers."""
        s = self.spec
        names = self.views | {
            "entity": s.entity, "slot": s.slot, "klass": s.klass, "authority": s.authority,
            "region": s.region, "region_name": s.region_name, "period": s.period, "flow": self.flow or "",
        }
        return self.spark.sql(text.format(**{k: quoted(v) for k, v in names.items()}), args=dict(args))

    def entity_profile(self, entity_id: str, min_observations: int = 1) -> DataFrame:
        """The day of one entity. Any text may be given as its id.

        The typed comparison reads one bucket of the stored tables; the comparison as text tells
        7 from 007.
        """
        as_text = "" if self.kind == "string" else " AND CAST(p.{entity} AS STRING) = :id"
        typed = ":id" if self.kind == "string" else f"try_cast(:id AS {self.kind})"
        return self.ask(
            f"""
            SELECT p.{{slot}}, p.observations, {rounded('p.mean_measure', 1)} AS mean_measure,
                   {rounded('p.peak_index', 3)} AS peak_index, e.{{authority}}, e.{{klass}}
            FROM {{fact_profile}} p JOIN {{dim_entity}} e ON e.{{entity}} = p.{{entity}}
            WHERE p.{{entity}} = {typed}{as_text} AND p.observations >= :least
            ORDER BY p.{{slot}}
            """,
            {"id": str(entity_id), "least": whole(min_observations, "min_observations")},
        )

    def class_peak(self, min_observations: int = 5) -> DataFrame:
        """When each class peaks and how sharply, over sufficiently observed profile rows."""
        return self.ask(
            f"""
            SELECT e.{{klass}}, p.{{slot}}, count(*) AS links,
                   {rounded('avg(p.peak_index)', 4)} AS mean_peak_index,
                   {rounded('avg(p.mean_measure)', 1)} AS mean_measure
            FROM {{fact_profile}} p JOIN {{dim_entity}} e ON e.{{entity}} = p.{{entity}}
            WHERE p.observations >= :least
            GROUP BY e.{{klass}}, p.{{slot}} ORDER BY e.{{klass}}, p.{{slot}}
            """,
            {"least": whole(min_observations, "min_observations")},
        )

    def sharpest(self, columns: tuple[str, ...], limit: int = 10, min_observations: int = 5) -> DataFrame:
        """The profile rows with the highest index, with dimension columns; ties by entity and slot."""
        shown = ", ".join(f"e.{quoted(c)}" for c in columns).replace("{", "{{").replace("}", "}}")
        return self.ask(
            f"""
            SELECT {shown}, p.{{slot}} AS peak_slot, {rounded('p.peak_index', 3)} AS peak_index,
                   {rounded('p.mean_measure', 1)} AS peak_measure, p.observations
            FROM {{fact_profile}} p JOIN {{dim_entity}} e ON e.{{entity}} = p.{{entity}}
            WHERE p.observations >= :least
            ORDER BY p.peak_index DESC NULLS LAST, p.{{entity}}, p.{{slot}}
            LIMIT :most
            """,
            {"least": whole(min_observations, "min_observations"), "most": whole(limit, "limit")},
        )

    def annual_trend(self, first_period: int = 2000, last_period: int = 2025) -> DataFrame:
        """Entities and mean flow per period, over the known flows."""
        return self.ask(
            f"""
            SELECT {{period}}, count(*) AS links, {rounded('avg({flow})', 1)} AS mean_flow
            FROM {{fact_annual}}
            WHERE {{period}} BETWEEN :first AND :last AND {{flow}} IS NOT NULL
            GROUP BY {{period}} ORDER BY {{period}}
            """,
            {"first": whole(first_period, "first_period"), "last": whole(last_period, "last_period")},
        )

    def region_summary(self, min_links: int = 1) -> DataFrame:
        """Entities, unweighted mean level and sharpest index of each region.

        The profile is folded to one row per entity before regions are attached.
        """
        return self.ask(
            f"""
            WITH days AS (
              SELECT {{entity}}, sum(mean_measure) AS level_sum, count(mean_measure) AS level_rows,
                     max(peak_index) AS sharpest
              FROM {{fact_profile}} GROUP BY {{entity}})
            SELECT r.{{region_name}}, count(*) AS entities,
                   {rounded('sum(level_sum) / sum(level_rows)', 1)} AS mean_measure,
                   {rounded('max(sharpest)', 3)} AS sharpest_peak_index
            FROM days d JOIN {{dim_entity}} e ON e.{{entity}} = d.{{entity}}
              JOIN {{dim_region}} r ON r.{{region}} = e.{{region}}
            GROUP BY r.{{region_name}} HAVING count(*) >= :least
            ORDER BY mean_measure DESC, r.{{region_name}}
            """,
            {"least": whole(min_links, "min_links")},
        )


def rows_per_id(rows: DataFrame, key: str, ids: Sequence[str]) -> DataFrame:
    """(id, n_rows): how many rows have a key that reads as the given text, in one pass.

    The texts are one argument of the query, an array; texts that are no value of the key's type
    match nothing.
    """
    view = f"rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    kind, name = rows.schema[key].dataType.simpleString(), quoted(key)
    try:
        return rows.sparkSession.sql(
            f"""
            WITH given AS (SELECT explode(:ids) AS id),
            found AS (
              SELECT {name} AS key, count(*) AS n FROM {quoted(view)}
              WHERE array_contains(transform(:ids, x -> try_cast(x AS {kind})), {name})
              GROUP BY {name})
            SELECT id, coalesce(n, 0) AS n_rows FROM given
            LEFT JOIN found ON key = try_cast(id AS {kind}) AND CAST(key AS STRING) = id
            """,
            args={"ids": F.array(*[F.lit(str(x)) for x in ids])},
        )
    finally:
        rows.sparkSession.catalog.dropTempView(view)


@contextmanager
def planner(spark: SparkSession, star: Star, spec: Spec, flow: str | None = None) -> Iterator[Planner]:
    """A planner whose views are dropped at the end; plans made before stay usable."""
    made = Planner(spark, star, spec, flow)
    try:
        yield made
    finally:
        made.close()
