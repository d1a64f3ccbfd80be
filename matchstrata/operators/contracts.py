"""Data contracts: rules evaluated together, reported together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import finished, not_integral
from ..schema import AWAY_WIN, DRAW, FINISHED_STATUSES, HOME_WIN

VIOLATION_SCHEMA = "rule string, `column` string, n_failed bigint, sample string"


#: Failing cases that are shown for each rule.
CASES = 5


class ContractViolation(ValueError):
    """Raised once, with every rule that failed."""

    def __init__(self, contract: str, failures: Sequence, cases: Sequence = ()):
        self.contract = contract
        self.failures = list(failures)
        #: Failing cases, at most ``CASES`` a rule, each as (rule, column, place, shown).
        self.cases = list(cases)
        lines = [
            f"{f['rule']}({f['column']}): {f['n_failed']} rows, e.g. {f['sample']}"
            for f in self.failures
        ]
        super().__init__(f"contract '{contract}' violated: " + "; ".join(lines))


@dataclass(frozen=True)
class Required:
    """A column the frame must have, castable to ``dtype``."""

    name: str
    dtype: str
    nullable: bool = False
    at_least: int | None = None
    one_of: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Contract:
    """Required columns, row conditions (SQL text or columns) and unique keys.

    Other columns may be there too. A NULL fails only the not-null rule: value
    rules and row conditions skip it.
    """

    name: str
    columns: tuple[Required, ...] = ()
    rows: Mapping[str, str | Column] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()

    def _missing(self, df: DataFrame) -> list[str]:
        return [c.name for c in self.columns if c.name not in df.columns]

    def _row_rules(self, df: DataFrame) -> list[tuple[str, str, Column, Column]]:
        """(rule, column, failed, shown) for each rule one row can break."""
        rules = []
        for spec in self.columns:
            if spec.name not in df.columns:
                continue
            raw = F.col(f"`{spec.name}`")
            shown = raw.cast("string")
            value = raw
            if df.schema[spec.name].dataType.simpleString() != spec.dtype:
                value = raw.try_cast(spec.dtype)
                rules.append(("castable", spec.name, raw.isNotNull() & value.isNull(), shown))
            if not spec.nullable:
                rules.append(("not_null", spec.name, raw.isNull(), F.lit("NULL")))
            if spec.at_least is not None:
                rules.append((f"at_least_{spec.at_least}", spec.name, value < spec.at_least, shown))
            if spec.one_of is not None:
                rules.append(("one_of", spec.name, ~value.isin(*spec.one_of), shown))
        for rule, condition in self.rows.items():
            # A whole-row condition is only evaluated where its columns exist.
            key = self.unique[0] if self.unique else [c.name for c in self.columns[:1]]
            key = [F.col(f"`{k}`").cast("string") for k in key if k in df.columns]
            shown = F.concat_ws("|", *key) if key else F.lit("")
            met = F.expr(condition) if isinstance(condition, str) else condition
            rules.append((rule, "*", ~met, shown))
        return rules

    def violations(self, df: DataFrame) -> DataFrame:
        """One row per broken rule: rule, column, failing rows, smallest sample.

        All row rules share one aggregation over one scan; each unique key adds
        one grouping with map-side partials.
        """
        spark = df.sparkSession
        missing = self._missing(df)
        parts = []
        if missing:
            parts.append(
                spark.createDataFrame(
                    [("column_present", c, None, None) for c in missing], VIOLATION_SCHEMA
                )
            )
            # Conditions may name an absent column: only the column rules remain.
            rules = Contract(self.name, self.columns)._row_rules(df)
        else:
            rules = self._row_rules(df)
        if rules:
            parts.append(self._broken_rows(df, rules))
        parts += [self._repeated(df, k) for k in self.unique if not set(k) & set(missing)]
        if not parts:
            return spark.createDataFrame([], VIOLATION_SCHEMA)
        return reduce(DataFrame.unionByName, parts)

    def report(self, df: DataFrame) -> DataFrame:
        """One row for every rule, broken or not: rule, column, failing rows.

        For frames with all columns of the contract.
        """
        rules = self._row_rules(df)
        parts = [self._broken_rows(df, rules, all_rules=True)] if rules else []
        parts += [self._repeated(df, k, all_rules=True) for k in self.unique]
        return reduce(DataFrame.unionByName, parts).select("rule", "column", "n_failed")

    def cases(self, df: DataFrame, n: int = CASES) -> DataFrame:
        """The ``n`` smallest failing cases of each rule: rule, column, place (from 1), shown.

        ``shown`` is the failing value, or the key of a row that breaks a condition;
        a case that several rows share comes once. Failures of all row rules are
        unpivoted in one scan and limited to ``n`` a rule in each task, before they
        are shuffled; so are the keys that occur twice.
        """
        missing = self._missing(df)
        rules = Contract(self.name, self.columns)._row_rules(df) if missing else self._row_rules(df)
        parts = [df.sparkSession.createDataFrame([], "rule string, column string, shown string")]
        if rules:
            each = [
                F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), failed.alias("failed"), shown.alias("shown"))
                for rule, column, failed, shown in rules
            ]
            some = reduce(lambda a, b: a | b, [F.coalesce(failed, F.lit(False)) for _, _, failed, _ in rules])
            failing = df.where(some).select(F.inline(F.array(*each))).where("failed").drop("failed")
            parts.append(failing)
        for key in self.unique:
            if not set(key) & set(missing):
                quoted = [f"`{k}`" for k in key]
                twice = df.groupBy(*quoted).agg(F.count("*").alias("_copies")).where("_copies > 1")
                shown = F.concat_ws("|", *[F.col(k).cast("string") for k in quoted])
                parts.append(twice.select(F.lit("unique").alias("rule"), F.lit("|".join(key)).alias("column"), shown.alias("shown")))
        # Equal cases meet in the aggregation first; of the different ones a window keeps n.
        found = reduce(DataFrame.unionByName, parts).distinct()
        order = Window.partitionBy("rule", "column").orderBy(F.asc_nulls_last("shown"))
        ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
        return ranked.select("rule", "column", "place", "shown")

    def holds(self, df: DataFrame) -> bool:
        return self.violations(df).isEmpty()

    def _broken_rows(self, df: DataFrame, rules, all_rules: bool = False) -> DataFrame:
        measured = []
        for i, (_, _, failed, shown) in enumerate(rules):
            measured.append(F.count_if(failed).alias(f"n{i}"))
            measured.append(F.min(F.when(failed, shown)).alias(f"s{i}"))
        entries = [
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column"),
                F.col(f"n{i}").alias("n_failed"),
                F.col(f"s{i}").alias("sample"),
            )
            for i, (rule, column, _, _) in enumerate(rules)
        ]
        totals = df.agg(*measured)
        found = totals.select(F.inline(F.array(*entries)))
        return found if all_rules else found.where("n_failed > 0")

    def _repeated(self, df: DataFrame, key: Sequence[str], all_rules: bool = False) -> DataFrame:
        quoted = [f"`{k}`" for k in key]
        shown = F.concat_ws("|", *[F.col(k).cast("string") for k in quoted])
        found = (
            df.groupBy(*quoted)
            .agg(F.count("*").alias("_copies"))
            .where("_copies > 1")
            .agg(F.sum("_copies").alias("n_failed"), F.min(shown).alias("sample"))
        )
        found = found.fillna(0, ["n_failed"]) if all_rules else found.where("n_failed IS NOT NULL")
        return found.select(
            F.lit("unique").alias("rule"),
            F.lit("|".join(key)).alias("column"),
            "n_failed",
            "sample",
        )

    def enforce(self, df: DataFrame) -> None:
        """Raise :class:`ContractViolation` naming all broken rules, if any.

        What reaches the driver has at most one row per rule, and then at most
        ``CASES`` cases per rule.
        """
        failures = self.violations(df).collect()
        if failures:
            cases = self.cases(df).orderBy("rule", "column", "place").collect()
            raise ContractViolation(self.name, failures, [tuple(c) for c in cases])


SILVER_MATCHES = Contract(
    "silver_matches",
    columns=(
        Required("event_id", "string"),
        Required("league", "string"),
        Required("home_score", "bigint", at_least=0),
        Required("away_score", "bigint", at_least=0),
        Required("outcome", "string", one_of=(HOME_WIN, AWAY_WIN, DRAW)),
        Required("score_difference", "bigint", at_least=0),
        Required("is_blowout", "boolean"),
    ),
    unique=(("event_id",),),
)

GOLD_STANDINGS = Contract(
    "gold_standings",
    columns=(
        Required("league", "string"),
        Required("team_id", "string"),
        Required("team", "string", nullable=True),
        Required("played", "bigint", at_least=0),
        Required("won", "bigint", at_least=0),
        Required("drawn", "bigint", at_least=0),
        Required("lost", "bigint", at_least=0),
        Required("goals_for", "bigint", at_least=0),
        Required("goals_against", "bigint", at_least=0),
        Required("goal_difference", "bigint"),
        Required("points", "bigint", at_least=0),
    ),
    rows={
        "points_are_3_won_plus_drawn": "points = won * 3 + drawn",
        "played_is_won_drawn_lost": "played = won + drawn + lost",
    },
    unique=(("league", "team_id"),),
)


def whole_numbers(name: str, columns: Sequence[str]) -> Contract:
    """Gate for text columns about to become whole numbers: no fractions."""
    rows = {f"{c}_is_whole": ~not_integral(c) for c in columns}
    return Contract(
        name, columns=tuple(Required(c, "string", nullable=True) for c in columns), rows=rows
    )


def status_counts(
    df: DataFrame, status: str = "status", statuses: Sequence[str] = FINISHED_STATUSES
) -> DataFrame:
    """How many rows are finished and how many pending."""
    done = F.count_if(finished(status, statuses))
    return df.agg(done.alias("finished"), (F.count("*") - done).alias("pending"))


def layer_gap(bronze: DataFrame, silver: DataFrame, status: str = "status") -> DataFrame:
    """Finished bronze rows beside silver rows, and whether the layers agree."""
    counts = bronze.agg(F.count_if(finished(status)).alias("finished"), F.lit(0).alias("refined"))
    kept = silver.agg(F.lit(0).alias("finished"), F.count("*").alias("refined"))
    return (
        counts.unionByName(kept)
        .agg(F.sum("finished").alias("finished"), F.sum("refined").alias("refined"))
        .withColumn("consistent", ~((F.col("finished") > 0) & (F.col("refined") == 0)))
    )


def require_refined(bronze: DataFrame, silver: DataFrame, status: str = "status") -> None:
    """Fail when bronze had finished matches and silver is empty.

    Bronze is only scanned for the rare empty silver.
    """
    if not silver.isEmpty():
        return
    done = bronze.agg(F.count_if(finished(status)).alias("n")).first()["n"]
    if done > 0:
        raise ContractViolation(
            "silver_follows_bronze",
            [{"rule": "not_empty", "column": "*", "n_failed": done,
              "sample": "bronze has finished matches, silver is empty"}],
        )
