"""The three lookup tables: minimum gaps, term bounds, default gestation."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations_with_replacement, product

from pyspark.sql import DataFrame, SparkSession

from partura.functions.inline import inline_table
from partura.functions.text import listed, lookup
from partura.rules import Rules

OUTCOME_LIMIT_SCHEMA = (
    "outcome_limit_id int, first_preg_category string, outcome_preg_category string, min_days int"
)
TERM_DURATIONS_SCHEMA = "category string, max_term int, min_term int, retry int"
GEST_EST_SCHEMA = (
    "gest_est_id int, category string, preterm int, postterm int, fullterm int, nodata int"
)

# Least days from the first outcome (row) to the later one (column).
GAP_COLUMNS = ("LB", "SB", "DELIV", "TRO", "ECT", "AB", "SA")
GAP_ROWS = {
    "LB": (182, 168, 168, 70, 70, 70, 70),
    "SB": (182, 168, 168, 70, 70, 70, 70),
    "DELIV": (182, 168, 168, 70, 70, 70, 70),
    "TRO": (168, 154, 154, 730, 56, 56, 365),
    "ECT": (168, 154, 154, 365, 56, 56, 56),
    "AB": (168, 154, 154, 365, 56, 56, 56),
    "SA": (168, 154, 154, 365, 56, 56, 56),
}
# Fixed values, in days: max_term, min_term, retry.
TERM_ROWS = {
    "LB": (301, 161, 28),
    "SB": (301, 100, 28),
    "DELIV": (301, 140, 28),
    "TRO": (365, 42, 14),
    "ECT": (84, 42, 14),
    "AB": (168, 42, 14),
    "SA": (139, 28, 14),
}
# Fixed values, in days: preterm, postterm, fullterm, nodata.
GESTATION_ROWS = {
    "LB": (245, 285, 280, 280),
    "SB": (196, 285, 280, 196),
    "DELIV": (245, 285, 280, 280),
    "TRO": (56, 56, 56, 56),
    "ECT": (56, 56, 56, 56),
    "AB": (70, 70, 70, 70),
    "SA": (70, 70, 70, 70),
}
# The row numbers of the gap table leave out these two.
SKIPPED_LIMIT_IDS = (9, 10)


def _default_gaps() -> dict[tuple[str, str], int]:
    return {
        (first, later): days
        for first, row in GAP_ROWS.items()
        for later, days in zip(GAP_COLUMNS, row)
    }


@dataclass(frozen=True)
class Lookups:
    min_days: dict[tuple[str, str], int] = field(default_factory=_default_gaps)
    terms: dict[str, tuple[int, int, int]] = field(default_factory=lambda: dict(TERM_ROWS))
    gestation: dict[str, tuple[int, int, int, int]] = field(
        default_factory=lambda: dict(GESTATION_ROWS)
    )

    def check(self, targets: tuple[str, ...]) -> "Lookups":
        """Raise unless every outcome type has its terms and evidence lies before its outcome.

        A start must lie after the prior outcome (retry of at least 1) and not after its own
        (min_term of at least 0). Gaps may be short or missing; see ``can_share_day``.
        """
        for target in targets:
            if target not in self.terms or target not in self.gestation:
                raise ValueError(f"term_durations and gest_est need a row for {target}")
            max_term, min_term, retry = self.terms[target]
            if retry < 1 or min_term < 0 or max_term < min_term:
                raise ValueError(f"term_durations row for {target} is out of order")
        return self

    def can_share_day(self, rules: Rules) -> bool:
        """Whether two accepted outcomes of a person can lie on one day.

        They do where the gap from the type accepted first is under 2 or does not count: it counts
        if the table has it, and outside forward-only steps only if it has the other order too.
        """
        for first, later in combinations_with_replacement(rules.targets, 2):
            least = self.min_days.get((first, later))
            if least is None or least < 2:
                return True
            if not rules.step(later).forward_only and (later, first) not in self.min_days:
                return True
        return False

    @classmethod
    def from_frames(
        cls, outcome_limit: DataFrame, term_durations: DataFrame, gest_est: DataFrame
    ) -> "Lookups":
        """Read lookups from tables, one row per outcome type or pair of them; a second one raises."""

        def rows(df: DataFrame, *keys: str) -> list:
            twice = df.groupBy(*keys).count().filter("count > 1").drop("count").take(1)
            if twice:
                raise ValueError(f"lookup table has more than one row for {tuple(twice[0])}")
            return df.collect()

        return cls(
            {
                (r.first_preg_category, r.outcome_preg_category): r.min_days
                for r in rows(outcome_limit, "first_preg_category", "outcome_preg_category")
            },
            {r.category: (r.max_term, r.min_term, r.retry) for r in rows(term_durations, "category")},
            {
                r.category: (r.preterm, r.postterm, r.fullterm, r.nodata)
                for r in rows(gest_est, "category")
            },
        )

    @classmethod
    def from_csv(cls, spark: SparkSession, directory: str) -> "Lookups":
        """Read ``outcome_limit.csv``, ``term_durations.csv`` and ``gest_est.csv``."""

        def table(name: str, schema: str) -> DataFrame:
            return spark.read.schema(schema).csv(f"{directory}/{name}.csv", header=True)

        return cls.from_frames(
            table("outcome_limit", OUTCOME_LIMIT_SCHEMA),
            table("term_durations", TERM_DURATIONS_SCHEMA),
            table("gest_est", GEST_EST_SCHEMA),
        )

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The lookups as DataFrames, in the layout of their CSV files."""
        ids = (n for n in range(1, len(self.min_days) + 3) if n not in SKIPPED_LIMIT_IDS)
        return {
            "outcome_limit": inline_table(
                spark,
                [(n, *pair, days) for n, (pair, days) in zip(ids, self.min_days.items())],
                OUTCOME_LIMIT_SCHEMA,
            ),
            "term_durations": inline_table(
                spark,
                [(category, *row) for category, row in self.terms.items()],
                TERM_DURATIONS_SCHEMA,
            ),
            "gest_est": inline_table(
                spark,
                [(n, category, *row) for n, (category, row) in enumerate(self.gestation.items(), 1)],
                GEST_EST_SCHEMA,
            ),
        }

    # The same tables as SQL text, so that using them needs no join.

    def gap(self, targets: tuple[str, ...], first: str, later: str) -> str:
        """Minimum days between two outcomes given by their position in ``targets``."""
        flat = listed(self.min_days.get(pair) for pair in product(targets, repeat=2))
        return f"get(array({flat}), {first} * {len(targets)} + {later})"

    def term(self, column: str, category: str) -> str:
        position = ("max_term", "min_term", "retry").index(column)
        return lookup({c: row[position] for c, row in self.terms.items()}, category)

    def default_days(self, column: str, category: str) -> str:
        position = ("preterm", "postterm", "fullterm", "nodata").index(column)
        return lookup({c: row[position] for c, row in self.gestation.items()}, category)
