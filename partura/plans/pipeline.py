"""The whole derivation, from clinical tables to episodes, as lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from partura.operators import episodes as ep
from partura.operators import outcomes as oc
from partura.operators import starts as st
from partura.operators import timeline as tl
from partura.rules import Rules
from partura.sources import results
from partura.sources.cdm import Cdm
from partura.sources.lookups import Lookups


@dataclass(frozen=True)
class Study:
    """Inputs and settings of one derivation, with its stages as lazy DataFrames."""

    cdm: Cdm
    lookups: Lookups
    rules: Rules
    # The settled runs in a table, as ``save`` leaves them.
    saved: DataFrame | None = None

    @cached_property
    def drug_dimension(self) -> tl.Concepts:
        """Drug concepts, whose size is checked once for all that is derived."""
        return tl.drug_dimension(self.cdm, self.rules)

    @cached_property
    def partitions(self) -> int | None:
        """Partitions for steps that move every person's rows, or none to leave that to Spark."""
        return tl.person_partitions(self.cdm)

    @cached_property
    def numbered(self) -> DataFrame:
        """Everyone's timeline as runs."""
        return tl.numbered_runs(self.cdm, self.rules, concepts=self.drug_dimension)

    @cached_property
    def settled(self) -> DataFrame:
        """Everyone's timeline after date moves."""
        if self.saved is not None:
            return self.saved
        return oc.settled_runs(self.numbered, self.rules)

    def save(self, table: str, buckets: int | None = None) -> "Study":
        """Write the settled runs to ``table``, replacing it, and derive everything after them from it.

        The clinical events are then read once however many results are written. The table is
        bucketed by person, so that no later step by person moves it again: ``buckets`` of them, or
        as many as shuffle partitions, which is how the runs lie already. It holds every column
        that later stages need and may be dropped when they are done.
        """
        spark, runs = self.settled.sparkSession, self.settled
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = self.partitions or own
        if (buckets or own) != dealt or not self.rules.moves_in_rounds:
            runs = runs.repartition(buckets or own, "person_id")
        writer = runs.write.mode("overwrite").bucketBy(buckets or own, "person_id")
        writer.sortBy("person_id", "day").saveAsTable(table)
        return replace(self, saved=spark.table(table))

    @cached_property
    def outcome_runs(self) -> DataFrame:
        """Timeline of people with an outcome event, before date moves."""
        return tl.numbered_runs(
            self.cdm, self.rules, starts_only=True, targets_only=True, concepts=self.drug_dimension
        )

    @cached_property
    def outcome_people(self) -> DataFrame:
        """Settled timeline of people with an outcome event, as the episodes need it."""
        if self.saved is not None:
            return tl.whole_days(self.saved)
        return oc.settled_runs(self.outcome_runs, self.rules)

    @cached_property
    def picked(self) -> DataFrame:
        """Every event that a pass of a step takes up, and what became of it."""
        runs = oc.settled_runs(self.outcome_runs, self.rules, witnesses=True)
        return oc.picked_events(oc.people_with_turns(runs, self.lookups, self.rules))

    @cached_property
    def pool_passes(self) -> DataFrame:
        """Every event of the steps' pools, and the pass in which it leaves."""
        return oc.pool_passes(self.outcome_people, self.picked, self.lookups, self.rules)

    @cached_property
    def outcome_rows(self) -> DataFrame:
        """Accepted outcomes with all that starts are chosen from."""
        return st.outcome_rows(
            self.outcome_people, self.lookups, self.rules, markers=st.DEFAULT_MARKERS
        )

    def outcomes_with(
        self, evidence: tuple[str, ...] = (), markers: tuple[str, ...] = ()
    ) -> DataFrame:
        """Accepted outcomes with no more than these kinds of evidence and markers."""
        return st.outcome_rows(self.outcome_people, self.lookups, self.rules, evidence, markers)

    @cached_property
    def picks(self) -> DataFrame:
        return st.picked_starts(self.outcome_rows, self.lookups, self.rules, self.partitions)

    @cached_property
    def best(self) -> DataFrame:
        return ep.best_episodes(self.picks, self.rules, self.lookups.can_share_day(self.rules))

    @cached_property
    def enrolled(self) -> DataFrame:
        best, large = self.best, self.partitions is not None
        if large and any(st.borrows(rule, self.rules) for rule in self.rules.start_rules):
            best = best.repartition(self.partitions, "person_id")  # back from the lanes
        return ep.enrolled(best, self.cdm, large)

    @cached_property
    def eligible(self) -> DataFrame:
        return ep.eligible(self.enrolled, self.cdm, self.rules, self.partitions is not None)

    @cached_property
    def numbered_episodes(self) -> DataFrame:
        return ep.numbered(self.eligible)

    @cached_property
    def supported_episodes(self) -> DataFrame:
        return ep.with_two_events(self.numbered_episodes)


@dataclass(frozen=True)
class Episodes:
    """Results; each is lazy and reads its inputs when it is written or collected."""

    episodes: DataFrame
    all_starts: DataFrame
    valid_outcomes: DataFrame
    timeline: DataFrame


def study(cdm: Cdm, lookups: Lookups | None = None, rules: Rules | None = None) -> Study:
    rules = rules or Rules()
    return Study(cdm, (lookups or Lookups()).check(rules.targets), rules)


def build_episodes(
    cdm: Cdm,
    lookups: Lookups | None = None,
    rules: Rules | None = None,
    stage_table: str | None = None,
    buckets: int | None = None,
) -> Episodes:
    """Declare the derivation. Nothing runs here but, for vocabularies whose size the plan cannot
    bound, one count each.

    With ``stage_table`` the timeline is written there first, once for all four results, in
    ``buckets`` by person; without it each result reads the clinical events when it is asked for.
    """
    s = study(cdm, lookups, rules)
    if stage_table is not None:
        s = s.save(stage_table, buckets)
    return Episodes(
        episodes=ep.final_episodes(s.supported_episodes, s.rules),
        all_starts=ep.all_starts(s.picks, s.rules),
        valid_outcomes=oc.valid_outcomes(s.outcome_people, s.lookups, s.rules),
        timeline=tl.event_timeline(s.settled),
    )


def run(
    spark: SparkSession,
    cdm: Cdm,
    table: str,
    lookups: Lookups | None = None,
    rules: Rules | None = None,
    mode: str = "append",
    stage_table: str | None = None,
) -> Episodes:
    """Derive the episodes and write them to ``table``; returns all results, still lazy.

    Without ``lookups`` those beside the result table are used where ``results.init`` wrote them, and
    a ``cdm`` without a concept set takes the one there. With ``stage_table`` the other results
    come from that table when they are asked for, not from the clinical events again. Where both
    tables have as many buckets, the episodes need no shuffle on their way either.
    """
    schema = table.rpartition(".")[0]
    if lookups is None:
        lookups = results.find_lookups(spark, schema)
    if cdm.pregnancy_concepts is None:
        cdm = replace(cdm, pregnancy_concepts=results.load_concepts(spark, schema))
    done = build_episodes(cdm, lookups, rules, stage_table, results.buckets(spark, table))
    results.write_episodes(done.episodes, table, mode)
    return done
