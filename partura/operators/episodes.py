"""From outcomes with starts to the final episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partura.functions.days import to_date, to_day
from partura.operators.starts import with_starts
from partura.rules import Rules
from partura.sources.cdm import Cdm

EPISODE_SCHEMA = (
    "person_id bigint not null, episode_start_date date not null, episode_end_date date not null, "
    "start_method string not null, original_outcome string not null, episode int not null, "
    "outcome string not null, episode_length int"
)


def all_starts(picks: DataFrame, rules: Rules) -> DataFrame:
    """Every candidate episode: each outcome with each of its starts, refined ones included."""
    starts = "array_distinct(concat(starts, array_compact(array(refined))))"
    return (
        with_starts(picks, rules)
        .selectExpr("person_id", "day AS end_day", "category", f"explode_outer({starts}) AS s")
        .filter("s IS NOT NULL")
        .select(
            "person_id",
            to_date(F.col("s.day")).alias("episode_start_date"),
            to_date(F.col("end_day")).alias("episode_end_date"),
            F.col("s.label").alias("start_category"),
            F.col("category").alias("outcome_category"),
            F.col("s.rank").alias("rank"),
        )
    )


def best_episodes(picks: DataFrame, rules: Rules, share_day: bool = False) -> DataFrame:
    """One episode per outcome day: the start of lowest rank.

    Accepted outcomes of a person that never share a day need no comparison between rows; with
    ``share_day`` the best start of those that do is taken, at equal ranks that of the lower event
    number. The start leaves through a generator: the later joins test its day, and a null test
    derived from them would otherwise be pushed down as a second copy of the whole choice.
    """
    starts = with_starts(picks, rules)
    if share_day:
        own = ("event_id", "category", "has_two_events")
        first = F.min(F.struct(F.least("refined", "best").alias("start"), *own)).alias("one")
        starts = (
            starts.groupBy("person_id", "day")
            .agg(first)
            .select("person_id", "day", "one.*")
            .select("*", F.col("start").alias("best"), F.col("start").alias("refined"))
        )
    return (
        starts
        .selectExpr(
            "person_id", "day AS end_day", "category AS outcome_category", "has_two_events",
            "inline_outer(array(least(refined, best)))",
        )
        .selectExpr(
            "person_id", "day AS start_day", "end_day", "label AS start_category",
            "outcome_category", "has_two_events",
        )
    )


def _with_person(episodes: DataFrame, own: DataFrame, large: bool) -> DataFrame:
    """Episodes joined to rows of their person. Estimates go by compressed columns, by which millions
    of people may seem small enough for a broadcast, so with ``large`` both sides are merged."""
    return episodes.join(own.hint("merge") if large else own, "person_id")


def enrolled(episodes: DataFrame, cdm: Cdm, large: bool = False) -> DataFrame:
    """Episodes inside an observation period, once for each period that holds one."""
    periods = cdm.observation_period.select(
        F.col("person_id").cast("long").alias("person_id"),
        to_day(F.col("observation_period_start_date")).alias("from_day"),
        to_day(F.col("observation_period_end_date")).alias("to_day"),
    )
    inside = (F.col("from_day") <= F.least("start_day", "end_day")) & (
        F.col("end_day") <= F.col("to_day")
    )
    return _with_person(episodes, periods, large).filter(inside)


def eligible(episodes: DataFrame, cdm: Cdm, rules: Rules, large: bool = False) -> DataFrame:
    """Episodes of women whose age in the start year is within bounds."""
    women = cdm.person.filter(F.col("gender_concept_id") == rules.female_concept_id).select(
        F.col("person_id").cast("long").alias("person_id"), "year_of_birth"
    )
    age = F.year(to_date(F.col("start_day"))) - F.col("year_of_birth")
    women = _with_person(episodes, women, large)
    return women.filter(age.between(rules.min_age, rules.max_age))


def numbered(episodes: DataFrame) -> DataFrame:
    """Episode number per person by start; equal rows take consecutive numbers."""
    order = ["start_day", "end_day", "outcome_category", "to_day", "from_day"]
    by_start = Window.partitionBy("person_id").orderBy(*order)
    return episodes.withColumn("episode", F.row_number().over(by_start))


def with_two_events(episodes: DataFrame) -> DataFrame:
    return episodes.filter("has_two_events")


def phenotype(outcome: Column, length: Column, rules: Rules) -> Column:
    """Reported outcome group; a stillbirth after a short pregnancy counts as a loss."""
    loss = outcome.isin("AB", "SA") | (
        (outcome == "SB") & (length < rules.short_stillbirth_days)
    )
    return (
        F.when(loss, "SA/AB").when(outcome.isin("DELIV", "LB"), "LB/DELIV").otherwise(outcome)
    )


def episode_rows(episodes: DataFrame) -> DataFrame:
    """Numbered episodes without the phenotype."""
    return episodes.select(
        "person_id",
        to_date(F.col("start_day")).alias("episode_start_date"),
        to_date(F.col("end_day")).alias("episode_end_date"),
        "start_category",
        "outcome_category",
        "episode",
    )


def final_episodes(episodes: DataFrame, rules: Rules) -> DataFrame:
    length = F.col("end_day") - F.col("start_day") + 1
    return episodes.select(
        "person_id",
        to_date(F.col("start_day")).alias("episode_start_date"),
        to_date(F.col("end_day")).alias("episode_end_date"),
        F.col("start_category").alias("start_method"),
        F.col("outcome_category").alias("original_outcome"),
        "episode",
        phenotype(F.col("outcome_category"), length, rules).alias("outcome"),
        length.alias("episode_length"),
    )
