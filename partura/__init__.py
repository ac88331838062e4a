"""Pregnancy episodes from clinical event tables, as Spark DataFrame operators."""

from partura.plans.pipeline import Episodes, build_episodes, run
from partura.rules import Rules
from partura.sources.cdm import Cdm
from partura.sources.lookups import Lookups

__all__ = ["Cdm", "Episodes", "Lookups", "Rules", "build_episodes", "run"]
