"""Clinical thresholds and rule tables, all overridable by the caller."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class OutcomeStep:
    """How one outcome type is accepted. Steps run in the order they are listed.

    ``moved_by``: the outcome takes the latest date of these categories within
    ``Rules.revision_days``. ``confirmed_by``: one of these must lie in the same window.
    ``rule_out``: an active-pregnancy record soon after the outcome refutes it.
    ``forward_only``: only the gap from an earlier accepted outcome is checked.
    """

    target: str
    pool_extra: tuple[str, ...] = ()
    moved_by: tuple[str, ...] = ()
    confirmed_by: tuple[str, ...] = ()
    rule_out: bool = True
    forward_only: bool = False


@dataclass(frozen=True)
class StartRule:
    """One kind of start evidence: start = record day + ``shift``; GEST shifts by its own value."""

    name: str
    categories: tuple[str, ...]
    shift: int | None
    latest: bool
    rank: int | None


# Outcome priority and the categories each step looks at.
STEPS = (
    OutcomeStep("LB", rule_out=False, forward_only=True),
    OutcomeStep("SB", pool_extra=("AGP", "PCONF")),
    OutcomeStep(
        "ECT",
        pool_extra=("AGP", "PCONF", "ECT_SURG1", "ECT_SURG2", "MTX"),
        moved_by=("ECT_SURG1", "MTX"),
        confirmed_by=("ECT_SURG1", "ECT_SURG2", "MTX"),
    ),
    OutcomeStep("AB", pool_extra=("AGP", "PCONF"), moved_by=("SA", "AB")),
    OutcomeStep("SA", pool_extra=("AGP", "PCONF"), moved_by=("SA", "AB")),
    OutcomeStep("DELIV", pool_extra=("AGP", "PCONF")),
)

# Start evidence, days from record to start, pick and rank.
START_RULES = (
    StartRule("LMP", ("LMP",), 0, True, 1),
    StartRule("GEST", ("GEST",), None, True, 2),
    StartRule("OVUL", ("OVUL",), -13, False, 3),
    StartRule("OVUL2", ("OVUL2",), -13, False, 4),
    StartRule("NULS", ("NULS",), -89, False, 6),
    StartRule("AFP", ("AFP",), -123, False, 7),
    StartRule("AMEN", ("AMEN",), -55, False, 80),
    StartRule("UP", ("UP",), -55, False, 90),
    StartRule("PUSHBACK", ("PCONF", "AGP", "PCOMP", "TA"), -55, False, None),
    StartRule("CONTRA", ("CONTRA",), 0, True, None),
)


@dataclass(frozen=True)
class Rules:
    """Every tunable of the algorithm with its published default."""

    # Fixed values.
    max_gestation_days: int = 301
    drug_categories: tuple[str, ...] = ("CONTRA", "MTX", "OVULDR")
    drug_classes: tuple[str, ...] = (
        "Branded Drug",
        "Branded Pack",
        "Clinical Drug",
        "Clinical Pack",
        "Ingredient",
    )
    screening_category: str = "DIAB"
    active_categories: tuple[str, ...] = ("AGP", "PCONF")
    rule_out_days: int = 42
    revision_days: int = 14
    marker_days_after: int = 30
    default_rank: int = 99
    refine_above_rank: int = 7
    female_concept_id: int = 8532
    min_age: int = 12
    max_age: int = 55
    short_stillbirth_days: int = 140

    steps: tuple[OutcomeStep, ...] = STEPS
    start_rules: tuple[StartRule, ...] = START_RULES

    # "reference": second-ovulation evidence is bounded by the prior outcome of the person whose
    # id equals the event number. "corrected": bounded by the person's own prior outcome.
    ovul2_join: str = "reference"
    # Compare concept data values ignoring case and trailing blanks.
    normalize_values: bool = False
    # Plan-size bound under which a dimension is broadcast, and the row bound that is counted
    # (once) when the plan estimate alone cannot prove it.
    broadcast_bytes: int = 64 * 1024 * 1024
    broadcast_rows: int = 500_000
    # Read the coded domains once more, for outcome concepts alone, and leave out rows of people
    # without any before they are counted. Pays where few of the people have an outcome.
    early_people: bool = False
    # Concept ids up to which the scans of clinical tables filter by them.
    scan_ids: int = 10_000

    def __post_init__(self) -> None:
        if self.ovul2_join not in ("reference", "corrected"):
            raise ValueError(f"ovul2_join must be 'reference' or 'corrected', not {self.ovul2_join!r}")

    @property
    def moves_in_rounds(self) -> bool:
        """Whether moves and verdicts are windows over days, a few for all steps together.

        That takes confirmations from the unmoved timeline and rule-outs from the fully moved one,
        so no step may be confirmed by a type that moved before, and no active category may move.
        """
        moved: set[str] = set()
        for step in self.steps:
            if moved & set(step.confirmed_by):
                return False
            if step.moved_by:
                moved.add(step.target)
        return not moved & set(self.active_categories)

    @property
    def targets(self) -> tuple[str, ...]:
        return tuple(step.target for step in self.steps)

    def step(self, target: str) -> OutcomeStep:
        return next(step for step in self.steps if step.target == target)

    def through(self, target: str) -> tuple[str, ...]:
        """Targets of all steps up to and including ``target``."""
        return self.targets[: self.targets.index(target) + 1]

    def start_rule(self, name: str) -> StartRule:
        return next(rule for rule in self.start_rules if rule.name == name)
