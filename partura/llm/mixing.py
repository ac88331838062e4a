"""Mixing to target weights: iterative proportional fitting over source, language and topic, then sampling.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partura.llm.fingerprints import words
from partura.llm.storage import Workspace

MARGINS = ("source", "lang", "topic")
#: A number tempers the margin's own shares by that power; a mapping states the shares.
TARGETS: dict[str, float | dict[str, float]] = {"source": 0.8, "lang": 0.9, "topic": 1.0}
ROUNDS = 50
TOLERANCE = 1e-6
WHOLE = 0.01  # share of the target weight that cells taken whole may hold where no budget is given
STEPS = 32  # steps of the logarithm by which the common factor is looked for
MISSING = "(none)"
CELLS = 50_000  # cells of which one task holds all
AT_ONCE = 2  # rounds of such cells between two looks at how far they have come


def topic(text: Column) -> Column:
    """What kind of text it is, by the characters it holds: table, marked, shouted, listed or prose."""
    n = F.greatest(F.char_length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return (n - F.char_length(F.regexp_replace(text, pattern, ""))) / n

    return (
        F.when(share("[|]") > 0.02, "table")
        .when(share("[#$%&*!]") > 0.05, "marked")
        .when(share("[A-Z]") > 0.3, "shouted")
        .when(share("\n") > 0.01, "listed")
        .otherwise("prose")
    )


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with `tokens` (words, at least 1) and the margins `_source`, `_lang`, `_topic` without nulls."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = "topic" in docs.columns
    kinds = {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col("topic") if given else topic(text)}
    tokens = F.greatest(F.size(words(text)), F.lit(1)).cast("long")
    named = [F.coalesce(c.cast("string"), F.lit(MISSING)).alias(f"_{m}") for m, c in kinds.items()]
    return docs.drop("tokens", "probability").select("*", tokens.alias("tokens"), *named)


def _target(cells: DataFrame, margin: str, goal: float | dict[str, float]) -> DataFrame:
    """The share of tokens that each value of a margin shall have."""
    if isinstance(goal, dict):
        total = sum(goal.values())
        if total <= 0 or min(goal.values()) < 0:
            raise ValueError(f"target weights of {margin} must not be negative, nor all zero")
        wanted = F.create_map(*[F.lit(x) for k, v in goal.items() for x in (k, v / total)])
        seen = cells.select(f"_{margin}").distinct()
        share = seen.withColumn("t", F.coalesce(F.element_at(wanted, F.col(f"_{margin}")), F.lit(0.0)))
    else:
        own = cells.groupBy(f"_{margin}").agg(F.sum("tokens").cast("double").alias("n"))
        share = own.select(f"_{margin}", F.pow("n", F.lit(float(goal))).alias("t"))
    total = share.agg(F.sum("t").alias("all")).first()["all"] or 1.0
    return share.select(f"_{margin}", (F.col("t") / total).alias(f"t_{margin}"))


def _with_sums(new: DataFrame, margin: str, few: bool) -> DataFrame:
    """`new` with `_sum`, the weight of the cell's value of a margin, and `_whole`, that of its whole cells."""
    whole = "sum(IF(weight >= tokens, weight, 0D))"
    if few:
        value = f"OVER (PARTITION BY _{margin})"
        return new.selectExpr("*", f"sum(weight) {value} AS _sum", f"{whole} {value} AS _whole")
    sums = new.groupBy(f"_{margin}").agg(F.expr("sum(weight) AS _sum"), F.expr(f"{whole} AS _whole"))
    return new.join(sums, f"_{margin}")


def _scaled(goal: str, bound: bool) -> str:
    """A cell's weight after its value's sum is brought to the goal; with `bound` as far as whole cells let it."""
    plain = f"IF(_sum > 0, weight * {goal} / _sum, 0D)"
    if not bound:
        return plain
    raised = f"weight * ({goal} - _whole) / (_sum - _whole)"
    short = f"CASE WHEN weight >= tokens THEN weight WHEN _sum > _whole THEN {raised} END"
    return f"least(IF({goal} > _sum, coalesce({short}, weight), {plain}), CAST(tokens AS DOUBLE))"


def _rounds(ws: Workspace, now: DataFrame, name: str, bound: bool, rounds: int, tolerance: float) -> DataFrame:
    """`now` with `weight` scaled to the goals `t_source`, `t_lang`, `t_topic` in turn; with `bound` to `tokens` at most.

    Rounds end when a whole round changes no weight by more than `tolerance` of itself, or after `rounds`. A bounded value
    that lacks weight gets it from its cells that are not whole yet. Up to CELLS cells, counted first, several rounds are one
    pass of one task over the cells; beyond, sums by a margin are combined before they move, so a
    source with very many cells is one row of them. Either way the weights are the same.
    """
    now = ws.save(now, f"{name}0")
    few = now.count() <= CELLS
    done = 0
    while done < rounds:
        new, last = now.coalesce(1) if few else now, done
        done = min(rounds, done + (AT_ONCE if few else 1))
        for k in range(last, done):
            if k + 1 == done:
                new = new.withColumn("_was", F.col("weight"))
            for m in MARGINS:
                own = [c for c in new.columns if c != "weight"]
                new = _with_sums(new, m, few).selectExpr(*own, f"{_scaled(f't_{m}', bound)} AS weight")
        saved = ws.save(new, f"{name}{done}")
        moved = saved.selectExpr("max(abs(weight - _was) / greatest(_was, 1e-300D)) AS c").first()["c"]
        now = saved.drop("_was")
        ws.drop(f"{name}{last}")
        if done > 1 and (moved is None or moved <= tolerance):
            break
    return now


def rake(
    ws: Workspace, cells: DataFrame, targets: dict = TARGETS, rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """`cells` (_source, _lang, _topic, tokens) with `weight`, whose sums by each margin are its targets `t_source` and so on.

    Where no weights meet all margins, the last margin holds exactly.
    """
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for m in MARGINS:
        now = now.join(_target(cells, m, targets[m]), f"_{m}")
    return _rounds(ws, now, "rake", False, rounds, tolerance)


def _common_factor(raked: DataFrame, whole: float) -> float:
    """The tokens to aim at: the most with which cells that would pass probability 1 hold at most `whole` of the weight."""
    ratio = F.col("weight") / F.col("tokens")
    steps = raked.where("weight > 0").groupBy(F.floor(F.log(ratio) * STEPS).alias("step"))
    steps = steps.agg(F.max(ratio).alias("most"), F.sum("weight").alias("weight"))
    above = Window.orderBy(F.desc("step"))  # one row a step, however many cells
    steps = steps.withColumn("held", F.sum("weight").over(above)).withColumn("all", F.sum("weight").over(Window.partitionBy()))
    most = steps.where(F.col("held") > whole * F.col("all")).agg(F.max("most").alias("m")).first()["m"]
    return 1.0 / most if most else 1.0


def fill(
    ws: Workspace, raked: DataFrame, budget: float, rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """`raked` with weights in tokens that come to `budget` and pass the tokens of no cell.

    A value of a margin with fewer tokens than its share of the budget is taken whole and the others share the rest by
    their targets; the cells are raked again to these goals.
    """
    now = raked.withColumn("weight", F.least(F.col("weight") * budget, F.col("tokens").cast("double")))
    for m in MARGINS:
        t, n = F.col(f"t_{m}"), F.col("n")
        values = raked.groupBy(f"_{m}", f"t_{m}").agg(F.sum("tokens").cast("double").alias("n"))
        values = ws.save(values, f"values_{m}")
        scale, before = float(budget), -1
        while True:
            short = t * scale >= n
            found = values.agg(
                F.sum(F.when(short, n).otherwise(0.0)).alias("whole"),
                F.sum(F.when(short, 0.0).otherwise(t)).alias("rest"),
                F.count_if(short).alias("short"),
            ).first()
            if found["short"] == before or not found["rest"] or budget <= found["whole"]:
                break
            scale, before = max(scale, (budget - found["whole"]) / found["rest"]), found["short"]
        goals = values.select(f"_{m}", F.least(t * scale, n).alias(f"t_{m}"))
        now = now.drop(f"t_{m}").join(goals, f"_{m}")
    return _rounds(ws, now, "fill", True, rounds, tolerance)


def uniform(seed: int) -> Column:
    """A number in [0, 1) that depends on the doc_id (of rows without one, on the text) and the seed alone."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.col("text").cast("string"), 256), F.lit(""))
    digits = F.substr(F.md5(F.concat(key, F.lit(f":{seed}")).cast("binary")), F.lit(1), F.lit(13))
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame,
    targets: dict[str, float | dict[str, float]] = TARGETS,
    budget: float | None = None,
    seed: int = 1,
    ws: Workspace | None = None,
    whole: float = WHOLE,
) -> DataFrame:
    """A sample of `docs` (doc_id, text, source, lang) whose tokens have the target shares, with `topic`, `tokens` and `probability`.

    Token weights are raked to the targets over the cells of source, language and topic (a column `topic`, or the
    kind of text). A document of a cell stays with probability weight / tokens of the cell, times a common factor that gives
    `budget` tokens, or without a budget the most with which cells that would pass probability 1 hold at most `whole` of the
    target weight. Such cells are taken whole and the others raked again under that bound, so a stray cell does not
    set how much of the rest stays. No document is taken twice. The expected tokens by each margin have just the target
    shares, except that values with too few tokens for theirs are whole and the others share the rest. Nulls in a margin
    are a value of their own; a value that a stated target leaves out has weight 0. A document without words counts as one
    token. Rows with the same doc_id stay or go together. An empty table gives no rows.
    """
    ws = ws or Workspace(docs.sparkSession, "mixing")
    full = measured(docs)
    margins = [f"_{m}" for m in MARGINS]
    cells = ws.save(full.groupBy(*margins).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = rake(ws, cells, targets)
    budget = _common_factor(raked, whole) if budget is None else budget
    most = raked.agg(F.max(F.col("weight") / F.col("tokens")).alias("m")).first()["m"] or 1.0
    if budget * most > 1 + 1e-9:
        raked, budget = fill(ws, raked, budget), 1.0
    chances = raked.select(*margins, (F.col("weight") / F.col("tokens") * budget).alias("probability"))
    joined = full.join(chances, margins).where(uniform(seed) < F.col("probability"))
    own = [c for c in docs.columns if c not in ("topic", "tokens", "probability")]
    return joined.select(*own, F.col("_topic").alias("topic"), "tokens", "probability")
