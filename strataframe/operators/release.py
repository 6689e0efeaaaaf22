"""A privacy policy compiled into one ordered plan, and what a release gives away beside an earlier one.

The plan has two levels.  Row steps see single records, since they need exact ages and dates; then
the records become cells, and every cell step relabels cells and adds them up again.  Each cell
carries the names of the rules that touched any of its records.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.operators.privacy import ADULT_AGE, MIN_CELL, apply_policy, merge_small_cells, release_statistics
from strataframe.session import cut_lineage
from strataframe.spec import PrivacyPolicy, Rollup

N, RULES = "n", "_rules"


class Step(NamedTuple):
    """One rule of a compiled policy; ``level`` is "row" or "cell"."""

    name: str
    level: str
    apply: Callable[[DataFrame], DataFrame]


def compile_policy(policy: PrivacyPolicy, population: DataFrame | None = None) -> list[Step]:
    """The steps of a policy in the order in which they are safe.

    Minors need the exact age and come before it is grouped; records become cells only then.  Rare
    details are judged by the places as recorded, then small places report under their parent, then
    groups that are still too small, and last the cells that no hierarchy helped are pooled.
    ``population`` has the place column and ``poblacion``.
    """
    hierarchies = [r for r in policy.rollups if r.scope is not None], [r for r in policy.rollups if r.scope is None]
    names = rule_names(policy)
    if len(set(names)) < len(names):
        raise ValueError("rules must have names of their own")
    steps = []
    if policy.minors:
        steps.append(Step("minors", "row", lambda df: _minors(df, policy, names.index("minors"))))
    steps.append(Step("generalise", "row", lambda df: apply_policy(df, policy)))
    steps += [Step(r.name, "cell", lambda df, r=r: _roll(df, policy, r, names.index(r.name))) for r in hierarchies[0]]
    if policy.places:
        steps.append(Step("places", "cell", lambda df: _small_places(df, policy, population, names.index("places"))))
    steps += [Step(r.name, "cell", lambda df, r=r: _roll(df, policy, r, names.index(r.name))) for r in hierarchies[1]]
    if policy.others:
        steps.append(Step("others", "cell", lambda df: _others(df, policy, names.index("others"))))
    return steps


def rule_names(policy: PrivacyPolicy) -> list[str]:
    """Names of the rules that touch some records only, in the order of their marks."""
    return [r.name for r in policy.rollups] + [n for n, on in (("minors", policy.minors), ("places", policy.places), ("others", policy.others)) if on]


def release(df: DataFrame, policy: PrivacyPolicy, population: DataFrame | None = None) -> DataFrame:
    """Published cells: ``policy.publish``, ``n`` (NULL where suppressed), ``suppressed``, ``total_exposed`` and ``rules``.

    One grouped count over the records, then aggregates over cells only.
    """
    if policy.places and population is None:
        raise ValueError(f"{policy.table}: small places are told by their population")
    steps, names = compile_policy(policy, population), rule_names(policy)
    rows = _row_steps(df, steps)
    cells = rows.groupBy(*_columns(policy)).agg(F.count(F.lit(1)).alias(N), F.bit_or(RULES).alias(RULES))
    for step in steps:
        if step.level == "cell":
            cells = step.apply(cells)
    if not policy.others:
        cells = _added(cells, policy.publish).withColumns({"suppressed": F.lit(False), "total_exposed": F.lit(False)})
    touched = F.concat_ws(",", *[F.when(F.col(RULES).bitwiseAND(1 << names.index(n)) != 0, F.lit(n)) for n in sorted(names)])
    return cells.select(*policy.publish, N, "suppressed", "total_exposed", touched.alias("rules"))


def released_statistics(df: DataFrame, policy: PrivacyPolicy, by, digits: int = 2) -> DataFrame:
    """The allowed statistics of ``policy.statistics`` (measure, least rows) over generalised rows; minors carry the national label."""
    measure, minimum = policy.statistics
    return release_statistics(_row_steps(df, compile_policy(policy)), by, measure, minimum, digits)


def _row_steps(df: DataFrame, steps: list[Step]) -> DataFrame:
    rows = df.withColumn(RULES, F.lit(0))
    for step in steps:
        if step.level == "row":
            rows = step.apply(rows)
    return rows


def _columns(policy: PrivacyPolicy) -> list[str]:
    parents = [r.parent for r in policy.rollups] + list(policy.places[1:2])
    return list(dict.fromkeys([*policy.publish, *parents]))


def _added(cells: DataFrame, keys) -> DataFrame:
    return cells.groupBy(*keys).agg(F.sum(N).alias(N), F.bit_or(RULES).alias(RULES))


def _mark(hit: Column, place: int) -> Column:
    return F.when(hit, F.col(RULES).bitwiseOR(1 << place)).otherwise(F.col(RULES))


def _minors(df: DataFrame, policy: PrivacyPolicy, mark: int) -> DataFrame:
    """Records about minors, or of unknown age, keep the national label as place and as every parent of it."""
    age, place, national = policy.minors
    minor = ~F.coalesce(F.col(age) >= ADULT_AGE, F.lit(False))
    above = [r.parent for r in policy.rollups if r.detail == place] + [p for p in policy.places[1:2] if policy.places[0] == place]
    hidden = {c: F.when(minor, F.lit(national)).otherwise(F.col(c)) for c in dict.fromkeys([place, *above])}
    return df.withColumns({**hidden, RULES: _mark(minor, mark)})


def _roll(cells: DataFrame, policy: PrivacyPolicy, rule: Rollup, mark: int) -> DataFrame:
    scope = [c for c in policy.publish if c != rule.detail] if rule.scope is None else list(rule.scope)
    total = F.sum(N).over(Window.partitionBy(*[F.expr(c) for c in scope], rule.detail))
    judged = cells.withColumn("_rare", (total < rule.minimum) & ~F.col(rule.detail).eqNullSafe(F.col(rule.parent)))
    label = F.when(F.col("_rare"), F.col(rule.parent)).otherwise(F.col(rule.detail))
    return _added(judged.withColumns({rule.detail: label, RULES: _mark(F.col("_rare"), mark)}), _columns(policy))


def _small_places(cells: DataFrame, policy: PrivacyPolicy, population: DataFrame, mark: int) -> DataFrame:
    place, parent, minimum = policy.places
    big = population.filter(F.col("poblacion") >= minimum).select(place, F.lit(True).alias("_big")).distinct()
    joined = cells.join(big, place, "left")
    small = F.col("_big").isNull() & ~F.col(place).eqNullSafe(F.col(parent))
    moved = joined.withColumns({place: F.when(small, F.col(parent)).otherwise(F.col(place)), RULES: _mark(small, mark)})
    return _added(moved.drop("_big"), _columns(policy))


def _others(cells: DataFrame, policy: PrivacyPolicy, mark: int) -> DataFrame:
    """Small cells of the category pooled within the other published columns; see :func:`merge_small_cells`."""
    category, minimum = policy.others
    within = [c for c in policy.publish if c != category]
    whole = _added(cells, policy.publish)
    pooled = merge_small_cells(whole, within, category, N, minimum)
    small = F.col(N) < minimum
    marks = whole.select(*within, F.when(small, F.lit("Otros")).otherwise(F.col(category)).alias(category), _mark(small, mark).alias(RULES))
    marks = marks.groupBy(*within, category).agg(F.bit_or(RULES).alias(RULES))
    marks = marks.toDF(*[f"_{c}" for c in [*within, category]], RULES)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*within, category]])
    return pooled.join(marks, same).select(*pooled.columns, _mark(F.col("suppressed"), mark).alias(RULES))


def hidden_bounds(table: DataFrame, row: str, column: str, measure: str = N, hidden: str = "suppressed") -> DataFrame:
    """What margins tell about hidden cells: the interval of each, by propagation over rows and columns.

    ``table`` has every cell's true value and whether it is hidden; row and column totals are
    taken as published.  In each line the hidden cells add up to what the visible ones leave, so a
    cell is at most that less the others' lower bounds, and at least that less the others' upper
    bounds.  Rounds go on until no interval shrinks.  Eager: the state is checkpointed per round.
    """
    rest = {line: table.groupBy(line).agg(F.sum(F.when(F.col(hidden), F.col(measure)).otherwise(0)).alias(f"_{line}")) for line in (row, column)}
    cells = table.filter(hidden).select(row, column, measure)
    for line in (row, column):
        cells = cells.join(rest[line], line)
    state = cut_lineage(cells.withColumns({"low": F.lit(0).cast("long"), "high": F.least(F.col(f"_{row}"), F.col(f"_{column}"))}))
    while True:
        tighter = state.withColumns({"_low": F.col("low"), "_high": F.col("high")})
        for line in (row, column):
            own = Window.partitionBy(line)
            left = F.col(f"_{line}")
            sums = tighter.withColumns({"_lows": F.sum("low").over(own), "_highs": F.sum("high").over(own)})
            low = F.greatest(F.col("low"), left - (F.col("_highs") - F.col("high")))
            high = F.least(F.col("high"), left - (F.col("_lows") - F.col("low")))
            tighter = sums.withColumns({"low": low, "high": high}).drop("_lows", "_highs")
        state = cut_lineage(tighter.withColumn("_moved", (F.col("low") > F.col("_low")) | (F.col("high") < F.col("_high"))).drop("_low", "_high"))
        if state.filter("_moved").isEmpty():
            return state.select(row, column, measure, "low", "high", (F.col("low") == F.col("high")).alias("derivable"))
        state = state.drop("_moved")


def withheld_differences(earlier: DataFrame, later: DataFrame, keys, measure: str = N, minimum: int = MIN_CELL) -> DataFrame:
    """The later release beside an earlier one: cells whose difference would show fewer than ``minimum`` records.

    Per cell of either: ``earlier_n``, the later value, their ``difference`` (a cell that one of them
    lacks counts 0 there) and what is ``published``: the earlier value where subtracting the releases
    would isolate someone, nothing if the cell is new.  Suppressed cells (NULL) show no difference.
    """
    a = earlier.select(*keys, F.col(measure).alias("earlier_n"), F.lit(True).alias("_was"))
    b = later.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(measure).alias("_n"), F.lit(True).alias("_is"))
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    both = a.join(b, on, "full_outer").select(*[F.when(F.col("_is"), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys], "earlier_n", F.col("_n").alias(measure), "_was", "_is")
    secret = (F.col("_was").isNotNull() & F.col("earlier_n").isNull()) | (F.col("_is").isNotNull() & F.col(measure).isNull())
    gap = F.coalesce(F.col(measure), F.lit(0)) - F.coalesce(F.col("earlier_n"), F.lit(0))
    close = ~secret & (gap != 0) & (F.abs(gap) < minimum)
    status = F.when(secret, "suppressed").when(gap == 0, "same").when(close, "withheld").otherwise("released")
    known = F.when(close, F.col("earlier_n")).otherwise(F.col(measure))
    return both.select(*keys, "earlier_n", measure, F.when(~secret, gap).alias("difference"), known.alias("published"), status.alias("status"))
