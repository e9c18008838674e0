"""Named metrics over any dimensions.

A metric is written once, as parts that may be merged again and a formula over
the merged parts. Most parts are sums. A metric that no sums can give again, a
percentile or a number of different users, either names the column its parts stay
apart by until the last step (``fine``: days make a weighted histogram, users one
row each), which is exact, or has a sketch for a part, which is small and carries
the stated error. The definitions of ``avg_order_value``, ``return_rate``,
``delivery_days`` and ``conversion_rate`` are ours; net revenue and gross margin
are the measures of the item fact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.functions.calendar import MONTH
from martweave.functions.money import UNITS, from_parts, rate, summed_parts

GOAL = "purchase"

Of = Callable[[str], Column]


@dataclass(frozen=True)
class Merged:
    """A part that is merged by something else than a sum."""

    make: Callable[..., Column]
    merge: Callable[[Column], Column]

    def __call__(self, units: float | None) -> Column:
        return self.make(units)


Parts = dict[str, Callable[..., Column] | Merged]


@dataclass(frozen=True)
class Metric:
    """``last`` are aggregates over the values of ``fine`` and their parts, taken in the last step."""

    name: str
    grain: str  # the fact it is computed on
    parts: Parts
    formula: Callable[[Of, float | None], Column]
    fine: str | None = None
    last: dict[str, Callable[[Of], Column]] = field(default_factory=dict)


def _money(name: str, of: Of, units: float | None) -> Column:
    return from_parts(of(f"{name}_high"), of(f"{name}_low"), of(f"{name}_odd"), units)


def _count(units: float | None = None) -> Column:
    return F.count(F.lit(1))


def _merge(make: Callable[..., Column], part: Column) -> Column:
    return make.merge(part) if isinstance(make, Merged) else F.sum(part)


_ITEMS, _ORDERS, _EVENTS = "fct_order_items", "fct_orders", "events"
_DAYS, _USER = "days_to_delivery", "user_id"
SKETCH_K = 200  # KLL: a rank is off by about 1.3 % of the rows at most, 99 times of 100
SKETCH_LOG = 12  # HLL: 2^12 registers, a relative standard error of about 1.6 %


def _percentile(share: float) -> Metric:
    """Exact: items are counted by days before anything else, and percentiles taken of the counts."""
    name = f"p{round(share * 100)}"
    return Metric(
        f"{name}_delivery_days",
        _ITEMS,
        {"delivered": lambda units: F.count(_DAYS)},
        lambda of, units: of(name),
        _DAYS,
        {name: lambda of: F.percentile(_DAYS, F.lit(share), of("delivered"))},
    )


def _sketched_percentile(share: float) -> Metric:
    """The day by whose end a share of the items was there; near the exact one in rank (``SKETCH_K``)."""
    return Metric(
        f"p{round(share * 100)}_delivery_days_sketched",
        _ITEMS,
        {
            "days_sketch": Merged(
                lambda units: F.kll_sketch_agg_bigint(F.col(_DAYS).cast("bigint"), F.lit(SKETCH_K)),
                lambda part: F.kll_merge_agg_bigint(part, F.lit(SKETCH_K)),
            ),
            "delivered": lambda units: F.count(_DAYS),
        },
        lambda of, units: F.when(
            of("delivered") > 0, F.kll_sketch_get_quantile_bigint(of("days_sketch"), F.lit(share))
        ),
    )


_REACHED = Merged(lambda units: F.max((F.col("event_type") == GOAL).cast("int")), F.max)
_BY_USER = {
    "users": lambda of: F.count(_USER),
    "converted_users": lambda of: F.coalesce(F.sum(F.when(F.col(_USER).isNotNull(), of("reached"))), F.lit(0)),
}
_USER_SKETCHES = {
    "users_sketch": Merged(
        lambda units: F.hll_sketch_agg(_USER, F.lit(SKETCH_LOG)), lambda part: F.hll_union_agg(part, F.lit(False))
    ),
    "converted_sketch": Merged(
        lambda units: F.hll_sketch_agg(F.when(F.col("event_type") == GOAL, F.col(_USER)), F.lit(SKETCH_LOG)),
        lambda part: F.hll_union_agg(part, F.lit(False)),
    ),
}


def _users_metric(name: str, formula: Callable[[Of, float | None], Column]) -> Metric:
    """Exact: one row for each user and group, in each task before the shuffle too."""
    return Metric(name, _EVENTS, {"reached": _REACHED}, formula, _USER, _BY_USER)


def _estimate(of: Of, part: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(of(part)), F.lit(0))

METRICS = {
    (m.grain, m.name): m
    for m in (
        Metric(
            "net_revenue", _ITEMS, summed_parts("net", "net_revenue"), lambda of, units: _money("net", of, units)
        ),
        Metric(
            "gross_margin",
            _ITEMS,
            summed_parts("margin", "gross_margin"),
            lambda of, units: _money("margin", of, units),
        ),
        Metric("items", _ITEMS, {"items": _count}, lambda of, units: of("items")),
        Metric(
            "return_rate",
            _ITEMS,
            {"returned": lambda units: F.count_if("is_returned"), "items": _count},
            lambda of, units: rate(of("returned").cast("double"), of("items")),
        ),
        Metric(
            "avg_delivery_days",
            _ITEMS,
            {
                "days": lambda units: F.sum("days_to_delivery"),
                "delivered": lambda units: F.count("days_to_delivery"),
            },
            lambda of, units: rate(of("days").cast("double"), of("delivered")),
        ),
        Metric(
            "net_revenue",
            _ORDERS,
            summed_parts("net", "total_revenue_net"),
            lambda of, units: _money("net", of, units),
        ),
        Metric(
            "gross_margin",
            _ORDERS,
            summed_parts("margin", "total_gross_margin"),
            lambda of, units: _money("margin", of, units),
        ),
        Metric("items", _ORDERS, {"items": lambda units: F.sum("items_count")}, lambda of, units: of("items")),
        Metric("orders", _ORDERS, {"orders": _count}, lambda of, units: of("orders")),
        Metric(
            "avg_order_value",
            _ORDERS,
            {**summed_parts("net", "total_revenue_net"), "orders": _count},
            lambda of, units: rate(_money("net", of, units), of("orders")),
        ),
        Metric(
            "buyers", _ITEMS, {}, lambda of, units: of("buyers"), _USER, {"buyers": lambda of: F.count(_USER)}
        ),
        Metric("delivered_items", _ITEMS, {"delivered": lambda units: F.count(_DAYS)}, lambda of, units: of("delivered")),
        *(_percentile(share) for share in (0.5, 0.9, 0.99)),
        *(_sketched_percentile(share) for share in (0.5, 0.9, 0.99)),
        Metric("events", _EVENTS, {"events": _count}, lambda of, units: of("events")),
        _users_metric("users", lambda of, units: of("users")),
        _users_metric("converted_users", lambda of, units: of("converted_users")),
        _users_metric("conversion_rate", lambda of, units: rate(of("converted_users").cast("double"), of("users"))),
        Metric("users_sketched", _EVENTS, _USER_SKETCHES, lambda of, units: _estimate(of, "users_sketch")),
        Metric(
            "conversion_rate_sketched",
            _EVENTS,
            _USER_SKETCHES,
            lambda of, units: rate(
                _estimate(of, "converted_sketch").cast("double"), _estimate(of, "users_sketch")
            ),
        ),
    )
}


@dataclass(frozen=True)
class Lookup:
    """A dimension to join: fact column, dimension key, attributes to group by.

    ``calendar`` marks a date dimension, whose size is bounded by the days it
    spans and not by the facts; only such a one is broadcast by hint. Turn
    ``sum_first`` off where the key and the other groups leave but a few fact rows
    each: the rows are then joined as they are, in one shuffle less, and a very
    frequent key is split at run time. With ``only`` fact rows that the dimension does
    not have are left out, so that a filtered dimension selects them. ``month`` names
    its attribute that a stored fact is laid out by (``LandedTable.by_month``): months
    that a filtered calendar does not have are then not read at all.
    """

    dimension: DataFrame
    fact_key: str
    key: str
    attributes: tuple[str, ...]
    calendar: bool = False
    sum_first: bool = True
    only: bool = False
    month: str | None = None

    def rows(self) -> DataFrame:
        attributes = [c for c in self.attributes if c != self.key]
        months = [F.col(self.month).alias(MONTH)] if self.month else []
        return self.dimension.select(F.col(self.key).alias(self.fact_key), *attributes, *months)

    def join(self, fact: DataFrame) -> DataFrame:
        keys = [self.fact_key, *([MONTH] if self.month else [])]
        dimension = F.broadcast(self.rows()) if self.calendar else self.rows()
        return fact.join(dimension, keys, "inner" if self.only else "left")


def measure(
    fact: DataFrame,
    grain: str,
    names: list[str],
    by: list[str],
    lookups: tuple[Lookup, ...] = (),
    units: float | None = UNITS,
) -> DataFrame:
    """Metrics of a fact grouped by fact columns and dimension attributes.

    The fact is first summed by the keys it is joined on, and only then joined: a
    user or product with very many rows meets its dimension as a few, and the
    joins and their shuffles carry sums in place of rows. Dimensions are joined
    from the left, so a fact row without one keeps counting, under NULL. Money is
    counted in ``units`` (see ``functions/money.py``).

    Metrics that stay apart by a column until the last step are one aggregation for
    each such column; the others go with the first of them. Each has the same
    groups, one row each, which are then laid together.
    """
    metrics = [METRICS[grain, name] for name in names]
    fine = list(dict.fromkeys(m.fine for m in metrics if m.fine)) or [None]
    made = [
        _measured(fact, [m for m in metrics if m.fine == f or (m.fine is None and f == fine[0])], f, by, lookups, units)
        for f in fine
    ]
    if len(made) > 1:
        kinds = {c: t for df in made for c, t in df.dtypes}
        wide = [
            df.select(*by, *(F.col(n) if n in df.columns else F.lit(None).cast(kinds[n]).alias(n) for n in names))
            for df in made
        ]
        together = reduce(DataFrame.unionByName, wide)
        return together.groupBy(*by).agg(*(F.first(n, ignorenulls=True).alias(n) for n in names))
    return made[0].select(*by, *names)


def _measured(
    fact: DataFrame,
    metrics: list[Metric],
    fine: str | None,
    by: list[str],
    lookups: tuple[Lookup, ...],
    units: float | None,
) -> DataFrame:
    parts = {part: make for m in metrics for part, make in m.parts.items()}
    calendars = [x for x in lookups if x.calendar]
    others = [x for x in lookups if not x.calendar and x.sum_first]
    direct = [x for x in lookups if not x.calendar and not x.sum_first]

    for x in [*calendars, *direct]:
        fact = x.join(fact)
    late = {a for x in others for a in x.attributes}
    early = [c for c in by if c not in late]
    apart = [fine] if fine else []
    months = [MONTH] if any(x.month for x in others) else []
    grouping = list(dict.fromkeys([*(x.fact_key for x in others), *months, *early, *apart]))

    def added(df: DataFrame, groups: list[str], of: Callable[..., Column]) -> DataFrame:
        made = [of(p, make).alias(f"_{p}") for p, make in parts.items()]
        return df.groupBy(*groups).agg(*made) if made else df.select(*groups).distinct()

    sums = added(fact, grouping, lambda p, make: make(units))
    if others:
        for x in others:
            sums = x.join(sums)
        sums = added(sums, list(dict.fromkeys([*by, *apart])), lambda p, make: _merge(make, F.col(f"_{p}")))
    if fine:
        of = lambda part: F.col(f"_{part}")
        last = {part: make(of) for m in metrics for part, make in m.last.items()}
        again = {p: _merge(parts[p], of(p)) for m in metrics if not m.fine for p in m.parts}
        sums = sums.groupBy(*by).agg(*(c.alias(f"_{p}") for p, c in (again | last).items()))
    return sums.select(
        *by, *(m.formula(lambda part: F.col(f"_{part}"), units).alias(m.name) for m in metrics)
    )


def delivery_days(
    fact: DataFrame, by: list[str], shares: tuple[float, ...] = (0.5, 0.9)
) -> DataFrame:
    """Average and exact percentiles of the days to delivery."""
    names = [f"p{round(share * 100)}" for share in shares]
    found = measure(
        fact.filter(F.col(_DAYS).isNotNull()),
        _ITEMS,
        ["delivered_items", "avg_delivery_days", *(f"{n}_delivery_days" for n in names)],
        by,
    )
    renamed = {"avg_delivery_days": "avg_days"} | {f"{n}_delivery_days": f"{n}_days" for n in names}
    return found.withColumnsRenamed(renamed)


def conversion_rate(events: DataFrame, by: list[str], goal: str = GOAL) -> DataFrame:
    """Users with the goal event among users with any event, per group."""
    known = events.filter(F.col(_USER).isNotNull())
    if goal != GOAL:
        known = known.withColumn("event_type", F.when(F.col("event_type") == goal, GOAL))
    return measure(known, _EVENTS, ["users", "converted_users", "conversion_rate"], by)


def coherence(
    left: DataFrame, right: DataFrame, by: list[str], names: list[str], tolerance: float = 0.0
) -> DataFrame:
    """One row per group and metric: both values and whether they agree.

    A group only one side has does not agree; groups match on NULL too. Both
    sides are metric results, one row per group.
    """
    # A mark tells a group that is absent from one whose values are NULL.
    a = left.select(*(F.col(c).alias(f"_l_{c}") for c in left.columns), F.lit(True).alias("_l"))
    b = right.select(*(F.col(c).alias(f"_r_{c}") for c in right.columns), F.lit(True).alias("_r"))
    same = reduce(
        lambda x, y: x & y, (F.col(f"_l_{c}").eqNullSafe(F.col(f"_r_{c}")) for c in by)
    )
    joined = a.join(b, same, "full_outer")
    groups = [F.coalesce(f"_l_{c}", f"_r_{c}").alias(c) for c in by]
    rows = F.array(
        *(
            F.struct(
                F.lit(n).alias("metric"),
                F.col(f"_l_{n}").cast("double").alias("left_value"),
                F.col(f"_r_{n}").cast("double").alias("right_value"),
            )
            for n in names
        )
    )
    both = F.coalesce(F.col("_l") & F.col("_r"), F.lit(False))
    exploded = joined.select(*groups, both.alias("_both"), F.inline(rows))
    difference = F.abs(F.col("left_value") - F.col("right_value"))
    agree = F.col("left_value").eqNullSafe(F.col("right_value")) | F.coalesce(
        difference <= tolerance, F.lit(False)
    )
    return exploded.withColumns({"difference": difference, "coherent": F.col("_both") & agree}).drop(
        "_both"
    )
