"""The star: one fact, three dimensions joined only when asked for, and the filter context."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import month_label

# attribute -> dimension that owns it
CITY = ("city_name", "city_uf", "state_name", "uf", "region")
COUNTRY = ("country_name",)
PRODUCT = ("product_category_name",)
KEY_OF = {"city": "city_id", "country": "trade_country_id", "product": "product_category_id"}
DIM_KEY = {"city": "city_id", "country": "country_id", "product": "product_category_id"}

PERIODS: dict[str, Callable[[Column], Column]] = {
    "year": F.year,
    "month": F.month,
    "month_number": lambda d: F.year(d) * 100 + F.month(d),
    "month_name": month_label,
}

def owner(attribute: str) -> str | None:
    for name, attributes in (("city", CITY), ("country", COUNTRY), ("product", PRODUCT)):
        if attribute in attributes:
            return name
    return None


@dataclass(frozen=True)
class FilterContext:
    """Slicer choices: allowed members per attribute, a range of months (both ends included), and tables of members."""

    members: Mapping[str, tuple] = field(default_factory=dict)
    date_from: date | None = None
    date_to: date | None = None
    tables: tuple[DataFrame, ...] = ()

    def where(self, **members: Iterable) -> FilterContext:
        """Keep these members; a second choice on the same attribute replaces the first."""
        return replace(self, members={**self.members, **{k: tuple(v) for k, v in members.items()}})

    def within(self, **members: Iterable) -> FilterContext:
        """Keep these members of those already chosen (intersection)."""
        merged = dict(self.members)
        for k, v in members.items():
            merged[k] = tuple(m for m in v if k not in merged or m in merged[k])
        return replace(self, members=merged)

    def matching(self, table: DataFrame, keep: bool = False) -> FilterContext:
        """Keep facts whose members are a row of ``table``, which has an attribute, key or period in each column.

        As in a calculation over a table, earlier choices on its columns are replaced; with ``keep`` they stay, and
        both count. The table is never collected: it meets the facts in a semi join below the grouping.
        """
        base = self if keep else replace(self.without(*table.columns), tables=tuple(t for t in self.tables if not set(t.columns) & set(table.columns)))
        return replace(base, tables=(*base.tables, table))

    def without(self, *attributes: str) -> FilterContext:
        return replace(self, members={k: v for k, v in self.members.items() if k not in attributes})

    def without_dates(self) -> FilterContext:
        dates = {"trade_date", *PERIODS}
        return replace(self.without(*dates), date_from=None, date_to=None, tables=tuple(t for t in self.tables if not dates & set(t.columns)))

    def without_lower_date(self) -> FilterContext:
        """Everything up to the last chosen period."""
        years = self.members.get("year")
        to = self.date_to
        if years:
            end = date(max(years), 12, 31)
            to = min(to, end) if to else end
        return replace(self.without_dates(), date_to=to)

    def bounds(self) -> tuple[date | None, date | None]:
        """The tightest date range the choices imply, for pruning the scan."""
        lo, hi = self.date_from, self.date_to
        years = self.members.get("year")
        if years:
            first, last = date(min(years), 1, 1), date(max(years), 12, 31)
            lo = max(lo, first) if lo else first
            hi = min(hi, last) if hi else last
        return lo, hi

    @property
    def empty(self) -> bool:
        return not self.members and not self.tables and self.date_from is None and self.date_to is None


EVERYTHING = FilterContext()
Provider = Callable[[frozenset, "date | None", "date | None"], DataFrame]


@dataclass(frozen=True)
class Bridge:
    """A key that hangs on a finer ``source`` key of the raw fact; ``frame`` holds (source, key)."""

    source: str
    frame: DataFrame


class Star:
    """``fact`` is a frame, or a function of (needed key columns, first date, last date) giving one.

    The function form lets a star over raw tables leave out joins no query asked for. Dimensions are
    joined LEFT from the fact, so facts with unknown keys stay, under a NULL member. No join carries
    a broadcast hint: the planner broadcasts a dimension only below its measured size threshold.
    A lone key with a :class:`Bridge` is summed by the bridge's source key before the bridge is joined,
    unless a period is grouped too.

    ``rollup`` holds the fact's sums by some of its keys (see ``plans.rollup``); it stands in for the fact wherever a
    query needs no other key.
    """

    def __init__(
        self,
        fact: DataFrame | Provider,
        cities: DataFrame,
        countries: DataFrame,
        products: DataFrame,
        bridges: Mapping[str, Bridge] | None = None,
        rollup: DataFrame | None = None,
    ):
        self._fact = fact
        self.rollup = rollup
        self.bridges = dict(bridges or {})
        self.dims = {"city": cities, "country": countries, "product": products}

    def fact(self, keys: Iterable[str] = (), lo: date | None = None, hi: date | None = None) -> DataFrame:
        keys = frozenset(keys)
        if self.rollup is not None and keys <= set(self.rollup.columns):
            frame = self.rollup
        elif callable(self._fact):
            return self._fact(keys, lo, hi)
        else:
            frame = self._fact
        if lo is not None:
            frame = frame.filter(F.col("trade_date") >= F.lit(lo))
        if hi is not None:
            frame = frame.filter(F.col("trade_date") <= F.lit(hi))
        return frame

    def filtered(self, names: Iterable[str], ctx: FilterContext = EVERYTHING, real: bool = False) -> DataFrame:
        """Fact rows under ``ctx`` with the keys and periods among ``names``.

        Choices on a dimension's attributes cut the facts by a semi join with the chosen members' keys,
        before anything is grouped.
        """
        columns = {c for t in ctx.tables for c in t.columns}
        asked = set(names) | set(ctx.members) | {c for c in columns if not owner(c)} | {KEY_OF[d] for d in map(owner, columns) if d}
        sliced = sorted({d for d in map(owner, ctx.members) if d})
        keys = {k for k in asked if not owner(k) and k not in PERIODS and k not in ("trade_date", "trade_flag")} | {KEY_OF[d] for d in sliced}
        lo, hi = ctx.bounds()
        facts = with_periods(self.fact(keys | ({"fob_value_real"} if real else set()), lo, hi), asked)
        for attribute, chosen in ctx.members.items():
            if not owner(attribute):
                facts = facts.filter(F.col(attribute).isin(*chosen))
        for d in sliced:
            members = self.dims[d].select(F.col(DIM_KEY[d]).alias(KEY_OF[d]), *sorted(a for a in ctx.members if owner(a) == d))
            for attribute, chosen in ctx.members.items():
                if owner(attribute) == d:
                    members = members.filter(F.col(attribute).isin(*chosen))
            facts = facts.join(members.select(KEY_OF[d]), KEY_OF[d], "left_semi")
        for table in ctx.tables:
            facts = self._matching(facts, table)
        return facts

    def _matching(self, facts: DataFrame, table: DataFrame) -> DataFrame:
        """Facts whose members are a row of ``table``: its attributes become keys, and those meet the facts."""
        rows = table.distinct()
        for d in sorted({d for d in map(owner, table.columns) if d}):
            shared = sorted(c for c in table.columns if owner(c) == d)
            dim = self.dims[d].select(F.col(DIM_KEY[d]).alias(KEY_OF[d]), *[F.col(c).alias(f"_{c}") for c in shared])
            rows = rows.join(dim, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in shared]).drop(*shared, *[f"_{c}" for c in shared])
        rows = rows.select(*[F.col(c).alias(f"_{c}") for c in rows.columns])
        return facts.join(rows, [F.col(c[1:]).eqNullSafe(F.col(c)) for c in rows.columns], "left_semi")

    def grouped(
        self,
        by: Iterable[str],
        aggregates: Mapping[str, Column],
        ctx: FilterContext = EVERYTHING,
        combine: Callable[[str], Column] = F.sum,
        real: bool = False,
    ) -> DataFrame:
        """One row per group of ``by`` (keys, periods or dimension attributes) under ``ctx``.

        Facts are grouped on dimension keys first and meet the dimensions afterwards; a second
        grouping with ``combine`` then rolls keys up to attributes. Map-side partial results make a
        hot key one row per task before anything is shuffled.
        """
        by = list(dict.fromkeys(by))
        asked = set(by) | set(ctx.members)  # columns of tables only filter, and are added by filtered()
        dims = sorted({d for d in map(owner, by) if d})  # a dimension that only filters is not joined
        keys = {KEY_OF[d] for d in map(owner, asked) if d} | (asked & set(KEY_OF.values()))
        plain = sorted({b for b in by if not owner(b)} - keys)
        # with a period the source key hardly reduces the rows: the map is joined first
        bridged = next((k for k in keys if k in self.bridges), None) if len(keys) == 1 and not plain and not ctx.members and not ctx.tables else None
        raw = {self.bridges[bridged].source} if bridged else keys
        facts = self.filtered(raw | set(by), ctx, real)
        kept = sorted({KEY_OF[d] for d in dims} | (keys & set(by)))  # not the keys that only filter
        groups = facts.groupBy(*(sorted(raw) if bridged else kept), *plain).agg(*[c.alias(n) for n, c in aggregates.items()])
        types = {n: groups.schema[n].dataType for n in aggregates}

        def rolled(frame: DataFrame, names: list[str]) -> DataFrame:
            return frame.groupBy(*names).agg(*[combine(n).cast(types[n]).alias(n) for n in aggregates])

        if bridged:
            groups = groups.join(self.bridges[bridged].frame, self.bridges[bridged].source, "left")
            groups = rolled(groups, [*kept, *plain])
        if not dims:
            return groups.select(*by, *aggregates)
        for d in dims:
            needed = sorted(a for a in by if owner(a) == d)
            dim = self.dims[d].select(F.col(DIM_KEY[d]).alias(KEY_OF[d]), *needed)
            groups = groups.join(dim, KEY_OF[d], "left")
        if {KEY_OF[d] for d in dims} <= set(by):
            return groups.select(*by, *aggregates)  # attributes follow from the keys: already grouped
        return rolled(groups, by)


def with_periods(frame: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add calendar attributes computed from ``trade_date``; no join is needed for them."""
    new = {n: PERIODS[n](F.col("trade_date")) for n in PERIODS if n in set(names)}
    return frame.withColumns(new) if new else frame


def in_dates(ctx: FilterContext, d: Column | None = None) -> Column:
    """The date part of ``ctx`` as one predicate on a date column."""
    d = F.col("trade_date") if d is None else d
    tests = [F.lit(True)]
    if ctx.date_from is not None:
        tests.append(d >= F.lit(ctx.date_from))
    if ctx.date_to is not None:
        tests.append(d <= F.lit(ctx.date_to))
    for name, members in ctx.members.items():
        if name in PERIODS:
            tests.append(PERIODS[name](d).isin(*members))
        elif name == "trade_date":
            tests.append(d.isin(*members))
    return reduce(lambda a, b: a & b, tests)
