"""The pages' sentences: computed facts first, text from them last. One row per page.

Each page sums the fact once at its finest grain and stores that; facts about months and members are
scalar subqueries on it, so nothing is joined by crossing frames and the fact is not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.numbers import blank_subtract, ratio
from quayside.functions.text import (
    MONTHS,
    fill,
    magnitude,
    month_label,
    month_year_label,
    name_of,
    percent,
    price,
    signed_points,
    times,
    weight,
    whole_percent,
)
from quayside.operators.concentration import hhi
from quayside.operators.ranking import first_member, leaders, leaders_by
from quayside.operators.timeintel import lead_streak, with_last_year
from quayside.plans.measures import evaluate, grand_total, regroup, sum_groups, sums_for
from quayside.plans.star import EVERYTHING, FilterContext, Star, with_periods
from quayside.plans.texts import BALANCE, EXPORTS, IMPORTS, OVERVIEW, PARTNERS, PRODUCTS, STATES
from quayside.sources.tables import stored

CATEGORY = "product_category_name"


def _row(frame: DataFrame) -> Column:
    """A one-row frame as one struct-valued scalar subquery."""
    return frame.select(F.struct("*")).scalar()


def _first_active(measure: str) -> Column:
    return month_label(F.min(F.when(F.col(measure) > 0, F.col("trade_date"))))


def _last_active(measure: str) -> Column:
    return month_label(F.max(F.when(F.col(measure) > 0, F.col("trade_date"))))


def _best(groups: DataFrame, member: str, value: str) -> DataFrame:
    return leaders(groups.select(member, value), member, value)


def _base(star: Star, by: list[str], measures: list[str], ctx: FilterContext) -> DataFrame:
    """The page's sums at its finest grain: one pass over the fact, written, then read by every question."""
    return stored(sum_groups(star, sums_for(measures), by, ctx), "page")


def _total(star: Star, base: DataFrame, measure: str, ctx: FilterContext) -> Column:
    """The unfiltered total; without filters the base already holds it."""
    return base.agg(F.sum(measure)).scalar() if ctx.empty else grand_total(star, measure)


def overview(star: Star, n: int | None = 10, ctx: FilterContext = EVERYTHING) -> DataFrame:
    base = _base(star, ["trade_date", "product_category_id", CATEGORY, "country_name"], ["exports", "imports"], ctx)
    months = regroup(base, ["exports"], ["trade_date"])
    span = months.agg(_first_active("exports").alias("first"), _last_active("exports").alias("last"))
    if ctx.empty:
        all_months, dates = regroup(base, ["imports"], ["trade_date"]), base
    else:
        all_months, dates = evaluate(star, ["imports"], ["trade_date"], ctx.without_dates()), star.fact()
    peak = _best(all_months.withColumn("month", month_label(F.col("trade_date"))), "month", "imports")
    available = dates.agg(
        month_year_label(F.min("trade_date")).alias("first"), month_year_label(F.max("trade_date")).alias("last")
    )
    categories = regroup(base, ["exports"], ["product_category_id", CATEGORY])
    by_value = categories.filter(F.col("exports").isNotNull()).groupBy("exports").agg(
        F.array_join(F.sort_array(F.collect_list(CATEGORY)), "").alias("name"),
        F.array_join(F.sort_array(F.collect_list("product_category_id")), "").alias("id"),
        F.sum("exports").alias("value"),
    )
    two = by_value.orderBy(F.col("exports").desc()).limit(2)
    second = F.when(F.count(F.lit(1)) > 1, F.min_by(F.struct("name", "id", "value"), "exports"))
    two = two.agg(F.max_by(F.struct("name", "id", "value"), "exports").alias("one"), second.alias("two"))
    countries = _best(regroup(base, ["exports"], ["country_name"]), "country_name", "exports")
    facts = span.withColumns(
        {
            "available": _row(available),
            "peak": _row(peak),
            "top": _row(two),
            "country": _row(countries),
            "total": _total(star, base, "exports", ctx),
        }
    )
    total = F.col("total")
    many = n is not None and n > 1
    shown = F.lit(n)
    f = OVERVIEW
    return facts.select(
        fill(f["data_available"], first=F.col("available.first"), last=F.col("available.last")).alias("data_available"),
        fill(f["series"], value=magnitude(F.col("peak.imports")), month=F.col("peak.month")).alias("series_subtitle"),
        fill(
            f["categories"],
            name1=F.col("top.one.name"), id1=F.col("top.one.id"), share1=percent(ratio(F.col("top.one.value"), total)),
            name2=F.col("top.two.name"), id2=F.col("top.two.id"), share2=percent(ratio(F.col("top.two.value"), total)),
        ).alias("categories_subtitle"),
        fill(f["states_title_many" if many else "states_title_one"], n=shown).alias("states_title"),
        fill(f["states_span"], first=F.col("first"), last=F.col("last")).alias("states_subtitle"),
        fill(f["countries_title_many" if many else "countries_title_one"], n=shown).alias("countries_title"),
        fill(
            f["countries"],
            country=F.col("country.country_name"), share=percent(ratio(F.col("country.exports"), total)),
            value=magnitude(F.col("country.exports")), first=F.col("first"), last=F.col("last"),
        ).alias("countries_subtitle"),
    )


def balance(star: Star, ctx: FilterContext = EVERYTHING) -> DataFrame:
    base = _base(star, ["trade_date"], ["balance", "balance_real"], ctx)
    months = regroup(base, ["exports", "imports", "balance", "balance_real"], ["trade_date"])
    labelled = months.withColumn("month", month_label(F.col("trade_date")))
    gap = F.when(F.col("balance_real") != 0, F.abs(blank_subtract(F.col("balance_real"), F.col("balance"))))
    row = labelled.withColumn("gap", gap).agg(
        _first_active("exports").alias("first"),
        _last_active("exports").alias("last"),
        F.max(F.when(F.col("gap").isNotNull(), F.struct("gap", "month"))).alias("gap"),
        F.sum("exports").alias("exports"),
        F.sum("imports").alias("imports"),
    )
    low = leaders(
        labelled.select("month", (-F.col("balance")).alias("balance")), "month", "balance"
    ).withColumn("balance", -F.col("balance"))
    name = name_of(MONTHS["pt-BR"], F.month("trade_date")).alias("name")
    years = months.filter(F.col("balance").isNotNull()).groupBy(F.year("trade_date"), name).agg(F.sum("balance").alias("b"))
    means = years.groupBy("name").agg(F.avg(F.col("b").cast("double")).alias("mean"))
    ends = means.agg(F.min("mean").alias("low"), F.max("mean").alias("high"), F.max(F.struct("mean", "name")).alias("best"),
                     F.max(F.struct((-F.col("mean")).alias("mean"), "name")).alias("worst"))
    facts = row.withColumns({"low": _row(low), "ends": _row(ends)})
    difference = F.abs(blank_subtract(F.col("exports"), F.col("imports")))
    known = {"first": F.col("first"), "last": F.col("last"), "value": magnitude(difference)}
    f = BALANCE
    return facts.select(
        fill(f["lowest"], month=F.col("low.month"), value=magnitude(F.col("low.balance"), absolute=True)).alias("page_title"),
        fill(f["real"], value=magnitude(F.col("gap.gap")), month=F.col("gap.month")).alias("real_subtitle"),
        F.when(F.coalesce("exports", F.lit(0)) > F.coalesce("imports", F.lit(0)), fill(f["surplus"], **known))
        .otherwise(fill(f["deficit"], **known)).alias("running_subtitle"),
        fill(
            f["heatmap"], worst=F.col("ends.worst.name"), best=F.col("ends.best.name"),
            low=magnitude(F.col("ends.low"), absolute=True), high=magnitude(F.col("ends.high"), absolute=True),
        ).alias("heatmap_subtitle"),
    )


def _lead(base: DataFrame, measure: str) -> dict[str, Column]:
    """Latest leader, years in the lead, and its total."""
    groups = regroup(base, [measure], ["year", CATEGORY])
    streak = lead_streak(leaders_by(groups, "year", CATEGORY, measure), "year", CATEGORY)
    name = streak.select(CATEGORY).scalar()
    total = groups.filter(F.col(CATEGORY) == name).agg(F.sum(measure)).scalar()
    return {f"{measure}_streak": _row(streak), f"{measure}_acc": total}


def products(star: Star, ctx: FilterContext = EVERYTHING) -> DataFrame:
    prices = ["export_price", "import_price"]
    base = with_periods(_base(star, ["trade_date", CATEGORY], prices, ctx), ["year"])
    months = regroup(base, ["exports", "imports", "export_weight", "import_weight"], ["trade_date"])
    row = months.agg(
        _first_active("exports").alias("e_first"), _last_active("exports").alias("e_last"),
        _first_active("imports").alias("i_first"), _last_active("imports").alias("i_last"),
        ratio(F.sum("exports"), F.sum("export_weight")).alias("export_price"),
        ratio(F.sum("imports"), F.sum("import_weight")).alias("import_price"),
    )
    groups = regroup(base, ["exports", "imports", *prices], [CATEGORY])
    years = regroup(base, prices, ["year"])
    top_exported = _best(groups, CATEGORY, "exports")
    export_price_of_top = groups.filter(F.col(CATEGORY) == top_exported.select(CATEGORY).scalar()).agg(F.max("export_price")).scalar()
    facts = row.withColumns(
        {
            "top_price": export_price_of_top,
            "most_imported": _row(_best(groups, CATEGORY, "imports")),
            "dearest_out": _row(_best(groups, CATEGORY, "export_price")),
            "dearest_in": _row(_best(groups, CATEGORY, "import_price")),
            "peak_out": _row(_best(years.withColumn("year", F.col("year").cast("string")), "year", "export_price")),
            "peak_in": _row(_best(years.withColumn("year", F.col("year").cast("string")), "year", "import_price")),
            **_lead(base, "exports"),
            **_lead(base, "imports"),
        }
    )
    f = PRODUCTS

    def lead(measure: str, template: str, first: str, last: str) -> Column:
        return fill(
            f[template], name=F.col(f"{measure}_streak.{CATEGORY}"), years=F.col(f"{measure}_streak.periods_in_lead"),
            value=magnitude(F.col(f"{measure}_acc"), absolute=True), first=F.col(first), last=F.col(last),
        )

    return facts.select(
        fill(f["most_exported_span"], first=F.col("e_first"), last=F.col("e_last")).alias("most_exported_subtitle"),
        fill(f["most_imported_title"], name=F.col(f"most_imported.{CATEGORY}")).alias("most_imported_title"),
        fill(f["dearest_title"], name=F.col(f"dearest_out.{CATEGORY}")).alias("dearest_title"),
        fill(f["dearest"], times=times(ratio(F.col("dearest_out.export_price"), F.col("top_price")))).alias("dearest_subtitle"),
        lead("exports", "export_lead", "e_first", "e_last").alias("exports_lead"),
        lead("imports", "import_lead", "i_first", "i_last").alias("imports_lead"),
        fill(f["yearly_price"], mean=price(F.col("export_price")), peak=price(F.col("peak_out.export_price")), year=F.col("peak_out.year")).alias("yearly_export_price"),
        fill(f["yearly_price"], mean=price(F.col("import_price")), peak=price(F.col("peak_in.import_price")), year=F.col("peak_in.year")).alias("yearly_import_price"),
        fill(f["category_price"], name=F.col(f"dearest_out.{CATEGORY}"), price=price(F.col("dearest_out.export_price"))).alias("category_export_price"),
        fill(f["category_price"], name=F.col(f"dearest_in.{CATEGORY}"), price=price(F.col("dearest_in.import_price"))).alias("category_import_price"),
    )


def _category_choice(star: Star, ctx: FilterContext) -> DataFrame:
    """How many categories are chosen, of how many, and the name when it is one."""
    names = star.dims["product"].select(CATEGORY).distinct()
    picked = F.col(CATEGORY).isin(*ctx.members[CATEGORY]) if CATEGORY in ctx.members else F.lit(True)
    return names.agg(
        F.count_if(picked).alias("chosen"), F.count(F.lit(1)).alias("known"), F.max(F.when(picked, F.col(CATEGORY))).alias("name")
    )


def partners(star: Star, n: int | None = 10, flag: str | None = None, ctx: FilterContext = EVERYTHING) -> DataFrame:
    """``imports_title`` shows the export share, as published; ``imports_title_fixed`` the import share."""
    # a flag slicer counts for concentration, while exports and imports set the flag themselves
    sums = _base(star, ["country_name"], ["exports", "imports"], ctx)
    groups = regroup(sums, ["exports", "imports"], ["country_name"])
    by_year = hhi(star, "country_name", ["year"], ctx)
    row = by_year.agg(
        F.min("year").alias("year"), (F.max_by("hhi", "year") - F.min_by("hhi", "year")).alias("change")
    )
    facts = row.withColumns(
        {
            "exporter": _row(first_member(groups, "country_name", "exports")),
            "importer": _row(first_member(groups, "country_name", "imports")),
            "export_total": _total(star, sums, "exports", ctx),
            "import_total": _total(star, sums, "imports", ctx),
            "categories": _row(_category_choice(star, ctx)),
        }
    )
    export_share = ratio(F.col("exporter.exports"), F.col("export_total"))
    import_share = ratio(F.col("importer.imports"), F.col("import_total"))
    f = PARTNERS
    chosen, known = F.col("categories.chosen"), F.col("categories.known")

    def card(direction: str, share: Column) -> Column:
        parts = {"share": percent(share, 2), "category": F.col("categories.name")}
        every, one, some = (fill(f[f"{direction}_{kind}"], **parts) for kind in ("all", "one", "some"))
        return F.when(chosen == known, every).when(chosen == 1, one).otherwise(some)

    change = F.col("change")
    return facts.select(
        card("exports", export_share).alias("exports_title"),
        card("imports", export_share).alias("imports_title"),
        card("imports", import_share).alias("imports_title_fixed"),
        fill(f["tornado_title"], n=F.lit(n)).alias("tornado_title"),
        fill(
            f["tornado"], n=F.lit(n), exporter=F.col("exporter.country_name"), export_share=whole_percent(export_share),
            importer=F.col("importer.country_name"), import_share=whole_percent(import_share),
        ).alias("tornado_subtitle"),
        F.when(change < 0, fill(f["hhi_down"], change=percent(-change), year=F.col("year")))
        .otherwise(fill(f["hhi_up"], change=percent(change), year=F.col("year"))).alias("hhi_subtitle"),
        fill(f["hhi_title"], flow=F.lit(IMPORTS if flag == "imp" else EXPORTS)).alias("hhi_title"),
    )


def states(star: Star, n: int | None = 10, ctx: FilterContext = EVERYTHING) -> DataFrame:
    months = evaluate(star, ["exports", "imports"], ["trade_date"], ctx)
    row = months.agg(
        _first_active("exports").alias("e_first"), _last_active("exports").alias("e_last"),
        _first_active("imports").alias("i_first"), _last_active("imports").alias("i_last"),
    )
    sums = ["exports", "imports", "export_weight", "import_weight"]
    # one row per city: its sums, and whether it exports or imports at all
    base = stored(sum_groups(star, sums, ["city_id", "city_uf", "state_name"], ctx), "page")
    groups = regroup(base, sums, ["state_name"])
    cities = regroup(base, ["exports", "imports"], ["city_uf"])
    known = F.col("city_id").isNotNull()
    active = base.groupBy("state_name").agg(
        F.count_if(known & F.col("exports").isNotNull()).alias("exports_members"),
        F.count_if(known & F.col("imports").isNotNull()).alias("imports_members"),
    )
    facts = row.withColumns(
        {
            "top": _row(groups.agg(*[F.max(m).alias(m) for m in ("exports", "imports", "export_weight", "import_weight")])),
            "out_city": _row(first_member(cities, "city_uf", "exports")),
            "in_city": _row(first_member(cities, "city_uf", "imports")),
            "out_state": _row(_best(groups, "state_name", "exports")),
            "in_state": _row(_best(groups, "state_name", "imports")),
            "out_active": _row(_best(active, "state_name", "exports_members")),
            "in_active": _row(_best(active, "state_name", "imports_members")),
        }
    )
    f = STATES

    def size(c: str) -> Column:
        return magnitude(F.col(c), absolute=True)

    return facts.select(
        fill(f["export_card"], first=F.col("e_first"), last=F.col("e_last"), value=size("top.exports"), weight=weight(F.col("top.export_weight"))).alias("export_card"),
        fill(f["import_card"], value=size("top.imports"), weight=weight(F.col("top.import_weight"))).alias("import_card"),
        fill(f["cities_title"], n=F.lit(n), first=F.col("e_first"), last=F.col("e_last")).alias("exporting_cities_title"),
        fill(f["cities_title"], n=F.lit(n), first=F.col("i_first"), last=F.col("i_last")).alias("importing_cities_title"),
        fill(f["exporting_city"], city=F.col("out_city.city_uf"), value=size("out_city.exports")).alias("exporting_city"),
        fill(f["importing_city"], city=F.col("in_city.city_uf"), value=size("in_city.imports")).alias("importing_city"),
        fill(f["exporting_cities"], state=F.col("out_active.state_name"), cities=F.col("out_active.exports_members")).alias("exporting_cities"),
        fill(f["importing_cities"], state=F.col("in_active.state_name"), cities=F.col("in_active.imports_members")).alias("importing_cities"),
        fill(f["map"], state=F.col("out_state.state_name"), value=size("out_state.exports")).alias("exports_map"),
        fill(f["map"], state=F.col("in_state.state_name"), value=size("in_state.imports")).alias("imports_map"),
    )


def coverage_label(star: Star, by: list[str], ctx: FilterContext = EVERYTHING) -> DataFrame:
    """Signed change of the coverage ratio against the year before, as text beside the number."""
    frame = with_last_year(star, ["coverage"], by, ctx)
    change = blank_subtract(F.col("coverage"), F.col("coverage_ly"))
    return frame.select(*by, change.alias("change"), signed_points(change).alias("label"))
