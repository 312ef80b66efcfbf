"""The calendar: one row per day, 114 derived columns, holidays included.

All columns are built-in expressions in one projection; the only join adds holiday names. Columns
that compare with today take the as-of day from the bounds, so a run can be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import MONTHS, WEEKDAYS, name_of

# Label texts by language.
LABELS = {
    "en-US": {"current": "Current", "quarter": "Q", "week": "W", "half": "H", "bimester": "B", "fortnight": "FN", "summer": "Summer", "spring": "Spring", "autumn": "Autumn", "winter": "Winter", "business": "BusinessDay", "non_business": "Non-BusinessDay"},
    "pt-BR": {"current": "Atual", "quarter": "T", "week": "S", "half": "S", "bimester": "B", "fortnight": "Q", "summer": "Verão", "spring": "Primavera", "autumn": "Outono", "winter": "Inverno", "business": "Dia Útil", "non_business": "Dia Não Útil"},
    "es-ES": {"current": "Actual", "quarter": "T", "week": "S", "half": "S", "bimester": "B", "fortnight": "Q", "summer": "Verano", "spring": "Primavera", "autumn": "Otoño", "winter": "Invierno", "business": "Dia Laborable", "non_business": "Dia No Laborable"},
}
# Fixed values: (day, month, name) of holidays on the same day every year.
FIXED_HOLIDAYS = {
    "pt-BR": [
        (1, 1, "Confraternização Universal"), (25, 1, "Aniversário da Cidade"), (21, 4, "Tiradentes"), (1, 5, "Dia do Trabalhador"),
        (9, 7, "Revolução Constitucionalista"), (7, 9, "Independência do Brasil"), (12, 10, "N. Srª Aparecida"), (2, 11, "Finados"),
        (15, 11, "Proclamação da República"), (20, 11, "Consciência Negra"), (24, 12, "Véspera de Natal"), (25, 12, "Natal"), (31, 12, "Véspera de Ano Novo"),
    ],
    "en-US": [(1, 1, "New Year's Day"), (4, 7, "Independence Day"), (11, 11, "Veterans Day"), (25, 12, "Christmas Day")],
    "es-ES": [(1, 1, "Año Nuevo"), (1, 5, "Día del Trabajo")],
}
# Fixed values: (days after Easter, name) of moving holidays.
MOVING_HOLIDAYS = {
    "pt-BR": [(-2, "Sexta-Feira Santa"), (0, "Páscoa"), (60, "Corpus Christi")],
    "en-US": [(-2, "Good Friday"), (0, "Easter"), (60, "Corpus Christi")],
    "es-ES": [(-2, "Viernes Santo"), (0, "Pascua"), (60, "Corpus Christi")],
}
# The Portuguese column names, in column order.
PORTUGUESE = """
    Data DataIndice DiasParaHoje DataAtual Ano AnoInicio AnoFim AnoIndice AnoDecrescenteNome
    AnoDecrescenteNumero AnosParaHoje AnoAtual DiaDoMes DiaDoAno DiaDaSemanaNumero DiaDaSemanaNome
    DiaDaSemanaNomeAbreviado DiaDaSemanaNomeIniciais MesNumero MesNome MesNomeAbreviado MesNomeIniciais
    MesAnoNome MesAnoNumero MesDiaNumero MesDiaNome MesInicio MesFim MesIndice MesesParaHoje MesAtualNome
    MesAtualNomeAbreviado MesAnoAtualNome TrimestreNumero TrimestreNome TrimestreAnoNome TrimestreAnoNumero
    TrimestreInicio TrimestreFim TrimestreIndice TrimestresParaHoje TrimestreAtual TrimestreAnoAtual
    MesDoTrimestreNumero SemanaDoAnoNumeroISO AnoISO SemanaAnoNumeroISO SemanaAnoNomeISO SemanaInicioISO
    SemanaFimISO SemanaIndiceISO SemanasParaHojeISO SemanaAtualISO SemanaPeriodoNome SemanaDoMesNumero
    SemestreNumero SemestreAnoNome SemestreAnoNumero SemestreIndice SemestresParaHoje SemestreAtual
    BimestreNumero BimestreAnoNome BimestreAnoNumero BimestreIndice BimestresParaHoje BimestreAtual
    QuinzenaDoMesNumero QuinzenaMesNumero QuinzenaMesNome QuinzenaMesAnoNumero QuinzenaMesAnoNome
    QuinzenaIndice QuinzenasParaHoje QuinzenaAtual DataDeFechamentoRef AnoFechamento MesFechamentoNome
    MesFechamentoNomeAbreviado MesFechamentoNumero MesAnoFechamentoNome MesAnoFechamentoNumero
    EstacaoNorteNumero EstacaoNorteNome EstacaoSulNumero EstacaoSulNome Feriado DiaUtilNumero DiaUtilNome
    AnoFiscalInicialNumero AnoFiscalFinalNumero AnoFiscal AnoFiscalInicio AnoFiscalFim AnoFiscalAtual
    AnosFiscaisParaHoje MesFiscalNumero MesFiscalNome MesFiscalNomeAbreviado MesFiscalAtual MesAnoFiscalNome
    MesAnoFiscalNumero MesAnoFiscalAtual MesesFiscaisParaHoje TrimestreFiscalNumero TrimestreFiscalNome
    MesDoTrimestreFiscalNumero AnoTrimestreFiscalNome AnoTrimestreFiscalNumero TrimestreFiscalInicio
    TrimestreFiscalFim TrimestresFiscaisParaHoje TrimestreFiscalAtual DiaDoTrimestreFiscal
""".split()
# Fixed value: invisible character that gives equal initials a sort order.
ZERO_WIDTH = "​"


def easter(year: Column) -> Column:
    """Easter Sunday of any Gregorian year, by Gauss' integer rule with the corrections of each century."""
    div = lambda x, n: F.floor(x / n).cast("int")
    century = div(year, 100)
    solar, lunar = century - div(century, 4), div(century * 8 + 13, 25)
    age = F.pmod(solar - lunar + 19 * F.pmod(year, F.lit(19)) + 15, F.lit(30))  # days from 21 March to the full moon
    age = F.when((age == 29) | ((age == 28) & (F.pmod(year, F.lit(19)) > 10)), age - 1).otherwise(age)
    full = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), age.cast("int"))
    return F.date_add(full, 8 - F.dayofweek(full))


def bounds_of(dates: DataFrame, column: str, years_ahead: int = 0) -> DataFrame:
    """One row: S (1 January of the first year), T (the last day, taken as today) and E (end of its year)."""
    found = dates.agg(F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("T"))
    return found.select(
        F.trunc("lo", "year").alias("S"), "T", F.make_date(F.year("T") + years_ahead, F.lit(12), F.lit(31)).alias("E")
    )


def holidays(bounds: DataFrame, language: str = "pt-BR") -> DataFrame:
    """(date, holiday) for every year of the bounds; names of one day are joined by ``/``."""
    years = bounds.select(F.explode(F.sequence(F.year("S"), F.year("E"))).alias("y"))
    entries = [
        F.struct(F.lit(i).alias("order"), F.make_date(F.col("y"), F.lit(m), F.lit(d)).alias("date"), F.lit(name).alias("name"))
        for i, (d, m, name) in enumerate(FIXED_HOLIDAYS[language])
    ]
    entries += [
        F.struct(F.lit(100 + i).alias("order"), F.date_add(easter(F.col("y")), days).alias("date"), F.lit(name).alias("name"))
        for i, (days, name) in enumerate(MOVING_HOLIDAYS[language])
    ]
    days = years.select(F.explode(F.array(*entries)).alias("h")).select("h.*")
    names = F.transform(F.sort_array(F.collect_list(F.struct("order", "name"))), lambda h: h["name"])
    return days.groupBy("date").agg(F.array_join(names, "/").alias("holiday"))


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _two(c: Column) -> Column:
    return F.right(c.cast("string"), F.lit(2))


def _half(d: Column) -> Column:
    return F.when(F.month(d) <= 6, 1).otherwise(2)


def _up(c: Column, n: int) -> Column:
    """c / n rounded up, for whole c."""
    return F.floor((c + (n - 1)) / n).cast("int")


def calendar(
    bounds: DataFrame,
    language: str = "pt-BR",
    week_start: int = 0,
    fiscal_end_month: int = 3,
    closing_day: int = 16,
    fixed: bool = False,
) -> DataFrame:
    """One row per day from S to E, columns by their English names.

    ``bounds`` is one row (S, T, E). ``week_start`` counts from Monday = 0. ``fixed`` computes the
    current fiscal year the way each day's own fiscal year is computed; by default it keeps the
    published rule, which is one year ahead of it.
    """
    lab = {k: F.lit(v) for k, v in LABELS[language].items()}
    months, weekdays = MONTHS[language], WEEKDAYS[language]
    d, s, t = F.col("Date"), F.col("S"), F.col("T")
    days = bounds.select("S", "T", F.explode(F.sequence("S", "E", F.expr("interval 1 day"))).alias("Date"))

    def current(test: Column, other: Column) -> Column:
        return F.when(test, lab["current"]).otherwise(other)

    def monday(x: Column) -> Column:
        return F.trunc(x, "week")

    y, m, dom = F.year(d), F.month(d), F.dayofmonth(d)
    q = F.quarter(d)
    dow = F.pmod(F.weekday(d) - week_start, F.lit(7))
    day_name = name_of(weekdays, F.weekday(d) + 1)
    month_name = name_of(months, m)
    month_short = F.left(month_name, F.lit(3))
    month_year = _text(month_short, "/", _two(y))
    months_to = (12 * y + m) - (12 * F.year(t) + F.month(t))
    quarter_name = _text(lab["quarter"], q)
    quarter_year = _text(quarter_name, " ", _two(y))
    quarters_to = (4 * y + q) - (4 * F.year(t) + F.quarter(t))
    week, week_year = F.weekofyear(d), F.extract(F.lit("YEAROFWEEK"), d).cast("int")
    week_name = _text(lab["week"], F.lpad(week.cast("string"), 2, "0"), " ", week_year)
    weeks_to = F.floor(F.datediff(monday(d), monday(t)) / 7).cast("int")
    day_format = "dd/MM/yyyy"
    first_dow = F.pmod(F.weekday(F.trunc(d, "month")) - week_start, F.lit(7))
    half, half_index = _half(d), lambda x: 2 * (F.year(x) - F.year(s)) + _half(x)
    half_name = _text(lab["half"], half, " ", y)
    bim, bim_index = _up(m, 2), lambda x: 6 * (F.year(x) - F.year(s)) + _up(F.month(x), 2)
    bim_name = _text(lab["bimester"], bim, " ", y)
    fort_of = lambda x: F.when(F.dayofmonth(x) <= 15, 1).otherwise(2)
    fort = fort_of(d)
    fort_index = lambda x: 24 * (F.year(x) - F.year(s)) + 2 * (F.month(x) - F.month(s)) + fort_of(x)
    fort_name = _text(month_short, " ", fort)
    closing = F.when(dom <= closing_day, d).otherwise(F.add_months(d, 1))
    closing_name = name_of(months, F.month(closing))
    closing_short = F.left(closing_name, F.lit(3))
    md = m * 100 + dom
    season = F.when(md.between(321, 620), 1).when(md.between(621, 921), 2).when(md.between(922, 1221), 3).otherwise(4)
    pick = lambda names: F.element_at(F.array(*[lab[n] for n in names]), season)
    business = F.when(F.col("Holiday").isNotNull() | (F.weekday(d) > 4), 0).otherwise(1)
    shift = lambda x: F.add_months(x, -fiscal_end_month)
    fy = F.year(shift(d))
    fy_now = F.year(shift(t)) if fixed else F.year(F.add_months(t, 12 - fiscal_end_month))
    fy_name = _text("FY ", fy, "-", fy + 1)
    fy_to = fy - fy_now
    fm, fm_now = F.month(shift(d)), F.month(shift(t))
    this_month = F.trunc(d, "month") == F.trunc(t, "month")
    fy_month_name = _text(month_short, " ", fy_name)
    fq, fq_now = _up(fm, 3), _up(fm_now, 3)
    fq_name = _text("FQ ", fq)
    fy_quarter_name = _text(fq_name, " | ", fy_name)
    month_in_fq = fm - 3 * (fq - 1)
    fq_start = F.trunc(F.add_months(d, 1 - month_in_fq), "month")
    fq_to = 4 * fy_to + fq - fq_now

    columns: dict[str, Column] = {
        # day against the bounds
        "Date": d,
        "DateIndex": F.datediff(d, s) + 1,
        "DaysToToday": F.datediff(d, t),
        "CurrentDate": current(d == t, F.date_format(d, day_format)),
        # year
        "Year": y,
        "YearStart": F.trunc(d, "year"),
        "YearEnd": F.make_date(y, F.lit(12), F.lit(31)),
        "YearIndex": y - F.year(s) + 1,
        "YearDescendingName": y,
        "YearDescendingNumber": -y,
        "YearsToToday": y - F.year(t),
        "CurrentYear": current(y == F.year(t), y.cast("string")),
        # day
        "DayOfMonth": dom,
        "DayOfYear": F.dayofyear(d),
        "DayOfWeekNumber": dow,
        "DayOfWeekName": day_name,
        "DayOfWeekNameShort": F.left(day_name, F.lit(3)),
        "DayOfWeekNameInitials": F.concat(F.repeat(F.lit(ZERO_WIDTH), 7 - dow), F.left(day_name, F.lit(1))),
        # month
        "MonthNumber": m,
        "MonthName": month_name,
        "MonthNameShort": month_short,
        "MonthNameInitials": F.concat(F.repeat(F.lit(ZERO_WIDTH), 12 - m), F.left(month_name, F.lit(1))),
        "MonthYearName": month_year,
        "MonthYearNumber": y * 100 + m,
        "MonthDayNumber": md,
        "MonthDayName": _text(month_short, " ", dom),
        "MonthStart": F.trunc(d, "month"),
        "MonthEnd": F.last_day(d),
        "MonthIndex": 12 * (y - F.year(s)) + m,
        "MonthsToToday": months_to,
        "CurrentMonthName": current(m == F.month(t), month_name),
        "CurrentMonthNameShort": current(m == F.month(t), month_short),
        "CurrentMonthYearName": current(months_to == 0, month_year),
        # quarter
        "QuarterNumber": q,
        "QuarterName": quarter_name,
        "QuarterYearName": quarter_year,
        "QuarterYearNumber": y * 100 + q,
        "QuarterStart": F.trunc(d, "quarter"),
        "QuarterEnd": F.last_day(F.add_months(F.trunc(d, "quarter"), 2)),
        "QuarterIndex": 4 * (y - F.year(s)) + q,
        "QuartersToToday": quarters_to,
        "CurrentQuarter": current(q == F.quarter(t), quarter_name),
        "CurrentQuarterYear": current(quarters_to == 0, quarter_year),
        "MonthOfQuarterNumber": (m - 1) % 3 + 1,
        # ISO week
        "WeekOfYearNumberISO": week,
        "YearISO": week_year,
        "WeekYearNumberISO": week_year * 100 + week,
        "WeekYearNameISO": week_name,
        "WeekStartISO": monday(d),
        "WeekEndISO": F.date_add(monday(d), 6),
        "WeekIndexISO": F.floor(F.datediff(monday(d), monday(s)) / 7).cast("int") + 1,
        "WeeksToTodayISO": weeks_to,
        "CurrentWeekISO": current(weeks_to == 0, week_name),
        "WeekPeriodName": _text(
            week_name, ": ", F.date_format(monday(d), day_format), "~", F.date_format(F.date_add(monday(d), 6), day_format)
        ),
        "WeekOfMonthNumber": F.floor((dom + first_dow - 1) / 7).cast("int") + 1,
        # half
        "HalfNumber": half,
        "HalfYearName": half_name,
        "HalfYearNumber": y * 100 + half,
        "HalfIndex": half_index(d),
        "HalfsToToday": half_index(d) - half_index(t),
        "CurrentHalf": current(half_index(d) == half_index(t), half_name),
        # two months
        "BimesterNumber": bim,
        "BimesterYearName": bim_name,
        "BimesterYearNumber": y * 100 + bim,
        "BimesterIndex": bim_index(d),
        "BimestersToToday": bim_index(d) - bim_index(t),
        "CurrentBimester": current(bim_index(d) == bim_index(t), bim_name),
        # half month
        "FortnightOfMonthNumber": fort,
        "FortnightMonthNumber": m * 10 + fort,
        "FortnightMonthName": fort_name,
        "FortnightMonthYearNumber": y * 10000 + m * 100 + m * 10 + fort,
        "FortnightMonthYearName": _text(lab["fortnight"], fort, " ", month_short, " ", y),
        "FortnightIndex": fort_index(d),
        "FortnightsToToday": fort_index(d) - fort_index(t),
        "CurrentFortnight": current(fort_index(d) == fort_index(t), fort_name),
        # closing month
        "ClosingDateRef": closing,
        "ClosingYear": F.year(closing),
        "ClosingMonthName": closing_name,
        "ClosingMonthNameShort": closing_short,
        "ClosingMonthNumber": F.month(closing),
        "ClosingMonthYearName": _text(closing_short, "/", _two(F.year(closing))),
        "ClosingMonthYearNumber": F.year(closing) * 100 + F.month(closing),
        # seasons; both hemispheres number them alike
        "SeasonNorthNumber": season,
        "SeasonNorthName": pick(["spring", "summer", "autumn", "winter"]),
        "SeasonSouthNumber": season,
        "SeasonSouthName": pick(["autumn", "winter", "spring", "summer"]),
        # business days
        "Holiday": F.col("Holiday"),
        "BusinessDayNumber": business,
        "BusinessDayName": F.when(business == 1, lab["business"]).otherwise(lab["non_business"]),
        # fiscal year
        "FiscalYearStartNumber": fy,
        "FiscalYearEndNumber": fy + 1,
        "FiscalYear": fy_name,
        "FiscalYearStart": F.make_date(fy, F.lit(fiscal_end_month % 12 + 1), F.lit(1)),
        "FiscalYearEnd": F.last_day(F.make_date(fy + 1, F.lit(fiscal_end_month), F.lit(1))),
        "CurrentFiscalYear": current(fy_to == 0, fy_name),
        "FiscalYearsToToday": fy_to,
        # fiscal month
        "FiscalMonthNumber": fm,
        "FiscalMonthName": month_name,
        "FiscalMonthNameShort": month_short,
        "CurrentFiscalMonth": current(this_month, month_name),
        "FiscalYearMonthName": fy_month_name,
        "FiscalYearMonthNumber": fy * 100 + fm,
        "FiscalYearMonthCurrent": current((fy_to == 0) & this_month, fy_month_name),
        "FiscalMonthsToToday": 12 * fy_to + fm - fm_now,
        # fiscal quarter
        "FiscalQuarterNumber": fq,
        "FiscalQuarterName": fq_name,
        "FiscalMonthOfQuarterNumber": month_in_fq,
        "FiscalYearQuarterName": fy_quarter_name,
        "FiscalYearQuarterNumber": fy * 100 + fq,
        "FiscalQuarterStart": fq_start,
        "FiscalQuarterEnd": F.last_day(F.add_months(d, 3 - month_in_fq)),
        "FiscalQuartersToToday": fq_to,
        "CurrentFiscalQuarter": current(fq_to == 0, fy_quarter_name),
        "DayOfFiscalQuarter": F.datediff(d, fq_start) + 1,
    }
    named = holidays(bounds, language).withColumnsRenamed({"date": "Date", "holiday": "Holiday"})
    return days.join(named, "Date", "left").select(*[c.alias(n) for n, c in columns.items()])


def renamed(frame: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Columns renamed by a dictionary (English name to local name); Portuguese when none is given."""
    if names is None:
        names = dict(zip(frame.columns, PORTUGUESE, strict=True))
    return frame.withColumnsRenamed(dict(names))


def labels(spark, language: str) -> DataFrame:
    """(label, text) of one language, from the table of all languages."""
    rows = [(k, *[LABELS[lang][k] for lang in LABELS]) for k in LABELS["en-US"]]
    wide = spark.createDataFrame(rows, ["label", *LABELS])
    long = wide.unpivot(["label"], list(LABELS), "language", "text")
    return long.filter(F.col("language") == language).select("label", "text")
