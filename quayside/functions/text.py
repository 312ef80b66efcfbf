"""Name normalisation, fixed-width text, and display formats, all as built-in expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that have no decomposition and are written with other letters.
STROKES = {"Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ŧ": "T", "ŧ": "t", "ĸ": "k"}
LIGATURES = {"ß": "ss", "ẞ": "SS", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "Þ": "TH", "þ": "th", "ð": "d", "Ð": "D", "ĳ": "ij", "Ĳ": "IJ"}
LATIN = [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]


def _plain_letters() -> dict[str, str]:
    """Every accented letter of the Latin blocks, and the letter that its decomposition begins with."""
    first = {chr(i): unicodedata.normalize("NFD", chr(i))[0] for i in LATIN}
    return {a: b for a, b in first.items() if a != b and b.isascii() and b.isalpha()} | STROKES


_LETTERS = _plain_letters()
ACCENTED, PLAIN = "".join(_LETTERS), "".join(_LETTERS.values())

# Month and weekday names (Monday first).
MONTHS = {
    "pt-BR": "Janeiro Fevereiro Março Abril Maio Junho Julho Agosto Setembro Outubro Novembro Dezembro".split(),
    "en-US": "January February March April May June July August September October November December".split(),
    "es-ES": "Enero Febrero Marzo Abril Mayo Junio Julio Agosto Septiembre Octubre Noviembre Diciembre".split(),
}
WEEKDAYS = {
    "pt-BR": "Segunda-Feira Terça-Feira Quarta-Feira Quinta-Feira Sexta-Feira Sábado Domingo".split(),
    "en-US": "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split(),
    "es-ES": "Lunes Martes Miércoles Jueves Viernes Sábado Domingo".split(),
}


def unaccent(c: Column) -> Column:
    for ligature, plain in LIGATURES.items():
        c = F.replace(c, F.lit(ligature), F.lit(plain))
    return F.translate(c, ACCENTED, PLAIN)


def normalize_name(c: Column) -> Column:
    """The comparison key of a place name: no accents, lower case, letters only.

    Text of one byte per character holds no accents and skips the letter-by-letter translation.
    """
    plain = F.when(F.octet_length(c) == F.char_length(c), c).otherwise(unaccent(c))
    return F.regexp_replace(F.lower(plain), "[^a-z]+", "")


def varchar(c: Column, n: int) -> Column:
    """Cut to n characters; a cast to varchar(n) would not cut."""
    return F.left(c.cast("string"), F.lit(n))


def char(c: Column, n: int) -> Column:
    """Cut to n characters; padding blanks carry no meaning, so they are dropped."""
    return F.rtrim(varchar(c, n))


def name_of(names: list[str], position: Column) -> Column:
    """The 1-based entry of a fixed list of names."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def month_label(d: Column, language: str = "pt-BR") -> Column:
    """Short month and two-digit year, such as ``Mar/24``."""
    return F.concat(F.left(name_of(MONTHS[language], F.month(d)), F.lit(3)), F.lit("/"), F.date_format(d, "yy"))


def month_year_label(d: Column, language: str = "pt-BR") -> Column:
    """Lower-case short month and full year, such as ``mar/2024``."""
    return F.concat(
        F.lower(F.left(name_of(MONTHS[language], F.month(d)), F.lit(3))), F.lit("/"), F.date_format(d, "yyyy")
    )


def _fixed(c: Column, digits: int) -> Column:
    return F.round(c.cast("double"), digits)


def magnitude(v: Column, absolute: bool = False) -> Column:
    """A value in billions, millions, thousands or units; ``absolute`` picks the unit by size alone."""
    size = F.abs(v) if absolute else v
    x = v.cast("double")
    return (
        F.when(size > 1_000_000_000, F.format_string("%.2f Bi", _fixed(x / 1e9, 2)))
        .when(size > 1_000_000, F.format_string("%.2f Mi", _fixed(x / 1e6, 2)))
        .when(size > 1_000, F.format_string("%.2f K", _fixed(x / 1e3, 2)))
        .when(size.isNotNull(), F.format_string("%.0f", _fixed(x, 0)))
    )


def weight(v: Column) -> Column:
    """Tonnes from 1000 kg on, kilograms below."""
    x = v.cast("double")
    return F.when(F.abs(v) >= 1000, F.format_string("%,.2f Ton", _fixed(x / 1000, 2))).when(
        v.isNotNull(), F.format_string("%.0f Kg", _fixed(x, 0))
    )


def percent(v: Column, digits: int = 1) -> Column:
    return F.when(v.isNotNull(), F.format_string(f"%.{digits}f%%", _fixed(v * 100, digits)))


def whole_percent(v: Column) -> Column:
    """Whole percent with at least two digits."""
    return F.when(v.isNotNull(), F.format_string("%02.0f%%", _fixed(v * 100, 0)))


def price(v: Column) -> Column:
    return F.when(v.isNotNull(), F.format_string("%.2f U$/kg", _fixed(v, 2)))


def times(v: Column) -> Column:
    return F.when(v.isNotNull(), F.format_string("%.0fx", _fixed(v, 0)))


def signed_points(v: Column) -> Column:
    """Signed difference in points; no sign on zero."""
    r = F.abs(_fixed(v, 1))
    sign = F.when(v > 0, "+").when(v < 0, "-").otherwise("")
    return F.when(v.isNotNull(), F.format_string("%s%.1f p.p.", sign, r))


def fill(template: str, **parts: Column) -> Column:
    """A sentence from a template with ``{name}`` places; a missing part is left out of the text."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(F.coalesce(parts[piece].cast("string"), F.lit("")))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)
