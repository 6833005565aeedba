"""Scalar expressions of the registry jobs, all built-in functions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The tokens that a dump reader takes for a missing value.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Divisions of the activity classification, with their Portuguese and English labels.
SECTORS = [
    ("01", "03", "Agricultura, pecuaria, producao florestal, pesca e aquicultura", "Agriculture, forestry, fishing and aquaculture"),
    ("05", "09", "Industrias extrativas", "Mining and quarrying"),
    ("10", "33", "Industrias de transformacao", "Manufacturing"),
    ("35", "35", "Eletricidade e gas", "Electricity, gas, steam and air conditioning supply"),
    ("36", "39", "Agua, esgoto, atividades de gestao de residuos e descontaminacao", "Water supply; sewerage, waste management and remediation activities"),
    ("41", "43", "Construcao", "Construction"),
    ("45", "47", "Comercio; reparacao de veiculos automotores e motocicletas", "Wholesale and retail trade; repair of motor vehicles and motorcycles"),
    ("49", "53", "Transporte, armazenagem e correio", "Transportation and storage"),
    ("55", "56", "Alojamento e alimentacao", "Accommodation and food service activities"),
    ("58", "63", "Informacao e comunicacao", "Information and communication"),
    ("64", "66", "Atividades financeiras, de seguros e servicos relacionados", "Financial and insurance activities"),
    ("68", "68", "Atividades imobiliarias", "Real estate activities"),
    ("69", "75", "Atividades profissionais, cientificas e tecnicas", "Professional, scientific and technical activities"),
    ("77", "82", "Atividades administrativas e serviços complementares", "Administrative and support service activities"),
    ("84", "84", "Administracao publica, defesa e seguridade social", "Public administration and defence; compulsory social security"),
    ("85", "85", "Educacao", "Education"),
    ("86", "88", "Saude humana e servicos sociais", "Human health and social work activities"),
    ("90", "93", "Artes, cultura, esporte e recreacao", "Arts, entertainment and recreation"),
    ("94", "96", "Outras atividades de servicos", "Other service activities"),
    ("97", "97", "Servicos domesticos", "Domestic services"),
    ("99", "99", "Organismos internacionais e outras instituicoes extraterritoriais", "Activities of extraterritorial organizations and bodies"),
]
OTHER_SECTOR = ("Outras", "Others")
#: Midpoint in years of each age band.
AGE_MIDPOINTS = {1: 6, 2: 16, 3: 25, 4: 35, 5: 45, 6: 55, 7: 65, 8: 75, 9: 85}


def missing_to_null(c: Column) -> Column:
    """A reader's missing-value tokens as null."""
    return F.when(~c.isin(NA_TOKENS), c)


def decimal_comma(c: Column) -> Column:
    """``"1234,50"`` as 1234.5; null stays null, nonsense raises as any bad cast does."""
    return F.regexp_replace(c, ",", ".").cast("double")


def zfill(c: Column, width: int) -> Column:
    """Left-pad with zeros, never cutting longer values; an empty value becomes all zeros."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def postcode(c: Column) -> Column:
    """Trimmed, without a trailing ``.0``, at least eight digits."""
    return zfill(F.regexp_replace(F.trim(c), r"\.0$", ""), 8)


def clean_token(c: Column) -> Column:
    """Trimmed text with tabs and newlines as spaces; empty and ``nan`` (any case) as null."""
    return F.when(~F.upper(F.trim(c)).isin("", "NAN"), F.trim(F.regexp_replace(c, r"[\t\n\r]", " ")))


def as_double(c: Column) -> Column:
    """``c`` as a double, null where it is none."""
    return c.try_cast("double")


def coordinate_is_valid(c: Column) -> Column:
    """Empty and numeric fields are valid; a row with another is to be dropped."""
    return F.coalesce(F.trim(c) == "", F.lit(True)) | as_double(F.trim(c)).isNotNull()


def safe_parse_date(c: Column) -> Column:
    """``YYYYMMDD`` as a date; null for null, 0, fewer than eight digits and days that don't exist."""
    return F.when(c >= 10000101, F.try_to_date(c.cast("string"), "yyyyMMdd"))


def hash_text(c: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the text; null for null, empty and ``NAN``."""
    return F.when(~F.upper(c).isin("", "NAN"), F.sha2(c, 256))


def month_end_int(month: Column) -> Column:
    """Last day of ``YYYY-MM`` as an integer ``YYYYMMDD``."""
    return F.date_format(F.last_day(F.to_date(F.concat(month, F.lit("-01")))), "yyyyMMdd").cast("int")


def month_range(start: str, end: str) -> list[str]:
    """The month labels from ``start`` to ``end``; an end before the start is an error."""
    (y, m), (last_y, last_m) = (map(int, x.split("-")) for x in (start, end))
    if not (1 <= m <= 12 and 1 <= last_m <= 12) or (y, m) > (last_y, last_m):
        raise ValueError(f"no months from {start} to {end}")
    return [f"{k // 12:04d}-{k % 12 + 1:02d}" for k in range(y * 12 + m - 1, last_y * 12 + last_m)]


def in_list(c: Column, listed: str | None) -> Column:
    """Whether ``c`` is in a comma-separated list, whose items are not trimmed; no list lets all pass, a null value passes no list."""
    return F.lit(True) if listed is None else F.coalesce(F.array_contains(F.split(F.lit(listed), ","), c), F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    return reduce(lambda x, y: x | y, (differs(a, b) for a, b in pairs), F.lit(False))


def score(*conditions: Column) -> Column:
    """How many conditions hold; one that is null does not."""
    return reduce(lambda x, y: x + y, (F.coalesce(c, F.lit(False)).cast("int") for c in conditions))


def given(c: Column) -> Column:
    """Whether a date number is there and not 0."""
    return c.isNotNull() & (c != 0)


def json_image(*columns: str) -> Column:
    """The columns as a JSON object that keeps nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_without(c: Column, *keys: str) -> Column:
    """A flat JSON object without some of its keys."""
    return F.to_json(F.map_filter(F.from_json(c, "map<string,string>"), lambda k, _: ~k.isin(*keys)))


def sector_label(division: Column, english: bool = True) -> Column:
    """Label of a two-digit division; others, null among them, have the label for the rest."""
    out = F.lit(None).cast("string")
    for low, high, pt, en in reversed(SECTORS):
        out = F.when(division.between(low, high), en if english else pt).otherwise(out)
    return F.coalesce(out, F.lit(OTHER_SECTOR[english]))


def age_of_band(band: Column) -> Column:
    """Midpoint age of an age band; null for unknown bands."""
    return reduce(lambda out, x: F.when(band == x[0], x[1]).otherwise(out), AGE_MIDPOINTS.items(), F.lit(None).cast("int"))


def rounded_mean(c: Column) -> Column:
    """Mean rounded half up to two decimals."""
    return F.round(F.avg(c).cast("decimal(20,10)"), 2)


def equal_loosely(a: Column, b: Column) -> Column:
    """Both null, equal as numbers, or equal as trimmed text in any case."""
    x, y = a.cast("string"), b.cast("string")
    same = F.coalesce(as_double(x) == as_double(y), F.lit(False)) | (F.upper(F.trim(x)) == F.upper(F.trim(y)))
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(same)


def composite_key(*columns: str) -> Column:
    return F.concat_ws("-", *columns)
