"""Column -> Column helpers (the scalar functions of the engine).

All of them are plain compositions of built-in Spark expressions, so they stay
inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- fixed values that must equal the reference's labels -------------------
# Shift of day by arrival hour: 7-11, 12-17, 18-23, else.
SHIFT_LABELS = ("Manhã", "Tarde", "Noite", "Madrugada")
# Age bands, in order, with their inclusive bounds; everything else (incl.
# negative ages) falls in the last label.
AGE_BANDS = (
    (0, 2, "0 a 2"), (3, 5, "3 a 5"), (6, 8, "6 a 8"), (9, 11, "9 a 11"),
    (12, 14, "12 a 14"), (15, 19, "15 a 19"), (20, 29, "20 a 29"),
    (30, 39, "30 a 39"), (40, 49, "40 a 49"), (50, 59, "50 a 59"),
)
AGE_BAND_ELSE = "60 ou mais"
# SLA bands of the total stay.
SLA_LABELS = ("Alta não registrada", "Registro inconsistente", "Dentro da meta",
              "Fora da meta", "Muito fora da meta")
# Missing risk colour label.
NO_CLASSIFICATION = "Ausência de Classificação"
# Portuguese month abbreviations, January..December.
MONTH_ABBREV_PT = ("Jan", "Fev", "Mar", "Abr", "Mai", "Jun",
                   "Jul", "Ago", "Set", "Out", "Nov", "Dez")
# Service categories.
SERVICE_PEDIATRICS = "PEDIATRIA"
SERVICE_SURGERY = "CIRURGIA GERAL"
SERVICE_ORTHO = "ORTOPEDIA/TRAUMATOLOGIA"
SERVICE_CARDIO = "CARDIOLOGIA"
SERVICE_GENERAL = "CLINICA MEDICA"
SERVICE_OTHER = "OUTROS"
CARDIO_SPECIALTIES = ("MEDICO CARDIOLOGISTA", "CIRURGIA CARDIOVASCULAR")
GENERAL_SPECIALTIES = ("CLINICA MEDICA", "GENERALISTA")
# Excel serial day zero and the serial-number pattern.
EXCEL_EPOCH = "1899-12-30 00:00:00"
EXCEL_SERIAL_PATTERN = r"^[0-9]+\.?[0-9]*$"
TIME_PATTERN = r"^\d{2}:\d{2}:\d{2}$"
CORRECTION_TS_FORMAT = "dd/MM/yyyy HH:mm:ss"
# Text written for missing cells by a pandas string conversion.
NULL_SENTINELS = ("NaT", "nan", "None", "")
# ---------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- time arithmetic (rule MIN) --------------------------------------------

def trunc_minute(ts: ColumnOrName) -> Column:
    """Truncate to the minute, keeping TIMESTAMP_NTZ."""
    return F.date_trunc("minute", _c(ts)).cast("timestamp_ntz")


def minute_number(ts: ColumnOrName) -> Column:
    """Minutes from the epoch's first to the one that holds ``ts``, from its date and
    clock: no conversion between time zones, which cost more than all else here."""
    t = _c(ts)
    return F.unix_date(F.to_date(t)).cast("long") * 1440 + F.hour(t) * 60 + F.minute(t)


def minutes_boundary(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Number of minute boundaries crossed from start to end (signed)."""
    return minute_number(end) - minute_number(start)


def minutes_whole(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole minutes elapsed from start to end (signed, truncated)."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def hours_whole(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.timestamp_diff("HOUR", _c(start), _c(end))


def step_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Guarded step duration: NULL when end is NULL or precedes start."""
    return step_of(start, end, minutes_boundary(end, start))


def step_of(start: ColumnOrName, end: ColumnOrName, minutes: ColumnOrName) -> Column:
    """``step_minutes`` of a step whose minutes are known."""
    s, e = _c(start), _c(end)
    return (F.when(e.isNull(), F.lit(None))
            .when(e < s, F.lit(None))
            .otherwise(_c(minutes)))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Unguarded duration: negative values are kept."""
    return minutes_boundary(end, start)


# ---- casts ------------------------------------------------------------------

def excel_or_datetime(text: ColumnOrName) -> Column:
    """Text to TIMESTAMP_NTZ; a bare number is an Excel serial day count.

    The serial is turned into whole seconds after day zero with a day-time
    interval (``timestampadd`` would overflow an int at ~3.97e9 s).
    """
    t = _c(text)
    secs = F.round(t.cast("double") * F.lit(86400)).cast("long")
    serial = F.lit(EXCEL_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))
    # a text with a dash is no serial: told without the pattern, which costs more than the cast
    return F.when(~t.contains("-") & t.rlike(EXCEL_SERIAL_PATTERN), serial).otherwise(t.cast("timestamp_ntz"))


def strict_long(text: ColumnOrName) -> Column:
    """Strict integer cast (bad text fails the job under ANSI mode)."""
    return _c(text).cast("long")


def strict_date(text: ColumnOrName) -> Column:
    return _c(text).cast("date")


def safe_long(text: ColumnOrName) -> Column:
    return _c(text).try_cast("long")


def safe_date(text: ColumnOrName) -> Column:
    return _c(text).try_cast("date")


def safe_datetime(text: ColumnOrName, fmt: str = CORRECTION_TS_FORMAT) -> Column:
    return F.try_to_timestamp(_c(text), F.lit(fmt)).cast("timestamp_ntz")


def period_date(text: ColumnOrName) -> Column:
    """``YYYY-MM`` text to the first day of that month."""
    return F.to_date(_c(text), "yyyy-MM")


def time_text(text: ColumnOrName) -> Column:
    """Time of day kept as ``HH:mm:ss`` text (lexicographic = time order);
    anything that is not a time becomes NULL."""
    t = F.trim(_c(text))
    return F.when(t.rlike(TIME_PATTERN), t)


def hhmm_to_time_text(text: ColumnOrName) -> Column:
    """``HH:mm`` → ``HH:mm:00``."""
    return time_text(F.concat(_c(text), F.lit(":00")))


# ---- text -------------------------------------------------------------------

def token(text: ColumnOrName, sep: str = " - ", index: int = 1) -> Column:
    """Trimmed ``index``-th (0-based) piece of ``text`` split on ``sep``;
    NULL when there are fewer pieces (instead of failing the job)."""
    return F.trim(F.get(F.split(_c(text), re.escape(sep)), index))


def null_sentinels(text: ColumnOrName, sentinels: Sequence[str] = NULL_SENTINELS) -> Column:
    t = _c(text)
    return F.when(t.isin(list(sentinels)), F.lit(None)).otherwise(t)


def default_if_blank(text: ColumnOrName, label: str = NO_CLASSIFICATION) -> Column:
    t = _c(text)
    return F.when(t.isNull() | (t == F.lit("")), F.lit(label)).otherwise(t)


def blank_to(value: ColumnOrName, fallback: ColumnOrName) -> Column:
    """Blank input falls back to another value."""
    return F.coalesce(F.nullif(F.trim(_c(value)), F.lit("")), _c(fallback))


def first_non_empty(cols: Iterable[ColumnOrName], default: str) -> Column:
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols], F.lit(default))


def is_numeric(text: ColumnOrName) -> Column:
    """A number is not ``NaN``: such text is a missing value."""
    number = F.trim(_c(text)).try_cast("double")
    return number.isNotNull() & ~F.isnan(number)


def is_time(text: ColumnOrName) -> Column:
    t = _c(text)
    return t.isNotNull() & F.trim(t).rlike(TIME_PATTERN)


def stable_id(*cols: ColumnOrName) -> Column:
    """Deterministic id for a record (replaces a random uuid)."""
    return F.sha2(F.concat_ws("|", *[_c(c).cast("string") for c in cols]), 256)


def lookup(key: ColumnOrName, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Dictionary lookup with default, as a literal map (no join)."""
    if mapping:
        m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        val = F.try_element_at(m, _c(key))
    else:
        val = F.lit(None).cast("string")
    return F.coalesce(val, F.lit(default)) if default is not None else val


# ---- categorisation -----------------------------------------------------------

def service_category(age: ColumnOrName, specialty: ColumnOrName, *,
                     surgery: str = SERVICE_SURGERY, ortho: str = SERVICE_ORTHO,
                     cardio: Sequence[str] = CARDIO_SPECIALTIES,
                     general: Sequence[str] = GENERAL_SPECIALTIES,
                     child_below: int = 15) -> Column:
    """Ordered CASE on age and specialty. NULL age never matches the age
    tests, so it falls through to the specialty branches or OUTROS."""
    a, s = _c(age), _c(specialty)
    return (F.when((a < child_below) & (s != surgery) & (s != ortho), F.lit(SERVICE_PEDIATRICS))
            .when(s == surgery, F.lit(SERVICE_SURGERY))
            .when(s == ortho, F.lit(SERVICE_ORTHO))
            .when(s.isin(list(cardio)), F.lit(SERVICE_CARDIO))
            .when((a > child_below - 1) & s.isin(list(general)), F.lit(SERVICE_GENERAL))
            .otherwise(F.lit(SERVICE_OTHER)))


def shift_of_day(ts: ColumnOrName) -> Column:
    t = _c(ts)
    h = F.hour(t)
    return (F.when(t.isNull(), F.lit(None).cast("string"))
            .when(h.between(7, 11), F.lit(SHIFT_LABELS[0]))
            .when(h.between(12, 17), F.lit(SHIFT_LABELS[1]))
            .when(h.between(18, 23), F.lit(SHIFT_LABELS[2]))
            .otherwise(F.lit(SHIFT_LABELS[3])))


def age_band(age: ColumnOrName) -> Column:
    a = _c(age)
    expr = F.when(a.isNull(), F.lit(None).cast("string"))
    for lo, hi, label in AGE_BANDS:
        expr = expr.when(a.between(lo, hi), F.lit(label))
    return expr.otherwise(F.lit(AGE_BAND_ELSE))


def in_target_flag(start: ColumnOrName, end: ColumnOrName, target_minutes: int = 360) -> Column:
    """1 when the stay is within target; NULL end → 0; negative stays → 1."""
    return stay_in_target(end, minutes_boundary(end, start), target_minutes)


def stay_in_target(end: ColumnOrName, minutes: ColumnOrName, target_minutes: int = 360) -> Column:
    """``in_target_flag`` of a stay whose minutes are known."""
    return (F.when(_c(end).isNull(), F.lit(0))
            .when(_c(minutes) <= target_minutes, F.lit(1))
            .otherwise(F.lit(0)))


def sla_band(start: ColumnOrName, end: ColumnOrName, target_minutes: int = 360,
             limit_minutes: int = 720) -> Column:
    return stay_band(end, minutes_boundary(end, start), target_minutes, limit_minutes)


def stay_band(end: ColumnOrName, minutes: ColumnOrName, target_minutes: int = 360,
              limit_minutes: int = 720) -> Column:
    """``sla_band`` of a stay whose minutes are known."""
    m = _c(minutes)
    return (F.when(_c(end).isNull(), F.lit(SLA_LABELS[0]))
            .when(m < 0, F.lit(SLA_LABELS[1]))
            .when(m <= target_minutes, F.lit(SLA_LABELS[2]))
            .when(m <= limit_minutes, F.lit(SLA_LABELS[3]))
            .otherwise(F.lit(SLA_LABELS[4])))


def month_abbrev(month: ColumnOrName) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTH_ABBREV_PT]), _c(month).cast("int"))


def period_label(period: ColumnOrName) -> Column:
    p = _c(period)
    return F.concat(month_abbrev(F.month(p)), F.lit("/"), F.year(p).cast("string"))


def rank_points(rank: ColumnOrName, points: Sequence[int]) -> Column:
    """Rank 1..len(points) → points[rank-1]; any other rank → NULL."""
    r = _c(rank)
    return F.when(r >= 1, F.try_element_at(F.lit(list(points)), r.cast("int")))
