"""Column expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output byte for byte.
# Text templates are printf style (format_string prints a null argument as
# "null", as a JS template literal does).
DEFAULT_COLOR = "#ccc"
MUTED_COLOR = "#444"
SNAPSHOT_STAMP_FORMAT = "yyyy-MM-dd'T'HH-mm-ss'Z'"  # e.g. 2024-09-02T12-00-03Z
SEASON_WEEK_FORMAT = "%s/%s"  # season, week
TOOLTIP_FORMAT = "%s: Rank %s (%s)"  # school, rank, seasonWeek
SYMBOL_FELL = "🔽"
SYMBOL_ROSE = "🔼"
SYMBOL_HELD = "➖"
DELTA_LABEL_FORMAT = "%s %s"  # |delta|, symbol
VERB_ROSE = "rose"
VERB_FELL = "fell"
MOVED_FORMAT = "%s %s %s place%s since entering the %s poll"  # school, verb, |delta|, plural, poll
HELD_FORMAT = "%s held steady since entering the %s poll"  # school, poll
DEFAULT_POLL_LABEL = "AP Top 25"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def falsy_or(value, fallback) -> Column:
    """JS ``a || b`` for strings: null and '' both fall back."""
    return F.coalesce(F.nullif(_c(value), F.lit("")), fallback if isinstance(fallback, Column)
                      else F.lit(fallback))


def default_color(color="color") -> Column:
    return falsy_or(color, DEFAULT_COLOR)


def default_logos(logos="logos") -> Column:
    """``logos ?? []``: only null is replaced."""
    return F.coalesce(_c(logos), F.array().cast("array<string>"))


def season_week_label(season="season", week="week") -> Column:
    """``"{season}/{week}"`` as a JS template prints it (null -> 'null')."""
    return F.format_string(SEASON_WEEK_FORMAT, _c(season), _c(week))


def snapshot_stamp(ts) -> Column:
    """UTC stamp used in snapshot keys. ``ts`` should be TIMESTAMP_NTZ in UTC
    (see ``iso_utc`` for LTZ input)."""
    return F.date_format(_c(ts), SNAPSHOT_STAMP_FORMAT)


def snapshot_key(year, dataset: str, ts, area: str = "raw", suffix: str = ".json") -> Column:
    """``{year}/{area}/{dataset}_{stamp}.json``."""
    return F.concat(_c(year).cast("string"), F.lit(f"/{area}/{dataset}_"), snapshot_stamp(ts),
                    F.lit(suffix))


def iso_utc(ts) -> Column:
    """Python ``datetime.isoformat()`` of an aware UTC time: the fraction is
    printed only when it is non-zero. ``ts`` is TIMESTAMP_NTZ holding UTC."""
    t = _c(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(t, "SSSSSS")
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
                 F.lit("+00:00")))


def point_label(rank="rank") -> Column:
    """``rank ?? ''``."""
    return F.coalesce(_c(rank).cast("string"), F.lit(""))


def tooltip(school="school", rank="rank", season_week="seasonWeek") -> Column:
    return F.format_string(TOOLTIP_FORMAT, _c(school), _c(rank), _c(season_week))


def delta_symbol(delta="delta") -> Column:
    d = _c(delta)
    return F.when(d > 0, F.lit(SYMBOL_FELL)).when(d < 0, F.lit(SYMBOL_ROSE)).otherwise(F.lit(SYMBOL_HELD))


def delta_label(delta="delta") -> Column:
    """``"{abs} {symbol}"``."""
    return F.format_string(DELTA_LABEL_FORMAT, F.abs(_c(delta)), delta_symbol(delta))


def delta_title(school="school", delta="delta", poll_label: str = DEFAULT_POLL_LABEL) -> Column:
    d = _c(delta)
    moved = F.format_string(
        MOVED_FORMAT, _c(school), F.when(d < 0, F.lit(VERB_ROSE)).otherwise(F.lit(VERB_FELL)),
        F.abs(d), F.when(F.abs(d) == 1, F.lit("")).otherwise(F.lit("s")), F.lit(poll_label))
    held = F.format_string(HELD_FORMAT, _c(school), F.lit(poll_label))
    return F.when(d == 0, held).otherwise(moved)
