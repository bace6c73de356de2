from rankflow.functions.scalar import (  # noqa: F401
    default_color, default_logos, delta_label, delta_symbol, delta_title, falsy_or,
    iso_utc, point_label, season_week_label, snapshot_stamp, snapshot_key, tooltip,
)
