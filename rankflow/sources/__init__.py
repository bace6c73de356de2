"""Sources and sinks: snapshot listings, JSON readers, the columnar codec."""

from rankflow.sources.columnar import (  # noqa: F401
    decode_columnar, decode_snapshot, encode_columnar, encode_rows,
)
from rankflow.sources.readers import (  # noqa: F401
    bad_documents, good_documents, land_raw, land_raw_files, parse_documents, read_documents, read_rankings, read_teams, stamp_now,
    unwrap_envelope,
)
from rankflow.sources.snapshots import (  # noqa: F401
    available_seasons, latest_per_group, latest_poll, latest_poll_per_season, latest_snapshot,
    list_files, newest, poll_files, season_files, with_season,
)
