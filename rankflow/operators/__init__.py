"""DataFrame -> DataFrame operators on poll rows."""

from rankflow.operators.flatten import flatten_rankings, nest_rankings  # noqa: F401
from rankflow.operators.merge import duplicate_keys, merge_teams  # noqa: F401
from rankflow.operators.movers import first_ranks, movers, rank_delta  # noqa: F401
from rankflow.operators.ranks import (  # noqa: F401
    tie_groups, tie_positions, visual_rank, week_groups,
)
from rankflow.operators.seasons import (  # noqa: F401
    filter_poll, require_columns, sample_rows, stamp_season, union_by_name,
)
from rankflow.operators.trajectory import (  # noqa: F401
    chart_rows, emphasis, plot_rank, team_series, top_flag, top_schools, trajectories,
)
from rankflow.operators.weeks import (  # noqa: F401
    attach_weeks, axis_bounds, season_changes, week_dimension,
)
