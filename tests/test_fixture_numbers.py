"""The fixture mapping at sf0.01 reproduces the counts measured when the
"""

from pyspark.sql import functions as F

from rankflow.operators.flatten import nest_rankings
from rankflow.operators.movers import movers
from rankflow.operators.ranks import tie_groups
from rankflow.operators.trajectory import trajectories
from rankflow.plans import fixtures
from rankflow.plans.queries import _slice

SF = "/root/testdata/sf0.01"


def test_sf001_counts(spark):
    rows = fixtures.poll_rows(spark, SF)
    assert rows.count() == 10169
    assert nest_rankings(rows).count() == 159
    sl = _slice(spark, SF)
    assert sl.count() == 1232
    assert sl.select("season", "week").distinct().count() == 79
    assert sl.select("season").distinct().count() == 7
    assert tie_groups(sl).where(F.col("isTie")).count() == 196
    traj = trajectories(sl)
    assert traj.where("isCurrent").select("school").distinct().count() == 15
    assert movers(traj).count() == 15
