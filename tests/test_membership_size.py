"""The join of facts to membership follows the membership table's size in memory."""

from fleetscope import schema as S
from fleetscope.operators import membership as M
from fleetscope.plans import fixtures as X
from tests.conftest import SF_SMALL


def test_small_tables_are_broadcast_and_large_ones_are_not(spark):
    cpu = X.load_metrics(spark, SF_SMALL, S.CPU_FAMILY)
    members = M.host_members(cpu)
    plan = lambda limit: cpu.join(M.measured(members, limit), S.SERVER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(M.BROADCAST_BYTES).split("\n== Initial")[0]
    assert "SortMergeJoin" in plan(10)
