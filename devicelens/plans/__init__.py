"""Physical-strategy choices the optimizer cannot make on its own."""

from .group_join import GroupStats, attach_group_stats, broadcast_row_budget, plan_group_stats

__all__ = ["GroupStats", "attach_group_stats", "broadcast_row_budget", "plan_group_stats"]
