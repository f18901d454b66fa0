"""DataFrame -> DataFrame operators."""

from .analyses import bucket_stats, device_type_stats, recent_data, recent_device
from .filters import assign_time_bucket, filter_identity, filter_recent, filter_time_range
from .stats import group_stats, usual_counts, usual_rate

__all__ = [
    "assign_time_bucket",
    "bucket_stats",
    "device_type_stats",
    "filter_identity",
    "filter_recent",
    "filter_time_range",
    "group_stats",
    "recent_data",
    "recent_device",
    "usual_counts",
    "usual_rate",
]
