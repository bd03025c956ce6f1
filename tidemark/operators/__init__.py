from tidemark.operators.ranges import ip_range_join
from tidemark.operators.relational import (
    anti,
    flatten_topics,
    high_water_mark,
    incremental_slice,
    mark_shared,
    ordered_limit,
    quality_check,
    semi,
    share_of_total,
    slice_start,
    topics_from_json,
)
from tidemark.operators.running import running_mean_stddev
from tidemark.operators.state import apply_changes, change_set, delete_matching, insert_new, upsert

__all__ = [
    "anti",
    "apply_changes",
    "change_set",
    "delete_matching",
    "flatten_topics",
    "high_water_mark",
    "incremental_slice",
    "insert_new",
    "ip_range_join",
    "mark_shared",
    "ordered_limit",
    "quality_check",
    "running_mean_stddev",
    "semi",
    "share_of_total",
    "slice_start",
    "topics_from_json",
    "upsert",
]
