"""Billing-event reports and keyed-lookup analytics on Spark DataFrames."""

from meterline.functions import hit_percentage
from meterline.operators.dimension import find, last_write, load_counters, lookup, upsert
from meterline.operators.ordered import repeat_within, running_hit_rate
from meterline.operators.prepare import prepare
from meterline.operators.reports import (
    daily_revenue,
    interval_count_by_name,
    interval_min_max,
    interval_revenue,
)
from meterline.operators.requests import (
    oldest_key,
    recent_keys,
    request_stats,
    response_roll_up,
    response_times,
    response_times_from,
)
from meterline.operators.rollup import roll_up
from meterline.plans import (
    answer_requests,
    load_dimension,
    load_into,
    put_rows,
    rate_load,
    read_loads,
    read_roll_up,
    refresh_roll_up,
    report_set,
    run_reports,
)
from meterline.schemas import BRIEF, FULL, Layout
from meterline.session import build_session, object_store_settings
from meterline.sinks import (
    VersionConflict,
    drop_old,
    held_table,
    land_cdr,
    log_messages,
    merge_buckets,
    merge_table,
    merge_version,
    preview,
    write_changes,
    write_report,
    write_request_log,
    write_version,
)
from meterline.sinks.joined import join_batches, read_batches
from meterline.sources import (
    builtin_mapping,
    empty_dimension,
    load_mapping,
    parse_log_messages,
    read_cdr,
    read_dimension,
    read_dimension_files,
    read_landed_cdr,
    read_request_log,
    stream_cdr,
    stream_request_log,
)
from meterline.streaming import (
    join_progress,
    log_progress,
    progress_rows,
    read_complete,
    read_updates,
    start_answers,
    start_lookups,
    start_reports,
    stop_all,
    stream_appended,
    stream_complete,
    stream_messages,
    stream_updates,
    stream_upsert,
)
