"""The catalog's queries in SQL, for an independent check on the same tables.

Written with plain windows over the whole table, after the definition of a
session, and not after the way the operators go about it.
"""

from __future__ import annotations

HALF_HOUR_MS = 1_800_000
SIX_HOURS_MS = 21_600_000

_DIMS = "device_family, os_family, browser_family"
_EVENT = (
    f"anonymous_id, {_DIMS}, device_sent_timestamp, event, n, file"
)
_TIME = "strftime(make_timestamp(device_sent_timestamp * 1000), '%Y-%m-%d %H:%M:%S.%g')"


#: Clicks on time (``ontime``) of a stream in four batches by time of arrival, judged by
#: the latest time of the batches before, less two days.
_STREAM = """
), fed as (
  select *, device_sent_timestamp
      + case when n % 11 = 0 then 518400000 else n % 7 * 21600000 end as arrived from clicks
), bounds as (
  select min(arrived) as low, max(arrived) as high from fed
), parts as (
  select fed.*, (arrived - low) * 4 // (high - low + 1) as batch from fed, bounds
), marks as (
  select batch, max(max(device_sent_timestamp)) over (
      order by batch rows between unbounded preceding and 1 preceding) - 172800000 as mark
  from parts group by batch
), judged as (
  select parts.*, device_sent_timestamp < coalesce(mark, 0) as late from parts join marks using (batch)
), ontime as (
  select * from judged where not late
"""
_PASSED = """device_sent_timestamp - device_sent_timestamp % 86400000 + 86400000
    <= (select max(device_sent_timestamp) - 172800000 from clicks)"""


def _with(
    gap_ms: int, mode: str = "compat", per_file: bool = False, more: str = "", source: str = "clicks"
) -> str:
    """CTEs: ``clicks``, ``more``, ``gaps`` and the sessionized ``sess`` of ``source``."""
    scope = "file, " if per_file else ""
    owner = f"{scope}anonymous_id"
    fill = owner if mode == "compat" else f"{owner}, {_DIMS}"
    return f"""
with raw as (
  select *, cast(json_extract_string(props, '$.k') as int) as k from events
), clicks as (
  select cast(user_id as varchar) as anonymous_id, event_type as browser_family,
         case when k % 10 = 0 then null when k % 10 = 1 then 'dev,1'
              else 'dev_' || (k % 3) end as device_family,
         epoch_us(ts) // 1000 as device_sent_timestamp, event_type as event,
         event_id as n, 'os_' || (user_id % 3) as os_family,
         strftime(ts, '%Y-%m-%d') as file
  from raw
{more}), lagged as (
  select *, lag(device_sent_timestamp) over (
           partition by {owner}, {_DIMS} order by device_sent_timestamp, n) as lag
  from {source}
), gaps as (
  select *, cast(device_sent_timestamp - lag as double) / 1000 as raw_delta,
         coalesce(device_sent_timestamp - lag < {gap_ms}, false) as same_section,
         {_TIME} as event_time
  from lagged
), tagged as (
  select *, case when same_section then raw_delta else 0.0::double end as delta_seg,
         case when not same_section then 'session_' || row_number() over (
           partition by {owner}, same_section
           order by device_sent_timestamp, n, {_DIMS}) end as partial_session
  from gaps
), sess as (
  select *, last_value(partial_session ignore nulls) over (
           partition by {fill} order by device_sent_timestamp)
         || '_' || anonymous_id as session_id
  from tagged
)
"""


def _each_dim(select: str, source: str, group: str = "", where: str = "true") -> str:
    """A union of one aggregate per dimension; ``{ref}`` is the reported value."""
    return " union all ".join(
        f"""select {group} '{d}' as what,
                   ltrim(coalesce({d}, 'Not Identified')) as ref, {select}
            from {source} where {where} group by all"""
        for d in ("device_family", "os_family", "browser_family")
    )


_COUNT = "count(session_id) as qtd_session"
_NEW = "not same_section"
_LOW = "quantile_disc(delta_seg, 0.5) as median"
_MIDDLE = """median(cast(device_sent_timestamp - lag as bigint)) / 1000 as median"""

_6H = _with(SIX_HOURS_MS)
_30M = _with(HALF_HOUR_MS)
_6H_STRICT = _with(SIX_HOURS_MS, "strict")
_6H_FILE = _with(SIX_HOURS_MS, per_file=True)

_6H_STREAM = _with(SIX_HOURS_MS, "strict", more=_STREAM, source="ontime")
_6H_STREAM_COMPAT = _with(SIX_HOURS_MS, more=_STREAM, source="ontime")

_BY_DIM_6H = f"{_6H} {_each_dim(_COUNT, 'sess', where=_NEW)}"
_BY_DIM_FILE = f"""{_6H_FILE}, parts as ({_each_dim(_COUNT, 'sess', 'file,', _NEW)})
    select what, ref, cast(sum(qtd_session) as bigint) as qtd_session
    from parts group by all"""
_GAPS_COLUMNS = f"{_EVENT}, cast(lag as double) as lag, raw_delta as delta_seg, same_section, event_time"
_SESSION_COLUMNS = f"{_EVENT}, delta_seg, same_section, event_time, session_id"
_MEDIAN_6H = f"{_6H} {_each_dim(_LOW, 'sess', where='same_section')}"
_MEDIAN_FILE = f"{_6H_FILE} {_each_dim(_LOW, 'sess', 'file,', 'same_section')}"
_FOLD = f"""{_6H_FILE}, parts as ({_each_dim(_LOW, 'sess', 'file,', 'same_section')})
    select what, ref, list_reduce(list_prepend(0.0::double, list(median order by file)),
                                  lambda x, y: (x + y) / 2) as median
    from parts group by all"""
_ALL_FILES_MEDIAN = f"{_6H_FILE} {_each_dim(_LOW, 'sess', where='same_section')}"
_STARTS = f"""select anonymous_id, {_DIMS}, device_sent_timestamp as start_ts,
    1::bigint as starts from sess where not same_section"""
_PER_FILE = f"{_6H_FILE} select file, {_COUNT} from sess where {_NEW} group by file"


def _by(dim: str) -> str:
    return f"{_6H} select {dim}, {_COUNT} from sess where {_NEW} group by {dim}"


def _json_object(key: str, value: str) -> str:
    item = f"to_json({key}) || ':' || {value}"
    return f"'{{' || string_agg({item}, ',' order by {key}) || '}}'"


def oracles() -> dict[str, str]:
    return {
        "event_count": "select count(*) as events from events",
        "json_round_trip": f"""{_6H} select same_section, count(*) as events,
            cast(sum(device_sent_timestamp - lag) as bigint) as gap_ms
            from gaps group by same_section""",
        "application_run": f"""{_6H}, counts as (
            select 'all' as what, '*' as ref, {_COUNT} from sess where {_NEW}
            union all {_each_dim(_COUNT, 'sess', where=_NEW)}),
            medians as ({_each_dim(_LOW, 'sess', where='same_section')})
            select what, ref, qtd_session, median from counts left join medians using (what, ref)""",
        "application_run_per_file": f"""{_6H_FILE} select file as day, {_COUNT}
            from sess where {_NEW} group by file union all select '2000-01-01', 0""",
        "result_json": f"""{_6H}, rows_ as ({_each_dim(_COUNT, 'sess', where=_NEW)})
            select what, {_json_object('ref', 'qtd_session')} as json
            from rows_ group by what""",
        "result_json_document": f"""{_6H},
            rows_ as ({_each_dim(_COUNT, 'sess', where=_NEW)}),
            objects as (select what, {_json_object('ref', 'qtd_session')} as obj
                        from rows_ group by what)
            select {_json_object('what', 'obj')} as json from objects""",
        "sessions_per_file_json": f"""{_6H_FILE}, rows_ as (
            select file, {_COUNT} from sess where {_NEW} group by file)
            select {_json_object('file', 'qtd_session')} as json from rows_""",
        "question_files": f"""{_6H_FILE},
            one as (select file, {_COUNT} from sess where {_NEW} group by file),
            two as ({_each_dim(_COUNT, 'sess', where=_NEW)}),
            three as ({_each_dim(_LOW, 'sess', where='same_section')}),
            two_by as (select what, {_json_object('ref', 'cast(qtd_session as double)')} as obj
                       from two group by what),
            three_by as (select what, {_json_object('ref', 'median')} as obj
                         from three group by what)
            select 1 as question, {_json_object('file', 'qtd_session')} as json from one
            union all select 2, {_json_object('what', 'obj')} from two_by
            union all select 3, {_json_object('what', 'obj')} from three_by""",
        "clickstream_in_order": f"{_6H} select {_SESSION_COLUMNS} from sess",
        "file_values": f"{_6H} select file, count(*) as events from clicks group by file",
        "approx_quantile_gap": f"""{_6H} select count(*) as gaps, true as proven,
            greatest(cast(ceil(count(*) * 0.5) as bigint) - count(*) // 4, 1) as rank_from,
            least(cast(ceil(count(*) * 0.5) as bigint) + count(*) // 4, count(*)) as rank_to
            from sess where same_section""",
        "session_gaps": f"{_30M} select {_GAPS_COLUMNS} from gaps",
        "session_gaps_6h": f"{_6H} select {_GAPS_COLUMNS} from gaps",
        "session_gaps_ticks": f"{_6H} select {_GAPS_COLUMNS} from gaps",
        "sessionize_compat": f"{_30M} select {_SESSION_COLUMNS} from sess",
        "sessionize_compat_6h": f"{_6H} select {_SESSION_COLUMNS} from sess",
        "sessionize_compat_ticks": f"{_6H} select {_SESSION_COLUMNS} from sess",
        "sessionize_compat_per_file": f"{_6H_FILE} select {_SESSION_COLUMNS} from sess",
        "sessionize_strict": f"{_6H_STRICT} select {_SESSION_COLUMNS} from sess",
        "sessionize_strict_ticks": f"{_6H_STRICT} select {_SESSION_COLUMNS} from sess",
        "session_smoke": f"""{_6H} select {_EVENT}, delta_seg, same_section, event_time,
            partial_session from tagged""",
        "session_starts": f"{_30M} {_STARTS}",
        "session_starts_6h": f"{_6H} {_STARTS}",
        "session_start_rows": f"""{_6H} select anonymous_id, device_sent_timestamp,
            session_id from sess where not same_section""",
        "sessions_total": f"{_6H} select {_COUNT} from sess where {_NEW}",
        "sessions_per_file": _PER_FILE,
        "sessions_by_browser": _by("browser_family"),
        "sessions_by_os": _by("os_family"),
        "sessions_by_device": _by("device_family"),
        "sessions_by_dim": f"{_30M} {_each_dim(_COUNT, 'sess', where=_NEW)}",
        "sessions_by_dim_6h": _BY_DIM_6H,
        "sessions_by_dim_from_events": _BY_DIM_6H,
        "fold_counts": _BY_DIM_FILE,
        "median_gap_by_dim": _MEDIAN_6H,
        "median_gap_by_dim_30m": f"{_30M} {_each_dim(_LOW, 'sess', where='same_section')}",
        "median_gap_exact": _MEDIAN_6H,
        "median_gap_between": f"{_6H} {_each_dim(_MIDDLE, 'sess', where='same_section')}",
        "median_gap_ticks": _MEDIAN_6H,
        "median_gap_per_file": _MEDIAN_FILE,
        "fold_median_compat": _FOLD,
        "median_kll": _ALL_FILES_MEDIAN,
        "median_gap_by_session": f"""{_6H} select session_id, {_LOW}
            from sess group by session_id""",
        "median_gap_rounded": f"""{_6H}, once as (
            select distinct session_id, cast(round(delta_seg * 1000) as bigint) as ms
            from sess)
            select session_id,
                   cast(round_even(median(ms) / 1000 * 100, 0) / 100 as real) as median
            from once group by session_id""",
        "half_event_count": f"""{_6H} select session_id, count(delta_seg) / 2 as central
            from sess group by session_id""",
        "session_durations": f"""{_6H_STRICT} select anonymous_id, session_id,
            max(device_sent_timestamp) - min(device_sent_timestamp) as duration_ms,
            cast(max(device_sent_timestamp) - min(device_sent_timestamp) as double) / 1000
              as duration
            from sess group by anonymous_id, session_id""",
        "median_session_duration_by_dim": f"""{_6H_STRICT}, spans as (
            select {_DIMS}, session_id, cast(max(device_sent_timestamp)
                - min(device_sent_timestamp) as double) / 1000 as delta_seg
            from sess group by all)
            {_each_dim(_LOW, 'spans')}""",
        "top_users": f"""{_6H} select anonymous_id, count(*) as count from clicks
            group by anonymous_id order by count desc, anonymous_id limit 10""",
        "user_timeline": f"""{_6H} select {_EVENT} from clicks where anonymous_id = (
            select anonymous_id from clicks group by 1 order by count(*) desc, 1 limit 1)""",
        "one_session": f"""{_6H} select {_SESSION_COLUMNS} from sess where session_id = (
            select session_id from sess group by 1 order by count(*) desc, 1 limit 1)""",
        "busiest_user_timeline": f"""{_6H} select {_EVENT} from clicks where anonymous_id = (
            select anonymous_id from clicks group by 1 order by count(*) desc, 1 limit 1)""",
        "busiest_session": f"""{_6H} select {_SESSION_COLUMNS} from sess where session_id = (
            select session_id from sess group by 1 order by count(*) desc, 1 limit 1)""",
        "half_event_count_per_file": f"""{_6H_FILE} select file, session_id,
            count(delta_seg) / 2 as central from sess group by file, session_id""",
        "distinct_gaps_per_file": f"""{_6H_FILE}
            select distinct file, session_id, delta_seg from sess""",
        "mixed_json_numbers": f"""{_6H} select {_COUNT}, (select count(*) from clicks)
            as bad_lines from sess where {_NEW}""",
        "distinct_gaps": f"{_6H} select distinct session_id, delta_seg from sess",
        "gap_list_by_session": f"""{_6H}, once as (
            select distinct session_id, cast(round(delta_seg * 1000) as bigint) as ms
            from sess)
            select session_id, string_agg(cast(ms as varchar), ',' order by ms) as deltas_ms
            from once group by session_id""",
        "answer_1": _PER_FILE,
        "answer_2": _BY_DIM_FILE,
        "answer_3": _ALL_FILES_MEDIAN,
        "answer_3_fold": _FOLD,
        "stream_counts": _BY_DIM_FILE,
        "stream_counts_compacted": _BY_DIM_FILE,
        "stream_quarantine": f"""{_6H}, batches as (
            select n, (device_sent_timestamp - min(device_sent_timestamp) over ()) * 3 // (
                max(device_sent_timestamp) over () - min(device_sent_timestamp) over () + 1) as batch
            from clicks)
            select 'sessions' as kind, 0::bigint as of, {_COUNT} from sess where {_NEW}
            union all select 'broken in ' || batch, cast(sum(n) as bigint), count(*)
            from batches where n % 5 = 0 group by batch""",
        "stream_median": _ALL_FILES_MEDIAN,
        "stream_session_window": f"""{_6H_STRICT} select anonymous_id, {_DIMS},
            min(device_sent_timestamp) as start_ts, max(device_sent_timestamp) as end_ts,
            count(*) as events,
            cast(max(device_sent_timestamp) - min(device_sent_timestamp) as double) / 1000
              as duration
            from sess group by anonymous_id, {_DIMS}, session_id""",
        "stream_session_ids": f"{_6H_STREAM} select {_SESSION_COLUMNS} from sess where {_PASSED}",
        "stream_session_ids_compat": f"""{_6H_STREAM_COMPAT} select {_SESSION_COLUMNS}
            from sess where {_PASSED}""",
        "stream_late_rows": f"""{_6H_STREAM} select {_EVENT}, 'late' as reason, batch
            from judged where late""",
        "stream_session_ledger": f"{_6H_STRICT} select {_SESSION_COLUMNS} from sess",
        "labelled_devices": f"""{_6H} select ltrim(coalesce(device_family,
            'Not Identified')) as ref, count(*) as events from clicks group by 1""",
    }
