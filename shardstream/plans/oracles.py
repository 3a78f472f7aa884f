"""The same results as the registered queries, as SQL over the same tables."""

from __future__ import annotations

_REC = """
rec as (
  select 'events' as stream_name,
         'shard-' || ((('0x' || substr(md5(user_id::varchar), 1, 8))::bigint) % 4) as shard_id,
         lpad(event_id::varchar, 20, '0') as sequence_number,
         user_id::varchar as partition_key,
         props as data,
         ts as arrival_ts,
         event_id, user_id, event_type
  from events)"""

_FE = """
fe as (
  select *, ((row_number() over (partition by shard_id order by sequence_number) - 1) // 500)::bigint as fetch_no
  from rec)"""

_STATUS = """
status as (
  select * from (values ('shard-0', null), ('shard-1', 'TERMINATE'), ('shard-2', 'ZOMBIE'), ('shard-3', null))
    v(shard_id, shutdown_reason))"""

_PRIOR = """
prior as (
  select shard_id, max(sequence_number) as done from rec where arrival_ts < timestamp '2024-01-10' group by 1)"""

_LAG = """
last_of as (select shard_id, fetch_no, max(arrival_ts) as m from fe group by 1, 2),
tip as (select shard_id, max(arrival_ts) as tip_ts from rec group by 1),
behind as (
  select shard_id, fetch_no, ((epoch_us(tip_ts) - epoch_us(m)) // 1000)::bigint as millis_behind_latest
  from last_of join tip using (shard_id))"""


def _with(*parts: str, select: str) -> str:
    return "with " + ",".join(parts) + "\n" + select.strip()


_PLAIN = "stream_name, shard_id, sequence_number, partition_key, data, epoch_us(arrival_ts) as arrival_us"

_ENVELOPE = _with(
    _REC, _FE, _PRIOR, _LAG,
    select=f"""
    select {_PLAIN}, coalesce(done, 'TRIM_HORIZON') as starting_sequence_number, millis_behind_latest
    from fe join behind using (shard_id, fetch_no) left join prior using (shard_id)""",
)

_BACKOFF_ROWS = "(select event_id, least(event_id % 8, 5) as retries from events)"


def _slots(bytes_per_second: int) -> str:
    return _with(
        _REC,
        select=f"""
        , z as (
          select shard_id, sequence_number,
                 row_number() over w - 1 as rn,
                 coalesce(sum(strlen(data)) over (partition by shard_id order by sequence_number
                   rows between unbounded preceding and 1 preceding), 0) as cb
          from rec window w as (partition by shard_id order by sequence_number))
        select shard_id, sequence_number, (rn // 500)::bigint as batch_no,
               greatest(rn // 1000, (cb // {bytes_per_second})::bigint)::bigint as slot_s
        from z""",
    )


ORACLES: dict[str, str] = {
    "shard_progress_with_lag": _with(
        _REC, _FE, _STATUS, _LAG,
        select="""
        , per_fetch as (
          select shard_id, fetch_no, count(*) as n, max(sequence_number) as last_seq from fe group by 1, 2)
        select shard_id, count(*) as fetches, sum(n)::bigint as records, max(last_seq) as sequence_number,
               max(millis_behind_latest) as max_millis_behind,
               case when max(shutdown_reason) is null then max(last_seq) end as committed
        from per_fetch join behind using (shard_id, fetch_no) left join status using (shard_id)
        group by shard_id""",
    ),
    "read_records": _with(_REC, select=f"select {_PLAIN} from rec"),
    "read_records_progress": _with(
        _REC, _STATUS,
        select="""
        select shard_id,
               case shard_id when 'shard-1' then 'SHARD_END'
                    when 'shard-2' then null else max(sequence_number) end as sequence_number,
               case shard_id when 'shard-3' then 'TERMINATE' else max(shutdown_reason) end as shutdown_reason
        from status left join rec using (shard_id) group by shard_id""",
    ),
    "commit_what_was_read": _with(
        _REC, select="select shard_id, count(*) as records, max(sequence_number) as sequence_number from rec group by shard_id"
    ),
    "read_committable": _ENVELOPE,
    "read_changes": _with(
        _REC, select="select shard_id, sequence_number, user_id as id, event_type as value from rec"
    ),
    "read_changes_committable": _with(
        _REC, _FE, _PRIOR, _LAG,
        select="""
        select shard_id, sequence_number, user_id as id, event_type as value,
               coalesce(done, 'TRIM_HORIZON') as starting_sequence_number, millis_behind_latest
        from fe join behind using (shard_id, fetch_no) left join prior using (shard_id)""",
    ),
    "start_trim_horizon": _with(_REC, select="select shard_id, sequence_number from rec"),
    "start_latest": _with(
        _REC,
        select="""
        , tip as (
          select shard_id, max(sequence_number) as ck from rec where arrival_ts < timestamp '2024-01-25' group by 1)
        select shard_id, sequence_number from rec left join tip using (shard_id)
        where ck is null or sequence_number > ck""",
    ),
    "start_at_timestamp": _with(
        _REC, select="select shard_id, sequence_number from rec where arrival_ts >= timestamp '2024-01-15'"
    ),
    "slice_index": _with(
        _REC,
        select="""
        select least(greatest(epoch_us(arrival_ts) - epoch_us(timestamp '2024-01-01'), 0) // 518400000000, 4)::bigint
                 as slice,
               shard_id, count(*) as rows, sum(strlen(data))::bigint as bytes,
               min(sequence_number) as first_sequence_number, max(sequence_number) as last_sequence_number,
               max(epoch_us(arrival_ts)) as last_arrival_us
        from rec group by 1, 2""",
    ),
    "stream_lag": _with(
        _REC,
        select="""
        , tip as (select shard_id, max(arrival_ts) as tip_ts from rec group by 1)
        select shard_id, sequence_number, ((epoch_us(tip_ts) - epoch_us(arrival_ts)) // 1000)::bigint as millis_behind_latest
        from rec join tip using (shard_id)""",
    ),
    "resume_from_progress": _with(
        _REC, _PRIOR,
        select="""
        select shard_id, sequence_number from rec
        left join (select * from prior where shard_id <> 'shard-3') p using (shard_id)
        where done is null or sequence_number > done""",
    ),
    "resume_all_shards": _with(
        _REC, _PRIOR,
        select="""
        select shard_id, sequence_number from rec left join prior using (shard_id)
        where done is null or sequence_number > done""",
    ),
    "resume_after_shard_end": _with(
        _REC, _PRIOR,
        select="""
        select shard_id, sequence_number from rec left join prior using (shard_id)
        where shard_id <> 'shard-1' and (done is null or sequence_number > done)""",
    ),
    "fetch_batches": _with(
        _REC, _FE,
        select="""
        select shard_id, fetch_no, count(*) as records, max(sequence_number) as last_sequence_number
        from fe group by 1, 2""",
    ),
    "fetch_batches_by_bytes": _with(
        _REC,
        select="""
        , b as (
          select *, row_number() over w - 1 as n, sum(strlen(data)) over w - strlen(data) as bytes
          from rec window w as (partition by shard_id order by sequence_number))
        select shard_id, (n // 500 + bytes // 4000)::bigint as fetch_no, count(*) as records,
               max(sequence_number) as last_sequence_number
        from b group by 1, 2""",
    ),
    "fetch_batches_full": _with(
        _REC,
        select="""
        , p as (
          select shard_id, sequence_number, row_number() over w - 1 as n, coalesce(strlen(data), 0) as size,
                 sum(coalesce(strlen(data), 0)) over w as upto
          from rec window w as (partition by shard_id order by sequence_number)),
        f as (
          select shard_id, 0::bigint as fetch_no, 0::bigint as n, 0::bigint as before from rec group by 1
          union all
          select f.shard_id, f.fetch_no + 1, min(p.n), arg_min(p.upto - p.size, p.n)::bigint
          from f join p using (shard_id)
          where p.n > f.n and (p.n = f.n + 120 or p.upto > f.before + 4000) group by f.shard_id, f.fetch_no)
        select p.shard_id, fetch_no, count(*) as records, max(sequence_number) as last_sequence_number
        from p asof join f on p.shard_id = f.shard_id and p.n >= f.n group by 1, 2""",
    ).replace("with", "with recursive", 1),
    "record_sets": _with(
        _REC, _FE,
        select="""
        select shard_id, fetch_no, count(*)::int as records, min(sequence_number) as first_sequence_number,
               max(sequence_number) as last_sequence_number,
               md5(string_agg(sequence_number || ':' || data, ',' order by sequence_number)) as digest
        from fe group by 1, 2""",
    ),
    "flatten_record_sets": _with(
        _REC, _FE,
        select="""
        select shard_id, fetch_no,
               (row_number() over (partition by shard_id, fetch_no order by sequence_number) - 1)::int as pos,
               sequence_number
        from fe""",
    ),
    "attach_envelope": _ENVELOPE,
    "strip_envelope": _with(_REC, select=f"select {_PLAIN} from rec"),
    "order_by_sequence": """
        select event_id::varchar as sequence_number, row_number() over (order by event_id::varchar) as sequence_rank
        from events""",
    "time_in_cache": _with(
        _REC, _FE,
        select="""
        , ends as (select shard_id, fetch_no, max(arrival_ts) as entry from fe group by 1, 2)
        select shard_id, fetch_no,
               ((epoch_us(lead(entry, 1, entry) over (partition by shard_id order by fetch_no)) - epoch_us(entry))
                 // 1000)::bigint as time_spent_in_cache_ms
        from ends""",
    ),
    "millis_behind_latest": _with(
        _REC, _FE, _LAG, select="select shard_id, fetch_no, millis_behind_latest from behind"
    ),
    "can_checkpoint": _with(
        _REC, _STATUS,
        select="""
        select shard_id, sequence_number, shutdown_reason is null as can_checkpoint
        from rec left join status using (shard_id)""",
    ),
    "checkpoint_records": _with(
        _REC, _STATUS,
        select="""
        select shard_id, max(sequence_number) as sequence_number
        from rec left join status using (shard_id) where shutdown_reason is null group by 1""",
    ),
    "checkpoint_record_sets": _with(
        _REC, _FE, _STATUS,
        select="""
        select shard_id, fetch_no, case when max(shutdown_reason) is null then max(sequence_number) end as sequence_number,
               case when max(shutdown_reason) is null then 'committed' else 'skipped' end as outcome
        from fe left join status using (shard_id) group by 1, 2""",
    ),
    "shard_end_progress": _with(
        _REC, _STATUS, _PRIOR,
        select="""
        , m as (
          select shard_id, case when shard_id <> 'shard-2' then max(sequence_number) end as m from rec group by 1)
        select shard_id, case when shard_id = 'shard-1' then 'SHARD_END' else coalesce(m, done) end as sequence_number
        from m left join prior using (shard_id)""",
    ),
    "invalid_progress": _with(
        _REC,
        select="""
        , tips as (select shard_id, max(sequence_number) as tip from rec group by 1),
        stored as (
          select shard_id, case shard_id when 'shard-1' then tip || '9'
                   when 'shard-2' then (select tip from tips where shard_id = 'shard-0') else tip end as sequence_number
          from tips)
        select shard_id, sequence_number from stored s
        where not exists (select 1 from rec r where r.shard_id = s.shard_id and r.sequence_number = s.sequence_number)""",
    ),
    "backward_progress": _with(
        _REC, _PRIOR,
        select="""
        , former as (
          select shard_id, max(sequence_number) as f from rec where arrival_ts < timestamp '2024-01-15' group by 1),
        later as (
          select shard_id, max(sequence_number) as l from rec where arrival_ts < timestamp '2024-01-25' group by 1),
        mixed as (
          select shard_id, case when shard_id = 'shard-1' then done else l end as sequence_number
          from later join prior using (shard_id))
        select shard_id, sequence_number, f as former_sequence_number
        from mixed join former using (shard_id) where sequence_number < f""",
    ),
    "route_to_shard": _with(_REC, select="select event_id, shard_id from rec"),
    "put_records": _with(
        _REC,
        select="""
        select sequence_number as request_id, shard_id,
               repeat('0', 19) || lpad((row_number() over (partition by shard_id order by sequence_number) - 1)::varchar,
                 19, '0') as sequence_number,
               true as successful, 1 as attempts, true as all_attempts_ok
        from rec""",
    ),
    "put_stream": _with(
        _REC,
        select="""
        select shard_id, count(*) as results, count(*) as request_ids, count(*) as sequence_numbers, 3::bigint as batches
        from rec group by 1""",
    ),
    "put_with_retries": _with(
        _REC,
        select="""
        select sequence_number as request_id,
               case when event_id % 8 <= 5 then shard_id end as shard_id,
               case when event_id % 8 <= 5 then sequence_number end as sequence_number,
               event_id % 8 <= 5 as successful,
               (least(event_id % 8, 5) + 1)::int as attempts,
               case when event_id % 8 > 5 then 'Throttled' end as error_code
        from rec""",
    ),
    "put_stream_with_retries": _with(
        _REC,
        select="""
        select sequence_number as request_id, case when event_id % 8 <= 5 then shard_id end as shard_id,
               event_id % 8 <= 5 as successful, (least(event_id % 8, 5) + 1)::int as attempts,
               case when event_id % 8 > 5 then 'Throttled' end as error_code, true as waits_kept
        from rec""",
    ),
    "unacknowledged": "select lpad(event_id::varchar, 20, '0') as request_id from events where event_id % 8 > 5",
    "payload_roundtrip": "select event_id, props as data, strlen(props)::bigint as bytes from events",
    "decode_new_image": """
        select lpad(event_id::varchar, 20, '0') as sequence_number, user_id as id, event_type as value from events""",
    "decode_nested_image": """
        select lpad(event_id::varchar, 20, '0') as sequence_number, user_id as id, event_id % 2 = 0 as even, true as none, props,
               event_type || ',' || user_id as words, 4 * user_id + 1 as twice_the_numbers, event_type as bytes,
               user_id as user, user_id::varchar as second, event_type || ',' || user_id as list, user_id as map_user,
               null::varchar as absent
        from events""",
    "all_attempts_ok": "select event_id, event_id % 8 = 0 as all_attempts_ok from events",
    "last_attempt_error": """
        select event_id, case when event_id % 8 > 5 then 'Throttled' end as error_code,
               case when event_id % 8 > 5 then 'slow down 6' end as error_message
        from events""",
    "classify_attempts": """
        select event_id, a::int as attempt,
               case when a > event_id % 8 then 'success'
                    when event_type <> 'error' and a <= 5 then 'retry' else 'failed' end as status
        from events, range(1, 7) r(a) where a <= least(event_id % 8, 5) + 1""",
    "retry_outcome": """
        select event_id, event_id % 8 as failures, least(event_id % 8, 5) as retries,
               least(event_id % 8, 5) + 1 as attempts_made,
               case when event_id % 8 > 5 then 'failed' else 'success' end as status
        from events""",
    "backoff_exponential": f"""
        select event_id, retries,
               coalesce((select sum(pow(100, a)) from range(1, 6) t(a) where a <= retries), 0)::bigint as backoff_ms
        from {_BACKOFF_ROWS}""",
    "backoff_linear": f"""
        select event_id, retries, (100 * retries * (retries + 1) // 2)::bigint as backoff_ms from {_BACKOFF_ROWS}""",
    "attempt_schedule": """
        select event_id, a as attempt,
               case when a > event_id % 8 then 'success' when a <= 5 then 'retry' else 'failed' end as status,
               (100 * a * (a - 1) // 2)::bigint as due_linear_ms,
               coalesce((select sum(pow(100, i)) from range(1, 6) t(i) where i < a), 0)::bigint as due_exponential_ms
        from events, range(1, 7) r(a) where a <= least(event_id % 8, 5) + 1""",
    "quota_by_shards": _with(
        _REC,
        select="""
        , n as (select count(distinct shard_id)::int as shards from rec)
        select shards, (shards * 2)::int as parallelism, 500 as max_batch_size,
               (shards * 1000)::int as max_records_per_second, (shards * 1000000)::int as max_bytes_per_second,
               5 as max_retries, 100 as base_ms
        from n""",
    ),
    "pack_batches": _with(
        _REC,
        select="""
        select shard_id, sequence_number,
               ((row_number() over (partition by shard_id order by sequence_number) - 1) // 500)::bigint as batch_no
        from rec""",
    ),
    "throttle_slots": _slots(1_000_000),
    "throttle_slots_by_bytes": _slots(5000),
    "departures": _with(
        _REC,
        select="""
        , b as (
          select shard_id, sequence_number, epoch_us(arrival_ts) as arrived,
                 greatest(1000000, (strlen(data) * 1000000 + 19) // 20)::bigint as busy from rec),
        c as (
          select *, coalesce(sum(busy) over (partition by shard_id order by sequence_number
            rows between unbounded preceding and 1 preceding), 0)::bigint as before from b)
        select shard_id, sequence_number,
               before + max(arrived - before) over (partition by shard_id order by sequence_number) as departure_us
        from c""",
    ),
    "order_by_uneven_sequence": """
        with n as (
          select case when event_id % 3 = 0 then repeat('7', 30) || lpad(event_id::varchar, 20, '0')
                      else md5(event_id::varchar) end as sequence_number
          from events)
        select sequence_number, row_number() over (order by sequence_number) as sequence_rank from n""",
    "apply_per_shard": _with(
        _REC,
        select="""
        select shard_id, count(*) as records, sum(strlen(data))::bigint as bytes,
               max(sequence_number) as last_sequence_number
        from rec group by 1""",
    ),
    # shard-2 is lost at the second run, shard-1 read to its end there; shard-3 ends with a record that never comes.
    "shard_processor": _with(
        _REC,
        select="""
        , n as (
          select *, (row_number() over (partition by shard_id, run order by sequence_number) - 1) // 500 as number
          from (select *, (arrival_ts >= timestamp '2024-01-10')::int as run from rec)),
        f as (
          select shard_id, run, number, count(*) as records, coalesce(sum(strlen(data)), 0) as bytes, max(sequence_number) as last
          from n where shard_id <> 'shard-2' or run = 0 group by 1, 2, 3),
        totals as (
          select shard_id, run, number, sum(records) over w as records, sum(bytes) over w as bytes, last from f
          window w as (partition by shard_id order by run, number)),
        ends as (
          select shard_id, max(records) as records, max(bytes) as bytes, null as last,
                 case shard_id when 'shard-1' then 'TERMINATE' else 'ZOMBIE' end as reason
          from totals where shard_id in ('shard-1', 'shard-2') group by 1)
        select shard_id, records::bigint as records, bytes::bigint as bytes, last::varchar as last, reason::varchar as reason
        from (select shard_id, records, bytes, last, null as reason from totals union all select * from ends)""",
    ),
}

# The same results by way of a log's index.
ORACLES |= {"start_latest_by_index": ORACLES["start_latest"], "resume_by_index": ORACLES["resume_from_progress"]}

# The same results, from plans for shards too large for one task.
ORACLES |= {
    "fetch_batches_cut": ORACLES["fetch_batches"],
    "order_by_sequence_cut": ORACLES["order_by_sequence"],
    "throttle_slots_by_bytes_cut": ORACLES["throttle_slots_by_bytes"],
    "departures_cut": ORACLES["departures"],
    "put_records_cut": f"select request_id, shard_id, sequence_number from ({ORACLES['put_records']})",
}
