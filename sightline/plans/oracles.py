"""The registered queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

from sightline.plans.commands import COMMANDS, EDGE_PORT, NODE_OUTPUT, NOT_IMPLEMENTED
from sightline.plans.tables import COMMAND_NAMES, RUN_TYPE, TOPIC_OF
from sightline.schema import ATTRS, PORTS, SCORED

STAMP = "'%Y%m%d%H%M%S'"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]::varchar[]"


def _case(column: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"when {_text(k)} then {v}" for k, v in mapping.items())
    return f"case {column} {whens} end"


def _rows(name: str, columns: str, rows) -> str:
    values = ", ".join("(" + ", ".join("null" if v is None else _text(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) as (values {values})"


def _keeps(samples: int) -> str:
    step = f"(n // {samples + 1})"
    start = f"((n - {samples - 1} * {step}) // 2)"
    return f"(case when n <= {samples} then true else (idx - {start}) % {step} = 0 end)"


def _ports() -> str:
    by_topic = {t: [p for p, read in PORTS.items() if read == t] for t in TOPIC_OF.values()}
    return _case("event_type", {e: _list(by_topic[t]) for e, t in TOPIC_OF.items()})


def _command_rows():
    return [(c, "handled", level) for c, (level, _, _) in COMMANDS.items()] + [
        (c, "not implemented", None) for c in NOT_IMPLEMENTED
    ]


def _edge_rows():
    for command, (_, _, edges) in COMMANDS.items():
        for src, dst in (e.split(">") for e in edges.split()):
            yield command, src, dst, NODE_OUTPUT[src], EDGE_PORT[src, dst]


# What each command stores, written out from the plans: track, attributes, feature, ranks, ranks by old attributes.
_FLOW = """
    ('track', true, false, false, false, false),
    ('track-attrrecog', false, false, false, false, false),
    ('track-reidfeature', false, false, false, false, false),
    ('track-reid', true, false, true, false, false),
    ('track-attrrecog-reid', true, true, false, true, false),
    ('track-attrrecog-reidfeature', true, true, true, false, false),
    ('attrrecog-reidfeature', false, true, true, false, false),
    ('attrrecog', false, true, false, false, false),
    ('attrrecog-reid', false, true, false, true, false),
    ('reid', false, false, false, true, true),
    ('reidfeature', false, false, true, false, false)"""

# Each entry may use the entries above it.
_WITH = {
    "event_k": "event_k as (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)",
    "message": f"""message as (
        select event_id, ts, cast(user_id as varchar) as task,
               {_case("event_type", {e: _text(t) for e, t in TOPIC_OF.items()})} as topic,
               event_id % 6 as "partition", k % 2 as serial, k, value,
               case when k % 5 <> 0 then 'plan-' || (k % 7) end as user_plan,
               list_filter({_ports()}, lambda p, i: (k >> (i - 1)) % 2 = 1) as dest_ports
        from event_k)""",
    "command": f"""command as (
        select event_id as command_id, ({_list(COMMAND_NAMES)})[event_id % {len(COMMAND_NAMES)} + 1] as command,
               case when event_id % 97 = 0 then '/videos/CAM0' || (event_id % 6 + 1)
                    else '/videos/CAM0' || (event_id % 6 + 1) || '/'
                         || strftime(date '1994-12-26' + cast(event_id % 344 * 7 as integer), '%Y-%m-%d')
               end as folder, k as serial
        from message where topic = 'COMMAND')""",
    "known": _rows("known", "command, status, input", _command_rows()),
    "edge": _rows("edge", "command, src, dst, output_type, port", _edge_rows()),
    "entry": _rows(
        "entry", "command, port", [(c, p) for c, (_, ports, _) in COMMANDS.items() for p in ports]
    ),
    "entity": f"""entity as (
        select o_orderkey as entity, video, video_start, start_frame,
               strftime(st + to_seconds(start_frame * 2 // 25), {STAMP}) as start_time,
               video || '_tarid' || o_orderkey as entity_id,
               'plan-' || (o_orderkey % 3) as data_type, o_orderstatus as status, st
        from (select *, o_orderkey * 37 % 1000000 as start_frame, strftime(st, {STAMP}) as video_start,
                     'CAM0' || (o_custkey % 6 + 1) || '-' || strftime(st, {STAMP}) || '-'
                     || strftime(st + interval 6 hour, {STAMP}) as video
              from (select *, cast(date_trunc('week', o_orderdate) as timestamp)
                              + to_hours(o_custkey % 4 * 6) as st from orders)))""",
    "numbered": """numbered as (
        select *, row_number() over (partition by video order by entity) - 1 as serial,
               count(*) over (partition by video) as num from entity)""",
    "stored": """stored as (
        select entity, video, serial,
               '/meta/result/ssd/2018-05-09/' || video || '/task/' || serial as url from numbered)""",
    "file": """file as (
        select distinct video, '/videos/' || split_part(video, '-', 1) || '/' || substr(video, 7, 4) || '-'
               || substr(video, 11, 2) || '-' || substr(video, 13, 2) || '/' || video || '.mp4' as path from entity)""",
    "task": """task as (
        select c.command_id, c.command, k.input, c.serial, f.video, f.path,
               md5(c.command_id || '|' || f.path) as task
        from command c join known k on c.command = k.command and k.status = 'handled'
             join file f on f.path = c.folder or starts_with(f.path, c.folder || '/'))""",
    "box": """box as (
        select *, row_number() over (partition by entity order by h, a, b, w, s1, s2) - 1 as idx,
               count(*) over (partition by entity) as n
        from (select l_orderkey as entity, l_partkey % 640 as x, l_suppkey % 480 as y,
                     cast(l_quantity as bigint) - 1 as w, cast(l_linenumber as bigint) * 10 as h,
                     round(l_discount * 100) as s1, round(l_tax * 100) as s2, l_quantity as s3,
                     l_partkey as a, l_suppkey as b from lineitem))""",
    "patched": f"""patched as (
        select *, entity || ':' || idx || ':' || x || ':' || y as patch, {_keeps(3)} as kept from box)""",
    "kept": "kept as (select * from patched where kept and w * h <> 0)",
    "means": """means as (
        select entity, count(*) as n_samples, avg(s1) as s1, avg(s2) as s2, avg(s3) as s3
        from patched where kept group by entity)""",
    "bucket": """bucket as (
        select hour_key, hour_key * 100 as bucket_start, hour_key * 100 + 29 as bucket_end
        from (select cast(strftime(day, '%Y%m%d') as bigint) * 100 + h as hour_key
              from (select distinct unnest([cast(st as date), cast(st as date) + 1]) as day from entity),
                   range(24) as r(h)))""",
    "placed": """placed as (
        select b.hour_key, b.bucket_start, b.bucket_end, e.entity, e.entity_id, e.data_type
        from entity e join bucket b on cast(e.start_time as bigint) // 10000 = b.hour_key
        where b.bucket_start * 100 <= cast(e.start_time as bigint)
          and cast(e.start_time as bigint) <= b.bucket_end * 100 + 59)""",
    "feature": "feature as (select vec_id as id, embedding as vec from embeddings)",
    "last_link": """last_link as (
        select l_partkey as src, l_suppkey as dst,
               arg_max(l_discount, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) as sim
        from lineitem group by l_partkey, l_suppkey)""",
    "valid": """valid as (
        select * from last_link where src in (select id from feature) and dst in (select id from feature))""",
    "run": f"""run as (
        select event_id, cast(user_id as varchar) as task,
               {_case("event_type", {e: _text(t) for e, t in RUN_TYPE.items()})} as type,
               'node' || (user_id % 8) as node, ts as start, epoch_ms(ts) as start_ms,
               epoch_ms(ts) + cast(round(value * 100) as bigint) as end_ms, k as n_samples,
               'CAM0' || (user_id % 6 + 1) || '-' || strftime(date_trunc('hour', ts), {STAMP}) || '-'
               || strftime(date_trunc('hour', ts) + interval 1 hour + to_minutes(k), {STAMP}) as video
        from event_k)""",
    "report": """report as (
        select user_id % 8 as node, ts, event_id, user_id as pid, k % 8 as device, value as util,
               cast(round(value * 100) as bigint) as mem from event_k where event_type = 'view')""",
    "left_side": """left_side as (
        select task, serial, event_id as left_id, ts as left_ts, k as left_k, user_plan as left_plan
        from message where topic = 'TRACKLET')""",
    "right_side": """right_side as (
        select task, serial, event_id as right_id, ts as right_ts, k as right_k
        from message where topic = 'ATTRIBUTES')""",
    "batched_left": "batched_left as (select *, epoch_us(left_ts) // 3600000000 as lb from left_side)",
    "batched_right": "batched_right as (select *, epoch_us(right_ts) // 3600000000 as rb from right_side)",
    "instant": """instant as (
        select l.*, r.* exclude (task, serial), 'instant' as how from batched_left l join batched_right r
        on l.task = r.task and l.serial = r.serial and l.lb = r.rb)""",
    "near": """near as (
        select l.*, r.* exclude (task, serial) from batched_left l join batched_right r
        on l.task = r.task and l.serial = r.serial and l.lb <> r.rb and abs(l.lb - r.rb) < 24
        where l.left_id not in (select left_id from instant) and r.right_id not in (select right_id from instant))""",
    "pairs": """pairs as (
        select * from instant
        union all select *, 'late_right' as how from near where rb > lb
        union all select *, 'late_left' as how from near where rb < lb
                  and right_id not in (select right_id from near where rb > lb))""",
    "latest_track": """latest_track as (
        select cast(entity as varchar) as entity_id, data_type, start_time,
               '/meta/' || entity_id || case when status = 'F' then '.har' else '' end as path
        from entity where status <> 'P')""",
    "entity_row": """entity_row as (
        select entity_id, data_type, coalesce(t.path, '') as path, coalesce(t.start_time, '') as start_time,
               coalesce(m.s1, -1) as s1, coalesce(m.s2, -1) as s2, coalesce(m.s3, -1) as s3,
               coalesce(f.n_floats, 0) as n_floats, f.n_floats is not null as is_finish,
               f.n_floats is null as is_get_sim
        from latest_track t
        full join (select cast(entity as varchar) as entity_id, 'plan-' || (entity % 3) as data_type,
                          s1, s2, s3 from means) m using (entity_id, data_type)
        full join (select cast(id as varchar) as entity_id, 'plan-' || (id % 3) as data_type,
                          len(vec) as n_floats from feature) f using (entity_id, data_type))""",
}

# Query -> (tables it needs, select).
_SELECT = {
    "bucket_scores": (
        "entity bucket box patched means placed",
        """select bucket_start, cast(floor(s1) as bigint) as band, count(*) as n_entities,
                  cast(sum(n_samples) as bigint) as n_samples
           from placed join means using (entity) group by bucket_start, floor(s1)""",
    ),
    "store_split": (
        "box patched",
        "select entity, idx, x, y, w, h, base64(encode(patch)) as data from patched where kept",
    ),
    "load_join": (
        "box patched",
        """select entity, idx, w, h, kept as sampled, case when kept then patch else '' end as patch from patched""",
    ),
    "oversize_route": (
        "",
        """select doc_id, n_bytes, n_bytes > 2000 as stored,
                  case when n_bytes > 2000 then '/meta/documents/' || doc_id else '' end as url,
                  case when n_bytes > 2000 then '' else md5(text) end as inline_digest
           from (select *, cast(octet_length(encode(text)) as bigint) as n_bytes from documents)""",
    ),
    "save_new_only": (
        "",
        """select distinct l_orderkey as entity, l_orderkey % 500 as task from lineitem
           where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')
             and l_orderkey % 500 not in (select user_id from events where event_type = 'error')""",
    ),
    "first_sample": (
        "box patched",
        "select entity, min(idx) as idx, arg_min(patch, idx) as patch from patched where kept group by entity",
    ),
    "parse_video": (
        "entity",
        """select entity, split_part(video, '-', 1) as cam, split_part(video, '-', 2) as video_start,
                  split_part(video, '-', 3) as video_end, entity_id from entity""",
    ),
    "start_time": (
        "entity",
        """select entity, start_frame, start_time,
                  (cast(substr(video_start, 1, 10) as bigint) + s // 3600)
                  || lpad(cast(s // 60 % 60 as varchar), 2, '0') || lpad(cast(s % 60 as varchar), 2, '0')
                  as start_time_compat
           from (select *, start_frame * 2 // 25 + cast(substr(video_start, 11, 2) as bigint) * 60
                           + cast(substr(video_start, 13, 2) as bigint) as s from entity)""",
    ),
    "video_path": (
        "entity file",
        """select entity, path, video as stem,
                  '/meta/result/ssd/2018-05-09/' || video || '/task/' || entity as store_path
           from entity join file using (video)""",
    ),
    "json_header": (
        "entity",
        """select entity, header->>'$.id.video-url' as video,
                  cast(header->>'$.run-frame-index' as bigint) as start_frame,
                  cast(header->'$.bounding-boxes' as varchar) as boxes_json,
                  cast(header->>'$.id.serial-number' as bigint) as serial,
                  cast(header->>'$.bounding-boxes[0].x' as bigint) as first_x
           from (select entity, '{"id":{"video-url":"' || video || '","serial-number":' || entity
                        || '},"tracklet-number":1,"run-frame-index":' || start_frame
                        || ',"bounding-boxes":[{"x":' || (entity % 640)
                        || ',"y":2,"width":3,"height":4}]}' as header from entity)""",
    ),
    "feature_codec": (
        "feature",
        """select id, cast(4 * len(vec) as bigint) as n_bytes, cast((4 * len(vec) + 2) // 3 * 4 as bigint) as n_chars,
                  cast(len(vec) as bigint) as n_floats, cast(vec[1] as double) as first,
                  cast(vec[-1] as double) as last, true as same from feature""",
    ),
    "scores_to_map": (
        "feature",
        "select id, "
        + ", ".join(
            (f"vec[{SCORED.index(a)} % len(vec) + 1]" if a in SCORED else "cast(0 as float)") + f" as {a}"
            for a in ATTRS
        )
        + " from feature",
    ),
    "time_keys": (
        "entity",
        "select entity, "
        + ", ".join(
            f"cast(substr(start_time, 1, {w}) as bigint) as {level}_key"
            for level, w in {"year": 4, "month": 6, "day": 8, "hour": 10}.items()
        )
        + " from entity",
    ),
    "uniform_sample": ("box", f"select entity, idx, n, {_keeps(2)} as kept_2, {_keeps(3)} as kept_3 from box"),
    "kept_samples": ("box patched kept", "select entity, idx, w, h from kept"),
    "mean_scores": ("box patched means", "select * from means"),
    "approx_equal": (
        "box patched means",
        """select entity, """
        + " and ".join(f"m.{s} * a.{s} >= 0 and abs(m.{s} - a.{s}) < 1e-4" for s in ("s1", "s2", "s3"))
        + """ as same from means m
           join (select entity, avg(s1) as s1, avg(s2) as s2, avg(s3) as s3 from box group by entity) a
           using (entity)""",
    ),
    "fragment_chunks": (
        "box",
        """select entity, idx // 3 as fragment, count(*) as n_frames, min(idx) as first_idx, max(idx) as last_idx,
                  string_agg(cast(x as varchar), ',' order by idx) as x from box group by entity, idx // 3""",
    ),
    "serial_number": ("entity numbered", "select video, entity, serial, num from numbered"),
    "topic_split": (
        "event_k message",
        """select topic, count(*) as n_messages, cast(sum(k) as bigint) as sum_k from message
           group by topic""",
    ),
    "port_filter": (
        "event_k message",
        """select event_id, task, user_plan from message
           where topic = 'TRACKLET' and list_contains(dest_ports, 'pedestrian-tracklet-saving')
             and user_plan is not null""",
    ),
    "recent_signals": (
        "event_k message",
        """select task, max(ts) as ts from message where topic = 'TERM_SIG' group by task
           order by 2 desc, 1 limit 100""",
    ),
    "drop_cancelled": (
        "event_k message",
        """select event_id, task, topic from message where topic <> 'TERM_SIG' and task not in (
             select task from (select task, max(ts) as ts from message where topic = 'TERM_SIG' group by task
                               order by 2 desc, 1 limit 100))""",
    ),
    "command_check": (
        "event_k message command known",
        """select command_id, c.command, coalesce(status, 'unsupported') as status
           from command c left join known k on c.command = k.command""",
    ),
    "task_fanout": (
        "event_k message command known entity file task",
        "select command_id, command, path, task from task",
    ),
    "entity_fanout": (
        "event_k message command known entity numbered stored file task",
        """select command_id, task, t.video, url from task t join stored s on t.video = s.video
           where input = 'entity'""",
    ),
    "serial_fanout": (
        "event_k message command known entity numbered stored file task",
        """select command_id, task, t.video, url from task t
           join stored s on t.video = s.video and t.serial % 4 = s.serial where input = 'serial'""",
    ),
    "plan_edges": (
        "event_k message command known edge entity file task",
        """select task, src, dst, output_type, port from task t join edge e on t.command = e.command""",
    ),
    "entry_ports": (
        "event_k message command known entry entity file task",
        """select task, ports from task t
           join (select command, string_agg(port, ',' order by port) as ports from entry group by command) e
           on t.command = e.command""",
    ),
    "plan_merge": (
        "event_k message",
        """select task || '-' || serial as plan, node, bool_or(k % (node * 10 + 11) = 0) as executed
           from message, range(4) as r(node) where topic in ('TRACKLET', 'ATTRIBUTES') group by 1, 2""",
    ),
    "full_outer_split": (
        "event_k message left_side right_side",
        """select task, serial, batch, coalesce(left_id, -1) as left_id, coalesce(right_id, -1) as right_id,
                  case when left_id is null then 'right' when right_id is null then 'left' else 'both' end as side
           from (select *, epoch_us(left_ts) // 21600000000 as batch from left_side) l
           full join (select *, epoch_us(right_ts) // 21600000000 as batch from right_side) r
           using (task, serial, batch)""",
    ),
    "buffered_join": (
        "event_k message left_side right_side",
        """select l.task, l.serial, left_id, coalesce(right_id, -1) as right_id
           from left_side l left join right_side r on l.task = r.task and l.serial = r.serial
                and abs(epoch_us(left_ts) - epoch_us(right_ts)) <= 21600000000""",
    ),
    "consume_join": (
        "event_k message left_side right_side batched_left batched_right instant near pairs",
        "select task, serial, left_id, right_id, how from pairs",
    ),
    "joined_union": (
        "event_k message left_side right_side batched_left batched_right instant near pairs",
        """select task, serial, left_id, right_id, left_k % 2 = 1 or right_k % 3 = 1 as executed,
                  coalesce(left_plan, '') as user_plan, how from pairs
           union all
           select task, serial, event_id, event_id, k % 2 = 1, coalesce(user_plan, ''), 'ready'
           from message where topic = 'TRACKLET_ATTR'""",
    ),
    "valid_edges": ("feature last_link valid", "select src, dst, sim from valid"),
    "pid_join": (
        "event_k report",
        """select 'container-' || c_custkey as container, c_custkey % 8 as node, c_custkey as pid,
                  coalesce(gpus, '') as index_list, coalesce(mems, '') as mem_list
           from customer left join (
             select node, pid, string_agg(cast(device as varchar), ',' order by device) as gpus,
                    string_agg(cast(mem as varchar), ',' order by device) as mems
             from (select node, pid, device, cast(sum(mem) as bigint) as mem from report group by 1, 2, 3)
             group by node, pid) u on u.node = c_custkey % 8 and u.pid = c_custkey""",
    ),
    "time_bucket_join": (
        "entity bucket placed",
        "select hour_key, bucket_start, bucket_end, entity_id, data_type from placed",
    ),
    "span_edges": (
        "entity",
        """select distinct strftime(s, '%Y%m%d%H%M')::bigint as bucket_start, strftime(e, '%Y%m%d%H%M')::bigint as bucket_end,
                  entity, data_type
           from (select day + interval 5 hour + interval 30 minute as s, day + interval 6 hour + interval 45 minute as e
                 from (select distinct date_trunc('day', st) as day from entity)
                 union all
                 select day + interval 22 hour + interval 40 minute,
                        day + to_days(cast(dayofyear(day) % 3 + 1 as integer)) + interval 1 hour + interval 15 minute
                 from (select distinct date_trunc('day', st) as day from entity))
           join (select *, st + to_seconds(start_frame * 2 // 25) as t from entity)
             on t >= s and t < e + interval 1 minute""",
    ),
    "video_overlaps": (
        "entity",
        """select a.video as a, b.video as b,
                  epoch(least(a.st, b.st) + interval 6 hour)::bigint - epoch(greatest(a.st, b.st))::bigint as shared_s
           from (select distinct video, st from entity) a
           join (select distinct video, st from entity) b
             on a.video < b.video and a.st <= b.st + interval 6 hour and b.st <= a.st + interval 6 hour""",
    ),
    "pairs_in_bucket": (
        "entity feature",
        """select bucket, id, rank, other, round(sim, 6) as sim
           from (select *, row_number() over (partition by bucket, id order by sim desc, other) as rank
                 from (select a.bucket, a.id, b.id as other,
                              round(list_cosine_similarity(a.vec::double[], b.vec::double[]), 9) as sim
                       from (select id, vec, substr(start_time, 1, 6) as bucket from feature join entity on id = entity) a
                       join (select id, vec, substr(start_time, 1, 6) as bucket from feature join entity on id = entity) b
                         on a.bucket = b.bucket and a.id <> b.id)) where rank <= 5""",
    ),
    "bucket_counts": (
        "entity bucket placed",
        "select bucket_start, count(*) as n_members from placed group by bucket_start",
    ),
    "complete_groups": (
        "entity numbered",
        """select task, n_stored, n_declared, n_declared - n_stored as missing, n_declared = n_stored as complete
           from (select video as task, count(*) as n_stored, max(num) as n_declared from numbered
                 where entity in (select l_orderkey from lineitem) group by video)""",
    ),
    "repath_complete": (
        "entity numbered",
        """select entity, '/meta/result/' || video || '/' || video || '.har/' || serial as path
           from (select *, count(*) over (partition by video) as n_stored from numbered
                 where entity in (select l_orderkey from lineitem)) where n_stored = num""",
    ),
    "archived_entities": (
        "entity numbered",
        """select entity_id, data_type, start_time,
                  '/meta/result/' || video || '/' || video || case when n_stored = num then '.har/' else '/' end || serial as path
           from (select *, count(*) over (partition by video) as n_stored from numbered
                 where entity in (select l_orderkey from lineitem))""",
    ),
    "topic_counts": (
        "event_k message",
        """select coalesce(topic, 'all') as topic, coalesce("partition", -1) as "partition", count(*) as n_messages
           from message group by rollup (topic, "partition")""",
    ),
    "mean_cost": (
        "event_k run",
        """select *, total_ms // n_runs as ms_per_run,
                  case when n_samples > 0 then total_ms // n_samples end as ms_per_sample
           from (select type, node, count(*) as n_runs, cast(sum(n_samples) as bigint) as n_samples,
                        cast(sum(end_ms - start_ms) as bigint) as total_ms from run group by type, node)""",
    ),
    "distinct_since": (
        "event_k run",
        "select distinct video from run where start > timestamp '2024-01-15 00:00:00'",
    ),
    "runs_since": (
        "event_k run",
        "select event_id, task, type, node, video from run where start > timestamp '2024-01-15 00:00:00'",
    ),
    "video_duration": (
        "event_k run",
        f"""select distinct video, epoch_ms(strptime(split_part(video, '-', 3), {STAMP}))
                   - epoch_ms(strptime(split_part(video, '-', 2), {STAMP})) as duration_ms from run""",
    ),
    "total_duration": (
        "event_k run",
        f"""select count(*) as n_videos, cast(sum(epoch_ms(strptime(split_part(video, '-', 3), {STAMP}))
                   - epoch_ms(strptime(split_part(video, '-', 2), {STAMP}))) as bigint) as total_ms
            from (select distinct video from run)""",
    ),
    "link_count": ("feature last_link valid", "select src, count(*) as n_links from valid group by src"),
    "latest_per_node": (
        "event_k report",
        """select node, event_id, pid, util from report
           qualify row_number() over (partition by node order by ts desc, event_id desc) = 1""",
    ),
    "ranked_links": (
        "feature last_link valid",
        "select src, dst, sim, row_number() over (partition by src order by sim desc, dst) as rank from valid",
    ),
    "topk_similar": (
        "feature",
        """select probe, rank, id, round(sim, 6) as sim
           from (select *, row_number() over (partition by probe order by sim desc, id) as rank
                 from (select p.id as probe, g.id as id,
                              round(list_cosine_similarity(p.vec::double[], g.vec::double[]), 9) as sim
                       from feature p join feature g on p.id <> g.id)) where rank <= 10""",
    ),
    "topk_pruned": (
        "feature",
        """select probe, rank, id, round(sim, 6) as sim
           from (select *, row_number() over (partition by probe order by sim desc, id) as rank
                 from (select p.id as probe, g.id as id,
                              round(list_cosine_similarity(p.vec::double[], g.vec::double[]), 9) as sim
                       from feature p join feature g on p.id <> g.id)) where rank <= 10""",
    ),
    "id_ranks": (
        "feature",
        """select probe, string_agg(cast(id as varchar), ',' order by rank) as ids
           from (select *, row_number() over (partition by probe order by sim desc, id) as rank
                 from (select p.id as probe, g.id as id,
                              round(list_cosine_similarity(p.vec::double[], g.vec::double[]), 9) as sim
                       from feature p join feature g on p.id <> g.id)) where rank <= 10 group by probe""",
    ),
    "free_devices": (
        "event_k report",
        """select distinct node, device from report
           where (node, device) not in (select (node, device) from report where util > 190.0)""",
    ),
    "upsert_merge": (
        "entity box patched means feature latest_track entity_row",
        """select entity_id, data_type, path, start_time, s1, s2, s3, n_floats, is_finish, is_get_sim
           from entity_row""",
    ),
    "lookup_entity": (
        "event_k entity box patched means feature latest_track entity_row",
        """select entity_id, data_type, path, s1, s2, s3 from entity_row
           where (entity_id, data_type) in (select (cast(user_id as varchar), 'plan-' || (k % 3)) from event_k)""",
    ),
    "lookup_feature": (
        "event_k feature",
        """select cast(id as varchar) as entity_id, 'plan-' || (id % 3) as data_type, cast(len(vec) as bigint) as n_floats,
                  cast(vec[1] as double) as first, cast(vec[-1] as double) as last
           from feature where (id, id % 3) in (select (user_id, k % 3) from event_k)""",
    ),
    "pair_value": (
        "feature last_link valid",
        """select src, dst, sim from valid
           where (src, dst) in (select (l_partkey, l_suppkey) from lineitem where l_returnflag = 'R')""",
    ),
    "pair_similarity": (
        "feature last_link valid",
        """select src, dst, round(c, 6) as similarity, round(1 - c, 6) as dissimilarity
           from (select src, dst, list_cosine_similarity(a.vec::double[], b.vec::double[]) as c
                 from valid join feature a on a.id = src join feature b on b.id = dst)""",
    ),
    "sim_by_bucket": (
        "event_k",
        """select a.event_id as src, b.event_id as dst, a.value as sim,
                  case when date_trunc('minute', a.ts) = date_trunc('minute', b.ts) then 'minute' else 'hour' end
                  as level
           from event_k a join event_k b on b.event_id = a.event_id + 1 + a.k % 3
           where date_trunc('hour', a.ts) = date_trunc('hour', b.ts)""",
    ),
    "attr_distance": (
        "box patched means",
        """select src, dst, (abs(a.s1 - b.s1) + abs(a.s2 - b.s2) + abs(a.s3 - b.s3)) / 3 as distance
           from (select distinct l_partkey as src, l_suppkey as dst from lineitem)
           join means a on a.entity = src join means b on b.entity = dst""",
    ),
    "tracks_hook": (
        "entity",
        """select video, serial, num, 1 + (mark * 31 + serial * 17) % 10000 as start_frame,
                  1 + (mark + serial * 7) % 31 as n_boxes
           from (select *, 3 + mark % 30 as num
                 from (select distinct video, cast(split_part(video, '-', 2) as bigint) % 97 as mark from entity)),
                range(32) as r(serial) where serial < num""",
    ),
    "features_hook": (
        "box patched kept",
        """select entity, idx, cast(128 as bigint) as n_floats,
                  (x * 31 + y * 17 + w * 7 + h * 3) % 256 / 256.0::double as first,
                  (x * 31 + y * 17 + w * 7 + h * 3 + 127) % 256 / 256.0::double as last from kept""",
    ),
    "detections_hook": (
        "",
        """select o_orderkey as id, ['person', 'car', 'bag'][o_orderkey % 3 + 1] as label,
                  o_orderkey % 4 as n_boxes,
                  case when o_orderkey % 4 > 0 then o_orderkey % (64 + o_orderkey % 50) end as x,
                  case when o_orderkey % 4 > 0 then o_orderkey * 3 % (48 + o_orderkey * 37 % 1000000 % 30) end as y,
                  case when o_orderkey % 4 > 0 then o_orderkey % 100 / 100.0::double end as score from orders""",
    ),
    "pack_files": (
        "entity numbered box patched",
        """select video, member, length, (cell << 32) + no as pack, cast(coalesce(sum(length) over (
                      partition by video, cell, no order by member
                      rows between unbounded preceding and 1 preceding), 0) as bigint) as at
           from (select *, cast(coalesce(sum(length + 512) over (
                                partition by video, cell order by member
                                rows between unbounded preceding and 1 preceding), 0) as bigint) // 4096 as no
                 from (select *, cast('0x' || substr(md5(member), 1, 8) as bigint) % (all_bytes // 65536 + 1) as cell
                       from (select *, cast(sum(length + 512) over (partition by video) as bigint) as all_bytes
                             from (select video, serial || '/' || idx as member,
                                          cast(strlen(patch) as bigint) as length
                                   from patched join numbered using (entity)))))""",
    ),
    "command_flow": (
        "event_k message command known entity numbered file task box patched means",
        f"""select * from (
            with flow(command, track, attr, feature, rank, old) as (values {_FLOW}),
            found as (
                select *, 1 + (mark * 31 + serial * 17) % 10000 as start_frame, 1 + (mark + serial * 7) % 31 as n
                from (select *, 3 + mark % 30 as num
                      from (select distinct video, cast(split_part(video, '-', 2) as bigint) % 97 as mark from entity)),
                     range(32) as r(serial) where serial < num),
            asked as (
                select command, video, serial, max(command_id) as command_id, origin from (
                    select t.command, t.video, v.serial, command_id, 'tracked' as origin
                    from task t join found v on t.video = v.video where input = 'video' and t.command like 'track%'
                    union all
                    select t.command, t.video, e.serial, command_id, 'stored' as origin
                    from task t join numbered e on t.video = e.video and (t.input = 'entity' or t.serial = e.serial)
                    where input in ('entity', 'serial') and e.entity in (select entity from box))
                group by command, video, serial, origin),
            tracks as (
                select t.command, t.video, v.serial, start_frame, num, arg_max(task, command_id) as task
                from task t join found v on t.video = v.video join flow f on f.command = t.command and f.track
                group by t.command, t.video, v.serial, start_frame, num),
            sampled as (
                select 'tracked' as origin, video, serial, idx, idx as x, idx * 2 as y, 3 as w, idx + 1 as h
                from found, range(32) as b(idx) where idx < n and {_keeps(5)}
                union all
                select 'stored', video, serial, idx, x, y, w, h from box join numbered using (entity)
                where {_keeps(5)} and w * h <> 0),
            based as (select *, x * 31 + y * 17 + w * 7 + h * 3 as base from sampled),
            score as (select origin, video, serial, arg_min(base, idx) as first_base, """
        + ", ".join(f"cast(sum((base + {i * 13}) % 1000) as double) / count(*) as {a}" for i, a in enumerate(ATTRS))
        + f""" from based group by origin, video, serial),
            old as (select video, serial, s1 from means join numbered using (entity)),
            mark as (
                select a.*, f.track, f.attr, f.feature, s.* exclude (origin, video, serial),
                       case when f.rank and not f.old
                            then cast(floor({ATTRS[0]}) as bigint) * 31 + cast(floor({ATTRS[-1]}) as bigint)
                            when f.rank then cast(floor(o.s1) as bigint) * 31
                                        + cast(floor(o.s1 + {len(ATTRS) - 1}) as bigint) end as rank_base
                from asked a join flow f on f.command = a.command
                left join score s on s.origin = a.origin and s.video = a.video and s.serial = a.serial
                left join old o on a.origin = 'stored' and o.video = a.video and o.serial = a.serial)
            select m.video || '_tarid' || m.serial as entity_id, m.command as data_type,
                   coalesce('/meta/result/ssd/2018-05-09/' || m.video || '/' || task || '/' || m.serial, '') as path,
                   coalesce(strftime(strptime(split_part(m.video, '-', 2), {STAMP}) + to_seconds(start_frame * 2 // 25),
                                     {STAMP}), '') as start_time,
                   coalesce(num, -1) as num, """
        + ", ".join(f"case when attr then coalesce({a}, -1) else -1 end as {a}" for a in ATTRS)
        + """, case when feature then coalesce(first_base % 256 / 256.0::double, -1) else -1 end as feature_first,
                   case when feature then coalesce((first_base + 127) % 256 / 256.0::double, -1) else -1 end as feature_last,
                   feature and first_base is not null as is_finish,
                   coalesce(array_to_string([(rank_base + j * 7) % 10000 for j in range(10)
                                             if rank_base is not null], ','), '') as ids
            from mark m left join tracks t on t.command = m.command and t.video = m.video and t.serial = m.serial
            where m.track or (attr and first_base is not null) or (feature and first_base is not null)
                  or rank_base is not null)""",
    ),
    "scores_hook": (
        "box patched kept",
        "select entity, count(*) as n_samples, "
        + ", ".join(
            f"cast(sum((x * 31 + y * 17 + w * 7 + h * 3 + {i * 13}) % 1000) as double) / count(*) as {a}"
            for i, a in enumerate(ATTRS)
        )
        + " from kept group by entity",
    ),
}


def oracle_sql() -> dict[str, str]:
    """SQL of every registered query that SQL can express."""
    out = {}
    for name, (needs, select) in _SELECT.items():
        tables = ",\n".join(_WITH[n] for n in needs.split())
        out[name] = f"with {tables}\n{select}" if tables else select
    return out
