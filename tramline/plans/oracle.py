"""Independent DuckDB SQL for each registered query.

Only the raw driver tables are registered as views on the oracle side, so
every statement starts with the same CTE prefix: the transit mapping of
FIXTURES.md §3 (DuckDB spelling) followed by typed/derived tables written
independently of the Spark code. ``pos`` is a row's number in its file: DuckDB
scans a file in order, and ``row_number() over ()`` counts in that order. Window boundaries are epoch milliseconds
computed with integer arithmetic; local hours use DuckDB's zone database.
"""

from __future__ import annotations

AS_OF_DATE = "20240115"
AS_OF_EPOCH_S = 1704110400

_ET = "(1704067200000000+(epoch_us(ts)-1704067200000000)//60)"

# FIXTURES.md §3 views (DuckDB text), plus time columns for alerts.
_BASE = [
    ("vehicle_positions", f"""
 select case when event_id%97=0 then '' else 'V'||user_id end vehicle_id,
 case when event_type='error' then '' else cast(500+user_id%12 as varchar) end route_id,
 case when event_id%101=0 then cast(0 as double) else cast(43.6+(user_id%50)*0.002 as double) end latitude,
 case when event_id%101=0 then cast(0 as double) else cast(-79.4+(user_id%50)*0.002 as double) end longitude,
 case when event_id%4=0 then null else cast(event_id%360 as float) end bearing,
 cast(null as float) speed, case when event_id%5=0 then 'EMPTY' end occupancy,
 case when event_id%13=0 then null else 'T'||(user_id//12+1) end trip_id,
 case when event_id%29=0 then cast(user_id%2 as int) end direction_id,
 case when event_type='signup' then null else cast(floor(value) as int)%60 end current_stop_sequence,
 make_timestamp({_ET}-case when event_id%17=0 then 400000000 else 0 end) event_time, make_timestamp({_ET}) received_at,
 {_ET}//1000000-(event_id%3)*20 feed_ts, event_id arrival_seq from events"""),
    ("routes_txt", """
 select 'R'||n_nationkey route_id, case when n_nationkey=10 then '' when n_nationkey=12 then '503' else cast(500+n_nationkey as varchar) end route_short_name,
 case when n_nationkey<2 then 1 when n_nationkey<5 then 0 when n_nationkey=9 then null else 3 end route_type, row_number() over () pos from nation"""),
    ("trips_txt", """
 select 'T'||case when o_orderkey%50=7 then o_orderkey-1 else o_orderkey end trip_id,'R'||(o_custkey%26) route_id,o_orderpriority service_id, case when o_orderkey%7=0 then '' else cast(o_orderkey%2 as varchar) end direction_id,o_orderstatus shape_id, row_number() over () pos from orders"""),
    ("calendar_txt", """
 select * from (values ('1-URGENT','1','20240101','20240630'),('2-HIGH','1','20240101','20240630'),('3-MEDIUM',' 1 ','20230701','20231231'),('4-NOT SPECIFIED','0','20240101','20240630'),('5-LOW','1','20231015','20240630')) t(service_id,wednesday,start_date,end_date)"""),
    ("stops_txt", """
 select 'S'||s_suppkey stop_id,'Stop '||s_suppkey stop_name, case when s_suppkey%37=5 then 'n/a' else cast(43.60+(s_suppkey%10)*0.0005+(s_suppkey%7)*0.0001 as varchar) end stop_lat, cast(-79.40+(s_suppkey//10)*0.002 as varchar) stop_lon,
 case when s_suppkey%10=0 then '1' else '' end location_type, case when s_suppkey%10 in (1,2) then 'S'||(s_suppkey-s_suppkey%10) else '' end parent_station, row_number() over () pos from supplier"""),
    ("stop_times_txt", """
 select 'T'||l_orderkey trip_id,'S'||l_suppkey stop_id,cast(l_linenumber as varchar) stop_sequence, case when l_linenumber=1 and l_returnflag='R' then '' else lpad(cast(l_orderkey%28 as varchar),2,'0')||':'||lpad(cast(l_suppkey%60 as varchar),2,'0')||':00' end arrival_time,
 row_number() over () pos from lineitem"""),
    ("service_alerts", f"""
 select 'A'||(user_id%40) alert_id, event_id%333<>0 and not (user_id%8=3 and event_id%2=0) has_body, case when (event_id//700)%2=1 then 'CONSTRUCTION' end cause, case when user_id%3=0 then 'Detail '||((event_id//300)%4) end description_text, case when user_id%4=0 then 'NO_SERVICE' else 'DETOUR' end effect,
 'Alert '||(user_id%40)||' v'||(case when (event_id//500)%3=1 then 1 else 0 end) header_text, list_value(cast(500+user_id%12 as varchar)) affected_route_ids,
 case when user_id%8=5 then list_value('X'||user_id%40, 'X0') else list_value('S'||(10*(user_id%10)),'S'||(10*((user_id+case when (event_id//500)%3=1 then 1 else 0 end)%10))) end affected_stop_ids, event_id arrival_seq,
 {_ET}//1000000 feed_ts, make_timestamp({_ET}) event_time from events"""),
]

_TOR = "cast(hour(timezone('America/Toronto', timezone('UTC', make_timestamp(({ms})*1000)))) as integer)"

# Typed and derived tables, written straight from the job descriptions.
_DERIVED = [
    ("g_routes", """
 select route_id, route_short_name, try_cast(nullif(trim(cast(route_type as varchar)),'') as integer) route_type,
 coalesce(nullif(route_short_name,''), route_id) route_key from (
   select route_id, coalesce(route_short_name,'') route_short_name, route_type,
          row_number() over (partition by route_id order by pos desc) rn from routes_txt) where rn = 1"""),
    # every row of the trips; which one of a repeated id counts is each table's own rule
    ("g_trips", """
 select trip_id, route_id, service_id, direction_raw, try_cast(nullif(trim(direction_raw),'') as integer) direction_id, shape_id, pos from (
     select trip_id, route_id, coalesce(service_id,'') service_id, coalesce(direction_id,'') direction_raw, trim(coalesce(shape_id,'')) shape_id, pos from trips_txt)"""),
    ("g_trip_routes", """
 select trip_id, route_id from (select *, row_number() over (partition by trip_id order by pos desc) rn from g_trips) where rn = 1"""),
    ("g_stops", """
 select * exclude (rn) from (select *, row_number() over (partition by stop_id order by pos desc) rn from (
 select stop_id, coalesce(stop_name,'') stop_name,
 try_cast(nullif(trim(stop_lat),'') as double) latitude, try_cast(nullif(trim(stop_lon),'') as double) longitude,
 trim(coalesce(location_type,'')) location_type, trim(coalesce(parent_station,'')) parent_station, pos from stops_txt)
 where latitude is not null and longitude is not null) where rn = 1"""),
    ("g_stop_times", """
 select trip_id, stop_id, try_cast(nullif(trim(stop_sequence),'') as integer) stop_sequence,
 trim(coalesce(arrival_time,'')) arrival_time, pos from stop_times_txt"""),
    ("g_weekday", """
 select service_id, coalesce(start_date,'') start_date, coalesce(end_date,'') end_date
 from calendar_txt where trim(coalesce(wednesday,''))='1'"""),
    ("g_window", f"""
 select start_date, end_date from g_weekday
 order by (start_date <= '{AS_OF_DATE}' and '{AS_OF_DATE}' <= end_date) desc, start_date desc, end_date desc limit 1"""),
    ("g_services", """
 select distinct service_id from g_weekday join g_window using (start_date, end_date)"""),
    ("g_weekday_trips", """
 select * exclude (rn) from (select *, row_number() over (partition by trip_id order by pos desc) rn from g_trips
   where not exists (select 1 from g_weekday) or service_id in (select service_id from g_services)) where rn = 1"""),
    ("g_first", """
 select trip_id, stop_sequence, arrival_time from (
   select *, row_number() over (partition by trip_id order by stop_sequence, pos) rn
   from g_stop_times where arrival_time <> '' and stop_sequence is not null) where rn = 1"""),
    ("g_tph", """
 select route_id, hour_of_day, direction_id, count(*) trip_count from (
   select r.route_key route_id,
          ((try_cast(trim(split_part(f.arrival_time, ':', 1)) as integer) % 24) + 24) % 24 hour_of_day,
          case when t.direction_raw = '' then '0' else t.direction_raw end direction_id
   from g_weekday_trips t join g_routes r on t.route_id = r.route_id join g_first f on f.trip_id = t.trip_id)
 where hour_of_day is not null group by all"""),
    ("g_headways", """
 select route_id, hour_of_day, round_even(60.0::double / max(trip_count), 2) scheduled_headway_minutes
 from g_tph group by route_id, hour_of_day"""),
    ("g_shape_counts", """
 select r.route_key route_id, coalesce(t.direction_id, 0) direction_id, t.shape_id,
        count(*) trip_count, arg_min(t.trip_id, t.pos) rep_trip_id, min(t.pos) seen_at
 from g_trips t join g_routes r on t.route_id = r.route_id group by all"""),
    ("g_dominant", """
 select route_id, direction_id, shape_id, trip_count, rep_trip_id, pair_at from (
   select *, row_number() over (partition by route_id, direction_id order by trip_count desc, seen_at) rn,
          min(seen_at) over (partition by route_id, direction_id) pair_at
   from g_shape_counts) where rn = 1"""),
    ("g_rep", """
 select * from (select *, row_number() over (partition by rep_trip_id order by pair_at desc) rn from g_dominant) where rn = 1"""),
    ("g_route_stops", """
 select v.route_id, v.direction_id, v.stop_id, s.stop_name, s.latitude, s.longitude, v.stop_sequence from (
   select d.route_id, d.direction_id, st.stop_id, min(st.stop_sequence) stop_sequence
   from g_rep d join g_stop_times st on st.trip_id = d.rep_trip_id
   where st.stop_sequence is not null group by all) v join g_stops s on s.stop_id = v.stop_id"""),
    ("g_stop_routes", """
 select distinct st.stop_id, t.route_id from g_stop_times st join g_trip_routes t on t.trip_id = st.trip_id"""),
    ("g_stations", """
 select s.stop_id station_id, s.stop_name station_name, s.latitude, s.longitude from g_stops s
 where s.stop_id in (select p.parent_station from g_stops p
   where p.parent_station <> '' and p.stop_id in (
     select sr.stop_id from g_stop_routes sr join g_routes r on r.route_id = sr.route_id where r.route_type = 1))"""),
    ("g_surface", """
 select sr.stop_id, r.route_key from g_stop_routes sr join g_routes r on r.route_id = sr.route_id
 join g_stops s on s.stop_id = sr.stop_id
 where r.route_type is distinct from 1 and s.location_type <> '1'"""),
    ("g_feeders", """
 select station_id, station_name, route_id, round_even(min(d), 1) distance_meters from (
   select st.station_id, st.station_name, sf.route_key route_id,
     2 * 6371000 * asin(sqrt(pow(sin((radians(s.latitude) - radians(st.latitude)) / 2), 2)
       + cos(radians(st.latitude)) * cos(radians(s.latitude)) * pow(sin(radians(s.longitude - st.longitude) / 2), 2))) d
   from g_stations st, g_surface sf join g_stops s on s.stop_id = sf.stop_id)
 where d <= 300 group by station_id, station_name, route_id"""),
    ("g_trip_dirs", """
 select trip_id, route_id, direction_id from (
   select *, row_number() over (partition by trip_id order by pos) rn from g_trips) where rn = 1"""),
    # --- positions ---------------------------------------------------------
    ("p_routed", """
 select *, (epoch_us(event_time) // 1000) // 300000 * 300000 window_start from vehicle_positions
 where route_id is not null and route_id <> ''"""),
    ("p_windows", f"""
 select route_id, window_start, window_start + 300000 window_end, count(distinct vehicle_id) vehicles,
        {_TOR.format(ms='window_start')} hour_of_day
 from p_routed group by route_id, window_start"""),
    ("p_delay", """
 select w.route_id, w.window_start, w.window_end,
   floor(5.0::double / w.vehicles * 100 + 0.5) / 100 actual_headway_minutes,
   floor(h.scheduled_headway_minutes * 100 + 0.5) / 100 scheduled_headway_minutes,
   floor((5.0::double / w.vehicles - h.scheduled_headway_minutes) * 100 + 0.5) / 100 delay_score
 from p_windows w join g_headways h on h.route_id = w.route_id and h.hour_of_day = w.hour_of_day"""),
]


# --- crowding, alerts, ripples, live ------------------------------------------
_DERIVED += [
    ("p_late", """
 select *, ((epoch_us(event_time) // 1000) // 300000) * 300 + 300 window_end_s,
        max(event_time) over (order by arrival_seq rows between unbounded preceding and current row) stream_time
 from p_routed"""),
    ("p_on_time", """
 select * from p_late where not (window_end_s <= (epoch_us(stream_time) // 1000) // 1000 - 30)"""),
    ("p_windows_on_time", f"""
 select route_id, window_start, window_start + 300000 window_end, count(distinct vehicle_id) vehicles,
        {_TOR.format(ms='window_start')} hour_of_day
 from p_on_time group by route_id, window_start"""),
    ("p_delay_on_time", """
 select w.route_id, w.window_start, w.window_end,
   floor(5.0::double / w.vehicles * 100 + 0.5) / 100 actual_headway_minutes,
   floor(h.scheduled_headway_minutes * 100 + 0.5) / 100 scheduled_headway_minutes,
   floor((5.0::double / w.vehicles - h.scheduled_headway_minutes) * 100 + 0.5) / 100 delay_score
 from p_windows_on_time w join g_headways h on h.route_id = w.route_id and h.hour_of_day = w.hour_of_day"""),
    ("c_eligible", """
 select p.route_id, p.vehicle_id, coalesce(p.direction_id, t.direction_id) direction_id,
        p.current_stop_sequence, p.feed_ts, p.arrival_seq,
        (epoch_us(p.event_time) // 1000) // 300000 * 300000 window_start
 from vehicle_positions p left join g_trip_dirs t on t.trip_id = p.trip_id and t.direction_id is not null
 where p.route_id <> '' and p.vehicle_id <> '' and p.current_stop_sequence is not null
   and coalesce(p.direction_id, t.direction_id) is not null"""),
    ("c_latest", """
 select * exclude (rn) from (select *, row_number() over (
   partition by route_id, direction_id, window_start, vehicle_id order by feed_ts desc, arrival_seq desc) rn
 from c_eligible) where rn = 1"""),
    ("c_sched", f"""
 select l.*, l.window_start + 300000 window_end, h.scheduled_headway_minutes
 from c_latest l join g_headways h on h.route_id = l.route_id
  and h.hour_of_day = {_TOR.format(ms='l.window_start + 300000')}"""),
    ("c_gaps", """
 select *, lead(current_stop_sequence) over (partition by route_id, direction_id, window_start
             order by current_stop_sequence, vehicle_id) - current_stop_sequence gap_stops,
        max(current_stop_sequence) over (partition by route_id, direction_id, window_start)
        - min(current_stop_sequence) over (partition by route_id, direction_id, window_start) span
 from c_sched"""),
    ("c_ratio", """
 select *, case when span > 0 then gap_stops * (5.0::double / span) end gap_min,
        case when span > 0 then gap_stops * (5.0::double / span) end / scheduled_headway_minutes ratio
 from c_gaps"""),
    ("c_out", """
 select vehicle_id, route_id, direction_id,
   floor(gap_min * 100 + 0.5) / 100 gap_ahead_minutes, floor(ratio * 100 + 0.5) / 100 crowding_ratio,
   floor(scheduled_headway_minutes * 100 + 0.5) / 100 scheduled_headway_minutes,
   case when ratio is null then 'UNKNOWN' when ratio >= 1.5 then 'LIKELY_CROWDED'
        when ratio <= 0.5 then 'LIKELY_EMPTY' else 'NORMAL' end crowding_level, window_end
 from c_ratio"""),
    ("a_changes", """
 select * from (select *, lag(effect) over w pe, lag(header_text) over w ph,
     lag(list_sort(affected_route_ids)) over w pr, lag(list_sort(affected_stop_ids)) over w ps,
     lag(cause) over w pc, lag(description_text) over w pd,
     row_number() over w rn
   from service_alerts where has_body window w as (partition by alert_id order by arrival_seq))
 where rn = 1 or pe is distinct from effect or ph is distinct from header_text
    or pr is distinct from list_sort(affected_route_ids) or ps is distinct from list_sort(affected_stop_ids)
    or pc is distinct from cause or pd is distinct from description_text"""),
    ("a_current", """
 select * exclude (rn) from (select *, row_number() over (partition by alert_id order by arrival_seq desc) rn
 from service_alerts) where rn = 1 and has_body"""),
    ("a_last", """
 select * exclude (rn) from (select *, row_number() over (partition by alert_id order by arrival_seq desc) rn
 from service_alerts where has_body) where rn = 1"""),
    ("r_versions", """
 select alert_id, effect, header_text, affected_route_ids, arrival_seq, event_time,
        unnest(list_distinct(affected_stop_ids)) station_id from service_alerts where has_body"""),
    ("r_closest", """
 select * exclude (rn) from (select v.*, f.station_name, f.route_id, f.distance_meters,
     row_number() over (partition by v.alert_id, v.arrival_seq, f.route_id order by f.distance_meters, f.station_id) rn
   from r_versions v join g_feeders f on f.station_id = v.station_id
   where not list_contains(v.affected_route_ids, f.route_id)) where rn = 1"""),
    ("r_rows", """
 select alert_id || '-' || route_id ripple_id, alert_id source_alert_id, effect source_effect,
   station_name affected_station, route_id feeder_route_id, 'LIKELY_CROWDING_INCREASE' predicted_impact,
   'Feeder route ' || route_id || ' near ' || station_name || ' station: ' || header_text header_text,
   arrival_seq, event_time written_at from r_closest"""),
    ("r_live", f"""
 select * exclude (rn) from (select *, row_number() over (partition by ripple_id order by arrival_seq desc) rn
 from r_rows) where rn = 1 and epoch_us(written_at) + 1800000000 > {AS_OF_EPOCH_S * 1000000}"""),
    ("v_live", f"""
 select * exclude (rn) from (select *, row_number() over (partition by vehicle_id order by arrival_seq desc) rn
 from vehicle_positions where vehicle_id <> '') where rn = 1
   and epoch_us(event_time) + 120000000 > {AS_OF_EPOCH_S * 1000000}"""),
    ("v_crowd_live", f"""
 select * exclude (rn) from (select *, row_number() over (
   partition by vehicle_id order by window_end desc, route_id desc, direction_id desc) rn
 from c_out where vehicle_id <> '') where rn = 1 and window_end * 1000 + 30000000 + 600000000 > {AS_OF_EPOCH_S * 1000000}"""),
    ("v_snapshot", """
 select v.*, c.crowding_level from v_live v left join v_crowd_live c on c.vehicle_id = v.vehicle_id"""),
    ("v_marked", """
 select *, sum(case when p is null or epoch_us(received_at) - epoch_us(p) > 180000000 then 1 else 0 end)
   over (partition by vehicle_id order by received_at, arrival_seq) run from (
   select *, lag(received_at) over (partition by vehicle_id order by received_at, arrival_seq) p
   from vehicle_positions where vehicle_id <> '')"""),
    ("v_last_run", f"""
 select m.* from v_marked m join (select vehicle_id, max(run) run from v_marked group by vehicle_id
   having epoch_us(max(received_at)) >= {(AS_OF_EPOCH_S - 180) * 1000000}) l on l.vehicle_id = m.vehicle_id and l.run = m.run"""),
    ("v_levels", f"""
 select vehicle_id, crowding_level from (select c.vehicle_id, c.crowding_level, row_number() over (
     partition by c.vehicle_id order by window_end desc, c.route_id desc, c.direction_id desc) rn
   from c_out c join (select vehicle_id, min(epoch_us(received_at)) b, max(epoch_us(received_at)) e from v_last_run group by vehicle_id) r
     on r.vehicle_id = c.vehicle_id and c.window_end * 1000 + 30000000 between b and e + 180000000
   where c.window_end * 1000 + 30000000 <= {AS_OF_EPOCH_S * 1000000}) where rn = 1"""),
    ("t_whole", """
 select event_id, '{"vehicle_id":"' || case when event_id%37=5 then '' else 'V'||user_id end || '","route_id":"'
   || (500+user_id%12) || '","event_id":' || event_id || '}' body from events"""),
    ("t_topic", """
 select event_id arrival_seq, case when event_id%31=3 then substring(body, 1, length(body)-4) when event_id%41=7 then 'no JSON '||event_id
   when event_id%43=11 then null else body end "value",
   case when event_id%31=3 or event_id%41=7 then 'malformed' when event_id%43=11 then 'empty' when event_id%37=5 then 'no key' end reason
 from t_whole"""),
    ("d_board", """
 select * exclude (rn) from (select *, row_number() over (partition by route_id order by window_start desc) rn
 from p_delay) where rn = 1"""),
]

_VEH = ("vehicle_id, route_id, latitude, longitude, bearing, feed_ts, occupancy, trip_id, direction_id, "
        "current_stop_sequence, arrival_seq")
_STICKY = ["route_id", "latitude", "longitude", "bearing", "occupancy", "trip_id", "direction_id",
           "current_stop_sequence", "feed_ts"]


_DELAY = "route_id, window_start, window_end, actual_headway_minutes, scheduled_headway_minutes, delay_score"
_CROWD = ("vehicle_id, route_id, direction_id, gap_ahead_minutes, crowding_ratio, scheduled_headway_minutes, crowding_level, "
          "window_end")
_ALERT = "alert_id, effect, header_text, affected_route_ids, affected_stop_ids, feed_ts, arrival_seq"
_RIPPLE = ("ripple_id, source_alert_id, source_effect, affected_station, feeder_route_id, predicted_impact, header_text, "
           "arrival_seq")


def _json(columns: str) -> str:
    return "cast(to_json({" + ", ".join(f"'{c.strip()}': {c.strip()}" for c in columns.split(",")) + "}) as varchar)"


def _sparse(columns: str) -> str:
    """Without the members that are null (a merge patch removes them)."""
    return "cast(json_merge_patch('{}', " + _json(columns)[5:-12] + ") as varchar)"


def with_prefix(select_sql: str) -> str:
    ctes = ",\n".join(f"{name} as ({body}\n)" for name, body in _BASE + _DERIVED)
    return f"with {ctes}\n{select_sql}"


ORACLE_SELECTS: dict[str, str] = {
    "delay_scores": "select * from p_delay",
    "delay_scores_on_time_only": "select * from p_delay_on_time",
    "unscheduled_windows": """select w.route_id, w.hour_of_day, w.window_start, w.window_end, w.vehicles
        from p_windows w anti join g_headways h on h.route_id = w.route_id and h.hour_of_day = w.hour_of_day""",
    "late_positions": """select arrival_seq, route_id, vehicle_id, (epoch_us(event_time) // 1000) event_time_ms,
        (epoch_us(stream_time) // 1000) stream_time_ms from p_late where window_end_s <= (epoch_us(stream_time) // 1000) // 1000 - 30""",
    "crowding_estimates": "select * from c_out",
    "crowding_estimates_array_form": "select * from c_out",
    "latest_vehicle_snapshot": """select route_id, direction_id, window_start, vehicle_id,
        current_stop_sequence, feed_ts, arrival_seq from c_latest""",
    "resolved_direction": """select arrival_seq, vehicle_id, route_id, direction_id, current_stop_sequence
        from c_eligible""",
    "routes": "select route_id, route_short_name, route_type from g_routes",
    "weekday_trips": "select trip_id, route_id, service_id, direction_raw from g_weekday_trips",
    "trip_directions": "select * from g_trip_dirs",
    "first_departures": "select * from g_first",
    "trips_per_hour_direction": "select * from g_tph",
    "scheduled_headways": "select * from g_headways",
    "route_headway_report": "select * from g_headways where route_id = '504'",
    "dominant_shapes": "select route_id, direction_id, shape_id, trip_count, rep_trip_id from g_dominant",
    "trips_first_row": "select * from g_trip_dirs",
    "trips_last_row": "select * from g_trip_routes",
    "route_paths": "select * from g_route_stops",
    "route_path_fallback": """select * from g_route_stops r where direction_id in (0, 1) and direction_id = (
        select min(x.direction_id) from g_route_stops x where x.route_id = r.route_id and x.direction_id in (0, 1))""",
    "stop_routes": "select * from g_stop_routes",
    "subway_stations": "select * from g_stations",
    "station_feeder_routes": "select * from g_feeders",
    "station_feeders_report": "select * from g_feeders where lower(station_name) like '%stop 10%'",
    "alert_changes": """select alert_id, effect, header_text, array_to_string(affected_route_ids, ',') affected_route_ids,
        array_to_string(affected_stop_ids, ',') affected_stop_ids, feed_ts, arrival_seq from a_changes""",
    "current_alerts": """select alert_id, effect, header_text, array_to_string(affected_route_ids, ',') affected_route_ids,
        array_to_string(affected_stop_ids, ',') affected_stop_ids, feed_ts, arrival_seq from a_current""",
    "ripple_changelog": """select ripple_id, source_alert_id, source_effect, affected_station, feeder_route_id,
        predicted_impact, header_text, arrival_seq from r_rows""",
    "ripples_live": """select ripple_id, source_alert_id, affected_station, feeder_route_id, header_text, arrival_seq,
        (epoch_us(written_at) // 1000) detected_at from r_live""",
    "alerts_without_ripples": """select alert_id, effect, header_text,
        array_to_string(affected_stop_ids, ',') affected_stop_ids, arrival_seq from a_current c
        where not exists (select 1 from g_feeders f where list_contains(c.affected_stop_ids, f.station_id))""",
    "live_vehicles": f"select {_VEH} from v_live",
    "vehicle_sticky_state": "select vehicle_id, " + ", ".join(
        f"arg_max({c}, arrival_seq) filter (where {c} is not null) {c}" for c in _STICKY)
        + ", max(arrival_seq) arrival_seq from vehicle_positions where vehicle_id <> '' group by vehicle_id",
    "vehicle_snapshot": f"select {_VEH}, crowding_level from v_snapshot",
    "vehicle_client_state": "select s.*, c.crowding_level from (select vehicle_id, " + ", ".join(
        f"arg_max({c}, arrival_seq) filter (where {c} is not null) {c}" for c in _STICKY)
        + ", max(arrival_seq) arrival_seq from v_last_run group by vehicle_id) s"
        + " left join v_levels c on c.vehicle_id = s.vehicle_id",
    "live_counters": """select 'vehicles' counter, count(*) "value" from v_live
        union all select 'alerts', count(*) from a_last
        union all select 'ripples', count(*) from r_live""",
    "map_vehicles": """select s.vehicle_id, s.route_id, s.latitude, s.longitude,
        case when t.route_type = 1 then 'subway' when t.route_type = 0 then 'streetcar' else 'bus' end vehicle_kind,
        case when s.crowding_level in ('NORMAL', 'LIKELY_CROWDED', 'LIKELY_EMPTY', 'UNKNOWN') then s.crowding_level
             else 'UNKNOWN' end crowding_level
        from v_snapshot s left join (select route_short_name, route_type from (select *, row_number() over (
          partition by route_short_name order by route_id desc) rn from g_routes) where rn = 1) t
          on t.route_short_name = s.route_id
        where s.latitude is not null and s.longitude is not null and not (s.latitude = 0 and s.longitude = 0)""",
    "delay_board": """select route_id, window_start, delay_score, actual_headway_minutes, scheduled_headway_minutes,
        case when delay_score >= 2 then 'bad' when delay_score <= -2 then 'ahead' else 'ok' end band,
        case when delay_score > 0 then '+' else '' end || printf('%.2f', delay_score) delay_display from d_board""",
    "routes_by_short_name": """select route_id, route_short_name, route_type,
        cast(row_number() over (order by route_short_name, route_id) as integer) listing_rank from g_routes""",
    "delay_board_by_route": """select route_id, case when delay_score > 0 then '+' else '' end || printf('%.2f', delay_score) delay_display,
        cast(round(cast(actual_headway_minutes as decimal(18, 2)), 1) as varchar) || ' / '
          || cast(round(cast(scheduled_headway_minutes as decimal(18, 2)), 1) as varchar) headway_display,
        cast(row_number() over (order by try_cast(nullif(regexp_extract(route_id, '^(\\d+)', 1), '') as bigint) nulls last, route_id) as integer) board_rank
        from d_board""",
    "delay_envelopes": """select 'delay_update' "type", cast(to_json({'route_id': route_id, 'window_start': window_start, 'window_end': window_end,
        'actual_headway_minutes': actual_headway_minutes, 'scheduled_headway_minutes': scheduled_headway_minutes,
        'delay_score': delay_score}) as varchar) "data" from p_delay""",
    "delay_board_by_route_descending": """select route_id, case when delay_score > 0 then '+' else '' end || printf('%.2f', delay_score) delay_display,
        cast(round(cast(actual_headway_minutes as decimal(18, 2)), 1) as varchar) || ' / '
          || cast(round(cast(scheduled_headway_minutes as decimal(18, 2)), 1) as varchar) headway_display,
        cast(row_number() over (order by try_cast(nullif(regexp_extract(route_id, '^(\\d+)', 1), '') as bigint) desc nulls first, route_id desc) as integer) board_rank
        from d_board""",
    "update_envelopes": f"""select 'vehicle_update' "type", {_sparse(_VEH)} "data" from vehicle_positions where vehicle_id <> ''
        union all select 'delay_update', {_sparse(_DELAY)} from p_delay
        union all select 'crowding_update', {_sparse(_CROWD)} from c_out
        union all select 'alert_update', {_sparse(_ALERT)} from service_alerts where has_body
        union all select 'ripple_update', {_sparse(_RIPPLE)} from r_rows""",
    "snapshot_document": f"""select 'vehicles' section, {_sparse(_VEH + ", crowding_level")} "json" from v_snapshot
        union all select 'delays', {_sparse(_DELAY)} from d_board
        union all select 'alerts', {_sparse(_ALERT)} from a_last
        union all select 'ripples', {_sparse(_RIPPLE)} from r_live""",
    "vehicle_messages": f"""select vehicle_id "key", {_sparse(_VEH)} "value" from vehicle_positions where vehicle_id <> ''""",
    "crowding_messages": f"""select vehicle_id "key", {_json(_CROWD)} "value" from c_out""",
    "topic_rejects": "select arrival_seq, reason, value from t_topic where reason is not null",
    "topic_counters": "select coalesce(reason, 'good') outcome, count(*) records from t_topic group by 1",
    "load_counters": """select 'routes' counter, count(*) "value" from g_routes
        union all select 'trips', count(*) from g_trip_dirs
        union all select 'scheduled_headways', count(*) from g_headways
        union all select 'station_feeder_routes', count(*) from g_feeders
        union all select 'route_stops', count(*) from g_route_stops
        union all select 'alert_records', count(*) from service_alerts where has_body
        union all select 'alerts_published', count(*) from a_changes
        union all select 'alerts_new', count(distinct alert_id) from service_alerts where has_body""",
    "alert_peek": """select arrival_seq, cast(to_json({'alert_id': alert_id, 'effect': effect, 'header_text': header_text}) as varchar) "value"
        from service_alerts where has_body order by arrival_seq desc limit 10""",
    "active_alerts": """select alert_id, effect, cause, header_text, description_text, array_to_string(affected_route_ids, ',') affected_route_ids,
          array_to_string(affected_stop_ids, ',') affected_stop_ids, feed_ts active_since, feed_ts "timestamp" from a_last
        union all by name
        select ripple_id, source_alert_id, source_effect, affected_station, feeder_route_id, predicted_impact,
          header_text, (epoch_us(written_at) // 1000) detected_at from r_live""",
    "alert_feed": """select 'alert' kind, alert_id item_id, coalesce(feed_ts, 0) * 1000 sort_time_ms,
          case when effect = 'NO_SERVICE' then 'severe' else 'info' end severity,
          replace(effect, '_', ' ') label, header_text text from a_last
        union all
        select 'ripple', ripple_id, (epoch_us(written_at) // 1000), 'ripple', lower(replace(predicted_impact, '_', ' ')),
          'Route ' || feeder_route_id || ' near ' || affected_station || ' - cascaded from ' || source_alert_id
        from r_live""",
    "update_envelope_counts": """select 'vehicle_update' "type", count(*) messages from vehicle_positions where vehicle_id <> ''
        union all select 'delay_update', count(*) from p_delay
        union all select 'crowding_update', count(*) from c_out
        union all select 'alert_update', count(*) from service_alerts where has_body
        union all select 'ripple_update', count(*) from r_rows""",
    "vehicle_feed_normalized": """select vehicle_id, route_id,
        case when latitude = 0 and longitude = 0 then 0.0::double else cast(cast(latitude as float) as double) end latitude,
        case when latitude = 0 and longitude = 0 then 0.0::double else cast(cast(longitude as float) as double) end longitude,
        case when latitude = 0 and longitude = 0 then null else bearing end bearing,
        feed_ts, occupancy, trip_id, direction_id, current_stop_sequence, arrival_seq from vehicle_positions""",
    "alert_feed_normalized": """select alert_id, effect, cause, header_text, description_text,
        array_to_string(affected_route_ids, ',') affected_route_ids,
        case when affected_stop_ids[1] = affected_stop_ids[2] then affected_stop_ids[1]
             else affected_stop_ids[1] || ',' || affected_stop_ids[2] end affected_stop_ids,
        feed_ts active_since, feed_ts, arrival_seq from service_alerts where has_body""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_prefix(sel) for name, sel in ORACLE_SELECTS.items()}
