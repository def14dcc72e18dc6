"""DuckDB oracles of the driver queries: the same results written as SQL over
the same parquet tables (views ``events``, ``documents``, ``embeddings``, ...).

The events-as-logs view and the line rules are restated in SQL; computed
doubles are rounded exactly as the Spark queries round them.
"""

from __future__ import annotations

from logscan.functions.hashing import EMBED_DIM
from logscan.plans.queries import DIGITS, TIE_DIGITS

EVENTS_AS_LOGS_SQL = """
  select event_id as _c0, cast(ts as timestamp) as "Timestamp",
         upper(event_type) as LogLevel,
         concat('Service', chr(cast(65 + user_id % 4 as int))) as Service,
         concat('evt ', event_type, ' by User', user_id, ' from 10.0.', user_id % 256, '.',
                event_id % 256) as Message,
         event_id as RequestID, concat('User', user_id) as "User",
         concat('10.0.', user_id % 256, '.', event_id % 256) as ClientIP,
         concat(value, 'ms') as TimeTaken
  from events"""

DIRTY_LOGS_SQL = """
  select _c0, "Timestamp",
         case when k = 1 then null else LogLevel end as LogLevel,
         case when k = 4 then null else Service end as Service,
         case when k = 2 then null else Message end as Message,
         RequestID, "User", ClientIP,
         case when k = 0 then 'nanms' when k = 3 then TimeTaken || 'x'
              when k = 5 then null else TimeTaken end as TimeTaken
  from (select l.*, try_cast(json_extract_string(e.props, '$.k') as bigint) % 10 as k
        from (""" + EVENTS_AS_LOGS_SQL + """) l join events e on e.event_id = l._c0)"""


def _mask_sql(c: str) -> str:
    return (r"regexp_replace(regexp_replace(coalesce(" + c +
            r", 'None'), '\b(?:\d{1,3}\.){3}\d{1,3}\b', '[IP]', 'g'), '\bUser\d+\b', '[USER]', 'g')")


def _parse_sql(c: str) -> str:
    st = r"regexp_replace(regexp_replace(" + c + r", 'ms$', ''), '^\s+|\s+$', '', 'g')"
    num = r"'^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$'"
    return (f"cast(coalesce(case when regexp_matches({st}, {num}) "
            f"then try_cast(replace({st}, '_', '') as double) "
            rf"when regexp_matches({st}, '(?i)^[+-]?nan$') then 'nan'::double "
            rf"when regexp_matches({st}, '(?i)^[+-]?(inf|infinity)$') "
            rf"then try_cast(regexp_replace({st}, '^\+', '') as double) end, 0.0) as float)")


_PREPARED_SQL = ("select _c0 as event_id, \"Timestamp\", LogLevel, Service, " + _mask_sql("Message")
                + " as Message, RequestID, \"User\", ClientIP, TimeTaken, "
                + _parse_sql("TimeTaken") + " as TimeVal from (@SRC@)")


def prepared_sql(src: str) -> str:
    return _PREPARED_SQL.replace("@SRC@", src)


def _token_slots_sql(text: str, dim: int) -> str:
    return (rf"list_transform(list_filter(string_split_regex(lower({text}), '[ \t\r\n]+'), "
            rf"lambda x: x <> ''), lambda t: cast(cast(('0x' || substr(md5(t), 1, 8)) as bigint) % {dim} as integer))")


# Rank-1 test model on the 64-wide embeddings, in SQL (errors unrounded).
EMB_ERRORS_SQL = """
  with b as (select vec_id, label, list_transform(embedding, lambda v: v::double) x,
                    list_transform(range(0, 64), lambda d: ((d * 7) % 11 - 5) / 40.0) w
             from embeddings),
       z as (select *, list_dot_product(x, w) z from b)
  select vec_id, label,
         list_sum(list_transform(range(1, 65), lambda i: (x[i] - w[i] * z) * (x[i] - w[i] * z))) / 64
           as e
  from z"""

# Full log-line chain on events: prepare, drop, text, token slots, and the
# rank-1 model over 768 slots.  For an L2-normalised x and z = x.w the error
# is (1 - 2 z^2 + z^2 |w|^2) / 768, so only slot counts are needed.
LOG_ERRORS_SQL = """
  with prep as (""" + prepared_sql(EVENTS_AS_LOGS_SQL) + """),
  ok as (select * from prep where LogLevel is not null and Service is not null
                             and Message is not null and TimeVal is not null and not isnan(TimeVal)),
  txt as (select *, concat('LOGLEVEL=', LogLevel, ' SERVICE=', Service, ' TIME=',
                           cast(cast(TimeVal as double) as varchar), ' TEXT=', Message) as text from ok),
  tok as (select event_id, unnest(""" + _token_slots_sql("text", EMBED_DIM) + """) as slot from txt),
  cnt as (select event_id, slot, count(*) as c from tok group by all),
  w as (select d as slot, ((d * 7) % 11 - 5) / 40.0 as w from range(0, 768) t(d)),
  ww as (select sum(w * w) as ww from w),
  z as (select event_id, sum(c * w) / sqrt(sum(c * c)) as z from cnt join w using (slot)
        group by event_id)
  select txt.*, (1 - 2 * z * z + z * z * (select ww from ww)) / 768 as e
  from txt join z using (event_id)"""



_UPLOAD_SQL = r"""
  select event_id, event_type,
         case when event_id % 2 = 0 then concat('/data/uploads/', event_id, '/log', user_id, '.csv')
              else concat('C:\uploads\', event_id, '\log', user_id, '.csv') end as filePath,
         concat('log', user_id, '.csv') as fileName,
         epoch_us(ts) // 1000 as uploadTime
  from events"""

_R = f", {DIGITS})"

ORACLE_SQL = {
    "mask_message": "select _c0 as event_id, " + _mask_sql("Message") + " as Message from ("
                    + EVENTS_AS_LOGS_SQL + ")",
    "mask_documents": "select doc_id, " + _mask_sql("text") + " as masked from documents",
    "parse_time": "select event_id, TimeTaken, case when isnan(v) then null else v end as TimeVal, "
                  "isnan(v) as time_is_nan from (select _c0 as event_id, TimeTaken, "
                  + _parse_sql("TimeTaken") + " as v from (" + DIRTY_LOGS_SQL + "))",
    "compose_text": "select event_id, concat('LOGLEVEL=', LogLevel, ' SERVICE=', Service, ' TIME=', "
                    "cast(cast(TimeVal as double) as varchar), ' TEXT=', Message) as text from ("
                    + prepared_sql(EVENTS_AS_LOGS_SQL) + ")",
    "drop_incomplete": "select event_id, LogLevel, Service, Message, TimeVal from ("
                       + prepared_sql(DIRTY_LOGS_SQL)
                       + ") where LogLevel is not null and Service is not null and Message is not null"
                         " and TimeVal is not null and not isnan(TimeVal)",
    "split_bucket": "select event_id, case when cast(('0x' || substr(md5(cast(event_id as varchar)), 1, 8))"
                    " as bigint) % 100 < 70 then 'train' else 'test' end as split from events",
    "token_index": "select doc_id, idx, count(*) as n from (select doc_id, unnest("
                   + _token_slots_sql("text", EMBED_DIM) + ") as idx from documents) group by all",
    "recon_error_fixed": "select vec_id, round(e" + _R + " as recon_error from (" + EMB_ERRORS_SQL + ")",
    "threshold": "select round(quantile_cont(e, 0.95)" + _R + " as threshold, count(*) as n from ("
                 + EMB_ERRORS_SQL + ")",
    "error_summary": "select count(*) as n, round(min(e)" + _R + " as min_error, round(max(e)" + _R
                     + " as max_error, round(avg(e)" + _R + " as mean_error, round(quantile_cont(e, 0.90)"
                     + _R + " as p90, round(quantile_cont(e, 0.95)" + _R + " as p95, "
                     "round(quantile_cont(e, 0.99)" + _R + " as p99 from (" + EMB_ERRORS_SQL + ")",
    "error_summary_by_label": "select label, count(*) as n, round(min(e)" + _R + " as min_error, "
                              "round(max(e)" + _R + " as max_error, round(avg(e)" + _R + " as mean_error, "
                              "round(quantile_cont(e, 0.90)" + _R + " as p90, round(quantile_cont(e, 0.95)" + _R
                              + " as p95, round(quantile_cont(e, 0.99)" + _R + " as p99 from ("
                              + EMB_ERRORS_SQL + ") group by label",
    "detect": "with s as (" + EMB_ERRORS_SQL + "), t as (select quantile_cont(e, 0.95) as thr from s) "
              "select vec_id, label, round(e" + _R + " as recon_error from s where e > (select thr from t)",
    "log_scores": "select event_id, round(e" + _R + " as recon_error from (" + LOG_ERRORS_SQL + ")",
    "detect_logs": "with s as (select * exclude (e), round(e, " + str(TIE_DIGITS) + ") as e from ("
                   + LOG_ERRORS_SQL + ")), t as (select quantile_cont(e, 0.95) as thr "
                   "from s) select event_id, LogLevel, Service, Message, TimeVal, round(e" + _R
                   + " as recon_error from s where e > (select thr from t)",
    "stream_detect": "with s as (select * exclude (e), round(e, " + str(TIE_DIGITS) + ") as e from ("
                     + LOG_ERRORS_SQL + ")), t as (select quantile_cont(e, 0.95) as thr "
                     "from s) select event_id, LogLevel, Service, Message, TimeVal, round(e" + _R
                     + " as recon_error from s where e > (select thr from t)",
    "stream_metrics": "with s as (select round(e, " + str(TIE_DIGITS) + ") as e from (" + LOG_ERRORS_SQL + ")), "
                      "t as (select quantile_cont(e, 0.95) as thr from s), "
                      "c as (select count(*)::double as n, (count(*) filter (where e > (select thr from t)))::double as a from s) "
                      "select 0::bigint as batch_id, unnest(['total_logs', 'anomalies_count', 'anomalies_ratio', "
                      "'duration_sec', 'detect_sec']) as metric_name, unnest([n, a, round(a / n" + _R + ", 1.0, 1.0]) "
                      "as metric_value from c",
    "stream_reload": "with s as (" + " union all ".join(
        f"select event_id, {part}::bigint as batch_id, round(e, {TIE_DIGITS}) as e from ("
        + LOG_ERRORS_SQL.replace("((d * 7) % 11 - 5) / 40.0", w) + f") where event_id % 2 = {part}"
        for part, w in enumerate(("((d * 7) % 11 - 5) / 40.0", "((d * 5) % 13 - 6) / 50.0"))) + "), "
        "t as (select batch_id, quantile_cont(e, 0.95) as thr from s group by batch_id) "
        "select event_id, batch_id, round(e" + _R + " as recon_error from s join t using (batch_id) where e > thr",
    "stream_logs": "select event_id, cast(event_id % 2 as bigint) as upload, strftime(\"Timestamp\", '%Y-%m-%d %H:%M:%S.%f') as ts, "
                   "LogLevel, Service, Message, TimeVal from (" + prepared_sql(EVENTS_AS_LOGS_SQL) + ")",
    "ae_sync": "select e::integer as epoch, count(*) as n, true as same from embeddings, range(1, 3) t(e) group by e",
    "pca_gram": "select i::integer as i, j::integer as j, count(*) as n, round(sum(embedding[i]::double), 6) as sum_i, "
                "round(sum(embedding[i]::double * embedding[j]::double), 6) as product "
                "from embeddings, range(1, 65) a(i), range(1, 65) b(j) where i <= j group by all",
    "csv_roundtrip": "select event_id, strftime(\"Timestamp\", '%Y-%m-%d %H:%M:%S.%f') as ts, LogLevel, Service,"
                     " Message, TimeVal from (" + prepared_sql(EVENTS_AS_LOGS_SQL) + ")",
    "batch_run": "with s as (select round(e, " + str(TIE_DIGITS) + ") as e from (" + LOG_ERRORS_SQL + ")), "
                 "t as (select quantile_cont(e, 0.95) as thr from s) "
                 "select 'total_logs' as metric_name, round(count(*)::double" + _R + " as metric_value from s "
                 "union all select 'anomalies_count', round((count(*) filter (where e > (select thr from t)))::double" + _R
                 + " from s",
    "consume_once": "select 'first' as run, 'ok' as status, count(*)::double as total_logs from events "
                    "union all select 'second', 'no_input', null::double",
    "row_ids": "select count(*) as n, count(*) as n_distinct, count(distinct event_id) as n_requests from events",
    "model_roundtrip": "with s as (" + EMB_ERRORS_SQL + "), t as (select quantile_cont(e, 0.95) as thr from s) "
                       "select vec_id, label, round(e" + _R + " as recon_error from s where e > (select thr from t)",
    "run_metrics": "with s as (" + EMB_ERRORS_SQL + "), t as (select quantile_cont(e, 0.95) as thr from s), "
                   "c as (select count(*)::double as total_logs, count(*) filter (where e > (select thr from t))::double "
                   "as anomalies_count from s) "
                   "select 'total_logs' as metric_name, round(total_logs" + _R + " as metric_value from c "
                   "union all select 'anomalies_count', round(anomalies_count" + _R + " from c "
                   "union all select 'anomalies_ratio', round(case when total_logs > 0 then "
                   "anomalies_count / total_logs else 0.0 end" + _R + " from c",
    "attach_scores": "with l as (select event_id as row_id, * exclude (event_id) from ("
                     + prepared_sql(DIRTY_LOGS_SQL) + ")), "
                     "s as (select row_id, cast(TimeVal as double) / 1000.0 as recon_error from l "
                     "where LogLevel is not null and Service is not null and Message is not null "
                     "and TimeVal is not null and not isnan(TimeVal)) "
                     "select row_id, LogLevel, Service, Message, TimeVal, round(recon_error" + _R
                     + " as recon_error from l join s using (row_id)",
    "dedupe": "select distinct lang, text from documents",
    "dedupe_by_text": "select lang, count(distinct text) as n_texts from documents group by lang",
    "topk": "select vec_id, label, round(e" + _R + " as recon_error from (" + EMB_ERRORS_SQL
            + ") order by e desc, vec_id limit 10",
    "latest_upload": "select fileName, uploadTime, filePath, event_id from (select *, row_number() over "
                     "(partition by fileName order by uploadTime desc, filePath desc) as rn from ("
                     + _UPLOAD_SQL + ")) where rn = 1",
    "catalogue_stream": "select fileName, uploadTime, filePath, "
                        "'uploads/' || regexp_extract(filePath, '([^/\\\\]*)$', 1) as object_key, "
                        "'uploads/' || uploadTime || '-' || fileName as landing_key "
                        "from (select *, row_number() over (partition by fileName order by uploadTime desc, "
                        "filePath desc) as rn from (" + _UPLOAD_SQL + ")) where rn = 1",
    "object_key": "select event_id, 'uploads/' || regexp_extract(filePath, '([^/\\\\]*)$', 1) as object_key"
                  " from (" + _UPLOAD_SQL + ")",
    "decode_event": "select event_id, case when event_type = 'error' then null else filePath end as filePath, "
                    "case when event_type = 'error' then null else fileName end as fileName, "
                    "case when event_type in ('error', 'signup') then null else uploadTime end as uploadTime, "
                    "event_type not in ('error', 'signup') as is_valid from (" + _UPLOAD_SQL + ")",
}

ORACLE_SQL["staged_run"] = ORACLE_SQL["detect_logs"]
ORACLE_SQL["attach_scores_bucketed"] = ORACLE_SQL["attach_scores"]
for _name in ("catalogue_state", "catalogue_batches"):  # the same catalogue, however it was kept
    ORACLE_SQL[_name] = ORACLE_SQL["catalogue_stream"]
