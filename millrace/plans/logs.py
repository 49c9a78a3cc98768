"""Log queries."""

from millrace.operators import logs
from millrace.plans.registry import query
from millrace.plans.shop import Shop

_PATTERN = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(query,
    '''[^'']*(''''[^'']*)*''', '?', 'g'), '--[^\\n]*|/\\*.*?\\*/', ' ', 'g'),
    '([=(,<>+*/-] *)[-+]([0-9])', '\\1\\2', 'g'),
    '\\b[0-9]+(\\.[0-9]+)?([eE][-+]?[0-9]+)?\\b', '?', 'g'), '\\(\\?( *, *\\?)*\\)', '(?)', 'g'), '\\s+', ' ', 'g'))"""
_STATISTICS = f"""select role, {_PATTERN} as pattern, count(*) as calls, cast(sum(duration_ms) as double) as total_ms,
    round(cast(sum(duration_ms) as double) / count(*), 3) as mean_ms from query_log group by 1, 2"""


@query(_STATISTICS)
def query_statistics(shop: Shop):
    return logs.query_statistics(shop.query_log)


@query(f"{_STATISTICS} order by mean_ms desc, role, pattern limit 20")
def query_patterns(shop: Shop):
    return logs.slowest_patterns(shop.query_log)


@query("""select cast(w.minutes as bigint) as minutes,
    time_bucket(interval '5 minutes', e.ts) + to_minutes(5 * s.step) as window_end,
    count(distinct e.user_id) as distinct_keys
    from raw_events e join (values (5), (15), (60)) w(minutes) on true
    join (select unnest(generate_series(1, 12)) as step) s on s.step * 5 <= w.minutes
    group by 1, 2""")
def working_set(shop: Shop):
    return logs.working_set(shop.raw_events, "user_id")


@query("""select operation, status, count(*) as operations,
    count(*) filter (where status = 'Error') as errors, cast(sum(duration_ms) as double) as total_ms,
    cast(max(duration_ms) as double) as longest_ms from operation_log group by operation, status""")
def operation_stats(shop: Shop):
    return logs.operation_stats(shop.operation_log)
