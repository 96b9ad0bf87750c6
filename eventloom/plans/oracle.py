"""The catalogue's queries in SQL for the correctness check."""

from __future__ import annotations

from eventloom.plans.catalog import KEYWORDS

_LINES = r"select unnest(string_split_regex(text, '\r\n|\r|\n')) as value"

_WORDS = r"""
    select {columns}, unnest(
        case when cut = '' and text <> '' then cast([] as varchar[])
             else string_split_regex(cut, '[ \t\n\x0B\f\r]') end) as word
    from (select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as cut
          from documents)
"""

_CTYPES = """
    select unnest([l_returnflag, cast(l_linenumber as varchar), '']) as ctype,
           l_shipdate as ts
    from lineitem
"""

_NAV = """
    select event_id, user_id, ts, 'P' || user_id as key,
           strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp
    from events where event_type = 'view'
"""

_PAGE = """
    select event_id, user_id, ts, 'P' || user_id as key,
           strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp, card
    from events, (values (1), (2)) cards(card) where event_type = 'click'
"""

_PAGE_BODY = """
    case when card = 1
         then '"source":{"event":' || p.event_id || '},"title":"first"'
         else '"title":"second"' end || ',"pageId":"' || p.key || '"}'
"""

_PAGE_JOIN = f"""
    select '{{"navSource":"view","navTitle":"nav ' || n.event_id || '","navPageId":"' || n.key
           || '",' || {_PAGE_BODY} as value
    from ({_NAV}) n join ({_PAGE}) p
      on n.key = p.key and date_trunc('day', n.ts) = date_trunc('day', p.ts)
"""

_KEYWORD_LIST = ", ".join(f"'{word}'" for word in KEYWORDS)

ORACLE: dict[str, str] = {
    "text_scan": f"{_LINES} from documents",
    "folder_scan": f"select value, true as from_text_file from ({_LINES} from documents)",
    "line_stream": f"{_LINES} from documents",
    "line_passthrough": f"{_LINES} from conversations",
    "keyword_sequence": f"""
        select 1 as one, ([{_KEYWORD_LIST}])[cast(o_orderkey % {len(KEYWORDS)} as int) + 1] as keyword,
               o_orderkey as n
        from orders""",
    "delimited_parse": """
        select l_orderkey, l_partkey, l_returnflag, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_linestatus
        from lineitem""",
    "sql_group_count": """
        select o_custkey, count(o_orderdate) as num from orders group by o_custkey
        order by num desc, o_custkey""",
    "sql_topk": """
        select 'player-' || o_custkey as player, count(o_orderdate) as num
        from orders group by player order by num desc, player limit 3""",
    "json_parse": """
        select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""",
    "json_quarantine": """
        select event_id, value from (
            select event_id, case when event_type = 'error'
                                  then substr(props, 1, length(props) - 1) else props end as value
            from events)
        where not json_valid(value)""",
    "json_nested_explode": f"""
        select ctype, count(*) as n from ({_CTYPES}) group by ctype""",
    "filter_nonempty": f"""
        select ctype, count(*) as n from ({_CTYPES}) where ctype <> '' group by ctype""",
    "content_totals": f"""
        select date_trunc('day', ts) as window_start, ctype, max(running) as total from (
            select ts, ctype, count(*) over (
                partition by ctype order by ts
                range between unbounded preceding and current row) as running
            from ({_CTYPES}) where ctype <> '')
        group by window_start, ctype""",
    "content_running": """
        select l_orderkey || '-' || l_linenumber as id, ctype, count(*) over (
            partition by ctype order by l_orderkey, l_linenumber, l_returnflag
            rows between unbounded preceding and current row) as total
        from (select l_orderkey, l_linenumber, l_returnflag,
                     unnest([l_returnflag, cast(l_linenumber as varchar)]) as ctype from lineitem)""",
    "running_maximum": """
        select event_id, event_type, max(value) over (
            partition by event_type order by ts, event_id
            rows between unbounded preceding and current row) as highest
        from events""",
    "last_known": """
        select event_id, user_id,
               last_value(case when event_type = 'click' then event_id end ignore nulls) over (
                   partition by user_id order by ts, event_id
                   rows between unbounded preceding and current row) as last_click
        from events""",
    "running_total_signed": """
        select date_trunc('hour', ts) as window_start, event_type,
               cast(max(running) as bigint) as total from (
            select ts, event_type, sum(user_id % 7 - 3) over (
                partition by event_type order by ts, event_id
                rows between unbounded preceding and current row) as running
            from events)
        group by window_start, event_type""",
    "tokenize": f"select doc_id, word, 1 as n from ({_WORDS.format(columns='doc_id')})",
    "windowed_word_count": f"""
        select time_bucket(interval 5 seconds, timestamp '2024-01-01' + to_seconds(doc_id))
                   as window_start,
               word, count(*) as total
        from ({_WORDS.format(columns='doc_id')}) group by window_start, word""",
    "running_reduce": """
        select event_id, event_type, count(*) over (
            partition by event_type order by ts, event_id
            rows between unbounded preceding and current row) as total
        from events""",
    "window_max_by": """
        select window_start, event_type, value, ts, event_id from (
            select *, date_trunc('hour', ts) as window_start, row_number() over (
                partition by date_trunc('hour', ts), event_type
                order by value desc, ts, event_id) as place
            from events)
        where place = 1""",
    "running_total_per_window": """
        select date_trunc('hour', ts) as window_start, event_type, max(running) as total from (
            select ts, event_type, count(*) over (
                partition by event_type order by ts, event_id
                rows between unbounded preceding and current row) as running
            from events)
        group by window_start, event_type""",
    "cumulative_window_count": """
        select date_trunc('hour', ts) as window_start, '(' || event_type || ')' as label,
               max(running) as total
        from (
            select ts, event_type, count(*) over (
                partition by event_type order by ts, event_id
                rows between unbounded preceding and current row) as running
            from events)
        group by window_start, event_type""",
    "seeded_window_count": """
        select window_start, c.user_id, n,
               cast(sum(n) over (partition by c.user_id order by window_start)
                    + coalesce(seed, 0) as bigint) as total
        from (select date_trunc('day', ts) as window_start, user_id, count(*) as n
              from events group by window_start, user_id) c
        left join (select o_custkey, count(*) as seed from orders group by o_custkey) s
               on s.o_custkey = c.user_id""",
    "split_route": """
        select event_id, case event_type when 'view' then 'NAV' when 'click' then 'PAGE'
                                         else 'NULL_TYPE' end as route
        from events""",
    "nav_cards": f"""
        select key, key as id, 'view' as source, 'nav ' || event_id as title, stamp as fileTime,
               stamp as contentsTime, 'site/NAV.json' as fileContents
        from ({_NAV})""",
    "page_cards": f"""
        select key, case when card = 1 then 'c' || event_id else '' || event_id end as id,
               case when card = 1 then '{{"event":' || event_id || '}}' end as source,
               case when card = 1 then 'first' else 'second' end as title, stamp as fileTime,
               stamp as contentsTime, 'pages/' || key || '.json' as fileContents
        from ({_PAGE})""",
    "json_project": f"select '{{' || {_PAGE_BODY} as value from ({_PAGE}) p",
    "page_join": _PAGE_JOIN,
    "page_join_stream": _PAGE_JOIN,
    "page_cogroup": f"""
        select window_start, key, coalesce(n_left, 0) as n_left, coalesce(n_right, 0) as n_right,
               'yes' as marker
        from (select date_trunc('day', ts) as window_start, key, count(*) as n_left
              from ({_NAV}) group by window_start, key)
        full join (select date_trunc('day', ts) as window_start, key, count(*) as n_right
                   from ({_PAGE}) group by window_start, key)
            using (window_start, key)""",
    "window_join": """
        select date_trunc('day', v.ts) as window_start, v.user_id, v.event_id as view_id,
               c.event_id as click_id
        from events v join events c
          on v.user_id = c.user_id and date_trunc('day', v.ts) = date_trunc('day', c.ts)
        where v.event_type = 'view' and c.event_type = 'click'""",
    "window_cogroup": """
        select window_start, user_id, coalesce(n_left, 0) as n_left,
               coalesce(n_right, 0) as n_right, 'yes' as marker, max_left, max_right
        from (select date_trunc('day', ts) as window_start, user_id, count(*) as n_left,
                     max(value) as max_left
              from events where event_type = 'view' group by window_start, user_id)
        full join (select date_trunc('day', ts) as window_start, user_id, count(*) as n_right,
                          max(value) as max_right
                   from events where event_type = 'click' group by window_start, user_id)
            using (window_start, user_id)""",
    "delimiter_segments": """
        with marked as (
            select *, event_type = 'error' as mark,
                   coalesce(sum(case when event_type = 'error' then 1 else 0 end) over (
                       partition by user_id order by ts, event_id
                       rows between unbounded preceding and 1 preceding), 0) as segment,
                   sum(case when event_type = 'error' then 1 else 0 end) over (
                       partition by user_id) as marks
            from events)
        select user_id, cast(segment as bigint) as segment, cast(count(*) as int) as n,
               string_agg(cast(event_id as varchar), ' ' order by ts, event_id) || ' ' as items
        from marked where not mark and segment < marks
        group by user_id, segment""",
    "lookup_enrich": """
        select d.doc_id, lang, source, quality, toxic
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "lookup_hit_rate": """
        select count(*) as calls, count(l.doc_id) as hits
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "lookup_backfill": """
        select c_custkey as custkey, c_acctbal, c_mktsegment from customer
        where c_mktsegment = 'BUILDING' or c_custkey in (select o_custkey from orders)""",
    "dirty_upsert": """
        select key, value from (
            select *, row_number() over (partition by key order by seq desc) as place from (
                select c_custkey as key, c_acctbal as value, -1 as seq from customer
                union all
                select user_id, value, event_id from events where value > 50))
        where place = 1""",
    "dirty_write_back": """
        select key, value from (
            select *, row_number() over (partition by key order by seq desc) as place from (
                select c_custkey as key, c_acctbal as value, -1 as seq from customer
                union all
                select user_id, value, event_id from events where value > 50))
        where place = 1""",
    "dropped_records": """
        select unnest(['lines', 'bad_lines', 'records_without_route', 'pages_without_key',
                       'nav_cards_without_id', 'page_cards_without_page', 'cards_without_time']) as what,
               unnest([count(*), count(*) filter (event_type not in ('view', 'click', 'signup', 'purchase')),
                       count(*) filter (event_type in ('signup', 'purchase')), 0,
                       count(*) filter (event_type = 'view'), 0, 0]) as n
        from events""",
    "recent_keys_topn": """
        select user_id, max(event_id) as last_seq from events group by user_id
        order by last_seq desc, user_id limit 20""",
}
