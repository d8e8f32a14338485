"""DuckDB SQL for every batch query in ``catalog`` (and the streams, whose final
result table equals the batch result).  Tables ``events`` and ``documents``
are views over the same parquet files.  Sums are cast to BIGINT (DuckDB gives
HUGEINT); window-based changelogs use ``row_number`` / ``lag`` directly.
"""

from __future__ import annotations

# Input views as CTE texts (the stand-ins of keytally.sources.topics).
F_VIEW = r"""
F as (select event_id, split_part(line, ',', 1) as key, split_part(line, ',', 2) as colour
      from (select event_id, concat(translate(cast(user_id as varchar), '0123456789', 'abcdefghij'),
                                    ',', event_type) as line from events)
      where regexp_full_match(line, '[a-z]*,(click|view)'))"""

TX_VIEW = r"""
TX as (select event_id, cast(user_id as varchar) as name,
              cast(json_extract_string(props, '$.k') as bigint) as amount, ts as time from events)"""

TK_VIEW = r"""
l as (select doc_id, lower(text) s, regexp_replace(lower(text), '\W+$', '') t
      from documents where text is not null),
k as (select doc_id, case when s = '' then [''] when t = '' then []
                          else regexp_split_to_array(t, '\W+') end as ws from l),
TK as (select doc_id, unnest(generate_series(0, len(ws) - 1)) as pos, unnest(ws) as word from k)"""

ISO_TIME = r"""case when date_part('microseconds', {t}) % 1000000 = 0 then strftime({t}, '%Y-%m-%dT%H:%M:%SZ')
     when date_part('microseconds', {t}) % 1000 = 0 then strftime({t}, '%Y-%m-%dT%H:%M:%S.%gZ')
     else strftime({t}, '%Y-%m-%dT%H:%M:%S.%fZ') end"""

TXR_VIEW = r"""
TXR as (select event_id, cast(user_id as varchar) as key,
               to_json({'name': cast(user_id as varchar),
                        'amount': cast(json_extract_string(props, '$.k') as bigint),
                        'time': """ + ISO_TIME.format(t="ts") + r"""})::varchar as value
        from events)"""

SUMMARY = r"""
S as (select name, count(*) as count, cast(sum(amount) as bigint) as balance,
             greatest(timestamp '1970-01-01', max(date_trunc('milliseconds', time))) as time
      from TX group by name)"""

CURRENT = r"""
C as (select s.colour, count(l.key) as count
      from (select distinct colour from F) s
      left join (select key, arg_max(colour, event_id) as colour from F group by key) l using (colour)
      group by s.colour)"""

ORACLE_SQL: dict[str, str] = {
    "word_count": r"""
with l as (select lower(text) s, regexp_replace(lower(text), '\W+$', '') t
           from documents where text is not null),
     w as (select unnest(case when s = '' then [''] when t = '' then []
                              else regexp_split_to_array(t, '\W+') end) as word from l)
select word, count(*) as count from w group by word""",

    "line_tokens": "with " + TK_VIEW + "\nselect doc_id, pos, word from TK",

    "running_word_count": "with " + TK_VIEW + r"""
select doc_id, pos, word,
       count(*) over (partition by word order by doc_id, pos rows unbounded preceding) as count from TK""",

    "word_count_records": r"""
with l as (select lower(text) s, regexp_replace(lower(text), '\W+$', '') t
           from documents where text is not null),
     w as (select unnest(case when s = '' then [''] when t = '' then []
                              else regexp_split_to_array(t, '\W+') end) as word from l)
select word as key, lpad(upper(to_hex(count(*))), 16, '0') as value from w group by word""",

    "pair_filter_rekey": "with " + F_VIEW + "\nselect event_id, key, colour from F",

    "latest_by_key": "with " + F_VIEW + "\nselect key, arg_max(colour, event_id) as colour from F group by key",

    "latest_with_deletes": r"""
with e as (select event_id, cast(user_id as varchar) as key,
                  case when event_type <> 'error' then event_type end as value from events),
     r as (select *, row_number() over (partition by key order by event_id desc) rn from e)
select key, value from r where rn = 1 and value is not null""",

    "current_value_count": "with " + F_VIEW + "," + CURRENT + "\nselect colour, count from C",

    "current_value_changelog": "with " + F_VIEW + r""",
p as (select *, lag(colour) over (partition by key order by event_id) as old from F),
d as (select event_id, 0 as step, old as colour, -1 as delta from p where old is not null
      union all select event_id, 1, colour, 1 from p)
select event_id, step, colour,
       cast(sum(delta) over (partition by colour order by event_id, step
                             rows unbounded preceding) as bigint) as count from d""",

    "changelog_with_deletes": r"""
with e as (select event_id, cast(user_id as varchar) as key,
                  case when event_type <> 'error' then event_type end as value from events),
p as (select *, lag(value) over (partition by key order by event_id) as old from e where key is not null),
d as (select event_id, 0 as step, old as value, -1 as delta from p where old is not null
      union all select event_id, 1, value, 1 from p where value is not null)
select event_id, step, value,
       cast(sum(delta) over (partition by value order by event_id, step
                             rows unbounded preceding) as bigint) as count from d""",

    "colour_count_records": "with " + F_VIEW + "," + CURRENT + r"""
select colour as key, lpad(upper(to_hex(count)), 16, '0') as value from C""",

    "transaction_records": "with " + TXR_VIEW + "\nselect event_id, key, value from TXR",

    "bad_transactions": "with " + TXR_VIEW + r""",
x as (select event_id, case when event_id % 20 <> 1 then key end as key,
             case event_id % 20 when 2 then null when 3 then 'junk'
               when 5 then regexp_replace(value, '"amount":(\d+)', '"amount":"\1"')
               when 7 then regexp_replace(value, '"amount":(\d+),', '')
               when 11 then regexp_replace(value, '"time":"(.{10}).*"', '"time":"\1"')
               when 13 then regexp_replace(value, ',"time":".*"', '')
               when 17 then regexp_replace(value, '"time":".{10}', '"time":"2024-02-30')
               else value end as value from TXR),
j as (select *, case when json_valid(value) then value end as js from x),
p as (select event_id, key, value, js, json_type(js, '$.amount') as amount_type,
             json_extract_string(js, '$.time') as tt from j),
r as (select *, case when key is null then 'null key'
                     when value is null then 'null value'
                     when js is null or json_type(js) <> 'OBJECT' then 'not a JSON object'
                     when amount_type is null or amount_type not in ('BIGINT', 'UBIGINT') then 'amount missing or not an integer'
                     when tt is null then 'time missing'
                     when not regexp_full_match(tt, '\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?(Z|[+-]\d\d:\d\d)')
                          then 'time not an ISO-8601 instant'
                     when try_cast(tt as timestamptz) is null then 'time not a valid instant'
                end as reason from p)
select event_id, key, value, reason from r where reason is not null""",

    "account_balance": "with " + TX_VIEW + "\nselect name, cast(sum(amount) as bigint) as balance from TX group by name",

    "account_summary": "with " + TX_VIEW + "," + SUMMARY + "\nselect name, count, balance, time from S",

    "running_balance": "with " + TX_VIEW + r"""
select event_id, name,
       cast(sum(amount) over (partition by name order by event_id rows unbounded preceding) as bigint) as balance
from TX""",

    "running_summary": "with " + TX_VIEW + r"""
select event_id, name, count(*) over w as count, cast(sum(amount) over w as bigint) as balance,
       greatest(timestamp '1970-01-01', max(date_trunc('milliseconds', time)) over w) as time
from TX window w as (partition by name order by event_id rows unbounded preceding)""",

    "count_records": "with " + TX_VIEW + r"""
select name as key, lpad(upper(to_hex(cast(sum(amount) as bigint))), 16, '0') as value
from TX group by name""",

    "summary_records": "with " + TX_VIEW + "," + SUMMARY + r"""
select name as key,
       to_json({'count': count, 'balance': balance, 'time': """ + ISO_TIME.format(t="time") + r"""})::varchar as value
from S""",
}
