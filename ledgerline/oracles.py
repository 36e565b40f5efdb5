"""DuckDB SQL with the results each registered query must give. Used for checking only."""

from __future__ import annotations

_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyzıſ0123456789"
_TO = "X" * 54 + "9" * 10
_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_PATTERN = "(licen[cs]e|eau)[a-z]*"
_CODES = ("AUTOMOBILE", "HOUSEHOLD", "B", "NONE")


def _mask(text: str) -> str:
    return f"translate({text}, '{_FROM}', '{_TO}')"


def _collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'))"


_FEED = """
c as (select n_name src, c_mktsegment code, c_custkey k,
             row_number() over (partition by c_nationkey, c_mktsegment order by c_custkey) rn
      from customer join nation on n_nationkey = c_nationkey),
r as (
 select distinct src, code, cast(0 as bigint) o, concat('CH', rpad(code,12,' '), '20240102') line from c
 union all
 select src, code, cast(rn as bigint),
        concat('D10', cast(k%9+1 as string), '0101', lpad(cast(k as string),9,'0'), rpad('',6,' '),
               rpad(concat('  Holder   ', cast(k as string)),67,' '), rpad('',23,' '),
               rpad(concat('Joint ',code),68,' '), rpad('',23,' '), rpad('',68,' ')) from c
 union all
 select distinct src, code, cast(9223372036854775807 as bigint), concat('CT', rpad(code,12,' '), 'END') from c),
feed as (select src, cast(row_number() over (partition by src order by code, o) as bigint) line_no, line from r)
"""

_DELIMITED = """
delim as (select o_orderstatus src, o_orderkey line_no,
    concat(case when o_orderkey % 3 = 0 then 'H1' else 'D1' end, '|', o_orderkey, '|', o_custkey, '|',
           o_orderstatus, '||Acct-', o_custkey, '|', o_orderpriority, '|Clerk é#', o_orderkey % 1000, '|',
           strftime(o_orderdate, '%Y-%m-%d')) line
  from orders)
"""

_DOCS = r"""
d as (select cast(doc_id as varchar) src, doc_id, lang, string_split_regex(text, '\r\n|\n|\r') parts
      from documents),
d2 as (select src, doc_id, lang,
              case when parts[len(parts)] = '' then parts[1:len(parts) - 1] else parts end parts from d),
docs as (select src, doc_id, lang, cast(unnest(range(1, len(parts) + 1)) as bigint) line_no,
                unnest(parts) line from d2)
"""


def _files(breaks: str) -> str:
    """Files of ten documents each, some empty ones, and their lines."""
    return rf"""
f0 as (select doc_id // 10 k, coalesce(string_agg(text, chr(10) order by doc_id), '') body from documents group by 1),
f1 as (select concat(case when k % 2 = 1 then '_' else '' end, k, '.txt') src, body from f0
       union all select concat('.', k, '.txt'), '' from f0 where k % 4 = 0),
f2 as (select src, body, string_split_regex(body, '{breaks}') parts from f1),
f3 as (select src, body, case when parts[len(parts)] = '' then parts[1:len(parts) - 1] else parts end parts from f2),
flines as (select src, cast(unnest(range(1, len(parts) + 1)) as bigint) line_no, unnest(parts) line from f3)
"""


_FILES = _files(r"\r\n|\n|\r")
_WIDE_FILES = _files(r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]")
_MARK = "cast(concat('0x', substr(md5(concat(line_no, '|', line)), 1, 8)) as bigint)"


def _fixed(line: str, ranges) -> str:
    parts, at = [], 0
    for start, end in ranges:
        parts += [f"substr({line},{at + 1},{start - at})"] if start > at else []
        parts.append(_mask(f"substr({line},{start + 1},{end - start + 1})"))
        at = end + 1
    return "concat(" + ", ".join([*parts, f"substr({line},{at + 1})"]) + ")"


_FIXED = _fixed("line", [(7, 16)])
_FIELDS = (
    "case when starts_with(line, 'D1') then array_to_string(list_transform(string_split(line, '|'), "
    f"lambda x, i: case when i between 6 and 9 then {_mask('x')} else x end), '|') else line end"
)
_MIXED = f"with {_FEED}, {_DELIMITED}, mixed as (select * from feed union all select * from delim)"
_CHARS = "cast(length({0}) - length(regexp_replace({0}, '[A-Za-z0-9ıſ]', '', 'g')) as bigint)"
_FIXED_CHARS = _CHARS.format("substr(line, 8, 10)")
_FIELD_CHARS = (
    "case when starts_with(line, 'D1') then "
    + _CHARS.format("array_to_string(string_split(line, '|')[6:9], '')")
    + " else 0 end"
)

_HOLDER = f"""'vendor' account_provider_name, substr(line, 9, 9) account_number,
 {_collapse('substr(line, 24, 67)')} account_holder_1,
 {_collapse('substr(line, 114, 68)')} account_holder_2,
 {_collapse('substr(line, 205, 68)')} account_holder_other"""
_DETAIL = "regexp_matches(line, 'D10[2-9]0101')"


def _blocks(codes) -> str:
    """Bounds and inner lines of the blocks of some codes, found by pattern."""
    listed = ", ".join(f"('{c}')" for c in codes)
    return f"""
codes(code) as (values {listed}),
starts as (select src, code, min(line_no) start_line from feed, codes
           where regexp_matches(line, '^CH.*' || code) group by src, code),
bounds as (select s.src, s.code, s.start_line, min(f.line_no) end_line
           from starts s left join feed f on f.src = s.src and f.line_no > s.start_line
                                         and regexp_matches(f.line, '^CT.*' || s.code)
           group by s.src, s.code, s.start_line),
inside as (select f.src, b.code, f.line_no, f.line from feed f join bounds b
           on f.src = b.src and f.line_no > b.start_line and f.line_no < b.end_line),
records as (select src, code, line_no, {_HOLDER} from inside where {_DETAIL}),
export as (select src, code, cast(0 as bigint) line_no,
                  'account_provider_name|account_number|account_holder_1|account_holder_2|account_holder_other' line
           from bounds where end_line is not null
           union all
           select src, code, line_no, concat_ws('|', account_provider_name, account_number,
                  account_holder_1, account_holder_2, account_holder_other) from records)
"""


_ONE = f"with {_FEED}, {_blocks(['BUILDING'])}"
_MANY = f"with {_FEED}, {_blocks(_CODES)}"
_FIELD_BLOCKS = f"""with {_FEED},
marks as (select src, line_no, substr(line, 1, 2) kind, trim(substr(line, 3, 12)) code from feed
          where starts_with(line, 'CH') or starts_with(line, 'CT')),
starts as (select src, code, min(line_no) start_line from marks where kind = 'CH' group by src, code),
bounds as (select s.src, s.code, s.start_line, min(m.line_no) end_line from starts s
           join marks m on m.src = s.src and m.code = s.code and m.kind = 'CT'
                       and m.line_no > s.start_line group by s.src, s.code, s.start_line),
details as (select f.src, b.code, f.line_no, f.line from feed f join bounds b
            on f.src = b.src and f.line_no > b.start_line and f.line_no < b.end_line where {_DETAIL})
"""


def _sections(lines: str, head: int, tail: int) -> str:
    return f"""
n as (select src, count(*) n from {lines} group by src),
sections as (
 select l.src, l.line_no, l.line, 'header' section from {lines} l where l.line_no <= {head}
 union all
 select l.src, l.line_no, l.line, 'trailer' from {lines} l join n using (src) where l.line_no > n - {tail}
 union all
 select l.src, l.line_no, l.line, 'data' from {lines} l join n using (src)
 where l.line_no > {head} and l.line_no <= n - {tail})
"""


_MATCH = f"""regexp_extract(line, '{_PATTERN}', 0, 'i') v"""
_UTF16 = "cast(length({0}) + len(regexp_extract_all({0}, '[\\x{{10000}}-\\x{{10FFFF}}]')) as integer)"
_MATCH_COLUMNS = f"""v match_value,
 {_UTF16.format("substr(line, 1, strpos(line, v) - 1)")} match_index,
 {_UTF16.format("v")} match_length"""

_LONG_BLOCKS = """with n as (select n_name src, c_mktsegment seg, count(*) filter (where c_custkey % 9 > 0) n
    from customer join nation on n_nationkey = c_nationkey group by all),
c as (select src, seg, case when n = 0 then 'no_detail' else 'ok' end status, cast(n as bigint) records from n),
hit as (select c.src, c.seg, c.status, c.records, d.src nation from c join c d on c.seg = d.seg and starts_with(c.src, d.src))"""

_REPORT = """
days as (select cast(timestamp '2001-07-21' + i * interval 1 day as date) on_day from range(7) t(i)
         where isodow(timestamp '2001-07-21' + i * interval 1 day) < 6),
holders as (select n_name broker, r_name company, c_custkey holder
            from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
            where c_custkey in (select o_custkey from orders where o_orderdate >= (select min(on_day) from days))),
wanted as (select broker, company, on_day from (select distinct broker, company from holders) cross join days),
seen as (select w.*, exists (select 1 from holders h join orders on o_custkey = h.holder
           where h.broker = w.broker and h.company = w.company and o_orderdate = w.on_day) sent from wanted w)
"""

_EXCEPTIONS = f"""with {_REPORT} select 'server-1' ProcessServer, broker BrokerName, on_day BusinessDate,
 company CompanyName from seen where not sent order by 3, 2, 4"""

_MAP = """
m as (
 select cast(c_custkey as bigint) seq, c_custkey old_id, c_custkey+1 new_id from customer where c_custkey%10 in (0,1)
 union all select 1000000000000000-c_custkey, c_custkey, c_custkey+1 from customer where c_custkey%10 in (5,6)
 union all select 2000000000000000+c_custkey, c_custkey, c_custkey+2 from customer where c_custkey%10 in (0,3)
 union all select 3000000000000000+c_custkey, c_custkey, cast(null as bigint) from customer where c_custkey%100=8),
nx as (select a.seq, a.old_id, a.new_id, min(b.seq) nseq from m a left join m b
       on b.old_id = a.new_id and b.seq > a.seq group by a.seq, a.old_id, a.new_id),
chain as (
 select old_id, new_id, nseq from nx where seq in (select min(seq) from m group by old_id)
 union all
 select c.old_id, n.new_id, n.nseq from chain c join nx n on n.seq = c.nseq),
resolved as (select old_id, new_id final_id from chain where nseq is null),
daily as (select event_id, user_id guid,
       case when event_id%7=0 then 0.0 when event_id%11=0 then null else value end balance from events),
trades2 as (select o_orderkey, case when r.old_id is not null then r.final_id else o_custkey end guid, o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority, r.old_id is not null hit
       from orders left join resolved r on r.old_id = o_custkey),
daily2 as (select event_id, case when r.old_id is not null and balance <> 0 then r.final_id else guid end guid, balance,
       r.old_id is not null hit from daily left join resolved r on r.old_id = guid),
archive2 as (select l_orderkey, l_partkey, case when r.old_id is not null then r.final_id else l_suppkey end guid,
       l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
       r.old_id is not null hit from lineitem left join resolved r on r.old_id = l_suppkey),
holdings2 as (select c_custkey guid, c_name, c_nationkey, c_acctbal, c_mktsegment, r.old_id is not null hit
       from customer left join resolved r on r.old_id = c_custkey)
"""
_MERGE = f"with recursive {_MAP}"
_KEPT_DAILY = "from daily2 where not (hit and coalesce(balance = 0, false))"

SQL = {
    "lines_from_documents": f"with {_DOCS} select src, line_no, line from docs",
    "lines_from_files": f"with {_FEED} select src, line from feed",
    "lines_back_slash_path": f"with {_FEED} select src, line from feed",
    "lines_numbered": f"with {_FEED} select src, line_no, line from feed",
    "lines_numbered_per_file": f"""with {_FEED} select src, cast(count(*) as bigint) "lines", true sound
        from feed group by src""",
    "file_sizes": f"""with {_FEED} select src, cast(sum(strlen(line) + 1) as bigint) "bytes"
        from feed group by src""",
    "zip_entry_list": """select concat('docs-', doc_id // 250, '.zip') archive,
        concat(lang, '/', doc_id, '.txt') entry, cast(strlen(text) as bigint) "bytes" from documents""",
    "zip_line_list": f"""with {_DOCS} select concat('docs-', doc_id // 250, '.zip') archive,
        concat(lang, '/', doc_id, '.txt') entry, line_no, line from docs""",
    "recent_business_dates": """with a as (select distinct cast(o_orderdate as date) as_of from orders),
        b as (select as_of, unnest(range(1, 8)) n from a)
        select as_of, as_of - cast(n as integer) business_date from b
        where isodow(as_of - cast(n as integer)) < 6""",
    "recent_business_dates_exact": """with a as (select distinct cast(o_orderdate as date) as_of from orders),
        b as (select as_of, unnest(range(1, 8)) n from a),
        w as (select as_of, as_of - cast(n as integer) business_date from b
              where isodow(as_of - cast(n as integer)) < 6)
        select as_of, business_date from w
        qualify row_number() over (partition by as_of order by business_date desc) <= 3""",
    "mask_fixed": f"with {_FEED} select src, line_no, {_FIXED} line from feed",
    "mask_fixed_wide": f"""with {_DOCS} select src, line_no,
        {_fixed('line', [(0, 9), (40, 59)])} line from docs""",
    "mask_delimited": f"with {_DELIMITED} select src, line_no, {_FIELDS} line from delim",
    "mask_by_layout": f"""{_MIXED} select src, line_no,
        case when src in ('F', 'O', 'P') then {_FIELDS} else {_FIXED} end line from mixed""",
    "mask_audit": f"""{_MIXED}, n as (select src, case when src in ('F', 'O', 'P') then {_FIELD_CHARS}
          else {_FIXED_CHARS} end chars from mixed)
        select src, cast(count(*) as bigint) "rows", cast(count(*) filter (where chars > 0) as bigint) rows_masked,
        cast(sum(chars) as bigint) chars_masked from n group by src""",
    "mask_round_trip": f"with {_FEED} select src, line_no, {_FIXED} line from feed",
    "mask_files_in_place": f"with {_FEED} select src, {_FIXED} line from feed",
    "mask_streamed": f"with {_FEED} select src, line_no, {_FIXED} line from feed",
    "whitespace_collapsed": f"""select page_id, {_collapse('html')} "text" from pages""",
    "filter_detail_records": f"with {_FEED} select src, line_no, line from feed where {_DETAIL}",
    "parse_holder_records": f"with {_FEED} select src, line_no, {_HOLDER} from feed where {_DETAIL}",
    "customer_block_bounds": f"{_ONE} select src, code, start_line, end_line from bounds",
    "customer_block": f"{_ONE} select src, code, line_no, line from inside",
    "extract_customer": f"{_ONE} select * from records",
    "customer_export_lines": f"{_ONE} select * from export",
    "customer_export_files": f"""{_MANY} select src, code,
        cast(row_number() over (partition by src, code order by line_no) as bigint) line_no, line from export""",
    "customers_multi": f"{_MANY} select * from records",
    "customers_status": f"""{_MANY}, srcs as (select distinct src from feed),
        n as (select src, code, count(*) n from records group by src, code)
        select srcs.src, codes.code, case when start_line is null then 'header_missing'
          when end_line is null then 'trailer_missing' when n is null then 'no_detail' else 'ok' end status,
          cast(coalesce(n, 0) as bigint) records
        from srcs cross join codes left join bounds b on b.src = srcs.src and b.code = codes.code
        left join n on n.src = srcs.src and n.code = codes.code""",
    "customers_by_field": f"{_FIELD_BLOCKS} select src, code, line_no, {_HOLDER} from details",
    "customers_by_table": f"""{_FIELD_BLOCKS}, n as (select src, code, count(*) n from details group by src, code)
        select b.src, b.code, case when n is null then 'no_detail' else 'ok' end status,
          cast(coalesce(n, 0) as bigint) records
        from bounds b left join n on n.src = b.src and n.code = b.code
        where b.code in (select c_mktsegment from customer group by c_mktsegment having max(c_custkey) % 2 = 0)""",
    "customers_long_codes": """with c as (select n_name src, concat('SEGMENT-NAMED-', c_mktsegment, '-', n_name) code,
          count(*) filter (where c_custkey % 9 > 0) n from customer join nation on n_nationkey = c_nationkey
          group by all)
        select src, code, case when n = 0 then 'no_detail' else 'ok' end status, cast(n as bigint) records from c""",
    "split_sections_negative": f"with {_FEED}, {_sections('feed', 2, 1)} select * from sections",
    "empty_sources": f"""with {_FILES} select src, cast(strlen(body) as bigint) "bytes", cast(len(parts) as bigint) "lines",
          cast(least(len(parts), 1) as bigint) header, cast(greatest(len(parts) - 2, 0) as bigint) "data",
          cast(least(len(parts), 1) as bigint) trailer from f3""",
    "masked_copies_named": f"""with {_FILES}, m as (select src, line_no, {_FIXED} line from flines),
        s as (select src, count(*) n, sum(strlen(line)) b, sum({_MARK}) marks from m group by src)
        select concat('m_', src) src, cast(coalesce(b + n - case when body[-1] in (chr(10), chr(13)) then 0 else 1 end, 0)
          as bigint) "bytes", cast(coalesce(n, 0) as bigint) "lines", cast(coalesce(marks, 0) as bigint) marks
        from f3 left join s using (src)""",
    "section_files_named": f"""with {_FILES}, {_sections('flines', 2, 1)},
        every as (select src, unnest(['header', 'data', 'trailer']) section from f3),
        p as (select src, section, list(line order by line_no) parts from sections group by all),
        q as (select src, section, parts, case when parts[len(parts)] = '' then parts[1:len(parts) - 1] else parts end kept from p),
        l as (select src, section, cast(unnest(range(1, len(kept) + 1)) as bigint) line_no, unnest(kept) line from q),
        s as (select src, section, count(*) n, sum({_MARK}) marks from l group by all)
        select concat(src, '.', section, '.txt') src, cast(coalesce(strlen(array_to_string(parts, chr(10))), 0) as bigint) "bytes",
          cast(coalesce(n, 0) as bigint) "lines", cast(coalesce(marks, 0) as bigint) marks
        from every left join q using (src, section) left join s using (src, section)""",
    "lines_wide_encoding": f"with {_FEED} select concat(src, '.txt') src, line_no, line from feed",
    "lines_unicode_breaks": f"with {_WIDE_FILES} select src, line_no, line from flines",
    "customers_by_pattern": f"""{_LONG_BLOCKS} select src, code, status, records from hit, unnest([
          concat(substr(seg, 1, 5), '.*-', nation), concat('(', seg, ')-', nation)]) as u(code)""",
    "customers_by_plain_text": f"{_LONG_BLOCKS} select src, concat(seg, '-', nation) code, status, records from hit",
    "mask_by_layout_table": f"""{_MIXED} select src, line_no,
        case when src in ('F', 'O', 'P') then {_FIELDS} else {_FIXED} end line from mixed""",
    "split_sections": f"with {_FEED}, {_sections('feed', 2, 1)} select * from sections",
    "split_document_sections": f"with {_DOCS}, {_sections('docs', 3, 2)} select * from sections",
    "section_counts": f"""with {_DOCS} select src, cast(count(*) as bigint) "lines",
        cast(least(count(*), 3) as bigint) header, cast(greatest(count(*) - 5, 0) as bigint) "data",
        cast(least(count(*), 2) as bigint) trailer from docs group by src""",
    "section_files_in_place": f"""with {_FEED}, files as (select concat(src, '/', line_no // 1048576) src,
          row_number() over (partition by src, line_no // 1048576 order by line_no) line_no, line from feed),
        {_sections('files', 2, 1)} select src, section,
        cast(row_number() over (partition by src, section order by line_no) as bigint) line_no, line from sections""",
    "section_files": f"""with {_FEED}, {_sections('feed', 2, 1)} select src, section,
        cast(row_number() over (partition by src, section order by line_no) as bigint) line_no, line from sections""",
    "search_lines": f"""with {_DOCS}, hits as (select src, line_no, line, {_MATCH} from docs
          where regexp_matches(line, '{_PATTERN}', 'i'))
        select src, line_no line_number, {_MATCH_COLUMNS} from hits""",
    "search_files": f"""with {_FEED} select src, regexp_extract(line, 'D10[57]0101', 0) match_value,
          cast(strpos(line, regexp_extract(line, 'D10[57]0101', 0)) - 1 as integer) match_index,
          8 match_length, line_no line_number from feed where regexp_matches(line, 'D10[57]0101')""",
    "search_zip": f"""with {_DOCS}, hits as (select doc_id, lang, line_no, line, {_MATCH} from docs
          where regexp_matches(line, '{_PATTERN}', 'i'))
        select concat(lang, '\\', doc_id, '.txt') filename, concat('docs-', doc_id // 250, '.zip\\', lang) "path",
        line_no line_number, {_MATCH_COLUMNS} from hits""",
    "active_broker_accounts": f"""with {_REPORT} select broker brokerage, company customer, holder accountguid
        from holders""",
    "expected_deliveries": f"with {_REPORT} select broker brokerage, company customer, on_day business_date from wanted",
    "processed_deliveries": f"""with {_REPORT} select broker brokerage, company customer, on_day business_date
        from seen where sent""",
    "unprocessed_deliveries": f"""with {_REPORT} select broker brokerage, company customer, on_day business_date
        from seen where not sent""",
    "exceptions_report": _EXCEPTIONS,
    "exceptions_report_text_ids": _EXCEPTIONS,
    "id_map_resolved": f"{_MERGE} select old_id, final_id from resolved",
    "merge_trades": f"{_MERGE} select * exclude (hit) from trades2",
    "merge_daily_process": f"{_MERGE} select * exclude (hit) {_KEPT_DAILY}",
    "merge_archive": f"{_MERGE} select * exclude (hit) from archive2",
    "merge_holdings": f"{_MERGE} select * exclude (hit) from holdings2 where not hit",
    "merge_audit": f"""{_MERGE}, e as (select cast(count(*) as bigint) map_entries from m),
        t as (
          select 'trades' table_name, hit upd, false del from trades2
          union all select 'daily_process', hit and coalesce(balance <> 0, false),
                           hit and coalesce(balance = 0, false) from daily2
          union all select 'archive', hit, false from archive2
          union all select 'holdings', false, hit from holdings2)
        select table_name, map_entries, cast(count(*) as bigint) rows_in,
          cast(count(*) filter (where upd) as bigint) updated, cast(count(*) filter (where del) as bigint) deleted,
          cast(count(*) filter (where not del) as bigint) rows_out
        from t, e group by table_name, map_entries""",
    "merge_literal_map": """select o_orderkey, case when o_custkey in (1, 2) then 3 when o_custkey = 4 then 1
          when o_custkey = 5 then null else o_custkey end guid from orders""",
    "merge_text_ids": f"""{_MERGE}, t as (
          select 'trades' table_name, guid from trades2
          union all select 'daily', guid {_KEPT_DAILY}
          union all select 'archive', guid from archive2
          union all select 'holdings', guid from holdings2 where not hit)
        select table_name, cast(count(*) as bigint) "rows", cast(count(distinct guid) as bigint) "keys",
          cast(sum(guid) as bigint) key_sum from t group by table_name""",
    "merge_committed": f"""{_MERGE}, t as (
          select 'trades' table_name, guid from trades2
          union all select 'daily', guid {_KEPT_DAILY}
          union all select 'archive', guid from archive2
          union all select 'holdings', guid from holdings2 where not hit)
        select table_name, cast(count(*) as bigint) "rows", cast(sum(guid) as bigint) key_sum,
          cast(count(*) - count(guid) as bigint) null_keys from t group by table_name""",
}
