"""What each query must return, as SQL for DuckDB over the given tables."""

from __future__ import annotations

from washline.catalog.dirty import DIRTY_SQL

# White space at either end, as the 29 characters that count as such.
EDGE = r"[\s\x{000B}\x{001c}-\x{001f}\x{0085}\p{Z}]+"
TRIM = rf"'^{EDGE}|{EDGE}$', '', 'g'"

# Numbers as text: whole, decimal.
WHOLE = r"'^\s*[+-]?[0-9]+\s*$'"
DECIMAL = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"

# A page as a file.
PAGE_FILE = "page_id::varchar || '.html' as name, strlen(coalesce(html, '')) as length"


def _money(column: str) -> str:
    return f"""round_even(replace(replace("{column}", '$', ''), ',', '')::double * 100, 0) / 100"""


def _cleaned(missing: str) -> str:
    """Cleaned store transactions; `missing` is the SQL value for missing names."""

    def name(column: str, kept: str) -> str:
        stripped = f"""regexp_replace("{column}", '[^{kept}]', '', 'g')"""
        return f"""coalesce(trim({stripped}), {missing}) as "{column}" """

    return f"""
        select l_orderkey, l_linenumber,
               {name("STORE_ID", "a-zA-Z0-9")},
               {name("STORE_LOCATION", "a-zA-Z0-9 ")},
               {name("PRODUCT_CATEGORY", "a-zA-Z0-9 ")},
               try_cast(regexp_replace("PRODUCT_ID", '[^0-9]', '', 'g') as bigint) as "PRODUCT_ID",
               {", ".join(f'{_money(c)} as "{c}"' for c in ("MRP", "CP", "DISCOUNT", "SP"))},
               strptime(trim("Date"), '%Y-%m-%d') as "Date"
        from ({DIRTY_SQL})
    """


def _profile(source: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        whole = f"regexp_matches({c}, {WHOLE}) and try_cast({c} as bigint) is not null"
        decimal = (
            f"not regexp_matches({c}, {WHOLE}) and regexp_matches({c}, {DECIMAL})"
            f" and isfinite(try_cast({c} as double))"
        )
        return f"""
            select '{c}' as "column", count({c}) as n,
                   (count(*) filter ({whole}))::bigint as n_int,
                   (count(*) filter (({whole}) or ({decimal})))::bigint as n_float,
                   (count(*) filter ({c} in ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')))
                       ::bigint as n_bool
            from source
        """

    return f"""
        with source as ({source}),
             counts as ({" union all ".join(one(c) for c in columns)})
        select *, case when n = 0 then 'double' when n_int = n then 'bigint'
                       when n_float = n then 'double' when n_bool = n then 'boolean'
                       else 'string' end as inferred
        from counts
    """


LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus l_shipdate"
).split()

TIMED_EVENTS = "select event_id, case when event_type <> 'error' then ts end as ts from events"

ROUTED = f"""
    select event_id, ts,
           case hour(ts) % 2 when 0 then 'even_hour' when 1 then 'odd_hour'
                             else 'none_hour' end as branch
    from ({TIMED_EVENTS})
"""


LINE_PROFILE = _profile(f"select {', '.join(f'{c}::varchar as {c}' for c in LINEITEM)} from lineitem", LINEITEM)


def oracle_sql() -> dict[str, str]:
    return {
        "clean_store_transactions": _cleaned("'nan'"),
        "clean_store_transactions_keep_nulls": _cleaned("null"),
        "strip_specials": """
            select o_orderkey, regexp_replace(o_orderpriority, '[^a-zA-Z0-9]', '', 'g') as packed,
                   regexp_replace(o_orderpriority, '[^a-zA-Z0-9 ]', '', 'g') as spaced
            from orders
        """,
        "strip_specials_text": """
            select doc_id, sha256(kept) as text_sha256, length(kept)::int as n_kept
            from (select doc_id, regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g') as kept
                  from documents)
        """,
        "digits_to_bigint": """
            select c_custkey, try_cast(regexp_replace(c_name, '[^0-9]', '', 'g') as bigint) as number
            from customer
        """,
        "digits_to_bigint_pages": """
            select page_id, digits, try_cast(digits as bigint) as number
            from (select page_id, regexp_replace(url, '[^0-9]', '', 'g') as digits from pages)
        """,
        "parse_currency": f"""
            select l_orderkey, l_linenumber, {_money("net")} as net
            from (select l_orderkey, l_linenumber,
                         '$' || format('{{:,.4f}}', l_extendedprice * (1 - l_discount)) as net
                  from lineitem)
        """,
        "round_half_even": """
            select l_orderkey, l_linenumber,
                   round_even(l_extendedprice * (1 - l_discount) * 100, 0) / 100 as cents,
                   round_even(l_quantity / 2, 0) as halves
            from lineitem
        """,
        "trim_strings": f"""
            select doc_id, regexp_replace(source, {TRIM}) as source, sha256(kept) as text_sha256,
                   length(kept)::int as n_kept
            from (select doc_id, source, regexp_replace(
                             ' ' || chr(9) || chr(12288) || chr(8195) || text
                                 || chr(160) || chr(28) || chr(13) || chr(10) || ' ', {TRIM}) as kept
                  from documents)
        """,
        "to_text_null_token": """
            select event_id, coalesce(nullif(event_type, 'error'), 'nan') as event_type,
                   user_id::varchar as user_text
            from events
        """,
        "to_double": """
            select o_orderkey, o_totalprice as price, try_cast(o_orderpriority as double) as priority
            from orders
        """,
        "to_timestamp_fmt": """
            select o_orderkey,
                   case when o_orderkey % 13 <> 0 then date_trunc('day', o_orderdate) end as day,
                   case when o_orderkey % 11 <> 0 then date_trunc('day', o_orderdate) end as checked,
                   o_orderdate as stamp
            from orders
        """,
        "count_losses": """
            select 'day' as "column", count(*) filter (o_orderkey % 11 = 0 or o_orderkey % 13 <> 0) as given,
                   count(*) filter (o_orderkey % 11 = 0) as lost
            from orders
            union all select 'number', count(o_orderkey), count(*) filter (o_orderkey % 5 = 0) from orders
            union all
            select 'price', count(*), count(*) filter (o_orderkey % 3 = 0) from orders
        """,
        "normalize_nulls": """
            select event_id,
                   case when event_id % 7 in (0, 1, 2, 4) then null when event_id % 7 = 3 then ' NA '
                        else event_type end as event_type
            from events
        """,
        "arithmetic": """
            select l_orderkey, l_linenumber, l_partkey,
                   l_linenumber::bigint + l_partkey as total,
                   l_linenumber::bigint * l_partkey as product,
                   l_partkey / nullif(l_linenumber, 0) as ratio,
                   l_linenumber / nullif(l_partkey, 0) as ratio_or_null,
                   l_tax + l_quantity as fraction_total,
                   l_quantity * l_extendedprice as fraction_product
            from lineitem
        """,
        "hour_and_parity": """
            select event_id, hour(ts)::int as hour, (hour(ts) % 2)::int as parity from events
        """,
        "route_hour_parity": ROUTED,
        "route_hour_literal": """
            select event_id, ts, 'none_hour' as branch from events
            union all
            select event_id, ts, 'odd_hour' as branch from events
        """,
        "route_all_matches": """
            select event_id, value, 'positive' as branch from events where value > 0
            union all
            select event_id, value, 'large' as branch from events where value > 50
            union all
            select event_id, value, 'rest' as branch from events
            where not coalesce(value > 0, false) and not coalesce(value > 50, false)
        """,
        "take_branch": f"select * from ({ROUTED}) where branch = 'odd_hour'",
        "merge_branches": """
            select p_partkey as key, p_retailprice as price, 'part' as branch from part
            union all select o_orderkey, o_totalprice, 'order' from orders
        """,
        "clean_whole_fractions": """
            select l_orderkey, l_linenumber, l_quantity::bigint::varchar as digits,
                   l_quantity::bigint::varchar as code
            from lineitem
        """,
        "change_branches": f"""
            select case when branch = 'odd_hour' then -event_id else event_id end as event_id,
                   branch, ts,
                   case branch when 'even_hour' then (hour(ts) // 2)::int
                               when 'odd_hour' then ((hour(ts) - 1) // 2)::int end as half
            from ({ROUTED})
        """,
        "write_branches": ROUTED,
        "row_index": """
            select row_number() over (order by ts, event_id) - 1 as "index", * from events
        """,
        "row_checksum": "select doc_id, sha256(text) as text_sha256 from documents",
        "row_checksum_pages": """
            select page_id, sha256(url) as url_sha256, sha256(html) as html_sha256 from pages
        """,
        "preview": "select * from orders order by o_orderkey limit 5",
        "profile_types": _profile(
            f"""
            select {", ".join(f"{c}::varchar as {c}" for c in LINEITEM)},
                   case when l_returnflag = 'R' then 'True' else 'False' end as is_returned,
                   case when l_linenumber not in (1, 2) then l_linenumber::varchar end as gaps,
                   null::varchar as nothing
            from lineitem
            """,
            [*LINEITEM, "is_returned", "gaps", "nothing"],
        ),
        "apply_types": "select * replace (p_size::bigint as p_size) from part",
        "csv_round_trip": "select * from orders",
        "csv_round_trip_text": "select * from documents",
        "usecols_sep_key": "select o_totalprice, o_orderkey, o_orderpriority from orders",
        "dedupe_header": """
            select c_custkey, c_name, c_nationkey::bigint as second_custkey from customer
        """,
        "write_table": "select * from orders",
        "publish_raw": """
            select row_number() over (order by p_partkey) - 1 as "index",
                   * replace (p_size::bigint as p_size)
            from part
        """,
        "publish_clean": f"""
            select row_number() over (order by l_orderkey, l_linenumber, "SP", "MRP", "STORE_ID",
                                               "Date") - 1 as "index",
                   * replace (l_linenumber::bigint as l_linenumber)
            from ({_cleaned("'nan'")})
        """,
        "stream_ingest": "select * from orders",
        "stream_clean": f"""
            select * replace (l_linenumber::bigint as l_linenumber) from ({_cleaned("'nan'")})
        """,
        "update_profile": LINE_PROFILE,
        "stream_profile": LINE_PROFILE,
        "list_files": f"select {PAGE_FILE} from pages",
        "file_checksums": f"select {PAGE_FILE}, sha256(coalesce(html, '')) as sha256 from pages",
        "probe_source": f"""
            select {PAGE_FILE}, if(coalesce(html, '') = '', 'empty', 'ok') as status from pages
        """,
        "land_files": f"""
            select {PAGE_FILE}, sha256(coalesce(html, '')) as sha256,
                   ceil(strlen(coalesce(html, '')) / 4096)::bigint as chunks,
                   strlen(coalesce(html, '')) as landed_bytes
            from pages
        """,
        "land_and_verify": f"""
            select {PAGE_FILE}, sha256(coalesce(html, '')) as sha256, true as ok from pages
        """,
    }
