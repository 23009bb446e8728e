"""Domain tables derived from the driver's tables, in SQL that Spark and DuckDB both run. The operators never know of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import awards as A
from tallyline.operators import masking as M
from tallyline.operators import registry as R
from tallyline.sources.staging import staged

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


def weighted(body: str) -> str:
    """SQL for the weighted digit sum of a 12-digit body."""
    return " + ".join(f"cast(substr({body}, {13 - n}, 1) as int) * {1 if n % 2 else 2}" for n in range(1, 13))


def number(key: str, wrong: str) -> str:
    """SQL for a 13-digit number of a key, its check digit off by one where ``wrong`` holds."""
    body = f"lpad(cast({key} as string), 12, '0')"
    return f"concat(cast((9 - ({weighted(body)}) % 9 + case when {wrong} then 1 else 0 end) % 10 as string), {body})"


WINNERS = f"""(
       select c_custkey, c_name, case when c_acctbal < 0 then '' else {number("c_custkey", "c_custkey % 37 = 0")} end as corporate_number from {{customer}}
     ) c"""
AWARD = """
select l.l_orderkey * 10 + l.l_linenumber as arrival, concat(cast(l.l_orderkey as string), '-', cast(l.l_linenumber as string)) as item_no,
       case when p.p_partkey % 11 = 0 then concat('医療法人社団 ', p.p_name) when p.p_partkey % 13 = 0 then concat('{{', p.p_name, '}}') else p.p_name end as title, cast(l.l_shipdate as date) as award_date, cast(cast(l.l_extendedprice as decimal(15, 2)) as string) as price,
       p.p_type as ministry_cd, concat(p.p_type, '/', p.p_brand) as sector, o.o_orderpriority as method_cd, c.c_name as winner_name,
       c.corporate_number, l.l_discount as award_ratio
"""
AWARDS = f"""{AWARD}from {{lineitem}} l join {{orders}} o on l.l_orderkey = o.o_orderkey join {WINNERS} on o.o_custkey = c.c_custkey
     join {{part}} p on l.l_partkey = p.p_partkey"""
#: The same rows. Orders meet customers before items, so that of the two only orders are dealt by customer once customers outgrow a broadcast.
SPARK_AWARDS = f"""{AWARD}from {{lineitem}} l join ({{orders}} o join {WINNERS} on o.o_custkey = c.c_custkey) on l.l_orderkey = o.o_orderkey
     join {{part}} p on l.l_partkey = p.p_partkey"""
BASELINE = f"""
select {number("c.c_custkey", "c.c_custkey % 37 = 0")} as corporate_number, lpad(cast(n.n_nationkey + 1 as string), 2, '0') as prefecture_code,
       n.n_name as prefecture
from {{customer}} c join {{nation}} n on c.c_nationkey = n.n_nationkey"""
CHANGES = f"""
select e.event_id as arrival, cast(e.ts as date) as file_date, {number("e.user_id", "e.user_id % 29 = 0")} as corporate_number,
       e.event_type as process_code, case e.event_id % 4 when 0 then '101' when 1 then '301' when 2 then '305' else '499' end as kind_code,
       cast(e.ts as date) - cast(e.event_id % 3 as int) as change_date, cast(regexp_extract(e.props, '([0-9]+)', 1) as int) as sequence_number,
       case when cast(regexp_extract(e.props, '([0-9]+)', 1) as int) % 10 = 0 then 1 else 0 end as correct_flag,
       coalesce(n.n_name, '') as prefecture, case e.user_id % 7 when 0 then '木村太郎' when 1 then '市川　花子' when 2 then '山田太郎商店' when 3 then 'Foo Inc.'
       else concat('N', cast(e.user_id as string)) end as name
from {{events}} e left join {{nation}} n on n.n_nationkey = e.user_id % 26"""
CLICKS = """
select ts, concat('p', cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 7 as string)) as product, event_type as kind,
       case when user_id % 5 = 0 then 'short' else concat('client-', cast(user_id as string)) end as client_id,
       concat('10.', cast(user_id % 200 as string), '.', cast(user_id % 7 as string), '.', cast(user_id % 250 as string)) as ip
from {events}"""
FETCHES = """
select ts, concat('feed', cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 4 as string)) as feed,
       case when event_type = 'error' then 'HEAD' else 'GET' end as method,
       case when event_type = 'click' then 'Googlebot/2.1 (+http://x)' when event_type = 'view'
            then concat('Reader/1.0 (', cast(user_id % 50 as string), ' subscribers)') else 'Mozilla/5.0 (X11; Linux)' end as user_agent,
       concat('10.', cast(user_id % 200 as string), '.', cast(user_id % 7 as string), '.', cast(user_id % 250 as string)) as ip
from {events}"""
OUTCOMES = """
select user_id % 40 as board, cast(ts as date) as day,
       case when min(case when event_type = 'error' then 1 else 0 end) = 1 then 'failed'
            when max(case when event_type = 'error' then 0 else value end) < 60 then 'unchanged' else 'ok' end as outcome
from {events} group by user_id % 40, cast(ts as date)"""
OBSERVED = """
select distinct user_id % 40 as board, concat(event_type, '-', cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 5 as string)) as posting,
       cast(ts as date) as day
from {events} where event_type <> 'error'"""
BLOCKED_HOSTS = """
select concat('h', cast(user_id % 12 as string)) as host, ts, event_id as fetch_id, event_type <> 'error' and event_type <> 'click' as ok
from {events}"""


DAYS = """select distinct year(ts) * 10000 + month(ts) * 100 + day(ts) as page_id, cast(ts as date) as day from {events}"""
LISTINGS = f"""
select page_id, concat('<h2>awards</h2><a onclick="doDownload(', chr(39), 'successful_bid_record_info_all_', cast(2013 + day(day) % 5 as string), '.zip', chr(39), ')">year</a> <a onclick="doDownload(', chr(39),
       'successful_bid_record_info_diff_', cast(page_id as string), '.zip', chr(39), ')">day</a><h2 id="csv-sjis">none here</h2><h2 id="csv-unicode">registry</h2><table><tr class="type1_corpHistory1"><th scope="row"> 令和',
       cast(year(day) - 2018 as string), '年', cast(month(day) as string), '月', cast(day(day) as string), '日 </th><td><a href="#" onclick="return doDownload(', cast(page_id % 1000 as string), ');"><b>zip</b> ',
       cast(120 + day(day) as string), ' kB</a></td></tr></table><h2 id="xml-unicode">other</h2><tr class="type1_corpHistory9"><th>令和1年5月1日</th><td><a onclick="return doDownload(1);">xml</a>') as html
from ({DAYS})"""
MATRIX = """
select concat('site-', cast(s_suppkey as string), ';') as source, case s_suppkey % 3 when 0 then 'CC BY 4.0, with source' when 1 then 'Public Data License 1.0' else 'Terms of use: no reuse' end as license,
       case when s_suppkey % 2 = 0 then 'Y - all paths' else 'N (search is disallowed)' end as robots_ok, case s_suppkey % 4 when 0 then 'Y' when 1 then 'unclear' when 2 then 'unclear' else 'N' end as reuse_allowed,
       concat('https://h', cast(s_suppkey % 10 as string), '.example.org/terms/', cast(s_suppkey as string), '; http://b.example.net/x?y=1') as url
from {supplier}"""
DATASETS = """
select concat('site-', cast(c_custkey as string), case when c_custkey % 6 = 0 then '' else ';' end) as key, concat('d', cast(c_custkey as string)) as dataset, c_custkey % 2 = 0 as prototype, c_custkey % 8 = 0 as hold
from {customer}"""

#: SQL for the key of a title, and for a name that is withheld, for the titles and names above.
TITLE_KEY = "regexp_replace(replace(lower(title), '医療法人社団', ''), '[ {}]', '', 'g')"
PERSON = "(kind_code = '499' and not regexp_matches(name, '商店|Inc') and length(regexp_replace(name, '[ 　]', '', 'g')) <= 6)"


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a binding over the tables of a folder."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duck(text: str) -> str:
    """A binding for DuckDB, whose tables are views of the same names."""
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text.replace("{{", "{").replace("}}", "}")


def raw_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, SPARK_AWARDS)


def code_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bodies and methods of all parts and orders, so also of all awards; a body's name is its code in lower case."""
    bodies = sql(spark, sf_dir, "select distinct p_type as ministry_cd from {part}").withColumn("publisher_name", F.lower("ministry_cd"))
    methods = sql(spark, sf_dir, "select distinct o_orderpriority as method_cd from {orders}")
    return bodies, methods.withColumn("method_detail", F.lower("method_cd")).withColumn("method", F.substring("method_cd", 1, 1))


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards with masked winners, whole yen, fiscal year and the winner's prefecture.

    Masked rows are written once: what follows joins and filters on the masked number, a column then and no expression.
    """
    raw = raw_awards(spark, sf_dir)
    rows = M.mask_winners(raw).withColumn("amount_jpy", A.scalars.parse_yen(F.col("price"))).withColumn("fiscal_year", A.scalars.fiscal_year(F.col("award_date")))
    rows = staged(rows.select("arrival", "item_no", "fiscal_year", "sector", "ministry_cd", "winner_type", "corporate_number", "amount_jpy"), "masked")
    lookup = A.build_lookup(sql(spark, sf_dir, BASELINE), rows)
    return A.enrich_prefecture(rows, lookup)


CELL = ["fiscal_year", "sector", "prefecture", "prefecture_code"]


def stored_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same awards, written once, for what reads them for cells and for whole sectors."""
    return staged(awards(spark, sf_dir).select(*CELL, "winner_type", "amount_jpy"), "awards")


def cells(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    return A.award_stats(awards(spark, sf_dir) if rows is None else rows, CELL)


def published(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Published cells (of stored awards). The cells are written once, as they are read twice: for themselves and for the universe of places."""
    return M.assert_not_directory(M.publish_cells(staged(cells(spark, sf_dir, rows), "cells"), ["fiscal_year", "sector"], "prefecture"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.normalize_changes(sql(spark, sf_dir, CHANGES))


def kept_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dedup_changes(changes(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.daily_counts(kept_changes(spark, sf_dir))


# ---------------------------------------------------------------- the same steps as DuckDB SQL

_body = "substr(corporate_number, 2, 12)"
_digits = " + ".join(f"try_cast(substr({_body}, {13 - n}, 1) as int) * {1 if n % 2 else 2}" for n in range(1, 13))
VALID = f"(regexp_matches(corporate_number, '^[0-9]{{13}}$') and try_cast(substr(corporate_number, 1, 1) as int) = 9 - ({_digits}) % 9)"
D_AWARDS = f"""raw as ({duck(AWARDS)}),
marked as (select *, case when {VALID} then 'corporate' else 'masked_individual' end as winner_type,
           round_even(price::double, 0)::bigint as amount_jpy, (year(award_date) - (month(award_date) < 4)::int)::int as fiscal_year from raw),
base as ({duck(BASELINE)}),
awards as (select m.*, coalesce(b.prefecture_code, '') as prefecture_code, coalesce(b.prefecture, '不明') as prefecture
           from marked m left join base b on m.winner_type = 'corporate' and m.corporate_number = b.corporate_number)"""


def d_stats(keys: str, source: str = "awards") -> str:
    """SQL for cell statistics by keys."""
    q = lambda p: f"round_even(quantile_cont(amount_jpy, {p}), 0)::bigint"
    return f"""select {keys}, count(*) filter (winner_type = 'corporate') as n_corporate, count(*) filter (winner_type <> 'corporate') as n_masked_individual,
       count(*) as n_awards, min(amount_jpy) as amount_min_jpy, {q(0.25)} as amount_q1_jpy, {q(0.5)} as amount_median_jpy, {q(0.75)} as amount_q3_jpy,
       max(amount_jpy) as amount_max_jpy, sum(amount_jpy)::bigint as amount_sum_jpy from {source} group by {keys}"""


D_CELLS = f"{D_AWARDS},\ncells as ({d_stats('fiscal_year, sector, prefecture, prefecture_code')})"
D_PUBLISHED = f"""{D_CELLS},
marks as (select *, n_masked_individual between 1 and 2 as small, sum(case when n_masked_individual between 1 and 2 then n_awards else 0 end)
              over (partition by fiscal_year, sector) as held from cells),
present as (select fiscal_year, sector, count(distinct prefecture) as present from marks where not small group by 1, 2),
published as (select m.fiscal_year, m.sector, m.prefecture, m.prefecture_code, n_corporate, n_masked_individual, n_awards, amount_min_jpy, amount_q1_jpy,
              amount_median_jpy, amount_q3_jpy, amount_max_jpy, amount_sum_jpy,
              case when held = 0 or (select count(distinct prefecture) from cells) - present >= 3 then held::bigint end as n_awards_suppressed_in_group
              from marks m join present using (fiscal_year, sector) where not small)"""
D_PAGES = f"""{D_PUBLISHED},
pages as (select fiscal_year, sector, sum(n_awards)::bigint as n_awards_in_table, sum(amount_sum_jpy)::bigint as amount_sum_jpy, min(amount_min_jpy) as amount_min_jpy,
          max(amount_max_jpy) as amount_max_jpy, count(*) as n_cells, coalesce(max(n_awards_suppressed_in_group), 0) as n_held_back,
          (sum(n_awards) + coalesce(max(n_awards_suppressed_in_group), 0))::bigint as n_awards from published group by 1, 2),
exact as ({d_stats("fiscal_year, sector")})"""
D_CHANGES = f"""craw as ({duck(CHANGES)}),
changes as (select * replace (nullif(prefecture, '') as prefecture), case when {VALID} then 'Y' else 'N' end as corporate_number_valid,
            strftime(file_date, '%Y-%m') as file_month from craw),
kept as (select * from changes qualify row_number() over (partition by file_month, corporate_number, change_date, sequence_number
         order by correct_flag desc, arrival) = 1)"""
D_DAILY = f"""{D_CHANGES},
daily as (select file_date as day, 'total' as axis, '' as key, count(*) as n from kept group by 1
          union all select file_date, 'process', coalesce(process_code, 'unknown'), count(*) from kept group by 1, 3
          union all select file_date, 'kind', coalesce(kind_code, 'unknown'), count(*) from kept group by 1, 3
          union all select file_date, 'prefecture', prefecture, count(*) from kept where prefecture is not null group by 1, 3)"""
