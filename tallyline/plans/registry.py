"""All registered queries of the library and their SQL. Each reads the driver's tables through the bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions import dims, scalars
from tallyline.operators import awards as A
from tallyline.operators import governance as G
from tallyline.operators import interactions as I
from tallyline.operators import masking as M
from tallyline.operators import postings as P
from tallyline.operators import registry as R
from tallyline.operators import reports as T
from tallyline.operators.pooled import pooled_quantile
from tallyline.plans import bindings as B
from tallyline.plans import queries as Q
from tallyline.sources import readers
from tallyline.sources.staging import staged

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def _add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    _QUERIES[name] = query
    if sql is not None:
        _ORACLES[name] = sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


CELL = "fiscal_year, sector, prefecture, prefecture_code"


# ---------------------------------------------------------------- awards


def _pages(s: SparkSession, d: str) -> DataFrame:
    return A.sector_year(B.published(s, d))


def _exact(s: SparkSession, d: str) -> DataFrame:
    return A.sector_year_exact(B.awards(s, d))


def _pages_and_exact(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Pages and exact statistics of the same stored awards."""
    rows = B.stored_awards(s, d)
    return A.sector_year(B.published(s, d, rows)), staged(A.sector_year_exact(rows), "exact")


def _quantiles(s: SparkSession, d: str) -> DataFrame:
    pages, exact = _pages_and_exact(s, d)
    return A.with_quantiles(pages, exact.where("n_awards > 50"), exact)


def _normalized(s: SparkSession, d: str) -> DataFrame:
    raw = B.raw_awards(s, d)
    bodies, methods = B.code_tables(s, d)
    return A.normalize_awards(raw, bodies, methods, {"license": "open"})


_add(
    "award_normalize",
    lambda s, d: _normalized(s, d).select(
        "arrival", "award_id", "fiscal_year", "amount_jpy", "winner_type", "winner_name", "winner_masked", "corporate_number", "publisher_name", "method",
        "title_masked", F.array_join("anonymise_flags", "|").alias("flags"), "raw_hash",
    ),
    f"""with {B.D_AWARDS} select arrival, sha1(concat_ws('|', ministry_cd, award_date::varchar, {B.TITLE_KEY}, amount_jpy::varchar)) as award_id,
    fiscal_year, amount_jpy, winner_type, case when winner_type = 'corporate' then winner_name end as winner_name,
    case when winner_type <> 'corporate' then '{M.PLACEHOLDER}' end as winner_masked, case when winner_type = 'corporate' then corporate_number end as corporate_number,
    lower(ministry_cd) as publisher_name, substr(method_cd, 1, 1) as method, 'N' as title_masked,
    case when winner_type = 'corporate' then '' when corporate_number = '' then 'no_corporate_number' else 'invalid_corporate_number' end as flags,
    sha256(concat_ws('|', arrival::varchar, item_no, title, award_date::varchar, price, ministry_cd, sector, method_cd, winner_name, corporate_number,
    award_ratio::varchar)) as raw_hash from awards""",
)
_add(
    "award_dedup",
    lambda s, d: A.dedup_awards(_normalized(s, d), ties=False).select("fiscal_year", "award_id", "arrival", "amount_jpy"),
    f"""with {B.D_AWARDS}, keyed as (select *, sha1(concat_ws('|', ministry_cd, award_date::varchar, {B.TITLE_KEY}, amount_jpy::varchar)) as award_id
    from awards) select fiscal_year, award_id, max(arrival) as arrival, amount_jpy from keyed group by all""",
)
_add("award_lookup", lambda s, d: A.build_lookup(B.sql(s, d, B.BASELINE), M.mask_winners(B.raw_awards(s, d).select("corporate_number", "winner_name").dropDuplicates(["corporate_number"]))),
     f"with {B.D_AWARDS} select distinct base.* from base join awards using (corporate_number) where winner_type = 'corporate'")
_add("award_enrich", lambda s, d: B.awards(s, d).select("arrival", "item_no", "prefecture", "prefecture_code"),
     f"with {B.D_AWARDS} select arrival, item_no, prefecture, prefecture_code from awards")
_add("award_cells", B.cells, f"with {B.D_AWARDS} {B.d_stats(CELL)}")
_add("award_cells_published", B.published, f"with {B.D_PUBLISHED} select * from published")
_add("award_cells_small", lambda s, d: M.suppress_small(B.cells(s, d)), f"with {B.D_CELLS} select * from cells where n_masked_individual not between 1 and 2")
_add("award_quartiles_by_rank", lambda s, d: A.quartiles_by_rank(B.awards(s, d), ["fiscal_year", "sector"], "amount_jpy"),
     f"with {B.D_AWARDS}, e as ({B.d_stats('fiscal_year, sector')}) select fiscal_year, sector, amount_q1_jpy, amount_median_jpy, amount_q3_jpy from e")
_add("award_ratio_stats", lambda s, d: A.ratio_stats(B.raw_awards(s, d).withColumn("award_ratio", F.when(F.col("award_ratio") > 0, F.col("award_ratio"))), ["sector"], "award_ratio"),
     f"""with r as (select sector, case when award_ratio > 0 then award_ratio end as x from ({B.duck(B.AWARDS)})) select sector,
     round_even(quantile_cont(x, 0.25), 4) as award_ratio_q1, round_even(quantile_cont(x, 0.5), 4) as award_ratio_median,
     round_even(quantile_cont(x, 0.75), 4) as award_ratio_q3, round_even(count(x) / count(*), 4) as award_ratio_coverage from r group by 1""")  # fmt: skip
_add("sector_year_exact", _exact, f"with {B.D_AWARDS} {B.d_stats('fiscal_year, sector')}")
_add("sector_year", _pages, f"with {B.D_PAGES} select * from pages")
_add(
    "sector_year_quantiles",
    _quantiles,
    f"""with {B.D_PAGES} select pages.*, amount_q1_jpy, amount_median_jpy, amount_q3_jpy, exact.n_awards > 50 as quantiles_exact
    from pages join exact using (fiscal_year, sector)""",
)
_POOL = """, seg as (select {g}, n_awards * 0.25 as w, unnest([{{'a': amount_min_jpy::double, 'b': amount_q1_jpy::double}}, {{'a': amount_q1_jpy::double, 'b': amount_median_jpy::double}},
  {{'a': amount_median_jpy::double, 'b': amount_q3_jpy::double}}, {{'a': amount_q3_jpy::double, 'b': amount_max_jpy::double}}]) as s from {t} where amount_min_jpy is not null),
xs as (select {g}, s.a as x from seg union select {g}, s.b from seg),
cdf as (select {g}, xs.x, sum(case when x >= s.b then w when x > s.a then w * (x - s.a) / (s.b - s.a) else 0 end) as f,
   sum(case when s.a = s.b and x = s.a then w else 0 end) as j from xs join seg using ({g}) group by {g}, xs.x),
steps as (select *, lag(x) over v as x0, lag(f) over v as f0, max(f) over (partition by {g}) as total from cdf window v as (partition by {g} order by x)),
p as (select unnest([0.25, 0.5, 0.75]) as p),
hit as (select {g}, p, min(x) as x from steps, p where f >= p * total - 1e-9 * total group by {g}, p),
val as (select h.{h}, h.p, case when f - j >= h.p * total - 1e-9 * h.p * total and f - j > f0 then least(x0 + (s.x - x0) * (h.p * total - f0) / (f - j - f0), s.x) else s.x end as q
   from hit h join steps s on {on} and h.x = s.x)"""
_add(
    "pooled_quantiles",
    lambda s, d: pooled_quantile(A.award_stats(B.awards(s, d), ["fiscal_year", "ministry_cd"]), ["fiscal_year"]).select(
        "fiscal_year", "n_cells", *[F.bround(c, 2).alias(c) for c in ("q25", "q50", "q75")]
    ),
    f"with {B.D_AWARDS}, c as ({B.d_stats('fiscal_year, ministry_cd')})"
    + _POOL.format(g="fiscal_year", h="fiscal_year", t="c", on="h.fiscal_year = s.fiscal_year")
    + """ select fiscal_year, (select count(*) from c where c.fiscal_year = val.fiscal_year) as n_cells, max(round_even(q, 2)) filter (p = 0.25) as q25,
    max(round_even(q, 2)) filter (p = 0.5) as q50, max(round_even(q, 2)) filter (p = 0.75) as q75 from val group by 1""",
)
_add("award_provenance", lambda s, d: A.award_provenance(B.raw_awards(s, d), A.dedup_awards(_normalized(s, d), ties=False), B.published(s, d)),
     f"""with {B.D_PUBLISHED}, keyed as (select fiscal_year, sha1(concat_ws('|', ministry_cd, award_date::varchar, {B.TITLE_KEY}, amount_jpy::varchar)) as award_id,
     max(award_date) as ld from awards group by 1, 2), h as (select max(n_awards_suppressed_in_group) as h from published group by fiscal_year, sector)
     select (select count(*) from raw) as records_parsed, count(*) as records_normalized, max(award_date) as last_award_date,
     (select coalesce(sum(h), 0)::bigint from h) as n_held_back, (select count(*) from raw) - count(*) as records_deduplicated
     from (select award_id, award_date from (select *, sha1(concat_ws('|', ministry_cd, award_date::varchar, {B.TITLE_KEY}, amount_jpy::varchar)) as award_id
     from awards) qualify row_number() over (partition by fiscal_year, award_id order by arrival desc) = 1)""")  # fmt: skip
_add("award_dimensions", lambda s, d: A.dimensions(B.published(s, d)),
     f"""with {B.D_PUBLISHED} select distinct 'fiscal_year' as dimension, fiscal_year::varchar as value from published
     union select 'sector', sector from published union select 'prefecture', prefecture from published""")  # fmt: skip
_add("award_dictionary", lambda s, d: A.encode_dictionary(B.cells(s, d), ["prefecture", "sector"], ["fiscal_year", "sector", "prefecture"]).drop("prefecture", "sector", "prefecture_code"),
     f"""with {B.D_CELLS}, o as (select *, row_number() over (order by fiscal_year, sector, prefecture) as k from cells),
     p as (select prefecture, (row_number() over (order by min(k)) - 1)::int as prefecture_idx from o group by 1),
     s as (select sector, (row_number() over (order by min(k)) - 1)::int as sector_idx from o group by 1)
     select o.* exclude (k, prefecture, sector, prefecture_code), prefecture_idx, sector_idx from o join p using (prefecture) join s using (sector)""")  # fmt: skip

# ---------------------------------------------------------------- parameterised queries over awards

_TOTALS = """select count(*) as n_cells, sum(n_awards)::bigint as n_awards, sum(n_corporate)::bigint as n_corporate, sum(n_masked_individual)::bigint as n_masked_individual,
  sum(amount_sum_jpy)::bigint as amount_sum_jpy, floor(sum(amount_sum_jpy) / sum(n_awards) + 0.5)::bigint as amount_mean_jpy, min(amount_min_jpy) as amount_min_jpy,
  max(amount_max_jpy) as amount_max_jpy from m"""
_add("procurement_stats", lambda s, d: Q.procurement_totals(B.published(s, d), low=1994, high=1996, sector="economy", prefecture="nation_1"),
     f"""with {B.D_PUBLISHED}, m as (select * from published where fiscal_year between 1994 and 1996 and contains(lower(sector), 'economy')
     and contains(lower(prefecture), 'nation_1') and (lower(prefecture) = 'nation_1' or not exists (select 1 from published where lower(prefecture) = 'nation_1')))
     {_TOTALS}""")  # fmt: skip
_add(
    "procurement_query",
    lambda s, d: Q.procurement_stats(B.published(s, d), 5, low=1994, high=1996, sector="economy", prefecture="NATION_1 area").select(
        "n_cells", "n_awards", "amount_sum_jpy", "amount_mean_jpy", "amount_min_jpy", "amount_max_jpy", "quartile_method", F.size("notes").alias("n_notes"),
        F.array_join(F.transform("buckets", lambda x: F.concat_ws("/", x["fiscal_year"].cast("string"), x["sector"], x["prefecture"], x["n_awards"].cast("string"))), ";").alias("buckets"),
    ),
    f"""with {B.D_PUBLISHED}, m as (select * from published where fiscal_year between 1994 and 1996 and contains(lower(sector), 'economy') and lower(prefecture) = 'nation_1'),
    b as (select * from m order by fiscal_year, sector, prefecture limit 5), t as ({_TOTALS})
    select n_cells, n_awards, amount_sum_jpy, amount_mean_jpy, amount_min_jpy, amount_max_jpy, case when n_cells = 1 then 'exact' when n_cells > 1 then 'estimated' end as quartile_method,
    ((n_cells = 0)::int + (n_cells > 1)::int + (n_cells > 5)::int)::int as n_notes,
    (select coalesce(string_agg(concat_ws('/', fiscal_year::varchar, sector, prefecture, n_awards::varchar), ';' order by fiscal_year, sector, prefecture), '') from b) as buckets from t""",
)
_add("procurement_buckets", lambda s, d: Q.procurement_buckets(B.published(s, d), low=1995, high=None, sector=None, prefecture=None, n=25),
     f"""with {B.D_PUBLISHED}, m as (select * from published where fiscal_year >= 1995)
     select fiscal_year, prefecture, sector, n_awards, amount_median_jpy, (select count(*) from m) as n_matched, (select count(*) from m) > 25 as truncated
     from m order by fiscal_year, sector, prefecture limit 25""")  # fmt: skip
_add("procurement_quantiles", lambda s, d: Q.procurement_quantiles(A.award_stats(B.awards(s, d), ["fiscal_year", "sector"]).where("sector like 'ECONOMY%'")),
     f"with {B.D_AWARDS}, c as (select 1 as g, * from ({B.d_stats('fiscal_year, sector')}) where sector like 'ECONOMY%')" + _POOL.format(g="g", h="g", t="c", on="h.g = s.g")
     + """ select (select count(*) from c) as n_cells, max(round_even(q, 0)) filter (p = 0.25)::bigint as q25, max(round_even(q, 0)) filter (p = 0.5)::bigint as q50,
     max(round_even(q, 0)) filter (p = 0.75)::bigint as q75 from val""")  # fmt: skip

# ---------------------------------------------------------------- reports

_add("report_matrix", lambda s, d: T.sector_year_matrix(_pages(s, d)), f"with {B.D_PAGES} select sector, fiscal_year, sum(n_awards)::bigint as n_awards from pages group by cube (sector, fiscal_year)")
_add("report_by_year", lambda s, d: T.awards_by_year(_pages(s, d), s.range(1990, 2001).select(F.col("id").cast("int").alias("fiscal_year"))),
     f"""with {B.D_PAGES} select y::int as fiscal_year, coalesce(sum(n_awards), 0)::bigint as n_awards from range(1990, 2001) r(y) left join pages on fiscal_year = y group by 1""")
_add("report_by_sector", lambda s, d: T.awards_by_sector(_pages(s, d), 1995),
     f"""with {B.D_PAGES}, c as (select sector, sum(n_awards)::bigint as n_awards from pages where fiscal_year = 1995 group by 1)
     select sector, n_awards, round_even(n_awards::double / sum(n_awards) over (), 4) as share from c""")  # fmt: skip
_add("report_median_by_sector", lambda s, d: T.median_by_sector(_exact(s, d), 1995), f"with {B.D_PAGES} select sector, amount_median_jpy from exact where fiscal_year = 1995")
_add("report_by_prefecture", lambda s, d: T.awards_by_prefecture(B.published(s, d)),
     f"""with {B.D_PUBLISHED}, c as (select prefecture, sum(n_awards)::bigint as n_awards from published group by 1)
     select prefecture, n_awards, round_even(n_awards::double / sum(n_awards) over (), 4) as share from c order by n_awards desc, prefecture limit 10""")  # fmt: skip
_add("report_growth", lambda s, d: T.growth(_pages(s, d), 1993, 1996),
     f"""with {B.D_PAGES}, g as (select sector, coalesce(sum(n_awards) filter (fiscal_year = 1993), 0)::bigint as n_base, coalesce(sum(n_awards) filter (fiscal_year = 1996), 0)::bigint as n_last
     from pages group by 1) select *, case when n_base > 0 then round_even(n_last / n_base, 2) end as growth from g""")  # fmt: skip
_add("report_count_vs_amount", lambda s, d: T.count_vs_amount_share(_pages(s, d)),
     f"""with {B.D_PAGES}, g as (select sector, sum(n_awards)::double as n, sum(amount_sum_jpy)::double as a from pages group by 1)
     select sector, round_even(n / sum(n) over (), 4) as award_share, round_even(a / sum(a) over (), 4) as amount_share from g""")  # fmt: skip
_add("report_month_shares", lambda s, d: T.month_shares(B.raw_awards(s, d)),
     f"""with c as (select sector, month(award_date)::int as month, count(*) as n from ({B.duck(B.AWARDS)}) group by 1, 2)
     select *, round_even(n / sum(n) over (partition by sector), 4) as share from c""")  # fmt: skip
_add("report_sextiles", lambda s, d: T.sextile_class(_pages(s, d).select("fiscal_year", "sector", "n_awards"), "n_awards"),
     f"""with {B.D_PAGES}, l as (select list(n_awards order by n_awards) as l from pages), c as (select list_transform(range(1, 6), lambda k: l[least(len(l) - 1, len(l) * k // 6) + 1]) as c from l)
     select fiscal_year, sector, n_awards, (1 + len(list_filter(c, lambda x: x <= n_awards)))::int as class from pages, c""")  # fmt: skip
_add("report_rank_cells", lambda s, d: T.rank_cells(B.published(s, d), ["fiscal_year", "sector"]).select("fiscal_year", "sector", "prefecture_code", "n_awards", "place"),
     f"""with {B.D_PUBLISHED} select fiscal_year, sector, prefecture_code, n_awards, row_number() over (partition by fiscal_year, sector
     order by n_awards desc, coalesce(nullif(prefecture_code, ''), 'zz'))::int as place from published""")  # fmt: skip
_add("report_index", lambda s, d: T.stats_index(*_pages_and_exact(s, d)),
     f"""with {B.D_PAGES} select sector, fiscal_year, pages.n_awards, pages.amount_sum_jpy, amount_median_jpy, amount_median_jpy is null as estimated
     from pages left join exact using (fiscal_year, sector)""")  # fmt: skip
_add("report_decades", lambda s, d: T.five_number_decades(_pages(s, d)),
     f"""with {B.D_PAGES} select sector, fiscal_year, floor(log10(greatest(amount_min_jpy, 1)))::int as low_decade, ceil(log10(greatest(amount_max_jpy, 1)))::int as high_decade from pages""")
_add("report_top_sectors", lambda s, d: T.top_k(T.awards_by_sector(_pages(s, d)).drop("share"), "n_awards", 8, "sector"),
     f"with {B.D_PAGES} select sector, sum(n_awards)::bigint as n_awards from pages group by 1 order by 2 desc, 1 limit 8")

# ---------------------------------------------------------------- registry changes

_add("change_normalize", lambda s, d: B.changes(s, d).select("arrival", "record_key", "corporate_number_valid", "file_month", "prefecture"),
     f"""with {B.D_CHANGES} select arrival, concat_ws('|', corporate_number, change_date::varchar, sequence_number::varchar) as record_key, corporate_number_valid, file_month, prefecture from changes""")
_add("change_dedup", lambda s, d: B.kept_changes(s, d).select("arrival", "correct_flag"), f"with {B.D_CHANGES} select arrival, correct_flag from kept")
_add("change_dedup_effect", lambda s, d: R.dedup_effect(B.changes(s, d), B.kept_changes(s, d)),
     f"""with {B.D_CHANGES}, a as (select file_date, count(*) as records_raw from changes group by 1), b as (select file_date, count(*) as records from kept group by 1)
     select file_date, records_raw, coalesce(records, 0) as records, records_raw - coalesce(records, 0) as dropped from a left join b using (file_date)""")  # fmt: skip
_LOOKUP = f"""select corporate_number, count(*) as n_changes, arg_min(change_date, r) as latest_change_date, arg_min(process_code, r) as latest_process_code,
  arg_min(kind_code, r) as latest_kind_code, arg_min(nm, r) as latest_name, coalesce(max(case when r = 1 then prefecture end), '') as latest_prefecture,
  count(*) filter (r <= 20) as n_history, string_agg(concat_ws('/', change_date::varchar, sequence_number::varchar, process_code, kind_code, nm), ';' order by r) filter (r <= 20) as history
  from (select *, case when {B.PERSON} then '' else name end as nm, row_number() over (partition by corporate_number
  order by change_date desc, sequence_number desc, correct_flag desc, arrival) as r from kept where corporate_number_valid = 'Y')"""


def _flat(df: DataFrame) -> DataFrame:
    """A lookup with its history as text."""
    entry = lambda h: F.concat_ws("/", h["change_date"].cast("string"), h["sequence_number"].cast("string"), h["process_code"], h["kind_code"], F.coalesce(h["name"], F.lit("")))
    out = df.withColumn("history", F.array_join(F.transform("history", entry), ";"))
    return out.fillna("", ["latest_name", "latest_prefecture"])


_add("corporate_lookup", lambda s, d: _flat(R.corporate_lookup(B.kept_changes(s, d))), f"with {B.D_CHANGES} {_LOOKUP} group by 1")
_add("corporate_lookup_batch", lambda s, d: _flat(R.corporate_lookup(B.kept_changes(s, d), B.sql(s, d, B.BASELINE))),
     f"with {B.D_CHANGES} {_LOOKUP} where corporate_number in (select corporate_number from ({B.duck(B.BASELINE)})) group by 1")
_add("corporate_lookup_results", lambda s, d: R.lookup_results(R.corporate_lookup(B.kept_changes(s, d)), B.sql(s, d, B.BASELINE), B.daily(s, d).where("axis = 'total'")).select(
        "corporate_number", "checksum_valid", "found", "n_changes", "covered_from", "covered_to", "days_with_data"),
     f"""with {B.D_CHANGES}, base as ({B.duck(B.BASELINE)}), c as (select corporate_number, count(*) as n from kept where corporate_number_valid = 'Y' group by 1)
     select distinct corporate_number, coalesce({B.VALID}, false) as checksum_valid, n is not null as found, coalesce(n, 0) as n_changes, (select min(file_date) from kept) as covered_from,
     (select max(file_date) from kept) as covered_to, (select count(distinct file_date) from kept) as days_with_data from base left join c using (corporate_number)""")  # fmt: skip
_add("change_history", lambda s, d: R.change_history(B.kept_changes(s, d), _A_NUMBER).select(
        "change_date", "sequence_number", F.col("kind.en").alias("kind_en"), F.col("process.en").alias("process_en"), "is_correction", "name_withheld", "name",
        F.col("name_masked_reason").isNotNull().alias("has_reason"), "prefecture", "file_date", "latest_flag"),
     f"""with {B.D_CHANGES} select change_date, sequence_number, case kind_code when '101' then 'national government body' when '301' then 'kabushiki kaisha (joint-stock company)'
     when '305' then 'godo kaisha (LLC)' else 'other (including unincorporated associations)' end as kind_en, 'unknown' as process_en, correct_flag = 1 as is_correction,
     {B.PERSON} as name_withheld, case when not {B.PERSON} then name end as name, {B.PERSON} as has_reason, prefecture, file_date, false as latest_flag from kept where corporate_number = '{{n}}'
     order by change_date desc, sequence_number desc, correct_flag desc, arrival limit 20""")  # fmt: skip
_A_NUMBER = (lambda b: f"{9 - sum(int(b[12 - n]) * (1 if n % 2 else 2) for n in range(1, 13)) % 9}{b}")("000000000007")
_ORACLES["change_history"] = _ORACLES["change_history"].replace("{n}", _A_NUMBER)
_add("change_names_guarded", lambda s, d: M.guard_names(B.changes(s, d), ["101", "301", "305"]).select("arrival", "name", "name_withheld"),
     f"""with {B.D_CHANGES} select arrival, case when not {B.PERSON} then name end as name, {B.PERSON} as name_withheld from changes""")
_add("daily_counts", B.daily, f"with {B.D_DAILY} select * from daily")
_add("merge_summary", lambda s, d: R.merge_summary(
        B.daily(s, d).where("axis = 'total'").select("day", "n"), R.daily_counts(B.changes(s, d)).where("axis = 'total' and day >= '2024-01-10'").select("day", "n")),
     f"""with {B.D_DAILY}, r as (select file_date as day, count(*) as n from changes where file_date >= date '2024-01-10' group by 1), o as (select day, n from daily where axis = 'total')
     select day, coalesce(r.n, o.n) as n from o full join r using (day)""")  # fmt: skip
_add("diff_summary", lambda s, d: R.diff_summary(B.daily(s, d).where("axis = 'total'"), "2023-12-25", "2024-02-10"),
     f"""with {B.D_DAILY}, c as (select unnest(generate_series(date '2023-12-25', date '2024-02-10', interval 1 day))::date as day)
     select count(*) as days, count(n) as days_with_file, count(*) - count(n) as days_without_file, coalesce(sum(n), 0)::bigint as total,
     floor(sum(n) / count(n) + 0.5)::bigint as mean_per_published_day from c left join (select * from daily where axis = 'total') using (day)""")  # fmt: skip
_add("scan_fill", lambda s, d: R.scan_fill(
        R.daily_counts(B.changes(s, d)).where("axis = 'total' and day(day) % 3 > 0"), B.daily(s, d).where("axis = 'total'")),
     f"""with {B.D_DAILY}, m as (select file_date as day, count(*) as m from changes where day(file_date) % 3 > 0 group by 1), t as (select day, n as s from daily where axis = 'total')
     select day, coalesce(m, s) as n, m is null as from_scan from m full join t using (day)""")  # fmt: skip


def _manifest(s: SparkSession, d: str) -> DataFrame:
    return B.sql(s, d, B.CHANGES).groupBy(F.col("file_date").alias("day")).agg(F.count("*").alias("records_raw"), F.sum("sequence_number").alias("raw_bytes"))


_MANIFEST = "manifest as (select file_date as day, count(*) as records_raw, sum(sequence_number)::bigint as raw_bytes from changes group by 1)"
_add("coverage", lambda s, d: R.coverage(_manifest(s, d), B.daily(s, d)),
     f"""with {B.D_DAILY}, {_MANIFEST} select min(day) as first_day, max(day) as last_day, count(*) as days, sum(n)::bigint as records, sum(records_raw)::bigint as records_raw,
     sum(raw_bytes)::bigint as raw_bytes, (sum(records_raw) - sum(n))::bigint as dropped from manifest left join (select * from daily where axis = 'total') using (day)""")  # fmt: skip
_add("daily_by_process", lambda s, d: R.daily_by_process(B.daily(s, d), ["click", "view"]),
     f"""with {B.D_DAILY} select day, coalesce(sum(n) filter (key = 'click'), 0)::bigint as n_click, coalesce(sum(n) filter (key = 'view'), 0)::bigint as n_view,
     coalesce(sum(n) filter (key not in ('click', 'view')), 0)::bigint as n_other from daily where axis = 'process' group by 1""")  # fmt: skip
for _name, _axis, _low, _high in (("prefecture_ranking", "prefecture", "2024-01-05", "2024-01-20"), ("process_ranking", "process", None, None), ("kind_ranking", "kind", None, None)):
    _cond = f"day between date '{_low}' and date '{_high}'" if _low else "true"
    _add(_name, lambda s, d, a=_axis, lo=_low, hi=_high: R.ranking(B.daily(s, d), a, lo, hi),
         f"""with {B.D_DAILY}, c as (select key, sum(n)::bigint as n from daily where axis = '{_axis}' and {_cond} group by 1)
         select key, n, round_even(n / (select sum(n) from daily where axis = 'total' and {_cond}), 4) as share, row_number() over (order by n desc, key)::int as rank from c""")  # fmt: skip
_add("coverage_by_code", lambda s, d: R.totals_by_code(B.daily(s, d)), f"with {B.D_DAILY} select axis, key, sum(n)::bigint as n from daily where axis <> 'total' group by 1, 2")
_add("process_means", lambda s, d: R.process_means(B.daily(s, d), ["click", "view"]),
     f"""with {B.D_DAILY}, r as (select day, sum(case when key = 'click' then n else 0 end) as a, sum(case when key = 'view' then n else 0 end) as b,
     sum(case when key not in ('click', 'view') then n else 0 end) as c from daily where axis = 'process' group by 1)
     select round_even(avg(a), 1) as mean_click, round_even(avg(b), 1) as mean_view, round_even(avg(c), 1) as mean_other from r""")  # fmt: skip
_add("kind_code_ranking", lambda s, d: R.code_ranking(B.daily(s, d), "kind", dims.KINDS).select("key", "n", "rank", "mean_per_day", "n_latest_day", "latest_day", "en"),
     f"""with {B.D_DAILY}, t as (select count(distinct day) as days, max(day) as latest from daily where axis = 'total'), c as (select key, sum(n)::bigint as n,
     sum(case when day = (select latest from t) then n else 0 end)::bigint as n_latest_day from daily where axis = 'kind' group by 1)
     select key, n, row_number() over (order by n desc, key)::int as rank, round_even(n / (select days from t), 1) as mean_per_day, n_latest_day, (select latest from t) as latest_day,
     case key when '101' then 'national government body' when '301' then 'kabushiki kaisha (joint-stock company)' when '305' then 'godo kaisha (LLC)'
     when '499' then 'other (including unincorporated associations)' else 'unknown' end as en from c""")  # fmt: skip
_add("diff_days", lambda s, d: R.diff_days(B.daily(s, d), "2024-01-05", "2024-01-20").select(
        "day", "changes", F.array_join(F.transform(F.map_entries("by_process"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";").alias("by_process")),
     f"""with {B.D_DAILY} select day, max(n) filter (axis = 'total') as changes, string_agg(key || '=' || n, ';' order by key) filter (axis = 'process') as by_process
     from daily where day between date '2024-01-05' and date '2024-01-20' group by 1""")  # fmt: skip
_add("changes_allowed", lambda s, d: M.assert_allowed(M.project_allowed(B.kept_changes(s, d))),
     f"""with {B.D_CHANGES} select corporate_number, corporate_number_valid, name, kind_code, prefecture, process_code, correct_flag, change_date, sequence_number, file_date from kept""")
_add("weekly_summary", lambda s, d: R.weekly_summary(B.daily(s, d), ["click", "view"]),
     f"""with {B.D_DAILY}, r as (select date_trunc('week', day)::date as monday, * from daily where axis in ('total', 'process'))
     select monday, sum(n) filter (axis = 'total')::bigint as total, count(*) filter (axis = 'total') as days, coalesce(sum(n) filter (axis = 'process' and key = 'click'), 0)::bigint as n_click,
     coalesce(sum(n) filter (axis = 'process' and key = 'view'), 0)::bigint as n_view, isoyear(monday)::varchar || '-W' || lpad(week(monday)::varchar, 2, '0') as week,
     (monday + 6)::date as sunday from r group by monday""")  # fmt: skip
_add("pending_files", lambda s, d: R.pending(_manifest(s, d).select("day"), _manifest(s, d).where("records_raw % 3 > 0").select("day", F.when(F.col("records_raw") % 3 == 1, "private").otherwise("published").alias("origin"))),
     f"with {B.D_CHANGES}, {_MANIFEST} select day from manifest where records_raw % 3 = 0")
_add("retention", lambda s, d: R.retention_state(_manifest(s, d), window=10, fade=3),
     f"""with {B.D_CHANGES}, {_MANIFEST}, p as (select day, row_number() over (order by day desc)::int as place from manifest)
     select day, place, case when place > 10 then 'gone' when place > 7 then 'next_to_go' else 'live' end as state from p""")  # fmt: skip
_add("fixed_sample", lambda s, d: R.fixed_sample(B.kept_changes(s, d), 200, ["arrival", "corporate_number", "file_date"]),
     f"""with {B.D_CHANGES} select arrival, corporate_number, file_date from kept where corporate_number_valid = 'Y' and kind_code in ('101', '301', '305')
     order by file_date, corporate_number, sequence_number::varchar, arrival limit 200""")  # fmt: skip
_add("feed_items", lambda s, d: R.feed_items(B.daily(s, d), 30),
     f"""with {B.D_DAILY} select day, n as total, (select string_agg(k.key || ': ' || k.n, ', ' order by k.n desc, k.key) from daily k where k.axis = 'kind' and k.day = t.day) as breakdown
     from daily t where axis = 'total' order by day desc limit 30""")  # fmt: skip
_add("status_index", lambda s, d: Q.status_index(_pages(s, d), B.daily(s, d)),
     f"""with {B.D_PAGES.replace("pages as", "pg as")}, {B.D_DAILY.replace(" base ", " base2 ")} select 'awards' as dataset, sum(n_awards)::bigint as records, count(*) as entries, max(fiscal_year)::varchar as newest from pg
     union all select 'changes', sum(n)::bigint, count(*), max(day)::varchar from daily where axis = 'total'""")  # fmt: skip

# ---------------------------------------------------------------- interactions

_PRODUCTS = [f"p{i}" for i in range(6)]
_CLICK = f"""c as ({B.duck(B.CLICKS)}), v as (select ts, product, kind, ts::date as day, case when length(client_id) >= 8 then client_id
  else split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) end as client from c where product in ('{"', '".join(_PRODUCTS)}') and kind in ('click', 'view')),
  daily as (select product, kind, day, count(distinct client) as clients from v group by 1, 2, 3)"""


def _clicks_daily(s: SparkSession, d: str) -> DataFrame:
    valid, _ = I.validate_clicks(B.sql(s, d, B.CLICKS), _PRODUCTS)
    return I.distinct_clients(valid, ["product", "kind"], F.col("client"))


_add("clicks_rejected", lambda s, d: I.validate_clicks(B.sql(s, d, B.CLICKS), _PRODUCTS)[1].groupBy("reason").agg(F.count("*").alias("n")),
     f"""with c as ({B.duck(B.CLICKS)}) select case when product = 'p6' then 'unknown_product' else 'unknown_kind' end as reason, count(*) as n from c
     where product = 'p6' or kind not in ('click', 'view') group by 1""")  # fmt: skip
_add("clicks_daily", _clicks_daily, f"with {_CLICK} select * from daily")
_add("intent_summary", lambda s, d: I.intent_summary(_clicks_daily(s, d), s.createDataFrame([(f"p{i}",) for i in range(8)], "product string"), F.lit("2024-01-20").cast("date"), 7),
     f"""with {_CLICK}, s as (select 'p' || i as product from range(8) r(i)), t as (select s.product, coalesce(sum(clients) filter (kind = 'click' and day > date '2024-01-13'), 0)::bigint as clicks_recent,
     coalesce(sum(clients) filter (kind = 'view' and day > date '2024-01-13'), 0)::bigint as views_recent, coalesce(sum(clients) filter (kind = 'click'), 0)::bigint as clicks,
     coalesce(sum(clients) filter (kind = 'view'), 0)::bigint as views from s left join daily using (product) group by 1)
     select *, case when views > 0 then round_even(clicks / views, 4) end as intent_rate from t""")  # fmt: skip
_FEED = f"""f as (select *, ts::date as day, regexp_extract(ip, '^[0-9]+\\.[0-9]+') as net from ({B.duck(B.FETCHES)}) where method = 'GET'),
  k as (select *, trim(regexp_replace(regexp_replace(lower(user_agent), '\\b[0-9]+ subscribers\\b', '', 'g'), '\\s+', ' ', 'g')) as agent,
  try_cast(regexp_extract(user_agent, '([0-9]+) subscribers', 1) as bigint) as rep, lower(split_part(split_part(user_agent, '/', 1), ' ', 1)) as family from f),
  fam as (select feed, day, family, max(rep) as rep from k where rep is not null group by 1, 2, 3), e as (select feed, day, sum(greatest(rep - 1, 0))::bigint as beyond from fam group by 1, 2),
  cnt as (select feed, day, count(*) as requests, count(distinct net || '|' || agent) as fetchers, count(distinct case when contains(lower(user_agent), 'googlebot') then net || '|' || agent end) as crawlers from k group by 1, 2),
  feeds as (select feed, day, requests, fetchers, crawlers, coalesce(beyond, 0) as reported_beyond, fetchers + coalesce(beyond, 0) as readers_estimate from cnt left join e using (feed, day))"""
_add("feed_daily", lambda s, d: I.feed_daily(B.sql(s, d, B.FETCHES), "salt"), f"with {_FEED} select * from feeds")
_add("feed_stats", lambda s, d: I.feed_stats(I.feed_daily(B.sql(s, d, B.FETCHES), "salt"), F.lit("2024-01-25").cast("date"), 14),
     f"""with {_FEED} select feed, count(*) as days, sum(requests)::bigint as requests, max(fetchers) as max_fetchers, max(readers_estimate) as max_readers_estimate
     from feeds where day > date '2024-01-11' group by 1""")  # fmt: skip
_add("client_hashes", lambda s, d: B.sql(s, d, B.CLICKS).select("client_id", F.to_date("ts").alias("day"), scalars.client_hash("salt", F.to_date("ts"), F.col("client_id")).alias("hash"),
        scalars.ip_prefix(F.col("ip")).alias("net")).distinct(),
     f"""select distinct client_id, ts::date as day, substr(sha256('salt:' || ts::date::varchar || ':' || client_id), 1, 20) as hash, regexp_extract(ip, '^[0-9]+\\.[0-9]+') as net from ({B.duck(B.CLICKS)})""")
_add("fixed_window_verdicts", lambda s, d: I.fixed_window_verdicts(
        s.read.parquet(f"{d}/events.parquet").select(F.concat(F.lit("c"), (F.col("user_id") % 20).cast("string")).alias("client"), "ts", F.col("event_id").alias("request_id")), 3, 86_400)
        .select("client", "request_id", "allowed", "remaining", "retry_after"),
     """with recursive e as (select 'c' || (user_id % 20) as client, epoch_us(ts) as t, event_id as request_id, row_number() over (partition by user_id % 20 order by ts, event_id) as r from events),
     w as (select client, t, request_id, r, t as s, 1 as k from e where r = 1 union all select e.client, e.t, e.request_id, e.r, case when e.t - w.s >= 86400000000 then e.t else w.s end,
     case when e.t - w.s >= 86400000000 then 1 else w.k + 1 end from w join e on e.client = w.client and e.r = w.r + 1)
     select client, request_id, k <= 3 as allowed, greatest(3 - k, 0)::bigint as remaining,
     greatest(1, ceil((s + 86400000000 - t) / 1e6))::bigint as retry_after from w""")  # fmt: skip

# ---------------------------------------------------------------- postings

_OUT = f"out as ({B.duck(B.OUTCOMES)}), obs as ({B.duck(B.OBSERVED)})"
_add("posting_lifecycle", lambda s, d: P.posting_lifecycle(B.sql(s, d, B.OBSERVED), B.sql(s, d, B.OUTCOMES)),
     f"""with {_OUT}, cr as (select board, day, row_number() over (partition by board order by day) as k from out where outcome <> 'failed'),
     l as (select o.board, o.posting, min(o.day) as first_seen, max(o.day) as last_seen from obs o join cr using (board, day) group by 1, 2)
     select board, posting, first_seen, last_seen, (select count(*) from cr where cr.board = l.board and cr.day > l.last_seen) as misses,
     case when (select count(*) from cr where cr.board = l.board and cr.day > l.last_seen) >= 2 then 'closed' else 'open' end as status,
     (select min(day) from cr where cr.board = l.board and cr.day > l.last_seen) as closed_at from l""")  # fmt: skip


_ERRORS = [("x -> HTTP 404", "board removed or token renamed: check the company''s careers page"), ("x -> HTTP 503", "rate limit or server error: usually transient"),
           ("HTTP 404 for robots.txt", "robots.txt refused: clearance question, see the gate"), ("timed out", "network or payload error: usually transient")]


def _nights(s: SparkSession, d: str) -> DataFrame:
    out = B.sql(s, d, B.OUTCOMES).withColumnRenamed("day", "night")
    out = out.withColumn("outcome", F.when(F.pmod(F.dayofmonth("night") + F.col("board"), F.lit(3)) > 0, "failed").otherwise(F.col("outcome")))
    return out.withColumn("error", F.when(F.col("outcome") == "failed", F.element_at(F.array(*[F.lit(e) for e, _ in _ERRORS]), (F.col("board") % 4 + 1).cast("int"))))


_NIGHTS = f"""{_OUT}, nights as (select board, day as night, case when (day(day) + board) % 3 > 0 then 'failed' else outcome end as outcome from out)"""
_add("board_health", lambda s, d: P.board_health(_nights(s, d), s.range(30).select(F.col("id").alias("board"))),
     f"""with {_NIGHTS}, g as (select board, max(night) filter (outcome <> 'failed') as good from nights group by 1)
     select board, count(*) as failed_nights, min(night) as first_failed, max(night) as last_failed, (['{"', '".join(e for e, _ in _ERRORS)}'])[board % 4 + 1] as last_error,
     (['{"', '".join(c for _, c in _ERRORS)}'])[board % 4 + 1] as likely_cause, count(*) >= 3 as flagged
     from nights join g using (board) where board < 30 and (good is null or night > good) group by board""")  # fmt: skip
_add("halted_hosts", lambda s, d: P.halted_hosts(B.sql(s, d, B.BLOCKED_HOSTS)),
     f"""with f as ({B.duck(B.BLOCKED_HOSTS)}), g as (select *, lag(ok, 1) over w as a, lag(ok, 2) over w as b from f window w as (partition by host order by ts, fetch_id))
     select host, min(ts) as halted_at from g where not ok and not a and not b group by 1""")  # fmt: skip


def _boards(s: SparkSession, d: str) -> DataFrame:
    return B.sql(s, d, B.OUTCOMES).select("board").distinct().withColumn("host", F.concat(F.lit("h"), (F.col("board") % 12).cast("string"))).withColumn("cleared", F.col("board") % 9 > 0)


_add("plan_boards", lambda s, d: P.plan_boards(_boards(s, d), _boards(s, d).where("board % 11 = 3"), P.halted_hosts(B.sql(s, d, B.BLOCKED_HOSTS)).where("host < 'h3'"),
        _boards(s, d).where("board % 5 = 0"), 1),
     f"""with {_OUT}, f as ({B.duck(B.BLOCKED_HOSTS)}), g as (select *, lag(ok, 1) over w as a, lag(ok, 2) over w as b from f window w as (partition by host order by ts, fetch_id)),
     h as (select distinct host from g where not ok and not a and not b and host < 'h3'),
     r as (select distinct board, 'h' || (board % 12) as host from out), q as (select board, host, case when board % 11 = 3 then 'blocked' when board % 9 = 0 then 'gate'
     when host in (select host from h) then 'host_halted' when board % 5 = 0 then 'already_fetched' end as x from r)
     select board, host, coalesce(x, case when row_number() over (partition by host, x is null order by board) > 1 then 'over_cap' end) as skip_reason from q""")  # fmt: skip
_add("skip_reasons", lambda s, d: P.skip_reasons(P.plan_boards(_boards(s, d), _boards(s, d).where("board % 11 = 3"), _boards(s, d).where("false"), _boards(s, d).where("board % 5 = 0"), 1)),
     f"""with {_OUT}, r as (select distinct board, 'h' || (board % 12) as host from out), q as (select board, host, case when board % 11 = 3 then 'blocked' when board % 9 = 0 then 'gate'
     when board % 5 = 0 then 'already_fetched' end as x from r), p as (select coalesce(x, case when row_number() over (partition by host, x is null order by board) > 1 then 'over_cap' end) as skip_reason
     from q) select skip_reason, count(*) as n_boards from p where skip_reason is not null group by 1""")  # fmt: skip
_add("host_requests", lambda s, d: P.host_requests(B.sql(s, d, B.BLOCKED_HOSTS)), f"select host, count(*) as n_requests from ({B.duck(B.BLOCKED_HOSTS)}) group by 1")
# places with what they are known to be: in Japan, prefecture, remote
_PLACES = [("Tokyo, Japan", True, "東京都", False), ("Osaka", True, "大阪府", False), ("Remote - Japan", True, None, True), ("San Francisco", False, None, False),
           ("Japantown, San Francisco", False, None, False), ("Yokohama", True, "神奈川県", False), ("Berlin", False, None, False), ("札幌 or Shibuya", True, "東京都", False),
           ("ＴＯＫＹＯ", True, "東京都", False), ("Japantown, Tokyo", False, "東京都", False), ("千葉県 or Tokyo", True, "千葉県", False)]
_D_PLACES = "places(i, location, japan, pref, far) as (values " + ", ".join(
    f"({i}, '{p}', {j}, {f"'{f}'" if f else 'null'}, {r})" for i, (p, j, f, r) in enumerate(_PLACES)
) + ")"
_D_POSTINGS = f"""{_D_PLACES}, p as (select distinct board, posting, location, japan, pref, far from obs join places on i = (board * 5 + right(posting, 1)::int) % {len(_PLACES)})"""


def _postings(s: SparkSession, d: str) -> DataFrame:
    place = F.element_at(F.array(*[F.lit(p[0]) for p in _PLACES]), ((F.col("board") * 5 + F.right("posting", F.lit(1)).cast("int")) % len(_PLACES) + 1).cast("int"))
    return B.sql(s, d, B.OBSERVED).select("board", "posting").distinct().withColumn("location", place)


def _sightings(s: SparkSession, d: str) -> DataFrame:
    seen = B.sql(s, d, B.OBSERVED).join(_postings(s, d), ["board", "posting"])
    name = F.concat_ws(":", F.col("board").cast("string"), "posting")
    first = F.min("day").over(Window.partitionBy("board", "posting"))
    return seen.select(F.col("day").alias("night"), name.alias("posting"), scalars.is_japan(F.col("location")).alias("is_japan"), first.alias("first_seen"))


def _closings(s: SparkSession, d: str) -> DataFrame:
    closed = P.posting_lifecycle(B.sql(s, d, B.OBSERVED), B.sql(s, d, B.OUTCOMES)).where("status = 'closed'")
    return closed.select(F.col("closed_at").alias("night"), F.concat_ws(":", F.col("board").cast("string"), "posting").alias("posting"))


_add("crawl_counters", lambda s, d: P.crawl_counters(_nights(s, d), _sightings(s, d), _closings(s, d)),
     f"""with {_NIGHTS}, {_D_POSTINGS}, a as (select night, count(*) as attempted, count(*) filter (outcome = 'ok') as n_ok, count(*) filter (outcome = 'unchanged') as n_unchanged,
     count(*) filter (outcome = 'failed') as n_failed from nights group by 1), o as (select obs.*, japan, min(day) over (partition by board, posting) as f from obs join p using (board, posting)),
     b as (select day as night, count(*) as n_seen, count(*) filter (japan) as n_japan, count(*) filter (f = day) as n_new from o group by 1),
     cr as (select board, day, row_number() over (partition by board order by day) as k from out where outcome <> 'failed'),
     l as (select o.board, o.posting, max(o.day) as last_seen from obs o join cr using (board, day) group by 1, 2),
     m as (select (select min(day) from cr where cr.board = l.board and cr.day > l.last_seen) as night, (select count(*) from cr where cr.board = l.board and cr.day > l.last_seen) as k from l),
     c as (select night, count(*) as n_closed from m where k >= 2 group by 1)
     select a.*, coalesce(n_seen, 0) as n_seen, coalesce(n_japan, 0) as n_japan, coalesce(n_new, 0) as n_new, coalesce(n_closed, 0) as n_closed
     from a left join b using (night) left join c using (night)""")  # fmt: skip


def _registry_rows(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A registry, what a check brought, and its results, for the boards of the log."""
    b = B.sql(s, d, B.OUTCOMES).select("board").distinct().select("board", F.lit("a").alias("ats"), F.col("board").cast("string").alias("board_token"))
    word = lambda m, *w: F.element_at(F.array(*[F.lit(x) for x in w]), (F.col("board") % m + 1).cast("int"))
    old = b.where("board < 30").select("ats", "board_token", word(4, "active", "inactive", "candidate", "").alias("status"), F.lit("").alias("status_checked_on"),
                                       F.lit("").alias("status_reason"), word(2, "2024-02-01", "2024-01-01").alias("checked_on"))
    found = b.where("board % 3 = 0").select("ats", "board_token", F.lit("2024-01-15").alias("checked_on"))
    result = b.select("ats", "board_token", word(5, "not_found", "empty_board", "no_japan_postings", "unchanged", "failed").alias("status"), F.lit("2024-01-15").alias("checked_on"))
    return old, found, result


_add("merge_registry", lambda s, d: P.merge_registry(*_registry_rows(s, d)).fillna(""),
     f"""with {_OUT}, b as (select distinct board from out), r as (select board, board < 30 as known, board % 3 = 0 as found,
     case when board < 30 then (['active', 'inactive', 'candidate', ''])[board % 4 + 1] else '' end as o, (['2024-02-01', '2024-01-01'])[board % 2 + 1] as oc,
     (['not_found', 'empty_board', 'no_japan_postings', 'unchanged', 'failed'])[board % 5 + 1] as rs from b where board < 30 or board % 3 = 0),
     q as (select *, known and not found and o in ('active', '') and board % 5 < 3 and '2024-01-15' >= oc as goes from r)
     select 'a' as ats, board::varchar as board_token, case when goes then 'inactive' when found and o = '' then 'active' else o end as status,
     case when goes then '2024-01-15' else '' end as status_checked_on, case when goes then 'check: ' || rs else '' end as status_reason,
     case when found then '2024-01-15' else oc end as checked_on from q""")  # fmt: skip
_add("verify_boards", lambda s, d: P.verify_boards(B.sql(s, d, B.OUTCOMES).groupBy("board").agg(F.max("outcome").alias("outcome")), _postings(s, d)),
     f"""with {_OUT}, {_D_POSTINGS}, c as (select board, count(*) as n, count(*) filter (japan) as nj, min(location) filter (japan) as sample_location from p group by 1),
     b as (select board, max(outcome) as outcome from out group by 1) select board, coalesce(n, 0) as n_postings, coalesce(nj, 0) as n_japan, sample_location,
     case when outcome <> 'ok' then outcome when nj > 0 then 'japan_hiring' when n > 0 then 'no_japan_postings' else 'empty_board' end as status from b left join c using (board)""")  # fmt: skip

# ---------------------------------------------------------------- governance

_add("audit_pages", lambda s, d: G.audit_pages(s.read.parquet(f"{d}/pages.parquet")),
     r"""with p as (select page_id, coalesce(html, '') as h from pages) select page_id, problem from (
     select page_id, 'too_large' as problem from p where strlen(h) > 100000 union all select page_id, 'no_title' from p where not regexp_matches(h, '(?i)<title>[^<]')
     union all select page_id, 'no_description' from p where not regexp_matches(h, '(?i)<meta name="description"') union all select page_id, 'mail_link' from p where regexp_matches(h, '(?i)mailto:')
     union all select page_id, 'form' from p where regexp_matches(h, '(?i)<form') union all select page_id, 'email_text' from p where regexp_matches(h, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z]'))""")  # fmt: skip
_add("audit_surfaces", lambda s, d: G.audit_surfaces(s.read.parquet(f"{d}/documents.parquet"), ["(?i)licen[sc]ed", "rights reserved"], {"version": r"\d\.\d", "apache": "Apache"}),
     r"""with t as (select doc_id, coalesce(text, '') as t from documents), f as (select * from t where regexp_matches(t, '(?i)licen[sc]ed') or contains(t, 'rights reserved'))
     select doc_id, 'version' as missing from f where not regexp_matches(t, '[0-9]\.[0-9]') union all select doc_id, 'apache' from f where not contains(t, 'Apache')""")  # fmt: skip
_add("audit_size", lambda s, d: G.audit_size(s.read.parquet(f"{d}/pages.parquet"), 1 << 20),
     """select sum(octet_length(encode(html)))::bigint as total_bytes, arg_max(page_id, (octet_length(encode(html)), page_id)) as largest_page, max(octet_length(encode(html)))::bigint as largest_bytes,
     sum(octet_length(encode(html))) > 1048576 as too_large from pages""")  # fmt: skip
_add("audit_classes", lambda s, d: G.audit_classes(s.read.parquet(f"{d}/pages.parquet").withColumn("page_class", F.regexp_extract("url", "/(en|de)/", 1)),
        {"en": {"short_title": "<title>[^<]{50}", "no_heading": "<h1"}, "de": {"short_title": "<title>[^<]{50}", "no_entity": "&amp;"}}),
     """select page_id, 'short_title' as problem from pages where regexp_extract(url, '/(en|de)/', 1) in ('en', 'de') and not regexp_matches(html, '<title>[^<]{50}')
     union all select page_id, 'no_heading' from pages where regexp_extract(url, '/(en|de)/', 1) = 'en' and not contains(html, '<h1')
     union all select page_id, 'no_entity' from pages where regexp_extract(url, '/(en|de)/', 1) = 'de' and not contains(html, '&amp;')""")  # fmt: skip
_add("page_links", lambda s, d: G.extract_links(s.read.parquet(f"{d}/pages.parquet")),
     r"""with a as (select page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href=["'']([^"''#]*)[^>]*>(.*?)</a>')) as a from pages),
     b as (select page_id, url, trim(regexp_extract(a, '(?is)href=["'']([^"''#]*)', 1)) as href, trim(regexp_replace(regexp_replace(regexp_extract(a, '(?is)<a\s[^>]*?href=["''][^"''#]*[^>]*>(.*?)</a>', 1),
     '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) as title from a)
     select distinct page_id, case when starts_with(href, '/') then regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || href else href end as target, title from b""")  # fmt: skip
_add("page_listing", lambda s, d: G.extract_listing(s.read.parquet(f"{d}/pages.parquet"), r"<(h[1-3])[^>]*>([^<]*)<", ["level", "heading"]),
     r"""select distinct page_id, regexp_extract(x, '<(h[1-3])[^>]*>([^<]*)<', 1) as level, regexp_extract(x, '<(h[1-3])[^>]*>([^<]*)<', 2) as heading
     from (select page_id, unnest(regexp_extract_all(html, '<(h[1-3])[^>]*>([^<]*)<')) as x from pages)""")  # fmt: skip


def _fingerprints(s: SparkSession, d: str, changed: bool) -> DataFrame:
    docs = s.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").alias("page_id"), F.split("text", "\n").alias("l"))
    if changed:
        docs = docs.where("page_id % 7 > 0").withColumn("l", F.when(F.col("page_id") % 5 == 0, F.slice("l", 1, 1)).otherwise(F.col("l")))
    return G.page_fingerprint(docs, F.col("l"))


_add("compare_fingerprints", lambda s, d: G.compare_fingerprints(_fingerprints(s, d, False), _fingerprints(s, d, True)).select(
        "page_id", "state", F.size("added").cast("long").alias("n_added"), F.size("removed").cast("long").alias("n_removed")),
     """with l as (select doc_id as page_id, list_sort(list_distinct(string_split(text, chr(10)))) as l from documents),
     b as (select doc_id as page_id, case when doc_id % 5 = 0 then string_split(text, chr(10))[1:1] else list_sort(list_distinct(string_split(text, chr(10)))) end as b from documents where doc_id % 7 > 0)
     select page_id, case when b is null then 'no_baseline' when b = l then 'same' else 'changed' end as state, len(list_filter(l, lambda x: b is null or not list_contains(b, x))) as n_added,
     case when b is null then 0 else len(list_filter(b, lambda x: not list_contains(l, x))) end as n_removed from l left join b using (page_id)""")  # fmt: skip
_add("award_source_version", lambda s, d: G.source_version(B.cells(s, d)))
_add("japan_places", lambda s, d: _postings(s, d).select("location", scalars.is_japan(F.col("location")).alias("is_japan"), scalars.japan_prefecture(F.col("location")).alias("prefecture"),
        scalars.is_remote(F.col("location")).alias("remote")).distinct(),
     f"""with {_OUT}, {_D_POSTINGS} select distinct location, japan as is_japan, pref as prefecture, far as remote from p""")

# ---------------------------------------------------------------- files, listings, surfaces

_add("union_files", lambda s, d: readers.union_files(s, [f"{d}/{t}.parquet" for t in ("documents", "benchmark", "conversations")], "parquet").select(
        "file_key", "doc_id", "item_id", "conv_id", "turn", "role", "lang", F.length("text").alias("n_text")),
     """select 'documents.parquet' as file_key, doc_id, null::bigint as item_id, null::bigint as conv_id, null::integer as turn, null::varchar as role, lang, length(text)::integer as n_text from documents
     union all select 'benchmark.parquet', null, item_id, null, null, null, null, length(text)::integer from benchmark
     union all select 'conversations.parquet', null, null, conv_id, turn, role, null, length(text)::integer from conversations""")  # fmt: skip
_add("union_totals", lambda s, d: readers.union_files(s, [f"{d}/{t}.parquet" for t in ("customer", "supplier")], "parquet",
        {"c_acctbal": "double", "s_acctbal": "double", "c_nationkey": "long", "s_nationkey": "long"}).groupBy(
        "file_key", F.coalesce("c_nationkey", "s_nationkey").alias("nation")).agg(F.count("*").alias("n"), F.bround(F.sum(F.coalesce("c_acctbal", "s_acctbal")), 2).alias("balance")),
     """select 'customer.parquet' as file_key, c_nationkey::bigint as nation, count(*) as n, round_even(sum(c_acctbal), 2) as balance from customer group by 2
     union all select 'supplier.parquet', s_nationkey::bigint, count(*), round_even(sum(s_acctbal), 2) from supplier group by 2""")  # fmt: skip
_add("award_listing", lambda s, d: G.award_listing(B.sql(s, d, B.LISTINGS)),
     f"""with p as ({B.duck(B.DAYS)}) select page_id, 'successful_bid_record_info_diff_' || strftime(day, '%Y%m%d') || '.zip' as file_name, 'diff' as kind, day::varchar as file_key, null::integer as fiscal_year from p
     union all select page_id, 'successful_bid_record_info_all_' || (2013 + day(day) % 5) || '.zip', 'all', 'FY' || (2013 + day(day) % 5), (2013 + day(day) % 5)::integer from p""")  # fmt: skip
_add("diff_listing", lambda s, d: G.diff_listing(B.sql(s, d, B.LISTINGS)),
     f"""with p as ({B.duck(B.DAYS)}) select page_id, day, (page_id % 1000)::varchar as file_no, 'zip ' || (120 + day(day)) || ' kB' as label, (120 + day(day)) || ' kB' as size from p""")


def _surfaces(s: SparkSession, d: str) -> DataFrame:
    """A text for each publication day that shows the day's figure, in one way or another; some are JSON, some have the notes they need."""
    n, k = F.col("raw_bytes"), F.dayofmonth("day")
    shown = F.when(k % 3 == 0, n.cast("string")).when(k % 3 == 1, F.format_number(n, 0)).otherwise(F.concat(F.lit("9"), n.cast("string"), F.lit("9")))
    note = F.when(k % 4 == 0, ", CC BY 4.0, modified").when(k % 4 == 1, ", CC BY 4.0").when(k % 4 == 2, ", modified").otherwise("")
    plain = F.concat(F.lit("On "), F.col("day").cast("string"), F.lit(": "), shown, F.lit(" bytes"), note, F.when(k % 7 == 0, " Source: x").otherwise(""))
    json_ = F.concat(F.lit('{"modified": "'), plain, F.lit('", "CC BY": 4}'))
    return _manifest(s, d).select((F.year("day") * 10000 + F.month("day") * 100 + k).cast("long").alias("doc_id"), F.when(k % 5 == 0, json_).otherwise(plain).alias("text"))


_add("audit_figures", lambda s, d: G.audit_surfaces(_surfaces(s, d), ["Source:"], {"licence": "CC BY", "notice": "modified"},
        _manifest(s, d).select(F.col("raw_bytes").alias("figure")), F.col("text").startswith("{")),
     f"""with {B.D_CHANGES}, {_MANIFEST}, x as (select (year(day) * 10000 + month(day) * 100 + day(day))::bigint as doc_id, day(day) as k, raw_bytes >= 1000 as large from manifest),
     f as (select * from x where k % 7 = 0 or (large and k % 3 < 2))
     select doc_id, 'licence' as missing from f where k % 4 in (2, 3) union all select doc_id, 'notice' from f where k % 4 in (1, 3)""")  # fmt: skip
_add("headline_figures", lambda s, d: G.shows_figure(s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), s.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("figure"))),
     r"""with f as (select distinct o_orderkey as n from orders where o_orderkey >= 1000), t as (select doc_id, unnest(list_distinct(regexp_extract_all(text, '[0-9]+') || regexp_extract_all(text, '[0-9,]*,[0-9,]*'))) as x from documents)
     select distinct doc_id from t where x in (select n::varchar from f) or x in (select format('{:,}', n) from f)""")  # fmt: skip
_LICENCES = {"cc by 4.0": "open", "public data": "open_with_source", "terms of use": "restricted"}
_ROBOTS = {"y": "allowed", "n": "refused"}
_add("clearance_projection", lambda s, d: G.project_clearance(B.sql(s, d, B.MATRIX), _LICENCES, _ROBOTS).select("source", "licence_class", "robots_class", "reuse_allowed", "url"),
     f"""with m as ({B.duck(B.MATRIX)}) select source, case when starts_with(license, 'CC BY') then 'open' when starts_with(license, 'Public') then 'open_with_source' else 'restricted' end as licence_class,
     case when starts_with(robots_ok, 'Y') then 'allowed' else 'refused' end as robots_class, reuse_allowed,
     case when reuse_allowed = 'Y' then url else regexp_extract(url, '^(https://[^/]+)', 1) || '; http://b.example.net' end as url from m""")  # fmt: skip
_add("clearance", lambda s, d: G.clear(B.sql(s, d, B.DATASETS), B.sql(s, d, B.MATRIX)),
     f"""with m as ({B.duck(B.MATRIX)}), x as ({B.duck(B.DATASETS)}), j as (select x.*, m.source, m.reuse_allowed, m.robots_ok from x left join m on contains(m.source, x.key)),
     g as (select dataset, any_value(prototype) as p, any_value(hold) as h, count(source) as n_rows, max(reuse_allowed) as r, max(robots_ok) as b from j group by 1)
     select dataset, n_rows, case when n_rows = 0 then 'missing' when n_rows > 1 then 'ambiguous' when r = 'Y' then 'cleared' when r = 'unclear' and p and starts_with(b, 'Y') then 'prototype' else 'blocked' end as tos_status,
     n_rows = 1 and r = 'Y' and not h as publishable from g""")  # fmt: skip

# ---------------------------------------------------------------- planning, boards and postings

_add("japan_postings", lambda s, d: P.japan_only(_postings(s, d)).select("board", "posting", "location"), f"with {_OUT}, {_D_POSTINGS} select board, posting, location from p where japan")
_add("active_boards", lambda s, d: P.active_boards(_registry_rows(s, d)[0].withColumn("status", F.when(F.col("board_token") == "7", " Active ").otherwise(F.col("status")))).select("ats", "board_token"),
     f"""with {_OUT}, b as (select distinct board from out where board < 30) select 'a' as ats, board::varchar as board_token from b where board = 7 or (['active', 'inactive', 'candidate', ''])[board % 4 + 1] in ('active', '')""")


def _verified(s: SparkSession, d: str) -> DataFrame:
    return P.verify_boards(B.sql(s, d, B.OUTCOMES).groupBy("board").agg(F.max("outcome").alias("outcome")), _postings(s, d))


_add("board_registry", lambda s, d: P.build_board_registry(_verified(s, d), _boards(s, d).where("board % 3 > 0").select("board", F.col("host").alias("company"))).select("board", "n_japan", "company"),
     f"""with {_OUT}, {_D_POSTINGS}, c as (select board, count(*) filter (japan) as n_japan from p group by 1), b as (select board, max(outcome) as outcome from out group by 1)
     select board, n_japan, case when board % 3 > 0 then 'h' || (board % 12) end as company from b join c using (board) where outcome = 'ok' and n_japan > 0""")  # fmt: skip


def _refresh(s: SparkSession, d: str) -> DataFrame:
    days = _manifest(s, d)
    k, key = F.dayofmonth("day"), F.col("day").cast("string").alias("file_key")
    listed = days.select(key, F.concat(F.lit("s"), k.cast("string")).alias("stamp"), F.concat((k * 2).cast("string"), F.lit(" kB")).alias("size_label"))
    manifest = days.where(k % 5 > 0).select(key, F.when(k % 7 == 0, "error").when(k % 7 == 1, "").otherwise("ok").alias("status"))
    recorded = days.where(k % 4 > 0).select(key, F.when(k % 3 == 0, "old").otherwise(F.concat(F.lit("s"), k.cast("string"))).alias("stamp"), F.concat((k * F.when(k % 11 == 0, 3).otherwise(2)).cast("string"), F.lit(" kB")).alias("size_label"))
    return R.plan_refresh(listed, manifest, recorded, ["2024-01-08"])


_add("refresh_plan", _refresh,
     f"""with {B.D_CHANGES}, {_MANIFEST}, x as (select day::varchar as file_key, day(day) as k from manifest), y as (select file_key, case when file_key = '2024-01-08' then 'forced' when k % 5 = 0 then 'new'
     when k % 7 = 0 then 'unreadable' when k % 4 > 0 and k % 3 = 0 then 'stamp_moved' when k % 4 > 0 and k % 11 = 0 then 'size_moved' end as reason from x) select * from y where reason is not null""")  # fmt: skip

# ---------------------------------------------------------------- pages of one sector and year


def _page(s: SparkSession, d: str, sector: str, year: int) -> DataFrame:
    rows = B.stored_awards(s, d)
    cells, exact = B.published(s, d, rows), A.sector_year_exact(rows)
    return T.page_rows(cells, exact.where("n_awards > 50"), exact, sector, year)


_add("page_rows", lambda s, d: _page(s, d, "ECONOMY/Brand#5", 1995),
     f"""with {B.D_PUBLISHED}, exact as ({B.d_stats("fiscal_year, sector")}), c as (select * from published where sector = 'ECONOMY/Brand#5' and fiscal_year = 1995)
     select 0 as place, null as prefecture, null as prefecture_code, (sum(c.n_awards) + coalesce(max(n_awards_suppressed_in_group), 0))::bigint as n_awards, coalesce(max(n_awards_suppressed_in_group), 0)::bigint as n_held_back,
     count(*) as n_cells, sum(c.n_corporate)::bigint as n_corporate, sum(c.n_masked_individual)::bigint as n_masked_individual, min(c.amount_min_jpy) as amount_min_jpy, any_value(e.amount_q1_jpy) as amount_q1_jpy,
     any_value(e.amount_median_jpy) as amount_median_jpy, any_value(e.amount_q3_jpy) as amount_q3_jpy, max(c.amount_max_jpy) as amount_max_jpy, sum(c.amount_sum_jpy)::bigint as amount_sum_jpy,
     floor(sum(c.amount_sum_jpy) / sum(c.n_awards) + 0.5)::bigint as amount_mean_jpy, 1.0::double as share, any_value(e.n_awards) > 50 as quantiles_exact from c join exact e using (fiscal_year, sector) having count(*) > 0
     union all select row_number() over (order by n_awards desc, coalesce(nullif(prefecture_code, ''), 'zz'))::int, prefecture, nullif(prefecture_code, ''), n_awards, null, null, n_corporate, n_masked_individual, amount_min_jpy,
     amount_q1_jpy, amount_median_jpy, amount_q3_jpy, amount_max_jpy, amount_sum_jpy, floor(amount_sum_jpy / n_awards + 0.5)::bigint, round_even(n_awards / sum(n_awards) over (), 4), true from c""")  # fmt: skip

# ---------------------------------------------------------------- stored postings: sightings, closing, purge; nights, lines


def _stored(s: SparkSession, d: str) -> DataFrame:
    """Postings as stored before a run: those first seen by the 20th, with misses and status by board."""
    seen = B.sql(s, d, B.OBSERVED).groupBy("board", "posting").agg(F.min("day").alias("f"), F.max("day").alias("l")).where("day(f) <= 20")
    misses = F.col("board") % 3
    return seen.select(
        F.concat_ws(":", F.col("board").cast("string"), "posting").alias("posting_id"), F.lit("a").alias("ats"), F.col("board").cast("string").alias("board_token"), F.lit("old").alias("title"),
        F.concat(F.lit("u"), F.col("board").cast("string")).alias("job_url"), F.lit("2023-12-01").alias("created_at"), F.col("f").cast("string").alias("first_seen_at"), F.least("l", F.lit("2024-01-20").cast("date")).cast("string").alias("last_seen_at"),
        misses.alias("consecutive_misses"), F.when(misses == 2, "closed").otherwise("open").alias("status"), F.when(misses > 0, "2024-01-19").alias("closed_at"),
    )


def _seen_last(s: SparkSession, d: str) -> DataFrame:
    rows = B.sql(s, d, B.OBSERVED).where("day(day) > 20").select("board", "posting").distinct()
    board = F.col("board").cast("string")
    return rows.select(F.concat_ws(":", board, "posting").alias("posting_id"), F.lit("a").alias("ats"), board.alias("board_token"), F.lit("new").alias("title"), F.lit("v").alias("job_url"),
                       F.when(F.col("board") % 2 == 0, "2024-01-05").alias("created_at"))


_STORED = f"""{_OUT}, stored as (select board || ':' || posting as posting_id, board, min(day)::varchar as f, least(max(day), date '2024-01-20')::varchar as l from obs group by board, posting having day(min(day)) <= 20),
  seen as (select distinct board || ':' || posting as posting_id, board from obs where day(day) > 20)"""
_add("posting_upsert", lambda s, d: P.merge_postings(_stored(s, d), _seen_last(s, d), F.lit("2024-01-30")).fillna("", ["closed_at", "created_at"]),
     f"""with {_STORED}, j as (select coalesce(a.posting_id, b.posting_id) as posting_id, coalesce(a.board, b.board) as board, a.posting_id is not null as known, b.posting_id is not null as sighted, f, l
     from stored a full join seen b on a.posting_id = b.posting_id)
     select posting_id, 'a' as ats, board::varchar as board_token, case when sighted then 'new' else 'old' end as title, case when known then 'u' || board else 'v' end as job_url,
     coalesce(case when sighted and board % 2 = 0 then '2024-01-05' end, case when known then '2023-12-01' end, '') as created_at, case when known then f else '2024-01-30' end as first_seen_at,
     case when sighted then '2024-01-30' else l end as last_seen_at, case when sighted then 0 else board % 3 end as consecutive_misses, case when sighted or board % 3 < 2 then 'open' else 'closed' end as status,
     case when not sighted and board % 3 > 0 then '2024-01-19' else '' end as closed_at from j""")  # fmt: skip


def _last_night(s: SparkSession, d: str) -> DataFrame:
    board = F.col("board").cast("string")
    return B.sql(s, d, B.OUTCOMES).select("board").distinct().select(F.lit("a").alias("ats"), board.alias("board_token"), F.element_at(F.array(F.lit("ok"), F.lit("unchanged"), F.lit("failed")), (F.col("board") % 7 % 3 + 1).cast("int")).alias("outcome"))


_add("posting_closing", lambda s, d: P.close_missing(_stored(s, d), _last_night(s, d), _seen_last(s, d).where("cast(board_token as int) % 5 > 0"), F.lit("2024-01-30")).select(
        "posting_id", "consecutive_misses", "status", F.coalesce("closed_at", F.lit("")).alias("closed_at")),
     f"""with {_STORED}, s2 as (select posting_id from seen where board % 5 > 0), j as (select stored.*, board % 3 as m, (['ok', 'unchanged', 'failed'])[board % 7 % 3 + 1] as o, posting_id in (select posting_id from s2) as x from stored),
     k as (select *, o <> 'failed' and m < 2 and not (x or (o = 'unchanged' and m = 0)) as missed from j)
     select posting_id, case when missed then m + 1 else m end as consecutive_misses, case when m = 2 or (missed and m = 1) then 'closed' else 'open' end as status,
     case when missed and m = 0 then '2024-01-30' when m > 0 then '2024-01-19' else '' end as closed_at from k""")  # fmt: skip
_add("purged_postings", lambda s, d: M.purge_blocked(_stored(s, d), _last_night(s, d).where("outcome = 'failed'").select("ats", "board_token")).select("posting_id"),
     f"with {_STORED} select posting_id from stored where board % 7 % 3 < 2")
_add("night_counts", lambda s, d: s.read.parquet(f"{d}/events.parquet").groupBy(scalars.night_key(F.col("ts").cast("timestamp")).alias("night")).agg(F.count("*").alias("n")),
     "select (ts - interval 3 hour)::date as night, count(*) as n from events group by 1")
_add("line_changes", lambda s, d: G.line_changes(*(B.sql(s, d, B.CLICKS).where(f"day(ts) = {k}").select(F.concat_ws(" ", "product", "kind").alias("line")) for k in (10, 11))),
     f"""with c as ({B.duck(B.CLICKS)}), a as (select product || ' ' || kind as line from c where day(ts) = 10), b as (select product || ' ' || kind as line from c where day(ts) = 11)
     select line, 'added' as change from (select * from b except all select * from a) union all select line, 'removed' from (select * from a except all select * from b)""")  # fmt: skip
