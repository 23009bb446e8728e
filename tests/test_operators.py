"""Operators on small frames with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyline.functions import dims, scalars
from tallyline.operators import awards, governance, interactions, masking, postings, registry, reports
from tallyline.operators.pooled import pooled_quantile
from tallyline.plans import bindings, queries
from tallyline.plans import registry as registered


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("number", "ok"), [("1010001005145", True), ("1000020249203", True), ("7000012050002", True), ("7011003005763", True), ("1234567890123", False),
                                             ("", False), (None, False), ("１０１０００１００５１４５", True)])
def test_check_digit(spark, number, ok):
    assert one(spark, scalars.check_digit_valid(F.lit(number).cast("string"))) is ok


def test_scalars(spark):
    assert one(spark, scalars.fiscal_year(F.lit("2026-04-01").cast("date"))) == 2026
    assert one(spark, scalars.fiscal_year(F.lit("2026-03-31").cast("date"))) == 2025
    assert one(spark, scalars.parse_yen(F.lit("31389000.00"))) == 31389000
    assert one(spark, scalars.parse_yen(F.lit("2.5"))) == 2
    assert one(spark, scalars.parse_yen(F.lit("x"))) is None
    assert one(spark, scalars.era_to_date(F.lit("令和元年5月1日"))) == dt.date(2019, 5, 1)
    assert one(spark, scalars.era_fiscal_year(F.lit("平成30年度"))) == 2018
    assert one(spark, scalars.nfkc(F.lit("Ｐｏｌｅ＆Ｌｉｎｅ合同会社"))) == "Pole&Line合同会社"
    assert one(spark, scalars.round_half_up(F.lit(2.5))) == 3
    assert one(spark, scalars.prefecture_name(F.lit("1"))) == "北海道"
    assert one(spark, scalars.ip_prefix(F.lit("192.168.3.4"))) == "192.168"
    assert one(spark, scalars.ip_prefix(F.lit("2001:db8::1"))) == "2001:db8:0"
    assert one(spark, scalars.agent_family(F.lit("Feedly/1.0 (x)"))) == "feedly"
    assert one(spark, scalars.reported_readers(F.lit("Feedly/1.0 (42 subscribers)"))) == 42
    assert one(spark, scalars.is_iso_date(F.lit("2024-02-30"))) is False
    with pytest.raises(ValueError, match="salt"):
        scalars.client_hash("", F.lit("d"), F.lit("x"))


@pytest.mark.parametrize(("ts", "night"), [("2026-09-24 19:10:00", 24), ("2026-09-25 02:59:00", 24), ("2026-09-25 03:00:00", 25)])
def test_night_key(spark, ts, night):
    assert one(spark, scalars.night_key(F.lit(ts).cast("timestamp"))).day == night


@pytest.mark.parametrize(("place", "ok"), [("Tokyo, Japan", True), ("東京都", True), ("Remote - Japan", True), ("JPN", True), ("Hybrid", False), ("Remote", False),
                                            ("Japantown, San Francisco", False), ("", False), (None, False)])
def test_is_japan(spark, place, ok):
    assert one(spark, scalars.is_japan(F.lit(place).cast("string"))) is ok


def test_masking(spark):
    raw = spark.createDataFrame([("1", "Ｐｏｌｅ", "7011003005763"), ("2", "山田", ""), ("3", "x", "1234567890123")], "id string, winner_name string, corporate_number string")
    rows = {r.id: r for r in masking.assert_masked(masking.mask_winners(raw)).collect()}
    assert rows["1"].winner_name == "Pole"
    assert rows["2"].winner_name is None and rows["2"].anonymise_flags == ["no_corporate_number"] and rows["2"].winner_masked == masking.PLACEHOLDER
    assert rows["3"].corporate_number is None and rows["3"].anonymise_flags == ["invalid_corporate_number"]
    titles = spark.createDataFrame([("佐藤花子氏に係る業務",), ("小林多様性研修",), ("翻訳業務",), ("Mr. John Smith",)], "title string")
    assert [r.title_masked for r in masking.mask_titles(titles).collect()] == ["Y", "N", "N", "Y"]
    with pytest.raises(ValueError, match="personal"):
        masking.assert_no_personal_columns(spark.range(1).withColumn("代表者名", F.lit("")))
    with pytest.raises(ValueError, match="parties"):
        masking.assert_not_directory(spark.range(1).withColumn("winner_name", F.lit("")))


@pytest.mark.parametrize(("held", "absent", "want"), [(0, 0, 0), (2, 1, None), (1, 2, None), (1, 3, 1), (2, 9, 2)])
def test_disclosure(spark, held, absent, want):
    cells = [("g", "keep", 0, 5)] + ([("g", "small", 1, held)] if held else []) + [("other", f"p{i}", 0, 1) for i in range(absent - (1 if held else 0))]
    df = spark.createDataFrame(cells, "sector string, prefecture string, n_masked_individual int, n_awards int")
    out = masking.publish_cells(df, ["sector"], "prefecture").where("sector = 'g'").collect()
    assert [r.prefecture for r in out] == ["keep"] and out[0].n_awards_suppressed_in_group == want


FIVE = [(2024, "東京都", "防衛", 10, 100, 200, 300, 400, 500), (2024, "大阪府", "防衛", 4, 1000, 1000, 2000, 3000, 4000)]
FIVE_SCHEMA = (
    "fiscal_year int, prefecture string, sector string, n_awards int, amount_min_jpy long, amount_q1_jpy long, amount_median_jpy long, amount_q3_jpy long, amount_max_jpy long"
)


def test_pooled_quantiles(spark):
    row = pooled_quantile(spark.createDataFrame(FIVE, FIVE_SCHEMA), ["fiscal_year"]).first()
    assert [round(row[c]) for c in ("q25", "q50", "q75")] == [240, 380, 1000]
    alone = pooled_quantile(spark.createDataFrame(FIVE[:1], FIVE_SCHEMA), ["fiscal_year"]).first()
    assert [round(alone[c]) for c in ("q25", "q50", "q75")] == [200, 300, 400]


def test_quartiles_agree(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 101).alias("amount_jpy"), F.lit("corporate").alias("winner_type"))
    a = awards.award_stats(df, ["g"]).select("g", "amount_q1_jpy", "amount_median_jpy", "amount_q3_jpy")
    assert a.exceptAll(awards.quartiles_by_rank(df, ["g"], "amount_jpy")).isEmpty()


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([("2024-01", "1", "d", 1, 0, 1), ("2024-01", "1", "d", 1, 1, 2), ("2024-01", "1", "d", 1, 1, 3)],
                               "file_month string, corporate_number string, change_date string, sequence_number int, correct_flag int, arrival int")
    once = registry.dedup_changes(df)
    assert [r.arrival for r in once.collect()] == [2] and registry.dedup_changes(once).exceptAll(once).isEmpty()


def test_closing_rule(spark):
    stored = spark.createDataFrame([("a", "b", "p1", "open", 0, None), ("a", "b", "p2", "open", 1, dt.date(2026, 1, 1)), ("a", "b", "p3", "closed", 2, dt.date(2026, 1, 1)), ("a", "c", "p4", "open", 0, None)],
                                   "ats string, board_token string, posting_id string, status string, consecutive_misses int, closed_at date")
    outcomes = spark.createDataFrame([("a", "b", "unchanged"), ("a", "c", "failed")], "ats string, board_token string, outcome string")
    seen = spark.createDataFrame([], "posting_id string")
    rows = {r.posting_id: (r.status, r.consecutive_misses) for r in postings.close_missing(stored, outcomes, seen, F.lit("2026-01-02").cast("date")).collect()}
    assert rows == {"p1": ("open", 0), "p2": ("closed", 2), "p3": ("closed", 2), "p4": ("open", 0)}


def test_merge_postings(spark):
    schema = "posting_id string, title string, location string, function_bucket string, updated_at string, first_seen_at string, last_seen_at string, consecutive_misses int, status string, closed_at string"
    stored = spark.createDataFrame([("x", "old", "Tokyo", "sales", "u1", "d1", "d1", 2, "closed", "d2"), ("y", "t", "Osaka", "other", "u", "d1", "d1", 0, "open", None)], schema)
    seen = spark.createDataFrame([("x", "new", "Kyoto", "engineering", None), ("z", "t", "Kobe", "other", "u9")], "posting_id string, title string, location string, function_bucket string, updated_at string")
    rows = {r.posting_id: r for r in postings.merge_postings(stored, seen, F.lit("d9")).collect()}
    x = rows["x"]
    assert (x.title, x.function_bucket, x.updated_at, x.first_seen_at, x.last_seen_at, x.consecutive_misses, x.status, x.closed_at) == ("new", "sales", "u1", "d1", "d9", 0, "open", None)
    assert rows["z"].first_seen_at == "d9" and rows["y"].last_seen_at == "d1"


def test_feed_counts(spark):
    ua = "Feedly/1.0 ({} subscribers)"
    rows = [("f", "GET", ua.format(42), "10.0.0.1"), ("f", "GET", ua.format(43), "10.0.9.9"), ("f", "HEAD", ua.format(99), "10.0.0.1"), ("f", "GET", "x", "10.1.0.1")]
    df = spark.createDataFrame(rows, "feed string, method string, user_agent string, ip string").withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp"))
    r = interactions.feed_daily(df, "salt").first()
    assert (r.requests, r.fetchers, r.reported_beyond, r.readers_estimate) == (3, 2, 42, 44)


def test_clearance(spark):
    matrix = spark.createDataFrame([("alpha data", "Y", "Y"), ("beta data", "unclear", "Yes"), ("beta more", "N", "N")], "source string, reuse_allowed string, robots_ok string")
    sets = spark.createDataFrame([("a", "alpha", False, False), ("b", "beta d", True, False), ("c", "beta", False, False), ("d", "none", False, False), ("e", "alpha", False, True)],
                                 "dataset string, key string, prototype boolean, hold boolean")
    rows = {r.dataset: (r.tos_status, r.publishable) for r in governance.clear(sets, matrix).collect()}
    assert rows == {"a": ("cleared", True), "b": ("prototype", False), "c": ("ambiguous", False), "d": ("missing", False), "e": ("cleared", False)}


def test_source_version_ignores_order(spark):
    df = spark.range(50).withColumn("x", F.col("id") * 3)
    v = lambda d: governance.source_version(d).first()[0]
    assert v(df) == v(df.orderBy(F.desc("id")).repartition(3)) != v(df.withColumn("x", F.col("id")))


def test_labels(spark):
    assert one(spark, dims.label(F.lit("21"), dims.PROCESSES))["en"] == "registry record closed"
    assert one(spark, dims.label(F.lit("x"), dims.PROCESSES))["ja"] == dims.UNKNOWN
    assert one(spark, dims.label_or_null(F.lit(" "), dims.CLOSE_CAUSES)) is None


@pytest.mark.parametrize(("kind", "name", "withheld"), [("499", "山田太郎", True), ("401", "佐藤花子", True), ("301", "山田太郎商店", False), ("301", "山田太郎", False),
                                                         ("499", "山田太郎商店", False), ("499", "架空地区自治会連合協議会", False), ("499", "木村太郎", True), ("499", "市川　花子", True),
                                                         ("499", "Ｆｏｏ Ｉｎｃ．", False), ("499", " ", False)])
def test_guard_names(spark, kind, name, withheld):
    df = spark.createDataFrame([(kind, name)], "kind_code string, name string")
    row = masking.guard_names(df, [k[0] for k in dims.KINDS if k[3]]).first()
    assert row.name_withheld is withheld and (row.name is None) is withheld


def test_allowed_columns(spark):
    df = spark.range(1).select(F.lit("1").alias("corporate_number"), F.lit("x").alias("street_number"), F.lit("n").alias("name"))
    assert masking.project_allowed(df).columns == ["corporate_number", "name"]
    with pytest.raises(ValueError, match="street_number"):
        masking.assert_allowed(df)
    for bad in ("contact_person", "代表取締役", "E-Mail", "birth_date"):
        with pytest.raises(ValueError, match="personal"):
            masking.assert_no_registry_persons(df.withColumn(bad, F.lit("")))
    assert masking.assert_no_registry_persons(df.withColumn("change_cause", F.lit(""))) is not None
    assert masking.drop_personal_columns(df.withColumn("担当者", F.lit(""))).columns == df.columns
    with pytest.raises(ValueError, match="origin"):
        masking.assert_classified(df, {"name": "registry"})


def test_text_rules(spark):
    x = lambda e: one(spark, e)
    assert x(scalars.title_key(F.lit("医療法人社団 Ａ会（東京）"))) == "a会東京"
    assert x(scalars.title_key(F.lit("株式会社{Foo}［B］"))) == "foob"
    assert x(scalars.era_to_date(F.lit("明治３５年１月２日"))) == dt.date(1902, 1, 2)
    assert x(scalars.is_japan(F.lit("Japantown, Tokyo"))) is False and x(scalars.is_japan(F.lit("ＪＡＰＡＮ"))) is True
    assert x(scalars.japan_prefecture(F.lit("札幌 or Shibuya"))) == "東京都" and x(scalars.japan_prefecture(F.lit("Kobe / 神奈川県"))) == "神奈川県"
    assert x(scalars.employment_type(F.lit("正社員 / contract"))) == "contract" and x(scalars.employment_type(F.lit("Ｆｕｌｌ－ｔｉｍｅ"))) == "full_time"
    assert x(scalars.function_bucket(F.lit("Engineering Manager"))) == "engineering" and x(scalars.function_bucket(F.lit("x"))) == "other"
    assert x(scalars.normal_title(F.lit("【急募】Sales／Engineer (Tokyo) – 東京"))) == "sales engineer 東京"
    for error, word in (("x -> HTTP 404", "removed"), ("x -> HTTP 429", "transient"), ("x -> HTTP 503", "transient"), ("fetch failed for x: timed out", "transient"),
                        ("robots.txt disallows x", "robots"), ("HTTP 404 for robots.txt", "robots"), (None, "network")):
        assert word in x(scalars.likely_cause(F.lit(error).cast("string"))), error
    a, b = F.create_map(F.lit("x"), F.lit(1).cast("long")), F.create_map(F.lit("x"), F.lit(2).cast("long"), F.lit("y"), F.lit(3).cast("long"))
    assert x(scalars.map_sum(a, b)) == {"x": 3, "y": 3} and x(scalars.map_max(a, b)) == {"x": 2, "y": 3}
    assert x(scalars.map_sum(F.lit(None).cast("map<string,long>"), a)) == {"x": 1}
    assert x(scalars.union_names(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("b"), F.lit("c")))) == ["a", "b", "c"]
    assert x(scalars.millis_to_ts(F.lit("1700000000000"))) == dt.datetime(2023, 11, 14, 22, 13, 20) and x(scalars.millis_to_ts(F.lit("x"))) is None
    assert x(scalars.site_roots(F.lit("see https://a.example/x, https://a.example/y; http://b.example"))) == ["https://a.example", "http://b.example"]
    assert x(scalars.directive_lines(F.lit("User-Agent: X # c\n\n# only\nDISALLOW:/a"))) == ["user-agent: X", "disallow: /a"]
    for url, want in (("https://h/a/../b", "https://h/b"), ("https://h/../x/./y?q=..", "https://h/x/y?q=.."), ("https://h/a/b/..", "https://h/a/"), ("mailto:x", "mailto:x"), ("https://h/a.b", "https://h/a.b")):
        assert x(governance.without_dots(F.lit(url))) == want, url
    assert x(governance.json_values(F.lit('{"a": "x", "b": ["y\\"z", 1]}'))) == 'x\ny\\"z'


def test_merge_registry(spark):
    """Known boards keep their status; only an active one that a fresh result disqualifies goes out of use."""
    rows = [("greenhouse", "gone", "inactive", "2026-10-10", "404", "2026-09-21"), ("lever", "cand", "candidate", "2026-10-10", "proposed", "2026-09-21"), ("lever", "nojp", "active", None, None, "2026-09-21"),
            ("lever", "cached", "", None, None, "2026-09-21"), ("lever", "late", "active", None, None, "2026-12-01")]
    old = spark.createDataFrame(rows, "ats string, board_token string, status string, status_checked_on string, status_reason string, checked_on string")
    rebuilt = spark.createDataFrame([("greenhouse", "gone", "2026-10-11"), ("lever", " cand", "2026-10-11"), ("lever", "brandnew", "2026-10-11")], "ats string, board_token string, checked_on string")
    results = spark.createDataFrame([("lever", "nojp", "no_japan_postings", "2026-10-11"), ("lever", "cached", "unchanged", "2026-10-11"), ("lever", "late", "not_found", "2026-10-11")],
                                    "ats string, board_token string, status string, checked_on string")
    out = {r.board_token: r for r in postings.merge_registry(old, rebuilt, results).collect()}
    assert {k: r.status for k, r in out.items()} == {"gone": "inactive", "cand": "candidate", "brandnew": "active", "nojp": "inactive", "cached": "", "late": "active"}
    assert out["gone"].status_reason == "404" and out["nojp"].status_reason == "check: no_japan_postings" and out["nojp"].status_checked_on == "2026-10-11"


def test_active_boards_and_lists(spark):
    boards = spark.createDataFrame([("a", "x", " Active "), ("a", "y", None), ("a", "z", "inactive")], "ats string, board_token string, status string")
    assert {r.board_token for r in postings.active_boards(boards).collect()} == {"x", "y"}
    left = masking.purge_blocked(boards, boards.where("board_token = 'x'"))
    assert {r.board_token for r in left.collect()} == {"y", "z"}
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "line string")
    assert sorted(map(tuple, governance.line_changes(lines("a", "b", "b"), lines("b", "c")).collect())) == [("a", "removed"), ("b", "removed"), ("c", "added")]
    governance.assert_fresh(lines("a", "b"), lines("b", "a"))
    with pytest.raises(ValueError, match="differs"):
        governance.assert_fresh(lines("a"), lines("a", "a"))


def test_listings(spark):
    html = "doDownload('successful_bid_record_info_all_2024.zip') doDownload('successful_bid_record_info_diff_20261009.zip') doDownload('successful_bid_record_info_all_2024.zip')"
    rows = governance.award_listing(spark.createDataFrame([(1, html)], "page_id int, html string")).collect()
    assert sorted((r.file_key, r.kind, r.fiscal_year) for r in rows) == [("2026-10-09", "diff", None), ("FY2024", "all", 2024)]
    row = '<tr class="type1_corpHistory1"><th scope="row"> 令和８年10月９日 </th><td><a href="#" onclick="return doDownload({});">zip <b>132KB</b></a></td></tr>'
    page = row.format(1) + '<h2 id="csv-unicode">x</h2>' + row.format(2) + '<h2 class="title" id="xml-unicode">' + row.format(3)
    rows = governance.diff_listing(spark.createDataFrame([(1, page), (2, "none")], "page_id int, html string")).collect()
    assert [(r.day, r.file_no, r.label, r.size) for r in rows] == [(dt.date(2026, 10, 9), "2", "zip 132KB", "132KB")]


def test_searches(spark):
    rows = [(2024, "東京都", "13", "防衛"), (2024, "京都府", "26", "外交"), (2024, "北海道", "01", "財務・金融")]
    stats = spark.createDataFrame(rows, "fiscal_year int, prefecture string, prefecture_code string, sector string")
    found = lambda q: sorted(r.prefecture for r in queries.resolve(stats, q, "prefecture", "prefecture_code").collect())
    assert found("１３") == ["東京都"] and found("1") == ["北海道"] and found("京都") == ["京都府", "東京都"] and found("東京都千代田区") == ["東京都"] and found("x") == []
    with pytest.raises(ValueError, match="外交, 財務・金融, 防衛"):
        queries.resolved(stats, "nothing", "sector")
    assert queries.resolved(stats, "金融", "sector").first().sector == "財務・金融"


def test_pending_and_axes(spark):
    days = spark.createDataFrame([(dt.date(2026, 1, d),) for d in (1, 2, 3)], "day date")
    held = spark.createDataFrame([(dt.date(2026, 1, 2), "private")], "day date, origin string")
    assert [r.day.day for r in registry.pending(days, held, newest=True).collect()] == [3, 1] and [r.day.day for r in registry.pending(days, held, most=1).collect()] == [1]
    daily = spark.createDataFrame([(dt.date(2026, 1, 1), "total", "", 5), (dt.date(2026, 1, 1), "process", "01", 5), (dt.date(2026, 1, 2), "total", "", 2)], "day date, axis string, key string, n long")
    with pytest.raises(ValueError, match="2026-01-02"):
        registry.require_axis(daily, "process")
    assert registry.require_axis(daily.where("day = '2026-01-01'"), "process").count() == 2
    assert [(r.state, r.place) for r in registry.retention_state(days, oldest="2026-01-02").orderBy("place").collect()] == [("next_to_go", 1), ("next_to_go", 2), ("gone", 3)]
    cells = spark.createDataFrame([(2025, "b", "x", 1, 0), (2024, "b", "x", 0, 1), (2025, "a", "x", 0, 0)], "fiscal_year int, sector string, prefecture string, prefecture_idx int, sector_idx int")
    assert [(r.fiscal_year, r.sector) for r in awards.order_stats(cells).collect()] == [(2024, "b"), (2025, "a"), (2025, "b")]
    assert [(r.fiscal_year, r.sector) for r in awards.order_compact(cells).collect()] == [(2024, "b"), (2025, "a"), (2025, "b")]


def test_audits(spark):
    must = {"source": "出典", "notice": "(?i)加工|modified"}
    docs = spark.createDataFrame([(1, "出典：x", False), (2, "about 313,568 awards", False), (3, "about 1313568 awards or 404", False), (4, '{"modified": "no", "n": "313568"}', True),
                                  (5, '{"a": "出典：x, modified", "n": 313568}', True), (6, None, False)], "doc_id int, text string, js boolean")
    rows = governance.audit_surfaces(docs, ["出典："], must, [313568, 404], F.col("js")).collect()
    assert sorted(map(tuple, rows)) == [(1, "notice"), (2, "notice"), (2, "source"), (4, "notice"), (4, "source")]
    pages = spark.createDataFrame([(1, "data", '{"@type":"Dataset"}'), (2, "data", "x" * 50), (3, "article", '"@type":"Article"'), (4, "other", None)], "page_id int, page_class string, html string")
    found = governance.audit_classes(pages, {"data": {"no_dataset": '"@type":"(Dataset|DataCatalog)"'}, "article": {"no_article": '"@type":"Article"', "no_button": 'data-intent="'}})
    assert sorted(map(tuple, found.collect())) == [(2, "no_dataset"), (3, "no_button")]
    assert tuple(governance.audit_size(pages, 60).first()) == (86, 2, 50, True) and governance.audit_size(pages.where("false")).first().total_bytes == 0


def test_provenance_of_ok_files(spark):
    raw = spark.createDataFrame([("f1", 1), ("f1", 2), ("f2", 3)], "file_key string, x int")
    rows = spark.createDataFrame([("2024-05-01", 1)], "award_date string, x int")
    cells = spark.createDataFrame([(2024, "s", 2)], "fiscal_year int, sector string, n_awards_suppressed_in_group long")
    manifest = spark.createDataFrame([("f1", "ok", "2026-01-01"), ("f2", "failed", "2026-01-02")], "file_key string, status string, retrieved_at string")
    out = awards.award_provenance(raw, rows, cells, manifest).first()
    assert (out.records_parsed, out.records_normalized, out.records_deduplicated, out.n_held_back, out.retrieved_at) == (2, 1, 1, 2, "2026-01-01")
    links = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (1, "b", "x")], "page_id int, target string, title string")
    assert governance.link_lines(links).first().lines == ["a | y", "b | x"]
    days = spark.createDataFrame([(1, 5, 9, "2026-01-03")], "day int, records_raw long, raw_bytes long, retrieved_at string")
    daily = spark.createDataFrame([(1, "total", "", 4)], "day int, axis string, key string, n long")
    assert registry.coverage(days, daily).first().retrieved_at == "2026-01-03"


def spread_cells(spark, n=400):
    low = (F.col("id") * 7919 % 1000).alias("amount_min_jpy")
    wide = F.col("id") % 5 * 40
    return spark.range(n).select("id", low, *[(low + wide * k).alias(c) for k, c in ((1, "amount_q1_jpy"), (2, "amount_median_jpy"), (3, "amount_q3_jpy"), (5, "amount_max_jpy"))], (F.col("id") % 9 + 1).alias("n_awards"))


def windows_of(df):
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if " Window " in f" {line.lstrip(' :+-')}" and "windowspecdefinition" in line]


def test_sums_over_ranges(spark):
    """Without groups, running sums go by ranges: the same figures as in one group, and no window over a whole table."""
    cells = spread_cells(spark)
    by_range = pooled_quantile(cells, [])
    in_one = pooled_quantile(cells.withColumn("g", F.lit(1)), ["g"]).drop("g")
    a, b = by_range.first(), in_one.first()
    assert a.n_cells == b.n_cells == 400 and all(abs(a[c] - b[c]) < 1e-6 for c in ("q25", "q50", "q75"))
    assert pooled_quantile(cells.where("id < 0"), []).first().q50 is None

    values = spark.range(500).select((F.col("id") * 37 % 101).alias("v")).unionByName(spark.createDataFrame([(None,)], "v long"))
    ordered = sorted(r.v for r in values.where("v is not null").collect())
    cuts = [ordered[min(len(ordered) - 1, len(ordered) * k // 6)] for k in range(1, 6)]
    classed = reports.sextile_class(values, "v")
    assert all(r["class"] == (0 if r.v is None else 1 + sum(c <= r.v for c in cuts)) for r in classed.collect())

    rows = spark.range(300).select((F.col("id") * 13 % 300).alias("k"), F.concat(F.lit("p"), F.col("id") % 40).alias("p"))
    coded = awards.encode_dictionary(rows, ["p"], ["k"])
    first: dict = {}
    for r in sorted(rows.collect()):
        first.setdefault(r.p, len(first))
    assert all(first[r.p] == r.p_idx for r in coded.collect())
    for df in (by_range, classed, coded):
        assert all("range_" in line for line in windows_of(df))


def test_headline_figures_in_texts(spark):
    texts = ["In all 12,345 rows.", "id 12345!", "x123456", "1,12,345", "9,123,45", "12,3456", "999", "no", None, "7,000,000", "7000000.5", "٣ 12345"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    figures = [12345, 999, 7_000_000]
    table = spark.createDataFrame([(f,) for f in figures], "figure long")
    joined = {r.doc_id for r in governance.shows_figure(docs, table).collect()}
    pattern = {r.doc_id for r in docs.where(F.col("text").rlike(governance.figure_pattern(figures))).collect()}
    assert joined == pattern == {0, 1, 9, 10, 11}
    must = {"licence": "CC", "notice": "(?i)modified"}
    a = sorted(map(tuple, governance.audit_surfaces(docs, [], must, figures).collect()))
    assert a == sorted(map(tuple, governance.audit_surfaces(docs, [], must, table).collect())) and len(a) == 10


def test_clear_meets_keys_by_equality(spark):
    sources = ["site-1;", "site-12;", "x site-1; site-1;", "", "日本データ", None, "ab", "aab"]
    matrix = spark.createDataFrame([(s, "Y" if k % 2 else "unclear", "Y" if k % 3 else None) for k, s in enumerate(sources)], "source string, reuse_allowed string, robots_ok string")
    keys = ["site-1", "site-1;", "", "本デ", "zz", None, "a", "ab", "a"]
    rows = [(f"d{k}", key, k % 2 == 0, False) for k, key in enumerate(keys)] + [("d1", "site-1;", False, False)]
    sets = spark.createDataFrame(rows, "dataset string, key string, prototype boolean, hold boolean")
    out = governance.clear(sets, matrix)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastNestedLoopJoin BuildRight, Inner", "")  # lengths of keys are one row
    twice = lambda d: 2 if d == "d1" else 1
    want = {d: twice(d) * sum(k is not None and s is not None and k in s for s in sources) for d, k, _, _ in rows}
    assert {r.dataset: r.n_rows for r in out.collect()} == want


def test_check_digit_matches_digit_sums(spark):
    bodies = [f"{(k * 7919 ** 3) % 10 ** 12:012d}" for k in range(300)] + ["12345678901", "1234567890１2", "+12345678901", "", None]

    def digit(b):
        if b is None or len(b) < 12 or not (b.isascii() and b.isdigit()):
            return None
        return 9 - sum(int(b[12 - n]) * (1 if n % 2 else 2) for n in range(1, 13)) % 9

    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    assert [r.d for r in df.select(scalars.check_digit(F.col("b")).alias("d")).collect()] == [digit(b) for b in bodies]


def test_masked_winners_are_not_one_task(spark):
    rows = spark.range(4000).select(F.col("id").alias("arrival"), F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("corporate_number"))
    lookup = spark.createDataFrame([("4", "13", "東京都"), (None, "01", "北海道"), ("-7", "02", "青森県")], "corporate_number string, prefecture_code string, prefecture string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        out = awards.enrich_prefecture(rows, lookup)
        assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) < 1000
        assert out.columns == ["arrival", "corporate_number", "prefecture_code", "prefecture"]
        assert {r.arrival for r in out.where("prefecture_code <> ''").collect()} == {4} and out.count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_masking_works_a_number_out_once(spark):
    df = spark.createDataFrame([("n", "1010001005145"), ("m", "x")], "winner_name string, corporate_number string")
    plan = masking.mask_winners(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") <= 2
    assert [r.corporate_number for r in masking.mask_winners(df).collect()] == ["1010001005145", None]


def test_packed_text_comes_back(spark):
    texts = ["0a" * 20, "0A" * 20, "abc", "ab", "ab\n", "zz", "日本", "\x01", "\u00ab", "", None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string").withColumn("b", scalars.packed(F.col("x")))
    rows = df.withColumn("y", scalars.unpacked(F.col("b"))).orderBy("k").collect()
    assert [r.y for r in rows] == texts and len(rows[0].b) == 21
    assert len({bytes(r.b) for r in rows if r.b is not None}) == len(texts) - 1


def test_dedup_of_awards(spark):
    rows = [(2024, "ab", 1, "y"), (2024, "ab", 2, "x"), (2024, "ab", 2, "w"), (2024, "Ab", 1, "a"), (2025, "ab", 1, "b"), (2024, None, None, "c"), (2024, None, 3, None), (2024, "", 5, "d")]
    df = spark.createDataFrame(rows, "fiscal_year int, award_id string, arrival long, raw_hash string")
    want = {(2024, "ab", 2, "x"), (2024, "Ab", 1, "a"), (2025, "ab", 1, "b"), (2024, None, 3, None), (2024, "", 5, "d")}
    out = awards.dedup_awards(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert {tuple(r) for r in out.collect()} == want and out.count() == len(want)
    short = awards.dedup_awards(df, ties=False).select("fiscal_year", "award_id", "arrival")
    assert {tuple(r) for r in short.collect()} == {r[:3] for r in want} and short.count() == len(want)
    numbered = df.withColumn("award_id", F.lit(7))
    assert awards.dedup_awards(numbered).dtypes == numbered.dtypes


def _exchanges(df):
    """Columns of the rows that each exchange of a plan without broadcasts moves."""
    conf, plan, found = df.sparkSession.conf, None, []
    before = {k: conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false"), strict=True):
            conf.set(k, v)
        plan = df.select("*")._jdf.queryExecution().executedPlan()
    finally:
        for k, v in before.items():
            conf.set(k, v)
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append([f"{c.name()} {c.dataType().simpleString()}" for c in (node.output().apply(i) for i in range(node.output().size()))])
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_award_dedup_moves_short_rows(spark):
    moved = _exchanges(registered.queries()["award_dedup"](spark, "/root/testdata/sf0.001"))
    assert [sorted(x) for x in moved if any(c.startswith("award_id ") for c in x)] == [["amount_jpy bigint", "arrival bigint", "award_id binary", "fiscal_year int"]]


def test_items_of_awards_are_not_dealt_by_customer(spark):
    moved = _exchanges(bindings.raw_awards(spark, "/root/testdata/sf0.001"))
    assert any("o_custkey bigint" in x for x in moved)
    assert not any("o_custkey bigint" in x and "l_orderkey bigint" in x for x in moved)
