"""Registry changes: normalisation, deduplication, daily and weekly summaries, lookups and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions import dims, scalars
from tallyline.operators.masking import assert_no_personal_columns, guard_names

#: Axes of the daily counts: name, column, label of blanks (None: blanks are left out).
AXES = [("process", "process_code", "unknown"), ("kind", "kind_code", "unknown"), ("prefecture", "prefecture", None)]
KEY = ["file_month", "corporate_number", "change_date", "sequence_number"]


def normalize_changes(raw: DataFrame, provenance: dict[str, str] | None = None) -> DataFrame:
    """Changes with validity flag, record key, file month and row hash; blank text becomes null."""
    rows = assert_no_personal_columns(raw)
    rows = rows.withColumn("raw_hash", scalars.row_hash(*[F.col(c) for c in raw.columns]))
    text = [c for c, kind in raw.dtypes if kind == "string"]
    rows = rows.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in text})
    rows = rows.withColumn("corporate_number_valid", F.when(scalars.check_digit_valid(F.col("corporate_number")), "Y").otherwise("N"))
    rows = rows.withColumn("record_key", scalars.record_key(F.col("corporate_number"), F.col("change_date"), F.col("sequence_number")))
    rows = rows.withColumn("file_month", F.date_format("file_date", "yyyy-MM"))
    return rows.withColumns({c: F.lit(v) for c, v in (provenance or {}).items()})


def dedup_changes(df: DataFrame, key: list[str] | None = None, arrival: str = "arrival") -> DataFrame:
    """One row per key: the first correction, else the first arrival."""
    w = Window.partitionBy(*(key or KEY)).orderBy(F.col("correct_flag").desc(), F.col(arrival).asc())
    return df.withColumn("n_", F.row_number().over(w)).where("n_ = 1").drop("n_")


def dedup_effect(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """Per day: raw and deduplicated counts and their difference."""
    a = raw.groupBy("file_date").agg(F.count("*").alias("records_raw"))
    b = kept.groupBy("file_date").agg(F.count("*").alias("records"))
    joined = a.join(b, "file_date", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    return joined.withColumn("dropped", F.col("records_raw") - F.col("records"))


def newest_first() -> list:
    """Order of a number's changes, newest first; a correction precedes what it corrects."""
    return [F.desc("change_date"), F.desc("sequence_number"), F.desc("correct_flag"), F.asc("arrival")]


def rank_changes(df: DataFrame) -> DataFrame:
    return df.withColumn("change_rank", F.row_number().over(Window.partitionBy("corporate_number").orderBy(*newest_first())))


def corporate_lookup(changes: DataFrame, numbers: DataFrame | None = None, history: int = 20) -> DataFrame:
    """Per valid number: its name, kind, address and latest change, the number of changes, and the newest ``history`` (0 to 100) of them.

    ``numbers`` (a column corporate_number) restricts to some: a semi-join, so any number of lookups is one job. A history is at most
    100 small structs, newest first; older changes are only counted.
    """
    rows = changes.where(F.coalesce(F.col("corporate_number_valid"), F.lit("")) != "N")
    if numbers is not None:
        rows = rows.join(numbers.select("corporate_number").distinct(), "corporate_number", "left_semi")
    rows = rank_changes(guard_names(rows, [k[0] for k in dims.KINDS if k[3]]))
    n = max(0, min(100, history))
    first = F.col("change_rank") == 1
    place = [c for c in ("prefecture", "prefecture_code", "city") if c in rows.columns]
    entry = F.struct("change_rank", "change_date", "sequence_number", "process_code", "kind_code", "name", *place)
    return rows.groupBy("corporate_number").agg(
        F.count("*").alias("n_changes"), *[F.max(F.when(first, F.col(c))).alias(f"latest_{c}") for c in ("change_date", "process_code", "kind_code", "name", *place)],
        F.count_if(F.col("change_rank") <= n).alias("n_history"), F.array_sort(F.collect_list(F.when(F.col("change_rank") <= n, entry))).alias("history"),
    )


def lookup_results(found: DataFrame, numbers: DataFrame, counts: DataFrame) -> DataFrame:
    """A row for each number asked for: whether it is valid and found, what :func:`corporate_lookup` gives of it, and the days covered."""
    asked = numbers.select("corporate_number").distinct()
    covered = counts.agg(F.min("day").alias("covered_from"), F.max("day").alias("covered_to"), F.countDistinct("day").alias("days_with_data"))  # one row
    rows = asked.join(found, "corporate_number", "left").join(F.broadcast(covered))
    valid = scalars.check_digit_valid(F.col("corporate_number"))
    return rows.withColumns({"checksum_valid": valid, "found": F.col("n_changes").isNotNull(), "n_changes": F.coalesce("n_changes", F.lit(0))})


def change_history(changes: DataFrame, number: str, history: int = 20) -> DataFrame:
    """The newest changes of one number in their public shape; the filter reaches the scan."""
    rows = changes.where((F.col("corporate_number") == number) & (F.coalesce(F.col("corporate_number_valid"), F.lit("")) != "N"))
    return shape_changes(rank_changes(guard_names(rows, [k[0] for k in dims.KINDS if k[3]])).where(F.col("change_rank") <= max(0, min(100, history))))


# Fixed value: why a name is withheld.
MASKED_REASON = "masked: 法人種別 is not a registered corporation and the name carries no corporate token (fail-closed personal-data guard)"


def shape_changes(df: DataFrame) -> DataFrame:
    """The public nested shape: labels as structs, flags as booleans, blanks as null. Columns that ``df`` lacks are null."""
    given = lambda c, kind="string": F.col(c) if c in df.columns else F.lit(None).cast(kind)
    text = lambda c: F.nullif(F.trim(given(c).cast("string")), F.lit("")).alias(c)
    flag = lambda c: F.coalesce(given(c).cast("string").isin("1", "true"), F.lit(False))
    return df.select(
        "corporate_number", "change_date", given("update_date", "date").alias("update_date"), given("file_date", "date").alias("file_date"), "sequence_number",
        flag("correct_flag").alias("is_correction"), dims.label(F.col("kind_code"), dims.KINDS).alias("kind"),
        dims.label(F.col("process_code"), dims.PROCESSES).alias("process"), "name", "name_withheld",
        F.when(F.col("name_withheld"), MASKED_REASON).alias("name_masked_reason"), text("prefecture"), text("prefecture_code"), text("city"),
        given("close_date", "date").alias("close_date"), dims.label_or_null(given("close_cause"), dims.CLOSE_CAUSES).alias("close_cause"),
        text("successor_corporate_number"), flag("latest_flag").alias("latest_flag"),
    )


def daily_counts(changes: DataFrame) -> DataFrame:
    """day, axis, key, n: per day the total and the counts by process, kind and prefecture, in one pass over grouping sets."""
    keyed = changes.select(
        F.col("file_date").alias("day"),
        *[(F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(blank or "")).alias(name)) for name, c, blank in AXES],
    )
    sets = keyed.groupingSets([["day"], ["day", "process"], ["day", "kind"], ["day", "prefecture"]], "day", "process", "kind", "prefecture")
    rows = sets.agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    axis = F.when(F.col("g") == 7, "total").when(F.col("g") == 3, "process").when(F.col("g") == 5, "kind").otherwise("prefecture")
    rows = rows.select("day", axis.alias("axis"), F.coalesce("process", "kind", "prefecture", F.lit("")).alias("key"), "n")
    return rows.where((F.col("axis") != "prefecture") | (F.col("key") != ""))


def day_summary(daily: DataFrame) -> DataFrame:
    """The nested form: one row a day with its total and a map of counts for each axis."""
    maps = [
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("axis") == name, F.struct("key", "n"))))).alias(f"{name}_counts") for name, _, _ in AXES
    ]
    return daily.groupBy("day").agg(F.sum(F.when(F.col("axis") == "total", F.col("n"))).alias("records"), *maps)


def merge_summary(old: DataFrame, new: DataFrame) -> DataFrame:
    """Day rows of both, the new one where both have a day."""
    cols = [c for c in new.columns if c != "day"]
    a, b = old.select("day", F.struct(*cols).alias("o")), new.select("day", F.struct(*cols).alias("n"))
    joined = a.join(b, "day", "full_outer").withColumn("x", F.coalesce("n", "o"))
    return joined.select("day", *[F.col(f"x.{c}").alias(c) for c in cols])


def calendar(spark: SparkSession, low: str, high: str) -> DataFrame:
    """Every day of a range; ranges that are reversed or beyond 400 days are refused."""
    import datetime as dt

    a, b = dt.date.fromisoformat(low), dt.date.fromisoformat(high)
    if not 0 <= (b - a).days <= 400:
        raise ValueError("the range must run forwards and span at most 400 days")
    return spark.range(1).select(F.explode(F.sequence(F.lit(a), F.lit(b), F.expr("interval 1 day"))).alias("day"))


def diff_summary(counts: DataFrame, low: str, high: str) -> DataFrame:
    """One row for a range of days: days, days with and without a file, total, and the mean of published days (half up).

    A day without a file is missing, not zero.
    """
    joined = calendar(counts.sparkSession, low, high).join(counts.select("day", "n"), "day", "left")
    with_file = F.count("n")
    return joined.agg(
        F.count("*").alias("days"), with_file.alias("days_with_file"), (F.count("*") - with_file).alias("days_without_file"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), scalars.round_half_up(F.sum("n") / with_file).alias("mean_per_published_day"),
    )


def diff_days(daily: DataFrame, low: str, high: str, by_kind: bool = True) -> DataFrame:
    """The published days of a range: day, changes and, if asked for, a map of changes by process code."""
    calendar(daily.sparkSession, low, high)  # refuses what it refuses
    rows = daily.where(F.col("day").between(F.lit(low).cast("date"), F.lit(high).cast("date")))
    each = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("axis") == "process", F.struct("key", "n")))))
    out = rows.groupBy("day").agg(F.sum(F.when(F.col("axis") == "total", F.col("n"))).alias("changes"), each.alias("by_process"))
    return out if by_kind else out.drop("by_process")


def scan_fill(manifest: DataFrame, scanned: DataFrame) -> DataFrame:
    """Counts by day from the manifest, from a scan where it has none."""
    a, b = manifest.select("day", F.col("n").alias("m")), scanned.select("day", F.col("n").alias("s"))
    return a.join(b, "day", "full_outer").select("day", F.coalesce("m", "s").alias("n"), F.col("m").isNull().alias("from_scan"))


def coverage(manifest: DataFrame, daily: DataFrame) -> DataFrame:
    """One row: first and last day, days, records raw and kept, their difference, bytes, and the latest retrieval if the manifest tells it."""
    kept = daily.where("axis = 'total'").select("day", F.col("n").alias("records"))
    joined = manifest.join(kept, "day", "left")
    out = joined.agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.sum("records_raw").alias("records_raw"), F.sum("raw_bytes").alias("raw_bytes"),
        *([F.max("retrieved_at").alias("retrieved_at")] if "retrieved_at" in manifest.columns else []),
    )
    return out.withColumn("dropped", F.col("records_raw") - F.col("records"))


def totals_by_code(daily: DataFrame) -> DataFrame:
    """axis, key, n over all days: what a coverage record holds beside its counts."""
    return daily.where("axis <> 'total'").groupBy("axis", "key").agg(F.sum("n").alias("n"))


def daily_by_process(daily: DataFrame, main: list[str]) -> DataFrame:
    """Per day one column for each main process code and one for the others."""
    rows = daily.where("axis = 'process'")
    parts = [F.coalesce(F.sum(F.when(F.col("key") == c, F.col("n"))), F.lit(0)).alias(f"n_{c}") for c in main]
    return rows.groupBy("day").agg(*parts, F.coalesce(F.sum(F.when(~F.col("key").isin(main), F.col("n"))), F.lit(0)).alias("n_other"))


def process_means(daily: DataFrame, main: list[str]) -> DataFrame:
    """One row: the mean per published day of each column of :func:`daily_by_process`, to one place."""
    rows = daily_by_process(daily, main)
    return rows.agg(*[F.bround(F.avg(c), 1).alias(c.replace("n_", "mean_", 1)) for c in rows.columns if c != "day"])


def code_ranking(daily: DataFrame, axis: str, table: list[tuple], low: str | None = None, high: str | None = None) -> DataFrame:
    """A ranking with labels, the mean per published day (one place) and the latest day's count beside each code."""
    ranked = ranking(daily, axis, low, high)
    total = daily.where("axis = 'total'").agg(F.countDistinct("day").alias("days"), F.max("day").alias("latest_day"))  # one row
    rows = daily.where(F.col("axis") == axis).join(F.broadcast(total))
    extra = rows.groupBy("key").agg(
        F.bround(F.sum("n") / F.max("days"), 1).alias("mean_per_day"), F.coalesce(F.sum(F.when(F.col("day") == F.col("latest_day"), F.col("n"))), F.lit(0)).alias("n_latest_day"),
        F.max("latest_day").alias("latest_day"),
    )
    label = dims.label(F.col("key"), table)
    return ranked.join(extra, "key").withColumns({"ja": label["ja"], "en": label["en"]})


def require_axis(daily: DataFrame, axis: str) -> DataFrame:
    """``daily`` itself; raises if some day has a total but no count on an axis."""
    lacking = daily.where("axis = 'total' and n > 0").select("day").join(daily.where(F.col("axis") == axis).select("day").distinct(), "day", "left_anti")
    if days := [str(r.day) for r in lacking.orderBy("day").limit(5).collect()]:
        raise ValueError(f"days without counts by {axis}: {days}")
    return daily


def ranking(daily: DataFrame, axis: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """key, n, share of all records (4 places), rank for one axis over a period; blank keys share in the total only."""
    rows = daily
    if low is not None:
        rows = rows.where(F.col("day") >= F.lit(low).cast("date"))
    if high is not None:
        rows = rows.where(F.col("day") <= F.lit(high).cast("date"))
    total = rows.where("axis = 'total'").agg(F.sum("n").alias("all"))
    counts = rows.where(F.col("axis") == axis).groupBy("key").agg(F.sum("n").alias("n")).join(F.broadcast(total))
    order = Window.orderBy(F.desc("n"), "key")  # one row a key
    return counts.select("key", "n", F.bround(F.col("n") / F.col("all"), 4).alias("share"), F.row_number().over(order).alias("rank"))


def weekly_summary(daily: DataFrame, codes: list[str]) -> DataFrame:
    """Per ISO week: key, Monday, Sunday, total, publication days, and the count of each process code."""
    week = F.date_trunc("week", "day").cast("date")
    rows = daily.where("axis in ('total', 'process')").withColumn("monday", week)
    out = rows.groupBy("monday").agg(
        F.sum(F.when(F.col("axis") == "total", F.col("n"))).alias("total"), F.count_if(F.col("axis") == "total").alias("days"),
        *[F.coalesce(F.sum(F.when((F.col("axis") == "process") & (F.col("key") == c), F.col("n"))), F.lit(0)).alias(f"n_{c}") for c in codes],
    )
    year = F.extract(F.lit("YEAROFWEEK"), "monday")
    key = F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear("monday").cast("string"), 2, "0"))
    return out.withColumn("week", key).withColumn("sunday", F.date_add("monday", 6))


def pending(listing: DataFrame, held: DataFrame, backfill: bool = False, most: int | None = None, newest: bool = False) -> DataFrame:
    """Listed days of which no file is held, oldest (or ``newest``) first. ``held``: day, origin (private or published); a backfill ignores the published."""
    have = held.where("origin = 'private'") if backfill else held
    out = listing.join(have.select("day").distinct(), "day", "left_anti").orderBy(F.desc("day") if newest else F.asc("day"))
    return out if most is None else out.limit(most)


def retention_state(days: DataFrame, window: int = 40, fade: int = 5, oldest: str | None = None) -> DataFrame:
    """day, place from the newest, state: live, next_to_go (the oldest ``fade`` of the window), gone. An observed oldest day overrides."""
    place = F.row_number().over(Window.orderBy(F.desc("day")))  # one row a publication day
    rows = days.select("day").distinct().withColumn("place", place)
    last = F.lit(window)
    if oldest is not None:
        rows = rows.withColumn("last_", F.max(F.when(F.col("day") >= F.lit(oldest).cast("date"), F.col("place"))).over(Window.partitionBy()))
        last = F.coalesce(F.col("last_"), F.lit(0))
    state = F.when(F.col("place") > last, "gone").when(F.col("place") > last - fade, "next_to_go").otherwise("live")
    return rows.select("day", "place", state.alias("state"))


def fixed_sample(changes: DataFrame, n: int, columns: list[str]) -> DataFrame:
    """The first n valid rows of corporate kinds by file date, number and sequence as text, in allowed columns."""
    corporate = [k[0] for k in dims.KINDS if k[3]]
    rows = changes.where((F.col("corporate_number_valid") == "Y") & F.col("kind_code").isin(corporate))
    return rows.orderBy("file_date", "corporate_number", F.col("sequence_number").cast("string"), "arrival").limit(n).select(*columns)


def feed_items(daily: DataFrame, days: int = 30) -> DataFrame:
    """Per day, newest first: total and a text of its kinds by count."""
    if not 1 <= days <= 120:
        raise ValueError("days must lie between 1 and 120")
    totals = daily.where("axis = 'total'").select("day", F.col("n").alias("total")).orderBy(F.desc("day")).limit(days)
    kinds = daily.where("axis = 'kind'").groupBy("day").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "key"))).alias("k"))
    text = F.array_join(F.transform("k", lambda x: F.concat(x["key"], F.lit(": "), (-x["m"]).cast("string"))), ", ")
    return totals.join(kinds, "day", "left").select("day", "total", F.coalesce(text, F.lit("")).alias("breakdown"))


def plan_refresh(listing: DataFrame, manifest: DataFrame, recorded: DataFrame, forced: list[str] | None = None) -> DataFrame:
    """file_key and the first reason to fetch it again: forced, new, unreadable, stamp_moved, size_moved."""
    m = manifest.select("file_key", F.col("status").alias("m_status"))
    r = recorded.select("file_key", F.col("stamp").alias("r_stamp"), F.col("size_label").alias("r_size"))
    joined = listing.join(m, "file_key", "left").join(r, "file_key", "left")
    reason = (
        F.when(F.col("file_key").isin(forced or []), "forced")
        .when(F.col("m_status").isNull(), "new")
        .when(~F.col("m_status").isin("ok", ""), "unreadable")
        .when(F.col("stamp") != F.col("r_stamp"), "stamp_moved")
        .when(F.col("size_label") != F.col("r_size"), "size_moved")
    )
    return joined.select("file_key", reason.alias("reason")).where("reason is not null")
