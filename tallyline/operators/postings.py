"""Job postings: first-seen state, closing, board health and crawl planning, as joins and windows over logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import scalars

#: What a later sighting refreshes; company fields, function, remote flag and URL stay as first seen.
REFRESHED = ["title", "location", "prefecture", "employment_type"]
#: Dates of the source: overwritten only by values that are there.
SOURCE_DATES = ["created_at", "updated_at"]


def describe(postings: DataFrame) -> DataFrame:
    """Postings with id, place in Japan, kind of employment, remote flag and function."""
    place = F.col("location")
    return postings.select(
        "*", scalars.posting_id(F.col("ats"), F.col("board_token"), F.col("job_id")).alias("posting_id"), scalars.is_japan(place).alias("is_japan"),
        scalars.japan_prefecture(place).alias("prefecture"), scalars.is_remote(place, F.col("title")).alias("remote_flag"),
        scalars.employment_type(F.coalesce("commitment", F.lit(""))).alias("employment_type"), scalars.function_bucket(F.col("title")).alias("function_bucket"),
        scalars.normal_title(F.col("title")).alias("title_normalized"),
    )


def japan_only(postings: DataFrame) -> DataFrame:
    return postings.where(scalars.is_japan(F.col("location")))


def active_boards(boards: DataFrame) -> DataFrame:
    """Boards whose status is active; blank counts as active."""
    status = F.coalesce(F.nullif(F.lower(F.trim("status")), F.lit("")), F.lit("active"))
    return boards.where(status == "active")


def merge_postings(stored: DataFrame, observed: DataFrame, now: Column) -> DataFrame:
    """Stored postings after a sighting: new ids get first_seen_at, known ones are refreshed, reopened and lose their misses."""
    cols = [c for c in stored.columns if c != "posting_id"]
    given = set(observed.columns)
    joined = stored.select("posting_id", F.struct(*cols).alias("s")).join(
        observed.select("posting_id", F.struct(*[c for c in observed.columns if c != "posting_id"]).alias("o")), "posting_id", "full_outer"
    )
    seen, known = F.col("o").isNotNull(), F.col("s").isNotNull()

    def value(c: str) -> Column:
        old = F.col(f"s.{c}")
        new = F.col(f"o.{c}") if c in given else F.lit(None)
        if c == "first_seen_at":
            return F.when(known, old).otherwise(now)
        if c == "last_seen_at":
            return F.when(seen, now).otherwise(old)
        if c == "consecutive_misses":
            return F.when(seen, F.lit(0)).otherwise(old)
        if c == "status":
            return F.when(seen, F.lit("open")).otherwise(old)
        if c == "closed_at":
            return F.when(~seen, old)
        if c in SOURCE_DATES:
            return F.when(seen, F.coalesce(new, old)).otherwise(old)
        if c in REFRESHED:
            return F.when(seen, new).otherwise(old)
        return F.when(known, old).otherwise(new)

    return joined.select("posting_id", *[value(c).alias(c) for c in cols])


def close_missing(stored: DataFrame, outcomes: DataFrame, seen: DataFrame, today: Column) -> DataFrame:
    """Misses and closing after a run.

    On boards crawled well, an open posting not seen has one more miss: the first sets a provisional closed_at, the second closes.
    An unchanged crawl confirms what is open without a miss. Failed crawls change nothing.
    """
    o = outcomes.select("ats", "board_token", "outcome")
    s = seen.select("posting_id").distinct().withColumn("seen_", F.lit(True))
    rows = stored.join(o, ["ats", "board_token"], "left").join(s, "posting_id", "left")
    confirmed = F.col("seen_").isNotNull() | ((F.col("outcome") == "unchanged") & (F.col("consecutive_misses") == 0))
    missed = F.col("outcome").isin("ok", "unchanged") & (F.col("status") == "open") & ~confirmed
    misses = F.col("consecutive_misses") + 1
    new = {
        "status": F.when(missed & (misses >= 2), "closed").otherwise(F.col("status")),
        "closed_at": F.when(missed & (misses == 1), today).otherwise(F.col("closed_at")),
        "consecutive_misses": F.when(missed, misses).otherwise(F.col("consecutive_misses")),
    }
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in stored.columns])


def posting_lifecycle(observations: DataFrame, outcomes: DataFrame) -> DataFrame:
    """First and last sighting, misses and status of every posting from the whole log.

    observations: board, posting, day; outcomes: board, day, outcome. Crawls of a board that went well are numbered; the crawls
    after a posting's last sighting are its misses, and the first two of them close it as of the first.
    """
    crawls = outcomes.where("outcome in ('ok', 'unchanged')").select("board", "day").distinct()
    crawls = crawls.withColumn("k", F.row_number().over(Window.partitionBy("board").orderBy("day")))
    seen = observations.join(crawls, ["board", "day"]).groupBy("board", "posting").agg(F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.max("k").alias("k_last"))
    per_board = crawls.groupBy("board").agg(F.max("k").alias("k_max"))
    following = crawls.select("board", (F.col("k") - 1).alias("k_last"), F.col("day").alias("next_crawl"))
    out = seen.join(per_board, "board").join(following, ["board", "k_last"], "left")
    misses = F.col("k_max") - F.col("k_last")
    return out.select(
        "board", "posting", "first_seen", "last_seen", misses.cast("long").alias("misses"), F.when(misses >= 2, "closed").otherwise("open").alias("status"),
        F.when(misses >= 1, F.col("next_crawl")).alias("closed_at"),
    )


def board_health(outcomes: DataFrame, active: DataFrame, flag_at: int = 3) -> DataFrame:
    """Failure streak of each active board that ends with its last night: length, first and last night, error, flag.

    Several failures of a night count once; any success of a night resets.
    """
    nights = outcomes.groupBy("board", "night").agg(F.max((F.col("outcome") != "failed").cast("int")).alias("good"), F.max("error").alias("error"))
    w = Window.partitionBy("board").orderBy("night")
    island = nights.withColumn("island", F.sum("good").over(w)).withColumn("last_island", F.sum("good").over(Window.partitionBy("board")))
    failed = island.where("island = last_island and good = 0")
    streak = failed.groupBy("board").agg(
        F.count("*").alias("failed_nights"), F.min("night").alias("first_failed"), F.max("night").alias("last_failed"), F.max_by("error", "night").alias("last_error")
    )
    streak = streak.join(active.select("board").distinct(), "board", "left_semi")
    return streak.withColumn("likely_cause", scalars.likely_cause(F.col("last_error"))).withColumn("flagged", F.col("failed_nights") >= flag_at)


def halted_hosts(fetches: DataFrame, at: int = 3) -> DataFrame:
    """Hosts whose log has ``at`` failures in a row, with the instant of the halt (the first such)."""
    w = Window.partitionBy("host").orderBy("ts", "fetch_id")
    rows = fetches.withColumn("island", F.sum(F.when(F.col("ok"), 1).otherwise(0)).over(w)).where(~F.col("ok"))
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("host", "island").orderBy("ts", "fetch_id")))
    return rows.where(F.col("k") == at).groupBy("host").agg(F.min("ts").alias("halted_at"))


def plan_boards(boards: DataFrame, blocked: DataFrame, halted: DataFrame, fetched: DataFrame, cap: int) -> DataFrame:
    """board, host, skip_reason: the first of blocked, gate, host_halted, already_fetched, over_cap that holds, else null."""
    one = lambda df, key, name: df.select(key).distinct().withColumn(name, F.lit(True))
    rows = boards.join(one(blocked, "board", "b_"), "board", "left").join(one(halted, "host", "h_"), "host", "left").join(one(fetched, "board", "f_"), "board", "left")
    reason = (
        F.when(F.col("b_"), "blocked").when(~F.coalesce(F.col("cleared"), F.lit(False)), "gate").when(F.col("h_"), "host_halted").when(F.col("f_"), "already_fetched")
    )
    rows = rows.withColumn("r_", reason)
    w = Window.partitionBy("host", F.col("r_").isNull()).orderBy("board")
    rows = rows.withColumn("k_", F.row_number().over(w))
    return rows.select("board", "host", F.coalesce("r_", F.when(F.col("k_") > cap, "over_cap")).alias("skip_reason"))


def verify_boards(fetches: DataFrame, postings: DataFrame) -> DataFrame:
    """Per board fetched: postings, those in Japan, a location in Japan, and what that makes it."""
    japan = scalars.is_japan(F.col("location"))
    counts = postings.groupBy("board").agg(F.count("*").alias("n"), F.count_if(japan).alias("nj"), F.min(F.when(japan, F.col("location"))).alias("sample_location"))
    rows = fetches.join(counts, "board", "left")
    status = F.when(F.col("outcome") != "ok", F.col("outcome")).when(F.col("nj") > 0, "japan_hiring").when(F.col("n") > 0, "no_japan_postings").otherwise("empty_board")
    return rows.select("board", F.coalesce("n", F.lit(0)).alias("n_postings"), F.coalesce("nj", F.lit(0)).alias("n_japan"), "sample_location", status.alias("status"))


def build_board_registry(results: DataFrame, candidates: DataFrame) -> DataFrame:
    """Boards found to hire in Japan with what the candidates' list says of them."""
    return results.where("status = 'japan_hiring'").join(candidates, "board", "left")


# Results of a check that end a board's use.
NOT_QUALIFYING = ["not_found", "empty_board", "no_japan_postings"]
BOARD = ["ats", "board_token"]


def merge_registry(old: DataFrame, rebuilt: DataFrame, results: DataFrame) -> DataFrame:
    """The registry after a check, keyed by ats and board_token.

    A known board keeps its status, its date and its reason, whatever the check found; a new one is active. A board that the check no
    longer brings stays; if it is active (blank counts so) and its result, not older than its own check, disqualifies it, it becomes
    inactive with that result as the reason. ``old``: BOARD, status, status_checked_on, status_reason, checked_on; ``rebuilt``: BOARD,
    checked_on; ``results``: BOARD, status, checked_on.
    """
    key = [F.trim(c).alias(c) for c in BOARD]
    blank = lambda c: F.coalesce(c, F.lit(""))
    a = old.select(*key, F.struct("status", "status_checked_on", "status_reason", "checked_on").alias("o"))
    b = rebuilt.select(*key, F.struct("checked_on").alias("n"))
    c = results.select(*key, F.col("status").alias("r_status"), F.col("checked_on").alias("r_on"))
    rows = a.join(b, BOARD, "full_outer").join(c, BOARD, "left")
    known, found = F.col("o").isNotNull(), F.col("n").isNotNull()
    in_use = blank(F.nullif(F.lower(F.trim("o.status")), F.lit(""))).isin("", "active")
    newer = blank(F.col("r_on")) >= blank(F.col("o.checked_on"))
    goes = known & ~found & in_use & F.coalesce(F.col("r_status").isin(NOT_QUALIFYING), F.lit(False)) & newer
    return rows.select(
        *BOARD,
        F.when(goes, "inactive").when(found & (blank(F.col("o.status")) == ""), "active").otherwise(F.col("o.status")).alias("status"),
        F.when(goes, F.col("r_on")).otherwise(F.col("o.status_checked_on")).alias("status_checked_on"),
        F.when(goes, F.concat(F.lit("check: "), F.col("r_status"))).otherwise(F.col("o.status_reason")).alias("status_reason"),
        F.coalesce("n.checked_on", "o.checked_on").alias("checked_on"),
    )


def crawl_counters(outcomes: DataFrame, sightings: DataFrame | None = None, closings: DataFrame | None = None) -> DataFrame:
    """Per night: boards attempted, ok, unchanged, failed; postings seen, in Japan, new, closed.

    ``sightings``: night, posting, is_japan, first_seen (the night of its first sighting); ``closings``: night, posting.
    """
    is_ = lambda x: F.count_if(F.col("outcome") == x)
    out = outcomes.groupBy("night").agg(F.count("*").alias("attempted"), is_("ok").alias("n_ok"), is_("unchanged").alias("n_unchanged"), is_("failed").alias("n_failed"))
    if sightings is not None:
        each = sightings.groupBy("night", "posting").agg(F.max("is_japan").alias("japan"), (F.min("first_seen") == F.col("night")).alias("new"))
        counts = each.groupBy("night").agg(F.count("*").alias("n_seen"), F.count_if("japan").alias("n_japan"), F.count_if("new").alias("n_new"))
        out = out.join(counts, "night", "left")
    if closings is not None:
        out = out.join(closings.groupBy("night").agg(F.countDistinct("posting").alias("n_closed")), "night", "left")
    return out.fillna(0)


def skip_reasons(plan: DataFrame) -> DataFrame:
    """skip_reason and the number of boards that a plan leaves out for it."""
    return plan.where("skip_reason is not null").groupBy("skip_reason").agg(F.count("*").alias("n_boards"))


def host_requests(fetches: DataFrame) -> DataFrame:
    """host and the number of requests to it."""
    return fetches.groupBy("host").agg(F.count("*").alias("n_requests"))
