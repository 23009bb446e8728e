"""Interactions: validated clicks and feed fetches, distinct clients, daily counters and rollups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import scalars


def validate_clicks(events: DataFrame, products: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) events: product on the list, kind click or view (blank: click), client id of 8 to 128 characters.

    A shorter client id gives way to the coarsened address. Rejected rows have a reason.
    """
    kind = F.coalesce(F.nullif(F.lower(F.trim("kind")), F.lit("")), F.lit("click"))
    reason = F.when(~F.coalesce(F.col("product").isin(products), F.lit(False)), "unknown_product").when(~kind.isin("click", "view"), "unknown_kind")
    given = F.trim(F.coalesce("client_id", F.lit("")))
    client = F.when(F.length(given) >= 8, F.substring(given, 1, 128)).otherwise(F.coalesce(scalars.ip_prefix(F.col("ip")), F.lit("-")))
    rows = events.withColumn("reason", reason)
    valid = rows.where("reason is null").drop("reason").withColumn("client", client).withColumn("kind", kind)
    return valid, rows.where("reason is not null")


def distinct_clients(events: DataFrame, keys: list[str], client: Column, ts: str = "ts") -> DataFrame:
    """``keys``, day, clients: how many different clients a UTC day has."""
    rows = events.select(*keys, F.to_date(ts).alias("day"), client.alias("client_")).distinct()
    return rows.groupBy(*keys, "day").agg(F.count("*").alias("clients"))


def intent_summary(daily: DataFrame, products: DataFrame, last: Column, days: int) -> DataFrame:
    """Per product: clicks and views of the last ``days`` (1 to 90) and of all time, and the rate of clicks to views (4 places).

    ``daily``: product, kind, day, clients. Products without events have zeros and no rate.
    """
    if not 1 <= days <= 90:
        raise ValueError("days must lie between 1 and 90")
    recent = F.col("day") > F.date_sub(last, days)

    def total(kind: str, when: Column | None = None) -> Column:
        cond = F.col("kind") == kind
        return F.coalesce(F.sum(F.when(cond if when is None else cond & when, F.col("clients"))), F.lit(0))

    sums = daily.groupBy("product").agg(
        total("click", recent).alias("clicks_recent"), total("view", recent).alias("views_recent"), total("click").alias("clicks"), total("view").alias("views")
    )
    names = ["clicks_recent", "views_recent", "clicks", "views"]
    out = products.join(sums, "product", "left").select("product", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    return out.withColumn("intent_rate", F.when(F.col("views") > 0, F.bround(F.col("clicks") / F.col("views"), 4)))


def feed_daily(fetches: DataFrame, salt: str) -> DataFrame:
    """feed, day, requests, distinct fetchers, crawlers among them, and the readers that agents report beyond themselves.

    A fetcher is an agent (counts of readers aside) at a coarsened address; only GET counts. Of the counts that an agent's family
    reports in a day the largest holds.
    """
    agent, day = F.col("user_agent"), F.to_date("ts")
    rows = fetches.where(F.upper("method") == "GET").select(
        "feed", day.alias("day"), scalars.agent_family(agent).alias("family"), scalars.reported_readers(agent).alias("reported"), scalars.is_crawler(agent).alias("crawler"),
        scalars.client_hash(salt, day, F.concat_ws("|", F.coalesce(scalars.ip_prefix(F.col("ip")), F.lit("-")), scalars.normal_agent(agent))).alias("fetcher"),
    )
    # one row per fetcher first: what is shuffled next no longer grows with requests
    once = rows.groupBy("feed", "day", "fetcher").agg(F.count("*").alias("requests"), F.max("crawler").alias("crawler"), F.max(F.struct(F.coalesce("reported", F.lit(0)), "family")).alias("r"))
    families = rows.where("reported is not null").groupBy("feed", "day", "family").agg(F.max("reported").alias("reported"))
    extra = families.groupBy("feed", "day").agg(F.sum(F.greatest(F.col("reported") - 1, F.lit(0))).alias("reported_beyond"))
    counts = once.groupBy("feed", "day").agg(F.sum("requests").alias("requests"), F.count("*").alias("fetchers"), F.count_if("crawler").alias("crawlers"))
    out = counts.join(extra, ["feed", "day"], "left").withColumn("reported_beyond", F.coalesce("reported_beyond", F.lit(0)))
    return out.withColumn("readers_estimate", F.col("fetchers") + F.col("reported_beyond"))


def feed_stats(daily: DataFrame, last: Column, days: int) -> DataFrame:
    """Per feed over the last ``days`` (1 to 31): days with fetches, requests, and the largest day's fetchers and estimate."""
    if not 1 <= days <= 31:
        raise ValueError("days must lie between 1 and 31")
    return daily.where(F.col("day") > F.date_sub(last, days)).groupBy("feed").agg(
        F.count("*").alias("days"), F.sum("requests").alias("requests"), F.max("fetchers").alias("max_fetchers"), F.max("readers_estimate").alias("max_readers_estimate")
    )


def fixed_window_verdicts(requests: DataFrame, limit: int, seconds: int = 60) -> DataFrame:
    """client, ts, request_id, allowed, remaining, retry_after (whole seconds to the window's end): a window begins with a client's first request after the last window's end.

    A fold over each client's requests in order: clients are dealt to partitions and sorted there, and a pass over the sorted
    batches carries one window start and one count, so memory does not grow with a client's requests.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, start, k = None, None, 0
        for rows in batches:
            place, wait = [], []
            for c, t in zip(rows.client, rows.t_, strict=True):
                if c != client or start is None or t - start >= seconds * 1_000_000:
                    client, start, k = c, t, 0
                k += 1
                place.append(k)
                wait.append(max(1, -((t - start - seconds * 1_000_000) // 1_000_000)))
            k_ = pd.Series(place, index=rows.index, dtype="int64")
            yield rows.drop(columns="t_").assign(allowed=k_ <= limit, remaining=(limit - k_).clip(lower=0), retry_after=wait)

    rows = requests.select(F.coalesce("client", F.lit("-")).alias("client"), F.col("ts").cast("timestamp").alias("ts"), "request_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t_"))
    dealt = rows.repartition("client").sortWithinPartitions("client", "ts", "request_id")
    return dealt.mapInPandas(fold, "client string, ts timestamp, request_id long, allowed boolean, remaining long, retry_after long")
