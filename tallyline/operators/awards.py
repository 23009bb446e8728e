"""Awards: normalisation, deduplication, enrichment and cell statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import dims, scalars
from tallyline.operators import ranges
from tallyline.operators.masking import assert_masked, mask_titles, mask_winners

QUARTILES = [0.25, 0.5, 0.75]


def normalize_awards(raw: DataFrame, bodies: DataFrame, methods: DataFrame, provenance: dict[str, str] | None = None) -> DataFrame:
    """Normalised awards from raw ones: names of codes, masking, whole yen, fiscal year, identities, provenance columns."""
    given = [F.col(c).cast("string") for c in ("item_no", "title", "award_date", "price", "ministry_cd", "method_cd", "winner_name")]
    rows = raw.where(F.coalesce(*given).isNotNull())
    rows = rows.withColumn("raw_hash", scalars.row_hash(*[F.col(c) for c in raw.columns]))
    rows = rows.withColumn("award_date", F.col("award_date").cast("date")).withColumn("amount_jpy", scalars.parse_yen(F.col("price").cast("string")))
    rows = rows.withColumn("award_id", scalars.award_id(F.col("ministry_cd"), F.col("award_date"), F.col("title"), F.col("amount_jpy")))
    rows = rows.withColumn("fiscal_year", scalars.fiscal_year(F.col("award_date")))
    rows = dims.with_codes(rows, bodies, "ministry_cd", {"publisher_name": dims.UNKNOWN, "sector": dims.UNKNOWN})
    rows = dims.with_codes(rows, methods, "method_cd", {"method_detail": dims.UNKNOWN, "method": "その他"})
    rows = assert_masked(mask_titles(mask_winners(rows)))
    empty = {"predicted_price_jpy": "long", "award_ratio": "double", "bidder_count": "int", "category_code": "string", "publish_date": "date"}
    rows = rows.withColumns({c: F.lit(None).cast(kind) for c, kind in empty.items() if c not in rows.columns})
    return rows.withColumns({c: F.lit(v) for c, v in (provenance or {}).items()})


def dedup_awards(df: DataFrame, arrival: str = "arrival", ties: bool = True) -> DataFrame:
    """The last arrival of each award of a fiscal year; ties by row hash.

    Without ``ties`` rows that arrive at once are not told apart, and no row hash is moved: for who keeps only what such rows share,
    as are the parts of an award's id. Ids are moved as bytes.
    """
    order = [F.desc(arrival), *([F.desc("raw_hash")] if ties and "raw_hash" in df.columns else [])]
    text = dict(df.dtypes)["award_id"] == "string"
    rows = df.withColumn("award_id", scalars.packed(F.col("award_id"))) if text else df
    w = Window.partitionBy("fiscal_year", "award_id").orderBy(*order)
    last = rows.withColumn("n_", F.row_number().over(w)).where("n_ = 1").drop("n_")
    return last.withColumn("award_id", scalars.unpacked(F.col("award_id"))) if text else last


def build_lookup(baseline: DataFrame, awards: DataFrame) -> DataFrame:
    """Registry rows whose number some award needs. ``awards`` are masked: they have no number but those whose check digit is right.

    So the numbers need no second check; as a filter here, it would be pushed to both sides and into the masking expression itself.
    """
    needed = awards.where(F.col("winner_type") == "corporate").select("corporate_number").distinct()
    return baseline.join(needed, "corporate_number", "left_semi")


def enrich_prefecture(awards: DataFrame, lookup: DataFrame) -> DataFrame:
    """Winner's prefecture by corporate number; unknown where there is none. The join strategy is left to the optimizer.

    Masked winners have no number. They would all be dealt to one task, so each gets a key of its other columns, which no number is like.
    """
    side = lookup.select(F.concat(F.lit("n"), "corporate_number").alias("key_"), F.col("prefecture_code").alias("pc"), F.col("prefecture").alias("pn"))
    rows = awards.drop("prefecture", "prefecture_code")
    spread = F.xxhash64(*[c for c in rows.columns if c != "corporate_number"]).cast("string")
    joined = rows.withColumn("key_", F.coalesce(F.concat(F.lit("n"), "corporate_number"), spread)).join(side, "key_", "left").drop("key_")
    code = F.coalesce("pc", F.lit(""))
    return joined.withColumn("prefecture_code", code).withColumn("prefecture", F.coalesce("pn", scalars.prefecture_name(code))).drop("pc", "pn")


def quartiles(c: Column, places: int = 0) -> Column:
    """Array of the three inclusive quartiles (linear between ranks), half-even; null without values."""
    return F.transform(F.percentile(c, F.array(*[F.lit(p) for p in QUARTILES])), lambda x: F.bround(x, places))


def award_stats(df: DataFrame, keys: list[str], amount: str = "amount_jpy") -> DataFrame:
    """Cell statistics by ``keys``: counts by kind of winner, and five-number summary and sum of the amounts."""
    corporate, masked = F.col("winner_type") == "corporate", F.col("winner_type") == "masked_individual"
    cells = df.groupBy(*keys).agg(
        F.count_if(corporate).alias("n_corporate"), F.count_if(masked).alias("n_masked_individual"), F.count(amount).alias("n_priced"),
        F.min(amount).alias("amount_min_jpy"), F.max(amount).alias("amount_max_jpy"), F.sum(amount).alias("amount_sum_jpy"), quartiles(F.col(amount)).alias("q"),
    )
    cells = cells.where("n_corporate + n_masked_individual + n_priced > 0")
    named = [F.get("q", F.lit(i)).cast("long").alias(f"amount_{n}_jpy") for i, n in enumerate(("q1", "median", "q3"))]
    return cells.select(
        *keys, "n_corporate", "n_masked_individual", (F.col("n_corporate") + F.col("n_masked_individual")).alias("n_awards"), "amount_min_jpy", *named,
        "amount_max_jpy", "amount_sum_jpy",
    )


def quartiles_by_rank(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """The same quartiles for cells of any size: ranks by a sort that can spill, and only the two rows at each cut are kept."""
    w = Window.partitionBy(*keys)
    rows = df.where(F.col(amount).isNotNull())
    rows = rows.withColumn("r", F.row_number().over(w.orderBy(amount)) - 1).withColumn("n", F.count("*").over(w))
    out = []
    for p, name in zip(QUARTILES, ("q1", "median", "q3"), strict=True):
        at = (F.col("n") - 1) * p
        low, high = F.max(F.when(F.col("r") == F.floor(at), F.col(amount))), F.max(F.when(F.col("r") == F.ceil(at), F.col(amount)))
        part = F.max(at - F.floor(at))
        out.append(F.bround(low + (high - low) * part, 0).cast("long").alias(f"amount_{name}_jpy"))
    return rows.groupBy(*keys).agg(*out)


def ratio_stats(df: DataFrame, keys: list[str], ratio: str) -> DataFrame:
    """Quartiles of a ratio to four places, and the share of rows that have one."""
    cells = df.groupBy(*keys).agg(quartiles(F.col(ratio), 4).alias("q"), F.bround(F.count(ratio) / F.count("*"), 4).alias("award_ratio_coverage"))
    return cells.select(*keys, *[F.get("q", F.lit(i)).alias(f"award_ratio_{n}") for i, n in enumerate(("q1", "median", "q3"))], "award_ratio_coverage")


def sector_year_exact(df: DataFrame, amount: str = "amount_jpy") -> DataFrame:
    """Quartiles of a sector's year over all its awards, also those of suppressed cells."""
    return award_stats(df, ["fiscal_year", "sector"], amount)


def sector_year(published: DataFrame) -> DataFrame:
    """Rollup of published cells to sector and year; n_awards adds what is held back, n_awards_in_table does not."""
    out = published.groupBy("fiscal_year", "sector").agg(
        F.sum("n_awards").alias("n_awards_in_table"), F.sum("amount_sum_jpy").alias("amount_sum_jpy"), F.min("amount_min_jpy").alias("amount_min_jpy"),
        F.max("amount_max_jpy").alias("amount_max_jpy"), F.count("*").alias("n_cells"),
        F.coalesce(F.max("n_awards_suppressed_in_group"), F.lit(0)).alias("n_held_back"),
    )
    return out.withColumn("n_awards", F.col("n_awards_in_table") + F.col("n_held_back"))


def with_quantiles(pages: DataFrame, exact: DataFrame, estimated: DataFrame) -> DataFrame:
    """Exact quartiles where there are any, else estimated ones; quantiles_exact tells them apart."""
    names = ["amount_q1_jpy", "amount_median_jpy", "amount_q3_jpy"]
    e = exact.select("fiscal_year", "sector", *[F.col(c).alias(f"e_{c}") for c in names])
    s = estimated.select("fiscal_year", "sector", *[F.col(c).alias(f"s_{c}") for c in names])
    joined = pages.join(e, ["fiscal_year", "sector"], "left").join(s, ["fiscal_year", "sector"], "left")
    picked = [F.coalesce(f"e_{c}", f"s_{c}").alias(c) for c in names]
    return joined.select(*pages.columns, *picked, F.col(f"e_{names[1]}").isNotNull().alias("quantiles_exact"))


def award_provenance(raw: DataFrame, normalized: DataFrame, published: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """One row: records parsed, normalised and deduplicated away, and awards held back.

    With a ``manifest`` (file_key, status, retrieved_at) only records of files that are ok count, and the latest retrieval is told.
    """
    if manifest is not None:
        manifest = manifest.where(F.coalesce(F.trim("status"), F.lit("")).isin("ok", ""))
        raw = raw.join(manifest.select("file_key").distinct(), "file_key", "left_semi")
    held = published.groupBy("fiscal_year", "sector").agg(F.max("n_awards_suppressed_in_group").alias("h")).agg(F.coalesce(F.sum("h"), F.lit(0)).alias("n_held_back"))
    parsed = raw.agg(F.count("*").alias("records_parsed"))
    kept = normalized.agg(F.count("*").alias("records_normalized"), F.max("award_date").alias("last_award_date"))
    joined = parsed.join(F.broadcast(kept)).join(F.broadcast(held))  # one row each
    if manifest is not None:
        joined = joined.join(F.broadcast(manifest.agg(F.max("retrieved_at").alias("retrieved_at"))))
    return joined.withColumn("records_deduplicated", F.col("records_parsed") - F.col("records_normalized"))


def dimensions(stats: DataFrame) -> DataFrame:
    """The distinct values of the dimensions as (dimension, value)."""
    parts = [stats.select(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")).distinct() for c in ("fiscal_year", "sector", "prefecture")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def order_stats(stats: DataFrame) -> DataFrame:
    """Cells in the order of the published table: year, sector, prefecture."""
    return stats.orderBy("fiscal_year", "sector", "prefecture")


def order_compact(stats: DataFrame) -> DataFrame:
    """Encoded cells in the order of the compact table: year, then the indexes of prefecture and sector."""
    return stats.orderBy("fiscal_year", "prefecture_idx", "sector_idx")


def encode_dictionary(stats: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """Dense index columns (<col>_idx) for values, numbered from 0 in order of first appearance under ``order``.

    Values are numbered within ranges of their first appearance, from the number of values in earlier ranges on.
    """
    numbered = stats.withColumn("at_", F.struct(*[F.col(c) for c in order]))
    out = numbered
    for c in cols:
        first = ranges.ranged(numbered.groupBy(F.col(c).alias("v_")).agg(F.min("at_").alias("first_")), "first_")
        ahead = F.broadcast(ranges.before(first, ahead_=F.count("*")))  # a row a range
        index = first.join(ahead, ranges.RANGE).select("v_", (F.col("ahead_") + F.row_number().over(ranges.within("first_")) - 1).cast("int").alias(f"{c}_idx"))
        out = out.join(index, F.col(c).eqNullSafe(F.col("v_")), "left").drop("v_")
    return out.drop("at_")
