"""Clearance of sources, audits of published texts and pages, listings and links of raw pages, fingerprints of terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import scalars


def _named(matrix: DataFrame, datasets: DataFrame) -> DataFrame:
    """For each key that a source may name: (key, n_sources, reuse, robots), over the clearance rows whose source contains it.

    Sources are cut into their stretches of each length that a key has, so keys meet them by equality and no key is held against all sources.
    """
    lengths = datasets.select(F.length("key").alias("n")).where("n is not null").distinct().agg(F.collect_list("n").alias("lengths"))  # one row
    sized = matrix.select("source", "reuse_allowed", "robots_ok").join(F.broadcast(lengths)).withColumn("n", F.explode("lengths")).where(F.col("n") <= F.length("source"))
    cut = F.transform(F.sequence(F.lit(1), F.length("source") - F.col("n") + 1), lambda i: F.substring("source", i, F.col("n")))
    stretches = sized.select("reuse_allowed", "robots_ok", F.explode(F.array_distinct(cut)).alias("key"))
    return stretches.groupBy("key").agg(F.count("*").alias("n_sources"), F.max("reuse_allowed").alias("reuse"), F.max("robots_ok").alias("robots"))


def clear(datasets: DataFrame, matrix: DataFrame) -> DataFrame:
    """Each dataset (dataset, key, prototype, hold) with tos_status and publishable.

    Exactly one clearance row must name the key in its source. Y passes; unclear passes as a prototype if robots_ok begins with Y;
    all else is blocked. A hold keeps a dataset from publication.
    """
    per = datasets.groupBy("dataset", "key", "prototype", "hold").agg(F.count("*").alias("times_"))
    joined = per.join(_named(matrix, datasets), "key", "left")
    per = joined.withColumn("n_rows", F.coalesce(F.col("times_") * F.col("n_sources"), F.lit(0)))
    status = (
        F.when(F.col("n_rows") == 0, "missing").when(F.col("n_rows") > 1, "ambiguous").when(F.col("reuse") == "Y", "cleared")
        .when((F.col("reuse") == "unclear") & F.col("prototype") & F.startswith(F.col("robots"), F.lit("Y")), "prototype").otherwise("blocked")
    )
    return per.select("dataset", "n_rows", status.alias("tos_status"), ((status == "cleared") & ~F.col("hold")).alias("publishable"))


def require_publishable(cleared: DataFrame) -> DataFrame:
    """``cleared``; reading a dataset that must not be published fails the job."""
    refuse = F.raise_error(F.concat(F.lit("not publishable: "), F.col("dataset")))
    return cleared.withColumn("publishable", F.when(F.col("publishable"), F.lit(True)).otherwise(refuse))


def project_clearance(matrix: DataFrame, licences: dict[str, str], robots: dict[str, str]) -> DataFrame:
    """Clearance rows for publication: licence and robots prose by their beginnings as words of a vocabulary, URLs as hosts unless cleared.

    Prose that nothing in the vocabulary fits fails the job.
    """

    def word(c: str, known: dict[str, str]) -> Column:
        low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
        fits = [F.when(F.startswith(low, F.lit(k)), F.lit(v)) for k, v in known.items()]
        return F.coalesce(*fits, F.raise_error(F.concat(F.lit(f"{c} has no word for: "), low)))

    url = F.when(F.col("reuse_allowed") == "Y", F.col("url")).otherwise(F.array_join(scalars.site_roots(F.col("url")), "; "))
    return matrix.withColumns({"licence_class": word("license", licences), "robots_class": word("robots_ok", robots), "url": url})


def figure_pattern(figures: list[int]) -> str | None:
    """A pattern for figures as they are written, with and without separators; figures below 1,000 are too common to tell. None without any."""
    large = sorted({f for f in figures if f >= 1000})
    return "|".join(rf"(?<![\d,]){f:,}(?![\d,])|(?<!\d){f}(?!\d)" for f in large) or None


def shown_numbers(text: Column) -> Column:
    """The numbers that a text shows, each once: runs of digits, and runs with separators as they are written."""
    runs = F.concat(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), F.regexp_extract_all(text, F.lit(r"[\d,]*,[\d,]*"), F.lit(0)))
    return F.array_distinct(F.filter(runs, lambda x: F.length(x) >= 4))


def shows_figure(docs: DataFrame, figures: DataFrame) -> DataFrame:
    """doc_id of each text that shows a headline figure (column ``figure``) of 1,000 or more, with separators or without.

    Numbers are taken from the texts and joined with the figures, so figures may be as many as a build has.
    """
    large = figures.select(F.col("figure").cast("long").alias("figure")).where("figure >= 1000")
    forms = large.select(F.explode(F.array(F.col("figure").cast("string"), F.format_number("figure", 0))).alias("number")).distinct()
    shown = docs.select("doc_id", F.explode(shown_numbers(F.coalesce("text", F.lit("")))).alias("number"))
    return shown.join(forms, "number", "left_semi").select("doc_id").distinct()


def audit_surfaces(docs: DataFrame, markers: list[str], must: dict[str, str], figures: DataFrame | list[int] | None = None, is_json: Column | None = None) -> DataFrame:
    """doc_id and missing: for each text that has a marker or a headline figure, the notes (name -> pattern) that it lacks, one row each.

    ``figures`` are a few numbers, or a table of them. Of texts that are JSON only the values count for a note, not the names of fields.
    """
    text = F.coalesce("text", F.lit(""))
    said = text if is_json is None else F.when(is_json, json_values(text)).otherwise(text)
    lacking = F.filter(F.array(*[F.when(~said.rlike(p), F.lit(n)) for n, p in must.items()]), lambda x: x.isNotNull())
    marks = [*markers, *filter(None, [figure_pattern(figures)] if isinstance(figures, list) else [])]
    marked = text.rlike("|".join(marks)) if marks else F.lit(False)
    rows = docs
    if isinstance(figures, DataFrame):
        rows = docs.join(shows_figure(docs, figures).withColumn("shows_", F.lit(True)), "doc_id", "left")
        marked = marked | F.col("shows_").isNotNull()
    return rows.where(marked).select("doc_id", F.explode(lacking).alias("missing"))


def audit_size(pages: DataFrame, most_bytes: int = 50 << 20) -> DataFrame:
    """One row about all pages: their bytes, the largest page and its bytes, and whether the whole is too large."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("long")
    largest = F.max(F.struct(size.alias("n"), "page_id"))
    out = pages.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total_bytes"), largest.alias("l"))
    return out.select("total_bytes", F.col("l.page_id").alias("largest_page"), F.col("l.n").alias("largest_bytes"), (F.col("total_bytes") > most_bytes).alias("too_large"))


def audit_classes(pages: DataFrame, rules: dict[str, dict[str, str]]) -> DataFrame:
    """page_id and problem: for each page of a class (column page_class), the marks (problem -> pattern) of its class that it lacks."""
    html = F.coalesce("html", F.lit(""))
    lacks = [F.when((F.col("page_class") == c) & ~html.rlike(p), F.lit(name)) for c, own in rules.items() for name, p in own.items()]
    return pages.select("page_id", F.explode(F.filter(F.array(*lacks), lambda x: x.isNotNull())).alias("problem"))


def audit_pages(pages: DataFrame, most_bytes: int = 100_000) -> DataFrame:
    """page_id and problem: too_large, no_title, no_description, mail_link, form, email_text; one row for each."""
    html = F.coalesce("html", F.lit(""))
    problems = {
        "too_large": F.octet_length(html) > most_bytes, "no_title": ~html.rlike("(?i)<title>[^<]"), "no_description": ~html.rlike('(?i)<meta name="description"'),
        "mail_link": html.rlike("(?i)mailto:"), "form": html.rlike("(?i)<form"), "email_text": html.rlike(r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z]"),
    }
    found = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in problems.items()]), lambda x: x.isNotNull())
    return pages.select("page_id", F.explode(found).alias("problem"))


def json_values(text: Column) -> Column:
    """The string values (not keys) of a JSON text, one after the other."""
    found = F.regexp_extract_all(text, F.lit(r'"(?:[^"\\]|\\.)*"(?:\s*:)?'), F.lit(0))
    strings = F.filter(found, lambda x: ~F.endswith(x, F.lit(":")))
    return F.array_join(F.transform(strings, lambda x: F.substring(x, F.lit(2), F.length(x) - 2)), "\n")


def extract_listing(pages: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    """page_id and the groups of every match of a pattern in a page, each listing once."""
    hits = F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
    rows = pages.select("page_id", F.explode(hits).alias("hit"))
    return rows.select("page_id", *[F.regexp_extract("hit", pattern, k + 1).alias(n) for k, n in enumerate(names)]).distinct()


# How the publisher's pages call award files of a year and of a day.
YEAR_FILE = r"doDownload\('(successful_bid_record_info_all_(\d{4})\.zip)'\)"
DAY_FILE = r"doDownload\('(successful_bid_record_info_diff_(\d{4})(\d{2})(\d{2})\.zip)'\)"


def award_listing(pages: DataFrame) -> DataFrame:
    """page_id, file_name, kind (all, diff), file_key, fiscal_year of every award file that a page lists, each once."""
    years = extract_listing(pages, YEAR_FILE, ["file_name", "y"])
    days = extract_listing(pages, DAY_FILE, ["file_name", "y", "m", "d"])
    a = years.select("page_id", "file_name", F.lit("all").alias("kind"), F.concat(F.lit("FY"), "y").alias("file_key"), F.col("y").cast("int").alias("fiscal_year"))
    b = days.select("page_id", "file_name", F.lit("diff").alias("kind"), F.concat_ws("-", "y", "m", "d").alias("file_key"), F.lit(None).cast("int").alias("fiscal_year"))
    return a.unionByName(b)


# Fixed value: a row of the publisher's table of registry diffs.
DIFF_ROW = (
    r'(?s)<tr[^>]*class="type\d_corpHistory\d+"[^>]*>\s*<th[^>]*>\s*(.*?)\s*</th>\s*<td[^>]*>\s*<a[^>]*onclick="return doDownload\((\d+)\);"[^>]*>(.*?)</a>'
)


def diff_listing(pages: DataFrame, section: str = 'id="csv-unicode"', end: str = 'id="xml-unicode"') -> DataFrame:
    """page_id, day, file_no, label, size of every registry diff that a page lists between two marks; dates are written by era."""
    after = F.substring_index("html", section, -1)
    part = pages.where(F.contains("html", F.lit(section))).withColumn("html", F.substring_index(after, end, 1))
    bare = lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", ""))
    rows = extract_listing(part, DIFF_ROW, ["era", "file_no", "label"])
    rows = rows.select("page_id", scalars.era_to_date(bare("era")).alias("day"), "file_no", bare("label").alias("label"))
    return rows.where("day is not null").withColumn("size", F.nullif(F.regexp_extract("label", r"(?i)([0-9.,]+\s*[kmg]?b)", 1), F.lit("")))


def without_dots(url: Column) -> Column:
    """A URL whose path has no ``.`` and ``..`` segments."""
    root, path = F.regexp_extract(url, r"^([a-z]+://[^/?#]+)", 1), F.regexp_extract(url, r"^[a-z]+://[^/?#]+(/[^?#]*)", 1)
    tail = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    parts = F.split(path, "/")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), empty,
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))),
    )
    folder = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.when((root != "") & path.rlike(r"/\.\.?(/|$)"), F.concat(root, F.lit("/"), F.array_join(kept, "/"), F.when(folder, "/").otherwise(""), tail)).otherwise(url)


def extract_links(pages: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """page_id, target, title of every anchor, once each: href resolved against the page's URL, tags stripped, keyword filter."""
    anchor = r"(?is)<a\s[^>]*?href=[\"']([^\"'#]*)[^>]*>(.*?)</a>"
    rows = pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(anchor), F.lit(0))).alias("a"))
    href = F.trim(F.regexp_extract("a", anchor, 1))
    title = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("a", anchor, 2), "<[^>]*>", " "), r"\s+", " "))
    root, folder = F.regexp_extract("url", "^([a-z]+://[^/?#]+)", 1), F.regexp_extract("url", "^([a-z]+://[^?#]*/)", 1)
    target = (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract("url", "^([a-z]+:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(F.when(folder == "", F.concat(root, F.lit("/"))).otherwise(folder), href))
    )
    out = rows.select("page_id", without_dots(target).alias("target"), title.alias("title")).distinct()
    return out if not keywords else out.where(F.lower(F.concat_ws(" ", "target", "title")).rlike("|".join(keywords)))


def link_lines(links: DataFrame) -> DataFrame:
    """page_id and the page's links as sorted lines ``target | title``, each once: what is compared from visit to visit."""
    return links.groupBy("page_id").agg(F.array_sort(F.collect_set(F.concat_ws(" | ", "target", "title"))).alias("lines"))


def page_fingerprint(pages: DataFrame, lines: Column) -> DataFrame:
    """page_id, sorted distinct lines, and their fingerprint."""
    kept = F.array_sort(F.array_distinct(lines))
    return pages.select("page_id", kept.alias("lines"), F.sha2(F.array_join(kept, "\n").cast("binary"), 256).alias("fingerprint"))


def compare_fingerprints(current: DataFrame, base: DataFrame) -> DataFrame:
    """page_id, state (same, changed, no_baseline), and the numbers of lines that came and went."""
    b = base.select("page_id", F.col("lines").alias("b_lines"), F.col("fingerprint").alias("b_fp"))
    joined = current.join(b, "page_id", "left")
    state = F.when(F.col("b_fp").isNull(), "no_baseline").when(F.col("b_fp") == F.col("fingerprint"), "same").otherwise("changed")
    none = F.array().cast("array<string>")
    old = F.coalesce("b_lines", none)
    return joined.select("page_id", state.alias("state"), F.array_except("lines", old).alias("added"), F.array_except(old, F.col("lines")).alias("removed"))


def line_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """line and change (added, removed) between two tables of lines, repeats counted."""
    return after.exceptAll(before).withColumn("change", F.lit("added")).unionByName(before.exceptAll(after).withColumn("change", F.lit("removed")))


def assert_fresh(new: DataFrame, published: DataFrame) -> None:
    """Raise unless both tables hold the same rows."""
    if not new.exceptAll(published).isEmpty() or not published.exceptAll(new).isEmpty():
        raise ValueError("what is published differs from a fresh build")


def source_version(df: DataFrame) -> DataFrame:
    """One row: a version of a table's content, whatever its row order. Row digests add up, so no task sees all rows in order."""
    digest = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).cast("binary"), 256)
    parts = [F.sum(F.conv(F.substring(digest, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(4)]
    text = F.concat_ws("-", F.count("*").cast("string"), *[F.coalesce(p, F.lit("0")) for p in parts])
    return df.agg(F.concat(F.lit("sha256-"), F.substring(F.sha2(text.cast("binary"), 256), 1, 16)).alias("source_version"))
