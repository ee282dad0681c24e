"""Web pages as tables: text, links, scores, bounded expansion."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.functions.text import count_words, fold_text, folded, host_allowed, is_official, normalize_spaces, short_hash, strip_spaces
from halyard.registry import NEGATIVE_WORDS, RELEVANT_WORDS


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """Character references to characters; Spark has no function for it."""
    return s.map(html.unescape, na_action="ignore")


# What is no visible text, what ends a line, and any other tag.
HIDDEN = r"(?is)<(script|style|noscript|template)\b[^>]*>.*?</\1>"
LINE_END = r"(?i)<\s*br\s*/?\s*>|</\s*(?:p|li|div|section|article|main|nav|header|footer|h[1-6]|tr|table)\s*>"
TAG = r"<[^>]+>"


def html_text(c: Column) -> Column:
    """Visible text: no scripts, styles or tags; block ends and breaks are line breaks; single spaces; no empty lines."""
    plain = unescape(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, HIDDEN, " "), LINE_END, "\n"), TAG, " "))
    tidy = F.transform(F.split(plain, r"\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"), normalize_spaces)
    return F.array_join(F.filter(tidy, lambda x: x != ""), "\n")


ANCHOR = r"""(?is)<a\b[^>]*?href\s*=\s*["']([^"']+)["'][^>]*>(.*?)</a>"""
HREF = r"""(?i)href\s*=\s*["']([^"']+)["']"""


def links(pages: DataFrame, url: str = "url", content: str = "html") -> DataFrame:
    """(src_url, position, href, label): a page's anchors with their text; a page without any gives its bare hrefs."""
    anchors = F.arrays_zip(F.regexp_extract_all(content, F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all(content, F.lit(ANCHOR), F.lit(2)).alias("label"))
    bare = F.transform(F.regexp_extract_all(content, F.lit(HREF), F.lit(1)), lambda h: F.struct(h.alias("href"), F.lit("").alias("label")))
    found = pages.select(F.col(url).alias("src_url"), F.when(F.size(anchors) > 0, anchors).otherwise(bare).alias("links"))
    each = found.select("src_url", F.posexplode("links").alias("position", "l"))
    label = normalize_spaces(unescape(F.regexp_replace("l.label", r"<[^>]+>", " ")))
    return each.select("src_url", "position", unescape(strip_spaces(F.col("l.href"))).alias("href"), label.alias("label"))


def canonical_url(c: Column) -> Column:
    return F.regexp_replace(strip_spaces(c), "#.*$", "")


def resolve(base: Column, href: Column) -> Column:
    """An absolute url: of an absolute, protocol-relative, rooted, query-only, empty or relative reference; dots are not folded."""
    h = canonical_url(href)
    scheme, origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(page.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*$"), F.concat(page, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    return (
        F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(origin, h))
        .when(h == "", canonical_url(base))
        .when(h.startswith("?"), F.concat(page, h))
        .otherwise(F.concat(folder, h))
    )


def edges(found: DataFrame, domain: str | None = None) -> DataFrame:
    """(src_url, position, dst_url, label): links resolved, http only, on the domain if one is given, each target's first of a page."""
    at = found.select("src_url", "position", resolve(F.col("src_url"), F.col("href")).alias("dst_url"), "label")
    at = at.where(F.lower("dst_url").rlike("^https?://"))
    if domain:
        at = at.where(host_allowed(F.col("dst_url"), domain))
    w = W.partitionBy("src_url", "dst_url").orderBy("position")
    return at.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def path_of(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))


def is_pdf(url: Column) -> Column:
    return F.lower(path_of(url)).endswith(".pdf")


#: A numbered decree in a folded address or label (fixed value).
DECREE = r"\b(ar|arrete|decret)[-_]?\d"


def relevance(url: Column, label: Column, year: int, relevant: tuple[str, ...] = RELEVANT_WORDS, negative: tuple[str, ...] = NEGATIVE_WORDS) -> Column:
    """4 for each relevant word, -5 for each negative, 3 for each year from the last to the next, 2 each for an official host, an annex and a numbered decree."""
    signal = fold_text(F.concat_ws(" ", url, label))
    years = count_words(signal, tuple(str(year + k) for k in (-1, 0, 1)))
    bonus = is_official(url).cast("int") + signal.contains("annexe").cast("int") + signal.rlike(DECREE).cast("int")
    return 4 * count_words(signal, relevant) - 5 * count_words(signal, negative) + 3 * years + 2 * bonus


def candidate_score(url: Column, label: Column, year: int, words: tuple[str, ...], negative: tuple[str, ...]) -> Column:
    """3 a word, -8 a negative one, the relevance, 4 a year from the last to the next, 2 for a PDF."""
    signal = fold_text(F.concat_ws(" ", url, label))
    words, negative = tuple(map(folded, words)), tuple(map(folded, negative))
    years = count_words(signal, tuple(str(year + k) for k in (-1, 0, 1)))
    return 3 * count_words(signal, words) - 8 * count_words(signal, negative) + relevance(url, label, year) + 4 * years + 2 * is_pdf(url).cast("int")


def candidates(found: DataFrame, existing: DataFrame, year: int, words: tuple[str, ...], negative: tuple[str, ...] = NEGATIVE_WORDS, accept: int = 12) -> DataFrame:
    """edges as candidates: id, url, title, kind, score, status existing, auto_accepted or candidate."""
    url, label = F.col("dst_url"), F.col("label")
    known = existing.select(canonical_url(F.col("url")).alias("dst_url"), F.lit(True).alias("_known")).distinct()
    scored = found.withColumn("score", candidate_score(url, label, year, words, negative)).join(known, "dst_url", "left")
    stem = F.regexp_replace(F.regexp_replace(F.regexp_extract(path_of(url), r"([^/]*)$", 1), r"(?i)\.(html?|pdf)$", ""), "[-_]+", " ")
    title = F.coalesce(F.nullif(normalize_spaces(label), F.lit("")), F.nullif(strip_spaces(stem), F.lit("")), url)
    return scored.select(
        F.concat(F.lit("discovered_"), short_hash(url)).alias("id"), url.alias("url"), title.alias("title"),
        F.when(is_pdf(url), "pdf").otherwise("html+pdf+links").alias("kind"), "score",
        F.when(F.col("_known"), "existing").when(F.col("score") >= accept, "auto_accepted").otherwise("candidate").alias("status"),
        F.col("src_url").alias("seed_url"), "position",
    )


def top_links(found: DataFrame, k: int) -> DataFrame:
    """Each seed's k best new candidates, by score, then shortness of url, then place in the page, then url: pages of one url may have two at a place."""
    w = W.partitionBy("seed_url").orderBy(F.desc("score"), F.length("url"), "position", "url")
    return found.where("status <> 'existing'").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranked_links(found: DataFrame, year: int, limit: int, pdf: bool, relevant: tuple[str, ...] = RELEVANT_WORDS, negative: tuple[str, ...] = NEGATIVE_WORDS) -> DataFrame:
    """Each page's PDF links, or its relevant page links on its own host, best first; negative words keep a page out."""
    url = F.col("dst_url")
    rows = found.where(is_pdf(url) if pdf else ~is_pdf(url))
    if not pdf:
        host = lambda c: F.lower(F.try_parse_url(c, F.lit("HOST")))
        signal = fold_text(F.concat_ws(" ", path_of(url), F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit("")), F.col("label")))
        wanted = (count_words(signal, relevant) > 0) | path_of(url).rlike(r"-a\d+\.html$")
        rows = rows.where((host(url) == host(F.col("src_url"))) & (count_words(signal, negative) == 0) & wanted & (url != canonical_url(F.col("src_url"))))
    scored = rows.withColumn("score", relevance(url, F.col("label"), year, relevant, negative))
    w = W.partitionBy("src_url").orderBy(F.desc("score"), F.length("dst_url"), "dst_url")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def sitemap_links(sitemaps: DataFrame) -> DataFrame:
    """(src_url, position, dst_url, label): the locations of sitemap documents (url, xml)."""
    locs = sitemaps.select(F.col("url").alias("src_url"), F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?is)<loc>\s*([^<]+?)\s*</loc>"), F.lit(1))).alias("position", "loc"))
    return locs.select("src_url", "position", canonical_url(unescape(F.col("loc"))).alias("dst_url"), F.lit("").alias("label"))


def expand(accepted: DataFrame, seeds: DataFrame, hops: int, max_pages: int) -> DataFrame:
    """(seed_url, url, hop): pages reached from each seed over accepted edges (src_url, dst_url, score), at most max_pages a seed.

    One join of frontier and edges a hop, less the visited; pages are kept by
    hop, then score, then url. Each hop's visited pages are checkpointed, so the
    plan does not grow.
    """
    visited = seeds.select(F.col("url").alias("seed_url"), F.col("url"), F.lit(0).alias("hop"), F.lit(0).alias("rank"))
    by = W.partitionBy("seed_url").orderBy("hop", "rank", "url")
    for hop in range(1, hops + 1):
        frontier = visited.where(F.col("hop") == hop - 1).select("seed_url", F.col("url").alias("src_url"))
        new = frontier.join(accepted, "src_url").groupBy("seed_url", F.col("dst_url").alias("url")).agg(F.max("score").alias("score"))
        new = new.join(visited.select("seed_url", "url"), ["seed_url", "url"], "left_anti")
        grown = visited.unionByName(new.select("seed_url", "url", F.lit(hop).alias("hop"), (-F.col("score")).cast("int").alias("rank")))
        visited = grown.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= max_pages).drop("_n").checkpoint()
    return visited.select("seed_url", "url", "hop")


def best_per_url(found: DataFrame) -> DataFrame:
    """Of candidates from several seeds and sitemaps the best of each url."""
    w = W.partitionBy("url").orderBy(F.desc("score"), "seed_url", "position")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def status_counts(found: DataFrame) -> DataFrame:
    """(status, n) of candidates; those without a status are unknown."""
    return found.groupBy(F.coalesce(F.nullif("status", F.lit("")), F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))


def domain_coverage(domains: DataFrame, existing: DataFrame, found: DataFrame, sample: int = 20) -> DataFrame:
    """(host, n_existing, n_candidates, n_accepted, urls): counts per domain, sub-domains included, and its first urls, by status, score and address.

    A host's urls are ranked before they are gathered, so no row grows with them.
    """
    host = lambda c: F.lower(F.try_parse_url(c, F.lit("HOST")))
    # a host and each domain above it meet by equality
    parts = F.split(host(F.col("url")), r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    below = lambda df, *more: df.where(host(F.col("url")).isNotNull()).select("url", *more, F.explode(above).alias("host")).join(domains.select("host"), "host")
    e = below(existing).groupBy("host").agg(F.countDistinct("url").alias("n_existing"))
    c = below(found, "status", "score")
    counts = c.groupBy("host").agg(F.count("*").alias("n_candidates"), F.count_if(F.col("status") == "auto_accepted").alias("n_accepted"))
    w = W.partitionBy("host").orderBy("status", F.desc("score"), "url")
    first = c.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= sample).groupBy("host").agg(F.array_sort(F.collect_list(F.struct("_n", "url"))).alias("_first"))
    out = domains.select("host").join(e, "host", "left").join(counts, "host", "left").join(first, "host", "left")
    urls = F.transform(F.coalesce("_first", F.array().cast("array<struct<_n:int,url:string>>")), lambda x: x["url"])
    return out.na.fill(0, ["n_existing", "n_candidates", "n_accepted"]).withColumn("urls", urls).drop("_first")


def merge_catalogue(known: DataFrame, discovered: DataFrame) -> DataFrame:
    """Catalogue and accepted discoveries; of each url the lowest priority number."""
    both = known.withColumn("_seq", F.lit(0)).unionByName(discovered.where("status in ('auto_accepted', 'existing')").withColumn("_seq", F.lit(1)), allowMissingColumns=True)
    w = W.partitionBy("url").orderBy("source_priority", "_seq", "source_id")
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_seq").select(*known.columns)


def cap_per_source(documents: DataFrame, source: str, order: str, cap: int = 45) -> DataFrame:
    """Each source's first documents in collection order."""
    w = W.partitionBy(source).orderBy(order)
    return documents.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).drop("_n")
