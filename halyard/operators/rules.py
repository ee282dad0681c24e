"""Structured rules: dates, deduplication, order and enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halyard.functions.text import bound, constant, contains_any, fold_text, metric_text, normalize_spaces, short_hash, strip_spaces
from halyard.operators.textmining import validity
from halyard.registry import OTHER_ACTIVITY, RULE_ACTIVITY, RULE_CONSTRAINT, RULE_RANK, SCIENTIFIC, SPECIES

def dated(rules: DataFrame, current_year: int) -> DataFrame:
    """rules (doc, rule_key, …) with valid_from, valid_to, effective_date_source, _confidence, _quote and _reason as their texts tell."""
    said = F.concat_ws(" ", "description", "source_excerpt", "source_context")
    key = F.struct("doc", "rule_key").alias("key")
    told = validity(rules.select(key, said.alias("text"), F.col("source_title").alias("title"), F.col("source_url").alias("url")), "key", current_year)
    named = told.select("key.*", "valid_from", "valid_to", F.lit("parser").alias("effective_date_source"), F.col("confidence").alias("effective_date_confidence"), F.col("quote").alias("effective_date_quote"), F.col("reason").alias("effective_date_reason"))
    return rules.join(named, ["doc", "rule_key"], "left")


def marked_units(units: DataFrame, groups: list[tuple[str, ...]], noise: tuple[str, ...], least: int = 45, most: int = 520) -> DataFrame:
    """Units of a length from least to most that hold a word of every group and none of noise."""
    held = lambda f: reduce(lambda a, words: a & contains_any(f, words), groups, ~contains_any(f, noise))
    return units.where(F.length("unit").between(least, most) & bound(fold_text(F.col("unit")), held))


#: Citations of decrees in a folded description, which do not count in its signature (fixed value).
CITED = r"\b(article|arrete|decret)\s+[a-z0-9\-\.]+"


def content_signature(rules: DataFrame) -> Column:
    """What makes two rules the same: type, species and zone; then the metric with its unit of sizes and quotas, else the folded title (not of closures) and a hash of the description without citations."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rules.columns else F.lit("")
    kind = text("rule_type")
    said = F.substring(normalize_spaces(F.regexp_replace(fold_text(text("description")), CITED, " ")), 1, 360)
    head = [kind, fold_text(text("species_common_name")), text("zone_code")]
    metric = [text("metric_type"), metric_text(F.col("metric_value")), fold_text(text("metric_unit"))]
    return (
        F.when(kind.isin("MIN_SIZE", "QUOTA"), F.concat_ws("|", *head, *metric))
        .when(kind == "CLOSURE_PERIOD", F.concat_ws("|", *head, short_hash(said)))
        .otherwise(F.concat_ws("|", *head, fold_text(text("title")), short_hash(said)))
    )


def priority() -> Column:
    """A source's priority number; none, and 0, count as last."""
    return F.coalesce(F.nullif("source_priority", F.lit(0)), F.lit(999))


def preference() -> list[Column]:
    """The better of two rules: lower priority number, no review, longer description, key, first seen."""
    return [priority(), F.coalesce("needs_manual_review", F.lit(False)).cast("int"), -F.length(F.coalesce("description", F.lit(""))), F.col("rule_key"), F.col("seq")]


def dedupe_keys(rules: DataFrame) -> DataFrame:
    """Of each rule_key the rule of the least source_priority as it stands, of these the preferred. rules: also seq, zone_code."""
    w = W.partitionBy("rule_key").orderBy("source_priority", *preference())
    return rules.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def dedupe_content(rules: DataFrame) -> DataFrame:
    """Of rules of one signature the preferred; it is flagged duplicate_content_merged if there were several."""
    signed = rules.withColumn("signature", content_signature(rules))
    w = W.partitionBy("signature").orderBy(*preference())
    ranked = signed.withColumn("_n", F.row_number().over(w)).withColumn("_of", F.count("*").over(W.partitionBy("signature"))).where("_n = 1")
    flags = F.coalesce("quality_flags", F.array().cast("array<string>"))
    merged = F.when(F.col("_of") > 1, F.array_union(flags, F.array(F.lit("duplicate_content_merged")))).otherwise(flags)
    return ranked.withColumn("quality_flags", merged).drop("_n", "_of")


def rule_order(rules: DataFrame) -> list[Column]:
    """Zone, species, place of the type, priority, key; rules without zone or species come after those with one."""
    rank = F.lit(999)
    for t, r in RULE_RANK.items():
        rank = F.when(F.col("rule_type") == t, r).otherwise(rank)
    last = lambda c, end: F.when(F.coalesce(c, F.lit("")) == "", end).otherwise(c)
    return [last(F.col("zone_code"), "ZZZ"), last(fold_text(F.col("species_common_name")), "zzzz"), rank, priority(), F.coalesce("rule_key", F.lit(""))]


# Points of a rule's confidence: by its source's priority, and what they change by; least and most.
PRIORITY_POINTS, OTHER_POINTS = {1: 0.92, 2: 0.78}, 0.62
METRIC_POINTS, REFERENCE_POINTS, REVIEW_POINTS, FLAG_POINTS = 0.08, 0.04, -0.22, -0.08
LEAST_POINTS, MOST_POINTS = 0.05, 0.99


def confidence() -> Column:
    """Points of a rule, from 0.05 to 0.99."""
    score = reduce(lambda c, kv: F.when(priority() == kv[0], kv[1]).otherwise(c), PRIORITY_POINTS.items(), F.lit(OTHER_POINTS))
    held = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    for met, points in (
        (held("metric_type") & F.col("metric_value").isNotNull(), METRIC_POINTS),
        (held("legal_reference"), REFERENCE_POINTS),
        (F.coalesce("needs_manual_review", F.lit(False)), REVIEW_POINTS),
        (F.size(F.coalesce("quality_flags", F.array().cast("array<string>"))) > 0, FLAG_POINTS),
    ):
        score = score + F.when(met, points).otherwise(0.0)
    return F.round(F.greatest(F.lit(LEAST_POINTS), F.least(F.lit(MOST_POINTS), score)), 2)


def unit_share(score: Column) -> Column:
    """A score of 0 to 1, or of 0 to 100, as 0 to 1; null for null."""
    s = F.when(score > 1, score / 100).otherwise(score)
    return F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)))


def _of(c: Column, table: dict[str, str], other: str) -> Column:
    return F.coalesce(F.try_element_at(constant(table, "map<string,string>"), c), F.lit(other))


# Words of a folded species name that tell its group; of all others the last.
TAXA = ((("araignee", "homard", "tourteau", "langouste", "crabe"), "crustacean"), (("coquille", "ormeau", "pouce"), "shellfish"))
OTHER_TAXON = "fish"


def citation_quote(rules: DataFrame, most: int = 700) -> Column:
    """The quote chosen for a rule, else its excerpt, else its description; dots where it is cut."""
    text = lambda c: F.nullif(normalize_spaces(F.col(c)), F.lit("")) if c in rules.columns else F.lit(None).cast("string")
    quote = F.coalesce(text("selected_quote"), text("source_excerpt"), text("description"), F.lit(""))
    return F.when(F.length(quote) <= most, quote).otherwise(F.concat(F.rtrim(F.substring(quote, 1, most - 3)), F.lit("...")))


def document_hash(rules: DataFrame) -> Column:
    """A rule's document's hash; where it is not known, that of the source's address, title, authority and date."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rules.columns else F.lit("")
    seed = F.concat_ws("\n", F.regexp_replace(strip_spaces(text("source_url")), "#.*$", ""), text("source_title"), text("authority_name"), text("valid_from"))
    return F.coalesce(F.nullif(text("document_hash"), F.lit("")), F.sha2(seed, 256))


def enrich(rules: DataFrame) -> DataFrame:
    """rules with status, confidence, activity, constraint, document_hash, citations, the species' record and the candidate's.

    A column that rules lack counts as null. citations: one, of the quote, its
    excerpt and context, and where it stands. candidate: what is put up for
    publication, under a key of rule, document and content.
    """
    t, m = F.col("rule_type"), F.col("metric_type")
    name = F.nullif(fold_text(F.col("species_common_name")), F.lit(""))
    given = lambda c, kind="string": F.col(c) if c in rules.columns else F.lit(None).cast(kind)
    cut = lambda c, n: F.substring(normalize_spaces(F.coalesce(given(c), F.lit(""))), 1, n)
    scientific = F.coalesce(F.nullif("species_scientific_name", F.lit("")), F.try_element_at(constant(SCIENTIFIC, "map<string,string>"), name))
    group = reduce(lambda c, kv: F.when(contains_any(name, kv[0]), kv[1]).otherwise(c), reversed(TAXA), F.lit(OTHER_TAXON))
    spellings = F.coalesce(F.try_element_at(constant({n: sorted(set(a)) for n, a in SPECIES.items()}, "map<string,array<string>>"), name), F.array(name))
    review = F.coalesce("needs_manual_review", F.lit(False))
    chosen = F.coalesce(given("selected_quote"), F.lit("")) != ""
    named = rules.withColumns({
        "document_hash": document_hash(rules),
        "status": F.when(review, "needs_review").otherwise("published"),
        "confidence": F.coalesce(unit_share(given("confidence_score", "double")), confidence()),
        "activity_type": _of(t, RULE_ACTIVITY, OTHER_ACTIVITY),
        "constraint_type": F.when(m == "SIZE_MIN_CM", "min_size").when(m.isin("QUOTA_MAX_UNITS", "QUOTA_MAX_KG"), "quota").otherwise(_of(t, RULE_CONSTRAINT, "general_rule")),
        "locator": F.coalesce(F.nullif("legal_reference", F.lit("")), "rule_key"),
        "quote": citation_quote(rules),
    })
    citation = F.struct(
        F.regexp_replace(strip_spaces(F.col("source_url")), "#.*$", "").alias("url"), F.col("quote"), cut("source_excerpt", 1 << 30).alias("source_excerpt"), cut("source_context", 1800).alias("source_context"),
        F.when(chosen, "ai_selected").otherwise("parser_excerpt").alias("selection_method"), F.col("locator"), F.col("document_hash"), F.col("confidence"),
    )
    species = F.struct(
        name.alias("canonical_name"), F.col("species_common_name").alias("common_name"), scientific.alias("scientific_name"), group.alias("taxon_group"), spellings.alias("aliases"),
        F.create_map().cast("map<string,string>").alias("external_ids"),
    )
    candidate = F.struct(
        short_hash(F.concat_ws("|", F.coalesce("rule_key", F.lit("")), "document_hash", content_signature(rules))).alias("candidate_key"),
        F.when(review, "candidate").otherwise("publishable").alias("status"), F.col("confidence"), F.col("activity_type"), F.col("constraint_type"),
        *[F.col(c) for c in ("rule_key", "rule_type", "title", "description", "metric_type", "metric_value", "metric_unit", "species_common_name", "document_hash") if c in named.columns],
    )
    return named.select("*", F.array(citation).alias("citations"), F.when(name.isNotNull(), species).alias("species"), candidate.alias("candidate"))


def audit_sample(rules: DataFrame, n: int) -> DataFrame:
    """The first n rules in rule order, with the twenty fields a reviewer is shown, long texts shortened; what rules lack is null."""
    given = lambda c, kind="string": F.col(c) if c in rules.columns else F.lit(None).cast(kind)
    cut = lambda c, most: F.substring(F.coalesce(given(c), F.lit("")), 1, most).alias(c)
    also = [F.col("seq")] if "seq" in rules.columns else []
    return rules.orderBy(*rule_order(rules), *also).limit(n).select(
        "rule_key", "rule_type", given("title").alias("title"), cut("description", 700), cut("source_excerpt", 700), cut("source_context", 1600),
        citation_quote(rules, 500).alias("current_quote"), given("legal_reference").alias("legal_reference"), given("valid_from", "date").alias("valid_from"), given("valid_to", "date").alias("valid_to"),
        given("effective_date_quote").alias("effective_date_quote"), given("metric_type").alias("metric_type"), given("metric_value", "double").alias("metric_value"), given("metric_unit").alias("metric_unit"),
        "species_common_name", F.coalesce("zone_code", F.lit("")).alias("zone_code"), given("source_priority", "int").alias("source_priority"), given("source_url").alias("source_url"), given("source_title").alias("source_title"),
        F.coalesce(given("needs_manual_review", "boolean"), F.lit(False)).alias("needs_manual_review"),
    )
