"""Quality reports over rules and documents."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halyard.functions.text import contains_any, fold_text, folded, is_iso_date, is_official, metric_text
from halyard.registry import CRUSTACEANS


#: What must not lack in a rule; the box of a zone with one of its own; marks of scripts and menus in a description (fixed values).
REQUIRED = ("rule_key", "rule_type", "title", "description", "source_url", "zone_code")
BOX = ("lat_min", "lat_max", "lon_min", "lon_max")
NOISE = ("var mediabox_settings", "tarteaucitron", "acceder au menu", "gestion des cookies", "ajaxpagestate")
SIZE_METRIC, QUOTA_METRICS = "SIZE_MIN_CM", ("QUOTA_MAX_UNITS", "QUOTA_MAX_KG")


def row_issues(rules: DataFrame, longest: int = 1200) -> DataFrame:
    """(rule_key, category, severity, details): one row per fault of a rule.

    rules: the REQUIRED columns, zone_strategy and the BOX, valid_from and
    valid_to (dates or texts), metric_type, metric_value (number or text). A
    column that rules lack counts as null.
    """
    have = lambda c: F.col(c) if c in rules.columns else F.lit(None).cast("string")
    text = lambda c: F.coalesce(have(c).cast("string"), F.lit(""))
    lacking = lambda names, bad: F.array_join(F.array_compact(F.array(*[F.when(bad(c), F.lit(c)) for c in names])), ",")
    missing, no_side = lacking(REQUIRED, lambda c: text(c) == ""), lacking(BOX, lambda c: have(c).isNull())
    value, kind = have("metric_value"), have("metric_type")
    number = value.cast("string").try_cast("double")
    bad_date = lambda c: (text(c) != "") & ~F.coalesce(is_iso_date(text(c)), F.lit(False))
    shown = metric_text(number)
    checks = [
        (missing != "", "missing_field", "error", missing),
        (F.length(text("description")) > longest, "description_too_long", "warning", F.length(text("description")).cast("string")),
        (contains_any(fold_text(text("description")), NOISE), "noisy_description", "warning", F.lit("")),
        ((text("source_url") != "") & ~is_official(have("source_url")), "source_priority", "info", text("source_url")),
        (bad_date("valid_from"), "invalid_validity_date", "error", text("valid_from")),
        (bad_date("valid_to"), "invalid_validity_date", "error", text("valid_to")),
        ((text("zone_strategy") == "CUSTOM_BBOX") & (no_side != ""), "invalid_zone", "error", no_side),
        (value.isNotNull() & number.isNull(), "invalid_metric", "error", value.cast("string")),
        ((kind == SIZE_METRIC) & ~number.between(1, 400), "suspicious_metric", "warning", shown),
        (kind.isin(*QUOTA_METRICS) & (number <= 0), "invalid_metric", "error", shown),
    ]
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(k).alias("category"), F.lit(s).alias("severity"), d.alias("details"))) for c, k, s, d in checks]), lambda x: x.isNotNull())
    return rules.select("rule_key", F.explode(found).alias("i")).select("rule_key", "i.category", "i.severity", "i.details")


def duplicate_content(rules: DataFrame, signature: Column) -> DataFrame:
    """(rule_key, first_key): rules whose signature an earlier rule of another key has."""
    w = W.partitionBy("signature").orderBy("seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.first(F.nullif("rule_key", F.lit("")), ignorenulls=True).over(w)
    return rules.withColumn("signature", signature).select("rule_key", first.alias("first_key")).where("first_key <> rule_key")


def metric_conflicts(rules: DataFrame) -> DataFrame:
    """(rule_key, other_key, first_value, metric_value): metrics that differ from the first of their type, species, zone, metric type and unit."""
    unit = F.coalesce("metric_unit", F.lit("")) if "metric_unit" in rules.columns else F.lit("")
    same = ["rule_type", fold_text(F.coalesce("species_common_name", F.lit(""))), F.coalesce("zone_code", F.lit("")), "metric_type", fold_text(unit)]
    w = W.partitionBy(*same).orderBy("seq")
    with_metric = rules.where("metric_value is not null and metric_type <> ''")
    first = with_metric.select("rule_key", F.first("rule_key").over(w).alias("other_key"), F.first("metric_value").over(w).alias("first_value"), "metric_value")
    return first.where(metric_text(F.col("metric_value")) != metric_text(F.col("first_value")))


def duplicate_keys(rules: DataFrame) -> DataFrame:
    return rules.groupBy("rule_key").agg(F.count("*").alias("n")).where("n > 1")


def count_by(rules: DataFrame, key: str, lacking: str | None = None) -> DataFrame:
    """(key, n) of the values of a column; rules without one are left out, or counted under another name."""
    value = F.nullif(F.col(key), F.lit(""))
    named = rules.select((value if lacking is None else F.coalesce(value, F.lit(lacking))).alias("key"))
    return named.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))


def count_zones(rules: DataFrame) -> DataFrame:
    """(key, n) by zone_code; rules without a zone count as UNKNOWN."""
    return count_by(rules, "zone_code", "UNKNOWN")


def summary(rules: DataFrame) -> DataFrame:
    """Counts of rules, of those to review, and of those with a validity, without one, and with one of an audit or of the parser."""
    known = F.col("valid_from").isNotNull() | F.col("valid_to").isNotNull()
    origin = F.col("effective_date_source")
    return rules.agg(
        F.count("*").alias("n_rules"),
        F.count_if(F.col("needs_manual_review")).alias("n_review"),
        F.count_if(known).alias("n_dated"),
        F.count_if(~known).alias("n_undated"),
        F.count_if(origin == "ai").alias("n_dated_by_audit"),
        F.count_if(origin.startswith("parser")).alias("n_dated_by_parser"),
    )


def required_categories() -> dict[str, Column]:
    """What a whole set of rules must have, by name (fixed values)."""
    kind = F.col("rule_type")
    crustacean = contains_any(fold_text(F.coalesce("species_common_name", F.lit(""))), CRUSTACEANS)
    return {
        "DIVING_GENERAL": kind == "DIVING_GENERAL",
        "SPEARFISHING_GENERAL": kind == "SPEARFISHING_GENERAL",
        "MIN_SIZE": kind == "MIN_SIZE",
        "QUOTA": kind == "QUOTA",
        "CRUSTACEAN_NUMERIC_RULE": kind.isin("MIN_SIZE", "QUOTA") & crustacean,
        "FISH_QUOTA_RULE": (kind == "QUOTA") & ~crustacean,
    }


def missing_categories(rules: DataFrame, categories: dict[str, Column] | None = None) -> DataFrame:
    """(category): of the required categories those no rule meets."""
    wanted = required_categories() if categories is None else categories
    seen = rules.agg(*[F.coalesce(F.max(c.cast("int")), F.lit(0)).alias(n) for n, c in wanted.items()])
    return seen.unpivot([], list(wanted), "category", "seen").where("seen = 0").select("category")


#: Columns of a document that its rules carry; of each the first rule's value holds.
DOCUMENT_COLUMNS = ("source_type", "authority_name", "source_title", "content_length", "raw_storage_path", "fetched_at", "checked_at", "etag", "last_modified", "content_hash", "fetch_status")


def document_manifest(rules: DataFrame) -> DataFrame:
    """One row per document_hash: source_url, document_type, DOCUMENT_COLUMNS, rule_keys, chunks, content_length.

    rules: rule_key, document_hash, source_url, quote, source_context, locator,
    seq, and the DOCUMENT_COLUMNS they have. chunks: each rule's quote, and its
    context where it differs from that of the first rule; numbered from 0 in
    the rules' order, with the hash of document, number and text, an estimate of
    tokens, and where it stands. content_length: the document's, else its
    chunks' characters.
    """
    own = [c for c in DOCUMENT_COLUMNS if c in rules.columns]
    quote, context = F.coalesce("quote", F.lit("")), F.coalesce("source_context", F.lit(""))
    parts = F.array(F.struct(F.lit(0).alias("part"), quote.alias("text"), F.col("locator").alias("locator")), F.struct(F.lit(1).alias("part"), context.alias("text"), F.concat("locator", F.lit(":context")).alias("locator")))
    rows = rules.select("document_hash", "seq", "rule_key", "source_url", *own, parts.alias("parts"))
    by_document = rows.groupBy("document_hash").agg(
        *[F.min_by(c, F.struct("seq", "rule_key")).alias(c) for c in ("source_url", *own)],
        F.array_sort(F.collect_set(F.nullif("rule_key", F.lit("")))).alias("rule_keys"),
        F.array_sort(F.collect_list(F.struct("seq", "rule_key", "parts"))).alias("said"),
    )
    # the first rule has its quote though it be empty, and its context only if it is another text; of the others what is not empty counts
    kept = F.flatten(F.transform("said", lambda r, i: F.filter(r["parts"], lambda p: F.when((i == 0) & (p["part"] == 0), True).when(i == 0, (p["text"] != "") & (p["text"] != r["parts"][0]["text"])).otherwise(p["text"] != ""))))
    chunk = lambda p, i: F.struct(
        i.alias("chunk_index"), F.sha2(F.concat_ws(":", "document_hash", i.cast("string"), p["text"]), 256).alias("chunk_hash"), p["text"].alias("text_excerpt"),
        F.greatest(F.lit(1), F.size(F.regexp_extract_all(p["text"], F.lit(r"\S+"), F.lit(0)))).alias("token_estimate"), p["locator"].alias("locator"),
    )
    out = by_document.withColumn("chunks", F.transform(kept, chunk)).drop("said")
    length = F.aggregate("chunks", F.lit(0).cast("long"), lambda n, c: n + F.length(c["text_excerpt"]))
    given = F.nullif(F.col("content_length").cast("long"), F.lit(0)) if "content_length" in own else F.lit(None).cast("long")
    pdf = F.lower(F.coalesce("source_url", F.lit(""))).endswith(".pdf")
    return out.withColumn("content_length", F.coalesce(given, length)).withColumn("document_type", F.when(pdf, "pdf").otherwise("html"))


#: Keys of an expectation, or of one of its filters, that ask for nothing.
ABOUT = ("id", "label", "severity")


def _as_text(rules: DataFrame, field: str) -> Column:
    """A rule's field folded, as it is compared; what rules lack, null, false and zero are empty."""
    if field not in rules.columns:
        return F.lit("")
    kind, c = rules.schema[field].dataType.typeName(), F.col(field)
    held = c if kind == "boolean" else c != 0 if kind in ("double", "float", "long", "integer", "short", "byte", "decimal") else F.lit(True)
    return F.coalesce(F.when(held, fold_text(c.cast("string"))), F.lit(""))


def _as_metric(value: Column) -> Column:
    """A metric as text: three decimals without trailing zeros; what is no number folded; empty for null."""
    number = value.cast("string").try_cast("double")
    return F.coalesce(F.when(number.isNotNull(), metric_text(number)).otherwise(fold_text(value.cast("string"))), F.lit(""))


def compile_filter(spec: dict[str, object], rules: DataFrame) -> Column:
    """One expectation filter: `name` equals, `name_contains` holds, both folded, `metric_value` as text; all must be met. A field that rules lack is empty."""
    parts = []
    for k, v in spec.items():
        if k in ABOUT:
            continue
        wanted = folded(str(v or ""))
        if k.endswith("_contains"):
            parts.append(_as_text(rules, k.removesuffix("_contains")).contains(wanted))
        elif k == "metric_value":
            own = F.col(k) if k in rules.columns else F.lit(None).cast("string")
            parts.append(_as_metric(own) == _as_metric(F.lit(None if v is None else str(v))))
        else:
            parts.append(_as_text(rules, k) == wanted)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def expectations(rules: DataFrame, wanted: list[dict]) -> DataFrame:
    """(id, label, severity, n_matched, matched_rule_keys, met, filters): each expectation with the rules that meet any of its filters.

    wanted: id, perhaps label and severity (warning), and any_of, a list of
    filters, or the one filter's own keys. Rules without a key do not count.
    All are looked up in one pass; matched keys are sorted, each once. filters:
    what was asked for, as JSON, where no rule has it; else null.
    """
    schema = "n int, id string, label string, severity string, filters string"
    rows, met = [], []
    for n, w in enumerate(wanted):
        name = str(w.get("id") or w.get("label") or "expectation")
        own = {k: v for k, v in w.items() if k not in ABOUT}
        rows.append((n, name, str(w.get("label") or name), str(w.get("severity") or "warning"), json.dumps(w.get("any_of") or own, ensure_ascii=False)))
        filters = [f for f in w["any_of"] if isinstance(f, dict)] if isinstance(w.get("any_of"), list) else [own]
        cond = reduce(lambda a, b: a | b, [compile_filter(f, rules) for f in filters], F.lit(False))
        met.append(F.when(F.coalesce(cond, F.lit(False)), F.lit(n)))
    about = rules.sparkSession.createDataFrame(rows, schema)
    none = F.array().cast("array<int>")
    keyed = rules.where(F.coalesce("rule_key", F.lit("")) != "").select("rule_key", F.explode(F.array_compact(F.array(*met)) if met else none).alias("n"))
    found = keyed.groupBy("n").agg(F.count("*").alias("n_matched"), F.array_sort(F.collect_set("rule_key")).alias("matched_rule_keys"))
    out = about.join(found, "n", "left")
    matched = F.coalesce("n_matched", F.lit(0).cast("long"))
    return out.select("id", "label", "severity", matched.alias("n_matched"), F.coalesce("matched_rule_keys", F.array().cast("array<string>")).alias("matched_rule_keys"), (matched > 0).alias("met"), F.when(matched == 0, F.col("filters")).alias("filters"))


def coverage_issues(found: DataFrame) -> DataFrame:
    """(severity, category, details): an issue for each expectation that no rule met, with what it asked for."""
    details = F.to_json(F.struct("id", "label", "filters"))
    return found.where(~F.col("met")).select("severity", F.lit("expected_coverage_missing").alias("category"), details.alias("details"))


def run_summary(rules: DataFrame, documents: DataFrame, candidates: DataFrame, citations: DataFrame, links: DataFrame, missing: DataFrame) -> DataFrame:
    """A run's counts in one row: sources, documents, candidates (rules if there are none), published rules, citations, species links, versions gone missing."""
    done = rules.agg(F.countDistinct(F.coalesce("source_url", F.lit(""))).alias("n_sources"), F.count("*").alias("n_published"))
    for name, df in (("n_documents", documents), ("n_candidates", candidates), ("n_citations", citations), ("n_species_links", links), ("n_missing_versions", missing)):
        done = done.join(df.agg(F.count("*").alias(name)), how="cross")
    return done.withColumn("n_candidates", F.when(F.col("n_candidates") > 0, F.col("n_candidates")).otherwise(F.col("n_published")))
