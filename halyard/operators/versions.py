"""Versioned history of rules, documents' fetch state, citations and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.functions.text import metric_text, normalize_spaces, strip_spaces
from halyard.operators import merge
from halyard.operators.rules import unit_share
from halyard.operators.textmining import parse_date, quote_in

#: A rule's parts that make its version, in order (fixed values).
FINGERPRINT = (
    "rule_type", "activity_type", "constraint_type", "title", "description", "legal_reference", "metric_type", "metric_value", "metric_unit",
    "species_common_name", "species_scientific_name", "zone_code", "valid_from", "valid_to",
)


def fingerprint(columns: list[str], fields: tuple[str, ...] = FINGERPRINT) -> Column:
    """SHA-256 of a rule's parts, lower-cased with single spaces; a part that lacks is empty, so places stay. Addresses and notes are none of them."""
    def part(c: str) -> Column:
        if c not in columns:
            return F.lit("")
        return metric_text(F.col(c)) if c == "metric_value" else F.coalesce(F.lower(normalize_spaces(F.col(c).cast("string"))), F.lit(""))

    return F.sha2(F.concat_ws("|", *map(part, fields)), 256)


def sync_versions(history: DataFrame, incoming: DataFrame, run_id: str, now: Column) -> DataFrame:
    """The history after a run: versions seen are current under the status they come with, current ones of other fingerprints of their rules are closed.

    history: rule_key, rule_fingerprint, is_current, status, observed_from,
    observed_to, last_seen_run_id. incoming: rule_key, rule_fingerprint, and
    perhaps status and needs_manual_review; without a status a rule is
    needs_review or published. observed_from is set when a version is first
    seen and stays when it comes back; a closed version keeps its status.
    """
    given = lambda c, kind: F.col(c) if c in incoming.columns else F.lit(None).cast(kind)
    status = F.coalesce(F.nullif(given("status", "string"), F.lit("")), F.when(F.coalesce(given("needs_manual_review", "boolean"), F.lit(False)), "needs_review").otherwise("published"))
    new = incoming.groupBy("rule_key", "rule_fingerprint").agg(F.max(status).alias("_status"))
    touched = incoming.select("rule_key").distinct().withColumn("_key", F.lit(True))
    both = history.withColumn("_old", F.lit(True)).join(new, ["rule_key", "rule_fingerprint"], "full_outer").join(touched, "rule_key", "left")
    seen, stale = F.col("_status").isNotNull(), F.col("_status").isNull() & F.col("_key").isNotNull() & F.coalesce("is_current", F.lit(False))
    return both.select(
        "rule_key", "rule_fingerprint",
        F.when(seen, True).when(stale, False).otherwise(F.col("is_current")).alias("is_current"),
        F.coalesce("_status", "status").alias("status"),
        F.when(F.col("_old").isNull(), now).otherwise(F.col("observed_from")).alias("observed_from"),
        F.when(seen, None).when(stale, now).otherwise(F.col("observed_to")).alias("observed_to"),
        F.when(seen, run_id).otherwise(F.col("last_seen_run_id")).alias("last_seen_run_id"),
    )


def sync_table(spark: SparkSession, path: str, incoming: DataFrame, run_id: str, now: Column, buckets: int = 64) -> int:
    """``sync_versions`` on a history under path, in folders by bucket of its rule_key; only buckets of incoming rules are read and written."""
    bucket = F.pmod(F.xxhash64("rule_key"), F.lit(buckets)).cast("int").alias("bucket")
    history = "rule_key string, rule_fingerprint string, is_current boolean, status string, observed_from timestamp, observed_to timestamp, last_seen_run_id string"

    def change(old: DataFrame) -> DataFrame:
        rows = old.drop("bucket") if "is_current" in old.columns else spark.createDataFrame([], history)
        return sync_versions(rows, incoming, run_id, now).select("*", bucket)

    return merge.rewrite_partitions(spark, path, "bucket", incoming.select("*", bucket), change)


def close_missing(history: DataFrame, seen: DataFrame, run_id: str, now: Column) -> DataFrame:
    """The history with current versions of rules that were not seen closed by this run as possibly_removed; unchanged if nothing was seen."""
    any_seen = seen.agg((F.count("*") > 0).alias("_any"))
    marked = history.join(seen.select("rule_key").distinct().withColumn("_seen", F.lit(True)), "rule_key", "left").join(any_seen, how="cross")
    gone = F.col("_any") & F.col("_seen").isNull() & F.col("is_current")
    return marked.select(
        "rule_key", "rule_fingerprint",
        F.when(gone, False).otherwise(F.col("is_current")).alias("is_current"),
        F.when(gone, "possibly_removed").otherwise(F.col("status")).alias("status"),
        "observed_from", F.when(gone, now).otherwise(F.col("observed_to")).alias("observed_to"),
        F.when(gone, run_id).otherwise(F.col("last_seen_run_id")).alias("last_seen_run_id"),
    )


def document_diff(fetched: DataFrame, state: DataFrame, now: Column, recheck_hours: int = 20) -> DataFrame:
    """(url, outcome, first_fetched_at): new, changed, unchanged_hash, recent_skip, error_reused or not_fetched.

    fetched: url, content_hash (null if fetching failed), fetched_at; state: url,
    content_hash, checked_at, first_fetched_at.
    """
    s = state.select("url", F.col("content_hash").alias("_hash"), "checked_at", "first_fetched_at", F.lit(True).alias("_known"))
    both = fetched.withColumn("_got", F.lit(True)).join(s, "url", "full_outer")
    known, recent = F.col("_known").isNotNull(), F.col("checked_at") > now - F.make_dt_interval(F.lit(0), F.lit(recheck_hours))
    outcome = (
        F.when(F.col("_got").isNull(), "not_fetched")
        .when(known & recent, "recent_skip")
        .when(F.col("content_hash").isNull(), F.when(known, "error_reused").otherwise("error"))
        .when(~known, "new")
        .when(F.col("content_hash") == F.col("_hash"), "unchanged_hash")
        .otherwise("changed")
    )
    first = F.when(outcome.isin("unchanged_hash", "recent_skip", "error_reused", "not_fetched"), F.col("first_fetched_at")).otherwise(F.col("fetched_at"))
    return both.select("url", outcome.alias("outcome"), first.alias("first_fetched_at"))


def reuse_rules(outcomes: DataFrame, previous: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rules, lost): previous rules of unchanged documents and fresh ones of the others; unchanged urls without previous rules."""
    same = outcomes.where(F.col("outcome").isin("unchanged_hash", "recent_skip", "error_reused")).select("url")
    kept = previous.join(same, "url", "left_semi")
    return kept.unionByName(fresh.join(same, "url", "left_anti")), same.join(previous, "url", "left_anti")


#: What is known of a fetched document: its columns, and their types (fixed values).
DOCUMENT_FIELDS = {
    "document_hash": "string", "content_hash": "string", "canonical_url": "string", "content_length": "long", "raw_storage_path": "string",
    "fetched_at": "timestamp", "checked_at": "timestamp", "etag": "string", "last_modified": "string", "fetch_status": "string",
}
#: Of these the two that always are the document's own, whatever the rule said before.
OWN_FIELDS = ("canonical_url", "fetch_status")


def attach_documents(rules: DataFrame, documents: DataFrame) -> DataFrame:
    """rules (url) with their document's ten fields as a struct, and its document_hash beside.

    A field the document lacks, or has as an empty text, keeps what the rule's
    own document struct says, if it has one. The address the document is known
    by is its canonical one. A rule whose document is not known stays as it is.
    """
    has = lambda c, kind: F.nullif(F.col(c).cast("string"), F.lit("")).cast(kind) if kind == "string" else F.col(c).cast(kind)
    given = {c: F.col("url") if c == "canonical_url" else has(c, k) if c in documents.columns else F.lit(None).cast(k) for c, k in DOCUMENT_FIELDS.items()}
    d = documents.select("url", F.struct(*[v.alias(c) for c, v in given.items()]).alias("_document"))
    before = set(rules.schema["document"].dataType.names) if "document" in rules.columns else set()
    old = lambda c: F.col(f"document.{c}") if c in before else F.lit(None).cast(DOCUMENT_FIELDS[c])
    known = F.col("_document").isNotNull()
    merged = F.struct(*[(F.when(known, F.col(f"_document.{c}")).otherwise(old(c)) if c in OWN_FIELDS else F.coalesce(f"_document.{c}", old(c))).alias(c) for c in DOCUMENT_FIELDS])
    rows = rules.join(d, "url", "left")
    own_hash = F.col("document_hash") if "document_hash" in rules.columns else F.lit(None).cast("string")
    return rows.withColumns({"document": F.when(known | F.lit(bool(before)), merged), "document_hash": F.coalesce("_document.document_hash", own_hash)}).drop("_document")


AUDIT_ISSUE = "array<struct<category:string,severity:string>>"


def apply_audit(rules: DataFrame, audit: DataFrame, least: float = 0.65) -> DataFrame:
    """rules with what an audit found: its score, quotes and dates its context bears out, flags, and review where it doubts.

    audit, one row a rule_key: score (0 to 1, or to 100), reason, quote,
    quote_reason, valid_from and valid_to (as written), date_quote,
    date_confidence, date_reason, issues (array of category, severity); what it
    lacks counts as null. Without a score only its issues count. A date is
    taken only where the audit's date quote stands in the rule's words, and
    only where the rule has none; the rule's dates then are the audit's by
    source, quote and confidence, even if it had both.
    """
    text = lambda c: F.nullif(normalize_spaces(F.col(c).cast("string")), F.lit("")) if c in audit.columns else F.lit(None).cast("string")
    plain = lambda c: F.nullif(strip_spaces(F.col(c).cast("string")), F.lit("")) if c in audit.columns else F.lit(None).cast("string")
    share = lambda c: unit_share(F.col(c).cast("double")) if c in audit.columns else F.lit(None).cast("double")
    issues = F.col("issues").cast(AUDIT_ISSUE) if "issues" in audit.columns else F.array().cast(AUDIT_ISSUE)
    day = lambda c: parse_date(F.col(c).cast("string")) if c in audit.columns else F.lit(None).cast("date")
    a = audit.select(
        "rule_key", share("score").alias("_score"), plain("reason").alias("_reason"), text("quote").alias("_quote"), plain("quote_reason").alias("_quote_reason"), day("valid_from").alias("_from"), day("valid_to").alias("_to"),
        text("date_quote").alias("_date_quote"), share("date_confidence").alias("_date_confidence"), plain("date_reason").alias("_date_reason"), F.coalesce(issues, F.array().cast(AUDIT_ISSUE)).alias("_issues"),
    )
    rows = rules.join(a, "rule_key", "left")
    kept = lambda c, kind="string": F.col(c) if c in rules.columns else F.lit(None).cast(kind)
    words = F.concat_ws(" ", *[kept(c) for c in ("source_context", "source_excerpt", "description", "source_title", "source_url")])
    scored = F.col("_score").isNotNull()
    quoted = scored & quote_in(F.col("_quote"), words)
    dated = scored & quote_in(F.col("_date_quote"), words) & (F.col("_from").isNotNull() | F.col("_to").isNotNull())
    low = scored & (F.col("_score") < least)
    found = F.coalesce("_issues", F.array().cast(AUDIT_ISSUE))
    flags = F.concat(F.when(low, F.array(F.lit("ai_low_confidence"))).otherwise(F.array().cast("array<string>")), F.transform(found, lambda i: F.concat(F.lit("ai_"), F.coalesce(F.nullif(i["category"], F.lit("")), F.lit("ai_audit")))))
    serious = F.exists(found, lambda i: F.coalesce(F.nullif(i["severity"], F.lit("")), F.lit("warning")).isin("warning", "error"))
    changed = {
        "confidence_score": F.coalesce("_score", kept("confidence_score", "double")),
        "confidence_source": F.when(scored, "ai").otherwise(kept("confidence_source")),
        "confidence_reason": F.coalesce(F.when(scored, F.col("_reason")), kept("confidence_reason")),
        "selected_quote": F.when(quoted, F.col("_quote")).otherwise(kept("selected_quote")),
        "selected_quote_source": F.when(quoted, "ai").otherwise(kept("selected_quote_source")),
        "selected_quote_reason": F.coalesce(F.when(quoted, F.col("_quote_reason")), kept("selected_quote_reason")),
        "valid_from": F.coalesce(kept("valid_from", "date"), F.when(dated, F.col("_from"))),
        "valid_to": F.coalesce(kept("valid_to", "date"), F.when(dated, F.col("_to"))),
        "effective_date_source": F.when(dated, "ai").otherwise(kept("effective_date_source")),
        "effective_date_quote": F.when(dated, F.col("_date_quote")).otherwise(kept("effective_date_quote")),
        "effective_date_reason": F.coalesce(F.when(dated, F.col("_date_reason")), kept("effective_date_reason")),
        "effective_date_confidence": F.when(dated, F.coalesce(F.nullif("_date_confidence", F.lit(0.0)), "_score")).otherwise(kept("effective_date_confidence", "double")),
        "quality_flags": F.array_union(F.coalesce(kept("quality_flags", "array<string>"), F.array().cast("array<string>")), flags),
        "needs_manual_review": F.coalesce(kept("needs_manual_review", "boolean"), F.lit(False)) | F.coalesce(low, F.lit(False)) | serious,
    }
    return rows.withColumns(changed).drop(*[c for c in a.columns if c.startswith("_")])


def promote(candidates: DataFrame, labels: DataFrame, least: float = 0.75) -> DataFrame:
    """candidates accepted where a label of their url finds them relevant with enough confidence; each once, however many labels it has."""
    found = labels.where(F.col("relevant") & (F.col("confidence") >= least)).select("url", F.lit(True).alias("_found")).distinct()
    rows = candidates.join(found, "url", "left")
    up = (F.col("status") == "candidate") & F.coalesce("_found", F.lit(False))
    return rows.withColumn("status", F.when(up, "auto_accepted").otherwise(F.col("status"))).drop("_found")


def species_links(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(species, links): distinct species records, and (rule_key, canonical_name) pairs, of rules with species (array of records)."""
    each = rules.select("rule_key", F.explode("species").alias("s"))
    species = each.groupBy(F.col("s.canonical_name").alias("canonical_name")).agg(F.max("s.scientific_name").alias("scientific_name"))
    return species, each.select("rule_key", F.col("s.canonical_name").alias("canonical_name")).distinct()


#: Fields of a citation, and what its rule says of each where it has no citation of its own (fixed values).
CITATION = ("source_url", "source_title", "authority_name", "quote", "locator", "document_hash", "content_hash", "raw_storage_path", "confidence_score", "page_number")


def primary_citation(rules: DataFrame, also: list[str] | None = None) -> DataFrame:
    """(rule_key, the fields of a citation, and rules' columns asked for also) of each rule: the first of its citations, else its source and description.

    A rule's own citation takes only what it lacks of content_hash and
    raw_storage_path from the rule. One made up from the rule quotes its
    description, stands where its legal reference or key says, and has a
    document hash that tells it is made up. What rules or their citations lack
    counts as null.
    """
    has = lambda c: F.col(c).cast("string") if c in rules.columns else F.lit(None).cast("string")
    some = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])
    made = {
        "source_url": has("source_url"), "source_title": has("source_title"), "authority_name": has("authority_name"), "quote": F.coalesce(has("description"), F.lit("")),
        "locator": some(has("legal_reference"), has("rule_key")), "document_hash": F.concat(F.lit("legacy:"), some(has("source_url"), has("rule_key"))),
        "content_hash": has("content_hash"), "raw_storage_path": has("raw_storage_path"), "confidence_score": has("confidence_score"),
    }
    held = rules.schema["citations"].dataType.elementType.names if "citations" in rules.columns else []
    known = {"source_url": ("source_url", "url"), "confidence_score": ("confidence_score", "confidence")}
    own = F.get("citations", F.lit(0)) if held else F.lit(None)
    fields = []
    for c in CITATION:
        at = next((n for n in known.get(c, (c,)) if n in held), None)
        mine = own[at].cast("string") if at else F.lit(None).cast("string")
        if c in ("content_hash", "raw_storage_path"):
            mine = F.coalesce(mine, made[c])
        fields.append((F.when(own.isNotNull(), mine).otherwise(made.get(c, F.lit(None).cast("string"))) if held else made.get(c, F.lit(None).cast("string"))).alias(c))
    return rules.select("rule_key", *fields, *[has(c).alias(c) for c in also or []])


def chunk_rows(rules: DataFrame) -> DataFrame:
    """(chunk_hash, rule_key, document_hash, chunk_index, text_excerpt, token_estimate, locator): the quote of each rule's first citation, else its description.

    The index is the key's hash in the range of an int, the estimate the
    quote's words, one at least. Of rows of one chunk_hash one stays.
    """
    about = primary_citation(rules, ["description"]).select("rule_key", "document_hash", "locator", "quote", "description")
    quote = F.coalesce(F.nullif("quote", F.lit("")), "description", F.lit(""))
    index = F.conv(F.substring(F.sha1("rule_key"), 1, 8), 16, 10).cast("long") % 2147483647 + 1
    words = F.size(F.filter(F.split(normalize_spaces(quote), " "), lambda w: w != ""))
    rows = about.select(
        F.concat_ws(":", F.coalesce("document_hash", F.lit("None")), "rule_key", index.cast("string")).alias("chunk_hash"), "rule_key", "document_hash", index.alias("chunk_index"),
        quote.alias("text_excerpt"), F.greatest(F.lit(1), words).cast("long").alias("token_estimate"), "locator",
    )
    return merge.last_of_key(rows, ["chunk_hash"])
