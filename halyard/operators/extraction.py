"""Structured rules from document text, in stages.

1. A document is cut and folded once; the pieces some extractor could make use
   of, lines, sentences, units and whole folded texts, are stored as rows.
2. Each group of extractors is a small query over the pieces of its kind and
   gives hits: where, the words, the same folded, and the parts of a rule. All
   hits are stored; they are few beside the texts.
3. Species are found by a join of the hits' words with the dictionary's table.
4. Hits become rules; the words round a rule are cut from its document, which
   is met once for all its rules.

No stage has more than some ten patterns, so each compiles; nothing is carried
that a later stage does not read.

Joins of what grows with the documents are pinned to sort-merge joins: stored
tables of texts that repeat themselves are small files, by whose size a table
of millions of rows would be broadcast, through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halyard.functions.text import bound, constant, contains_any, fold_text, groups_of, normalize_spaces, parse_number, short_hash, slugify
from halyard.operators.textmining import DECLARING, NO_SPECIES, SENSITIVE, declaration_contexts, dictionary_rows, entries_met, find_sentence, name_stem, plausible_name, rule_scope, text_lines, text_units, window_in
from halyard.registry import ALL_ZONES, SPECIES, ZONES
from halyard.staging import spread, stored

# Patterns in folded text. A line begins with a name and perhaps a scientific name (groups 1 and 2); group 3 is the number.
NAME = r"^([a-z'\-\s]{3,})(?:\s*\(([^)]+)\))?"
UNITS = r"captures?|specimens?|unites?"
SIZE_LINES = (rf"{NAME}\s*[:;\-]\s*(\d+(?:[\.,]\d+)?)\s*cm\b", rf"{NAME}\s+(\d+(?:[\.,]\d+)?)\s*cm\b")
#: Quotas of lines: pattern, whether in kilograms; that of a table has its unit in group 4 and needs a document that speaks of days.
QUOTA_LINES = (
    (rf"{NAME}\s*[:;\-]\s*(\d+)\s*(?:{UNITS})\s*(?:par|/)\s*jour", False),
    (rf"{NAME}\s*[:;\-]\s*(\d+(?:[\.,]\d+)?)\s*kg\s*(?:par|/)\s*jour", True),
    (rf"{NAME}\s*[:;\-]\s*(\d+)\s*(?:{UNITS})\s*(?:max(?:imum)?)?\s*(?:par|/)\s*(?:pecheur|navire)\s*et\s*par\s*jour", False),
    (rf"{NAME}\s*[:;\-]\s*(\d+(?:[\.,]\d+)?)\s*kg\s*(?:max(?:imum)?)?\s*(?:par|/)\s*(?:pecheur|navire)\s*et\s*par\s*jour", True),
)
QUOTA_TABLE = rf"{NAME}(?:\s+[a-z'\-\s]{{0,200}})?\s+(\d+(?:[\.,]\d+)?)\s*(kg|kilogrammes?|{UNITS})\b"
DAILY = ("par pecheur et par jour", "par navire et par jour")
EACH = r"par\s+(?:pecheur|navire)\s+et\s+par\s+jour"
NUMBER = r"(\d+|un|une|deux|trois|quatre|cinq|six|sept|huit|neuf|dix)"
#: Quotas of running text: pattern, group of the number, group of the name or the name itself, whether in kilograms.
QUOTA_TEXTS = (
    (rf"pas plus de\s+{NUMBER}\s+specimens?\s+de\s+([a-z'\-\s]{{3,}}?)\s+(?:ne\s+peuvent|peuvent|sont|doivent|seront|$)[^\.]*?{EACH}", 1, 2, False),
    (rf"peche\s+(?:sous\s*-\s*marine\s+)?(?:du|de|des)\s+([a-z'\-\s]{{3,}}?)\s+est limitee?\s+a\s+{NUMBER}\s+(?:unites?|specimens?|captures?|individus?)[^\.]*?{EACH}", 2, 1, False),
    (rf"quantite totale de\s+(\d+(?:[\.,]\d+)?)\s*kg\s+de\s+([a-z'\-\s]{{3,}}?)\s+{EACH}", 1, 2, True),
    (rf"captures?\s+sont\s+limitees?\s+{EACH}\s+a\s+(\d+(?:[\.,]\d+)?)\s*(?:kg|kilogrammes?)[^\.]*toutes?\s+especes?", 1, "toutes especes marines", True),
    (r"(\d+|un|une)\s+thon\s+rouge\s+par\s+navire\s+et\s+par\s+jour", 1, "thon rouge", False),
)
#: What a text with any of these quotas has in it; the shortest quota has more than QUOTA_CHARS characters.
QUOTA_SIGN, QUOTA_CHARS, AROUND = r"par\s+(?:pecheur|navire)\s+et\s+par\s+jour", 20, 220
PERIOD = r"du\s+(\d{1,2}\s*(?:er)?\s+[a-z]+(?:\s+\d{4})?)\s+au\s+(\d{1,2}\s*(?:er)?\s+[a-z]+(?:\s+\d{4})?)"
BANS = ("interdit", "aucun specimen", "fermeture", "no-kill")
# What practice rules are about, that they bind, and what does not count; sources that have none.
PRACTICE = ("engin", "filet", "casier", "palangre", "hamecon", "marquage", "nageoire", "vente", "equipement respiratoire", "bouteille", "lampe", "harpon", "debarquement", "transport")
BINDING = ("il est interdit", "est interdite", "est interdit", "sont interdit", "est obligatoire", "doit etre", "doivent etre", "sont autorises", "sont autorisees", "est autorise", "est autorisee", "la vente")
FRAGMENTS = (
    "signifie pas", "cette liste sera elargie", "reservee a certains engins", "obligation de debarquement", "zones interdites ou dangereuses",
    "respecter les tailles reglementaires", "engins autorises et tailles minimales", "listent les engins autorises",
)
SITE_NOISE = ("cookie", "newsletter", "mentions legales", "contact")
NO_PRACTICE_SOURCES = ("manuel", "recfishing")
DECLARED = ("recfishing", "declaration", "enregistrement")
DECLARATION_TEXT = " figure parmi les especes sensibles soumises a enregistrement et declaration des captures via RecFishing selon la zone applicable."
# Rules of statutes: name, key, words that stand in one sentence or three.
STATUTES = (
    ("age", "spearfishing.fr.min-age.fusil-harpon", ("peche", "sous", "marine", "fusil", "harpon", "moins", "ans")),
    ("diving", "diving.fr.code-sport.section-a322-71", ("etablissements", "pratique", "plongee", "subaquatique")),
)
AGE = r"(?i)moins de\s*(\d+|seize)\s*ans"
# Clauses of the ministry's pages: what stands in the folded page, title, description.
CLAUSES = (
    ("ne pas utiliser d'equipement respiratoire", "Interdiction d'utiliser un equipement respiratoire en peche sous-marine", "Ne pas utiliser d'equipement respiratoire."),
    ("avoir plus de 16 ans", "Age minimum en peche sous-marine", "Avoir plus de 16 ans et une bonne condition physique."),
    ("ne pas pratiquer la peche sous-marine la nuit", "Interdiction de la peche sous-marine de nuit", "Ne pas pratiquer la peche sous-marine la nuit."),
)
STATUTE_SOURCES, MINISTRY = ("LEGIFRANCE",), "MINISTERE_MER"
OPERATIONAL_SOURCES = ("DIRM", "MINISTERE_MER", "PREFECTURE_MARITIME", "PREFECTURE_DEPARTEMENTALE", "DATA_GOUV")
# Of each extractor: type of rule, title (before the species, if it has one), legal reference, notes.
KINDS = {
    "size": ("MIN_SIZE", "Taille minimale de capture - ", "Arrete du 26 octobre 2012 modifie (rappels DIRM)", "Extraction automatique depuis document operationnel, validation manuelle requise."),
    "quota": ("QUOTA", "Quota de capture - ", "Document operationnel DIRM - quotas peche de loisir", "Extraction automatique de quotas, validation manuelle obligatoire."),
    "closure": ("CLOSURE_PERIOD", "Periode de fermeture - ", "Document operationnel DIRM - restrictions temporelles", "Extraction automatique des periodes de fermeture, validation manuelle obligatoire."),
    "protected": ("PROTECTED_SPECIES", "Interdiction de capture - ", "Document operationnel DIRM - restrictions par espece", "Extraction automatique des interdictions par espece, validation manuelle obligatoire."),
    "practice": ("PRACTICE_RULE", "Regle de pratique de peche de loisir", "Document operationnel - pratiques de peche de loisir", "Extraction automatique d'une regle de pratique, validation manuelle recommandee."),
    "declaration": ("LOCAL_RESTRICTION", "Declaration des captures - ", "Reglement UE 2023/2842 et dispositifs nationaux d'application", "Extraction automatique des obligations declaratives d'especes sensibles."),
    "clause": ("SPEARFISHING_GENERAL", "", "Page ministerielle peche de loisir en mer", "Source operationnelle ministerielle, verification manuelle recommandee."),
    "age": ("SPEARFISHING_GENERAL", "Age minimum pour la peche sous-marine au fusil-harpon", "Code rural et de la peche maritime - Article R921-90", "Regle generale issue de Legifrance."),
    "diving": ("DIVING_GENERAL", "Cadre de securite des etablissements de plongee subaquatique", "Code du sport - Article A322-71", "Regle generale de plongee issue de Legifrance."),
}

DOCUMENT = ("doc", "text", "source_scope", "source_type", "url", "source_url", "source_title")
#: Kinds of pieces: a document's folded text, its lines, sentences, units, and units of documents that speak of declaring catches.
WHOLE, LINE, SENTENCE, UNIT, DECLARING_UNIT = "whole", "line", "sentence", "unit", "declaring"
PIECE = "array<struct<piece:string,place:int,said:string,f:string>>"
HIT = {"kind": "string", "place": "long", "said": "string", "f": "string", "name": "string", "scientific": "string", "number": "string", "kg": "boolean", "first": "string", "last": "string"}


def documents(docs: DataFrame) -> DataFrame:
    """docs (doc, text, source_scope, source_type) with the other columns extraction looks at, empty where they lack."""
    have = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    return docs.select("doc", have("text").alias("text"), "source_scope", "source_type", *[have(c).alias(c) for c in DOCUMENT[4:]])


def pieces(own: DataFrame) -> DataFrame:
    """(doc, source_type, practice, daily, piece, place, said, f): the pieces of documents that an extractor could make use of.

    practice: whether the source may have practice rules; daily: whether the
    document speaks of what is taken a day.
    """
    kind, flat, text = F.col("source_type"), F.col("flat"), F.col("text")
    operational, statute = kind.isin(*OPERATIONAL_SOURCES), kind.isin(*STATUTE_SOURCES)
    folded = own.where(operational | statute).select("doc", "source_type", "text", fold_text(text).alias("flat"), (~contains_any(fold_text(F.concat_ws(" ", "url", "source_title")), NO_PRACTICE_SOURCES)).alias("practice"))
    declares = contains_any(flat, SENSITIVE) & contains_any(flat, DECLARED)
    # folded here, before the rows: a filter on a column worked out after them would work it out again for each of its terms
    cut = lambda piece, parts, fold=fold_text: F.transform(parts, lambda x, i: F.struct(F.lit(piece).alias("piece"), i.alias("place"), x.alias("said"), fold(x).alias("f")))
    none = F.array().cast(PIECE)
    lawful = statute & reduce(lambda a, b: a | b, [reduce(lambda a, w: a & flat.contains(w), words, F.lit(True)) for _, _, words in STATUTES])
    whole = (operational & flat.rlike(QUOTA_SIGN)) | ((kind == MINISTRY) & contains_any(flat, tuple(c[0] for c in CLAUSES)))
    parts = F.concat(
        F.when(operational & flat.rlike("[0-9]"), cut(LINE, text_lines(text))).otherwise(none),
        F.when(operational & contains_any(flat, BANS), cut(SENTENCE, F.split(normalize_spaces(text), r"(?<=[.;!?])\s+"))).otherwise(none),
        F.when(operational | lawful, cut(UNIT, text_units(text))).otherwise(none),
        F.when(whole, cut(WHOLE, F.array(flat), lambda x: x)).otherwise(none),
    )
    said = folded.select("doc", "source_type", "practice", contains_any(flat, DAILY).alias("daily"), (operational & declares).alias("declares"), F.explode(parts).alias("p"))
    known = said.select("doc", "source_type", "practice", "daily", "declares", "p.*")
    f, piece = F.col("f"), F.col("piece")
    useful = (
        F.when(piece == LINE, f.rlike("[0-9]"))
        .when(piece == SENTENCE, contains_any(f, BANS))
        .when(piece == UNIT, statute | F.col("declares") | f.contains("interdit") | contains_any(f, PRACTICE))
        .otherwise(True)
    )
    kept = known.where(useful)
    return kept.withColumn("piece", F.when((piece == UNIT) & F.col("declares"), DECLARING_UNIT).otherwise(piece)).drop("declares")


def _hits(rows: DataFrame, kind: Column | str, place: Column, **parts: Column) -> DataFrame:
    """Hits of pieces: said and f of the piece unless given, what an extractor has not is null."""
    given = {"kind": F.lit(kind) if isinstance(kind, str) else kind, "place": place, "said": F.col("said"), "f": F.col("f"), **parts}
    return rows.select("doc", *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in HIT.items()])


def line_hits(found: DataFrame) -> DataFrame:
    """Sizes and quotas of lines; each pattern may find one in a line."""
    lines = found.where(F.col("piece") == LINE)
    f = F.col("f")
    one = lambda kind, n, parts, kg: F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("nth"), parts.alias("parts"), kg.alias("kg"))
    options = [one("size", n, groups_of(f, p, 3), F.lit(False)) for n, p in enumerate(SIZE_LINES)]
    options += [one("quota", n, groups_of(f, p, 3), F.lit(kg)) for n, (p, kg) in enumerate(QUOTA_LINES)]
    options.append(bound(F.when(F.col("daily") | f.contains("par jour"), groups_of(f, QUOTA_TABLE, 4)), lambda g: one("quota", len(QUOTA_LINES), g, F.coalesce(F.get(g, F.lit(3)).contains("kg"), F.lit(False)))))
    rows = lines.select("doc", "place", "said", "f", F.explode(F.filter(F.array(*options), lambda o: o["parts"].isNotNull())).alias("o"))
    part = lambda i: F.get("o.parts", F.lit(i))
    return _hits(rows, F.col("o.kind"), F.col("place").cast("long") * 10 + F.col("o.nth"), name=part(0), scientific=F.nullif(normalize_spaces(part(1)), F.lit("")), number=part(2), kg=F.col("o.kg"))


def text_hits(found: DataFrame) -> DataFrame:
    """Quotas of running text, each with up to AROUND characters before and after it.

    A text is cut at a pattern's matches into rows; what stands round a match
    is put together from the rows beside it, of which AROUND characters hold
    few, a quota being longer than QUOTA_CHARS.
    """
    whole = found.where((F.col("piece") == WHOLE) & F.col("source_type").isin(*OPERATIONAL_SOURCES)).select("doc", "f")
    near = -(-AROUND // QUOTA_CHARS)
    cut = lambda n, p: F.when(F.col("f").rlike(p), F.struct(F.lit(n).alias("nth"), F.arrays_zip(F.split("f", p).alias("between"), F.regexp_extract_all("f", F.lit(p), F.lit(0)).alias("hit")).alias("parts")))
    cuts = whole.select("doc", F.explode(F.filter(F.array(*[cut(n, q[0]) for n, q in enumerate(QUOTA_TEXTS)]), lambda c: c.isNotNull())).alias("c"))
    rows = cuts.select("doc", F.col("c.nth").alias("nth"), F.posexplode("c.parts").alias("at", "x")).select("doc", "nth", "at", "x.between", "x.hit")
    of = lambda values: F.coalesce(*[F.when(F.col("nth") == n, v) for n, v in enumerate(values)])
    groups = of([groups_of(F.col("hit"), p, 2 if isinstance(name, int) else 1) for p, _, name, _ in QUOTA_TEXTS])
    part = lambda i: F.get("groups", F.lit(i - 1))
    order = W.partitionBy("doc", "nth").orderBy("at")
    joined = lambda c, a, b: F.array_join(F.collect_list(c).over(order.rowsBetween(a, b)), "")
    ends = rows.withColumns({"tail": F.concat(F.right("between", F.lit(AROUND)), F.coalesce("hit", F.lit(""))), "head": F.concat(F.left("between", F.lit(AROUND)), F.coalesce("hit", F.lit("")))})
    ends = ends.withColumns({"before": F.concat(joined("tail", -near, -1), F.col("between")), "after": joined("head", 1, near)}).where("hit is not null")
    around = F.concat(F.right("before", F.lit(AROUND)), F.col("hit"), F.left("after", F.lit(AROUND)))
    said = ends.select("doc", "nth", "at", around.alias("f"), groups.alias("groups"))
    place = (F.col("nth") + 1).cast("long") * (1 << 40) + F.col("at")
    names, kilograms = [part(name) if isinstance(name, int) else F.lit(name) for _, _, name, _ in QUOTA_TEXTS], [F.lit(kg) for *_, kg in QUOTA_TEXTS]
    return _hits(said, "quota", place, said=normalize_spaces(F.col("f")), name=of(names), number=of([part(number) for _, number, _, _ in QUOTA_TEXTS]), kg=of(kilograms))


def sentence_hits(found: DataFrame) -> DataFrame:
    """Closed seasons: a sentence that bans, with a period."""
    rows = found.where(F.col("piece") == SENTENCE).withColumn("parts", groups_of(F.col("f"), PERIOD, 2)).where("parts is not null")
    part = lambda i: normalize_spaces(F.get("parts", F.lit(i)))
    return _hits(rows, "closure", F.col("place"), first=part(0), last=part(1))


def unit_hits(found: DataFrame) -> DataFrame:
    """Forbidden species, and practice rules."""
    units = found.where(F.col("piece").isin(UNIT, DECLARING_UNIT) & F.col("source_type").isin(*OPERATIONAL_SOURCES))
    f = F.col("f")
    protected = f.contains("interdit") & contains_any(f, ("peche", "capture", "detention"))
    binds = F.length("said").between(45, 520) & contains_any(f, PRACTICE) & contains_any(f, BINDING) & contains_any(f, ("peche", "capture", "loisir"))
    practice = F.col("practice") & binds & ~contains_any(f, SITE_NOISE + FRAGMENTS)
    kinds = F.filter(F.array(F.when(protected, "protected"), F.when(practice, "practice")), lambda k: k.isNotNull())
    return _hits(units.withColumn("kind", F.explode(kinds)), F.col("kind"), F.col("place"))


def declaration_hits(found: DataFrame) -> DataFrame:
    """The context of a duty to declare catches of sensitive species, if the text has both."""
    units = found.where(F.col("piece") == DECLARING_UNIT).select("doc", F.col("place").alias("position"), F.col("said").alias("unit"), "f")
    contexts = declaration_contexts(units, "doc", SENSITIVE, DECLARING).select("doc", F.col("context").alias("said")).withColumn("f", fold_text(F.col("said")))
    return _hits(contexts.where(contains_any(F.col("f"), SENSITIVE) & contains_any(F.col("f"), DECLARED)), "declaration", F.lit(0))


def clause_hits(found: DataFrame) -> DataFrame:
    """Clauses of the ministry's pages."""
    whole = found.where((F.col("piece") == WHOLE) & (F.col("source_type") == MINISTRY))
    clause = lambda n, c: F.when(F.col("f").contains(c[0]), F.struct(F.lit(n).alias("n"), F.lit(c[1]).alias("title"), F.lit(c[2]).alias("said")))
    rows = whole.select("doc", F.explode(F.filter(F.array(*[clause(n, c) for n, c in enumerate(CLAUSES)]), lambda c: c.isNotNull())).alias("c"))
    rows = rows.select("doc", "c.n", "c.title", "c.said").withColumn("f", F.lower(normalize_spaces(F.col("said"))))
    return _hits(rows, "clause", F.col("n"), name=F.col("title"))


def statute_hits(found: DataFrame) -> DataFrame:
    """Rules of statutes: of each the first unit with all its words, else the first run of three units that has them."""
    units = found.where((F.col("piece") == UNIT) & F.col("source_type").isin(*STATUTE_SOURCES))
    order = W.partitionBy("doc").orderBy("place")
    three = units.withColumns({c: F.concat_ws(" ", c, F.lead(c).over(order), F.lead(c, 2).over(order)) for c in ("said", "f")})
    # a run counts after all single units; its number tells it from them
    runs = units.withColumn("of", F.lit(0)).unionByName(three.withColumn("of", F.lit(1)))
    every = lambda words: reduce(lambda a, w: a & F.col("f").contains(w), words, F.lit(True))
    rule = lambda n, kind, key, words: F.when(every(words), F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), F.lit(key).alias("key")))
    met = runs.select("doc", "of", "place", "said", "f", F.explode(F.filter(F.array(*[rule(n, *s) for n, s in enumerate(STATUTES)]), lambda r: r.isNotNull())).alias("r"))
    first = met.groupBy("doc", F.col("r.n").alias("n"), F.col("r.kind").alias("kind"), F.col("r.key").alias("key")).agg(F.min_by(F.struct("said", "f"), F.struct("of", "place")).alias("s"))
    rows = first.select("doc", "n", "kind", "key", "s.said", "s.f")
    age = F.when(F.col("kind") == "age", F.nullif(F.lower(F.regexp_extract("said", AGE, 1)), F.lit("")))
    return _hits(rows, F.col("kind"), F.col("n"), name=F.col("key"), number=age)


EXTRACTORS = (line_hits, text_hits, sentence_hits, unit_hits, declaration_hits, clause_hits, statute_hits)


def extract(docs: DataFrame, base: DataFrame | None = None, dictionary: DataFrame | None = None) -> DataFrame:
    """Rules of documents, each by the extractors of its source's type; with base, static rules beside them.

    docs: doc (a key), text, source_scope, source_type, and perhaps url (the
    document's), source_url and source_title. dictionary: place, name,
    spelling; without one the registry's species. Of each rule_key a document's
    first is kept. Documents without text or key, and sources of other types,
    give none.
    """
    own = documents(docs).where("doc is not null")
    found = stored(pieces(spread(own)), "rule-pieces")
    hits = reduce(DataFrame.union, [h(found) for h in EXTRACTORS])
    hits = stored(hits.withColumn("hit", F.monotonically_increasing_id()), "rule-hits")
    named = stored(_named(hits, dictionary if dictionary is not None else dictionary_rows(docs.sparkSession, SPECIES)), "rule-names")
    rules = _first_of_key(_rules(named, own))
    return rules if base is None else base.unionByName(rules, allowMissingColumns=True)


def _named(hits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Hits with the species they are of, a row each; those that need one and have none are left out.

    A size's or quota's species is the dictionary's first in its name, else in
    its words, else the name's own stem; a ban's or declaration's are all in its
    words; a practice rule's the first, if any.
    """
    kind = F.col("kind")
    of_species = hits.where(kind.isin("size", "quota", "closure", "protected", "declaration", "practice"))
    met = entries_met(of_species, "hit", {"name": "name", "words": "f"}, dictionary)
    rows = hits.join(met.hint("merge"), "hit", "left").withColumn("stem", F.when(kind.isin("size", "quota"), name_stem(F.col("name"))))
    usable = F.when((F.col("stem") != "") & ~F.col("stem").isin(*NO_SPECIES), F.col("stem"))
    rows = rows.withColumn("own", F.when(kind.isin("size", "quota"), F.coalesce("first_name", F.when(usable.isNotNull(), F.coalesce(F.col("first_words"), usable)))))
    named = (
        F.when(kind.isin("size", "quota"), F.when(F.col("own").isNotNull() & ((kind == "size") | plausible_name(F.col("own"))), F.array("own")))
        .when(kind.isin("closure", "protected", "declaration"), F.col("all_words"))
        .when(kind == "practice", F.array("first_words"))
        .otherwise(F.array(F.lit(None).cast("string")))
    )
    value = F.when(kind.isin("size", "quota", "age"), parse_number(F.col("number")))
    rows = rows.select("doc", *HIT, value.alias("value"), F.explode(named).alias("species"))
    return rows.where(F.col("value").isNotNull() | ~kind.isin("size", "quota"))


def _by_kind(values: dict[str, Column | str]) -> Column:
    """What a hit's kind is given, a column or a text."""
    if not any(isinstance(v, Column) for v in values.values()):
        return F.try_element_at(constant(values, "map<string,string>"), F.col("kind"))
    return F.coalesce(*[F.when(F.col("kind") == k, v if isinstance(v, Column) else F.lit(v)) for k, v in values.items()])


def _described(named: DataFrame) -> DataFrame:
    """Named hits with their description, scope and key."""
    kind, species, said, f = (F.col(c) for c in ("kind", "species", "said", "f"))
    told = named.where(kind == "declaration")
    sentence = find_sentence(said, [F.get(F.split(species, " "), F.lit(0))])
    declared = F.when(F.length("sentence") <= 420, F.col("sentence")).otherwise(F.concat(species, F.lit(DECLARATION_TEXT)))
    told = told.withColumn("sentence", sentence).withColumn("description", declared).drop("sentence")
    # a declaration's key goes by its context's scope, its zone by its description's
    told = told.withColumn("zone_f", fold_text(F.col("description")))
    return named.where(kind != "declaration").withColumns({"description": said, "zone_f": f}).unionByName(told)


def _rules(named: DataFrame, own: DataFrame) -> DataFrame:
    """Rule rows of named hits."""
    kind, species, said, f, value = (F.col(c) for c in ("kind", "species", "said", "f", "value"))
    rows = _described(named).join(own.drop("text").hint("merge"), "doc")
    rows = rows.withColumns({"scope": rule_scope(f, F.col("source_scope")), "zone_scope": rule_scope(F.col("zone_f"), F.col("source_scope")), "unit": F.when(F.col("kg"), "kg/jour").otherwise("captures/jour")})
    # scopes, units and the dictionary's names are ASCII; only words of the document have to be folded
    plain = lambda c: F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    name, at = slugify(species), plain(F.col("scope"))
    rows = rows.withColumns({"name_slug": name, "at": at})
    start = F.concat(F.lit("species."), F.col("name_slug"), F.lit("."))
    key = _by_kind({
        "size": F.concat(start, F.lit("min-size."), "at"),
        "quota": F.concat(start, F.lit("quota."), plain(F.col("unit")), F.lit("."), "at"),
        "closure": F.concat(start, F.lit("closure."), plain(F.col("first")), F.lit("."), plain(F.col("last")), F.lit("."), "at"),
        "protected": F.concat(start, F.lit("protected."), "at", F.lit("."), short_hash(said)),
        "practice": F.concat(F.lit("practice."), slugify(F.coalesce(species, F.substring(said, 1, 80))), F.lit(".restriction."), "at", F.lit("."), short_hash(said)),
        "declaration": F.concat(start, F.lit("declaration."), "at"),
        "clause": F.concat(F.lit("spearfishing.fr.ministere."), plain(F.col("name"))),
        "age": F.col("name"),
        "diving": F.col("name"),
    })
    subject = F.when(kind == "practice", F.concat(F.lit(" - "), species)).when(kind == "clause", F.col("name")).otherwise(species)
    metric = {"size": ("SIZE_MIN_CM", "cm"), "quota": (F.when(F.col("kg"), "QUOTA_MAX_KG").otherwise("QUOTA_MAX_UNITS"), F.col("unit")), "age": ("AGE_MIN_YEARS", "ans")}
    made = rows.select(
        "doc", "kind", "place", key.alias("rule_key"), _by_kind({k: v[0] for k, v in KINDS.items()}).alias("rule_type"),
        F.concat(_by_kind({k: v[1] for k, v in KINDS.items()}), F.coalesce(subject, F.lit(""))).alias("title"), "description",
        _by_kind({k: v[2] for k, v in KINDS.items()}).alias("legal_reference"),
        F.when(value.isNotNull(), _by_kind({k: m for k, (m, _) in metric.items()})).alias("metric_type"), value.alias("metric_value"),
        F.when(value.isNotNull(), _by_kind({k: u for k, (_, u) in metric.items()})).alias("metric_unit"),
        species.alias("species_common_name"), F.col("scientific").alias("species_scientific_name"), zone_of(F.col("zone_scope"), F.col("source_scope")).alias("zone"),
        (~kind.isin("age", "diving")).alias("needs_manual_review"), _by_kind({k: v[3] for k, v in KINDS.items()}).alias("notes"),
        F.col("description").alias("source_excerpt"), "said",
        F.when(F.col("url") != "", F.col("url")).otherwise(F.col("source_url")).alias("source_url"),
        F.when((F.col("url") == "") | (F.col("url") == F.col("source_url")), F.col("source_title")).otherwise("").alias("source_title"), "source_type",
    )
    return _in_context(made, own).select("*", "zone.*").drop("zone", "kind", "said")


def _in_context(made: DataFrame, own: DataFrame) -> DataFrame:
    """Rules with the words round their description; a declaration's are all it was found in. A document is met once for all its descriptions."""
    asked = made.where("kind <> 'declaration'").groupBy("doc").agg(F.collect_set("description").alias("all"))
    one = lambda text: F.transform("all", lambda x: F.struct(x.alias("description"), bound(normalize_spaces(x), lambda a: window_in(text, a)).alias("around")))
    round_it = asked.join(own.select("doc", "text").hint("merge"), "doc").select("doc", F.explode(bound(normalize_spaces(F.col("text")), one)).alias("w")).select("doc", "w.*")
    placed = made.join(round_it.hint("merge"), ["doc", "description"], "left")
    return placed.withColumn("source_context", F.when(F.col("kind") == "declaration", F.col("said")).otherwise(F.col("around"))).drop("around")


ZONE_FIELDS = ("zone_code", "zone_name", "zone_strategy", "lat_min", "lat_max", "lon_min", "lon_max")
ZONE = "struct<zone_code:string,zone_name:string,zone_strategy:string,lat_min:double,lat_max:double,lon_min:double,lon_max:double>"


def zone_of(scope: Column, source_scope: Column) -> Column:
    """The zone of a scope, else of its source's, else of all: code, name, strategy and box."""
    every = {"zone_code": ALL_ZONES[0], "zone_name": ALL_ZONES[1], "zone_strategy": "APP_ZONES_UNION"}
    boxes = {s: dict(zip(ZONE_FIELDS, (code, name, "CUSTOM_BBOX", *box), strict=True)) for s, (code, name, *box) in ZONES.items()}
    known = constant(boxes | {"france": every}, f"map<string,{ZONE}>")
    return F.coalesce(F.try_element_at(known, scope), F.try_element_at(known, source_scope), constant(every, ZONE))


def _first_of_key(rules: DataFrame) -> DataFrame:
    w = W.partitionBy("doc", "rule_key").orderBy("place")
    return rules.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").withColumnRenamed("place", "position")
