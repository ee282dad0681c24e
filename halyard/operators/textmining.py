"""Sentences, dictionaries, dates and contexts in documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halyard.functions.text import SPACE, bound, contains_any, fold_text, folded, groups_of, normalize_spaces, slugify
from halyard.registry import MONTHS
from halyard.staging import stored

LINE = r"[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"
LINES = rf"\r\n|{LINE}"
#: Space that ends a sentence: after its mark, or from an end of line on; what is no space is passed over by one look.
UNIT_END = rf"{SPACE}(?<=[.;:!?]{SPACE}|{LINE}){SPACE}*"


def text_lines(c: Column) -> Column:
    """Lines with single spaces, none empty."""
    return F.filter(F.transform(F.split(c, LINES), normalize_spaces), lambda x: x != "")


def text_units(c: Column) -> Column:
    """Sentences: lines cut after . ; : ! ? and space; single spaces, straight apostrophes, none empty."""
    cut = F.split(F.regexp_replace(c, UNIT_END, "\n"), "\n")
    return F.filter(F.transform(cut, lambda u: F.replace(normalize_spaces(u), F.lit("’"), F.lit("'"))), lambda u: u != "")


def sentence_units(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    return docs.select(key, F.posexplode(text_units(F.col(text))).alias("position", "unit"))


def find_sentence(c: Column, tokens: list[str | Column]) -> Column:
    """The first unit that holds all tokens, both folded; else the first run of three units that does; else null. Units are cut and folded once."""
    wanted = [folded(t) if isinstance(t, str) else fold_text(t) for t in tokens]
    every = lambda u: reduce(lambda a, t: a & u["f"].contains(t), wanted, F.lit(True))
    first = lambda units: F.get(F.filter(units, every), F.lit(0))["said"]

    def found(units: Column) -> Column:
        def run(i: Column) -> Column:
            three = F.slice(units, i + 1, 3)
            told = F.filter(F.transform(three, lambda u: u["f"]), lambda f: f != "")
            return F.struct(F.array_join(F.transform(three, lambda u: u["said"]), " ").alias("said"), F.array_join(told, " ").alias("f"))

        return F.coalesce(first(units), first(F.transform(units, lambda _, i: run(i))))

    return bound(F.transform(text_units(c), lambda u: F.struct(u.alias("said"), fold_text(u).alias("f"))), found)


def dictionary_rows(spark: SparkSession, dictionary: dict[str, tuple[str, ...]]) -> DataFrame:
    """A dictionary at hand as the table the matching operators take: place, name, spelling."""
    return spark.createDataFrame([(n, name, w) for n, (name, words) in enumerate(dictionary.items()) for w in words], "place long, name string, spelling string")


def word_runs(c: Column, sizes: list[int]) -> Column:
    """The different runs of so many words of a folded text, with what stands between the words as it is."""
    runs = [F.regexp_extract_all(c, F.lit(rf"\b(?=(\w+(?:\W+\w+){{{k - 1}}}))"), F.lit(1)) for k in sizes]
    return F.array_distinct(F.flatten(F.array(*runs)))


#: Sizes of runs that one pass over the texts looks for.
RUN_SIZES = 8
#: A dictionary of at most so many characters, a row counting ROW_CHARS more, goes to every task; a larger one meets the runs by a sort-merge join.
SMALL_DICTIONARY, ROW_CHARS = 20_000_000, 64


def _spelled(texts: DataFrame, keys: list[str], folded_text: str, dictionary: DataFrame) -> DataFrame:
    """(keys, columns of dictionary): every spelling that stands in a folded text as whole words.

    The runs are never the side that is broadcast: they come from texts whose
    files may be small, and are many times these.
    """
    words = F.size(F.regexp_extract_all("spelling", F.lit(r"\w+"), F.lit(0)))
    counted = dictionary.select(words.alias("n"), (F.length("spelling") + ROW_CHARS).alias("chars")).where("n > 0").groupBy("n").agg(F.sum("chars").alias("chars")).collect()
    sizes = sorted(r["n"] for r in counted) or [1]
    small = sum(r["chars"] for r in counted) <= SMALL_DICTIONARY
    passes = [sizes[i : i + RUN_SIZES] for i in range(0, len(sizes), RUN_SIZES)]
    runs = reduce(DataFrame.union, [texts.select(*keys, F.explode(word_runs(F.col(folded_text), some)).alias("spelling")) for some in passes])
    return runs.join(dictionary.hint("broadcast" if small else "merge"), "spelling")


def spellings_met(texts: DataFrame, keys: list[str], folded_text: str, dictionary: DataFrame) -> DataFrame:
    """(keys, place, name, spelling): each entry of which a spelling stands in a folded text as whole words, with the longest such spelling.

    dictionary: place, name, spelling, of any size. A spelling begins and ends
    with a letter or digit; so it is one of the text's runs of words, and both
    tables meet by equality. Only the numbers of words that spellings have come
    to the driver.
    """
    met = _spelled(texts, keys, folded_text, dictionary.select("place", "name", "spelling"))
    return met.groupBy(*keys, "place", "name").agg(F.max_by("spelling", F.struct(F.length("spelling"), "spelling")).alias("spelling"))


def names_met(texts: DataFrame, key: str, folded_text: str, dictionary: DataFrame) -> DataFrame:
    """(key, first_name, n_names, longest): of the entries met in a folded text the first's name, how many names they have, and the longest spelling.

    The digest of spellings_met without its rows, which are as many as texts
    times entries where many entries share a spelling. A spelling has a row for
    every 64 names, with a bit for each; bits, the least place and the last
    spelling are gathered by text. Spellings are numbered by length, then as
    they are.
    """
    known = stored(dictionary.select("place", "name", "spelling").where("spelling is not null"), "dictionary")
    names = stored(known.select("name").distinct().withColumn("nth", F.monotonically_increasing_id()), "dictionary-names")
    bit = F.expr("shiftleft(1L, cast(nth % 64 as int))")
    bits = known.join(names, "name").groupBy("spelling", F.floor(F.col("nth") / 64).alias("block")).agg(F.bit_or(bit).alias("bits"), F.min("place").alias("place"))
    spellings = known.select("spelling").distinct().orderBy(F.length("spelling"), "spelling").withColumn("entry", F.monotonically_increasing_id())
    spellings = stored(spellings, "dictionary-spellings")
    met = _spelled(texts, [key], folded_text, stored(bits.join(spellings, "spelling"), "dictionary-bits"))
    blocks = met.groupBy(key, "block").agg(F.bit_or("bits").alias("bits"), F.min("place").alias("place"), F.max("entry").alias("entry"))
    each = blocks.groupBy(key).agg(F.sum(F.bit_count("bits").cast("long")).alias("n_names"), F.min("place").alias("place"), F.max("entry").alias("entry"))
    first = known.groupBy("place").agg(F.min("name").alias("first_name"))
    named = each.join(first.hint("merge"), "place").join(spellings.withColumnRenamed("spelling", "longest").hint("merge"), "entry")
    return named.select(key, "first_name", "n_names", "longest")


def entries_met(texts: DataFrame, key: str, parts: dict[str, str], dictionary: DataFrame) -> DataFrame:
    """(key, and of each part first_PART and all_PART): the first entry of the dictionary met in each of a row's folded texts, and all, sorted.

    parts: a short name of each text and its column. Rows without any entry are left out.
    """
    each = F.array(*[F.struct(F.lit(p).alias("part"), F.col(c).alias("f")) for p, c in parts.items()])
    met = _spelled(texts.select(key, F.explode(each).alias("t")).select(key, "t.part", "t.f").where("f is not null"), [key, "part"], "f", dictionary.select("place", "name", "spelling"))
    of = lambda p, c: F.when(F.col("part") == p, F.col(c))
    found = [x for p in parts for x in (F.min_by("name", of(p, "place")).alias(f"first_{p}"), F.array_sort(F.collect_set(of(p, "name"))).alias(f"all_{p}"))]
    return met.groupBy(key).agg(*found)


#: What a name may begin with, and where it ends, in folded text (fixed values).
LEADS = (r"^(de|du|des|d')\s+", r"^(la|le|les|l')\s+", r"^(peche|peche sous marine)\s+(de|du|des)\s+")
NAME_END = r"\b(par|pour|en)\b.*$"


def name_stem(c: Column) -> Column:
    """A name as written in a rule, without brackets, articles and what follows par, pour, en."""
    name = F.regexp_replace(fold_text(c), r"\([^)]*\)", " ")
    for lead in LEADS:
        name = F.regexp_replace(name, lead, "")
    return normalize_spaces(F.regexp_replace(name, NAME_END, ""))


#: Names that are no species; words no name of a quota has (fixed values).
NO_SPECIES = ("autres zones", "coquillages", "crustaces", "poissons", "attention", "cf", "reglementation", "especes sensibles")
STOP_WORDS = (
    "captures", "capture", "limitee", "limitees", "limites", "quantite", "totale", "autorisee", "superieure", "inferieure", "pecheur", "navire",
    "jour", "specimens", "specimen", "unites", "kg", "danatifes",
)


def plausible_name(name: Column) -> Column:
    """At most four words, none with a digit, none a stop word."""
    words = lambda f: F.filter(F.split(f, r"[\s\-]+"), lambda w: w != "")
    fit = lambda w: (F.size(w) > 0) & (F.size(w) <= 4) & ~F.exists(w, lambda x: x.rlike("[0-9]") | x.isin(*STOP_WORDS))
    return bound(fold_text(name), lambda f: (f == "toutes especes marines") | bound(words(f), fit))


#: Phrases of a scope in order (fixed values).
SCOPES = (
    ("nord du parallele 48", "north-48n"), ("sud du parallele 48", "south-48n"), ("bretagne", "bretagne"), ("pays de la loire", "pays-de-la-loire"),
    ("manche est", "memn"), ("mer du nord", "memn"), ("mediterranee", "mediterranee"), ("sud-atlantique", "sud-atlantique"), ("sud atlantique", "sud-atlantique"),
    ("golfe du lion", "golfe-du-lion"), ("calanques", "calanques"), ("corse", "corse"),
)
SOURCE_SCOPES = (
    ("finistere", "bretagne"), ("cotes-darmor", "bretagne"), ("morbihan", "bretagne"), ("ille-et-vilaine", "bretagne"),
    ("premar_atlantique", "france"), ("prefecture maritime de l'atlantique", "france"), ("premar_manche", "memn"), ("manche et de la mer du nord", "memn"),
    ("premar_mediterranee", "mediterranee"), ("namo", "namo"), ("nord-atlantique-manche-ouest", "namo"), ("memn", "memn"), ("manche est mer du nord", "memn"),
    ("manche-est-mer-du-nord", "memn"), ("mer du nord", "memn"), ("mer-du-nord", "memn"), ("mediterranee", "mediterranee"), ("sud-atlantique", "sud-atlantique"),
)
NATIONAL_SOURCES = ("LEGIFRANCE", "MINISTERE_MER")


def _first_phrase(folded: Column, phrases: tuple[tuple[str, str], ...]) -> Column:
    return F.coalesce(*[F.when(folded.contains(p), F.lit(v)) for p, v in phrases])


def text_scope(folded: Column, phrases: tuple[tuple[str, str], ...] = SCOPES) -> Column:
    return F.coalesce(_first_phrase(folded, phrases), F.lit("general"))


def source_scope(source_id: Column, title: Column, url: Column, source_type: Column) -> Column:
    marker = fold_text(F.concat_ws(" ", source_id, title, url))
    return F.when(source_type.isin(*NATIONAL_SOURCES), "france").otherwise(F.coalesce(_first_phrase(marker, SOURCE_SCOPES), slugify(source_id)))


def rule_scope(folded: Column, of_source: Column) -> Column:
    """The text's own scope, else its source's."""
    own = text_scope(folded)
    return F.when(own != "general", own).otherwise(of_source)


def context_window(text: Column, anchor: Column, size: int = 1400) -> Column:
    """The text half a size round an anchor, dots where it is cut; without the anchor, its first size characters."""
    return bound(F.struct(normalize_spaces(text).alias("text"), normalize_spaces(anchor).alias("anchor")), lambda b: window_in(b["text"], b["anchor"], size))


def window_in(t: Column, a: Column, size: int = 1400) -> Column:
    """context_window of a text and an anchor that have single spaces already."""
    half = size // 2

    def cut(place: Column) -> Column:
        first, last = F.greatest(F.lit(1), place - half), F.least(F.length(t), place - 1 + F.length(a) + half)
        inner = F.trim(F.substr(t, first, last - first + 1))
        whole = F.concat(F.when(first > 1, "...").otherwise(""), inner, F.when(last < F.length(t), "...").otherwise(""))
        return F.when(t == "", a).when((a == "") | (place == 0), F.substring(t, 1, size)).otherwise(whole)

    return bound(F.call_function("locate", a, t), cut)  # from 1; 0 if absent


def quote_in(quote: Column, context: Column) -> Column:
    q, c = normalize_spaces(F.coalesce(quote, F.lit(""))), normalize_spaces(F.coalesce(context, F.lit("")))
    return (q != "") & (c != "") & F.contains(c, q)


#: What tells of sensitive species; of declaring catches, each all words of one group; and of a site's own furniture (fixed values).
SENSITIVE = ("especes sensibles", "especes concernees")
DECLARING = (("recfishing",), ("declaration", "capture"), ("enregistrement", "pecheur"))
SITE_NOISE = ("acceder au contenu", "acceder au menu", "rechercher menu", "sur le meme sujet", "mentions legales", "gestion des cookies", "partager la page")


def declaration_contexts(units: DataFrame, key: str, sensitive: tuple[str, ...] = SENSITIVE, declaring: tuple[tuple[str, ...], ...] = DECLARING, noise: tuple[str, ...] = SITE_NOISE) -> DataFrame:
    """(key, context): the units about sensitive species and their declaration, joined, in the order they are come upon, each once.

    units: key, position (from 0, all of a document's), unit, and f, the same
    folded. A unit with a word of sensitive brings itself and the seven after
    it. One that declares brings itself, the three before and the three after
    it; if one of those before is sensitive, from the nearest such on. Both end
    before the first unit of noise. Documents without any are left out.
    """
    f = F.col("f")
    all_of = lambda words: reduce(lambda a, w: a & f.contains(w), words, F.lit(True))
    declares = reduce(lambda a, b: a | b, [all_of(w) for w in declaring])
    # 1 sensitive, 2 declares (and is not), 0 neither
    judged = units.select(key, "position", "unit", F.when(contains_any(f, sensitive), 1).when(declares, 2).otherwise(0).alias("mark"), contains_any(f, noise).alias("noise"))
    order = W.partitionBy(key).orderBy("position")
    near = F.max(F.when(F.col("mark") == 1, F.col("position"))).over(order.rowsBetween(-3, 0))
    beside = F.collect_list(F.struct("position", "unit", "noise")).over(order.rowsBetween(-3, 7))
    first = F.when(F.col("mark") == 1, F.col("position")).otherwise(F.coalesce("near", F.greatest(F.col("position") - 3, F.lit(0))))
    end = F.col("position") + F.when(F.col("mark") == 1, 8).otherwise(4)
    marked = judged.withColumns({"near": near, "beside": beside}).where("mark > 0").select(key, F.col("position").alias("by"), "beside", first.alias("first"), end.alias("end"))
    ahead = marked.withColumn("ahead", F.filter("beside", lambda u: (u["position"] >= F.col("first")) & (u["position"] < F.col("end"))))
    stop = F.array_min(F.transform(F.filter("ahead", lambda u: u["noise"]), lambda u: u["position"]))
    brought = ahead.withColumn("stop", stop).select(key, "by", F.explode(F.filter("ahead", lambda u: F.col("stop").isNull() | (u["position"] < F.col("stop")))).alias("u"))
    once = brought.groupBy(key, F.col("u.position").alias("position")).agg(F.min("by").alias("by"), F.first("u.unit").alias("unit"))
    joined = once.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("by", "position", "unit"))).alias("all"))
    return joined.select(key, normalize_spaces(F.array_join(F.transform("all", lambda u: u["unit"]), " ")).alias("context"))


# Dates

MONTH_PATTERN = "|".join(MONTHS)
DATE_PATTERN = rf"20\d{{2}}-\d{{1,2}}-\d{{1,2}}|\d{{1,2}}[/-]\d{{1,2}}[/-]20\d{{2}}|\d{{1,2}}\s*(?:er)?\s+(?:{MONTH_PATTERN})(?:\s+20\d{{2}})?"


# Dates in folded text.
ISO_DATE, NUMBER_DATE = r"\b(20\d{2})-(\d{1,2})-(\d{1,2})\b", r"\b(\d{1,2})[/-](\d{1,2})[/-](20\d{2})\b"
WORD_DATE = rf"\b(\d{{1,2}})\s*(?:er)?\s+({MONTH_PATTERN})(?:\s+(20\d{{2}}))?\b"


def parse_date(c: Column, year: Column | None = None) -> Column:
    """A date written 2026-04-30, 30/04/2026 or 30 avril 2026; without a year, in the given one; null if it is none."""
    return bound(fold_text(c), lambda t: date_in(t, year))


def date_in(t: Column, year: Column | None = None) -> Column:
    """parse_date of a folded text."""
    make = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-M-d")

    def told(g: Column) -> Column:
        part = lambda way, i: F.get(F.get(g, F.lit(way)), F.lit(i))
        month = F.array_position(F.array(*map(F.lit, MONTHS)), part(2, 1)).cast("string")
        of_year = F.nullif(part(2, 2), F.lit(""))
        of_year = of_year if year is None else F.coalesce(of_year, year.cast("string"))
        return (
            F.when(F.get(g, F.lit(0)).isNotNull(), make(part(0, 0), part(0, 1), part(0, 2)))
            .when(F.get(g, F.lit(1)).isNotNull(), make(part(1, 2), part(1, 1), part(1, 0)))
            .when(of_year.isNotNull(), make(of_year, month, part(2, 0)))
        )

    return bound(F.array(*[groups_of(t, p, 3) for p in (ISO_DATE, NUMBER_DATE, WORD_DATE)]), told)


def reference_year(c: Column, current: int) -> Column:
    """The current year if the text names it, else the latest from the last year on, else the latest; null without one."""
    plain = F.regexp_extract_all(c, F.lit(r"\b(20\d{2})\b"), F.lit(1))
    packed = F.regexp_extract_all(c, F.lit(r"(?<!\d)(20\d{2})(?=\d{4}\b)"), F.lit(1))

    def told(years: Column) -> Column:
        late = F.filter(years, lambda y: y >= current - 1)
        return F.when(F.array_contains(years, current), F.lit(current)).when(F.size(late) > 0, F.array_max(late)).when(F.size(years) > 0, F.array_max(years))

    return bound(F.transform(F.concat(plain, packed), lambda y: y.cast("int")), told)


CONSULTATION = ("consultation du public", "observations formulees", "en application de l'article", "code des relations entre le public", "procedure de participation")
#: Patterns of a start, each with its confidence of 0.92 (fixed values).
STARTS = (
    rf"(?:entre(?:ra)? en vigueur|prend(?:ra)? effet|applicable a compter)\s+(?:le\s+|du\s+)?({DATE_PATTERN})",
    rf"(?:a compter du|a partir du|des le)\s*({DATE_PATTERN})",
    rf"(?:depuis le)\s*({DATE_PATTERN})",
)
RANGE = rf"(?:du|de)\s+({DATE_PATTERN})\s+(?:au|jusqu au|jusqu'au)\s+({DATE_PATTERN})"
UNTIL = rf"(?:jusqu au|jusqu'au|prend fin le)\s*({DATE_PATTERN})"
TITLE_YEAR = r"\b(?:applicables?|campagne|annee|saison|reglementation)\s+(?:en\s+|pour\s+)?(20\d{2})\b"


def validity(docs: DataFrame, key: str, current_year: int, text: str = "text", title: str = "title", url: str = "url") -> DataFrame:
    """(key, valid_from, valid_to, confidence, reason, quote): the best validity found in text and title.

    Candidates: a start (0.92), a range (0.78, 0.62 without a known year, the
    end a year later if it lies before), an end (0.75), the title's year
    (0.56). Best: confidence, then with a start, then with an end, then place.
    """
    doc = docs.select(key, F.coalesce(F.col(title), F.lit("")).alias("title"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = normalize_spaces(F.concat_ws(" ", "text", "title", "url"))
    # units are folded once, and only those with a date go on
    cut = F.transform(text_units(whole), lambda u: F.struct(u.alias("unit"), fold_text(u).alias("f")))
    dating = F.filter(cut, lambda u: u["f"].rlike(DATE_PATTERN) & ~contains_any(u["f"], CONSULTATION))
    units = doc.select(key, reference_year(F.concat_ws(" ", "title", "url"), current_year).alias("_year"), F.posexplode(dating).alias("position", "u")).select(key, "_year", "position", "u.*")
    units = units.withColumn("year", F.coalesce(reference_year(F.col("unit"), current_year), "_year"))
    f, year, none = F.col("f"), F.col("year"), F.lit(None).cast("string")
    wording = lambda reason, p, first, last: bound(groups_of(f, p, 2 if first and last else 1), lambda g: F.when(g.isNotNull(), F.struct(F.lit(reason).alias("reason"), (F.get(g, F.lit(0)) if first else none).alias("first"), (F.get(g, F.lit(1 if first else 0)) if last else none).alias("last"))))
    wordings = F.array(*[wording("start", p, True, False) for p in STARTS], wording("range", RANGE, True, True), wording("end", UNTIL, False, True))
    # what a unit says of dates as rows; only then are the dates read
    said = units.select(key, "position", "unit", "year", F.posexplode(wordings).alias("nth", "w")).where("w is not null").select(key, "position", "unit", "year", "nth", "w.*")
    read = said.withColumns({"start": date_in(F.col("first"), year), "end": date_in(F.col("last"), year)})
    later = F.when(F.col("end") < F.col("start"), F.coalesce(date_in(F.col("last"), F.year("end") + 1), F.col("end"))).otherwise(F.col("end"))
    confidence = F.when(F.col("reason") == "start", 0.92).when(F.col("reason") == "end", 0.75).when(year.isNotNull(), 0.78).otherwise(0.62)
    found = lambda a, b, c, r: F.struct(a.alias("valid_from"), b.alias("valid_to"), c.alias("confidence"), r.alias("reason"))
    inside = read.select(key, "position", "unit", "nth", found(F.col("start"), F.when(F.col("reason") == "range", later).otherwise(F.col("end")), confidence, F.col("reason")).alias("c"))
    named = F.nullif(F.regexp_extract(fold_text(F.col("title")), TITLE_YEAR, 1), F.lit(""))
    day = lambda s: F.try_to_date(F.concat(named, F.lit(s)), "yyyy-MM-dd")
    titled = doc.select(key, F.lit(1 << 30).alias("position"), F.col("title").alias("unit"), F.lit(9).alias("nth"), found(day("-01-01"), day("-12-31"), F.lit(0.56), F.lit("title")).alias("c"))
    every = inside.unionByName(titled).where("c.valid_from is not null or c.valid_to is not null")
    rank = F.struct(-F.col("c.confidence"), F.col("c.valid_from").isNull().alias("b"), F.col("c.valid_to").isNull().alias("d"), "position", "nth")
    best = every.groupBy(key).agg(F.min_by(F.struct("c.*", F.substring(normalize_spaces(F.col("unit")), 1, 700).alias("quote")), rank).alias("v"))
    return best.select(key, "v.*")
