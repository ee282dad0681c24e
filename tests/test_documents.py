import datetime as dt

import pytest
from pyspark.sql import functions as F

from halyard.functions import text
from halyard.operators import extraction, geo, pages, quality, rules, textmining, versions


def doc(spark, said, scope="france", kind="DIRM", url="https://www.dirm.example/rules.pdf", title=""):
    schema = "doc long, text string, source_scope string, source_type string, url string, source_url string, source_title string"
    return spark.createDataFrame([(1, said, scope, kind, url, "https://www.dirm.example/", title)], schema)


#: Documents of the extraction tests: text, and what is not as in doc.
SAID = {
    "list": ("Bar commun (Dicentrarchus labrax) : 42 cm\nHomard : 3 captures par jour\nAraignee de mer : 5 kg par jour", {"scope": "namo"}),
    "six": ("La peche sous-marine des araignees est limitee a six unites par pecheur et par jour.", {}),
    "table": ("Quantite maxi de peche autorisee par pecheur et par jour\nAraignee de mer 5 unites", {}),
    "middle": ("Araignee de mer de taille normale 4 kilogrammes et 7 unites par jour", {}),
    "two": ("Pas plus de deux specimens de bar ne peuvent etre gardes par pecheur et par jour.", {}),
    "total": ("Une quantite totale de 5 kg de maquereau par pecheur et par jour.", {}),
    "all": ("Les captures sont limitees par navire et par jour a 12,5 kg pour toutes especes.", {}),
    "tuna": ("La prise : un thon rouge par navire et par jour.", {}),
    "no days": ("Araignee de mer 5 unites", {}),
    "no name": ("Quantite totale autorisee : 3 captures par jour", {}),
    "twice": ("En Bretagne la peche du bar est limitee a deux unites par pecheur et par jour. " + "x " * 300 + "En Corse la peche du bar est limitee a deux unites par pecheur et par jour. ", {}),
    "closed": ("Aucun specimen de lieu jaune ne peut etre capture et detenu du 1er janvier au 30 avril.", {}),
    "protected": ("La peche du merou et du corb est interdite en Corse.", {}),
    "sale": ("La vente des produits issus de la peche maritime de loisir est interdite.", {}),
    "sale manual": ("La vente des produits issus de la peche maritime de loisir est interdite.", {"url": "https://x.fr/manuel.pdf"}),
    "sale title": ("La vente des produits issus de la peche maritime de loisir est interdite.", {"title": "RecFishing"}),
    "forum": ("La vente des produits issus de la peche maritime de loisir est interdite.", {"kind": "FORUM"}),
    "empty": ("", {}),
    "null": (None, {}),
    "sensitive": ("Especes sensibles : Bar, Lieu jaune, Dorade rose.\nLes pecheurs de loisir doivent s'enregistrer et faire une declaration via RecFishing.", {}),
    "not sensitive": ("Declaration obligatoire des captures.\nBar et dorade rose.", {}),
    "page": ("Coquilles Saint-Jacques Tourteau\nEspeces concernees pour 2026.\nLieu jaune, Bar et Dorade rose sont des especes sensibles.\nLes pecheurs doivent s'enregistrer et declarer les captures via RecFishing.\nSur le meme sujet: Tourteau et coquillages.", {}),
    "age": ("L'exercice de la peche sous-marine au moyen d'un fusil-harpon est interdit aux personnes agees de moins de seize ans.", {"kind": "LEGIFRANCE"}),
    "diving": ("Les dispositions s'appliquent aux etablissements mentionnes a l'article L. 322-2 qui organisent la pratique de la plongee subaquatique.", {"kind": "LEGIFRANCE"}),
    "clauses": ("Ne pas utiliser d'equipement respiratoire ;\nNe pas pratiquer la peche sous-marine la nuit ;\nAvoir plus de 16 ans et une bonne condition physique", {"kind": "MINISTERE_MER"}),
}


@pytest.fixture(scope="module")
def found(spark):
    """Rules of a type from a document of SAID; all are extracted at once."""
    docs = None
    for name, (said, about) in SAID.items():
        one = doc(spark, said, **about).withColumn("doc", F.lit(name))
        docs = one if docs is None else docs.union(one)
    rows = extraction.extract(docs.coalesce(2)).collect()
    return lambda name, rule_type=None: [r for r in rows if r["doc"] == name and rule_type in (None, r["rule_type"])]


def test_fold_slug_and_numbers(spark):
    df = spark.createDataFrame([(" Pêche  à l’eau Ça ",)], "t string")
    t = F.col("t")
    assert df.select(text.fold_text(t), text.slugify(t), text.normalize_label(F.lit(" Marée "))).first()[:] == ("peche a leau ca", "peche-a-leau-ca", "maree")
    n = spark.createDataFrame([(1.0,), (1.25,), (None,)], "x double").select(text.metric_text(F.col("x"))).collect()
    assert [r[0] for r in n] == ["1", "1.25", ""]
    assert df.select(text.parse_number(F.lit("six")), text.parse_number(F.lit("2,5")), text.parse_number(F.lit("x"))).first()[:] == (6.0, 2.5, None)
    marks = df.select(text.fold_text(F.lit("Ş ž Ệ ≠ é")), text.normalize_label(F.lit(" Mare\u0301e Ş ά ")), text.slugify(F.lit("Dvořák")))
    assert marks.first()[:] == ("s z e = e", "maree s α", "dvorak")
    shown = ["Six", "VINGT", "seize", " Une ", "deux-", "2,5 kg", "env. 3", "1.2.3", "-", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in shown], "t string").select(text.parse_number(t)).collect()]
    assert got == [6.0, None, 16.0, 1.0, 2.0, 2.5, 0.3, None, None, None]
    hosts = df.select(text.host_allowed(F.lit("https://a.x.fr/p"), "x.fr"), text.host_allowed(F.lit("https://ax.fr/"), "x.fr"), text.is_official(F.lit("https://www.mer.gouv.fr/a")))
    assert hosts.first()[:] == (True, False, True)


def test_html_text(spark):
    page = "<nav>Menu</nav><script>var x='</p>';</script><style>p{}</style><p>Un &amp; deux<br>trois</p>"
    assert spark.createDataFrame([(page,)], "h string").select(pages.html_text(F.col("h"))).first()[0] == "Menu\nUn & deux\ntrois"


def test_links_scores_and_status(spark):
    html = '<a href="/tailles-2026.pdf">Tailles peche</a><a href="/contact">Contact</a><a href="https://other.org/peche">x</a><a href="mailto:a@b">m</a><a href="/tailles-2026.pdf#p2">again</a>'
    page = spark.createDataFrame([("https://www.mer.gouv.fr/a/b.html", html)], "url string, html string")
    found = pages.edges(pages.links(page), "mer.gouv.fr")
    assert {r["dst_url"] for r in found.collect()} == {"https://www.mer.gouv.fr/tailles-2026.pdf", "https://www.mer.gouv.fr/contact"}
    none = spark.createDataFrame([], "url string")
    points = [r[0] for r in spark.createDataFrame([("ar-12",), ("arrete_3",), ("decret",), ("arrete du",), ("bar12",)], "t string").select(pages.relevance(F.lit("https://x.org/"), F.col("t"), 2026, (), ())).collect()]
    assert points == [2, 2, 0, 0, 0]
    got = {r["url"].rsplit("/", 1)[1]: r for r in pages.candidates(found, none, 2026, ("peche", "tailles")).collect()}
    assert got["tailles-2026.pdf"]["status"] == "auto_accepted" and got["contact"]["status"] == "candidate"
    assert got["tailles-2026.pdf"]["kind"] == "pdf" and got["tailles-2026.pdf"]["id"].startswith("discovered_")
    assert [r["dst_url"][-3:] for r in pages.ranked_links(pages.edges(pages.links(page)), 2026, 5, True).collect()] == ["pdf"]


def test_expansion_is_bounded(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    e = spark.createDataFrame([("a", "b", 1), ("a", "c", 5), ("b", "d", 1), ("c", "a", 1), ("d", "e", 1)], "src_url string, dst_url string, score int")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert sorted((r["url"], r["hop"]) for r in pages.expand(e, seeds, 2, 9).collect()) == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
    assert sorted(r["url"] for r in pages.expand(e, seeds, 2, 2).collect()) == ["a", "c"]


@pytest.mark.parametrize(("said", "want"), [("1er mai 2026", dt.date(2026, 5, 1)), ("30/04/2026", dt.date(2026, 4, 30)), ("le 31 mars", dt.date(2026, 3, 31)), ("2026-02-30", None), ("rien", None)])
def test_dates(spark, said, want):
    assert spark.createDataFrame([(said,)], "t string").select(textmining.parse_date(F.col("t"), F.lit(2026))).first()[0] == want


@pytest.mark.parametrize(
    ("said", "title", "url", "want"),
    [
        ("Cet arrete entre en vigueur le 1er mai 2026.", "", "", (dt.date(2026, 5, 1), None)),
        ("Texte.", "Regles applicables en 2026", "", (dt.date(2026, 1, 1), dt.date(2026, 12, 31))),
        ("Du 1er janvier au 30 avril.", "", "", (None, None)),
        ("Consultation du public du 1er mars 2026 au 2 mars 2026. Peche interdite du 1er janvier au 30 avril.", "", "https://x/arrete-2026", (dt.date(2026, 1, 1), dt.date(2026, 4, 30))),
        ("Ouverte du 1er novembre 2026 au 28 fevrier 2026.", "", "", (dt.date(2026, 11, 1), dt.date(2026, 2, 28))),
    ],
)
def test_validity(spark, said, title, url, want):
    df = spark.createDataFrame([(1, said, title, url)], "doc long, text string, title string, url string")
    got = textmining.validity(df, "doc", 2026).first()
    assert ((got["valid_from"], got["valid_to"]) if got else (None, None)) == want


def test_sizes_and_quotas(found):
    s = found("list", "MIN_SIZE")
    assert [(r["species_common_name"], r["metric_value"], r["species_scientific_name"], r["rule_key"]) for r in s] == [("bar", 42.0, "dicentrarchus labrax", "species.bar.min-size.namo")]
    assert (s[0]["title"], s[0]["zone_code"], s[0]["lat_max"], s[0]["source_excerpt"]) == ("Taille minimale de capture - bar", "FACADE_NAMO", 51.4, "Bar commun (Dicentrarchus labrax) : 42 cm")
    assert s[0]["legal_reference"].startswith("Arrete du 26") and "Homard" in s[0]["source_context"] and s[0]["notes"].endswith("requise.")
    q = {r["species_common_name"]: (r["metric_type"], r["metric_value"], r["metric_unit"], r["rule_key"].split(".quota.")[1]) for r in found("list", "QUOTA")}
    assert q == {"homard": ("QUOTA_MAX_UNITS", 3.0, "captures/jour", "captures-jour.namo"), "araignees": ("QUOTA_MAX_KG", 5.0, "kg/jour", "kg-jour.namo")}


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("six", ("araignees", 6.0, "captures/jour")), ("table", ("araignees", 5.0, "captures/jour")), ("middle", ("araignees", 4.0, "captures/jour")), ("two", ("bar", 2.0, "captures/jour")),
        ("total", ("maquereau", 5.0, "kg/jour")), ("all", ("toutes especes marines", 12.5, "kg/jour")), ("tuna", ("thon rouge", 1.0, "captures/jour")), ("no days", None), ("no name", None),
    ],
)
def test_quotas_in_words(found, name, want):
    assert [(r["species_common_name"], r["metric_value"], r["metric_unit"]) for r in found(name, "QUOTA")] == ([want] if want else [])


def test_quotas_of_text_have_their_own_surroundings(found):
    got = {r["rule_key"]: (r["description"], r["zone_code"]) for r in found("twice", "QUOTA")}
    assert set(got) == {"species.bar.quota.captures-jour.bretagne", "species.bar.quota.captures-jour.corse"}
    assert got["species.bar.quota.captures-jour.corse"][1] == "SECTEUR_CORSE" and "bretagne" not in got["species.bar.quota.captures-jour.corse"][0]


def test_other_rules(found):
    assert [r["rule_key"] for r in found("closed", "CLOSURE_PERIOD")] == ["species.lieu-jaune.closure.1er-janvier.30-avril.france"]
    p = found("protected", "PROTECTED_SPECIES")
    assert sorted(r["species_common_name"] for r in p) == ["corb", "merou"] and all(".corse." in r["rule_key"] for r in p)
    assert [len(found(n, "PRACTICE_RULE")) for n in ("sale", "sale manual", "sale title")] == [1, 0, 0]
    assert not found("empty") and not found("null") and not found("forum")


def test_declarations(found):
    d = found("sensitive", "LOCAL_RESTRICTION")
    assert sorted(r["species_common_name"] for r in d) == ["bar", "dorade rose", "lieu jaune"]
    assert {r["description"] for r in d} == {"Bar, Lieu jaune, Dorade rose."} and all("RecFishing" in r["source_context"] for r in d)
    assert not found("not sensitive", "LOCAL_RESTRICTION")
    d = found("page", "LOCAL_RESTRICTION")
    assert sorted(r["species_common_name"] for r in d) == ["bar", "dorade rose", "lieu jaune"] and all("Coquilles" not in r["description"] for r in d)


def test_declaration_context_goes_by_ranges_and_noise(spark):
    units = [f"u{i}." for i in range(14)]
    def context(**said):
        mine = [said.get(u[:-1], u) for u in units]
        rows = spark.createDataFrame([(1, i, u) for i, u in enumerate(mine)], "doc long, position int, unit string").withColumn("f", text.fold_text(F.col("unit")))
        return "".join(r["context"] for r in textmining.declaration_contexts(rows, "doc").collect())

    assert context() == ""
    assert context(u2="especes sensibles") == " ".join(["especes sensibles", *units[3:10]])
    assert context(u5="via recfishing") == " ".join([*units[2:5], "via recfishing", *units[6:9]])
    assert context(u5="via recfishing", u4="gestion des cookies") == " ".join(units[2:4])
    assert context(u1="especes concernees", u3="declaration des captures", u4="mentions legales") == "especes concernees u2. declaration des captures"
    assert context(u9="enregistrement du pecheur", u2="recfishing") == " ".join(["u0.", "u1.", "recfishing", *units[3:9], "enregistrement du pecheur", *units[10:13]])


def test_statutes_and_clauses(found):
    assert [(r["rule_key"], r["metric_type"], r["metric_value"], r["needs_manual_review"]) for r in found("age")] == [("spearfishing.fr.min-age.fusil-harpon", "AGE_MIN_YEARS", 16.0, False)]
    assert [(r["rule_key"], r["rule_type"]) for r in found("diving")] == [("diving.fr.code-sport.section-a322-71", "DIVING_GENERAL")]
    clauses = found("clauses", "SPEARFISHING_GENERAL")
    assert len(clauses) == 3 and all(r["needs_manual_review"] and r["rule_key"].startswith("spearfishing.fr.ministere.") for r in clauses)


def test_static_rules_stand_beside_extracted_ones(spark):
    base = spark.createDataFrame([("own", "DIVING_GENERAL")], "rule_key string, rule_type string")
    got = {r["rule_key"]: r["metric_value"] for r in extraction.extract(doc(spark, "Bar : 42 cm"), base).collect()}
    assert got == {"own": None, "species.bar.min-size.france": 42.0}


def test_rules_get_their_dates(spark):
    d = rules.dated(extraction.extract(doc(spark, "Aucun specimen de bar du 1er janvier 2026 au 30 avril 2026.\nHomard : 3 captures par jour")), 2026)
    got = {r["rule_type"]: (r["valid_from"], r["valid_to"], r["effective_date_source"]) for r in d.collect()}
    assert got["CLOSURE_PERIOD"] == (dt.date(2026, 1, 1), dt.date(2026, 4, 30), "parser")


def test_extraction_is_staged_and_compiles(spark, capfd):
    spark.sparkContext.setLogLevel("WARN")
    got = extraction.extract(doc(spark, SAID["list"][0]))
    got.collect()
    spark.sparkContext.setLogLevel("ERROR")
    assert "64 KB" not in capfd.readouterr().err and len(got._jdf.queryExecution().optimizedPlan().toString()) < 100_000


@pytest.mark.parametrize("n", range(len(extraction.QUOTA_TEXTS)))
def test_surroundings_of_quotas_in_running_text(spark, n):
    import re

    quota = ("pas plus de 2 specimens de bar ne peuvent etre gardes par pecheur et par jour", "peche du bar est limitee a 3 unites par navire et par jour", "quantite totale de 5 kg de bar par pecheur et par jour", "captures sont limitees par navire et par jour a 4 kg pour toutes especes", "un thon rouge par navire et par jour")[n]
    said = (quota + ". " + "ab " * 40) * 3 + "x" * 500 + " " + (quota + ". ") * 15 + "fin"
    own = spark.createDataFrame([(1, "DIRM", "whole", 0, said, said)], "doc long, source_type string, piece string, place int, said string, f string")
    got = sorted((r["place"], r["f"], r["number"], r["name"]) for r in extraction.text_hits(own).collect())
    pattern, number, name, _ = extraction.QUOTA_TEXTS[n]
    want = [(((n + 1) << 40) + i, said[max(m.start() - 220, 0) : m.end() + 220], m.group(number), m.group(name) if isinstance(name, int) else name) for i, m in enumerate(re.finditer(pattern, said))]
    assert got == want and len(want) == 18


def test_a_dictionary_of_any_size_is_a_table(spark):
    import random
    import re

    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "e", "io", "ur", "on", "ic", "al")]
    spellings = {" ".join(rng.choice(words) for _ in range(rng.choice((1, 2, 2, 3, 3, 4)))) for _ in range(14_000)}
    spellings = sorted(spellings | {"saint-pierre", "saint-pierre d'eau", "l'eau"})
    assert len(spellings) > 10_000
    known = [(i, f"n{i % 5000}", s) for i, s in enumerate(spellings)]
    texts = [(i, "".join(rng.choice(words) + rng.choice((" ", " ", " ", "  ", ", ", "-")) for _ in range(60)) + rng.choice(("", "saint-pierre d'eau.", "l'eau"))) for i in range(40)] + [(98, ""), (99, None)]
    got = textmining.entries_met(spark.createDataFrame(texts, "doc long, f string"), "doc", {"text": "f"}, spark.createDataFrame(known, "place long, name string, spelling string"))
    want = {}
    for i, t in texts:
        met = [(place, name) for place, name, s in known if t and s in t and re.search(rf"\b{re.escape(s)}\b", t)]
        if met:
            want[i] = (min(met)[1], sorted({name for _, name in met}))
    assert {r["doc"]: (r["first_text"], r["all_text"]) for r in got.collect()} == want and len(want) == 40
    longest = textmining.spellings_met(spark.createDataFrame([(1, "un saint-pierre d'eau")], "doc long, f string"), ["doc"], "f", spark.createDataFrame([(1, "a", "saint-pierre"), (1, "a", "saint-pierre d'eau"), (2, "b", "pierre d"), (3, "c", "aint")], "place long, name string, spelling string"))
    assert sorted((r["name"], r["spelling"]) for r in longest.collect()) == [("a", "saint-pierre d'eau"), ("b", "pierre d")]


SPACES = "\u00a0\u2009\u3000\u202f\u2003\u0085\u001f"


def test_white_space_is_that_of_unicode(spark):
    t = F.col("t")
    df = spark.createDataFrame([(f"{s}Bar :{s}{s}42 cm{s}. Suite{s}",) for s in SPACES], "t string")
    assert {r[0] for r in df.select(text.normalize_spaces(t)).collect()} == {"Bar : 42 cm . Suite"} == {r[0] for r in df.select(text.strip_spaces(text.normalize_spaces(t))).collect()}
    page = "<p>Bar&nbsp;: 42&nbsp;cm</p><p>&nbsp;</p><p>&#8239;Homard&emsp;:&#x3000;3&thinsp;captures</p>"
    assert spark.createDataFrame([(page,)], "t string").select(pages.html_text(t)).first()[0] == "Bar : 42 cm\nHomard : 3 captures"
    units = spark.createDataFrame([("Un.\u00a0Deux :\u2009trois !\u3000Quatre\u202fcinq",)], "t string").select(textmining.text_units(t)).first()[0]
    assert units == ["Un.", "Deux :", "trois !", "Quatre cinq"]
    around = spark.createDataFrame([("a\u00a0b " * 10,)], "t string").select(textmining.context_window(t, F.lit("b\u2009a"), 8), textmining.quote_in(F.lit("b\u3000a"), t)).first()
    assert tuple(around) == ("a b a b a...", True)
    for s in "\u00a0\u2009\u3000":
        row = spark.createDataFrame([(1, f"entre en vigueur le 1er{s}mai{s}2026", "", "")], "doc long, text string, title string, url string")
        assert textmining.validity(row, "doc", 2026).first()["valid_from"] == dt.date(2026, 5, 1)
    labels = spark.createDataFrame([("\ufb01n\u00b2\u00a0",), ("\u3000Ｖent\u2003",), ("Άλφα",), ("½",)], "t string")
    assert [r[0] for r in labels.select(text.normalize_label(t)).collect()] == ["fin2", "vent", "αλφα", "1⁄2"]


def test_sentences(spark):
    df = spark.createDataFrame([("Un. Deux: trois!\nQuatre l’eau",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(textmining.text_units(F.col("t"))).collect()] == [["Un.", "Deux:", "trois!", "Quatre l'eau"], None, []]
    assert df.select(textmining.find_sentence(F.col("t"), ["un", "trois"])).first()[0] == "Un. Deux: trois!"


def test_units_and_spaces_as_their_definition_has_them(spark):
    import random
    import re

    rng, space = random.Random(12), " \t\n\u000b\u000c\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2009\u2028\u2029\u202f\u205f\u3000"
    one = lambda u: re.sub(f"[{space}]+", " ", u).strip(" ")
    texts = ["".join(rng.choice("ab.:?é\u2019" + space + "      ") for _ in range(rng.randrange(30))) for _ in range(2000)] + ["a.\r\n b", "a. \r\n b", " . "]
    lines = lambda t: re.split("\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]", t)
    units = lambda t: [one(u).replace("\u2019", "'") for line in lines(t) for u in re.split(f"(?<=[.;:!?])[{space}]+", line) if one(u)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.normalize_spaces(F.col("t")), textmining.text_units(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(t, one(t), units(t)) for t in texts]


def test_a_unit_is_folded_once_however_many_words_are_asked_for(spark):
    units = spark.createDataFrame([(1, "Ça dépend de la réglementation et du comité, la licence non."), (2, "Ça dépend de la réglementation et de la page du comité, non.")], "doc int, unit string")
    kept = rules.marked_units(units, [("tion", "ment"), (" de ", " la ")], ("license", "page"))
    assert [r["doc"] for r in kept.collect()] == [1]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1


def test_validity_folds_a_unit_once_and_parts_go_to_all_tasks(spark):
    from halyard.plans import documents

    rows = [(1, "Bar. Consultation du public le 3 mars 2026. Ferme du 1er mai au 3 juin.", "", "https://x/2026"), (2, "Sans date. Rien", "", "")]
    told = textmining.validity(spark.createDataFrame(rows, "doc int, text string, title string, url string"), "doc", 2026)
    assert [(r["doc"], r["valid_from"], r["valid_to"]) for r in told.collect()] == [(1, dt.date(2026, 5, 1), dt.date(2026, 6, 3))]
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("translate(lambda"), plan.count("translate(unit")) == (1, 0)
    assert documents._parts(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_context_window_cuts_each_document_once(spark):
    from halyard.plans import catalog

    plan = catalog.queries()["context_window"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?<=[.;:!?]") == 1


def test_rules_are_enriched_in_all_tasks(spark):
    from halyard.plans import catalog

    assert catalog.queries()["rule_enrich"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def rule_rows(spark):
    rows = [("k1", "MIN_SIZE", "Bar 42", "SIZE_MIN_CM", 42.0, "bar", "z", 2, 0), ("k2", "MIN_SIZE", "Bar 42 encore", "SIZE_MIN_CM", 42.0, "bar", "z", 1, 1), ("k3", "MIN_SIZE", "Bar 45", "SIZE_MIN_CM", 45.0, "bar", "z", 1, 2)]
    df = spark.createDataFrame(rows, "rule_key string, rule_type string, description string, metric_type string, metric_value double, species_common_name string, zone_code string, source_priority int, seq int")
    return df.withColumn("needs_manual_review", F.lit(False)).withColumn("quality_flags", F.array().cast("array<string>"))


def test_rule_dedupe_and_conflicts(spark):
    r = rule_rows(spark)
    once = {x["rule_key"]: x["quality_flags"] for x in rules.dedupe_content(rules.dedupe_keys(r)).collect()}
    assert once == {"k2": ["duplicate_content_merged"], "k3": []}
    assert [tuple(x) for x in quality.metric_conflicts(r).collect()] == [("k3", "k1", 42.0, 45.0)]
    other = r.withColumn("metric_unit", F.when(F.col("seq") == 2, "inch").otherwise("cm"))
    assert quality.metric_conflicts(other).count() == 0
    assert [tuple(x) for x in quality.duplicate_content(r, rules.content_signature(r)).collect()] == [("k2", "k1")]
    same = r.withColumn("rule_key", F.lit("k"))
    assert quality.duplicate_content(same, rules.content_signature(same)).count() == 0


def test_signatures_by_type(spark):
    rows = [("QUOTA", "Bar", "a", 2.0, "kg/jour"), ("QUOTA", "Bar", "b", 2.0, "captures/jour"), ("CLOSURE_PERIOD", "x", "Arrêté n-12 du bar", None, None), ("CLOSURE_PERIOD", "y", "arrete n-13 du bar", None, None), ("PRACTICE_RULE", "x", "article r-1 du bar", None, None), ("PRACTICE_RULE", "y", "du bar", None, None)]
    r = spark.createDataFrame(rows, "rule_type string, title string, description string, metric_value double, metric_unit string").withColumns({"species_common_name": F.lit("Bâr"), "zone_code": F.lit("z"), "metric_type": F.lit("M")})
    s = [x[0] for x in r.select(rules.content_signature(r)).collect()]
    assert s[0] == "QUOTA|bar|z|M|2|kg/jour" and s[0] != s[1] and s[2] == s[3] and s[4] != s[5] and s[4].startswith("PRACTICE_RULE|bar|z|x|")


def test_rules_without_zone_or_species_come_last(spark):
    rows = [("a", None, "bar"), ("b", "Z1", None), ("c", "Z1", "Étoile"), ("d", "Z1", "denti"), ("e", "", "bar")]
    r = spark.createDataFrame(rows, "rule_key string, zone_code string, species_common_name string").withColumns({"rule_type": F.lit("QUOTA"), "source_priority": F.lit(1), "description": F.lit("d"), "metric_type": F.lit(""), "metric_value": F.lit(1.0)})
    assert [x["rule_key"] for x in rules.audit_sample(r, 4).collect()] == ["d", "c", "b", "a"]


def test_row_issues_cover_every_check(spark):
    good = ("k", "MIN_SIZE", "t", "d", "https://x.gouv.fr/", "z", "2026-01-01", "SIZE_MIN_CM", "42", "CUSTOM_BBOX", 1.0)
    cases = {"missing_field": {2: ""}, "description_too_long": {3: "x" * 1201}, "noisy_description": {3: "Accéder au menu"}, "source_priority": {4: "https://x.org"}, "invalid_validity_date": {6: "2026-02-30"}, "invalid_zone": {10: None}, "invalid_metric": {8: "many"}, "suspicious_metric": {8: "401"}}
    rows = [(good[0] + name, *[change.get(i, v) for i, v in enumerate(good)][1:]) for name, change in cases.items()] + [good, ("q", *good[1:7], "QUOTA_MAX_KG", "0", "APP", None)]
    df = spark.createDataFrame(rows, "rule_key string, rule_type string, title string, description string, source_url string, zone_code string, valid_from string, metric_type string, metric_value string, zone_strategy string, lat_min double")
    df = df.withColumns({c: F.lit(1.0) for c in ("lat_max", "lon_min", "lon_max")})
    got = {(r["rule_key"], r["category"]) for r in quality.row_issues(df).collect()}
    assert got == {(f"k{name}", name) for name in cases} | {("q", "invalid_metric")}


def test_expectations(spark):
    wanted = [{"id": "a", "severity": "error", "any_of": [{"species_common_name": "BÂR", "metric_value": "42"}]}, {"id": "b", "any_of": [{"description_contains": "Thön"}]}, {"label": "c", "rule_type": "min_size", "description_contains": "ENCORE"}]
    got = {r["id"]: tuple(r)[2:6] for r in quality.expectations(rule_rows(spark), wanted).collect()}
    assert got == {"a": ("error", 2, ["k1", "k2"], True), "b": ("warning", 0, [], False), "c": ("warning", 1, ["k2"], True)}
    assert quality.expectations(rule_rows(spark), []).count() == 0
    # a field that rules lack is empty; keys that only name a filter ask for nothing; what nobody meets comes with its filters
    lacking = quality.expectations(rule_rows(spark), [{"id": "d", "severity": "error", "any_of": [{"label": "x", "nothing": "1"}, "no filter"]}, {"id": "e", "any_of": [{"id": "y", "nothing": ""}]}, {"id": "f", "any_of": []}])
    got = {r["id"]: (r["n_matched"] > 0, r["filters"]) for r in lacking.collect()}
    assert got == {"d": (False, '[{"label": "x", "nothing": "1"}, "no filter"]'), "e": (True, None), "f": (False, '{"any_of": []}')}
    issues = [tuple(r) for r in quality.coverage_issues(lacking).orderBy("severity").collect()]
    assert [i[:2] for i in issues] == [("error", "expected_coverage_missing"), ("warning", "expected_coverage_missing")] and "nothing" in issues[0][2]


def test_rules_without_a_zone_are_counted(spark):
    r = spark.createDataFrame([("a", "Z"), ("b", ""), ("c", None), ("d", "Z")], "rule_key string, zone_code string")
    assert {tuple(x) for x in quality.count_zones(r).collect()} == {("Z", 2), ("UNKNOWN", 2)}
    assert {tuple(x) for x in quality.count_by(r, "zone_code").collect()} == {("Z", 2)}


def test_required_categories(spark):
    r = rule_rows(spark)
    assert {x[0] for x in quality.missing_categories(r).collect()} == {"DIVING_GENERAL", "SPEARFISHING_GENERAL", "QUOTA", "CRUSTACEAN_NUMERIC_RULE", "FISH_QUOTA_RULE"}
    one = r.withColumns({"rule_type": F.lit("QUOTA"), "species_common_name": F.lit("Étrille")})
    assert {x[0] for x in quality.missing_categories(one).collect()} == {"DIVING_GENERAL", "SPEARFISHING_GENERAL", "MIN_SIZE", "FISH_QUOTA_RULE"}


def test_manifest_and_enrichment(spark):
    r = rule_rows(spark).withColumns({"title": F.lit("t"), "metric_unit": F.lit("cm"), "legal_reference": F.lit(None).cast("string"), "species_scientific_name": F.lit(None).cast("string"), "source_url": F.lit("https://x.gouv.fr/a.PDF#p"), "source_excerpt": F.col("description"), "source_context": F.concat("description", F.when(F.col("seq") > 0, " und").otherwise("")), "document_hash": F.lit("h")})
    rich = rules.enrich(r)
    one = rich.where("rule_key = 'k1'").first()
    assert (one["species"]["canonical_name"], one["species"]["common_name"], one["species"]["scientific_name"], one["species"]["external_ids"]) == ("bar", "bar", "Dicentrarchus labrax", {})
    assert one["citations"][0]["url"] == "https://x.gouv.fr/a.PDF" and one["candidate"]["status"] == "publishable" and len(one["candidate"]["candidate_key"]) == 10
    m = quality.document_manifest(rich).first()
    assert m["rule_keys"] == ["k1", "k2", "k3"] and m["document_type"] == "html"
    assert [c["text_excerpt"] for c in m["chunks"]] == ["Bar 42", "Bar 42 encore", "Bar 42 encore und", "Bar 45", "Bar 45 und"]
    assert [c["chunk_index"] for c in m["chunks"]] == list(range(5)) and m["content_length"] == sum(len(c["text_excerpt"]) for c in m["chunks"])
    long = rich.sparkSession.createDataFrame([("x" * 800,)], "description string")
    assert long.select(rules.citation_quote(long)).first()[0] == "x" * 697 + "..."


@pytest.mark.parametrize(
    "shape",
    ['{"type":"Polygon","coordinates":[[[2,1],[4.5,1],[4.5,3],[2,1]]]}', '{"type":"FeatureCollection","features":[{"geometry":{"coordinates":[2,1]}},{"geometry":{"coordinates":[4.5,3]}}]}', "[[2,1],[4.5,3]]", "POLYGON((2 1, 4.5 3))"],
)
def test_boxes_of_geometry(spark, shape):
    none = F.lit(None).cast("double")
    b = spark.createDataFrame([(shape,)], "g string").select(geo.entity_box([none] * 4, F.col("g"), none, none).alias("b")).first()["b"]
    assert tuple(b) == (1.0, 3.0, 2.0, 4.5)


def test_overlap_touches_edges_and_comes_once(spark):
    side = "id string, lat_min double, lat_max double, lon_min double, lon_max double"
    a = spark.createDataFrame([("a", 0.0, 5.0, 0.0, 5.0)], side).withColumnRenamed("id", "a")
    b = spark.createDataFrame([("b", 5.0, 9.0, -3.0, 9.0), ("c", 5.1, 9.0, 0.0, 1.0), ("d", 1.0, 2.0, 1.0, 2.0)], side).withColumnRenamed("id", "b")
    assert sorted(r["b"] for r in geo.overlapping(a, b, "a", "b").collect()) == ["b", "d"]


def test_versions(spark):
    schema = "rule_key string, rule_fingerprint string, is_current boolean, status string, observed_from timestamp, observed_to timestamp, last_seen_run_id string"
    old = dt.datetime(2026, 1, 1)
    history = spark.createDataFrame([("v1", "f1", True, "active", old, None, "r0"), ("v2", "f2", True, "active", old, None, "r0"), ("v1", "f0", False, "superseded", old, old, "r0")], schema)
    now = F.to_timestamp(F.lit("2026-03-01 00:00:00"))
    seen = spark.createDataFrame([("v1", "f0")], "rule_key string, rule_fingerprint string")
    got = {(r["rule_key"], r["rule_fingerprint"]): (r["is_current"], r["status"]) for r in versions.sync_versions(history, seen, "r1", now).collect()}
    assert got == {("v1", "f1"): (False, "active"), ("v1", "f0"): (True, "published"), ("v2", "f2"): (True, "active")}
    # a version that comes back keeps the time it was first seen
    back = versions.sync_versions(history, seen, "r1", now).where("rule_fingerprint = 'f0'").first()
    assert (back["observed_from"], back["observed_to"], back["last_seen_run_id"]) == (old, None, "r1")
    told = spark.createDataFrame([("v1", "f9", "", True), ("v2", "f2", "checked", True)], "rule_key string, rule_fingerprint string, status string, needs_manual_review boolean")
    got = {r["rule_fingerprint"]: (r["is_current"], r["status"], r["observed_from"] > old) for r in versions.sync_versions(history, told, "r1", now).collect()}
    assert got == {"f1": (False, "active", False), "f0": (False, "superseded", False), "f2": (True, "checked", False), "f9": (True, "needs_review", True)}
    closed = {r["rule_key"]: (r["status"], r["last_seen_run_id"]) for r in versions.close_missing(history, seen, "r1", now).where("is_current or status = 'possibly_removed'").collect()}
    assert closed == {"v1": ("active", "r0"), "v2": ("possibly_removed", "r1")}
    assert versions.close_missing(history, seen.limit(0), "r1", now).where("is_current").count() == 2
    prints = spark.createDataFrame([("MIN_SIZE", 42.0), ("MIN_SIZE", 45.0)], "rule_type string, metric_value double").select(versions.fingerprint(["rule_type", "metric_value"])).distinct()
    assert prints.count() == 2
    moved = spark.createDataFrame([("A", "MIN", "u1"), (" a", "min", "u2")], "title string, rule_type string, source_url string")
    assert moved.select(versions.fingerprint(moved.columns)).distinct().count() == 1


def test_audit_fills_dates_that_lack_where_its_own_date_quote_stands(spark):
    known = dt.date(2026, 5, 1)
    rows = [("k1", None, None), ("k2", known, None), ("k3", None, None), ("k4", None, None), ("k5", None, None)]
    r = spark.createDataFrame([(k, "Le bar a 42 cm", "Le\u00a0bar a 42 cm du 1er janvier au 2 mars", a, b, ["old"], False) for k, a, b in rows], "rule_key string, description string, source_context string, valid_from date, valid_to date, quality_flags array<string>, needs_manual_review boolean")
    schema = "rule_key string, score double, quote string, valid_from string, valid_to string, date_quote string, date_confidence double, issues array<struct<category:string,severity:string>>"
    audit = [
        ("k1", 90.0, "bar a 42", "1er janvier 2026", None, "1er\u00a0janvier", 0.0, []),
        ("k2", 0.5, "merou", "2026-01-01", "2026-03-02", "2 mars", 0.8, []),
        ("k3", 0.7, None, "2026-01-01", None, "3 avril", 0.9, [("odd", "info")]),
        ("k4", None, "bar", "2026-01-01", None, "2 mars", 0.9, [("", None)]),
    ]
    done = {x["rule_key"]: x for x in versions.apply_audit(r, spark.createDataFrame(audit, schema)).collect()}
    dates = {k: (x["valid_from"], x["valid_to"], x["effective_date_source"], x["effective_date_confidence"]) for k, x in done.items()}
    assert dates == {"k1": (dt.date(2026, 1, 1), None, "ai", 0.9), "k2": (known, dt.date(2026, 3, 2), "ai", 0.8), "k3": (None, None, None, None), "k4": (None, None, None, None), "k5": (None, None, None, None)}
    assert {k: x["selected_quote"] for k, x in done.items()} == {"k1": "bar a 42", "k2": None, "k3": None, "k4": None, "k5": None}
    assert {k: (x["quality_flags"], x["needs_manual_review"], x["confidence_score"]) for k, x in done.items()} == {
        "k1": (["old"], False, 0.9), "k2": (["old", "ai_low_confidence"], True, 0.5), "k3": (["old", "ai_odd"], False, 0.7), "k4": (["old", "ai_ai_audit"], True, None), "k5": (["old"], False, None),
    }


def test_citations_and_chunks(spark):
    cited = "array<struct<source_url:string,quote:string,document_hash:string,locator:string>>"
    rows = [("k1", "Le bar.", "u1", None, "ch", [("c", "mot \u00a0 deux", "dh", "p1")]), ("k2", "La dorade grise.", "u2", "ref", "ch", []), ("k3", None, "", None, None, None), ("k4", "Par défaut.", "u4", None, None, [("c", "", "dh", "p")])]
    r = spark.createDataFrame(rows, f"rule_key string, description string, source_url string, legal_reference string, content_hash string, citations {cited}")
    got = {x["rule_key"]: (x["source_url"], x["quote"], x["locator"], x["document_hash"], x["content_hash"]) for x in versions.primary_citation(r).collect()}
    assert got == {"k1": ("c", "mot \u00a0 deux", "p1", "dh", "ch"), "k2": ("u2", "La dorade grise.", "ref", "legacy:u2", "ch"), "k3": ("", "", "k3", "legacy:k3", None), "k4": ("c", "", "p", "dh", None)}
    chunks = {x["rule_key"]: x for x in versions.chunk_rows(r.union(r)).collect()}
    assert {k: (x["text_excerpt"], x["token_estimate"]) for k, x in chunks.items()} == {"k1": ("mot \u00a0 deux", 2), "k2": ("La dorade grise.", 3), "k3": ("", 1), "k4": ("Par défaut.", 2)}
    import hashlib

    index = int(hashlib.sha1(b"k1").hexdigest()[:8], 16) % 2147483647 + 1
    assert (chunks["k1"]["chunk_index"], chunks["k1"]["chunk_hash"]) == (index, f"dh:k1:{index}")


def test_documents_fill_what_rules_know_of_them(spark):
    r = spark.createDataFrame([(1, "u1", "own"), (2, "u2", "own"), (3, "u3", None)], "k int, url string, document_hash string")
    d = spark.createDataFrame([("u1", "dh", "", 5, "ok"), ("u3", None, "ch", None, None)], "url string, document_hash string, content_hash string, content_length long, fetch_status string")
    got = {x["k"]: (x["document_hash"], x["document"] and (x["document"]["canonical_url"], x["document"]["content_hash"], x["document"]["content_length"], x["document"]["fetch_status"])) for x in versions.attach_documents(r, d).collect()}
    assert got == {1: ("dh", ("u1", None, 5, "ok")), 2: ("own", None), 3: (None, ("u3", "ch", None, None))}
    assert len(versions.DOCUMENT_FIELDS) == 10 == len(versions.attach_documents(r, d).schema["document"].dataType.names)


def test_reviewers_get_twenty_fields(spark):
    r = spark.createDataFrame([("a", "QUOTA", "d" * 900, "bar", None, 1, "x" * 600)], "rule_key string, rule_type string, description string, species_common_name string, zone_code string, source_priority int, source_excerpt string")
    one = rules.audit_sample(r, 5).first()
    assert len(one) == 20 and len(one["description"]) == 700 and one["current_quote"] == "x" * 497 + "..." and (one["zone_code"], one["title"], one["needs_manual_review"]) == ("", None, False)


def test_boxes_of_any_size_overlap(spark):
    import random

    rng = random.Random(8)

    def boxes(n):
        out = [(0, -90.0, 90.0, -180.0, 180.0), (1, 5.0, 5.0, 5.0, 5.0), (2, None, 1.0, 1.0, 1.0)]
        for i in range(3, n):
            size = rng.choice((0.0, 0.001, 0.01, 0.64, 3.0, 40.0, 400.0))
            lat, lon = round(rng.uniform(-90, 90), rng.choice((0, 2))), round(rng.uniform(-180, 180), rng.choice((0, 2)))
            out.append((i, lat, lat + size * rng.choice((0, 0.5, 1)), lon, lon + size))
        return out

    a, b = boxes(120), boxes(150)
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} int, lat_min double, lat_max double, lon_min double, lon_max double")
    got = geo.overlapping(frame(a, "a"), frame(b, "b"), "a", "b")
    want = sorted((p[0], q[0]) for p in a for q in b if None not in p + q and p[1] <= q[2] and q[1] <= p[2] and p[3] <= q[4] and q[3] <= p[4])
    assert sorted(map(tuple, got.collect())) == want


def test_hosts_show_their_first_addresses(spark):
    found = spark.createDataFrame([(f"https://a.x.fr/{i:03}", ("candidate", "auto_accepted", "existing", "")[i % 4], i % 7) for i in range(90)], "url string, status string, score int")
    hosts = spark.createDataFrame([("x.fr",), ("y.fr",)], "host string")
    got = {r["host"]: r for r in pages.domain_coverage(hosts, found.select("url"), found).collect()}
    want = [u for _, _, u in sorted(((r["status"], -r["score"], r["url"]) for r in found.collect()))][:20]
    assert got["x.fr"]["urls"] == want and got["x.fr"]["n_candidates"] == 90 and got["y.fr"]["urls"] == []
    assert {tuple(r) for r in pages.status_counts(found).collect()} == {("candidate", 23), ("auto_accepted", 23), ("existing", 22), ("unknown", 22)}


def test_html_text_query_with_references_cut_short(spark, tmp_path):
    from halyard.plans import documents

    html = "<title>and&amp;&amp</title><p>x &amp; y &am</p><p>&quot;z&quot; &copy</p>"
    spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert documents.QUERIES["html_text"](spark, str(tmp_path)).first()["text"] == 'and&&amp x & y &am\n"z" &copy'


def test_promote_with_several_labels_and_pages_of_a_url(spark, tmp_path):
    from halyard.plans import documents

    c = spark.createDataFrame([("a", "candidate"), ("b", "candidate"), ("c", "existing")], "url string, status string")
    labels = spark.createDataFrame([("a", True, 0.9), ("a", False, 0.9), ("a", True, 0.8), ("b", True, 0.1), ("b", None, 0.9), ("c", True, 0.9), ("c", True, 0.9)], "url string, relevant boolean, confidence double")
    assert sorted(r[:] for r in versions.promote(c, labels).select("url", "status").collect()) == [("a", "auto_accepted"), ("b", "candidate"), ("c", "existing")]
    spark.createDataFrame([(2, "u"), (4, "u"), (7, "u")], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(r[:] for r in documents.QUERIES["label_promote"](spark, str(tmp_path)).collect())
    assert got == [(2, "auto_accepted"), (4, "auto_accepted"), (7, "candidate")]


def test_top_links_of_one_place_go_by_url(spark):
    rows = [("s", u, 5, 3, "candidate") for u in ("http://x/b", "http://x/c", "http://x/a")]
    found = spark.createDataFrame(rows, "seed_url string, url string, score int, position int, status string").repartition(3)
    assert {r["url"]: r["rank"] for r in pages.top_links(found, 2).collect()} == {"http://x/a": 1, "http://x/b": 2}


def test_runs_of_words_are_not_broadcast(spark, monkeypatch):
    """Of a small dictionary the dictionary is, of a large one none is; with the same entries."""
    texts = spark.range(40).select("id", F.lit("un bar commun et un homard").alias("f"))
    known = spark.createDataFrame([(0, "bar", "bar commun"), (1, "homard", "homard"), (2, "none", "merou")], "place long, name string, spelling string")
    plans, found = [], []
    for most in (textmining.SMALL_DICTIONARY, 10):
        monkeypatch.setattr(textmining, "SMALL_DICTIONARY", most)
        met = textmining.entries_met(texts, "id", {"text": "f"}, known)
        found.append({r["id"]: (r["first_text"], r["all_text"]) for r in met.collect()})
        plans.append(met._jdf.queryExecution().executedPlan().toString())
    assert "BuildRight" in plans[0] and "BuildLeft" not in plans[0]
    assert "SortMergeJoin" in plans[1] and "BroadcastHashJoin" not in plans[1]
    assert found[0] == found[1] and len(found[0]) == 40 and found[0][3] == ("bar", ["bar", "homard"])


def test_names_met_is_the_digest_of_spellings_met(spark):
    """Many entries of one spelling and one name, over 64 names, spellings of several lengths, and words that only begin alike."""
    texts = spark.createDataFrame([(1, "aa bb cc"), (2, "aa  bb"), (3, "aa bbx, cc"), (4, "zz"), (5, None), (6, "cc dd aa bb")], "id long, f string")
    rows = [(n, f"n{n % 150}", ("aa bb", "cc", "cc dd", "bb cc")[n % 4]) for n in range(900, 100, -1)] + [(5, "gone", "qq"), (7, "n1", None), (8, "n2", "")]
    known = spark.createDataFrame(rows, "place long, name string, spelling string")
    met = textmining.spellings_met(texts, ["id"], "f", known)
    want = met.groupBy("id").agg(F.min_by("name", "place"), F.countDistinct("name"), F.max_by("spelling", F.struct(F.length("spelling"), "spelling")))
    got = textmining.names_met(texts, "id", "f", known)
    assert sorted(r[:] for r in got.collect()) == sorted(r[:] for r in want.collect()) and got.count() == 3


def test_boxes_of_a_crowded_cell_meet_in_blocks(spark, monkeypatch):
    """All of 60 and 90 boxes overlap in one cell: every pair once, in groups of a few."""
    monkeypatch.setattr(geo, "BLOCK", 10)
    side = [F.lit(x).alias(s) for x, s in zip((0.0, 1.0, 0.0, 1.0), geo.SIDES)]
    a, b = spark.range(60).select(F.col("id").alias("a"), *side), spark.range(90).select(F.col("id").alias("b"), *side)
    cells = lambda df, p: df.select(p, F.lit(0).alias("c"))
    groups = geo._met(cells(a, "a"), cells(b, "b"), "a", "b", ["c"]).groupBy("pa", "pb").count().collect()
    assert len(groups) > 40 and sum(r["count"] for r in groups) == 5400 and max(r["count"] for r in groups) < 540
    got = [r[:] for r in geo.overlapping(a, b, "a", "b").collect()]
    assert len(got) == len(set(got)) == 5400
