import math
import random

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from halyard.llm import license_scan, quality
from tests.llm.helpers import CASES
from tests.llm.test_corpus_operators import brute_groups, brute_lines

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_filter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.schema.names == docs.schema.names, name
        assert 0 < out.count() <= docs.count(), name
        docs = out
    assert docs.count() < start
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_run_gives_what_the_stages_give(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.select("doc_id").distinct().count() == got.count() > 0


@pytest.mark.parametrize("k", range(5))
def test_stages_of_an_empty_table(spark, k):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[k][1](spark, none, SF).count() == 0


def edited(spark, n):
    """n documents, each with its own line and one line of two fields, of 20 and 50 values."""
    rows = [(i, f"own{i} text here\nThis page was edited by {chr(97 + 7 * i % 20)}first {chr(97 + 7 * i // 20 % 50 // 25)}{chr(97 + 7 * i // 20 % 25)}last yesterday", "en", "s", 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("n", [100, 1000])
def test_fields_are_found_at_every_size(spark, n):
    left = corpus_pipeline.drop_recurring_lines(spark, edited(spark, n), SF)
    assert left.where(F.col("text").contains("edited by")).count() == 1 and left.count() == n


@pytest.mark.parametrize("end", ["{}", "{} {}x", "{} {}x {}y"])
def test_lines_alike_in_leading_words_alone_stay(spark, end):
    own = ["".join(chr(97 + int(c)) for c in str(1000 + i)) for i in range(40)]
    rows = [(i, "Was it that " + end.format(*[w] * 3), "en", "s", 0) for i, w in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_recurring_lines(spark, docs, SF)
    assert sorted(r["text"] for r in left.collect()) == sorted(r[1] for r in rows)


# The whole pipeline against brute force, awkward cases included

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _lines string, row string, h int, key string, fp int"


def corpus():
    """(documents, labels, items): noise, recurring lines, near copies, documents with benchmark items, and the awkward cases."""
    rng = random.Random(31)
    words = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.choice([6, 12, 25]))) for i in range(8)] + [(90, None), (91, "")]
    docs, labels = list(CASES), []
    for i in range(160):
        good = rng.random() < 0.7
        text = say(rng.randint(20, 80)) if good else " ".join(w + "$$$" for w in say(rng.randint(20, 80)).split())
        if i % 4 == 0:
            text += f"\nthis page was seen {rng.randrange(99)} times by {say(1)} and others here\n" + say(5)
        if i % 11 == 0:
            text += "\n" + items[rng.randrange(8)][1].upper()
        docs.append((1000 + i, text))
        labels.append((1000 + i, int(good), 0))
        if i % 13 == 0:
            docs += [(3000 + i, text), (3000 + i, text)]
    return docs, labels, items


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    docs, labels, items = corpus()
    at = tmp_path_factory.mktemp("sf")
    rows = [(i, t, "en", "s", -1, "kept", f"r{n}", n, "k", n) for n, (i, t) in enumerate(docs)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def pairs(df):
    return sorted((repr(r["doc_id"]), repr(r["text"])) for r in df.select("doc_id", "text").collect())


def runs_of(text, size):
    w = license_scan.words_of(text or "")
    return {" ".join(w[i : i + size]) for i in range(len(w) - size + 1)}


def test_every_stage_equals_brute_force(spark, made):
    from tokenizers import Tokenizer

    docs, _, items = corpus()
    frame, stages = spark.read.parquet(f"{made}/documents.parquet"), [f for _, f in corpus_pipeline.STAGES]

    # quality: the model's score of each text by plain arithmetic
    model, find = quality.train(frame, spark.read.parquet(f"{made}/labels.parquet")), quality.Indicators()

    def accepted(text):
        at = find(text or "")
        x = [float(model.scale[b]) for b in at]
        size = math.sqrt(sum(v * v for v in x))
        margin = sum(v / size * float(model.weight[b]) for v, b in zip(x, at, strict=True)) + model.bias if size else model.bias
        return 1 / (1 + math.exp(-(model.a * margin + model.b))) >= 0.3

    want = [(i, t) for i, t in docs if accepted(t)]
    out = stages[0](spark, frame, made)
    assert pairs(out) == sorted((repr(i), repr(t)) for i, t in want) and 0 < len(want) < len(docs)
    assert out.columns == frame.columns and set(r[0] for r in out.select("_lines").collect()) == {"kept"}
    out = out.cache()

    # line dedup
    lines = brute_lines(want, least_docs=5)
    out = stages[1](spark, out, made).cache()
    assert pairs(out) == lines and lines != sorted((repr(i), repr(t)) for i, t in want)
    assert out.columns == frame.columns and out.where("n_chars is distinct from length(text) or _lines <> 'kept'").count() == 0

    # near-dedup: the row of the smallest id of each group, once
    rows = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
    smallest = {}
    for d, print_, least in brute_groups(rows):
        smallest.setdefault((d, print_), least)
    out = stages[2](spark, out, made).cache()
    kept = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
    assert len(kept) == len(set(kept)) == len({(least, p) if least == "None" else least for (_, p), least in smallest.items()})
    assert all(repr(d) in smallest.values() for d, _ in kept) and set(kept) <= set(rows) and len(kept) < len(set(rows))

    # decontamination
    clean = []
    for d, text in kept:
        bad = False
        for _, t in items:
            width = min(5, len(license_scan.words_of(t or "")))
            own = runs_of(t, width) if width else set()
            bad = bad or bool(own) and len(own & runs_of(text, width)) >= math.ceil(0.8 * len(own) - 1e-9)
        if not bad:
            clean.append((d, text))
    out = stages[3](spark, out, made).cache()
    assert pairs(out) == sorted((repr(d), repr(t)) for d, t in clean) and len(clean) < len(kept)

    # encoding
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted((repr(r["doc_id"]), list(r["ids"]), r["decoded"]) for r in stages[4](spark, out, made).collect())
    ids = [x.ids for x in t.encode_batch([x or "" for _, x in clean], add_special_tokens=False)]
    said = t.decode_batch(ids, skip_special_tokens=False)
    assert got == sorted((repr(d), i, s) for (d, _), i, s in zip(clean, ids, said, strict=True))

    # and all of it in one go
    whole = sorted((repr(r["doc_id"]), list(r["ids"])) for r in corpus_pipeline.run(spark, made).collect())
    assert whole == [(d, i) for d, i, _ in got]


def test_nothing_is_left_but_the_last_stage(spark, made):
    from halyard.llm import common

    common.clear(spark)
    assert corpus_pipeline.run(spark, made).count() > 0 and len(common._written) == 1
    common.clear(spark)
    assert common._written == []
