"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams (words, runs of word shapes, repeats of the word before)
are hashed into buckets. A bucket's scale is the log-count ratio of the two
classes, counted by Spark over every labelled training row. A linear
hinge-loss model over the scaled, length-normalised indicators is fitted by
dual coordinate descent on a bounded sample of those rows, and its margins are
turned into probabilities by a sigmoid fitted on rows that model did not see.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import arrow_task, discard, durable, per_batch, slices, texts, with_columns

#: Buckets of the hashed indicators (a table of this length goes to every task).
BUCKETS = 1 << 18
#: Bounds of the sample the hinge-loss model is fitted on, rows and their indicators together, half of each a class's; counts cover all rows.
FIT_ROWS, FIT_INDICATORS = 12_000, 24_000_000
#: Bits of the filter of labelled ids: at least, for each label, and at most (16 MB, sent to every task).
FILTER_BITS, BITS_A_LABEL, MOST_BITS = 1 << 22, 16, 1 << 27
WORD = re.compile(r"\S+")
CACHE_WORDS = 150_000


#: Letters and digits of ASCII by their kind; a run of one kind; more than three of another character.
KINDS = str.maketrans({c: "A" if c.isupper() else "a" if c.isalpha() else "0" for c in map(chr, range(128)) if c.isalnum()})
RUN, MANY = re.compile(r"([Aa0])\1+"), re.compile(r"([^Aa0])\1{3,}")
#: Longer words are shaped and hashed anew in each text, so that what a task remembers stays small.
KEPT_LETTERS = 64


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits as A, a and 0; other characters as they are, at most three of a run. Words are taken whole."""
    kinds = word.translate(KINDS) if word.isascii() else "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return MANY.sub(r"\1\1\1", RUN.sub(r"\1", kinds))


class Indicators:
    """Bucket numbers of a text's n-grams."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.shapes, self.words, self.grams = buckets, {}, {}, {}

    def bucket(self, kind: str, gram: str) -> int:
        return zlib.crc32(f"{kind}\x00{gram}".encode()) % self.buckets

    def _gram(self, gram: tuple) -> int:
        b = self.grams.get(gram)
        if b is None:
            b = self.bucket("shapes", " ".join(gram))
            if sum(map(len, gram)) <= KEPT_LETTERS:
                if len(self.grams) > CACHE_WORDS:
                    self.grams.clear()
                self.grams[gram] = b
        return b

    def __call__(self, text: str) -> np.ndarray:
        """Sorted, each once."""
        words = WORD.findall(text)
        distinct = set(words)
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
            self.shapes.clear()
        known, shapes, long = self.words, self.shapes, []
        for w in distinct:
            if w not in known:
                known[w], shapes[w] = self.bucket("word", w.lower()), shape(w)
                if len(w) > KEPT_LETTERS:
                    long.append(w)
        s = [shapes[w] for w in words]
        found = {known[w] for w in distinct}
        for w in long:
            del known[w], shapes[w]
        counts = Counter(s)
        found.update(self._gram((x,)) for x in counts)
        found.update(map(self._gram, set(zip(s, s[1:], strict=False))))
        found.update(map(self._gram, set(zip(s, s[1:], s[2:], strict=False))))
        found.update(self.bucket("share", f"{x} {8 * n // len(s)}") for x, n in counts.items())
        again = sum(map(eq, words, words[1:]))
        found.add(self.bucket("again", str(8 * again // max(1, len(words)))))
        found.add(self.bucket("distinct", str(8 * len(distinct) // max(1, len(words)))))
        out = np.fromiter(found, np.int32, len(found))
        out.sort()
        return out


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0


def filter_bits(keys: int) -> int:
    """A power of two that grows with the keys, within bounds; with more keys than it has room for, the filter only lets more through."""
    return min(MOST_BITS, max(FILTER_BITS, 1 << (BITS_A_LABEL * keys - 1).bit_length()))


def key_filter(keys: DataFrame, key: str, bits: int) -> np.ndarray:
    """A table of bits, 64 a number, with a one where some key hashes to: what has none is no key."""
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    words = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at % 64))")).alias("ones"))
    got = words.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got["word"].to_numpy()] = got["ones"].to_numpy()
    return out


def ragged(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def indicator_rows(docs: DataFrame, maybe: np.ndarray) -> DataFrame:
    """(doc_id, f): the bucket numbers of each text whose id is in the filter maybe."""
    sent = docs.sparkSession.sparkContext.broadcast(maybe)
    slim = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(64 * len(maybe))).alias("at"))

    def make():
        find = Indicators()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.column("at").to_numpy()
            b = batch.filter(pa.array(sent.value[at >> 6] >> (at & 63) & 1 == 1))
            return with_columns(b, ["doc_id"], f=ragged([find(t) for t in texts(b)]))

        return one

    return per_batch(slim, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, f array<int>", make)


def class_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Rows of each class with each indicator, as an array (2, buckets): each task adds up its rows, Spark the tasks."""

    def add(batches):
        total = np.zeros((2, buckets), np.int64)
        for b in batches:
            f, y = b.column("f"), b.column("y").to_numpy()
            sizes = np.diff(f.offsets.to_numpy())
            np.add.at(total, (np.repeat(y, sizes), f.flatten().to_numpy()), 1)
        y, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(total[y, at])], names=["y", "bucket", "n"])

    got = arrow_task(rows.select("y", "f"), add, "y int, bucket int, n long").groupBy("y", "bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((2, buckets))
    out[got["y"], got["bucket"]] = got["n"]
    return out


def fit_hinge(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, buckets: int, passes: int = 40, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2/2 + sum cost max(0, 1 - y (w x + b)), by dual coordinate descent.

    rows: indices and values of each row, of length 1; y: -1 or 1; cost: of each row.
    """
    w, b, alpha = np.zeros(buckets), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            gradient = y[i] * (w[at] @ x + b) - 1
            new = min(max(alpha[i] - gradient / (x @ x + 1), 0.0), cost[i])  # the bias is one more indicator, always 1
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * x
                b += step
                worst = max(worst, abs(new - alpha[i]))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, b


def fit_sigmoid(margin: np.ndarray, y01: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a m + b))) by Newton's method on smoothed targets, each step halved until it leads down."""
    n1, n0 = y01.sum(), (1 - y01).sum()
    t = np.where(y01 == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.array([1.0, float(np.log((n1 + 1) / (n0 + 1)))])

    def loss(x: np.ndarray) -> float:
        z = x[0] * margin + x[1]
        return float((np.logaddexp(0, z) - t * z).sum() + 1e-3 * x[0] ** 2 / 2)

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x[0] * margin + x[1], -700, 700)))
        s = p * (1 - p) + 1e-9
        g = np.array([((p - t) * margin).sum() + 1e-3 * x[0], (p - t).sum()])
        h = np.array([[(s * margin**2).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum()]])
        d, now = np.linalg.solve(h, g), loss(x)
        step = next((k for k in 0.5 ** np.arange(40) if loss(x - k * d) <= now), 0.0)
        x = x - step * d
        if abs(step * d).max() < 1e-6:
            break
    return float(x[0]), float(x[1])


class Model:
    """Scale and weight of each bucket, bias, and sigmoid; without both classes, a constant."""

    def __init__(self, scale: np.ndarray, weight: np.ndarray, bias: float, a: float, b: float):
        self.scale, self.weight, self.bias, self.a, self.b = scale, weight, bias, a, b

    def margin(self, f: np.ndarray) -> float:
        r = self.scale[f]
        size = float(np.sqrt(r @ r))
        return (float(r @ self.weight[f]) / size if size else 0.0) + self.bias

    def score(self, f: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.a * self.margin(f) + self.b, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS, c: float = 1.0) -> Model:
    """Fit on rows of docs (doc_id, text) that labels marks 0 or 1 and that are not held out.

    Null labels are left out; a document labelled twice counts as the smaller
    label. With one class or none, the model is the smoothed share of class 1.
    """
    y = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    spark = docs.sparkSession
    y, y_path = durable(y.where(~held_out()), "quality-labels")
    # texts without a label stay where they are; of the others only the indicators move, by the same plan at any size
    rows = indicator_rows(docs.where(~held_out()), key_filter(y, "doc_id", filter_bits(y.count()))).join(y.hint("merge"), "doc_id")
    rows, path = durable(rows, "quality-rows")
    sizes = {r["y"]: (r["n"], r["f"]) for r in rows.groupBy("y").agg(F.count("*").alias("n"), F.sum(F.size("f")).alias("f")).collect()}
    (n0, f0), (n1, f1) = sizes.get(0, (0, 0)), sizes.get(1, (0, 0))
    if not (n0 and n1):
        discard(spark, path, y_path)
        p = (n1 + 1) / (n0 + n1 + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, float(np.log(p / (1 - p))))
    counts = class_counts(rows)
    smooth = counts + 1.0
    # ratio of the shares of each class's rows with the indicator; no indicator seen weighs nothing
    scale = np.where(counts.sum(axis=0) > 1, np.log(smooth[1] / (n1 + 2)) - np.log(smooth[0] / (n0 + 2)), 0.0)
    # each class may take half of both bounds, so a rare one is in the sample however rare it is
    keep = [min(1.0, fit_rows / 2 / n, FIT_INDICATORS / 2 / max(1, f)) for n, f in ((n0, f0), (n1, f1))]
    drawn = lambda k: F.lit(True) if k == 1 else F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < math.ceil(k * (1 << 40))
    picked = rows.where(F.when(F.col("y") == 0, drawn(keep[0])).otherwise(drawn(keep[1])))
    # each row becomes an array as it arrives
    sample = sorted(((r[0], r[1], np.array(r[2], np.int32)) for r in picked.select("doc_id", "y", "f").toLocalIterator()), key=lambda r: r[:2])
    discard(spark, path, y_path)
    x = []
    for _, _, at in sample:
        v = scale[at]
        at, v = at[v != 0], v[v != 0]
        x.append((at, v / np.sqrt(v @ v) if len(v) else v))
    target = np.array([r[1] for r in sample], np.int64)
    if len(set(target.tolist())) < 2:
        p = (n1 + 1) / (n0 + n1 + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, float(np.log(p / (1 - p))))
    sign, cost = 2.0 * target - 1, np.full(len(x), c)
    # every fourth row of each class tells what margins mean; where a class has too few for that, the rows of the fit do
    nth = np.where(target == 1, np.cumsum(target), np.cumsum(1 - target))
    part = nth % 4 == 0
    w, b = fit_hinge(x, sign, cost, BUCKETS)
    if len(set(target[part].tolist())) == 2:
        seen, bias = fit_hinge([x[i] for i in np.flatnonzero(~part)], sign[~part], cost[~part], BUCKETS)
    else:
        part, seen, bias = np.ones(len(x), bool), w, b
    margins = np.array([seen[x[i][0]] @ x[i][1] + bias for i in np.flatnonzero(part)])
    slope, offset = fit_sigmoid(margins, target[part].astype(float))
    # odds of the sample as odds of all labelled rows
    return Model(scale, w, b, slope, offset + float(np.log(keep[0] / keep[1])))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: id, score (0 to 1), predicted (1 if score >= threshold).

    Null and empty texts have no words and get the score of that; texts of any
    length count whole; repeated rows give repeated rows; null ids stay null;
    other columns are ignored; an empty table gives no rows.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        find = Indicators()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            s = np.array([sent.value.score(find(t)) for t in texts(batch)])
            return with_columns(batch, ["id"], score=pa.array(s), predicted=pa.array((s >= threshold).astype(np.int32)))

        return one

    return per_batch(slim, f"id {slim.schema['id'].dataType.simpleString()}, score double, predicted int", make).withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, that the model predicts to be of quality 1.

    Null and empty texts are judged by the score of no words; of repeated rows
    all or none stay; an empty table gives no rows.
    """
    names = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        find = Indicators()
        for b in slices(batches):
            ok = [sent.value.score(find(t)) >= threshold for t in texts(b)]
            yield b.filter(pa.array(ok, pa.bool_()))

    return arrow_task(docs.select(*names), task, docs.schema)
