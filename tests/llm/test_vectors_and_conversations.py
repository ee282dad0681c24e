import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from halyard.llm import conversation_repair, pivot_search, vectors, whitening

SF = "/root/testdata/sf0.001"
VECTOR = "vec_id long, embedding array<float>, label int, whole string, query int, ring string, n int"


def table_of(spark, rows):
    """Vectors beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, v, 1, "w", 2, "r", 3) for i, v in rows], VECTOR)


def floored(v, width):
    return [int(np.floor(64.0 * float(np.float32(x)))) for x in v] + [0] * (width - len(v))


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]


def awkward(seed, n=300, width=7, big=False):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(rng.choice((-1, 0, 2)), 0.3) for _ in range(width)]) for i in range(n)]
    hot = rows[5][1]
    rows += [(1000 + i, hot) for i in range(n // 2)] + [rows[3], rows[3], (None, rows[4][1]), (None, [0.1] * width)]
    rows += [(2000, None), (2001, [None] * width), (2002, [float("nan")] * width), (2003, [float("inf")] + [0.0] * (width - 1)), (2020, []), (2040, [0.5]), (40, [9.0, 1.0])]
    return rows + ([(3000, [3e38] * width), (3020, [-3e38] + [1e10] * (width - 1))] if big else [])


# 11 exact search


def brute_search(rows, queries, k):
    rows, queries = usable(rows), usable(queries)
    width = max((len(v) for _, v in rows), default=0)
    held = lambda v: [max(-vectors.LIMIT, min(vectors.LIMIT, x)) for x in floored(v, width)[:width]]
    most, out = vectors.LONGEST, []
    for q, v in {(q, tuple(v)) for q, v in queries}:
        a = held(v)
        scored = [(max(-most - 1, min(most, sum(x * y for x, y in zip(a, held(w))))), i) for i, w in rows if i != q]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("big", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, big):
    monkeypatch.setattr(pivot_search, "RING_ROWS", 16)
    monkeypatch.setattr(pivot_search, "PAGE_ROWS", 8)
    monkeypatch.setattr(pivot_search, "SALT_PAGES", 2)
    monkeypatch.setattr(pivot_search, "BLOCK", 7)
    rows = awkward(1, big=big)
    index = pivot_search.build(table_of(spark, rows))
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [(-5, [1.0] * 3)]
    got = pivot_search.search(index, table_of(spark, asked), 6)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(rows, asked, 6)
    assert index.pages.groupBy("ring").agg(F.countDistinct("salt").alias("n")).agg(F.max("n")).first()[0] > 1  # the hot vector's ring


def test_search_of_few_and_of_none(spark):
    few = [(1, [1.0, 0.0]), (20, [0.5, 0.5]), (40, [0.0, 1.0])]
    got = pivot_search.search(pivot_search.build(table_of(spark, few)), table_of(spark, few[1:]), 20)
    assert sorted(tuple(r) for r in got.collect()) == brute_search(few, few[1:], 20)
    none = table_of(spark, few).limit(0)
    assert pivot_search.search(pivot_search.build(none), table_of(spark, few), 3).count() == 0
    assert pivot_search.search(pivot_search.build(table_of(spark, few)), none, 3).count() == 0


def test_rings_that_cannot_hold_a_best_row_are_not_read():
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 400, (8, 16))
    rows = np.rint(middles[rng.integers(0, 8, 4000)] + rng.normal(0, 4, (4000, 16))).astype(np.int64)
    most = float((rows * rows).sum(1).max())
    pivots = pivot_search.centres(pivot_search.lifted(rows[:500], most), 8)
    d = pivot_search.distances(pivot_search.lifted(rows, most), pivots)
    near = d.argmin(1)
    ring = near * pivot_search.RINGS + (d.min(1) > np.median(d.min(1)))
    numbers = np.unique(ring)
    of = lambda f: np.array([f(d.min(1)[ring == r]) for r in numbers])
    index = pivot_search.Directory(16, most, pivots, numbers, of(np.min), of(np.max), of(len))
    bound, scores = pivot_search.bounds(index, rows[:200]), rows[:200] @ rows.T
    highest = np.stack([scores[:, ring == r].max(1) for r in numbers], axis=1)
    assert (bound >= highest).all()
    kth = np.sort(scores, axis=1)[:, -20]
    assert (bound >= kth[:, None]).mean() < 0.5


# 13 whitening


def brute_whitening(x):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), [sum(c.tolist()) for c in fit.T]
    centred = fit - np.array([float(s / n) for s in sums])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, e[order], u[:, order], deviation, x - np.array([float(s / n) for s in sums]), np.trace(v)


def held_against_brute_force(got, ids, x):
    n, e, u, deviation, centred, trace = brute_whitening(x)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    k = min(16, int((e > 1e-9 * e[0]).sum()))
    for i, d, row in zip(ids, deviation, centred):
        r = by_id[i][0]
        assert (r["n"], r["deviation"]) == (n, d) and len(r["whitened"]) == len(r["explained"]) == k and r["identity_error"] <= 1e-4
        np.testing.assert_allclose(r["explained"], e[:k] / trace, rtol=1e-9)
        np.testing.assert_allclose(np.abs(r["whitened"]), np.abs(row @ u[:, :k] / np.sqrt(e[:k])), atol=1e-6)
    w = np.array([by_id[i][0]["whitened"] for i in ids])
    fit = np.unique(np.concatenate([x, w], axis=1), axis=0)[:, x.shape[1] :] if len({tuple(r) for r in x}) == len(x) else w[np.unique(x, axis=0, return_index=True)[1]]
    assert np.abs(np.cov(fit.T, bias=True).reshape(k, k) - np.eye(k)).max() < 1e-6  # one sign for all rows


def test_whitening_of_the_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    x = np.array([floored(r["embedding"], 64) for r in rows]) + whitening.OFFSET
    held_against_brute_force(whitening.whiten(df).collect(), [r["vec_id"] for r in rows], x)


def test_whitening_of_awkward_rows(spark):
    rows = awkward(7)
    got = whitening.whiten(table_of(spark, rows)).collect()
    kept = usable(rows)
    x = np.array([floored(v, 7) for _, v in kept]) + whitening.OFFSET
    assert len(got) == len(kept) and len({r["identity_error"] for r in got}) == 1
    own = [(i, r) for (i, _), r in zip(kept, x) if i not in (None, 40)]
    full = brute_whitening(x)
    assert {r["n"] for r in got} == {full[0]}
    by_id = {r["vec_id"]: r for r in got if r["vec_id"] not in (None, 40)}
    for i, r in own:
        assert by_id[i]["deviation"] == full[3][next(j for j, y in enumerate(x) if (y == r).all())]


def test_whitening_of_thin_tables(spark):
    assert whitening.whiten(table_of(spark, [(1, [1.0])]).limit(0)).count() == 0
    assert whitening.whiten(table_of(spark, [(1, None)])).count() == 0
    same = whitening.whiten(table_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], list(r["whitened"])) for r in same] == [(1, 0, [])] * 3
    line = whitening.whiten(table_of(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)])).collect()
    assert all(len(r["whitened"]) == 1 and abs(r["explained"][0] - 1) < 1e-12 for r in line)
    assert whitening.whiten(table_of(spark, [(1, []), (2, [])])).count() == 2
    huge = whitening.whiten(table_of(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])])).collect()
    assert {r["deviation"] for r in huge if r["vec_id"] < 3} == {vectors.LONGEST}


def test_jacobi_keeps_the_digits_of_small_eigenvalues():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    values = 10.0 ** -np.arange(0, 15, 0.5)
    a = (q * values) @ q.T
    u, e = whitening.principal((a + a.T) / 2)
    np.testing.assert_allclose(e[:10], values[:10], rtol=1e-8)
    np.testing.assert_allclose(u @ u.T, np.eye(len(u)), atol=1e-10)


# 12 conversation repair


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            out += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def in_order(turns):
    return sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2].encode(), hashlib.md5(t[3].encode()).hexdigest()))


def faults_of(turns):
    seen, out = set(), []
    for _, _, r, x in turns:
        blank, last = not re.search(r"[^\x20\x09-\x0D]", x), x.rstrip(" \t\n\v\f\r")[-1:]
        out.append("blank" if blank else "duplicate" if (r, x) in seen else "truncated" if last not in (".", "!", "?") else "")
        seen.add((r, x))
    return out


def brute_repair(turns):
    """All edits, by the cheapest (cost, audit) of every state, prefixes compared as texts."""
    initial_to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    ways = {0: (0, "", [])}

    def insert(ways):
        for _ in range(3):
            for s, (c, a, t) in list(ways.items()):
                role = "assistant" if s == 2 else "user"
                to = initial_to[role[0]][s]
                ways[to] = min(ways.get(to, (10**9, "", [])), (c + 5, a + "I", [*t, (role, "")]))
        return ways

    for (_, _, r, x), fault in zip(turns, faults_of(turns)):
        new = {}
        for s, (c, a, t) in insert(ways).items():
            options = [(s, (c + 2, a + "D", t))]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for role, cost, letter in ((r, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if s in initial_to.get(role[:1], {}):
                        options.append((initial_to[role[0]][s], (c + cost + more, a + letter, [*t, (role, x)])))
            for to, way in options:
                new[to] = min(new.get(to, (10**9, "", [])), way)
        ways = new
    ways = insert(ways) if turns else ways
    return min(w for s, w in ways.items() if s in (0, 3))


def brute_report(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = in_order([t for t in damaged(rows) if t[0] == c])
        numbers, faults = [t[1] for t in turns if t[1] is not None], faults_of(turns)
        cost, audit, kept = brute_repair(turns)
        illegal = sum(p[2][:1] + q[2][:1] not in ("su", "ua", "au") for p, q in itertools.pairwise(turns))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out[c] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest())
    return out


def odd_conversations(seed, n=60):
    rng = random.Random(seed)
    texts, roles = ["Yes.", "No!", "cut", "", " \t", None, "Why? ", "Yes.", "x" * 5000 + ".", "é 你好 😀."], ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = [(c, rng.choice([None, rng.randint(0, 6), rng.randint(0, 40)]), rng.choice(roles), rng.choice(texts)) for c in range(n) for _ in range(rng.randint(1, 9))]
    return rows + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (7, 1, "user", "Twice.")] + [(7, 1, "user", "Twice.")] * 3


def as_turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "m") for r in rows], "conv_id long, turn long, role string, text string, mark string, slice int, at string")


def reported(spark, monkeypatch, rows, query):
    from halyard.llm import queries

    monkeypatch.setattr(queries, "table", lambda *_: as_turns(spark, rows))
    got = query(spark, "")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r)[1:] for r in got.collect()}


def test_repair_equals_brute_force(spark, monkeypatch):
    from halyard.llm.queries import op12_conversation_repair

    rows = odd_conversations(2)
    assert reported(spark, monkeypatch, rows, op12_conversation_repair) == brute_report(rows)


@pytest.mark.parametrize("size", [1, 3, 64])
def test_repair_of_long_conversations_in_slices(spark, monkeypatch, size):
    from halyard.llm.queries import op12_conversation_repair

    rng = random.Random(size)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Yes.", "No!", "cut", f"Turn {t}.", f"left {t}"])) for t in range(240)] + [(2, t, "user", f"Only {t}.") for t in range(90)] + [(3, None, "assistant", "All the same.")] * 70
    whole = conversation_repair.repair(conversation_repair.damage(as_turns(spark, rows)))
    monkeypatch.setattr(conversation_repair, "slices_of", sized(size))
    assert reported(spark, monkeypatch, rows, op12_conversation_repair) == brute_report(rows)
    assert whole.slices.count() < 8


def sized(size):
    def slices_of(ordered):
        conversation_repair.SLICE_ROWS = size
        try:
            yield from real(ordered)
        finally:
            conversation_repair.SLICE_ROWS = 1024

    real = conversation_repair.slices_of
    return slices_of


def test_repair_of_an_empty_table(spark, monkeypatch):
    from halyard.llm.queries import op12_conversation_repair

    assert reported(spark, monkeypatch, [], op12_conversation_repair) == {}


def test_audits_are_read_through_doubled_pointers():
    rng = random.Random(9)
    codes = [[rng.randrange(4) for _ in range(n)] for n in (1, 2, 5, 33, 200)]
    faults = [[rng.randrange(4) for _ in c] for c in codes]
    for (costs, ranks, audits), c in zip(conversation_repair.solve(codes, faults), codes):
        known = [(r, a) for r, a, cost in zip(ranks, audits, costs) if cost < conversation_repair.INFINITE]
        assert [a for _, a in sorted(known)] == sorted(a for _, a in known)
        assert all(sum(x != "I" for x in a) == len(c) and a[-1] != "I" for _, a in known)
        assert all((r1 == r2) == (a1 == a2) for r1, a1 in known for r2, a2 in known)
