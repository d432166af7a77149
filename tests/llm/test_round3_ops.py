"""Embedding whitening, n-gram join and ranked search against plain numpy / Python."""

import heapq
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corvid.llm import lexical_search as ls
from corvid.llm import overlap_join as oj
from corvid.llm import whitening as wh
from corvid.llm.lexical_search import SharePlan, ranked_search
from corvid.llm.overlap_join import divide_skip, linked_documents
from corvid.llm.whitening import eigenvalues_above, feast, whitened_components
from tests.llm import corpus as c

# -- op11 ------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n long, id string, x long, component int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 5, "q", 9, 1) for i, v in rows], VECTORS)


def test_inertia_counts_eigenvalues():
    r = np.random.default_rng(1)
    for d in (1, 2, 7, 30):
        a = r.standard_normal((d, d))
        a = a + a.T
        np.fill_diagonal(a, 0)  # two-by-two pivots
        values = np.linalg.eigvalsh(a)
        for s in r.uniform(values.min() - 1, values.max() + 1, 20):
            assert eigenvalues_above(a, s) == (values > s).sum()
    assert eigenvalues_above(np.zeros((3, 3)), 0.0) == 0 and eigenvalues_above(np.eye(3), 0.5) == 3


@pytest.mark.parametrize("spectrum", [[5, 4, 3, 2, 1, .5], [7, 7, 7, 7, 7, 1], [9, 1e-3, 1e-3, 1e-6, 0, 0], [1, 0, 0, 0, 0, 0],
                                      [1, 1 - 1e-9, .5, .4, .4 - 1e-10, .1], [2, 2, 2, 2, 2, 2]])
def test_feast_against_a_full_decomposition(spectrum):
    r = np.random.default_rng(2)
    q = np.linalg.qr(r.standard_normal((6, 6)))[0]
    v = (q * np.array(spectrum)) @ q.T
    v = (v + v.T) / 2
    values, axes = feast(v, 4)
    want = sorted((x for x in spectrum if x > 0), reverse=True)[:4]
    assert np.allclose(values, want, rtol=1e-9, atol=1e-14)
    assert np.allclose(axes.T @ axes, np.eye(len(want)), atol=1e-12)
    assert np.abs(v @ axes - axes * values).max() < 1e-13 * spectrum[0] * 10


def brute_whitening(rows, k=4):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows
          if v is not None and all(e is not None and math.isfinite(np.float32(e)) for e in v)]
    x = [(i, np.floor(256 * v.astype(np.float32).astype(float)).astype(np.int64)) for i, v in ok]
    sizes = Counter(len(t) for t in {tuple(v) for _, v in x})
    d = max(sizes, key=lambda s: (sizes[s], s))
    x = [(i, v) for i, v in x if len(v) == d]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    w, u = np.linalg.eigh(centred.T @ centred / n)
    w, u = w[::-1][:k], u[:, ::-1][:, :k]
    return [(i, n, sum((n * int(a) - s) ** 2 for a, s in zip(v, sums)),
             ((v - fit.mean(axis=0)) @ u) / np.sqrt(w)) for i, v in x], w / np.trace(centred.T @ centred / n)


def test_whitening_against_numpy(spark):
    r = np.random.default_rng(3)
    base = (r.standard_normal((300, 6)) * [3, 2, 1.5, 1, .5, .1]).astype(np.float32).tolist()
    rows = list(enumerate(base)) + [(1000 + i, base[0]) for i in range(150)] + [
        (2000, None), (2001, base[1][:5] + [None]), (2002, base[1][:5] + [float("nan")]), (2003, base[1][:5] + [float("inf")]),
        (2004, [1.0] * 5), (2005, []), (None, base[2]), (7, base[3]), (2006, [1e30] * 6)]
    got = whitened_components(vector_frame(spark, rows).repartition(5)).collect()
    want, share = brute_whitening([r for r in rows if r[0] != 2006])
    assert len(got) == 4 * len(want) and {g.n for g in got} == {300}
    assert all(abs(g.explained / share[g.component - 1] - 1) < 1e-10 and g.identity_error < 1e-12 for g in got)
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2])
    for k in range(4):
        mine = sorted(((g.vec_id, g.deviation, abs(g.whitened)) for g in got if g.component == k + 1), key=key)
        plain = sorted(((i, dev, abs(z[k])) for i, _, dev, z in want), key=key)
        assert [m[:2] for m in mine] == [p[:2] for p in plain]
        assert np.allclose([m[2] for m in mine], [p[2] for p in plain], atol=1e-9)
        signs = {np.sign(g.whitened) * np.sign(z[k]) for i, _, _, z in want if i is not None and i < 300 and abs(z[k]) > 1e-6
                 for g in got if g.vec_id == i and g.component == k + 1 and abs(abs(g.whitened) - abs(z[k])) < 1e-9}
        assert len(signs) == 1  # one sign for all rows


def test_whitening_of_wide_entries_is_exact(spark):
    rows = [(i, [float(4e6 * i), float((i * 37) % 11) * 1e5]) for i in range(50)]
    got = whitened_components(vector_frame(spark, rows)).collect()
    want, _ = brute_whitening(rows)
    dev = {i: d for i, _, d, _ in want}
    assert all(g.deviation == (dev[g.vec_id] if dev[g.vec_id] < 2 ** 63 else None) for g in got)
    assert max(g.identity_error for g in got) < 1e-10 and {g.component for g in got} == {1, 2}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])] * 4, [(1, []), (2, [])]])
def test_whitening_without_variance(spark, rows):
    out = whitened_components(vector_frame(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


# -- op12 ------------------------------------------------------------------------------

def plain_components(rows, percent=80):
    """As the contract says: every pair compared."""
    sets = [(i, c.shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(sets):
        ids.setdefault(find(k), []).append(i)
    name = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return sorted(((i, len(s), name[find(k)]) for k, (i, s) in enumerate(sets)), key=str)


def joined(spark, rows, **options):
    return sorted(map(tuple, linked_documents(c.frame(spark, rows).repartition(3), **options).collect()), key=str)


def test_divide_skip_against_counting():
    r = random.Random(5)
    for _ in range(300):
        lists = [sorted(r.sample(range(40), r.choice([1, 2, 5, 30]))) for _ in range(r.randint(1, 12))]
        docs, where = [], []
        for x in lists:
            where.append((len(docs), len(docs) + len(x)))
            docs += x
        t = r.randint(1, len(lists) + 1)
        count = Counter(d for x in lists for d in x)
        assert sorted(divide_skip(docs, list(where), t)) == sorted((d, n) for d, n in count.items() if n >= t)


def test_ngram_join(spark):
    rows = c.corpus()
    assert joined(spark, rows) == plain_components(rows)


def near_copies(seed, size, words=60):
    r = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(size):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 9])):
            w[r.randrange(words)] = f"x{r.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    return rows


def test_ngram_join_over_many_blocks(spark):
    """Near copies, templates that share most words and passages, cut into blocks of a few documents."""
    r = random.Random(8)
    rows = near_copies(1, 150) + [(1000 + i, t.replace("w", "v")) for i, t in near_copies(2, 80, 30)]
    passage = " ".join(f"p{i}" for i in range(50))
    rows += [(2000 + i, passage + " " + " ".join(f"u{r.randrange(10 ** 6)}" for _ in range(r.choice([2, 5, 12, 30]))))
             for i in range(80)]
    rows += [(3000, None), (3001, ""), (None, rows[3][1]), (None, "lone text"), (5, rows[5][1]), (5, "other text of five"), (7, "lone text")]
    r.shuffle(rows)
    want = plain_components(rows)
    assert joined(spark, rows) == want
    assert joined(spark, rows, block_shingles=300) == want


def test_ngram_join_edges(spark):
    assert linked_documents(c.frame(spark, [])).count() == 0
    rows = [(4, "a b"), (2, "A  B"), (9, None), (8, " \n"), (1, "b a"), (3, "a b c d e f")]
    assert joined(spark, rows) == plain_components(rows)


def test_ngram_join_boundary(spark):
    """Exactly 80 % is linked, just under is not."""
    base = [f"t{i}" for i in range(94)]                     # 90 shingles
    at = base[:84] + [f"y{i}" for i in range(10)]           # 80 shared of 100
    under = base[:83] + [f"z{i}" for i in range(11)]        # 79 shared of 101
    rows = [(1, " ".join(base)), (2, " ".join(at)), (3, " ".join(under))]
    assert [x[2] for x in joined(spark, rows)] == [x[2] for x in plain_components(rows)]


# -- op13 ------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(rows, items, k=10):
    docs = [(i, Counter(TERM.findall(c.lower(t)))) for i, t in rows]
    n = sum(1 for _, x in docs if x)
    total = sum(sum(x.values()) for _, x in docs)
    df = Counter(t for _, x in docs for t in x)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(TERM.findall(c.lower(t)))
    out = []
    for item, terms in queries.items():
        scored = []
        for i, x in docs:
            s = 0
            for t in terms & set(x):
                m = 10 + 90 * sum(x.values()) * n // total
                s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * x[t] // (1000 * x[t] + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(heapq.nsmallest(k, scored))]
    return sorted(out, key=str)


def search_frames(spark, rows, items):
    return (c.frame(spark, rows).repartition(3),
            spark.createDataFrame([(i, t, 3, "x") for i, t in items], "item_id long, text string, rank int, doc_id string"))


def test_ranked_search(spark):
    rows = c.corpus() + [(None, "one abc"), (None, "one"), (3, "one two three"), (3, "one two three")]
    texts = [t for _, t in rows if t]
    r = random.Random(4)
    items = [(i, " ".join(r.choice(texts).split()[:r.randint(1, 40)])) for i in range(30)]
    items += [(40, None), (41, ""), (42, "?!"), (43, "ONE, one; One"), (44, "nowhere-to-be-found"), (None, "one é ß"),
              (50, "one"), (50, "three"), (51, max(texts, key=len))]
    want = plain_search(rows, items)
    docs, bench = search_frames(spark, rows, items)
    assert sorted(map(tuple, ranked_search(docs, bench).collect()), key=str) == want
    # several item blocks, and documents in several blocks of accumulators: the same answers
    assert sorted(map(tuple, ranked_search(docs, bench, block_terms=50).collect()), key=str) == want
    assert sorted(map(tuple, ranked_search(docs, bench, k=3).collect()), key=str) == plain_search(rows, items, 3)


def test_share_plan_sums_to_the_items():
    r = random.Random(6)
    pool = [r.getrandbits(63) - 2 ** 62 for _ in range(300)]
    shared = [r.sample(pool, 20) for _ in range(4)]
    items = [sorted({*r.choice(shared), *r.choice(shared), *r.sample(pool, 5)}) for _ in range(40)] + [[], pool]
    plan = SharePlan(items)
    value = {t: r.randrange(1000) for t in pool}
    acc = [0] * plan.leaves
    for t, leaf in zip(plan.terms.view(np.int64).tolist(), plan.leaf):
        acc[leaf] += value[t]
    for a, b in plan.merges:
        acc.append(acc[a] + acc[b])
    assert [sum(acc[n] for n in p) for p in plan.parts] == [sum(value[t] for t in x) for x in items]
    plain, with_sharing, _ = plan.node_counts()
    assert plan.merges and with_sharing < plain / 2


def test_ranked_search_empty_tables(spark):
    for rows, items in (([], []), ([], [(1, "one")]), ([(1, "one")], []), ([(1, None)], [(1, "one")])):
        out = ranked_search(*search_frames(spark, rows, items))
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_length_part_beyond_a_long():
    n = np.array([10 ** 9, 3])
    assert ls._length_part(n, 10 ** 11, 10 ** 13).tolist() == [10 + 90 * int(x) * 10 ** 11 // 10 ** 13 for x in n]


def test_contract_columns_of_new_queries():
    from corvid.llm.queries import QUERIES
    assert {"op11_embedding_whitening", "op12_ngram_join", "op13_ranked_search"} <= set(QUERIES)
    assert wh.COMPONENTS == 4 and oj.PERCENT == 80
