"""Decontamination, ranked search and vector codes against brute force on awkward tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from ledgerguard.llm import bag_search, decontamination, pivot_codes
from ledgerguard.llm.queries import LLM_ORACLE, LLM_QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BIG = (1 << 63) - 1


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def say(rnd, n):
    return " ".join(rnd.choice(["alpha", "beta", "gamma", "délta", "x1", "zwölf", "ÄÖ", "rho", "sigma"]) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(11)
    items = [(0, say(rnd, 14)), (1, say(rnd, 30)), (2, "Only four, words: here"), (2, "another row of the same item, long enough for windows of ten"),
             (3, None), (4, ""), (5, " .,;! "), (6, "single"), (None, "an item without an id has these nine words"), (10, "Only four words here"),
             (BIG, "the largest id of all has its own words, some of them rare")]
    texts = [None, "", "...", "single", "SINGLE single", items[0][1].upper(), f"{say(rnd, 5)} {items[1][1]} {say(rnd, 5)}",
             items[2][1] + "\n" + items[3][1], "only FOUR words here! only four words here", "x " * 3000 + items[10][1],
             " ".join(items[1][1].split()[:9]), say(rnd, 8000)] + [say(rnd, rnd.randint(0, 80)) for _ in range(30)]
    # copies in another order of words share a bag; a third of the rows is one document
    texts += [" ".join(reversed(texts[6].split()))] * 3 + ["the largest words of all"] * 25
    rows = [(i, t, "k", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[6], (None, texts[6], "k", 1, 2), (BIG, texts[6], "k", 1, 2), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, term string, t long, n long").repartition(4)
    return docs, spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, window string")


def brute_hits(docs, items, size=10):
    known = {}
    for r in items:
        w = words(r.text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            known.setdefault(tuple(w[i:i + k]), set()).add("" if r.item_id is None else str(r.item_id))
    out = []
    for r in docs:
        w, hit, found = words(r.text), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in known:
                    hit |= set(range(i, i + n))
                    found |= known[tuple(w[i:i + n])]
        out.append((r.doc_id, hit, found))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("size,broadcast_bytes", [(10, 1 << 20), (10, 0), (3, 1 << 20), (7, 0)])
def test_contaminated_documents(spark, tables, size, broadcast_bytes):
    docs, items = tables
    rows = docs.collect()
    want = [(d, len(words(r.text)), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
            for r, (d, hit, found) in zip(rows, brute_hits(rows, items.collect(), size))]
    got = decontamination.contaminated_documents(docs, items, size, broadcast_bytes).collect()
    assert order(map(tuple, got)) == order(want) and sum(r.contaminated for r in got) > 8


def test_no_python_runs_in_the_native_operator(spark, tables):
    docs, items = tables
    for bytes_ in (1 << 20, 0):
        rows = decontamination.contamination(docs, items, broadcast_bytes=bytes_)
        assert not re.search("Python|Arrow|Pandas", rows._jdf.queryExecution().toString())


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_decontaminate(spark, tables, broadcast_bytes):
    docs, items = tables
    rows = docs.collect()
    hits = brute_hits(rows, items.collect())
    clean = [r for r, (_, hit, _) in zip(rows, hits) if not hit]
    got = decontamination.decontaminate(docs, items, "documents", broadcast_bytes=broadcast_bytes)
    assert order(map(tuple, got.collect())) == order(map(tuple, clean))
    want, token = [], re.compile(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)")
    for r, (_, hit, _) in zip(rows, hits):
        text = r.text
        if hit:
            found = token.findall(text)
            lead = re.match(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text)[0]
            text = lead + "".join(a + b for i, (a, b) in enumerate(found) if i not in hit)
        want.append((r.doc_id, text, *tuple(r)[2:]))
    cut = decontamination.decontaminate(docs, items, "spans", broadcast_bytes=broadcast_bytes)
    assert cut.columns == docs.columns
    assert order(map(tuple, cut.collect())) == order(want)
    left = decontamination.contaminated_documents(cut, items).collect()
    assert sum(r.contaminated for r in left) <= 1  # words on both sides of a cut may meet
    with pytest.raises(ValueError):
        decontamination.decontaminate(docs, items, "all")


def brute_search(docs, items, top):
    bags = [(r.doc_id, words(r.text)) for r in docs]
    n_docs, n_terms = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    asked = {}
    for r in items:
        asked.setdefault(r.item_id, set()).update(words(r.text))
    df = {}
    for _, w in bags:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, said in asked.items():
        found = []
        for d, w in bags:
            if not w:
                continue
            m = 100 - 50 + (50 * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 20 * m)) for t in said if t in w)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return out


@pytest.mark.parametrize("top,block_bytes", [(50, 1 << 20), (3, 1 << 20), (1, 100), (50, 200)])
def test_ranked_documents(spark, tables, top, block_bytes):
    docs, items = tables
    got = bag_search.ranked_documents(docs, items, top, block_bytes).collect()
    assert order(map(tuple, got)) == order(brute_search(docs.collect(), items.collect(), top))


def test_best_classes_in_any_order_and_slices():
    rnd = np.random.default_rng(1)
    scores, first = rnd.integers(0, 4, (300, 5)), rnd.permutation(300)
    null, want = rnd.random(300) < 0.3, []
    for item in range(5):
        rows = sorted((-scores[c, item], bool(null[c]), first[c], c) for c in range(300) if scores[c, item] > 0)
        want.append([r[3] for r in rows[:7]])
    best = bag_search.Best(5, 7)
    for a in range(0, 300, 13):
        s = slice(a, a + 13)
        best.add(scores[s], first[s], null[s], np.arange(300)[s])
    item, _, _, _, which = best.kept
    assert [which[item == i].tolist() for i in range(5)] == want


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, v, label) for i, v, label in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    dim = min((i is None, i or 0, len(v)) for i, v, _ in kept)[2]
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in kept if len(v) == dim]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], np.int64).tobytes()))
    width = dim // parts
    books = [[v[p * width:(p + 1) * width] for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [v[p * width:(p + 1) * width] for _, v, _ in kept]
            which = [near(x, books[p])[1] for x in own]
            books[p] = [[sum(c) // len(c) for c in zip(*m)] if (m := [x for x, w in zip(own, which) if w == k]) else e
                        for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, sums = [], {}
    for i, v, label in kept:
        found = [near(v[p * width:(p + 1) * width], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        sums[label] = sums.get(label, 0) + out[-1][2]
    return [(i, code, error, sums[label], digest) for i, code, error, label in out]


@pytest.mark.parametrize("n,dim,parts,entries", [(400, 16, 8, 16), (90, 6, 3, 4), (5, 8, 8, 16), (0, 8, 8, 16)])
def test_coded_vectors(spark, n, dim, parts, entries):
    rnd = random.Random(n)
    rows = [(7 * i, [rnd.choice([-1, 1]) * rnd.random() ** 3 for _ in range(dim)], rnd.choice([1, 2, None])) for i in range(n)]
    rows += [rows[i] for i in range(0, n, 9)] + [(BIG, x[1], None) for x in rows[:3]]
    # a hot vector, a null id; what is dropped: nulls, holes, NaN, infinities, another length, none at all
    rows += [(10 * n + i, [0.5] * dim, 1) for i in range(n // 2)] + [(None, x[1], 9) for x in rows[:1]]
    rows += [(-1, None, 1), (-2, [None] + [0.0] * (dim - 1), 1), (-3, [math.nan] * dim, 2), (-4, [math.inf] * dim, None), (-5, [], 1),
             (-6, [0.0] * (dim + 1), 1), (10 ** 6, [0.0] * 2 * dim, 1) if n else (-7, None, 3)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, v string").repartition(3)
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = pivot_codes.coded_vectors(table, parts, entries).collect()
    assert order(map(tuple, got)) == order(brute_codes(rows, parts, entries, 6))
    assert len(got) == (n + -(-n // 9) + 3 + n // 2 + 1 if n else 0)


def test_pivots_prune_and_never_change_the_nearest():
    rnd = np.random.default_rng(5)
    for spread in (3, 5000, 1 << 24):
        points, entries = rnd.integers(-spread, spread, (700, 8)), rnd.integers(-spread, spread, (16, 8))
        entries[5] = entries[11]  # ties
        pivots = pivot_codes.farthest(entries, 4)
        which, square, evaluated = pivot_codes.nearest(points, pivot_codes.distances(points, pivots), entries, pivots)
        all_squares = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (which == all_squares.argmin(axis=1)).all() and (square == all_squares.min(axis=1)).all()
        assert spread == 3 or evaluated < 0.95 * all_squares.size
        assert 11 not in which


def test_huge_components_count_as_the_largest(spark):
    most = pivot_codes.reach(8)
    table = spark.createDataFrame([(0, [3e38] * 8, 1), (1, [-3e38] * 8, 1), (2, [1.0] * 8, 1)],
                                  "vec_id long, embedding array<float>, label int")
    rows, books = pivot_codes.compressed(table, entries=2, rounds=0)
    assert books[:, 0].ravel().tolist() == [most] * 8 and books[:, 1].ravel().tolist() == [-most] * 8
    assert [r.error for r in rows.orderBy("vec_id").collect()] == [0, 0, 8 * (most - 4096) ** 2]


@pytest.mark.parametrize("name", ["op11_benchmark_decontamination", "op12_ranked_lexical_search", "op13_vector_code_compression"])
def test_sql_on_awkward_and_empty_tables(spark, tables, tmp_path, name):
    import duckdb
    docs, items = tables
    vectors = spark.createDataFrame([(i % 30, [float(i % 7), -0.3, i / 9, 0.1, 0.2, 0.3, 0.4, 0.5], i % 3 or None) for i in range(60)]
                                    + [(1, None, 1), (0, [math.nan] * 8, 1)], "vec_id long, embedding array<float>, label int")
    con = duckdb.connect()
    for kind, df in (("documents", docs), ("benchmark", items), ("embeddings", vectors)):
        df.write.parquet(f"{tmp_path}/all/{kind}.parquet")
        df.limit(0).write.parquet(f"{tmp_path}/none/{kind}.parquet")
        con.sql(f"create view {kind} as select * from '{tmp_path}/all/{kind}.parquet/*.parquet'")
    got = LLM_QUERIES[name](spark, f"{tmp_path}/all")
    want = con.sql(LLM_ORACLE[name])
    assert sorted(want.columns) == sorted(got.columns)
    assert order(map(tuple, got.select(*want.columns).collect())) == order(want.fetchall())
    assert LLM_QUERIES[name](spark, f"{tmp_path}/none").collect() == []
