"""Phrase collocations, exact top-k search and source divergence against plain models."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from duskwatch.llm import collocations, divergence, topk_search
from duskwatch.llm.words import BitTable, blocks_of

DOCS = "text string, lang string, source string, rank string, phrase string, n string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def documents(seed=1, n=60):
    rng = random.Random(seed)
    words = ["a", "B", "ab", "é", "x-y", "new", "york", "New", "of"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", ": ", "! "]
    out = [("".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None, "und"]), rng.choice(["s", "t", None, ""])) for _ in range(n)]
    out += [(None, "en", "s"), ("", "fr", "only"), ("...", None, None), (None, None, None), ("new york " * 400, "en", "s")] + [("of new york of", "de", "t")] * 30
    return out


def phrases_by_hand(docs, support, cover, top):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang, _ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts[lang].update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = []
    for lang, of in counts.items():
        found = {p: a for p, a in of.items() if len(p) > 1 and a >= support}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and cover * a <= 100 * b and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((1000 * a * total[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize("support,cover,top,shards", [(8, 100, 2000, 4), (3, 80, 5, 2), (20, 100, 2000, 16), (1, 100, 50, 1)])
def test_phrases_against_all_runs_of_words(spark, support, cover, top, shards):
    docs = documents(support)
    table = spark.createDataFrame([(*d, "x", "y", "z") for d in docs], DOCS).repartition(5)
    got = collocations.collocations(table, support=support, cover=cover, top=top, shards=shards)
    assert sorted(tuple(r) for r in got.collect()) == phrases_by_hand(docs, support, cover, top)


def test_phrases_with_full_tallies_and_tables(spark, monkeypatch):
    """Counts passed on early, and bit tables so full that they let everything through, change nothing."""
    monkeypatch.setattr(collocations, "TALLY", 16)
    monkeypatch.setattr(collocations, "LABELS", 4)
    docs = documents(9)
    rows = [row for row in docs if row[0]]
    batch = pa.RecordBatch.from_pydict({"text": [r[0] for r in rows], "lang": [r[1] or "und" for r in rows]})
    full = collections.namedtuple("Shared", "value")(BitTable(np.full(BitTable.BITS // 64, 2**64 - 1, np.uint64)))
    monkeypatch.setattr(collocations, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 5})())}))
    seen = collections.Counter()
    for out in collocations.mined((2,), full, None, 4)(iter([batch] * 3)):
        assert set(out.column("shard").to_pylist()) == {1}
        for key, n in zip(out.column("key").to_pylist(), out.column("n").to_pylist()):
            seen[key] += n
    once = collections.Counter()
    for out in collocations.labelled(full, full, 5)(iter([batch])):
        for row in out.to_pylist():
            once[row["lang"], row["phrase"]] += row["n"]
    by_hand = collections.Counter()
    for text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            by_hand.update((lang or "und", " ".join(words[i : i + k])) for k in range(2, 6) for i in range(len(words) - k + 1))
    assert once == by_hand
    assert sum(seen.values()) == 3 * sum(n for (_, p), n in by_hand.items() if p.count(" ") == 1)


def test_phrase_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([(10**12, 10**13, 10**12, 10**12), (7, 10**15, 8, 9), (10**17, 10**17, 10**17, 10**17)], "a bigint, n bigint, l bigint, r bigint")
    got = [r[0] for r in counts.select(F.expr(collocations.SCORE)).collect()]
    assert got == [1000 * a * n // (l * r) for a, n, l, r in map(tuple, counts.collect())]


def test_phrases_of_very_long_texts_and_empty_tables(spark):
    long = "w" * 300_000
    table = spark.createDataFrame([(f"{long} tail " * 5, "en"), ("one two " * 200_000, "de")], "text string, lang string")
    got = {(r["lang"], r["phrase"]): r["a"] for r in collocations.collocations(table, support=4).collect()}
    assert got == {("en", f"{long} tail {long} tail {long}"): 4, ("en", f"tail {long} tail {long} tail"): 4, ("de", "one two one two one"): 199_998, ("de", "two one two one two"): 199_998} | {
        k: v for k, v in got.items() if k[1].count(" ") < 4
    }
    assert collocations.collocations(table.limit(0), support=1).count() == 0


def nearest_by_hand(rows, asks, k, scale):
    taking = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(taking):
        if i is None or not asks(i):
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for m, (j, w) in enumerate(taking) if m != n)
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def vectors(seed, n, dim, spread):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]
    same = [1.0] + [0.0] * (dim - 1)
    rows += [(1000 + i, same) for i in range(40)]  # a group of equal vectors that is larger than k
    rows += [(None, same), (5, same), (5, same), (10, None), (20, [float("nan")] * dim), (30, [None] * dim), (40, [float("inf")] * dim), (50, []), (60, [0.5]), (70, [0.0] * dim)]
    return rows


@pytest.mark.parametrize("spread,dim,k", [(0.05, 8, 10), (2.0, 4, 3), (0.3, 2, 60)])
def test_search_against_all_products(spark, monkeypatch, spread, dim, k):
    monkeypatch.setattr(topk_search, "BLOCK", 16)  # several blocks of queries
    monkeypatch.setattr(topk_search, "TILE", 32)
    rows = vectors(dim, 200, dim, spread)
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, rank int, score int")
    got = topk_search.top_k(table, F.col("vec_id") % 5 == 0, k=k, scale=64)
    assert sorted((tuple(r) for r in got.collect()), key=str) == nearest_by_hand(rows, lambda i: i % 5 == 0, k, 64)


def test_annuli_are_left_out_and_nothing_is_lost():
    """In clusters most annuli stay unvisited, and no point is above its annulus's bound."""
    rng = np.random.default_rng(4)
    points = (rng.normal(0, 1000, (40, 6))[rng.integers(0, 40, 3000)] + rng.normal(0, 5, (3000, 6))).astype(np.int64)
    pivots = topk_search.farthest_first(points[:500], 40)
    away = topk_search.distances(points, pivots)
    near = away.argmin(axis=1)
    own, size = away[np.arange(len(points)), near], np.linalg.norm(points, axis=1)
    cell = near * topk_search.RINGS + (own > np.median(own))
    rows = [{"cell": c, "n": int((cell == c).sum()), "low": own[cell == c].min(), "high": own[cell == c].max(), "norm": size[cell == c].max()} for c in np.unique(cell)]
    annuli = topk_search.Annuli(pivots, rows)
    bounds, scores = annuli.bounds(points[:100]), topk_search.products(points[:100], points)
    for c, bound in zip(annuli.cell, bounds.T):
        assert (scores[:, cell == c] <= bound[:, None]).all()
    kth = np.sort(scores, axis=1)[:, -11]
    assert (bounds >= kth[:, None]).mean() < 0.3


def test_products_are_exact():
    for size in (10, 10**4, 10**7, 2**30, 2**31):
        a = np.array([[size, -size + 1], [size - 1, 3]])
        want = [[int(x[0]) * int(y[0]) + int(x[1]) * int(y[1]) for y in a] for x in a]
        assert topk_search.products(a, a).tolist() == want
    with pytest.raises(OverflowError):
        topk_search.products(np.array([[2**40]]), np.array([[2**40]]))


def test_search_of_few_or_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    ask = F.col("vec_id") % 100 == 0
    assert [tuple(r) for r in topk_search.top_k(table, ask).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk_search.top_k(table.where("vec_id = 0"), ask).count() == 0
    assert topk_search.top_k(table.where("vec_id = 1"), ask).count() == 0
    assert topk_search.top_k(table.limit(0), ask).count() == 0


def divergences_by_hand(docs, min_docs, top):
    counts, spread, of_lang = (collections.defaultdict(collections.Counter) for _ in range(3))
    for text, lang, source in docs:
        words = [lower(w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang or "", source or ""].update(words)
        spread[lang or ""].update(set(words))
        of_lang[lang or ""].update(words)
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = [t for t, n in spread[lang].items() if n >= min_docs]

        def shares(count):
            total = sum(count[t] for t in kept) + len(kept)
            return [1 + 10**9 * (count[t] + 1) // total for t in kept]

        p_of, q = {s: shares(c) for (of, s), c in counts.items() if of == lang}, shares(of_lang[lang])
        for s, p in p_of.items():
            pairs = sorted((-sum((x - y) ** 2 // y for x, y in zip(p, other)), o.encode()) for o, other in p_of.items() if o != s)
            terms = sorted((-((x - y) ** 2 // y), t.encode()) for t, x, y in zip(kept, p, q) if counts[lang, s][t] and x > y)[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("min_docs,top,block,side", [(3, 200, 4096, 32), (1, 4, 4, 2), (40, 200, 2, 1), (1000, 5, 4, 2)])
def test_divergence_against_all_terms(spark, monkeypatch, min_docs, top, block, side):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "SIDE", side)
    rng = random.Random(min_docs)
    docs = documents(min_docs) + [(" ".join("".join(rng.choices("abcé", k=2)) for _ in range(20)), "en", f"s{i % 7}") for i in range(50)]
    table = spark.createDataFrame([(*d, "x", "y", "z") for d in docs], DOCS).repartition(3)
    got = divergence.divergences(table, min_docs=min_docs, top=top)
    assert sorted(tuple(r) for r in got.collect()) == divergences_by_hand(docs, min_docs, top)


def test_equal_subtrees_are_one_node():
    trees = divergence.Trees()
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 3, 256), np.zeros(256, np.int64)
    a[64:] = 0
    x, y = trees.build(a), trees.build(b)
    assert trees.build(b.copy()) == y and x != y
    assert len(trees.halves[-1]) == 2  # two roots
    for left, right, u, v in ((a, b, x, y), (a, a, x, x)):
        nodes_a, nodes_b, times = trees.matches(u, v, 8)
        got = {(trees.values[m], trees.values[n]): t for m, n, t in zip(nodes_a, nodes_b, times.tolist())}
        assert got == collections.Counter(zip(left.tolist(), right.tolist())) and len(got) == len(times)


def test_divergence_of_long_texts_and_empty_tables(spark):
    table = spark.createDataFrame([("word " * 300_000, "en", "a"), ("z" * 500_000, "en", "b")], "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence.divergences(table, min_docs=1).collect())
    assert got == divergences_by_hand([tuple(r) for r in table.collect()], 1, 200)
    assert divergence.divergences(table.limit(0)).count() == 0


@pytest.mark.parametrize("held", [3, 40])
def test_divergence_counts_passed_on_early(monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    docs = documents(3)
    batch = pa.RecordBatch.from_pydict({"lang": [d[1] or "" for d in docs], "source": [d[2] or "" for d in docs], "text": [d[0] for d in docs]})
    full = collections.namedtuple("Shared", "value")(BitTable(np.full(BitTable.BITS // 64, 2**64 - 1, np.uint64)))
    spread, counts, texts, groups = collections.Counter(), collections.Counter(), {}, set()
    for out in divergence.doc_counts(iter([batch, batch])):
        spread.update(dict(zip(out.column("key").to_pylist(), out.column("docs").to_pylist())))
    for out in divergence.kept_counts(full)(iter([batch])):
        for r in out.to_pylist():
            if r["key"] is None:
                groups.add((r["lang"], r["source"]))
            elif r["term"] is None:
                counts[r["lang"], r["source"], r["key"]] += r["n"]
            else:
                assert texts.setdefault(r["key"], (r["lang"], r["term"])) == (r["lang"], r["term"])
    by_hand, in_docs = collections.Counter(), collections.Counter()
    for text, lang, source in docs:
        words = [lower(w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        by_hand.update((lang or "", source or "", w) for w in words)
        in_docs.update({(lang or "", w) for w in words})
    assert {(lang, source, texts[key][1]): n for (lang, source, key), n in counts.items()} == by_hand
    assert {texts[key]: n for key, n in spread.items()} == {key: 2 * n for key, n in in_docs.items()}
    assert groups == {(d[1] or "", d[2] or "") for d in docs}


def test_blocks_over_cut_batches():
    names = [1] * 5 + [2] + [3] * 7 + [1] * 2
    table = pa.table({"block": names, "n": list(range(len(names)))})
    got = [(t.column("block")[0].as_py(), t.column("n").to_pylist()) for t in blocks_of(iter(table.to_batches(max_chunksize=2) + table.slice(0, 0).to_batches()))]
    assert got == [(1, [0, 1, 2, 3, 4]), (2, [5]), (3, [6, 7, 8, 9, 10, 11, 12]), (1, [13, 14])]
