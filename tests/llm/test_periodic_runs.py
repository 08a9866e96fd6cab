"""Periodic runs against all periods of all stretches."""

import hashlib
import random
import time
import zlib
from collections import Counter

import pytest

from clipsense.llm import periodic_runs, queries

from .test_corpus_operators import COLUMNS, SF_DIR, odd_rows


def runs_by_hand(words, least):
    """For each period, every stretch in which words that far apart are equal; the smallest period counts."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - at >= q and end + q - at >= least:
                found.setdefault((at, end + q - at), q)
            at = end + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def make(draw):
    """Random words of few kinds, repeats, Fibonacci words, nested repeats, regions of one period side by side."""
    k, kind = draw.choice([1, 2, 2, 3, 30]), draw.randrange(5)
    some = lambda n: [draw.randrange(k) for _ in range(n)]
    if kind == 0:
        return some(draw.choice([0, 1, 5, 60, 300]))
    if kind == 1:
        return some(draw.randint(0, 9)) + some(draw.randint(1, 40)) * draw.randint(1, 8) + some(draw.randint(0, 9))
    if kind == 2:
        a, b = [0], [0, 1]
        for _ in range(draw.randint(1, 11)):
            a, b = b, b + a
        return b[draw.randint(0, 5) :]
    if kind == 3:
        part = some(draw.randint(1, 4))
        for _ in range(draw.randint(1, 3)):
            part = part * draw.randint(1, 13)
            part = part[: len(part) - draw.randint(0, min(3, len(part) - 1))] + some(draw.randint(0, 1))
        return (part * 2)[:600]
    p = draw.randint(1, 5)
    part = [draw.randrange(2) for _ in range(p)] * 60
    x, y = part[draw.randint(0, p) : draw.randint(30, 120)], part[draw.randint(0, p) : draw.randint(30, 120)]
    return x + y + x[draw.randint(0, 3) :] + y


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("least", [2, 12])
def test_runs_are_all_and_only_the_runs(seed, least):
    draw = random.Random(seed)
    for _ in range(60):
        texts = [make(draw) for _ in range(draw.choice([1, 3, 8]))]
        got = periodic_runs.runs_of_texts([[str(w).encode() for w in t] for t in texts], least)
        assert got == [runs_by_hand(t, least) for t in texts]


def test_highly_periodic_periods_need_their_own_search(monkeypatch):
    """A run whose period is itself a repetition has no synchronising position in common with its shift."""
    text = ["a", "b", "c"] * 40
    words = [w.encode() for w in text[:-1] + text[:-1]]
    expected = runs_by_hand(words, 12)
    assert (0, 238, 119) in expected
    assert periodic_runs.runs_of_texts([words]) == [expected]
    monkeypatch.setattr(periodic_runs, "_between_regions", lambda *arguments: None)
    assert (0, 238, 119) not in periodic_runs.runs_of_texts([words])[0]


def test_equal_contexts_are_chosen_alike():
    """Positions are chosen by the next 2 tau words alone, at least one in tau where nothing is highly periodic."""
    import numpy as np

    draw = random.Random(3)
    ids = np.array([draw.randrange(4) for _ in range(3000)], dtype=np.int64)
    hashes, tau = periodic_runs._mix(ids.astype(np.uint64)), 1
    for _ in range(5):
        hashes, tau = periodic_runs._doubled(hashes, tau), 2 * tau
        regions = [(s, e) for (s, e), q in periodic_runs.runs_of(ids).items() if 3 * q <= tau <= e - s]
        chosen = set(periodic_runs._synchronising(hashes, tau, regions).tolist())
        by_context = {}
        for i in range(len(ids) - 2 * tau + 1):
            by_context.setdefault(ids[i : i + 2 * tau].tobytes(), set()).add(i in chosen)
        assert all(len(v) == 1 for v in by_context.values())
        for i in range(len(ids) - 3 * tau + 2):
            window = ids[i : i + 3 * tau - 1]
            periodic = any((window[p:] == window[:-p]).all() for p in range(1, tau // 3 + 1))
            assert periodic or not chosen.isdisjoint(range(i, i + tau))


def digests_by_hand(doc_id, text):
    words = (text or "").encode().split()
    crc = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if crc % 10 == 0 and words:
        g, n = crc // 10, len(words)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_hand(words, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (str(doc_id), len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_is_brute_force(spark):
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = [(str(r["doc_id"]), *[r[c] for c in names]) for r in queries.op12_periodic_runs(spark, SF_DIR).collect()]
    rows = [r for r in queries.documents(spark, SF_DIR).collect() if len((r["text"] or "").split()) <= 1500]
    found = {g[0]: g for g in got}
    assert len(got) == queries.documents(spark, SF_DIR).count() and len(rows) > 150
    assert all(found[str(r["doc_id"])] == digests_by_hand(r["doc_id"], r["text"]) for r in rows)
    assert sum(g[1] > 0 for g in got) > 10


def test_odd_rows_have_one_result_each(spark):
    odd = spark.createDataFrame(odd_rows(), COLUMNS)
    rows = periodic_runs.find_runs(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows())
    same = [r for r in rows if r["doc_id"] == 11][0]
    assert [tuple(x) for x in same["runs"]] == [(0, 300, 1)] and same["collapsed"] == "same"
    assert periodic_runs.find_runs(spark.createDataFrame([], COLUMNS)).count() == 0


def test_long_texts_end():
    draw = random.Random(1)
    words = [str(draw.randrange(5000)).encode() for _ in range(300_000)]
    start = time.time()
    copied = words[:100_000] * 2 + words + [b"x" * 1_000_000] * 40 + [b"a", b"b"] * 50_000
    runs = periodic_runs.runs_of_texts([copied])[0]
    assert (500_000, 40, 1) in runs and (500_040, 100_000, 2) in runs
    assert any(s == 0 and n >= 300_000 and q == 100_000 for s, n, q in runs)
    assert time.time() - start < 60
