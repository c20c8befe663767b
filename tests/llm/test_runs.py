"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from farelane.llm import queries
from farelane.llm.op13_runs import find_runs, run_digests, slice_runs


def brute(words, periods=4, least=6):
    """Every maximal stretch, by trying each period; its smallest period only."""
    out = set()
    for q in range(1, len(words) // periods + 1):
        equal = [x == y for x, y in zip(words, words[q:])] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            elif not same and start is not None:
                stretch = words[start : i + q]
                if len(stretch) >= max(least, periods * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    out.add((start, len(stretch), q))
                start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def in_slice(docs, periods, least):
    rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    numbers = {}
    index = np.array([numbers.setdefault(w, len(numbers)) for d in docs for w in d], dtype=np.int32)
    ends = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(int)
    out = [[] for _ in docs]
    for first, length, period in zip(*(x.tolist() for x in slice_runs(rows, index, periods, least))):
        row = rows[first]
        out[row].append((first - int(ends[row]), length, period))
    return out


@pytest.mark.parametrize("periods, least", [(4, 6), (2, 2), (2, 5), (3, 1), (5, 1)])
def test_slices(periods, least):
    rng = random.Random(periods * 10 + least)
    for _ in range(120):
        docs = []
        for _ in range(rng.randint(0, 6)):
            letters = "abcd"[: rng.randint(1, 4)]
            words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < 0.6:
                a, p = rng.randrange(len(words)), rng.randint(1, 6)
                words = [words[a + (i - a) % p] if i >= a and a + p <= len(words) else w for i, w in enumerate(words)]
            docs.append(words)
        assert in_slice(docs, periods, least) == [brute(d, periods, least) for d in docs]


def test_nested_runs_and_one_long_one():
    """A run whose period holds runs of its own, and a text of one word, which is not quadratic."""
    words = (["a"] * 7 + ["b"]) * 5
    assert in_slice([words], 4, 6) == [brute(words)]
    assert in_slice([["x"] * 200_000], 4, 6) == [[(0, 200_000, 1)]]


def digests(words):
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    row = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (*row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark, sf_dir):
    expected = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        if len(words) > 1000:  # the others are compared in test_slices; brute force is slow there
            continue
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        expected[r.doc_id] = digests(words)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_runs"](spark, sf_dir).collect()}
    assert len(expected) > 100 and sum(x[0] for x in expected.values()) > 10
    assert {k: got[k] for k in expected} == expected


def test_odd_texts(odd):
    rows = find_runs(odd).collect()
    assert len(rows) == odd.count()
    given = odd.select("doc_id", "text").collect()
    words = [re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in given]
    short = [(r.doc_id, len(w), brute(w), collapsed(w, brute(w))) for r, w in zip(given, words) if len(w) < 100]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows if r.n_words < 100]
    assert sorted(got, key=str) == sorted(short, key=str)
    long = {r.doc_id: [tuple(x) for x in r.runs] for r in rows if r.n_words >= 100}
    assert long == {5: [(0, 32000, 8)], 8: [(0, 32000, 8)]}
    assert run_digests(find_runs(odd)).count() == odd.count()


def test_ties_and_white_space(make):
    docs = make((1, "a a a a a a x b b b b b b"), (2, "\x0ba\x0ca\ta\r\na a\xa0a a a a a a a "))
    rows = {r.doc_id: r for r in run_digests(find_runs(docs)).collect()}
    assert (rows[1].n_runs, rows[1].start, rows[1].length, rows[1].period, rows[1].exponent_milli) == (2, 0, 6, 1, 6000)
    assert (rows[2].n_runs, rows[2].start, rows[2].length) == (1, 5, 6)
    assert {r.doc_id: r.collapsed for r in find_runs(docs).collect()}[1] == "a x b"


def test_empty(none):
    assert find_runs(none).count() == 0 and run_digests(find_runs(none)).count() == 0


def test_refuses_one_period(odd):
    with pytest.raises(ValueError):
        find_runs(odd, periods=1)
