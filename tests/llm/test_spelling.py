"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from farelane.llm import queries
from farelane.llm.op12_spelling import counted, letter_runs, near_words, spelling_variants, trie_edges


def near_of(words):
    """Pairs one edit apart: words with equal rests around one letter, or one letter less."""
    near, around = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            around[i, w[:i], w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for group in around.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(counts, ratio=5):
    near = near_of(set(counts))
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), counts.get(form.get(w)))
    return out


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def table(spark, counts):
    rows = [(w, n, "x", "y", 1) for w, n in counts.items()]
    return spark.createDataFrame(rows, "word string, n int, form string, rest string, u int")


def test_query(spark, sf_dir):
    counts = Counter()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r.doc_id}:{word}".encode())
            if h % 199 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert len(counts) > 500
    assert found(queries.QUERIES["op12_spelling"](spark, sf_dir)) == brute(counts)


def test_made_words(spark):
    """Few letters, so that words share beginnings, are beginnings of others and have many neighbours."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abü") for _ in range(rng.randint(1, 7))) for _ in range(500)}
    words |= {"a" * k for k in range(1, 12)} | {"😀ab", "😀b", "b"}
    counts = {w: rng.choice([1, 1, 2, 5, 25, 26, 130]) for w in sorted(words)}
    assert found(spelling_variants(table(spark, counts))) == brute(counts)


def test_pairs_come_once(spark):
    counts = {w: 1 for w in ("hello", "helo", "hllo", "hell", "helloo", "jello", "h")}
    pairs = [tuple(sorted(r)) for r in near_words(trie_edges(table(spark, counts))).collect()]
    assert len(pairs) == len(set(pairs))
    near = near_of(set(counts))
    assert set(pairs) == {tuple(sorted((a, b))) for a in near for b in near[a]}


def test_long_words_are_few_edges(spark):
    """Words of thousands of letters part once: rounds follow the nodes, not the letters."""
    long = "abcdefgh" * 1000
    counts = {long: 50, long[:4000] + long[4001:]: 5, long + "x": 4, long[:-1] + "y": 3, "other": 9}
    edges = trie_edges(table(spark, counts)).collect()
    assert len(edges) < 12
    assert found(spelling_variants(table(spark, counts))) == brute(counts)


def test_chain_of_forms(spark):
    counts = {"aaaaaa": 1, "aaaaab": 5, "aaaabb": 25, "aaabbb": 125, "aabbbb": 625}
    rows = found(spelling_variants(table(spark, counts)))
    assert rows == brute(counts) and rows["aaaaaa"][:2] == ("aaaaab", "aabbbb")


def test_odd_rows(spark, odd, none):
    assert spelling_variants(counted(letter_runs(none))).count() == 0
    runs = sorted((r.doc_id is None, r.doc_id or 0, r.word) for r in letter_runs(odd, 1).collect())
    expected = [
        (r.doc_id is None, r.doc_id or 0, re.sub("[A-Z]", lambda m: m[0].lower(), w))
        for r in odd.select("doc_id", "text").collect()
        for w in re.findall("[A-Za-zÀ-ÿ]+", r.text or "")
    ]
    assert runs == sorted(expected)
    counts = spark.createDataFrame([(None, 7), ("", 8), ("word", None), ("wort", 3)], "word string, n long")
    assert {r.word: r.n_near for r in spelling_variants(counts).collect()} == {"word": 1, "wort": 1}


def test_words_are_counted_over_all_rows(make):
    docs = make(*[(i, "Banana banana BANANA, ananas") for i in range(3)])
    assert {r.word: r.n for r in counted(letter_runs(docs)).collect()} == {"banana": 9}
    assert counted(letter_runs(docs), min_count=1).filter(F.col("word") == "ananas").first().n == 3
