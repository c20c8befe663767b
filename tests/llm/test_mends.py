"""Columns with clashing names, brute-force matchers, and production parameters."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import op05_decontamination as op5
from farelane.llm.keys import join_frequent, row_key
from farelane.llm.op02_secrets import redact, scan_secrets
from farelane.llm.op05_decontamination import LEAST, UNITS, WINDOW, find_leaks, without_leaks
from farelane.llm.op06_toxicity import ALPHA, BETA, L1, L2, Ftrl, without_toxic
from farelane.llm.op07_jaccard_join import one_of_each
from farelane.llm.op08_neighbours import find_nearest
from farelane.llm.op09_suffix_dedup import string_classes

SF = "/root/testdata/sf0.001"

#: Names that the operators use inside, each with a value that a changed column would not keep.
NAMES = (
    "row spans text_ live live_ judged secret owner repo doc given score stays key_a key_b key_a_ key_b_ kept c "
    "component node found words window template n n_owners n_repos features order held_out"
).split()


@pytest.fixture
def clashing(make):
    docs = make(
        (1, "password=abc123xyz and more words to make a text of some length here"),
        (2, "password=abc123xyz and more words to make a text of some length here too"),
        (2, "password=abc123xyz and more words to make a text of some length here too"),
        (3, "a vile thing that nobody wants to read at all in this place today"),
        (4, None),
        (None, "What colour is the sky"),
    ).drop("row", "start", "score", "key_a")
    docs = docs.withColumn("source", F.lit("one"))
    return docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES})


def _kept_as_given(got, docs):
    """All rows of ``got`` are rows of ``docs`` with every value, and the text may be masked."""
    assert got.columns == docs.columns
    given = {tuple(r[c] for c in docs.columns if c != "text") for r in docs.collect()}
    rows = got.collect()
    assert all(tuple(r[c] for c in docs.columns if c != "text") in given for r in rows)
    return rows


def test_columns_with_names_from_inside_stay(clashing, spark):
    masked = _kept_as_given(redact(clashing), clashing)
    assert len(masked) == 6 and "[SECRET]" in next(r.text for r in masked if r.doc_id == 1)
    labels = spark.createDataFrame([(i, int(i == 3)) for i in (1, 2, 3)] * 3, "doc_id long, toxic int")
    assert 0 < len(_kept_as_given(without_toxic(clashing, labels), clashing)) <= 6
    kept = _kept_as_given(one_of_each(clashing, 3, 80), clashing)
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "None"]
    items = spark.createDataFrame([(1, "What colour is the sky")], "item_id long, text string")
    assert len(_kept_as_given(without_leaks(clashing, items), clashing)) == 5


def test_many_repositories_make_a_copied_example(make):
    """One owner's example in many repositories is copied; one in few looks live."""
    docs = make(*[(i, "password=example123") for i in range(30)], *[(100 + i, "password=mine98765") for i in range(3)])
    docs = docs.withColumn("source", F.lit("one"))
    got = {r.doc_id: (r.n_live, r.n_copied) for r in scan_secrets(docs).collect()}
    assert got[5] == (0, 1) and got[101] == (1, 0)
    found = scan_secrets(docs).filter("doc_id = 5").first().found[0]
    assert (found.n_owners, found.n_repos) == (1, 30)
    texts = {r.doc_id: r.text for r in redact(docs).collect()}
    assert texts[5] == "password=example123" and texts[101] == "[SECRET]"


@pytest.mark.parametrize("rows", [6, 30_000])
def test_joining_frequent_keys(spark, rows):
    """A third of all rows share a key; every row finds its partner, whichever way it goes."""
    left = spark.range(rows).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % max(rows // 5, 1)).alias("k"))
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.max("id").alias("last")).persist()
    got = join_frequent(left, right, "k", "c")
    assert got.count() == rows and got.exceptAll(left.join(right, "k")).isEmpty()
    right.unpersist()


# ---- decontamination against a matcher that compares words ----


def _words(text):
    return re.findall(r"(?:[^\W_]|·)+", re.sub(r"(?<=\d)[.,](?=\d)", "·", text or ""))


def _kind(word, before):
    if "0" <= word[0] <= "9":
        return 1
    if word.lower() in UNITS and before is not None and "0" <= before[0] <= "9":
        return 3
    return 2 if word[0] != word[0].lower() and word != word.upper() else 0


def _kinds(words):
    return [_kind(w, words[i - 1] if i else None) for i, w in enumerate(words)]


def _forms(words, kinds):
    literal = [w.lower() for w in words]
    slots = [k or w for k, w in zip(kinds, literal)]
    return slots, [k if k and k != 2 else w for k, w in zip(kinds, literal)], literal


def _matches(text, item):
    """The shifts along which a text holds an item, by comparing every window of words."""
    words, other = _words(text), _words(item)
    kinds, given = _kinds(words), _kinds(other)
    width, out = min(WINDOW, len(other)), set()
    if not other:
        return out
    here, mine = _forms(words, kinds), _forms(other, given)
    for shift in range(1 - len(other), len(words)):
        covered = set()
        for at in range(len(other) - width + 1):
            place = shift + at
            if place < 0 or place + width > len(words):
                continue
            for a in mine:
                window = a[at : at + width]
                plain = sum(isinstance(x, str) for x in window)
                if 2 * plain >= width and any(b[place : place + width] == window for b in (here[0], here[2])):
                    covered |= set(range(at, at + width))
        if not covered:
            continue

        def same(p):
            i = shift + p
            if not 0 <= i < len(words):
                return False
            return words[i].lower() == other[p].lower() or (given[p] > 0 and given[p] == kinds[i])

        while min(covered) > 0 and same(min(covered) - 1):
            covered.add(min(covered) - 1)
        while max(covered) < len(other) - 1 and same(max(covered) + 1):
            covered.add(max(covered) + 1)
        need = min(LEAST, len(other))
        if len(covered) < need:
            continue
        pairs = {(given[p], other[p].lower(), words[shift + p].lower()) for p in covered if given[p]}
        run = best = 0
        for p in range(min(covered), max(covered) + 1):
            run = run + 1 if words[shift + p].lower() == other[p].lower() else 0
            best = max(best, run)
        if len({x[:2] for x in pairs}) == len(pairs) or best >= need:
            out.add(shift)
    return out


def test_leaks_against_a_plain_matcher(make, spark):
    rng = random.Random(4)
    plain = "the of to drives far how many apples does it take at that speed with her".split()

    def text(n):
        return " ".join(rng.choice([*plain, *plain, "Maria", "Peter", "Anna", str(rng.randint(2, 9)), "3 km", "2 hours"]) for _ in range(n))

    items = [(i, text(rng.choice([3, 6, 9, 14, 20, 40]))) for i in range(40)]
    rows = []
    for i in range(150):
        item = rng.choice(items)[1].split()
        a = rng.randrange(len(item))
        part = item if rng.random() < 0.6 else item[a : a + 16]
        swap = {w: rng.choice(["Maria", "Peter", "Zoe"]) for w in ("Maria", "Peter", "Anna")} | {str(k): str(rng.randint(2, 9)) for k in range(2, 10)}
        if rng.random() < 0.6:
            part = [swap.get(w, w) for w in part]
        elif rng.random() < 0.5:
            part = [w if rng.random() < 0.95 else "other" for w in part]
        rows.append((i, " ".join([text(rng.randint(0, 8)), *part, text(rng.randint(0, 8))]).strip()))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.start_word) for r in find_leaks(make(*rows), frame).collect()}
    # Items with the same words count as the one of the smallest id.
    first = {}
    for i, t in items:
        first.setdefault(tuple(_words(t)), (i, t))
    expected = {(d, i, s) for d, t in rows for i, it in first.values() for s in _matches(t, it)}
    assert got == expected and len(expected) > 60


def test_a_long_literal_copy_with_one_changed_name(make, spark):
    """36 words of which 34 in a row are the item's: one of two equal names was changed."""
    item = "Anna " + " ".join(f"word{i}" if i % 5 else "then" for i in range(34)).replace("word", "w") + " Anna"
    doc = "xx Berta" + item[4:] + " yy"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in find_leaks(make((7, doc)), items).collect()] == [7]


@pytest.mark.parametrize("width", [1, 2, 3, 5, 7, 8, 13])
def test_window_hashes_tell_windows_apart(spark, width):
    rng = random.Random(width)
    forms = [[rng.randint(0, 2) for _ in range(n)] for n in (0, 1, 2, 5, 12, 40, 41)]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, f array<long>")
    rows = {r.i: r.runs[0] for r in op5.with_windows(df, ["f"], width, "runs").collect()}
    by_hash, by_window = {}, {}
    for i, f in enumerate(forms):
        windows = [tuple(f[k : k + width]) for k in range(len(f) - width + 1)]
        assert len(rows[i]) == len(windows)
        for h, w in zip(rows[i], windows):
            assert by_hash.setdefault(h, w) == w and by_window.setdefault(w, h) == h


# ---- toxicity against the published update, one coordinate at a time ----


def test_ftrl_against_the_plain_update():
    rng = random.Random(2)
    model, z, n = Ftrl(6), [0.0] * 65, [0.0] * 65

    def weight(i):
        l1 = 0.0 if i == 64 else L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((BETA + n[i] ** 0.5) / ALPHA + L2)

    for _ in range(400):
        at = sorted(rng.sample(range(64), rng.randint(0, 10))) + [64]
        label = int(rng.random() < 0.4 or 3 in at)
        w = {i: weight(i) for i in at}
        g = 1 / (1 + np.exp(-sum(w.values()))) - label
        for i in at:
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / ALPHA
            z[i] += g - sigma * w[i]
            n[i] += g * g
        model.learn(np.array(at), label)
    got = model.weights(np.arange(65))
    assert got == pytest.approx([weight(i) for i in range(65)], abs=1e-12)
    assert 0 < np.count_nonzero(got) < 65


# ---- suffix buckets against the strings themselves ----


def test_buckets_of_equal_strings():
    rng = random.Random(1)
    for _ in range(60):
        length = rng.choice([8, 9, 16, 20, 33, 50])
        segments = [
            bytes(rng.choice(b"ab") for _ in range(rng.randint(length, length + 40))) if rng.random() < 0.7 else b"a" * rng.randint(length, 90)
            for _ in range(rng.randint(1, 12))
        ]
        data, sizes = np.frombuffer(b"".join(segments), dtype=np.uint8), np.array([len(x) for x in segments])
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
        buckets, raw = string_classes(data, left, length), data.tobytes()
        by_string, by_bucket = {}, {}
        for i in np.flatnonzero(left >= length):
            string = raw[i : i + length]
            assert by_string.setdefault(string, buckets[i]) == buckets[i]
            assert by_bucket.setdefault(buckets[i], string) == string


# ---- nearest neighbours with the factor that the query uses ----


def test_recall_at_the_factor_of_the_query(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    chosen = F.col("vec_id") % 50 == 0
    exact = {(r.query_id, r.vec_id) for r in find_nearest(df, chosen, factor=1.0).collect()}
    ours = {(r.query_id, r.vec_id) for r in find_nearest(df, chosen).collect()}
    assert len(exact & ours) / len(exact) >= 0.9


def test_equal_rows_have_equal_keys(odd):
    keyed = odd.select("doc_id", "text", *row_key(odd["doc_id"], odd["text"]))
    assert keyed.select("key_a", "key_b").distinct().count() == odd.select("doc_id", "text").distinct().count()
