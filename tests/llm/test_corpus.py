"""Decontamination, toxicity, near duplicates, neighbours, repeats and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from farelane.llm.components import components
from farelane.llm.op05_decontamination import find_leaks, without_leaks
from farelane.llm.op06_toxicity import score_toxicity, without_toxic
from farelane.llm.op07_jaccard_join import SMALL, join_components, one_of_each, subset_cost
from farelane.llm.op08_neighbours import find_nearest
from farelane.llm.op09_suffix_dedup import repeat_digests

SF = "/root/testdata/sf0.001"


def _ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


ITEM = "If Maria drives 120 km in 3 hours, how far does Maria drive in 5 hours at that same steady speed"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, "What colour is the sky"), (3, None), (4, ""), (5, ITEM), (6, "7 8 9")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_leaks(odd, make, items, none, spark):
    changed = ITEM.replace("Maria", "Peter").replace("120 km", "90 miles").replace("3 hours", "2 hours")
    broken = ITEM.replace("Maria drives", "Peter drives")  # the second Maria stays
    docs = odd.unionByName(
        make(
            (20, "Here it comes. " + ITEM + "? And more."),
            (21, "xx " + changed + " yy"),
            (22, "xx " + ITEM.lower() + " yy"),
            (23, "xx " + ITEM.upper() + " yy"),
            (24, "xx " + broken + " yy"),
            (25, "so what colour is the sky today"),
            (26, "what colour is a sky"),
            (27, "1 2 3 4 5 6"),
        )
    )
    got = {(r.doc_id, r.item_id): r for r in find_leaks(docs, items).collect()}
    assert set(got) == {(20, 1), (21, 1), (22, 1), (23, 1), (24, 1), (25, 2)}
    assert got[20, 1].n_changed == 0 and got[20, 1].coverage == 1.0
    assert got[21, 1].n_changed >= 4
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 6
    assert find_leaks(none, items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0


def test_leaks_of_items_dense_in_slots(make, spark):
    dense = [
        "What is 12 times 13?",
        "Compute 12 + 7 * 3 - 18 / 6 + 44 - 2 * 9 + 5 * 11 - 3",
        "Did Angela Merkel meet Barack Obama in Berlin Germany on Monday June 3 2013",
        "Which Of These Old Towns Lies Nearest The River Rhine And Its Southern Bank",
    ]
    edge = "how many people came to the party with Anna Bob Carl Dora Emil"  # its last windows are mostly slots
    items = spark.createDataFrame(list(enumerate([*dense, edge])), "item_id long, text string")
    docs = make(
        *[(10 + k, f"so they ask: {t} and go on") for k, t in enumerate([*dense, edge])],
        *[(20 + k, f"so they ask: {t.lower()} and go on") for k, t in enumerate([*dense, edge])],
        (30, "they ask how many people came to the party with Gina Hans Ida Jan Kurt and go on"),
        (31, "What is 12 plus 13? Compute 5 + 6 + 7 + 8 + 9 + 10 + 11 + 12 + 13 + 14"),
        (32, "Ann Bea Cleo Dan Eve Finn Gus in Hamburg on Tuesday July 4 2014"),
    )
    got = {(r.doc_id, r.item_id): r.coverage for r in find_leaks(docs, items).collect()}
    assert got == {**{(10 + k, k): 1.0 for k in range(5)}, **{(20 + k, k): 1.0 for k in range(5)}, (30, 4): 1.0}


def test_leaks_whose_new_values_coincide(make, spark):
    item = "Maria has 5 apples and 3 pears so how many pieces of fruit does Maria have if she eats 5 of them"
    other = item.replace("Maria", "Peter")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = make(
        (10, other.replace("5", "4").replace("3", "4")),
        (11, other.replace("5 apples", "4 apples").replace("3", "4")),  # 5 is 4, then 5
    )
    assert [(r.doc_id, r.n_slots, r.n_changed) for r in find_leaks(docs, items).collect()] == [(10, 5, 5)]


def test_toxicity(odd, make, none, spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(2000):
        text = rng.choices(words, k=30)
        bad = k % 5 == 0
        if bad:
            text[rng.randrange(30)] = rng.choice(["vile", "awful"])
            text[rng.randrange(30)] = "vile"
        rows.append((100 + k, " ".join(text)))
        labels.append((100 + k, int(bad)))
    labels = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")
    docs = make(*rows).unionByName(odd)
    got = score_toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    fresh = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 100]
    right = sum(r.predicted == int((r.doc_id - 100) % 5 == 0) for r in fresh)
    assert right / len(fresh) > 0.97


def test_toxicity_without_labels_or_rows(odd, none, spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in score_toxicity(odd, empty).collect()} == {0.5}
    assert score_toxicity(none, empty).count() == 0


def test_nothing_learnt_rejects_nothing(odd, spark):
    docs = odd.drop("score")
    held = [k for k in range(1, 9) if zlib.crc32(str(k).encode()) % 5 == 0]
    for rows in ([], [(1, None), (5, None)], [(k, 1) for k in held], [(10**6, 1), (10**6 + 1, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        kept = without_toxic(docs, labels)
        assert kept.columns == docs.columns and kept.count() == docs.count()


def _components(rows, width, percent):
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
        words = [w for w in words if w]
        grams = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                old, new = label[a], label[b]
                label = [new if k == old else k for k in label]
    least = {}
    for k, (i, _) in zip(label, rows):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    return [(i, len(s), least.get(k)) for (i, _), s, k in zip(rows, sets, label)]


def _near_texts(rng, base_words, copies, changes):
    for _ in range(copies):
        words = list(base_words)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_near_duplicates(make, width, percent):
    rng = random.Random(width)
    rows = [(1, "One two three"), (9, "one TWO three"), (None, "one two three"), (4, None), (5, ""), (6, " \n"), (7, "a b")]
    number = 10
    for size, copies, changes in ((12, 40, 1), (22, 40, 2), (33, 30, 3), (60, 40, 5), (150, 60, 9), (400, 20, 20)):
        base = [f"{size}w{k}" for k in range(size)]
        for text in _near_texts(rng, base, copies, changes):
            rows.append((number, text))
            number += 1
        for cut in (1, 2, size // 8):
            rows.append((number, " ".join(base[:-cut])))
            number += 1
    shared = " ".join(f"common{k}" for k in range(12))
    for k in range(60):
        rows.append((number + k, " ".join(f"own{k}x{j}" for j in range(50)) + " " + shared))
    docs = make(*rows)
    got = [tuple(r) for r in join_components(docs, width, percent).collect()]
    assert _ordered(got) == _ordered(_components(rows, width, percent))


def test_one_of_each_keeps_the_smallest(odd, none):
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and sorted(str(i) for i in ids) == sorted(map(str, [1, 2, 3, 4, 5, 6, 7, None, -9]))
    assert one_of_each(none).count() == 0 and join_components(none).count() == 0


def test_subsets_of_small_sets_are_few():
    assert subset_cost(5, 90) == 1 and subset_cost(19, 90) < 300 and SMALL < 64


def test_components_of_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(0, 60)]
    star = [(200, 100 + k) for k in range(50)]
    edges = spark.createDataFrame([*path, *star, (7, 7)], "u long, v long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert all(got[k] == 0 for k in range(61)) and all(got[100 + k] == 100 for k in range(50)) and got[200] == 100
    assert components(edges.limit(0)).count() == 0


def _vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), [float(x) for x in rng.normal(size=6)]) for k in range(300)]
    rows += [(1000 + k, rows[50][1]) for k in range(30)]  # copies tie
    rows += [(50, rows[50][1]), (2000, None), (2050, [0.0] * 6), (2100, [float("nan")] * 6), (2150, [None] * 6)]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (None, [1.0] * 6)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, row string")


def test_neighbours_at_factor_one(spark):
    rows, df = _vectors(spark)
    got = {}
    for r in find_nearest(df, F.col("vec_id") % 50 == 0, 5, factor=1.0, shard_rows=64, query_rows=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    fit = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.all(np.isfinite(v)) and any(v)]
    cosine = lambda a, b: float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
    for at, (i, q) in enumerate(fit):
        if i % 50:
            continue
        near = sorted((-round(cosine(q, v), 12), j) for k, (j, v) in enumerate(fit) if k != at and len(v) == len(q))[:5]
        own = [(round(s, 12), j) for _, j, s in sorted(got[i])]
        assert any([(-s, j) for s, j in near] == own[k : k + 5] for k in range(0, len(own), 5)) or i == 50
    assert [j for _, j, _ in sorted(got[3000])] == [3001]
    assert {2050, 2100, 2150}.isdisjoint(got)
    assert find_nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    exact, ours = (
        {(r.query_id, r.vec_id) for r in find_nearest(df, F.col("vec_id") % 50 == 0, factor=f).collect()} for f in (1.0, 5.0)
    )
    assert len(exact & ours) / len(exact) >= 0.9


@pytest.mark.parametrize("rank", [8, 16])
def test_neighbours_recall_near_few_dimensions(spark, rank):
    rng = np.random.default_rng(rank)
    n, k = 12_000, 5
    vectors = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, 64)) + 0.05 * rng.normal(size=(n, 64))
    vectors = vectors.astype(np.float32).astype(float)
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    cosine = unit[::50] @ unit.T
    cosine[np.arange(len(cosine)), np.arange(0, n, 50)] = -2
    exact = {(50 * q, int(i)) for q, near in enumerate(np.argsort(-cosine, axis=1)[:, :k]) for i in near}
    got = find_nearest(df, F.col("vec_id") % 50 == 0, k).collect()
    assert len(got) == len(exact)
    assert len(exact & {(r.query_id, r.vec_id) for r in got}) / len(exact) >= 0.97


def _removed(rows, length):
    out = []
    for i, text in rows:
        data = (text or "").encode()
        smaller = {
            t.encode()[k : k + length]
            for j, t in rows
            if t and j is not None and (i is None or j < i)
            for k in range(len(t.encode()) - length + 1)
        }
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            if data[k : k + length] in smaller:
                gone[k : k + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone]) if data else b""
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(make, none):
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdé ", k=90))
    rows = [(3, passage), (3, passage), (None, passage), (1, "x" * 200), (2, "x" * 70), (4, None), (5, ""), (6, passage[:49])]
    rows += [(10 + k, "".join(rng.choices("abcd ", k=60)) + passage[k : k + 60 + k] + "".join(rng.choices("xyz ", k=60))) for k in range(20)]
    rows += [(40, passage + passage), (-1, passage[5:80]), (41, "".join(rng.choices("ab", k=3000)))]
    got = [tuple(r) for r in repeat_digests(make(*rows)).collect()]
    assert _ordered(got) == _ordered(_removed(rows, 50))
    assert repeat_digests(none).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, count = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == first.columns
        count.append(docs.count())
    assert count == sorted(count, reverse=True) and count[-1] > 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == count[-1]


def test_pipeline_near_duplicates_keep_one_of_each_component(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == {i if c is None or n == 0 else c for i, n, c in _components(rows, 5, 80)}


def test_pipeline_of_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
