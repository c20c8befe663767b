"""N-gram Jaccard join, heavy and light: subsets of small sets, inverted lists of large ones."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations, count
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.components import components
from farelane.llm.keys import BROADCAST_ROWS, KEY, broadcast_if_small, join_frequent, row_key
from farelane.llm.texts import hashes, joined, slices, small_batches, words_of
from farelane.session import save_table

#: Cells of each sketch of counts, in chunks of a row, and tasks whose sketches meet first.
CELL_BITS, CHUNK_BITS, MEETING = 22, 16, 64
#: Classes of counts that a doubling of the count goes through.
FINE = 4
#: Bytes of text whose words and shingles a task holds at once.
HELD_BYTES = 1 << 20
#: Largest set that may be light, and rows of subsets that a scanned pair is worth.
SMALL, PAIR_COST = 32, 4
#: Members that a list is compared with in one turn.
CENTRES = 4
#: Words of the smallest bitmap of a set; to so many the members of lists fold theirs.
LEAST_WORDS = 8


def least_overlap(a: int, b: int, percent: int) -> int:
    """Common shingles from which on sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: np.ndarray | int, percent: int):
    """So many shingles, first in the common order, hold one of any linked partner's first ones."""
    return n - -(-percent * n // 100) + 1


def parity_bits(own: np.ndarray) -> np.ndarray:
    """For each cell of a bitmap whether an odd number of the set's shingles falls in it, in words of
    64 cells; there are two to four cells for a shingle, or more if it is the smallest bitmap. Cells of
    two sets that differ are at most as many as the shingles of only one of them."""
    words = max(LEAST_WORDS, 1 << (max(len(own) - 1, 0) // 32).bit_length())
    odd = np.bincount(own.view(np.int64) & (64 * words - 1), minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def shingle_sets(
    text: pa.Array, width: int, ranks: tuple[np.ndarray, np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """The set of hashed shingles of each text, sorted; a shorter text is one shingle, an empty one none.

    With ``ranks``, the classes of counts of shingles and of words, also how rare each one is: the
    smaller of two bounds of its count, its cell's and that of its rarest word, then its words' classes.
    """
    rows, index, words = words_of(pc.ascii_lower(text))
    coded = hashes(words)
    word = coded[index] if len(index) else np.zeros(0, np.uint64)
    wide = len(word) >= width
    full = joined(*[word[i : len(word) - width + 1 + i] for i in range(width)]) if wide else word[:0]
    if ranks is not None:
        shingles, of_words = ranks
        own_class = of_words[_cells(coded)][index].astype(np.int64) if len(index) else np.zeros(0, np.int64)
        parts = [own_class[i : len(word) - width + 1 + i] for i in range(width)] if wide else []
        least = np.minimum.reduce(parts) if wide else own_class[:0]
        rare = np.minimum(shingles[_cells(full)], least) * (1 << 16) + sum(parts) if wide else least
    ends = np.searchsorted(rows, np.arange(len(text) + 1)).tolist()
    for lo, hi in zip(ends, ends[1:]):
        if hi - lo >= width:
            own, first = np.unique(full[lo : hi - width + 1], return_index=True)
            yield own, None if ranks is None else rare[lo : hi - width + 1][first]
        else:
            # At most one shingle, which needs no order.
            own = joined(*[word[i : i + 1] for i in range(lo, hi)]) if hi > lo else word[:0]
            yield own, None if ranks is None else np.zeros(len(own), np.int64)


def _cells(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def count_sketch(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of how many documents have a shingle of each cell, and how often a word of each cell
    stands in any: two sketches of a fixed number of cells, whatever the data.

    They only order shingles, rare ones first; any order gives the same links. There are ever more
    shingles to a cell as a corpus grows, but few new words: where the first sketch is full, a shingle
    is as rare as its rarest word. Tasks add up their own, then groups of tasks, then all; a cell of
    one task stops at 255, or 65535 for words. The driver gets the classes, a byte a cell, compressed.
    """
    limits = {"shingles": (255, np.uint8), "words": (65535, np.uint16)}

    def own(batches):
        # Counts stop at their limits as they grow, so that narrow cells hold them.
        cells = {"shingles": np.zeros(1 << CELL_BITS, np.uint8), "words": np.zeros(1 << CELL_BITS, np.uint32)}
        seen = 0

        def count(text: pa.Array) -> None:
            for own, _ in shingle_sets(text, width):
                at = _cells(own)
                before = cells["shingles"][at]
                cells["shingles"][at] = before + (before < limits["shingles"][0])
            _, index, words = words_of(pc.ascii_lower(text))
            at = _cells(hashes(words))
            np.add.at(cells["words"], at, np.bincount(index, minlength=len(words)).astype(np.uint32))
            cells["words"][at] = np.minimum(cells["words"][at], limits["words"][0])

        for batch in slices(batches, limit=HELD_BYTES):
            count(batch.column("text"))
            seen += batch.num_rows
        if seen:
            part = TaskContext.get().partitionId()
            for kind, (_, size) in limits.items():
                parts = cells.pop(kind).reshape(-1, 1 << CHUNK_BITS)
                yield pa.RecordBatch.from_pydict(
                    {
                        "kind": [kind] * len(parts),
                        "chunk": list(range(len(parts))),
                        "part": [part] * len(parts),
                        "cells": [x.astype(size).tobytes() for x in parts],
                    }
                )

    def total(first: bool):
        def add(table: pa.Table) -> pa.Table:
            size = limits[table["kind"][0].as_py()][1] if first else np.uint32
            cells = sum(np.frombuffer(x.as_py(), dtype=size).astype(np.uint32) for x in table["cells"])
            keys = {k: table[k][:1] for k in ("kind", "chunk", "part")}
            packed = cells.tobytes()
            if not first:
                packed = zlib.compress((FINE * np.log2(cells.astype(np.float64) + 1)).astype(np.uint8).tobytes(), 1)
            return pa.table({**keys, "cells": pa.array([packed], pa.binary())})

        return add

    schema = "kind string, chunk long, part long, cells binary"
    sketch = docs.select("text").mapInArrow(own, schema).withColumn("meet", F.expr(f"part div {MEETING}"))
    sketch = sketch.groupBy("kind", "chunk", "meet").applyInArrow(total(True), schema)
    classes = {k: np.zeros((1 << CELL_BITS - CHUNK_BITS, 1 << CHUNK_BITS), dtype=np.uint8) for k in limits}
    for row in sketch.groupBy("kind", "chunk").applyInArrow(total(False), schema).collect():
        classes[row.kind][row.chunk] = np.frombuffer(zlib.decompress(row.cells), dtype=np.uint8)
    return classes["shingles"].reshape(-1), classes["words"].reshape(-1)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))


def ordered_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Each row's key, id, set size, 128-bit hash of the set, its bitmap, and its first shingles in the
    common order: rare ones first, then by hash. Small sets keep all of their shingles."""
    ranks = docs.sparkSession.sparkContext.broadcast(count_sketch(docs, width))

    def order(batches):
        for batch in slices(batches, limit=HELD_BYTES):
            sizes, set_a, set_b, bits, firsts = [], [], [], [], []
            for own, rare in shingle_sets(batch.column("text"), width, ranks.value):
                n = len(own)
                digest = xxhash.xxh3_128_digest(own.tobytes())
                a, b = np.frombuffer(digest, dtype=np.int64).tolist()
                keep = n if n <= SMALL else int(prefix_size(n, percent))
                sizes.append(n)
                set_a.append(a)
                set_b.append(b)
                bits.append(parity_bits(own))
                firsts.append(own[np.lexsort((own, rare))[:keep]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in ("row", *KEY, "doc_id")),
                    pa.array(sizes, pa.int64()),
                    pa.array(set_a, pa.int64()),
                    pa.array(set_b, pa.int64()),
                    _lists(bits),
                    _lists(firsts),
                ],
                ["row", *KEY, "doc_id", "n", "set_a", "set_b", "bits", "firsts"],
            )

    ids = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), *row_key(docs["doc_id"], docs["text"]), "doc_id", "text"
    )
    schema = f"row long, key_a long, key_b long, doc_id {ids}, n long, set_a long, set_b long, "
    schema += "bits array<long>, firsts array<long>"
    saved = save_table(rows.mapInArrow(order, schema), "sets")
    ranks.destroy()  # the table is read from now on
    return saved


def _partners(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(size, larger size, common shingles) of every pair of sizes with ``n`` in it that can link."""
    out = []
    for m in range(-(-percent * n // 100), 100 * n // percent + 1):
        a, b = min(n, m), max(n, m)
        c = least_overlap(a, b, percent)
        if c <= a:
            out.append((a, b, c))
    return out


def subset_cost(n: int, percent: int) -> int:
    """Subsets that a set of this size lists."""
    return sum(comb(n, c) for _, _, c in _partners(n, percent))


def light_limit(unique: DataFrame, percent: int) -> int:
    """The size from which on sets are heavy: where the subsets of all sets of a size are more than
    the postings and scanned pairs of their inverted lists. At most ``SMALL`` rows are collected."""
    small = unique.filter(F.col("n").between(1, SMALL))
    lists = small.select("n", F.explode(_first(percent)).alias("token")).groupBy("token", "n").agg(F.count(F.lit(1)).alias("c"))
    sized = lists.groupBy("token").agg(F.collect_list(F.struct("n", "c")).alias("all"))  # SMALL rows at most
    near = lambda x, y: (y["n"] * 100 >= x["n"] * percent) & (x["n"] * 100 >= y["n"] * percent)
    scanned = sized.select(F.explode("all").alias("x"), "all").select(
        "x.n",
        "x.c",
        F.aggregate(
            F.transform(F.filter("all", lambda y: near(F.col("x"), y)), lambda y: y["c"]),
            F.lit(0).cast("long"),
            lambda a, c: a + c,
        ).alias("met"),
    )
    pairs = {r.n: (r.postings, r.pairs) for r in scanned.groupBy("n").agg(F.sum("c").alias("postings"), F.sum(F.col("c") * F.col("met")).alias("pairs")).collect()}
    for n in range(1, SMALL + 1):
        postings, met = pairs.get(n, (0, 0))
        # A set has as many postings as first shingles.
        if postings // prefix_size(n, percent) * subset_cost(n, percent) > postings + PAIR_COST * met:
            return n
    return SMALL + 1


def light_edges(unique: DataFrame, limit: int, percent: int) -> DataFrame:
    """Edges of linked sets below ``limit``: they share a subset of just the size that links them.

    Subsets are listed for each pair of sizes, so sharing one is linking, and all sets that share
    one are linked in a star, without a pair of each two.
    """

    def enumerate_subsets(batches):
        for batch in batches:
            nodes, smaller, larger, sums = [], [], [], []
            for node, n, own in zip(*(batch.column(k).to_pylist() for k in ("node", "n", "firsts"))):
                own = sorted(own)
                for a, b, c in _partners(n, percent):
                    if b >= limit:
                        continue
                    for chosen in combinations(own, c):
                        digest = xxhash.xxh3_128_digest(np.array(chosen, dtype=np.int64).tobytes())
                        nodes.append(node)
                        smaller.append(a)
                        larger.append(b)
                        sums.append(digest)
                    if len(nodes) > 50_000:
                        yield pa.RecordBatch.from_pydict({"node": nodes, "n": smaller, "m": larger, "subset": sums})
                        nodes, smaller, larger, sums = [], [], [], []
            if nodes:
                yield pa.RecordBatch.from_pydict({"node": nodes, "n": smaller, "m": larger, "subset": sums})

    light = unique.filter((F.col("n") > 0) & (F.col("n") < limit)).select("node", "n", "firsts")
    sizes = light.select("node", F.col("n").alias("size"))
    listed = light.mapInArrow(enumerate_subsets, "node long, n long, m long, subset binary")
    listed = save_table(listed.join(sizes, "node"), "subsets")
    key = ["n", "m", "subset"]
    # Sets of one size share a subset with each other only where that size is the pair.
    stars = listed.groupBy(*key).agg(
        F.min("node").alias("v"), F.min("size").alias("low"), F.max("size").alias("high"), F.count(F.lit(1)).alias("c")
    )
    stars = stars.filter((F.col("c") > 1) & (F.col("low") == F.col("n")) & (F.col("high") == F.col("m")))
    return listed.join(stars, key).filter("node <> v").select(F.col("node").alias("u"), "v")


def _can_link(most: str, x: str, y: str, percent: int) -> Column:
    """Whether sets of these sizes can link with at most ``most`` shingles of each in common."""
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    enough = F.least(F.col(f"{x}.{most}"), F.col(f"{y}.{most}")) * (100 + percent) >= (a + b) * percent
    return enough & (a * 100 >= b * percent) & (b * 100 >= a * percent)


def _folded(bits: Column, word: Column, words: Column) -> Column:
    """That word of a bitmap folded to so many."""
    places = F.sequence(word, F.size(bits) - 1, words)
    return F.aggregate(places, F.lit(0).cast("long"), lambda acc, k: acc.bitwiseXOR(F.get(bits, k)))


def differing(x: str, y: str) -> Column:
    """Cells in which the bitmaps of two sets differ; the larger is folded to the smaller's cells."""
    a, b = F.col(f"{x}.bits"), F.col(f"{y}.bits")
    words = F.least(F.size(a), F.size(b))
    return F.aggregate(
        F.sequence(F.lit(0), words - 1),
        F.lit(0),
        lambda acc, k: acc + F.bit_count(_folded(a, k, words).bitwiseXOR(_folded(b, k, words))),
    )


def shortened(bits: str) -> Column:
    """The bitmap folded to ``LEAST_WORDS`` words."""
    words = F.lit(LEAST_WORDS)
    return F.transform(F.sequence(F.lit(0), words - 1), lambda k: _folded(F.col(bits), k, words))


def differing_short(x: str, y: str) -> Column:
    """As ``differing`` of shortened bitmaps; without a lambda, so that a join can have it as a condition."""
    cells = [F.bit_count(F.get(f"{x}.short", F.lit(i)).bitwiseXOR(F.get(f"{y}.short", F.lit(i)))) for i in range(LEAST_WORDS)]
    return sum(cells[1:], cells[0])


def _near(cells: Column, x: str, y: str, percent: int) -> Column:
    """Whether two sets can link by the cells in which their bitmaps differ: linked ones differ in few shingles."""
    return cells * (100 + percent) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - percent)


def _bound(x: str, y: str, percent: int) -> Column:
    """Whether two sets can link, from their sizes and first shingles: those after the last common one
    can all be common, those before can't but for the ones that are."""
    common = F.array_intersect(F.col(f"{x}.firsts"), F.col(f"{y}.firsts"))
    last = F.element_at(common, -1)
    rest = [F.col(f"{k}.n") - F.array_position(F.col(f"{k}.firsts"), last) for k in (x, y)]
    most = F.size(common) + F.least(*rest)
    return (F.size(common) > 0) & (most * (100 + percent) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * percent)


def verified(pairs: DataFrame, unique: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) of sets that link, by their whole sets, which are made anew from the
    texts of the documents that stand for them."""
    nodes = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).distinct().withColumnRenamed("u", "node")
    wanted = save_table(nodes.join(unique.select("node", *KEY), "node"), "wanted")
    keyed = docs.select(*row_key(docs["doc_id"], docs["text"]), "text")
    texts = keyed.join(broadcast_if_small(wanted), KEY).select("node", "text")

    def sets(batches):
        for batch in slices(batches, limit=HELD_BYTES):
            own = [x.view(np.int64) for x, _ in shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(own)], ["node", "shingles"])

    # Repeated rows give a set twice.
    whole = save_table(texts.mapInArrow(sets, "node long, shingles array<long>"), "shingles").dropDuplicates(["node"])
    left, right = whole.toDF("u", "set_u"), whole.toDF("v", "set_v")
    met = pairs.join(left, "u").join(right, "v")
    common = F.size(F.array_intersect("set_u", "set_v"))
    either = F.size("set_u") + F.size("set_v") - F.col("common")
    return met.withColumn("common", common).filter(F.col("common") * 100 >= either * percent).select("u", "v")


def _first(percent: int) -> Column:
    return F.slice("firsts", 1, (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``u``, ``v``) that can link by the first shingles and the bitmaps of both."""
    met = pairs.join(sets.toDF("u", "x"), "u").join(sets.toDF("v", "y"), "v")
    met = met.filter(_bound("x", "y", percent)).filter(_near(differing("x", "y"), "x", "y", percent))
    return save_table(met.select("u", "v"), "pairs")


def _unconnected(lists: DataFrame, found: DataFrame) -> DataFrame:
    """Members that are not their list's pivot, with their component and the pivot's (``main``): of
    lists with two or more, and not all of one component."""
    named = lists.filter("c > 2").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = save_table(named.filter("node <> pivot").drop("c"), "members")
    mixed = members.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    members = members.join(mixed.filter("low <> high").select("token"), "token")
    members = members.join(found.toDF("pivot", "main"), "pivot", "left").withColumn("main", F.coalesce("main", "pivot"))
    return save_table(members, "unconnected")


def _to_meet(members: DataFrame) -> tuple[int, int]:
    """How many members there are, and how many pairs of them share a list but no component."""
    parts = members.groupBy("token", "component").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("c"))
    whole = parts.groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("same"))
    rows, pairs = whole.agg(F.sum("c"), F.sum(F.col("c") * F.col("c") - F.col("same"))).first()
    return int(rows or 0), int(pairs or 0) // 2


def all_components(unique: DataFrame, light: DataFrame, docs: DataFrame, limit: int, width: int, percent: int) -> DataFrame:
    """``node`` and ``component`` of all linked sets: by the ``light`` edges, and by edges found here that
    connect those of which one has ``limit`` shingles or more.

    Inverted lists hold the first shingles of each set. Lists of one member go. Sets that meet in a
    list have nothing in common before its shingle but what is in other lists, so a set's shingles
    that stood alone before it can't be common: ``most`` is what is left.
    Every list has a pivot, its smallest node. Members are compared with it first, which connects a
    group of near copies without a pair of each two. While many pairs of different components are
    left, ``CENTRES`` other members of each list, by a hash, are compared with it in turn. Then only members that are not connected yet
    are compared: those outside the pivot's component with all members of other components. What is
    left out is connected already; how many turns there are does not change what is connected.
    """
    least = -(-percent * limit // 100)
    kept = unique.filter(F.col("n") >= least).select("node", "n", "bits", _first(percent).alias("firsts"))
    postings = kept.select("node", "n", F.posexplode("firsts").alias("place", "token"))
    pivots = postings.groupBy("token").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("c"))
    shared = postings.join(pivots.filter("c > 1"), "token")
    in_order = Window.partitionBy("node").orderBy("place")  # as many rows as a set has first shingles
    alone = F.col("place") - F.row_number().over(in_order) + 1
    lists = save_table(shared.withColumn("most", F.col("n") - alone).drop("place"), "lists")
    sets = kept.select("node", F.struct("n", "bits", "firsts").alias("set"))

    size = F.struct("n", "most")
    centres = lists.filter("node = pivot").select("token", F.col("node").alias("v"), size.alias("y"))
    pairs = lists.filter("node <> pivot").select("token", F.col("node").alias("u"), size.alias("x")).join(centres, "token")
    heavy = F.greatest("x.n", "y.n") >= limit
    pairs = pairs.filter(heavy & _can_link("most", "x", "y", percent)).select("u", "v").distinct()
    edges = save_table(verified(_bounded(pairs, sets, percent), unique, docs, width, percent), "links")

    left = None
    for turn in count(1):
        found = save_table(components(edges.unionByName(light)), "components")
        members = _unconnected(lists, found)
        before, (rows, left) = left, _to_meet(members)
        # Other members of each list are its centres as long as that spares a tenth of the pairs.
        if left <= PAIR_COST * rows or (before is not None and left > before * 9 // 10):
            break
        member, order = F.struct("node", "component", "n", "most"), F.xxhash64("node", F.lit(turn))
        centres = members.groupBy("token", F.pmod(order, F.lit(CENTRES))).agg(F.min_by(member, order).alias("y"))
        centres = centres.select("token", "y")
        pairs = members.select("token", member.alias("x")).join(centres, "token").filter(
            (F.col("x.component") != F.col("y.component")) & heavy & _can_link("most", "x", "y", percent)
        )
        pairs = pairs.select(F.greatest("x.node", "y.node").alias("u"), F.least("x.node", "y.node").alias("v")).distinct()
        more = verified(_bounded(pairs, sets, percent), unique, docs, width, percent)
        edges = save_table(edges.unionByName(more), "links")
    if not left:
        return found
    # A pair meets in every list that both are in; it counts where their smallest common token is, and if
    # their bitmaps are near: those of members just below the limit, which meet pairwise, mostly are not.
    own = members.groupBy("node").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    short = kept.join(own, "node").select("node", "tokens", shortened("bits").alias("short"))
    members = members.join(short, "node").select(
        "token", F.struct("node", "component", "main", "tokens", "short", "n", "most").alias("x")
    )
    strays = members.filter("x.component <> x.main")
    met = strays.join(members.withColumnRenamed("x", "y"), "token").filter(
        (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.main")) | (F.col("x.node") > F.col("y.node")))
        & (F.greatest("x.n", "y.n") >= limit)
        & _can_link("most", "x", "y", percent)
        & _near(differing_short("x", "y"), "x", "y", percent)
        & (F.element_at(F.array_intersect("x.tokens", "y.tokens"), 1) == F.col("token"))
    )
    rest = met.select(F.greatest("x.node", "y.node").alias("u"), F.least("x.node", "y.node").alias("v")).distinct()
    rest = _bounded(rest, sets, percent)
    if rest.isEmpty():
        return found
    # What is connected already goes on as the stars of its components.
    stars = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return components(stars.unionByName(verified(rest, unique, docs, width, percent)))


def linked(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """As ``_linked``, whose jobs in Python workers all run before it returns, in small batches."""
    with small_batches(docs.sparkSession):
        return _linked(docs, width, percent)


def _linked(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``text``): its ``row`` number, key, ``n`` and ``component``, a
    number that linked rows share; an empty set has a component of its own."""
    sets = ordered_sets(docs, width, percent)
    held = sets.filter("n > 0")
    # Equal sets are one node, the row of the smallest number; the others of its rows go.
    reps = save_table(held.groupBy("set_a", "set_b").agg(F.min("row").alias("node")), "nodes")
    copies = save_table(
        held.select("set_a", "set_b", "row").join(reps, ["set_a", "set_b"]).filter("row <> node").select("row"), "copies"
    )
    if copies.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        unique = held.join(F.broadcast(copies), "row", "left_anti")
    else:
        unique = save_table(held.join(copies, "row", "left_anti"), "unique")
    unique = unique.withColumnRenamed("row", "node")
    limit = light_limit(unique, percent)
    light = save_table(light_edges(unique, limit, percent), "light")
    found = all_components(unique, light, docs, limit, width, percent)
    nodes = reps.join(found, "node", "left")
    nodes = nodes.select("set_a", "set_b", F.coalesce("component", "node").alias("component"))
    rows = held.drop("bits", "firsts").join(nodes, ["set_a", "set_b"])
    alone = sets.filter("n = 0").drop("bits", "firsts").withColumn("component", F.col("row"))
    return rows.select(*alone.columns).unionByName(alone).drop("set_a", "set_b")


def join_components(
    docs: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links, for each row.

    Two documents link when their sets of ``width``-word shingles have ``percent`` per cent of the
    shingles of both in common. Equal sets are one set. Small sets list every subset of the size that
    links two of them; large sets meet in inverted lists of their rarest shingles; the size between
    is where one costs as much as the other. What can link by its first shingles is compared whole.

    Null and empty texts have an empty set and link with nothing. Null ids are never the smallest;
    a component of null ids alone has a null one. Repeated rows are copies of each other. An empty
    table gives no row. Other columns are not read.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    rows = save_table(linked(docs, width, percent), "linked")
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("c"))
    return join_frequent(rows, save_table(least, "least"), "component", "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the smallest id, of equal ones the first by key.

    All columns stay, whatever their names. Of repeated rows (same id and text) one stays; documents
    without words all stay.
    """
    rows = save_table(linked(docs.select("doc_id", "text"), width, percent), "linked").filter("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEY)
    kept = rows.groupBy("component").agg(F.min(order).alias("kept"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    many = join_frequent(rows, save_table(kept, "kept"), "component", "c")
    same = (F.col("key_a") == F.col("kept.key_a")) & (F.col("key_b") == F.col("kept.key_b"))
    # The keys of rows in a larger component: those that go, and those of which one row stays.
    touched = save_table(many.withColumn("stays", same).select(*KEY, "stays").distinct(), "touched")
    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *row_key(docs["doc_id"], docs["text"]))
    marked = given.join(broadcast_if_small(touched), KEY, "left")
    free = marked.filter(F.col("stays").isNull()).select("doc")
    stay = marked.filter("stays").dropDuplicates(KEY).select("doc")
    return free.unionByName(stay).select("doc.*")
