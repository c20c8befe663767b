"""Spelling variants: words one edit apart, found by states that walk a distributed trie level by level."""

from __future__ import annotations

from functools import reduce
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.keys import broadcast_if_small
from farelane.session import save_table

#: Letters of a run: Latin ones of the first 256 code points, as a pattern.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: A word has so many code points at least, and occurs so often.
MIN_LENGTH, MIN_COUNT = 6, 5
#: A form occurs so many times as often as its variant at least.
RATIO = 5

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

EDGE = "parent string, head string, label string, child string, ends boolean, words long"


def letter_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``word`` of each maximal run of letters of ``min_length`` code points or more, A-Z lowered."""
    runs = docs.select(
        docs[id_col].alias("doc_id"), F.explode(F.regexp_extract_all(docs[text_col], F.lit(f"({LETTERS})"), F.lit(1))).alias("run")
    ).filter(F.length("run") >= min_length)
    lowered = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, UPPER.lower())).otherwise(F.col("run"))
    return runs.select("doc_id", lowered.alias("word"))


def counted(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n``: how often each of ``words`` occurs, if long and frequent enough."""
    long = words.filter(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def trie_edges(words: DataFrame) -> DataFrame:
    """The edges of the trie of ``words`` (distinct, not empty): ``parent`` and ``child``, nodes named by
    the beginning that leads to them, ``head`` and ``label``, the first letter and all letters of the
    edge, and whether a word ``ends`` at the child.

    A node is the root, or where words part or end, so an edge may hold many letters and a long word
    adds no long path. Each round takes the words one node down: words at a node are grouped by their
    next letter, and what the first and the last word of a group have in common all of it has. As
    many rounds as nodes on a path; groups are combined before they are shuffled.
    """

    def closed(batches):
        for batch in batches:
            rows = []
            for parent, head, low, high, n in zip(*(batch.column(k).to_pylist() for k in ("parent", "head", "low", "high", "words"))):
                child = low if n == 1 else commonprefix([low, high])
                rows.append((parent, head, child[len(parent) :], child, len(low) == len(child), n))
            kinds = [pa.string()] * 4 + [pa.bool_(), pa.int64()]
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds)], ["parent", "head", "label", "child", "ends", "words"]
            )

    edges = []
    left = words.select("word", F.lit(0).alias("depth"))
    while True:
        at = left.select("word", F.substring("word", F.lit(1), F.col("depth")).alias("parent"), F.substring("word", F.col("depth") + 1, F.lit(1)).alias("head"))
        groups = at.groupBy("parent", "head").agg(F.min("word").alias("low"), F.max("word").alias("high"), F.count(F.lit(1)).alias("words"))
        level = save_table(groups.mapInArrow(closed, EDGE), "edges")
        edges.append(level)
        open_ = level.filter("words > 1").select("parent", "head", F.length("child").alias("depth"))
        left = at.join(broadcast_if_small(open_), ["parent", "head"]).filter(F.length("word") > F.col("depth")).select("word", "depth")
        left = save_table(left, "words")
        if not left.limit(1).count():
            return save_table(reduce(DataFrame.unionByName, edges).drop("words"), "trie")


def _rest(text: Column, start: Column) -> Column:
    return F.substring(text, F.length(start) + 1, F.length(text))


def _walked(a: Column, b: Column, x: str, y: str) -> Column:
    """The state after letters ``a`` lead to node ``x`` and ``b`` to ``y``: null if they differ, else
    ``u`` with all letters used, ``v`` and the ``rest`` of the letters to it that ``u`` has to match."""

    def state(u: str, v: str, rest: Column) -> Column:
        return F.struct(
            F.col(f"{u}.child").alias("u"), F.col(f"{u}.ends").alias("u_ends"), F.col(f"{v}.child").alias("v"), F.col(f"{v}.ends").alias("v_ends"), rest.alias("rest")
        )

    return F.when(b.startswith(a), state(x, y, _rest(b, a))).when(a.startswith(b), state(y, x, _rest(a, b)))


def first_edits(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The states after one edit, and the pairs of words of which one is the other and a last letter.

    Two words part at one node, by two of its edges; there are no more edges than letters. Their
    letters there are replaced by each other, or the first word's is inserted and the second's has to
    match what follows it. So each pair of words has one state at most on each way down.
    """
    edge = F.struct("head", "label", "child", "ends")
    x, y = edges.select("parent", edge.alias("x")), edges.select("parent", edge.alias("y"))
    met = x.join(y, "parent").filter("x.head <> y.head")
    after_x, after_y = (F.expr(f"substring({k}.label, 2)") for k in "xy")
    replaced = F.when(F.col("x.head") < F.col("y.head"), _walked(after_x, after_y, "x", "y"))
    inserted = _walked(after_x, F.col("y.label"), "x", "y")
    states = met.select(F.explode(F.array(replaced, inserted)).alias("s")).filter("s is not null").select("s.*")
    last = edges.filter(F.col("ends") & (F.length("label") == 1)).select("parent", F.col("child").alias("u"))
    ended = edges.filter("ends").select(F.col("child").alias("parent"))
    return states, last.join(ended, "parent").select("u", F.col("parent").alias("v"))


def near_words(edges: DataFrame) -> DataFrame:
    """``u``, ``v``: each pair of words of the trie that one inserted, deleted or replaced letter parts.

    A state is a word, its position, a node of the trie and the edits so far. All states kept have one
    edit, as those without are the trie itself; and a word up to a position is a node ``v`` of the
    trie, less the ``rest`` of the letters on the way to it, so that words with one beginning share
    their states. Level by level the states are joined with the edge table on the node ``u`` and the
    next letter; where nothing is left to match, ``v`` first goes on by each of its edges. A state in
    which both nodes end a word is a pair.
    """
    table = broadcast_if_small(edges)
    states, last = first_edits(edges)
    pairs = [last]
    states = save_table(states, "states")
    while states.limit(1).count():
        pairs.append(states.filter("rest = '' and u_ends and v_ends").select("u", "v"))
        onward = table.select(F.col("parent").alias("v"), F.col("child").alias("to"), F.col("ends").alias("to_ends"), "label")
        moved = states.filter("rest = ''").join(onward, "v").select("u", "u_ends", F.col("to").alias("v"), F.col("to_ends").alias("v_ends"), F.col("label").alias("rest"))
        ready = states.filter("rest <> ''").unionByName(moved).select(
            F.col("u").alias("parent"), F.substring("rest", 1, 1).alias("head"), F.struct(F.col("v").alias("child"), F.col("v_ends").alias("ends")).alias("x"), "rest"
        )
        edge = table.select("parent", "head", "label", F.struct("child", "ends").alias("y"))
        met = ready.join(edge, ["parent", "head"]).select(_walked(F.col("label"), F.col("rest"), "y", "x").alias("s"))
        states = save_table(met.filter("s is not null").select("s.*"), "states")
    return reduce(DataFrame.unionByName, pairs)


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word that its forms lead to. Each round doubles the steps; forms
    are ever more frequent words, so there are few and no circle."""
    roots = save_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = save_table(
            roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots"
        )
        if not roots.filter("moved").limit(1).count():
            return roots.drop("moved")


def spelling_variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of each word of ``counts`` (``word``, ``n``).

    Near are words that one inserted, deleted or replaced code point parts; ``n_near`` says how many.
    ``form`` is the near word of largest ``n``, of equal ones the first in the order of code points, if
    it occurs ``ratio`` times as often as the word or more, else null. ``root`` is the last word that
    forms lead to, the word itself without one. Nothing is capped: all near words are found.

    Words are distinct; null and empty ones are left out. An empty table gives no row.
    """
    counts = save_table(counts.filter("word <> ''").select("word", F.col("n").cast("long").alias("n")), "counts")
    pairs = save_table(near_words(trie_edges(counts)), "near")
    both = pairs.toDF("word", "other").unionByName(pairs.toDF("other", "word"))
    near = both.join(counts.toDF("other", "other_n"), "other").groupBy("word")
    near = near.agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    found = counts.join(near, "word", "left")
    form_n = -F.col("best.less")
    is_form = form_n >= F.col("n") * ratio
    found = save_table(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, form_n).alias("form_n")), "forms"
    )
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
