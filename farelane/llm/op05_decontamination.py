"""Benchmark decontamination by template windows; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.keys import KEY, broadcast_if_small, row_key
from farelane.session import save_table

#: Words of a window, and words in place that make a match of a longer item.
WINDOW, LEAST = 8, 13

NUMBER, NAME, UNIT = 1, 2, 3

# Words that are units when they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g gram grams kg oz lb lbs pound pounds "
    "ton tons ml l liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years percent cent cents dollar dollars euro euros degree degrees mph kmh hz khz w kw v"
).split()

_IN_NUMBER = r"(?<=\d)[.,](?=\d)"
_SEPARATORS = r"[^\p{L}\p{N}·]+"


def words_column(text: Column) -> Column:
    """The words of a text; a decimal or grouped number is one word. Null is empty."""
    joined = F.regexp_replace(F.coalesce(text, F.lit("")), _IN_NUMBER, "·")
    return F.filter(F.split(joined, _SEPARATORS), lambda w: w != "")


def _is_number(word: Column) -> Column:
    return F.ascii(word).between(48, 57)


def kind_of(word: Column, before: Column) -> Column:
    """The slot that a word fills: number, unit after a number, name, or 0.

    A name begins with a capital and has small letters; a word all in capitals is a plain word.
    """
    first = F.substring(word, 1, 1)
    return (
        F.when(_is_number(word), NUMBER)
        .when(F.lower(word).isin(UNITS) & F.coalesce(_is_number(before), F.lit(False)), UNIT)
        .when((first != F.lower(first)) & (word != F.upper(word)), NAME)
        .otherwise(0)
    )


def kinds_column(words: str) -> Column:
    return F.transform(words, lambda w, i: kind_of(w, F.get(words, i - 1)))


def literal_column(words: str) -> Column:
    """A hash of each word in lower case."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def canonical_column(literal: str, kinds: str, names: bool = True) -> Column:
    """A number for each word: the slot's, or the word's literal hash."""

    def canonical(kind: Column, own: Column) -> Column:
        slot = (kind > 0) if names else (kind > 0) & (kind != NAME)
        return F.when(slot, kind.cast("long")).otherwise(own)

    return F.zip_with(kinds, literal, canonical)


def _doubled(column: str, by: int) -> Column:
    """A hash of each element of an array of run hashes and the one ``by`` places on, which is null
    beyond the end."""
    return F.transform(column, lambda x, i: F.xxhash64(x, F.get(column, i + by)))


def with_windows(df: DataFrame, forms: list[str], width: int, name: str) -> DataFrame:
    """``df`` with ``name``, an array of arrays: of each of its columns ``forms`` a hash of each run of
    ``width`` words, by place.

    Runs of 2, 4, ... words are hashed from the two halves of each; the last halves overlap if ``width``
    is no power of two. So a word is hashed as often as there are doublings, not as often as a run is
    wide. Each doubling is a column of its own, which is computed once.
    """
    have, steps = 1, []
    while have < width:
        steps.append(min(have, width - have))
        have += steps[-1]
    columns = [f"{name}_{i}" for i in range(len(forms))]
    out = df.withColumns({c: F.col(f) for c, f in zip(columns, forms)})
    for by in steps:
        out = out.withColumns({c: _doubled(c, by) for c in columns})
    whole = [F.slice(c, 1, F.greatest(F.size(f) - width + 1, F.lit(0))) for c, f in zip(columns, forms)]
    return out.withColumn(name, F.array(*whole)).drop(*columns)


def templates(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The different items by their words: the smallest id, words, slots, both canonical forms and the
    literal one.

    In the second form names are words, for copies in lower case.
    """
    words = items.select(items[id_col].alias("item_id"), words_column(items[text_col]).alias("words"))
    split = words.filter(F.size("words") > 0).groupBy("words").agg(F.min("item_id").alias("item_id"))
    split = split.withColumn("kinds", kinds_column("words")).withColumn("literal", literal_column("words"))
    return split.select(
        F.xxhash64("words").alias("template"),
        "item_id",
        "words",
        "kinds",
        F.array(canonical_column("literal", "kinds"), canonical_column("literal", "kinds", False)).alias("forms"),
        "literal",
        F.least(F.lit(WINDOW), F.size("words")).alias("width"),
    )


def template_windows(known: DataFrame) -> DataFrame:
    """``window`` and the place ``at`` of each window of the templates, in all forms.

    A window with slots needs a plain word in every second place, since slots alone say nothing; a
    literal one has no slots.
    """
    forms = known.select("template", "width", F.explode(F.array_union("forms", F.array("literal"))).alias("form"))
    found = None
    for width in _widths(known):
        hashed = with_windows(forms.filter(F.col("width") == width), ["form"], width, "runs")
        placed = hashed.select("template", "width", "form", F.posexplode(F.get("runs", F.lit(0))).alias("at", "window"))
        found = placed if found is None else found.unionByName(placed)
    plain = F.size(F.filter(F.slice("form", F.col("at") + 1, F.col("width")), lambda x: ~x.between(1, 3)))
    return found.filter(2 * plain >= F.col("width")).select("template", "width", "at", "window").distinct()


def _widths(table: DataFrame) -> list[int]:
    """The different widths of windows, ``WINDOW`` values at most; that one if there is none."""
    return [r.width for r in table.select("width").distinct().collect()] or [WINDOW]


def candidates(docs: DataFrame, windows: DataFrame, known: DataFrame) -> DataFrame:
    """Documents (by key) and templates with a window in place along one shift."""
    words = docs.select(*row_key(docs["doc_id"], docs["text"]), words_column(docs["text"]).alias("words"))
    hashed = words.select(*KEY, kinds_column("words").alias("kinds"), literal_column("words").alias("literal"))
    canonical = hashed.select(*KEY, canonical_column("literal", "kinds").alias("form"), "literal")
    found = None
    for width in _widths(windows):
        # The windows of the canonical form, then those of the literal one.
        runs = with_windows(canonical, ["form", "literal"], width, "runs")
        placed = runs.select(
            *KEY, (F.size("form") - width + 1).alias("n"), F.posexplode(F.flatten("runs")).alias("place", "window")
        ).withColumn("place", F.col("place") % F.col("n"))
        own = broadcast_if_small(windows.filter(F.col("width") == width))
        hits = placed.join(own, "window").select(
            *KEY, "template", "width", (F.col("place") - F.col("at")).alias("shift"), "at"
        )
        found = hits if found is None else found.unionByName(hits)
    # Both sets are bounded by the item's length, whatever number of rows share the key.
    lined = found.groupBy(*KEY, "template", "width", "shift").agg(F.collect_set("at").alias("ats"))
    covered = F.array_sort(
        F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + F.col("width") - 1))))
    )
    sized = broadcast_if_small(known.select("template", "item_id", F.col("words").alias("item"), "kinds"))
    return (
        lined.withColumn("covered", covered)
        .join(sized, "template")
        .select(*KEY, "item_id", "item", "kinds", "shift", "covered")
    )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` that hold an item of a benchmark, as it is or with other numbers, names and units.

    Words are replaced by typed slots: numbers, units after a number, names (capitalised words). Runs of
    ``WINDOW`` such words, and of the words as they are, are hashed and joined with those of the items;
    the literal ones find copies of items that are mostly names or numbers. Matches of one document and
    item with the same shift are put together and go on as far as words and slots match; they need
    ``LEAST`` words in place, or all of a shorter item. Their slots are then compared: one value of the
    item must always stand for one value of the document; several of the item may stand for the same,
    as new values may coincide. ``LEAST`` words in a row that are literally the item's, or all of a
    shorter item, are enough by themselves. Items below ``WINDOW`` words are one window.

    Returns a row for each document, item and shift: ``key_a``, ``key_b`` (the row's key), ``doc_id``,
    ``item_id`` (the smallest of items with the same words), ``start_word`` (may be negative if the
    item's beginning is missing), ``n_words`` in place, ``coverage`` of the item, ``n_slots`` compared
    and ``n_changed`` of them.

    Only hits and candidates are shuffled. The items' windows are broadcast if they are few, else
    joined by a shuffle. Null and empty texts match nothing. Repeated rows (same id and text) and
    items are found once each per row. Empty tables give no row. Other columns are not read.
    """
    docs = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    known = save_table(templates(items, item_id_col, item_text_col), "templates")
    windows = save_table(template_windows(known), "windows")
    found = save_table(candidates(docs, windows, known), "candidates")
    by_doc = found.groupBy(*KEY).agg(
        F.collect_list(F.struct("item_id", "item", "kinds", "shift", "covered")).alias("found")
    )
    keyed = docs.select(*row_key(docs["doc_id"], docs["text"]), "doc_id", "text")
    held = keyed.join(broadcast_if_small(save_table(by_doc, "contaminated")), KEY).select(
        *KEY, "doc_id", words_column(F.col("text")).alias("words"), "found"
    )

    def slots(x: Column) -> Column:
        return F.transform(
            F.filter(x["covered"], lambda p: F.get(x["kinds"], p) > 0),
            lambda p: F.struct(
                F.get(x["kinds"], p).alias("kind"),
                F.lower(F.get(x["item"], p)).alias("given"),
                F.lower(F.get(F.col("words"), x["shift"] + p)).alias("here"),
            ),
        )

    each = held.select(*KEY, "doc_id", "words", F.explode("found").alias("x"))
    each = each.withColumn("x", F.col("x").withField("covered", _extended(F.col("x"), F.col("words"))))
    each = each.filter(F.size("x.covered") >= F.least(F.lit(LEAST), F.size("x.item")))
    each = each.withColumn("slots", slots(F.col("x"))).withColumn("pairs", F.array_distinct("slots"))
    given = F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p["given"])))
    consistent = (F.size(given) == F.size("pairs")) | (
        _literal_run(F.col("x"), F.col("words")) >= F.least(F.lit(LEAST), F.size("x.item"))
    )
    return each.filter(consistent).select(
        *KEY,
        "doc_id",
        F.col("x.item_id").alias("item_id"),
        F.col("x.shift").alias("start_word"),
        F.size("x.covered").alias("n_words"),
        (F.size("x.covered") / F.size("x.item")).alias("coverage"),
        F.size("slots").alias("n_slots"),
        F.size(F.filter("slots", lambda p: p["given"] != p["here"])).alias("n_changed"),
    )


def _extended(x: Column, words: Column) -> Column:
    """The places in line with a match, with those before and after it that match without a gap."""

    def same(p: Column) -> Column:
        at = x["shift"] + p
        here, kind = F.get(words, at), F.get(x["kinds"], p)
        slot = (kind > 0) & (kind == kind_of(here, F.get(words, at - 1)))
        return F.coalesce((F.lower(here) == F.lower(F.get(x["item"], p))) | slot, F.lit(False))

    def run(places: Column) -> Column:
        """How many of the places match from the first on."""
        end = F.array_position(F.transform(places, same), False)
        return F.when(end > 0, end - 1).otherwise(F.size(places)).cast("int")

    first, last, n = F.array_min(x["covered"]), F.array_max(x["covered"]), F.size(x["item"])
    none = F.array().cast("array<int>")
    before = F.when(first > 0, F.sequence(first - 1, F.lit(0), F.lit(-1))).otherwise(none)
    after = F.when(last < n - 1, F.sequence(last + 1, n - 1)).otherwise(none)
    return F.concat(
        F.reverse(F.slice(before, 1, run(before))), x["covered"], F.slice(after, 1, run(after))
    )


def _literal_run(x: Column, words: Column) -> Column:
    """The most words in a row, from the first place of a match to its last, that equal the item's."""
    places = F.sequence(F.array_min(x["covered"]), F.array_max(x["covered"]))
    equal = F.transform(
        places,
        lambda p: F.when(F.lower(F.get(words, x["shift"] + p)) == F.lower(F.get(x["item"], p)), "1").otherwise("0"),
    )
    return F.array_max(F.transform(F.split(F.array_join(equal, ""), "0"), F.length))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that ``find_leaks`` finds; all columns stay."""
    leaks = save_table(find_leaks(docs, items, id_col, text_col).select(*KEY).distinct(), "leaks")
    names = [f"{k}_" for k in KEY]
    leaks = broadcast_if_small(leaks.toDF(*names))
    a, b = row_key(docs[id_col], docs[text_col])
    return docs.join(leaks, (a == leaks[names[0]]) & (b == leaks[names[1]]), "left_anti")
