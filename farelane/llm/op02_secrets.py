"""Secret scan with ownership: who holds a candidate tells a copied example from a live credential."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.texts import slices
from farelane.llm.keys import join_frequent
from farelane.session import save_table

# The base kinds in their order, with the least length of a secret.
BASE = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# A run that is too short may be skipped at once: what starts inside of it is shorter still.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Kinds that are added to the base only if their ownership looks live.
ADDED = ("issued", "jwt", "private_key")
_ISSUED = re.compile(
    r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35})"
)
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")
_KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]{32,}")
KINDS = (*BASE, *ADDED)

#: Owners from which on a secret counts as a copied example.
COPIED_OWNERS = 3
#: Repositories from which on a candidate is a copied example, whoever owns them.
COPIED_REPOS = 25

SPANS = "array<struct<start:long,kind:int,end:long,secret:string>>"


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, number of the kind, end, hash of the secret) of every candidate, in order."""
    found = []
    for m in _ASSIGN.finditer(text):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end(), m[1]))
    for kind, pattern, needs in (
        (1, _ACCESS, "AKIA"),
        (2, _HEX, ""),
        (3, _ISSUED, ""),
        (4, _JWT, "eyJ"),
        (5, _KEY, "PRIVATE KEY"),
    ):
        if needs in text:
            found += [(m.start(), kind, m.end(), m[0]) for m in pattern.finditer(text)]
    return sorted((a, k, b, hashlib.sha256(s.encode()).hexdigest()) for a, k, b, s in found)


def find_candidates(docs: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with the candidates of each text in the column ``name``; all columns stay."""
    kind = pa.list_(
        pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("secret", pa.string())])
    )

    def scan(batches):
        for batch in slices(batches, "text_"):
            found = [
                [dict(zip(("start", "kind", "end", "secret"), x)) for x in candidates(t)]
                for t in batch.column("text_").to_pylist()
            ]
            at = batch.schema.get_field_index("text_")
            yield batch.remove_column(at).append_column(name, pa.array(found, kind))

    if name in docs.columns or "text_" in docs.columns:
        raise ValueError(f"the columns {name} and text_ must be free")
    given = docs.withColumn("text_", F.col(text_col))
    schema = docs.schema.simpleString()[len("struct<") : -1]
    return given.mapInArrow(scan, f"{schema},{name}:{SPANS}" if schema else f"{name}:{SPANS}")


def ownership(found: DataFrame, repo: Column, owner: Column) -> DataFrame:
    """``secret`` with ``n_spans``, ``n_repos`` and ``n_owners`` over the whole corpus.

    Three sums, each combined before it is shuffled: by repository, by owner and by secret. A secret
    that a third of all rows hold is one row for each task, repository and owner.
    """
    spans = found.filter(F.size("spans") > 0).select(
        owner.alias("owner"), repo.alias("repo"), F.explode("spans.secret").alias("secret")
    )
    by_repo = spans.groupBy("secret", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("secret", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
    return by_owner.groupBy("secret").agg(
        F.sum("n").alias("n_spans"),
        F.sum("repos").alias("n_repos"),
        F.count(F.lit(1)).alias("n_owners"),
    )


def judged(found: DataFrame, repo: Column, owner: Column, copied: int, copied_repos: int) -> DataFrame:
    """``row`` and its spans, each with ``live``: held by fewer than ``copied`` owners and in fewer than
    ``copied_repos`` repositories. A secret that many spans hold is not brought together for that."""
    owners = save_table(ownership(found, repo, owner), "owners")
    spans = found.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("span"))
    known = join_frequent(spans.select("row", "span.*"), owners, "secret", "n_spans")
    live = (F.col("n_owners") < copied) & (F.col("n_repos") < copied_repos)
    return known.groupBy("row").agg(
        F.array_sort(
            F.collect_list(F.struct("start", "kind", "end", "secret", live.alias("live"), "n_owners", "n_repos"))
        ).alias("judged")
    )


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str | None = None,
    copied: int = COPIED_OWNERS,
    copied_repos: int = COPIED_REPOS,
) -> DataFrame:
    """One row for each of ``docs``: counts of the base kinds, all spans, and how many look live.

    A candidate's hash is counted over the corpus by distinct repositories (``repo_col``, by default
    each document is one) and owners. One that fewer than ``copied`` owners hold, in fewer than
    ``copied_repos`` repositories, looks live; the others are copied examples. Base spans are always
    reported; spans of the added kinds only where they look live. ``spans`` is ``kind:start:end`` by
    start, then kind, in code points, end exclusive; ``found`` has them as structs with ``live``,
    ``n_owners`` and ``n_repos``.

    Null and empty texts have no spans. Null owners and repositories are one value of their own.
    Repeated rows and null ids are rows of their own; an empty table gives no row. Other columns are
    not read. The candidates are written to the shared folder once, with a number for each row.
    """
    row = docs.select(
        docs[id_col].alias("doc_id"),
        docs[owner_col].alias("owner"),
        docs[repo_col or id_col].alias("repo"),
        docs[text_col].alias("text"),
    )
    found = find_candidates(row).drop("text").withColumn("row", F.monotonically_increasing_id())
    found = save_table(found, "secrets")
    verdicts = judged(found, F.col("repo"), F.col("owner"), copied, copied_repos)
    # Rows without candidates, nearly all, need no join.
    none = F.array().cast("array<struct<start:long,kind:int,end:long,secret:string,live:boolean,n_owners:long,n_repos:long>>")
    held = found.filter(F.size("spans") > 0).select("doc_id", "row").join(verdicts, "row").drop("row")
    free = found.filter(F.size("spans") == 0).select("doc_id", none.alias("judged"))
    base = F.filter("judged", lambda x: x["kind"] < len(BASE))
    told = F.filter("judged", lambda x: (x["kind"] < len(BASE)) | x["live"])

    def count(test) -> Column:
        return F.size(F.filter("judged", test)).cast("long")

    def of_kind(i: int) -> Column:
        return count(lambda x: x["kind"] == i)

    return held.unionByName(free).select(
        "doc_id",
        *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(_text(base), 256).alias("base_sha256"),
        _text(told).alias("spans"),
        count(lambda x: x["live"]).alias("n_live"),
        count(lambda x: ~x["live"]).alias("n_copied"),
        told.alias("found"),
    )


def redact(
    docs: DataFrame,
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str | None = "doc_id",
    copied: int = COPIED_OWNERS,
    copied_repos: int = COPIED_REPOS,
    mask: str = "[SECRET]",
) -> DataFrame:
    """``docs`` with every live-looking secret's span replaced by ``mask``; all rows and columns stay.

    Copied examples stay as they are. Overlapping spans are one. Null texts stay null. Columns may have
    any names: they travel together, apart from what is added inside.
    """
    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    of_doc = lambda name: F.col("doc").getField(name)
    found = find_candidates(given.withColumn("text", of_doc(text_col)), "text", "spans").drop("text")
    found = save_table(found.withColumn("row", F.monotonically_increasing_id()), "secrets")
    verdicts = judged(found, of_doc(repo_col), of_doc(owner_col), copied, copied_repos)
    live = verdicts.select("row", F.filter("judged", lambda x: x["live"]).alias("live"))
    held = found.filter(F.size("spans") > 0).join(live, "row")
    # Text between the spans: each piece goes from the furthest end so far to the next start.
    text = of_doc(text_col)
    step = F.aggregate(
        "live",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, x: F.struct(
            F.when(x["start"] < a["at"], a["out"])
            .otherwise(
                F.concat(
                    a["out"],
                    F.substring(text, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")),
                    F.lit(mask),
                )
            )
            .alias("out"),
            F.greatest(a["at"], x["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))),
    )
    masked = F.when(text.isNotNull(), step)
    changed = F.struct(*[(masked if c == text_col else of_doc(c)).alias(c) for c in docs.columns])
    free = found.filter(F.size("spans") == 0).select("doc")
    return held.select(changed.alias("doc")).unionByName(free).select("doc.*")
