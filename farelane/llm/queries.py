"""The registered queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.op01_licenses import scan_licenses
from farelane.llm.op02_secrets import scan_secrets
from farelane.llm.op03_token_counts import count_tokens
from farelane.llm.op04_packing import pack
from farelane.llm.keys import KEY
from farelane.llm.op05_decontamination import find_leaks
from farelane.llm.op06_toxicity import score_toxicity
from farelane.llm.op07_jaccard_join import join_components
from farelane.llm.op08_neighbours import find_nearest
from farelane.llm.op09_suffix_dedup import repeat_digests
from farelane.llm.op10_token_files import token_files
from farelane.llm.op11_warc import warc_round_trip
from farelane.llm.op12_spelling import counted, letter_runs, spelling_variants
from farelane.llm.op13_runs import find_runs, run_digests
from farelane.llm.ship import ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The tokenizer file of the token queries.
TOKENIZER = "word_bpe_49k.json"


def query(fn: Query) -> Query:
    """Register ``fn`` under its name, with the library sent to the executors first."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ship(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("found")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 2048)


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(*KEY)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(table(spark, sf_dir, "documents"))


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = letter_runs(table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "word"))
    at = (h % F.length("word")).cast("int")
    less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    words = runs.select(F.when(h % 199 == 0, less).otherwise(F.col("word")).alias("word"))
    return spelling_variants(counted(words))


def _repeating(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of a tenth of the ids changed: from a word on they repeat a few words."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.expr("crc32(string(doc_id)) div 10").alias("g"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = F.expr("int(1 + (size(words) - g % size(words)) div (3 + g % 8))")
    changed = F.when(
        n > 0,
        F.concat(
            F.slice("words", F.lit(1), a),
            F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a),
        ),
    )
    return chosen.select("doc_id", F.coalesce(F.array_join(changed, " "), "text").alias("text"))


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(find_runs(_repeating(table(spark, sf_dir, "documents"))))
