"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

Each text is cut at content-defined places; a chunk becomes a 64-bit identifier, and the identifiers
are verified: over the whole corpus no two chunks of one identifier may differ in their SHA-256. Texts
are then compared by their ordered identifier lists (recipes), so that a text is read once and never
shuffled, however long it is. Should two chunks ever share an identifier, the digests themselves
become the identifiers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import lowered, read_table, stored, with_totals

#: A chunk ends after the first line end or sentence end beyond `least` characters, or at `most`.
CHUNK = r"(?s).{{{least},{most}}}?(?:\n|[.!?] )|.{{1,{most}}}"


def chunk_recipes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 512, most: int = 8192) -> DataFrame:
    """row_id, key, text_sha256, recipe (64-bit chunk identifiers) and digests (SHA-256), stored once."""
    cut = F.lit(CHUNK.format(least=least, most=most))
    chunked = docs.select(F.col(key).alias("key"), lowered(F.col(text)).alias("norm")).withColumn("chunks", F.regexp_extract_all("norm", cut, F.lit(0)))
    return stored(
        chunked.select(
            F.monotonically_increasing_id().alias("row_id"),
            "key",
            F.sha2("norm", 256).alias("text_sha256"),
            F.transform("chunks", lambda c: F.xxhash64(c)).alias("recipe"),
            F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("digests"),
        ),
        "recipes",
    )


def verified(recipes: DataFrame) -> bool:
    """Whether each chunk identifier stands for one digest over the whole corpus."""
    chunk = recipes.select(F.explode(F.arrays_zip("recipe", "digests")).alias("c")).select("c.recipe", "c.digests")
    shared = chunk.groupBy("recipe", "digests").count().groupBy("recipe").count().filter("count > 1")
    return shared.isEmpty()


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts are equal to each other. Of equal texts the row with the
    largest key stays (a null key is the smallest); of rows that repeat that key one stays. An empty
    table gives an empty result; other columns are not read.
    """
    recipes = chunk_recipes(docs, key, text)
    column = "recipe" if verified(recipes) else "digests"
    rows = recipes.select("row_id", "key", "text_sha256", F.col(column).alias("recipe"))
    totals = {"top": (F.max(F.struct("key", "row_id")), F.max), "group_size": (F.count("*"), F.sum)}
    return with_totals(rows, ["recipe"], ["row_id"], totals).select(
        F.col("key").alias(key),
        F.col("top.key").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("top.row_id")).alias("kept"),
        "text_sha256",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)
"""
