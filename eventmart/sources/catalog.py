"""Product and customer catalogs from several files: aliases, usable rows only, the first source wins."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eventmart.functions.columns import blank_to_null

# Aliases of catalog fields, and the keys under which an export may wrap its rows.
PRODUCT = {"product_id": ["product_id", "sku", "id"], "sku": ["sku", "product_id"], "name": ["name", "title", "product_name"], "category": ["category", "product_category"], "brand": ["brand"], "price": ["price", "product_price", "unit_price"]}
CUSTOMER = {"customer_id": ["customer_id", "id"], "segment": ["segment", "customer_segment"], "country": ["country"], "city": ["city"]}
WRAPPERS = ["products", "items", "data", "results", "records", "customers"]


def unwrap_json(df: DataFrame) -> DataFrame:
    """Rows of a JSON export that may hold them in an array under a wrapper key."""
    arrays = [F.col(c) for c, kind in df.dtypes if c in WRAPPERS and kind.startswith("array<struct")]
    return df.select(F.explode(F.coalesce(*arrays)).alias("r")).select("r.*") if arrays else df


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog file by its suffix: CSV, NDJSON, or JSON (array, object or wrapped)."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    if path.endswith((".ndjson", ".jsonl")):
        return spark.read.json(path)
    return unwrap_json(spark.read.option("multiLine", True).json(path))


def _text(df: DataFrame, name: str) -> Column:
    """A field as text; of an object (a nested category or brand) its name, else its slug."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StructType):
        return F.coalesce(*[blank_to_null(F.col(f"{name}.{part}").cast("string")) for part in ("name", "slug") if part in kind.names], F.lit(None).cast("string"))
    return blank_to_null(F.col(name).cast("string"))


def _fields(df: DataFrame, aliases: dict[str, list[str]]) -> dict[str, Column]:
    return {f: F.coalesce(*[_text(df, c) for c in names if c in df.columns], F.lit(None).cast("string")).alias(f) for f, names in aliases.items()}


def products(df: DataFrame) -> DataFrame:
    """Products with id, name and a price of 0 or more; comma decimals are read."""
    rows = df.select(*_fields(df, PRODUCT).values()).withColumn("sku", F.coalesce("sku", "product_id"))
    return rows.withColumn("price", F.replace("price", F.lit(","), F.lit(".")).try_cast("double")).filter("product_id IS NOT NULL AND name IS NOT NULL AND price >= 0")


def customers(df: DataFrame) -> DataFrame:
    rows = df.select(*_fields(df, CUSTOMER).values())
    return rows.withColumn("segment", F.coalesce("segment", F.lit("unknown"))).filter("customer_id IS NOT NULL")


def first_wins(sources: list[DataFrame], key: str) -> DataFrame:
    """Union of the sources, of each key the row of the earliest source (ties: by the row's hash)."""
    ranked = None
    for rank, df in enumerate(sources):
        one = df.withColumn("_rank", F.lit(rank))
        ranked = one if ranked is None else ranked.unionByName(one, allowMissingColumns=True)
    order = Window.partitionBy(key).orderBy("_rank", F.xxhash64(*[c for c in ranked.columns if not c.startswith("_")]))
    return ranked.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_rank")


SHAPES = {"products": (products, "product_id"), "customers": (customers, "customer_id")}


def resolved(sources: dict[str, DataFrame], kind: str = "products") -> DataFrame:
    """The catalog of sources as they were read, the earliest first, with the name of each row's source in `_source`."""
    shape, key = SHAPES[kind]
    return first_wins([shape(raw).withColumn("_source", F.lit(name)) for name, raw in sources.items()], key)


def source_counts(sources: dict[str, DataFrame], kind: str = "products") -> DataFrame:
    """One row for each source that has rows: source, rows read, usable, taken (in the catalog from here), dropped (not usable), repeated
    (usable, but known from an earlier row). All sources are counted in one pass over them."""
    shape, _ = SHAPES[kind]
    seen = [df.select(F.lit(name).alias("source"), F.lit(what).alias("what")) for name, raw in sources.items() for what, df in (("rows", raw), ("usable", shape(raw)))]
    seen.append(resolved(sources, kind).select("_source", F.lit("taken").alias("what")))
    counts = reduce(DataFrame.union, seen).groupBy("source").agg(*[F.count_if(F.col("what") == w).alias(w) for w in ("rows", "usable", "taken")])
    return counts.withColumns({"dropped": F.col("rows") - F.col("usable"), "repeated": F.col("usable") - F.col("taken")})


def load(spark: SparkSession, paths: list[str], kind: str = "products") -> tuple[DataFrame | None, dict[str, str]]:
    """(catalog, outcome of each path); a source that cannot be read is skipped."""
    got, outcome = load_counted(spark, paths, kind, count=False)
    return got, {path: o["status"] for path, o in outcome.items()}


def load_counted(spark: SparkSession, paths: list[str], kind: str = "products", count: bool = True, given: dict[str, DataFrame] | None = None) -> tuple[DataFrame | None, dict[str, dict]]:
    """(catalog, outcome of each path: status, rows read, usable and taken); a source that cannot be read is skipped.

    taken: rows that the catalog has from this source, the others being unusable or known from an earlier one. given: sources by
    name that are tables already; they come before the paths, as rows in a configuration do.
    """
    sources, outcome = {}, {}
    for name in [*(given or {}), *paths]:
        try:
            raw = given[name] if given and name in given else read_catalog(spark, name)
            SHAPES[kind][0](raw)
        except AnalysisException as e:
            logging.getLogger(__name__).warning("catalog source %s: %s", name, e)
            outcome[name] = {"status": "skipped", "rows": 0, "usable": 0, "taken": 0}
            continue
        sources[name] = raw
        outcome[name] = {"status": "read", "rows": 0, "usable": 0, "taken": 0}
    if not sources:
        return None, outcome
    if count:
        for r in source_counts(sources, kind).collect():  # a row for each source
            outcome[r.source] |= {"rows": r.rows, "usable": r.usable, "taken": r.taken}
    return resolved(sources, kind).drop("_source"), outcome


def statistics(outcome: dict[str, dict]) -> dict:
    """Totals of the outcomes of `load_counted`: sources_used, rows_read, rows_dropped, duplicates_removed, resolved."""
    total = {what: sum(o[what] for o in outcome.values()) for what in ("rows", "usable", "taken")}
    used = [name for name, o in outcome.items() if o["status"] == "read"]
    return {"sources_used": used, "rows_read": total["rows"], "rows_dropped": total["rows"] - total["usable"], "duplicates_removed": total["usable"] - total["taken"], "resolved": total["taken"]}
