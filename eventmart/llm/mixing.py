"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks. With w the exact share of a source, its block j is released at slot floor(j / w)
and due by slot ceil((j + 1) / w); of the released blocks the one with the earliest deadline comes next. Every
prefix of the schedule then holds each source's share to within less than one block, however long it is: shares
are rationals, nothing is rounded and nothing repeats. Only (source, block) places are scheduled on the driver;
the size of a block follows the corpus, so that there are about MAX_BLOCKS of them beside one for each source.
The stream ends when every source has been passed over whole; sources that run out before begin again.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.common import read_table, stored

#: Slots that a schedule is meant to have at most, whatever the number of rows.
MAX_BLOCKS = 100_000
#: Slots beyond which a schedule, which the driver holds, is refused: weights under some 1 / MOST_SLOTS or as many sources ask for more.
MOST_SLOTS = 2 * MAX_BLOCKS
#: Least rows of a block, and rows that are numbered together.
BLOCK_ROWS, BUCKET_ROWS = 8, 1_000
#: Target weight of a source of n blocks: n ** EXPONENT, before weights are made to sum to 1.
EXPONENT = 0.85
#: Columns that `schedule` adds.
COLUMNS = ["mix_source", "mix_epoch", "mix_block", "mix_release", "mix_deadline", "mix_slot"]


def shares(weights: dict[str, float | Fraction]) -> dict[str, Fraction]:
    """Exact shares of the weights, which are positive; a float stands for the rational that it is."""
    if bad := [s for s, w in weights.items() if not 0 < w < float("inf")]:
        raise ValueError(f"weights must be positive and finite: {sorted(bad)[:5]}")
    exact = {s: Fraction(w) for s, w in weights.items()}
    total = sum(exact.values())
    return {s: w / total for s, w in exact.items()}


def windows(share: Fraction, j: int) -> tuple[int, int]:
    """Release and deadline of block j."""
    return j * share.denominator // share.numerator, -(-(j + 1) * share.denominator // share.numerator)


def earliest_deadline_first(share: dict[str, Fraction], blocks: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) until `blocks` of every source have been passed; ties go to the first name."""
    waiting = [(0, s, 0) for s in share]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []  # deadline, source, block, release
    left, out = sum(n > 0 for n in blocks.values()), []
    for slot in range(1 << 62):
        if not left:
            return out
        while waiting and waiting[0][0] <= slot:
            release, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (windows(share[s], j)[1], s, j, release))
        deadline, s, j, release = heapq.heappop(ready)
        out.append((s, j, release, deadline, slot))
        heapq.heappush(waiting, (windows(share[s], j + 1)[0], s, j + 1))
        left -= j + 1 == blocks[s]


def plan(rows: dict[str, int], weights: dict[str, float] | None = None, block_rows: int | None = None, exponent: float = EXPONENT) -> tuple[list[tuple], dict[str, int], int]:
    """The schedule of sources of these sizes, blocks of each, and rows of a block (by default as many as MAX_BLOCKS asks for)."""
    if weights is not None and (missing := set(rows) - set(weights)):
        raise ValueError(f"no target weight for {sorted(missing)[:5]}")

    def sized(size: int) -> tuple[dict[str, Fraction], dict[str, int]]:
        blocks = {s: -(-n // size) for s, n in rows.items()}
        return shares({s: weights[s] for s in rows} if weights is not None else {s: n**exponent for s, n in blocks.items()}), blocks

    size = block_rows or BLOCK_ROWS
    share, blocks = sized(size)
    slots = max((blocks[s] / share[s] for s in rows), default=0)
    if block_rows is None and slots > MAX_BLOCKS:
        size = ceil(size * slots / MAX_BLOCKS)
        share, blocks = sized(size)
        slots = max(blocks[s] / share[s] for s in rows)
    if slots > MOST_SLOTS:
        small = sorted(share, key=lambda s: share[s] / blocks[s])[:5]
        raise ValueError(f"a schedule of {ceil(slots)} blocks is beyond {MOST_SLOTS}: the sources {small} have too small weights, or there are too many")
    return earliest_deadline_first(share, blocks), blocks, size


def numbered(rows: DataFrame) -> DataFrame:
    """rows (mix_source, mix_key, ...; stored) with mix_row: 0, 1, ... within the source, in the order of a hash of the key and the row's place.

    Rows are numbered within buckets of a source; the buckets' counts give the offsets. A source, or a key, of any
    number of rows is so spread over many tasks.
    """
    spread = max(1, rows.count() // BUCKET_ROWS)
    rows = rows.withColumn("mix_hash", F.xxhash64("mix_key", F.monotonically_increasing_id()))
    rows = rows.withColumn("mix_bucket", F.pmod("mix_hash", F.lit(spread)))
    counts = rows.groupBy("mix_source", "mix_bucket").count()
    before = F.sum("count").over(Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("mix_source", "mix_bucket", F.coalesce(before, F.lit(0)).alias("mix_offset"))
    inner = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_hash")
    placed = rows.withColumn("mix_row", F.row_number().over(inner) - 1).join(offsets, ["mix_source", "mix_bucket"])
    return placed.withColumn("mix_row", F.col("mix_row") + F.col("mix_offset")).drop("mix_bucket", "mix_offset", "mix_hash")


def placed_rows(docs: DataFrame, key: str, source: str, weights: dict[str, float] | None = None, block_rows: int | None = None, exponent: float = EXPONENT, in_files: bool = False) -> DataFrame:
    """row (a struct of the columns of docs), mix_key and COLUMNS; a row for each time that a row of docs is passed over."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).alias("mix_key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("mix_source"))
    # places of rows are asked for more than once, so rows that are not in files already are stored
    rows = rows if in_files else stored(rows, "mixed", compression="zstd")
    # one row for each source: the driver holds their weights anyway, and no schedule has more sources than MOST_SLOTS
    sizes = {r[0]: r[1] for r in rows.groupBy("mix_source").count().limit(MOST_SLOTS + 1).collect()}
    places, blocks, size = plan(sizes, weights, block_rows, exponent)
    passes: dict[str, int] = dict.fromkeys(blocks, 0)
    for s, j, *_ in places:
        passes[s] = max(passes[s], j // blocks[s] + 1)
    slots = spark.createDataFrame(places, "mix_source string, mix_block long, mix_release long, mix_deadline long, mix_slot long")
    per_source = spark.createDataFrame([(s, blocks[s], passes[s]) for s in blocks], "mix_source string, mix_blocks long, mix_passes long")
    # per_source has one row for each source, slots about MAX_BLOCKS more
    passed = numbered(rows).join(F.broadcast(per_source), "mix_source").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_passes") - 1)))
    passed = passed.withColumn("mix_block", F.expr(f"mix_row div {size} + mix_epoch * mix_blocks"))
    return passed.join(F.broadcast(slots), ["mix_source", "mix_block"]).select("row", "mix_key", *COLUMNS)


def schedule(docs: DataFrame, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """docs with mix_source, mix_epoch, mix_block, mix_release, mix_deadline and mix_slot, a row for each time it is passed over.

    options: weights (target of each source, by default from its blocks; a source without one is refused),
    block_rows, exponent, in_files (docs are read from files as they are, so they are not stored for their numbers). Weights
    that ask for more than MOST_SLOTS blocks are refused. A null source is the source ''. Every row appears at least once; of repeated rows, and of
    rows with one key or none, each appears as often as its place says. Where docs has a column of one of these
    names, the added one has an underscore more. An empty table gives an empty result.
    """
    taken, names = set(docs.columns), {}
    for c in COLUMNS:
        names[c] = c
        while names[c] in taken:
            names[c] += "_"
    return placed_rows(docs, key, source, **options).select("row.*", *[F.col(c).alias(n) for c, n in names.items()])


def mixed_stream(docs: DataFrame, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The columns of docs, repeated as the schedule says and laid out in its order. Cases as in schedule."""
    return placed_rows(docs, key, source, **options).repartitionByRange("mix_slot", "mix_key").sortWithinPartitions("mix_slot", "mix_key").select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(read_table(spark, sf_dir, "documents").select("doc_id", "source"), in_files=True)
