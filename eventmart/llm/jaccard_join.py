"""Size-aware heavy-light similarity join on the Jaccard index of word n-gram sets.

Equal sets are one class and are joined once. A counting pass, packed by hash bucket, keeps only the
n-grams that more than one set has, with the number of those sets. Small sets (light) are joined by
enumerating the fixed-size subsets that a linked pair must share. Large sets (heavy) are joined by scanning
inverted lists of the rarest n-grams, so many that linked sets must meet in one list. The size boundary
comes from the measured cost of both. In a list each set is compared with one pivot; sets that then
lie in different components are compared too, unless the pivot distances rule a link out (the Jaccard
distance obeys the triangle inequality). Every pair that could join two components is thus decided, and a
group of copies costs one comparison for each copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import PIECE_BYTES, bytes_of, discard, hand_back, pieces, read_table, stored
from eventmart.llm.components import components, joined
from eventmart.llm.words import SPACED, Words, grams, mixed

#: Words of an n-gram; a link needs 100 * intersection >= 75 * union.
NGRAM, PERCENT = 5, 75
#: n-grams of one bucket of the counting pass, on average, and the least number of buckets.
BUCKET_GRAMS, LEAST_BUCKETS = 1_500_000, 64
#: Cells of the frequent n-gram table, and times the mean from which a cell bypasses the buckets; a cell of more than
#: BUCKET_GRAMS / FREQUENT n-grams always does, so that no bucket outgrows a task, whatever the size of the corpus.
CELL_BITS, FREQUENT = 16, 6
#: Sets that a task remembers as already sent.
SENT_SETS = 100_000
#: Sets that a task holds as Python objects at once.
SLICE_ROWS = 128
#: Largest set for which subsets may be enumerated.
LARGEST_LIGHT = 14


class Sets:
    """Distinct n-gram hashes of each text. bounds: of each row in `grams`; a, b: 128-bit signature of each row's set."""

    def __init__(self, column: pa.Array, ngram: int):
        w = Words(column, SPACED)
        words = np.diff(w.rows)
        g, row = grams(w.hash, ngram), w.row[: max(0, len(w) - ngram + 1)]
        inner = row == w.row[ngram - 1 :] if len(g) else np.zeros(0, bool)
        g, row = g[inner], row[inner]
        short = np.flatnonzero((words > 0) & (words < ngram))
        total = np.zeros(len(short), np.uint64)
        for k in range(ngram - 1):
            on = words[short] > k
            total[on] = mixed(total[on] + w.hash[w.rows[short[on]] + k])
        g, row = np.concatenate([g, mixed(total + words[short].astype(np.uint64))]), np.concatenate([row, short])
        order = np.lexsort((g, row))
        g, row = g[order], row[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
        self.grams, self.row = g[new], row[new]
        self.bounds = np.searchsorted(self.row, np.arange(len(words) + 1))
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.grams ^ np.uint64(seed)))]) for seed in (0x243F6A8885A308D3, 0x13198A2E03707344)]
        self.a, self.b = (mixed(s[self.bounds[1:]] - s[self.bounds[:-1]]) for s in sums)


def least_overlap(n: int, m: int, percent: int) -> int:
    """Smallest intersection of linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def set_table(docs: DataFrame, ngram: int) -> DataFrame:
    """row_id, key, n (n-grams) and a, b (signature of the set) of each row, with one row of cell counts for each task. Stored once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        names = ["key", "n", "a", "b", "cells"]
        kind = None
        for batch in pieces(batches):
            kind = batch.column("key").type
            s = Sets(batch.column("text"), ngram)
            cells += np.bincount((s.grams >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(s.bounds)), pa.array(s.a.view(np.int64)), pa.array(s.b.view(np.int64)), pa.nulls(batch.num_rows, pa.list_(pa.int64()))], names)
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.array([-1], pa.int64()), *[pa.nulls(1, pa.int64())] * 2, pa.array([cells], pa.list_(pa.int64()))], names)

    kind = docs.schema["key"].dataType.simpleString()
    return stored(docs.mapInArrow(scan, f"key {kind}, n long, a long, b long, cells array<long>").select(F.monotonically_increasing_id().alias("row_id"), "*"), "sets")


def shared_grams(docs: DataFrame, ngram: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """a, b, token and count arrays of the n-grams of each set that other sets may have too, one row for each set and bucket.

    A token is 48 bits of the hash and its bucket. n-grams of frequent cells get the cell's count and need no
    bucket, so no bucket holds the sets of a very common n-gram.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in pieces(batches, limit=2 * PIECE_BYTES):  # fewer packs
            for begin in range(0, batch.num_rows, 60_000):
                s = Sets(batch.column("text").slice(begin, 60_000), ngram)
                signature = list(zip(s.a.tolist(), s.b.tolist(), strict=True))
                own = np.zeros(len(signature), bool)  # the first of each set in this task
                for i, x in enumerate(signature):
                    own[i] = x not in seen
                    seen.add(x)
                if len(seen) > SENT_SETS:  # what is sent twice is counted once in its bucket
                    seen.clear()
                use = own[s.row]
                g, row = s.grams[use], s.row[use]
                bucket = (g % np.uint64(buckets)).astype(np.int64)
                count = frequent[(g >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                bucket[count > 0] = buckets
                order = np.argsort(bucket, kind="stable")
                g, row, bucket, count = g[order], row[order].astype(np.uint16), bucket[order], count[order]
                cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(g) else np.zeros(0, np.int64)
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(g)], strict=False):
                    rows, index = np.unique(row[a:b], return_inverse=True)
                    keys = np.stack([s.a[rows], s.b[rows]], 1)
                    h = g[a:b] >> np.uint64(16)
                    packed = [keys.tobytes(), index.astype(np.uint16).tobytes(), (h & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(), (h >> np.uint64(32)).astype(np.uint16).tobytes()]
                    number = int(bucket[a])
                    counts = count[a:b].astype(np.int64).tobytes() if number == buckets else b""
                    low = (g[a:b] % np.uint64(buckets) & np.uint64(0xFFFF)).astype(np.uint16).tobytes() if number == buckets else b""
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.array([x], pa.binary()) for x in (*packed, low, counts))], ["bucket", "keys", "idx", "h32", "h16", "low", "counts"])

    def rows_of(keys: np.ndarray, owner: np.ndarray, token: np.ndarray, count: np.ndarray) -> pa.Table:
        order = np.argsort(owner, kind="stable")
        owner, token, count = owner[order], token[order], count[order]
        which, first = np.unique(owner, return_index=True)
        cut = pa.array(np.append(first, len(owner)).astype(np.int32))
        return pa.table({"a": keys[which, 0].view(np.int64), "b": keys[which, 1].view(np.int64), "token": pa.ListArray.from_arrays(cut, pa.array(token.view(np.int64))), "count": pa.ListArray.from_arrays(cut, pa.array(count))})

    def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, and for each n-gram the number of its key and its 48 bits."""
        (keys, ends), (index, cuts), (low, _), (high, _) = (bytes_of(table[c].combine_chunks()) for c in ("keys", "idx", "h32", "h16"))
        distinct, number = np.unique(keys.view("V16"), return_inverse=True)
        place = np.repeat((ends[:-1] // 16).astype(np.int32), np.diff(cuts) // 2)  # of the first key of each pack
        place += index.view(np.uint16)
        h = high.view(np.uint16).astype(np.uint64)
        h <<= np.uint64(32)
        h |= low.view(np.uint32)
        return distinct.view(np.uint64).reshape(-1, 2), number.astype(np.int32)[place], h

    def count_bucket(key: tuple, table: pa.Table) -> pa.Table:
        keys, owner, h = unpack(table)
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        del order
        same = h[1:] == h[:-1]
        several = np.append(same, False) | np.append(False, same)
        h, owner = h[several], owner[several]
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        del order
        new = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[: len(h)]
        h, owner = h[new], owner[new]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])[: len(h)])
        count = np.diff(np.append(first, len(h)))
        count = np.repeat(count, count)
        on = count > 1
        out = rows_of(keys, owner[on], h[on] << np.uint64(16) | np.uint64(key[0].as_py() & 0xFFFF), count[on].astype(np.int64))
        hand_back()
        return out

    def frequent_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, owner, h = unpack(pa.Table.from_batches([batch]))
                low = np.frombuffer(b"".join(batch.column("low").to_pylist()), np.uint16).astype(np.uint64)
                yield from rows_of(keys, owner, h << np.uint64(16) | low, np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int64)).to_batches()

    packs = docs.select("text").mapInArrow(pack, "bucket int, keys binary, idx binary, h32 binary, h16 binary, low binary, counts binary")
    schema = "a long, b long, token array<long>, count array<long>"
    light = packs.filter(F.col("bucket") < buckets).groupBy("bucket").applyInArrow(count_bucket, schema)
    return light.union(packs.filter(F.col("bucket") == buckets).mapInArrow(frequent_rows, schema)) if frequent.any() else light


def candidate_sets(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """sid, a, b, n, tokens (shared n-grams, sorted) and prefix (those among the first in order of count) of each set
    that may be linked. Stored once."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            out = []
            for a, b, n, parts in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "n", "parts")), strict=True):
                pairs = sorted({(c, t) for p in parts for t, c in zip(p["token"], p["count"], strict=True)})
                first = n - -(-percent * n // 100) + 1 - (n - len(pairs))  # the others come before, as nobody shares them
                if first > 0:
                    out.append((a, b, n, sorted(t for _, t in pairs), [t for _, t in pairs[:first]], float(sum(c for c, _ in pairs[:first]))))
            columns = zip(*out, strict=True) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["a", "b", "n", "tokens", "prefix", "cost"])

    parts = shared.groupBy("a", "b").agg(F.collect_list(F.struct("token", "count")).alias("parts"))
    rows = parts.join(classes.select("a", "b", "n"), ["a", "b"]).select("a", "b", "n", "parts")
    rows = rows.mapInArrow(order, "a long, b long, n long, tokens array<long>, prefix array<long>, cost double")
    return stored(rows.select(F.monotonically_increasing_id().alias("sid"), "*"), "candidates", compression="zstd")


def boundary(sets: DataFrame, percent: int) -> int:
    """Largest size up to which enumerating subsets costs no more than scanning lists, from the sets there are."""
    # at most LARGEST_LIGHT rows
    cost = {r["n"]: (r["lists"], r["sizes"]) for r in sets.filter(F.col("n") <= LARGEST_LIGHT).groupBy("n").agg(F.sum("cost").alias("lists"), F.collect_set(F.size("tokens")).alias("sizes")).collect()}
    best, light, heavy = 0, 0.0, 0.0
    for n in sorted(cost):
        light += sum(subsets(max(cost[n][1]), n, LARGEST_LIGHT, percent).values())
        heavy += cost[n][0]
        if light <= max(heavy, 1):
            best = n
    return best


def subsets(have: int, n: int, limit: int, percent: int) -> dict[tuple[int, int, int], int]:
    """(smaller size, larger size, subset size) -> number of subsets, for each partner size up to limit of a set of n with `have` shared."""
    sizes = [m for m in range(-(-percent * n // 100), n * 100 // percent + 1) if 0 < m <= limit]
    return {(min(n, m), max(n, m), c): comb(have, c) for m in sizes if (c := least_overlap(n, m, percent)) <= have}


def signatures(sets: DataFrame, limit: int, percent: int) -> DataFrame:
    """token (list name), sid, n, pos: the rarest n-grams of sets that a heavy set may be linked to, with their place in
    the set's order, and subsets of the light sets (place 0)."""
    lists = sets.filter(F.col("n") * 100 >= percent * (limit + 1)).select("sid", "n", F.size("tokens").alias("shared"), F.posexplode("prefix").alias("pos", "token"))
    lists = lists.select("token", "sid", "n", (F.col("n") - F.col("shared") + F.col("pos")).alias("pos"))

    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, n, tokens in zip(*(batch.column(c).to_pylist() for c in ("sid", "n", "tokens")), strict=True):
                for low, high, size in subsets(len(tokens), n, limit, percent):
                    some = np.array(list(combinations(tokens, size)), np.int64).view(np.uint64)
                    name = mixed(mixed(some).sum(axis=1, dtype=np.uint64) + np.uint64(low << 32 | high << 16 | size))
                    yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array([sid] * len(name), pa.int64()), pa.array([n] * len(name), pa.int64())], ["token", "sid", "n"])

    light = sets.filter(F.col("n") <= limit).select("sid", "n", "tokens").mapInArrow(enumerate_subsets, "token long, sid long, n long")
    return lists.union(light.select("token", "sid", "n", F.lit(0).cast("long").alias("pos")).distinct())


def may_meet(n: str, pos: str, m: str, at: str, percent: int):
    """Whether sets of n and m n-grams can be linked when their first common n-gram stands at these places of their orders."""
    least = F.expr(f"({percent} * ({n} + {m}) + {100 + percent - 1}) div {100 + percent}")
    return (F.col(pos) + least <= F.col(n)) & (F.col(at) + least <= F.col(m))


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b (sid) with the similarity of their sets and whether they are linked. Stored once."""
    one = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("o"))
    union = F.col("na") + F.col("nb") - F.col("o")
    return stored(both.select("a", "b", (F.col("o") / union).alias("similarity"), (100 * F.col("o") >= percent * union).alias("linked")), "compared")


def linked_components(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node (sid) and root of every set that is linked with another one, directly or through others."""
    lists = stored(signatures(sets, boundary(sets, percent), percent), "lists", compression="zstd")
    # the pivot of a list is the set with the fewest rarer n-grams, so the least altered one of a group of copies
    pivots = lists.groupBy("token").agg(F.min(F.struct("pos", "sid", "n")).alias("p"), F.count("*").alias("sets")).filter("sets > 1").select("token", F.col("p.sid").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.pos").alias("at"))
    member = lists.join(pivots, "token")
    first = compared(member.filter((F.col("sid") != F.col("pivot")) & may_meet("n", "pos", "pn", "at", percent)).select(F.least("pivot", "sid").alias("a"), F.greatest("pivot", "sid").alias("b")).distinct(), sets, percent)
    labels = stored(components(first.filter("linked").select("a", "b")), "labels")
    distance = first.select(F.col("a").alias("pivot"), F.col("b").alias("sid"), "similarity").union(first.select("b", "a", "similarity"))
    near = member.join(distance, ["pivot", "sid"], "left").join(labels.withColumnRenamed("node", "sid"), "sid", "left")
    similarity = F.when(F.col("sid") == F.col("pivot"), 1.0).otherwise(F.col("similarity"))
    near = stored(near.select("token", "sid", "n", "pos", similarity.alias("s"), F.coalesce("root", "sid").alias("root")), "members", compression="zstd")
    open_lists = near.groupBy("token").agg((F.min("root") < F.max("root")).alias("open")).filter("open").select("token")
    left = near.join(open_lists, "token", "left_semi")
    x, y = left.toDF("token", "a", "na", "pa", "sa", "ra"), left.toDF("token", "b", "nb", "pb", "sb", "rb")
    far = F.coalesce(F.abs(F.col("sa") - F.col("sb")) > 1 - percent / 100 + 1e-9, F.lit(False))
    may = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & may_meet("na", "pa", "nb", "pb", percent) & ~far
    rest = x.join(y, "token").filter(may).select("a", "b").distinct()
    second = compared(rest.join(first, ["a", "b"], "left_anti"), sets, percent)
    out = joined(labels, second.filter("linked").select("a", "b"))
    discard(sets.sparkSession, lists, near, first, second)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id (the smallest key that links lead to, its own included).

    A text of fewer words than an n-gram has its whole word sequence as its only element; null and empty
    texts, and texts without words, have none and are linked with nothing. Rows of equal texts are linked. A
    null key is never the smallest unless there is no other. An empty table gives an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    table = set_table(rows, ngram)
    found = table.filter("n >= 0").select("row_id", "key", "n", "a", "b")
    classes = stored(found.filter("n > 0").groupBy("a", "b").agg(F.min("n").alias("n"), F.min("key").alias("low")), "classes")
    # one number for each of the 2 ** CELL_BITS cells
    cells = {r[0]: r[1] for r in table.filter("n < 0").select(F.posexplode("cells")).groupBy("pos").agg(F.sum("col")).collect()}
    frequent = np.array([cells.get(i, 0) for i in range(1 << CELL_BITS)], np.int64)
    total = int(frequent.sum())
    frequent[frequent <= min(FREQUENT * max(1, total // len(frequent)), BUCKET_GRAMS // FREQUENT)] = 0
    buckets = max(LEAST_BUCKETS, total // BUCKET_GRAMS + 1)
    sets = candidate_sets(shared_grams(rows, ngram, frequent, buckets), classes, percent)
    labels = linked_components(sets, percent)
    member = sets.select("sid", "a", "b").join(labels.withColumnRenamed("node", "sid"), "sid").join(classes, ["a", "b"]).select("a", "b", "root", "low")
    lowest = member.join(member.groupBy("root").agg(F.min("low").alias("component")), "root").select("a", "b", "component")
    of_class = classes.select("a", "b", "low").join(lowest, ["a", "b"], "left").select("a", "b", F.coalesce("component", "low").alias("component"))
    out = found.filter("n > 0").join(of_class, ["a", "b"]).select("key", "n", "component").union(found.filter("n = 0").select("key", "n", "key"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
