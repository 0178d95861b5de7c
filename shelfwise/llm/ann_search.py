"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import staged

FOUND = "query_id long, class long, members array<long>, score double"


@dataclass(frozen=True)
class Tables:
    """``tables`` hash functions of ``hashes`` Gaussian projections each, cut into intervals of ``width``.

    Vectors are scaled to unit length first, where nearness by cosine is nearness by distance, and
    Gaussian projections (2-stable) keep distances.
    """

    tables: int = 8
    hashes: int = 6
    width: float = 1.5
    probes: int = 80
    seed: int = 11

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Where each unit vector falls on every projection, in intervals: rows x tables x hashes."""
        rng = np.random.Generator(np.random.PCG64([self.seed, vectors.shape[1]]))
        lines = rng.standard_normal((vectors.shape[1], self.tables * self.hashes))
        shifts = rng.uniform(0, self.width, self.tables * self.hashes)
        return ((vectors @ lines + shifts) / self.width).reshape(len(vectors), self.tables, self.hashes)

    def keys(self, cells: np.ndarray, table: np.ndarray | int) -> np.ndarray:
        """A 64-bit key of each bucket: its cells and its table."""
        key = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, np.uint64) + np.asarray(table, np.uint64)
        for h in range(self.hashes):
            key = (key ^ cells[..., h].astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(29)
        return key.view(np.int64)

    def perturbations(self, inside: np.ndarray) -> list[list[tuple[int, int]]]:
        """The own bucket, then steps to next intervals by estimated success.

        The chance that a neighbour lies across a border falls with the squared distance to it; sets
        of borders come by rising sums, from a heap that shifts or extends a set's last member.  A
        set that crosses both borders of an interval is passed over.
        """
        gaps = np.concatenate([inside, 1 - inside])
        order = np.argsort(gaps, kind="stable")
        cost = (gaps[order] ** 2).tolist()
        steps = [(int(i) % self.hashes, -1 if i < self.hashes else 1) for i in order]
        found, heap = [[]], [(cost[0], (0,))]
        while heap and len(found) < self.probes:
            total, members = heapq.heappop(heap)
            if len({steps[m][0] for m in members}) == len(members):
                found.append([steps[m] for m in members])
            last = members[-1] + 1
            if last < len(cost):
                heapq.heappush(heap, (total + cost[last], (*members, last)))
                heapq.heappush(heap, (total - cost[last - 1] + cost[last], (*members[:-1], last)))
        return found

    def probe_keys(self, place: np.ndarray) -> np.ndarray:
        """Keys of all buckets that a query visits; ``place`` is tables x hashes."""
        cells, out = np.floor(place).astype(np.int64), []
        for t in range(self.tables):
            steps = self.perturbations(place[t] - cells[t])
            visited = np.repeat(cells[t][None, :], len(steps), axis=0)
            for row, moves in enumerate(steps):
                for h, by in moves:
                    visited[row, h] += by
            out.append(self.keys(visited, t))
        return np.unique(np.concatenate(out))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine of a vector with each row of others, in the same order of additions for every row."""
    one, others = one / np.abs(one).max(), others / np.abs(others).max(axis=1, keepdims=True)
    return (others * one).sum(axis=1) / (np.sqrt((one * one).sum()) * np.sqrt((others * others).sum(axis=1)))


def best_in_slot(rows: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    """Of the rows in each bucket that a query visits, its ``k`` + 1 nearest, for every query of a slot."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64()]
    out: list[list] = [[], [], [], []]
    if len(rows) and len(asked):
        vectors = matrix(rows.column("vec"))
        directions, members = unit(vectors), rows.column("members")
        classes = rows.column("class").to_numpy()
        order = np.argsort(rows.column("key").to_numpy(), kind="stable")
        keys = rows.column("key").to_numpy()[order]
        sent = asked.filter(pa.compute.is_valid(asked.column("vec")))
        places = {q: i for i, q in enumerate(sent.column("number").to_pylist())}
        queries, ids = matrix(sent.column("vec")), sent.column("query_id").to_numpy()
        near = unit(queries)
        visits = asked.filter(pa.compute.is_null(asked.column("vec")))
        who = np.array([places[q] for q in visits.column("number").to_pylist()], np.int64)
        to = visits.column("key").to_numpy()
        low, high = np.searchsorted(keys, to, "left"), np.searchsorted(keys, to, "right")
        by_bucket = np.lexsort((who, low))
        by_bucket = by_bucket[high[by_bucket] > low[by_bucket]]
        best: dict[int, list] = {}
        margin = 16 * (vectors.shape[1] + 8) * np.finfo(float).eps  # over what rounding does to a score

        def nearest(q: int, rows: np.ndarray) -> np.ndarray:
            """The ``k`` + 1 first of the rows by exact cosine and class."""
            return rows[np.lexsort((classes[rows], -cosines(queries[q], vectors[rows])))[: k + 1]]

        edges = np.flatnonzero(np.insert(low[by_bucket][1:] != low[by_bucket][:-1], 0, True)) if len(by_bucket) else []
        for s, e in zip(edges, [*edges[1:], len(by_bucket)]):
            held = order[low[by_bucket[s]] : high[by_bucket[s]]]
            for part in range(s, e, 512):
                some = who[by_bucket[part : min(e, part + 512)]]
                scores = near[some] @ directions[held].T
                place = max(0, len(held) - k - 1)
                border = np.partition(scores, place, axis=1)[:, place] - margin
                at, column = np.nonzero(scores >= border[:, None])
                ends = np.searchsorted(at, np.arange(len(some) + 1))
                for q, b, e in zip(some.tolist(), ends[:-1], ends[1:]):
                    best.setdefault(q, []).append(held[column[b:e]] if e - b <= k + 3 else nearest(q, held[column[b:e]]))
        for q, parts in best.items():
            held = np.unique(np.concatenate(parts))
            held = nearest(q, held)
            for i, score in zip(held.tolist(), cosines(queries[q], vectors[held])):
                for column, value in zip(out, (ids[q], classes[i], members[i].as_py(), score)):
                    column.append(value)
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], names=["query_id", "class", "members", "score"])


def valid(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def ann_search(
    vectors: DataFrame, queries: DataFrame | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 5, every: int = 50, hashing: Tables = Tables(), bucket_rows: int = 4096, slot_rows: int = 40_000,
) -> DataFrame:
    """The ``k`` nearest rows found for every query, by largest cosine in double precision.

    Queries are the rows of ``queries``, or else those of ``vectors`` whose id ``every`` divides; a
    row of the query's own id is no candidate.  Every row is in the index, once for equal vectors:
    rows with the same vector are one entry with its ``k`` + 1 smallest ids, which is all that any
    answer can use.  Queries visit ``hashing.probes`` buckets of every table; entries met in any
    table are ranked by their exact cosine on the original vectors.  Buckets of more than
    ``bucket_rows`` entries are split, and queries visit all parts.  A query that met fewer than
    ``k`` rows is compared with all rows, in blocks.

    Returns ``query_id``, ``rank`` (from 1; ties to the smaller id), the id and ``score``.  Vectors
    that are null, empty, zero or hold nulls or non-finite numbers take no part, nor rows without
    id; vectors of another length never meet.  Rows that repeat an id count by their best score.
    """

    def given(df: DataFrame) -> DataFrame:
        rows = df.select(df[id_col].cast("long").alias("id"), df[vector_col].cast("array<double>").alias("vec"))
        return rows.filter(F.col("id").isNotNull() & valid(F.col("vec")))

    rows = given(vectors)
    asked = rows.filter(F.col("id") % every == 0) if queries is None else given(queries)
    # The filter on the number runs before the shuffle as well: a vector that many rows share sends k + 1 a task.
    first = Window.partitionBy("vec").orderBy("id")
    entries = rows.withColumn("n", F.dense_rank().over(first)).filter(F.col("n") <= k + 1).groupBy("vec").agg(
        F.min("id").alias("class"), F.slice(F.array_sort(F.collect_set("id")), 1, k + 1).alias("members")
    )
    entries = staged(entries.withColumn("dim", F.size("vec")), "entries")
    asked = staged(asked.distinct().withColumn("number", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "queries")
    count = entries.count()
    tasks = max(1, -(-count // 5_000))

    def hashed(batches: Iterator[pa.RecordBatch], probing: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in np.unique(batch.column("dim").to_numpy()).tolist():
                part = batch.filter(pa.compute.equal(batch.column("dim"), dim))
                place = hashing.places(unit(matrix(part.column("vec"))))
                if probing:
                    keys = [hashing.probe_keys(p) for p in place]
                else:
                    keys = list(hashing.keys(np.floor(place).astype(np.int64), np.arange(hashing.tables)[None, :]))
                yield part.drop_columns(["vec"] if probing else []).append_column("keys", pa.array(keys, pa.list_(pa.int64())))

    def with_keys(df: DataFrame, probing: bool) -> DataFrame:
        kept = [f for f in df.schema if not (probing and f.name == "vec")]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", keys array<long>"
        made = df.repartition(tasks, "class" if "class" in df.columns else "number").mapInArrow(lambda b: hashed(b, probing), schema)
        return made.withColumn("key", F.explode("keys")).drop("keys")

    indexed, visits = with_keys(entries, False), with_keys(asked, True)
    crowded = indexed.groupBy("dim", "key").count().filter(F.col("count") > bucket_rows)
    crowded = staged(crowded.select("dim", "key", F.ceil(F.col("count") / bucket_rows).alias("parts")), "crowded")
    part, parts = F.lit(0).cast("long"), F.lit(1).cast("long")
    if not crowded.isEmpty():
        indexed, visits = indexed.join(crowded, ["dim", "key"], "left"), visits.join(crowded, ["dim", "key"], "left")
        parts = F.coalesce("parts", F.lit(1)).cast("long")
        part = F.pmod(F.xxhash64("class"), parts)
        visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    else:
        visits = visits.withColumn("part", part)
    slots = max(1, -(-count * hashing.tables // slot_rows))
    slot = F.pmod(F.xxhash64("dim", "key", "part"), F.lit(slots))
    indexed = indexed.withColumn("part", part).withColumn("slot", slot).select("dim", "slot", "key", "class", "members", "vec")
    visits = visits.withColumn("slot", slot).select("dim", "slot", F.col("id").alias("query_id"), "number", "key")

    def compared(index: DataFrame, visits: DataFrame) -> DataFrame:
        """Answers of each slot; a query's vector goes there once."""
        visits = staged(visits, "visits")
        there = visits.select("dim", "slot", "query_id", "number").distinct().join(asked.select("number", "vec"), "number")
        sent = visits.withColumn("vec", F.lit(None).cast("array<double>")).unionByName(there.withColumn("key", F.lit(None).cast("long")))
        by_slot = index.groupBy("dim", "slot").cogroup(sent.groupBy("dim", "slot"))
        return by_slot.applyInArrow(lambda a, b: best_in_slot(a, b, k), FOUND)

    def ranked(found: DataFrame) -> DataFrame:
        met = found.select("query_id", F.explode("members").alias(id_col), "score").filter(F.col(id_col) != F.col("query_id"))
        met = met.groupBy("query_id", id_col).agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
        return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", id_col, "score")

    answers = staged(ranked(compared(indexed, visits)), "answers")
    full = answers.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = staged(asked.join(full, "id", "left_anti"), "short")
    if short.isEmpty():
        return answers
    blocks = max(1, -(-count // slot_rows))
    every_row = entries.withColumns({"slot": F.pmod(F.xxhash64("class"), F.lit(blocks)), "key": F.lit(0).cast("long")})
    visits = short.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    visits = visits.select("dim", "slot", F.col("id").alias("query_id"), "number", F.lit(0).cast("long").alias("key"))
    more = ranked(compared(every_row.select("dim", "slot", "key", "class", "members", "vec"), visits))
    return answers.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(more)
