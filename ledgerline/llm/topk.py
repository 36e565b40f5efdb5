"""Exact top-k by integer inner product over a bit-sliced index.

Vectors are quantised to integers and cut into blocks of rows. A block's index holds, per component,
one bitmap per bit of (component - minimum) without its lowest ``DROPPED_BITS`` bits. For a query the
weighted sum of the components is added up by bitmap arithmetic alone: the slice of bit j of a
component goes, for every set bit i of the query's component, to weight i + j, and full adders reduce
all bitmaps of a weight to one, carrying into the next. A negative component takes the complement.
Selection then walks from the most significant slice down and finds the k-th largest sum; as the
dropped bits change a score by a known bound, every row within that bound of it is a boundary row,
and those alone are scored exactly. k rows per query and block go to the final ranking.

Every block meets every block of queries, one pair per task row: the stated query set against all
rows, in blocks. The queries are broadcast only below a measured size; beyond it blocks of both sides are
dealt over (query deal, vector deal), so no join key holds more than a part of either.

Vectors whose products could leave 62 bits are *wide*: they have blocks of their own, and pairs with one
are scored by Python integers. A score beyond 64 bits is ranked as it is and shown as the nearest long.

Defined cases: vectors that are null, empty or hold a null or a component that is not finite, or have a
null id, take no part; all others do. Vectors of another length than the query are no candidates of it.
Only the query's own row is no candidate: rows that share its id are, and of rows equal in id and vector
one counts as the query's own. Equal scores and ids are ranked among themselves in any order. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_BYTES, Staged, stage, table

SCALE = 1024
EVERY = 100
TOP = 10
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
DROPPED_BITS = 3
#: Bytes of query blocks that one join key holds, where they are too many to broadcast.
DEAL_BYTES = 8 * 1024 * 1024
_LONG = 2**63 - 1
_BLOCK = "dim int, wide boolean, ids binary, data binary"


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, dim and x: the vectors that take part, their components as doubles."""
    x = F.col(vector).cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    taking = df.filter(F.col(key).isNotNull() & x.isNotNull() & (F.size(x) > 0) & sound)
    return taking.select(F.col(key).cast("long").alias("id"), F.size(x).alias("dim"), x.alias("x"))


def integers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * component) as Python integers; from 2^53 on every double is whole."""
    out = np.empty(x.size, object)
    out[:] = [int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE) for v in x.ravel().tolist()]
    return out.reshape(x.shape)


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """dim, wide, ids, data: up to ``rows`` vectors of one length as two packed arrays.

    Vectors that are not wide are packed as quantised 32-bit integers, wide ones as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list[tuple[np.ndarray, np.ndarray]]] = {}

        def packed(key):
            ids = np.concatenate([i for i, _ in held[key]])
            data = np.concatenate([x for _, x in held.pop(key)])
            columns = [pa.array([key[0]], pa.int32()), pa.array([key[1]]), [ids.tobytes()], [data.tobytes()]]
            return pa.RecordBatch.from_pydict(dict(zip(("dim", "wide", "ids", "data"), columns, strict=True)))

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, dims = batch.column("id").to_numpy(), batch.column("dim").to_numpy()
            flat, at = batch.column("x").flatten().to_numpy(), np.r_[0, np.cumsum(dims)]
            with np.errstate(over="ignore"):
                whole = np.floor(flat * SCALE)
            # Two vectors below the limit have products that add up to less than 2^62.
            size = np.maximum.reduceat(np.abs(whole), at[:-1])
            wide = size >= np.minimum(2.0**30, 2.0**31 / np.sqrt(dims))
            for dim, is_wide in sorted(set(zip(dims.tolist(), wide.tolist(), strict=True))):
                key, rest = (dim, is_wide), np.flatnonzero((dims == dim) & (wide == is_wide))
                while len(rest):
                    room = rows - sum(len(i) for i, _ in held.get(key, []))
                    mine, rest = rest[:room], rest[room:]
                    places = at[mine][:, None] + np.arange(dim)
                    x = flat[places] if is_wide else whole[places].astype(np.int32)
                    held.setdefault(key, []).append((ids[mine], x))
                    if len(mine) == room:
                        yield packed(key)
        for key in list(held):
            yield packed(key)

    return vectors.mapInArrow(run, _BLOCK)


def _unpacked(ids: bytes, data: bytes, dim: int, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(data, np.float64 if wide else np.int32).reshape(-1, dim)
    return np.frombuffer(ids, np.int64), integers(x) if wide else x


class SlicedIndex:
    """Bitmaps of one block of integer vectors, and top-k over them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.n = ids, x.astype(np.int64), len(ids)
        self.low = self.x.min(axis=0)
        self.span = self.x.max(axis=0) - self.low
        self.bits = max(1, int(self.span.max()).bit_length())
        self.dropped = min(DROPPED_BITS, self.bits - 1)
        moved = (self.x - self.low).astype(np.uint64)
        width = -(-self.n // 64) * 64
        self.slices = np.stack([self._packed(((moved >> np.uint64(j)) & np.uint64(1)).T.astype(np.uint8), width) for j in range(self.dropped, self.bits)], axis=1)
        self.all = self._packed(np.ones((1, self.n), np.uint8), width)[0]

    @staticmethod
    def _packed(bits: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(bits), width), np.uint8)
        out[:, : bits.shape[1]] = bits
        return np.packbits(out, axis=1, bitorder="little").view(np.uint64)

    def rows_of(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.n])

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, lowest first, of the weighted sum without the dropped bits."""
        size = np.abs(query)
        slices = np.where((query < 0)[:, None, None], ~self.slices & self.all, self.slices)
        by_weight: dict[int, list[np.ndarray]] = {}
        for i in range(int(size.max()).bit_length()):
            chosen = slices[(size >> i) & 1 == 1]
            for j in range(chosen.shape[1]):
                by_weight.setdefault(i + j, []).append(chosen[:, j])
        out, weight = [], 0
        while by_weight:
            found = by_weight.pop(weight, None)
            column = np.concatenate(found) if found else np.zeros((1, len(self.all)), np.uint64)
            carried = by_weight.setdefault(weight + 1, [])
            while len(column) > 1:
                if len(column) == 2:
                    a, b = column
                    carried.append((a & b)[None])
                    column = (a ^ b)[None]
                    continue
                m = len(column) // 3
                a, b, c = column[:m], column[m : 2 * m], column[2 * m : 3 * m]
                both = a ^ b
                carried.append((a & b) | (c & both))
                column = np.concatenate([both ^ c, column[3 * m :]])
            out.append(column[0] if len(column) else np.zeros_like(self.all))
            if not carried:
                by_weight.pop(weight + 1)
            weight += 1
        return out

    def boundary(self, sums: list[np.ndarray], among: np.ndarray, k: int, slack: int) -> np.ndarray:
        """Rows whose sum is at least the k-th largest sum less ``slack``."""
        kept, threshold, need = among, 0, k
        for j in range(len(sums) - 1, -1, -1):  # from the most significant slice down
            high = kept & sums[j]
            count = int(np.bitwise_count(high).sum())
            if count >= need:
                kept, threshold = high, threshold | 1 << j
            else:
                need -= count
                kept = kept & ~sums[j]
        floor = max(0, threshold - slack)
        if floor >> len(sums):
            return among & ~among
        above, equal = np.zeros_like(among), among
        for j in range(len(sums) - 1, -1, -1):
            if floor >> j & 1:
                equal = equal & sums[j]
            else:
                above = above | (equal & sums[j])
                equal = equal & ~sums[j]
        return above | equal

    def top(self, query: np.ndarray, k: int) -> np.ndarray:
        """The k best rows, ties to the smaller id."""
        query = query.astype(np.int64)
        if self.n <= k or not query.any():
            rows = np.arange(self.n)
        else:
            lost = int(np.abs(query).sum()) * ((1 << self.dropped) - 1)
            slack = -(-lost // (1 << self.dropped))
            rows = self.rows_of(self.boundary(self.sums(query), self.all, k, slack))
        return rows[np.lexsort((self.ids[rows], -(self.x[rows] @ query)))[:k]]


def _sortable(score: int) -> bytes:
    """A whole number as bytes that sort like it."""
    size = abs(score)
    body = size.to_bytes((size.bit_length() + 7) // 8, "big")
    body = len(body).to_bytes(4, "big") + body
    return b"\1" + body if score >= 0 else b"\0" + bytes(255 - b for b in body)


def _answers(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """k + 1 best rows of a block per query, as one of them may be the query's own."""
    for batch in batches:
        for row in batch.to_pylist():
            dim = row["dim"]
            ids, x = _unpacked(row["ids"], row["data"], dim, row["wide"])
            query_ids, queries = _unpacked(row["q_ids"], row["q_data"], dim, row["q_wide"])
            exact = row["wide"] or row["q_wide"]
            index = None if exact else SlicedIndex(ids, x)
            if exact:
                x, queries = x.astype(object), queries.astype(object)
            out = {n: [] for n in ("chunk", "query", "query_id", "vec_id", "score", "beyond", "same")}
            for i, (own, query) in enumerate(zip(query_ids.tolist(), queries, strict=True)):
                if exact:
                    scores = x @ query
                    rows = sorted(range(len(ids)), key=lambda r: (-scores[r], ids[r]))[: k + 1]  # noqa: B023
                    scores = [scores[r] for r in rows]
                else:
                    rows = index.top(query, k + 1)
                    scores = (index.x[rows] @ query.astype(np.int64)).tolist()
                out["chunk"] += [row["chunk"]] * len(rows)
                out["query"] += [i] * len(rows)
                out["query_id"] += [own] * len(rows)
                out["vec_id"] += ids[rows].tolist()
                out["score"] += [min(max(s, -_LONG), _LONG) for s in scores]
                out["beyond"] += [_sortable(s) if abs(s) >= _LONG else None for s in scores]
                out["same"] += [bool(ids[r] == own and (x[r] == query).all()) for r in rows]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_pydict({n: pa.array(v, t) for (n, v), t in zip(out.items(), types, strict=True)})


def _met(vectors: DataFrame, asked: Staged, limit: int) -> DataFrame:
    """Every block of vectors with every block of queries of its length."""
    if asked.bytes <= limit:
        return vectors.join(F.broadcast(asked.df), "dim")
    deals = -(-asked.bytes // DEAL_BYTES)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long")))
    left = vectors.withColumn("vd", F.pmod(F.monotonically_increasing_id(), F.lit(deals))).withColumn("qd", every)
    right = asked.df.withColumn("qd", F.pmod(F.xxhash64("chunk"), F.lit(deals))).withColumn("vd", every)
    return left.join(right.hint("merge"), ["dim", "qd", "vd"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, limit: int = BROADCAST_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score of the k best vectors of every query; both sides as ``quantised``."""
    asked = blocks(queries, QUERY_ROWS).select(
        "dim", F.col("wide").alias("q_wide"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
        F.monotonically_increasing_id().alias("chunk"),
    )
    pairs = _met(blocks(vectors, BLOCK_ROWS), stage(asked, "query-blocks", gather=True), limit)
    schema = "chunk bigint, query int, query_id bigint, vec_id bigint, score bigint, beyond binary, same boolean"
    columns = ["dim", "wide", "ids", "data", "q_wide", "q_ids", "q_data", "chunk"]
    found = pairs.select(*columns).mapInArrow(lambda b: _answers(b, k), schema)
    query = ["chunk", "query", "query_id"]
    order = [F.desc("score"), F.desc("beyond"), F.asc("vec_id")]
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy(*query).orderBy(*order)))
    best = best.filter(F.col("rank") <= k + 1)
    # One row that is equal to the query in id and vector is the query's own.
    own = F.row_number().over(Window.partitionBy(*query, "same").orderBy("rank"))
    others = best.withColumn("own", own).filter(~F.col("same") | (F.col("own") > 1))
    ranked = others.withColumn("rank", F.row_number().over(Window.partitionBy(*query).orderBy("rank")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("id") % EVERY == 0))


OP9_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id,
    list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.n <> c.n AND len(q.x) = len(c.x)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(greatest(least(score, 9223372036854775807), -9223372036854775807) AS BIGINT) AS score FROM r WHERE rank <= 10
"""
