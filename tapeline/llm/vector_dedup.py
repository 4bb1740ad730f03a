"""Near-duplicate embeddings with randomised-rotation binary codes.

A unit vector is rotated at random and coded by its signs, x = signs / sqrt(D). With the stored correction factor
f = <x, own vector>, <x, q> / f is an unbiased estimate of the cosine with q. It also bounds it: the angle between x and
q is at most that between x and its own vector plus that between the two vectors. So pairs with <x, q> below
cos(acos f + acos limit) are not near, for certain, and need no exact recomputation. q itself travels in 4 bits a
component with the length of its rounding error, which widens the bound.

Candidates are vectors that agree in a run of sign bits of one of several rotations: ``tables`` runs of ``bits`` bits,
chosen from the number of vectors so that buckets stay small and a pair at the limit is missed once in 10,000 times.
Bounded candidates meet again with their whole vectors; the pair counts in the first run it agrees in, so only once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.buckets import in_buckets
from tapeline.llm.common import pick
from tapeline.llm.components import components, star_forest
from tapeline.llm.vectors import by_length, rotation, unit, usable
from tapeline.session import staged

LIMIT = 0.95
MISSED = 1e-4
SEED = 17
LEVELS = 16


def plan(n: int, limit: float = LIMIT, missed: float = MISSED) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = min(40, max(8, math.ceil(math.log2(max(n, 2))) - 2))
    agree = (1 - math.acos(limit) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log(1 - agree))


def run_keys(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(n, tables) keys of unit vectors; keys of different runs and dimensions differ."""
    d = units.shape[1]
    signs = np.concatenate([units @ rotation(d, SEED, r) >= 0 for r in range(math.ceil(bits * tables / d))], axis=1)
    runs = signs[:, : bits * tables].reshape(len(units), tables, bits)
    value = runs @ (1 << np.arange(bits, dtype=np.int64))
    return ((np.arange(tables, dtype=np.int64)[None, :] << 40 | value) * 1_000_003 + d).astype(np.int64)


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed 4-bit components of the rotated vectors, whose top bits are the sign code; correction factor; rounding error."""
    d = units.shape[1]
    turned = units @ rotation(d, SEED, 0)
    factor = np.abs(turned).sum(axis=1) / math.sqrt(d)
    step = np.maximum(np.abs(turned).max(axis=1, keepdims=True), 1e-300) / (LEVELS / 2)
    level = np.clip(np.floor(turned / step), -LEVELS // 2, LEVELS // 2 - 1)
    error = np.linalg.norm(turned - (level + 0.5) * step, axis=1)
    nibble = (level + LEVELS // 2).astype(np.uint8)
    nibble = np.concatenate((nibble, np.zeros((len(units), d % 2), np.uint8)), axis=1)
    return np.concatenate((nibble[:, ::2] << 4 | nibble[:, 1::2], step.astype("<f4").view(np.uint8).reshape(-1, 4)), axis=1), factor, error


def decoded(packed: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Sign codes of unit length and rounded rotated vectors."""
    step = packed[:, -4:].copy().view("<f4").astype(np.float32)
    nibble = np.stack((packed[:, :-4] >> 4, packed[:, :-4] & 15), axis=2).reshape(len(packed), -1)[:, :d]
    rounded = nibble.astype(np.float32) - np.float32(LEVELS / 2 - 0.5)
    return np.where(rounded > 0, np.float32(1), np.float32(-1)) / np.float32(math.sqrt(d)), rounded * step


def _keyed(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                cid = part.column(0).to_numpy()
                for at, m in by_length(part.column(1)):
                    u = unit(m)
                    keys, (packed, factor, error) = run_keys(u, bits, tables), codes(u)
                    code = pa.array([p.tobytes() for p in packed], pa.binary())
                    n = pa.array(np.full(len(at), m.shape[1], np.int32))
                    for t in range(tables):
                        yield pa.record_batch([pa.array(keys[:, t]), pa.array(cid[at]), n, code, pa.array(factor.astype(np.float32)), pa.array(error.astype(np.float32))], ["key", "cid", "d", "code", "factor", "error"])

    return run


def _screen(limit: float):
    """Rows (key, cid) of the vectors with a partner in their bucket that may be near."""

    def judge(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
        length, near = rows.column("d").to_numpy(), np.zeros(len(i), bool)
        factor, error = rows.column("factor").to_numpy().astype(np.float64), rows.column("error").to_numpy().astype(np.float64)
        # a little room for the sums in single precision
        bound = np.cos(np.minimum(np.pi, np.arccos(np.clip(factor, 0, 1)) + math.acos(limit))) - 1e-4
        code = rows.column("code").combine_chunks()
        for d in np.unique(length):
            own = np.flatnonzero(length == d)
            place = np.full(len(length), -1)
            place[own] = np.arange(len(own))
            packed = np.frombuffer(b"".join(code.take(pa.array(own)).to_pylist()), np.uint8).reshape(len(own), -1)
            sign, rounded = decoded(packed, int(d))
            use = np.flatnonzero((place[i] >= 0) & (place[j] >= 0))
            for lo in range(0, len(use), 20_000):
                k = use[lo : lo + 20_000]
                dot = np.einsum("nd,nd->n", sign[place[i[k]]], rounded[place[j[k]]])
                near[k] = dot + error[j[k]] >= bound[i[k]]
        both = np.unique(np.concatenate((i[near], j[near])))
        return rows.select(["key", "cid"]).take(pa.array(both))

    return judge


def _exact(limit: float, bits: int, tables: int):
    """Links of each vector, a row (cid, null, number of rows linked) each, and edges (a, b, null) that connect all links."""

    def judge(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
        key, cid, size = (rows.column(c).to_numpy() for c in ("key", "cid", "n"))
        linked = np.zeros(len(i), bool)
        for own, m in by_length(rows.column("v")):
            place = np.full(len(key), -1)
            place[own] = np.arange(len(own))
            u = unit(m)
            keys = run_keys(u, bits, tables)
            here = (keys == key[own][:, None]).argmax(axis=1)
            use = np.flatnonzero((place[i] >= 0) & (place[j] >= 0))
            for lo in range(0, len(use), 10_000):
                k = use[lo : lo + 10_000]
                a, b = place[i[k]], place[j[k]]
                near = np.einsum("nd,nd->n", u[a], u[b]) >= limit
                k, a, b = k[near], a[near], b[near]
                first = (keys[a] == keys[b]).argmax(axis=1) == here[a]
                linked[k[first]] = True
        i, j = i[linked], j[linked]
        some, at = np.unique(cid[np.concatenate((i, j))], return_inverse=True)
        links = np.bincount(at, np.concatenate((size[j], size[i])).astype(np.float64), minlength=len(some)).astype(np.int64)
        a, b = star_forest(cid[i], cid[j])
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.table({
            "a": pa.concat_arrays([pa.array(some, pa.int64()), pa.array(a, pa.int64())]),
            "b": pa.concat_arrays([none(len(some)), pa.array(b, pa.int64())]),
            "n": pa.concat_arrays([pa.array(links, pa.int64()), none(len(a))]),
        })

    return judge


def near_vectors(table: DataFrame, limit: float = LIMIT) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``table`` (vec_id, embedding); links are cosines >= ``limit``.

    Vectors that are null, zero or empty, or hold null or non-finite components, link with nothing; vectors of different
    lengths do not link. Equal vectors are one node of the graph and link with each other, rows of one vec_id too. Null ids
    are never smallest; a component of null ids only has a null id. An empty table gives an empty one; other columns
    are ignored.
    """
    rows = pick(table, "vec_id", "embedding").withColumn("ok", usable(F.col("embedding")))
    slim = rows.select("vec_id", "ok", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"), "embedding")
    nodes = slim.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("embedding").alias("v"))
    nodes = staged(nodes.withColumn("cid", F.monotonically_increasing_id()), "vector-nodes")
    bits, tables = plan(nodes.count(), limit)

    keyed = nodes.select("cid", "v").mapInArrow(_keyed(bits, tables), "key bigint, cid bigint, d int, code binary, factor float, error float")
    near = staged(in_buckets(keyed, _screen(limit), "key bigint, cid bigint", "vector-screen").distinct(), "vector-near")
    whole = near.join(nodes.select("cid", "n", "v"), "cid").select("key", "cid", "n", "v")
    found = staged(in_buckets(whole, _exact(limit, bits, tables), "a bigint, b bigint, n bigint", "vector-exact"), "vector-links")

    links = found.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"), "vector-components").select(F.col("node").alias("cid"), "root")
    joined = nodes.drop("v").join(links, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    joined = staged(joined, "vector-roots")
    least = staged(joined.groupBy("root").agg(F.min("least").alias("component_id")), "vector-least")
    known = joined.join(least, "root").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id", F.lit(True).alias("there"))
    known = staged(known, "vector-known")
    out = slim.drop("embedding").join(known, ["h1", "h2"], "left")
    mine = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.when(F.col("ok"), F.col("links")).otherwise(0).cast("bigint").alias("n_links"), mine.alias("component_id"), F.col("vec_id").eqNullSafe(mine).alias("kept")
    )
