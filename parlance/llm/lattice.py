"""Operator 2, embedding near-dedup: lattice hashing.

Each of `TABLES` random projections takes the unit vectors to 8 dimensions, where they are decoded to the nearest point of the
E8 lattice. A vector is at home in that cell and probes the `PROBES` neighbouring cells that it is nearest to. Vectors that
meet (one at home where the other is at home or probes) are verified by cosine in double precision.

Equal vectors fall together first. Cells belong to a label and a dimension, and are cut into blocks of homes and of visitors; a
task takes many blocks one after the other, each a matrix product, and a hot cell is spread over many tasks. A block gives the
number of links of each vector and links enough to connect what it found connected, not all pairs. A pair that meets several
times is counted only at the first of its meetings, which is worked out from the vectors.

With these parameters pairs at a cosine of exactly 0.93 meet with a probability of 0.9995, closer ones more often (README).

Edge cases: vectors that are null, empty or zero, or hold null or non-finite components, and those without label link with
nothing. Vectors of different lengths don't link. Rows with one id and several vectors are one vector for components; each
row's links are its own. Rows without id have no component. Extra columns are ignored. Empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm import e8
from parlance.llm.blocks import each_block
from parlance.llm.common import stash
from parlance.llm.graph import components

COSINE = 0.93
TABLES = 4
PROBES = 8
SCALE = 0.18
BLOCK = 512
SEED = 3

_NEAR = e8.shortest_vectors()
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    return x / np.linalg.norm(x, axis=1)[:, None]


def cells(x: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """rows x tables x (1 + probes) cell keys of unit vectors; the first of each table is the home."""
    rng = np.random.default_rng(seed)
    out = np.empty((len(x), tables, 1 + probes), np.int64)
    for t in range(tables):
        basis, _ = np.linalg.qr(rng.normal(size=(max(x.shape[1], e8.DIMENSIONS), e8.DIMENSIONS)))
        shift = rng.uniform(0, 1, e8.DIMENSIONS)
        mix = rng.integers(1, 1 << 62, e8.DIMENSIONS) | 1
        z = x @ basis[: x.shape[1]] / scale + shift
        home = e8.nearest(z)
        near = np.argsort(-((z - home) @ _NEAR.T), axis=1, kind="stable")[:, :probes]
        points = np.concatenate([home[:, None], home[:, None] + _NEAR[near]], 1)
        out[:, t] = ((points * 2).astype(np.int64) * mix).sum(2) // 64 * 64 + t  # the table's number in the key
    return out


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("dim").to_numpy()
        for n in np.unique(sizes):
            part = batch.filter(pa.array(sizes == n))
            found = cells(unit(_matrix(part.column("vector"), part.num_rows)))
            per = found.shape[1] * found.shape[2]
            each = pa.array(np.repeat(np.arange(part.num_rows), per))
            home = np.tile(np.tile(np.arange(found.shape[2]) == 0, found.shape[1]), part.num_rows)
            yield pa.RecordBatch.from_arrays([*[part.column(c).take(each) for c in ("id", "label", "dim")], pa.array(found.reshape(-1)), pa.array(home)], ["id", "label", "dim", "cell", "home"])


def _matrix(vectors: pa.Array, rows: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _firsts(home: np.ndarray, all_: np.ndarray, a: np.ndarray, b: np.ndarray, ids: np.ndarray, cell: int) -> np.ndarray:
    """Whether this cell is the first meeting of each pair a (at home here), b; where both are at home, one order of the two counts."""
    a_in_b = (home[a][:, :, None] == all_[b]).any(2)
    b_in_a = (home[b][:, :, None] == all_[a]).any(2)
    first = (a_in_b | b_in_a).argmax(1)
    rows, here = np.arange(len(a)), cell % 64
    ha, hb = home[a, first], home[b, first]
    both = a_in_b[rows, first] & b_in_a[rows, first]
    return (first == here) & np.where(ha == hb, ids[a] < ids[b], np.where(both, np.minimum(ha, hb) == cell, True))


def _verify(block: pa.Table) -> pa.Table:
    """One block of a cell: the homes of side 0 against the visitors of side 1. Rows a, b (a link; n 0) and a, null, n (links of a)."""
    cell, side = block.column("cell")[0].as_py(), block.column("side").to_numpy()
    ids, first, place = np.unique(block.column("id").to_numpy(), return_index=True, return_inverse=True)
    left, right = place[side == 0], place[side == 1]
    if not len(left) or not len(right):
        return _LINKS.empty_table()
    copies = block.column("copies").to_numpy()[first]
    vectors = block.column("vector").combine_chunks().take(pa.array(first))
    x = unit(_matrix(vectors, len(ids)))
    counts, links = np.zeros(len(ids), np.int64), []
    parent = list(range(len(ids)))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    table: tuple[np.ndarray, np.ndarray] | None = None
    for at in range(0, len(left), 64):
        i, j = np.nonzero(x[left[at : at + 64]] @ x[right].T >= COSINE)
        a, b = left[at + i], right[j]
        a, b = a[a != b], b[a != b]
        if not len(a):
            continue
        if table is None:
            every = cells(x)
            table = every[:, :, 0], every
        good = _firsts(*table, a, b, ids, cell)
        a, b = a[good], b[good]
        np.add.at(counts, a, copies[b])
        np.add.at(counts, b, copies[a])
        for p, q in zip(a.tolist(), b.tolist(), strict=True):
            r, s = find(p), find(q)
            if r != s:
                parent[s] = r
                links.append((ids[p], ids[q]))
    some, n = np.flatnonzero(counts), len(links)
    first = np.concatenate([np.array([a for a, _ in links], np.int64), ids[some]])
    second = np.concatenate([np.array([b for _, b in links], np.int64), np.zeros(len(some), np.int64)])
    other = pa.array(second, mask=np.arange(len(second)) >= n)
    return pa.table([pa.array(first), other, pa.array(np.concatenate([np.zeros(n, np.int64), counts[some]]))], schema=_LINKS)


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: key, n_links, component_id and kept (the vector whose key names its component)."""
    v = F.col(vector).cast("array<double>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sane = F.col(label).isNotNull() & F.col(vector).isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"), F.coalesce(sane, F.lit(False)).alias("sane"))
    digest = F.when(F.col("sane"), F.sha2(F.to_json(F.struct("label", "vector")), 256))
    rows = stash(rows.select("key", "label", "vector", "sane", digest.alias("digest")))
    # a set of equal vectors is known by its smallest key; ids of sets are numbers of their own, as keys may repeat
    same = rows.where("sane").groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    body = rows.where("sane").select("digest", "label", "vector").dropDuplicates(["digest"])
    reps = body.join(same, "digest").select(F.monotonically_increasing_id().alias("id"), "label", F.size("vector").alias("dim"), "vector", "copies", "least", "digest")
    reps = stash(reps)  # written once, so the numbers stay

    spot = ["label", "dim", "cell"]
    posts = stash(reps.select("id", "label", "dim", "vector").mapInArrow(_post, "id long, label string, dim int, cell long, home boolean").distinct())
    full = posts.groupBy(*spot).agg(F.count_if("home").alias("homes"), F.count("*").alias("visitors")).where("homes > 0 and visitors > 1")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    meet = posts.join(stash(full.select(*spot, blocks("homes").alias("nh"), blocks("visitors").alias("nv"))), spot)
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    at_home = F.transform(F.sequence(F.lit(0), F.col("nv") - 1), lambda k: place(own("nh"), k, 0))
    visiting = F.transform(F.sequence(F.lit(0), F.col("nh") - 1), lambda k: place(k, own("nv"), 1))
    jobs = meet.select("id", *spot, F.explode(F.when(F.col("home"), F.concat(at_home, visiting)).otherwise(visiting)).alias("p"))
    jobs = jobs.select("id", *spot, "p.i", "p.j", "p.side").join(reps.select("id", "vector", "copies"), "id")
    found = stash(each_block(jobs, [*spot, "i", "j"], _verify, "a long, b long, n long"))

    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    # components go by the smallest keys of the sets
    least = reps.select("id", "least")
    edges = found.where("b is not null").select("a", "b")
    edges = edges.join(least.select(F.col("id").alias("a"), F.col("least").alias("la")), "a").join(least.select(F.col("id").alias("b"), F.col("least").alias("lb")), "b")
    comps = components(edges.select(F.col("la").alias("a"), F.col("lb").alias("b"))).withColumnRenamed("id", "least")
    facts = reps.select("id", "digest", "least", "copies").join(counts, "id", "left").join(comps, "least", "left")
    facts = facts.select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    out = rows.select("key", "digest").join(facts, "digest", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    out = out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
