"""Operator 11: embedding near-duplicates by lattice hashing.

1. Equal vectors are one distinct vector with a number of copies.
2. Distinct vectors that share a lattice cell and lie so near to one of the
   cell's leaders that any two of them must link form a class, which moves as
   one from here on.  A group of a million near copies is then a few classes.
3. In each of several tables eight random projections are decoded to the
   nearest point of the E8 lattice.  A class enters the cells of its members,
   and asks in these and in the neighbouring cells nearest to each member.
   Cells with too many classes are dealt again by further lattices.
4. Classes that meet in a cell and whose centres' sign sketches allow a link
   are candidates.  Each member's cosine with the other class's centre shows
   that it links with all members, with none, or that it must be compared
   with each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import materialize
from clickmart.llm._words import U, mix
from clickmart.llm.simhash import _spread, components

MIN_COS = 0.9
TABLES, PROBES, SCALE = 5, 8, 0.7
#: Cells with more classes are dealt again, by this many tables, at most so many times; what is left large is compared in blocks.
PIECE, AGAIN_TABLES, AGAIN = 2048, 4, 3
LEADERS = 8
#: Sign bits of a sketch, and the standard deviations a link's sketch distance may lie over its mean.
BITS, SIGMAS = 128, 5.0
#: Angles this near to the limit (radians) are compared vector by vector.
MARGIN = 1e-7


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minus signs."""
    pairs = [(i, j, a, b) for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for k, (i, j, a, b) in enumerate(pairs):
        whole[k, i], whole[k, j] = a, b
    signs = 1 - 2 * (np.arange(256)[:, None] >> np.arange(8) & 1)
    return np.concatenate([whole, signs[(signs < 0).sum(axis=1) % 2 == 0] * 0.5])


NEIGHBOURS = _minimal_vectors()


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    point = np.round(y)
    off = y - point
    odd = np.flatnonzero(point.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 shifted by one half."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def _cell_hash(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64-bit name of lattice points (doubled, they are integers)."""
    h = salt.astype(np.uint64)
    with np.errstate(over="ignore"):
        for c in (2 * points).round().astype(np.int64).view(np.uint64).T:
            h = mix(h * U(0x9E3779B97F4A7C15) + c)
    return h


def _projection(dim: int, table: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((11, dim, table, level))
    return rng.normal(size=(dim, 8)), rng.random(8)


def lattice_cells(x: np.ndarray, table: int, level: int, salt: np.ndarray, probes: int, scale: float) -> np.ndarray:
    """Of unit vectors: the name of each one's own cell and of its ``probes`` nearest neighbouring cells, as columns."""
    g, shift = _projection(x.shape[1], table, level)
    y = scale * (x @ g) + shift
    point = nearest_e8(y)
    seeded = mix(salt.astype(np.uint64) + U((level * 4096 + table) * 65536 + x.shape[1] + 1))
    out = [_cell_hash(point, seeded)]
    if probes:
        side = (y - point) @ NEIGHBOURS.T
        best = np.argpartition(-side, probes - 1, axis=1)[:, :probes]
        out += [_cell_hash(point + NEIGHBOURS[best[:, k]], seeded) for k in range(probes)]
    return np.stack(out, axis=1)


def _unit_rows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each dimension in a column of valid vectors."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    dims, out = np.diff(ends), []
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        x = values[ends[at][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out.append((at, x / np.sqrt((x * x).sum(axis=1, keepdims=True))))
    return out


def _pieces(n: int, size: int = 4096) -> Iterator[slice]:
    for i in range(0, n, size):
        yield slice(i, i + size)


def _cosines(a: pa.Array, b: pa.Array) -> pa.Array:
    """Cosine of two vectors of the same dimension in double precision; null if dimensions differ."""
    out, valid = np.zeros(len(a)), np.zeros(len(a), bool)
    same = np.flatnonzero(np.diff(a.offsets.to_numpy()) == np.diff(b.offsets.to_numpy()))
    a, b = a.take(pa.array(same)), b.take(pa.array(same))
    for (at, x), (_, y) in zip(_unit_rows(a), _unit_rows(b)):
        out[same[at]], valid[same[at]] = np.minimum(1.0, (x * y).sum(axis=1)), True
    return pa.array(out, mask=~valid)


def _cosine(a: str, b: str) -> Column:
    return F.arrow_udf(_cosines, "double")(a, b)


def _sketches(column: pa.Array) -> pa.Array:
    """Signs of ``BITS`` random projections."""
    out: list = [None] * len(column)
    for at, x in _unit_rows(column):
        g = np.random.default_rng((12, x.shape[1])).normal(size=(x.shape[1], BITS))
        for part in _pieces(len(at)):
            packed = np.packbits(x[part] @ g > 0, axis=1)
            for i, bits in zip(at[part].tolist(), packed):
                out[i] = bits.tobytes()
    return pa.array(out, pa.binary())


def _valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _own_cell(scale: float):
    def cells(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column), np.uint64)
        for at, x in _unit_rows(column):
            for part in _pieces(len(at)):
                out[at[part]] = lattice_cells(x[part], 0, 99, np.zeros(len(x[part]), np.uint64), 0, scale)[:, 0]
        return pa.array(out.view(np.int64))
    return F.arrow_udf(cells, "long")


#: Rows of a cell: the class with its centre's sketch and radius (1/1000 radians); ``asks`` 0 for its own cell, 1 for a probed one.
ENTRY = "cell long, owner long, asks int, sketch binary, milli int"


def _entries(tables: int, level: int, probes: int, scale: float):
    """Entries of rows (salt, asks, owner, vec, sketch, milli).  Repeats within a batch are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            salt = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            asks = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, x in _unit_rows(b.column(3)):
                for part in _pieces(len(at)):
                    rows = at[part]
                    cells = np.concatenate([lattice_cells(x[part], t, level, salt[rows], probes, scale) for t in range(tables)], axis=1).view(np.int64)
                    asked = np.ones(cells.shape, np.int64)
                    asked[:, ::probes + 1] = asks[rows][:, None]
                    cell, ask, row = cells.ravel(), asked.ravel(), np.repeat(rows, cells.shape[1])
                    order = np.lexsort((ask, owner[row], cell))
                    cell, ask, row = cell[order], ask[order], row[order]
                    new = np.ones(len(cell), bool)
                    new[1:] = (cell[1:] != cell[:-1]) | (owner[row[1:]] != owner[row[:-1]]) | (ask[1:] != ask[:-1])
                    row = row[new]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[new]), pa.array(owner[row]), pa.array(ask[new].astype(np.int32)),
                         b.column(4).take(pa.array(row)), b.column(5).take(pa.array(row))], names=["cell", "owner", "asks", "sketch", "milli"])
    return run


def _allowed(limit: float) -> np.ndarray:
    """Largest sketch distance of two classes, by the sum of their radii in 1/1000 radians."""
    angle = np.minimum(limit + np.arange(4000) / 1000, np.pi)
    p = angle / np.pi
    return BITS * p + SIGMAS * np.sqrt(BITS * p * (1 - p))


def _meet(limit: float, hold: int = 200_000, at_once: int = 1 << 20):
    """Of entries sorted by cell: pairs of classes, one asking where the other is, that may link."""
    allowed = _allowed(limit)

    def pairs(cell, cid, asks, sketch, radius) -> Iterator[pa.RecordBatch]:
        own, ask = np.flatnonzero(asks == 0), np.arange(len(cell))
        low, high = np.searchsorted(cell[own], cell[ask]), np.searchsorted(cell[own], cell[ask], side="right")
        total = np.concatenate([[0], np.cumsum(high - low)])
        i = 0
        while i < len(ask):
            j = max(i + 1, int(np.searchsorted(total, total[i] + at_once, side="right")) - 1)
            found, of = _spread(low[i:j], high[i:j])
            a, b = ask[i:j][of], own[found]
            apart = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1)
            near = (cid[a] != cid[b]) & (apart <= allowed[np.minimum(radius[a] + radius[b], len(allowed) - 1)])
            u, v = cid[a[near]], cid[b[near]]
            out = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0

        def cut(whole: bool):
            nonlocal parts, rows
            cols = [np.concatenate(c) for c in zip(*parts)]
            end = len(cols[0]) if whole else int(np.searchsorted(cols[0], cols[0][-1]))  # the last cell may go on
            parts, rows = [tuple(c[end:] for c in cols)], len(cols[0]) - end
            return pairs(*(c[:end] for c in cols)) if end else ()

        for b in batches:
            sketch = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint64).reshape(len(b), -1)
            parts.append((b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), sketch, b.column(4).to_numpy().astype(np.int64)))
            rows += len(b)
            if rows >= hold:
                yield from cut(False)
        if parts:
            yield from cut(True)

    return run


def classes_of(distinct: DataFrame, limit: float, scale: float = SCALE, leaders: int = LEADERS) -> DataFrame:
    """``distinct`` (vid, vec, copies, first_id) with ``cid``: a vector within ``limit`` / 2 of this one, itself if there is none.

    So any two vectors with the same cid link.  A cell's leaders are those
    with the smallest hash in each of ``leaders`` parts of it.
    """
    celled = materialize(distinct.withColumn("cell", _own_cell(scale)("vec")), "vector-cells")
    lead = (celled.groupBy("cell", F.pmod(F.xxhash64("vid", F.lit(1)), F.lit(leaders)).alias("part"))
            .agg(F.min(F.struct(F.xxhash64("vid", F.lit(2)).alias("h"), "vid")).alias("l"), F.count("*").alias("n"))
            .select("cell", "n", F.col("l.vid").alias("vid"))
            .join(celled.select("vid", "vec"), "vid")
            .groupBy("cell").agg(F.sum("n").alias("members"), F.collect_list(F.struct("vid", "vec")).alias("leaders")).where("members > 1"))
    near = np.cos(limit / 2 - MARGIN)
    looked = (celled.join(lead.select("cell", "leaders"), "cell").select("vid", "vec", F.explode("leaders").alias("l"))
              .where(F.col("l.vid") != F.col("vid"))
              .where(F.col("l.vid") < F.col("vid"))  # of two leaders only one gives way, and only to one that stays
              .where(_cosine("vec", "l.vec") >= float(near))
              .groupBy("vid").agg(F.min("l.vid").alias("cid")))
    # A leader that itself belongs elsewhere still is a centre: only distances to it matter.
    return celled.drop("cell").join(looked, "vid", "left").withColumn("cid", F.coalesce("cid", "vid"))


def candidate_classes(members: DataFrame, limit: float, tables: int = TABLES, probes: int = PROBES,
                      scale: float = SCALE, piece: int = PIECE) -> DataFrame:
    """Distinct pairs (a, b), a < b, of classes that may link, from the cells of ``members`` (vid, cid, vec, sketch, milli)."""
    def met(rows: DataFrame) -> DataFrame:
        return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_meet(limit), "a long, b long")

    found = None
    source = members.select(F.lit(0).cast("long").alias("salt"), F.lit(0).alias("asks"), "cid", "vec", "sketch", "milli", "vid")
    for level in range(AGAIN + 1):
        run = _entries(tables if level == 0 else AGAIN_TABLES, level, probes, scale)
        made = source.select("salt", "asks", "cid", "vec", "sketch", "milli").mapInArrow(run, ENTRY)
        rows = materialize(made.dropDuplicates(["cell", "owner", "asks"]), "lattice-entries")
        large = materialize(rows.where("asks = 0").groupBy("cell").count().where(F.col("count") > piece).select("cell"), "large-cells")
        last = level == AGAIN or large.isEmpty()
        pairs = met(rows if last else rows.join(large, "cell", "left_anti"))
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        # The members in large cells go on by further lattices inside them.
        inside = (source.select("salt", "asks", "vid", "vec", "sketch", "milli").mapInArrow(run, ENTRY).select("cell", "owner", "asks").distinct()
                  .join(large, "cell", "left_semi"))
        source = materialize(inside.join(members.withColumnRenamed("vid", "owner"), "owner")
                             .select(F.col("cell").alias("salt"), "asks", "cid", "vec", "sketch", "milli", F.col("owner").alias("vid")), "dealt-again")
    return found.distinct()


def near_vectors(vectors: DataFrame, min_cos: float = MIN_COS, tables: int = TABLES, probes: int = PROBES,
                 scale: float = SCALE, piece: int = PIECE, leaders: int = LEADERS) -> DataFrame:
    """For every row of ``vectors`` (vec_id, embedding, any others): vec_id, n_links, component_id and kept.

    Two vectors link if their cosine, in double precision, is ``min_cos`` or
    more and lattice hashing finds them (every link counted is a true one;
    the tests measure the share found).  ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest vec_id reachable over
    links, itself included, and ``kept`` tells whether it is the row's own.

    A vector that is null, empty, zero, or holds a null or non-finite entry
    links with nothing and is kept; vectors of different dimensions never
    link.  Rows that repeat a vector link with each other.  Rows without
    vec_id are linked like any other; they are never kept, and a component
    has a null id only if none of its rows has one.  Other columns are left
    out.  An empty table gives no rows.

    Vectors are told apart by a 64-bit hash.  One row of a distinct vector
    gives ``tables`` * (``probes`` + 1) entries of some 40 bytes; near copies share theirs.
    """
    limit = float(np.arccos(min_cos))
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    base = base.withColumn("vec", F.when(_valid(F.col("vec")), F.transform("vec", lambda x: x + 0.0)))
    keyed = base.select("vec_id", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")).alias("vid"), "vec")
    ids = materialize(keyed.drop("vec"), "vector-ids")
    distinct = (keyed.where("vid is not null").groupBy("vid")
                .agg(F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id")))
    members = materialize(classes_of(distinct, limit, scale, leaders), "vector-members")
    centre = members.select(F.col("vid").alias("cid"), F.col("vec").alias("centre"))
    angle = F.acos(_cosine("vec", "centre"))
    away = members.where("cid <> vid").join(centre, "cid").select("cid", "copies", angle.alias("angle"))
    own = members.where("cid = vid").select("cid", "copies", F.lit(0.0).alias("angle"))
    sizes = (away.unionByName(own).groupBy("cid")
             .agg(F.max("angle").alias("radius"), F.sum("copies").alias("weight")))
    classes = materialize(sizes.join(centre, "cid").withColumn("sketch", F.arrow_udf(_sketches, "binary")("centre"))
                          .withColumn("milli", F.ceil(F.col("radius") * 1000).cast("int")), "vector-classes")

    described = materialize(members.join(classes.select("cid", "sketch", "milli"), "cid"), "class-members")
    pairs = materialize(candidate_classes(described, limit, tables, probes, scale, piece), "class-pairs")
    both = pairs.select(F.col("a").alias("cid"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("cid"), F.col("a").alias("other")))
    facts = classes.select(F.col("cid").alias("other"), "centre", "radius", "weight")
    judged = materialize(
        both.join(members.select("vid", "cid", "vec"), "cid").join(facts, "other").select("vid", "cid", "vec", "other", "radius", "weight", angle.alias("angle"))
        .where(F.col("angle") - F.col("radius") <= limit + MARGIN)
        .withColumn("all", (F.col("radius") > 0) & (F.col("angle") + F.col("radius") <= limit - MARGIN)), "member-class")
    against = members.select(F.col("cid").alias("other"), F.col("vid").alias("to"), F.col("vec").alias("to_vec"), F.col("copies").alias("weight"))
    verified = materialize(judged.where("not all").select("vid", "cid", "vec", "other").join(against, "other")
                           .where(_cosine("vec", "to_vec") >= min_cos).select("vid", "cid", "other", "weight"), "verified-links")
    both_ways = judged.where("all").select("vid", "cid", "other", "weight").unionByName(verified)

    found = both_ways.groupBy("vid").agg(F.sum("weight").alias("found"))
    # Members link with their own centre, so one link for two classes connects what all of theirs do.
    links = (both_ways.where("cid < other").select(F.col("cid").alias("u"), F.col("other").alias("v")).distinct()
             .unionByName(members.where("cid <> vid").select(F.col("vid").alias("u"), F.col("cid").alias("v"))))
    roots = components(links)
    counted = (members.join(classes.select("cid", "weight"), "cid").join(found, "vid", "left")
               .join(roots, members.vid == roots.node, "left")
               .select("vid", "first_id", F.coalesce("root", "vid").alias("root"), (F.col("weight") - 1 + F.coalesce("found", F.lit(0))).alias("n_links")))
    counted = materialize(counted, "vector-links")
    smallest = counted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = counted.join(smallest, "root").select("vid", "n_links", "component_id")
    linked = (ids.where("vid is not null").join(result, "vid").select("vec_id", "n_links", "component_id")
              .unionByName(ids.where("vid is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))))
    return linked.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
