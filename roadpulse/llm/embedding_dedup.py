"""Operator 10: near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c differ by d^2 = 2 - 2c. A rotation keeps distances; the rotated
coordinates are cut into blocks, and a squared distance is the sum of the blocks'. So a pair
within the limit is, in at least one block, within that block's share of it (its number of
coordinates over all). Candidates are the union over blocks of the pairs that are within the
share there, so none is missed; each is then verified on the original vectors in double precision.

The rotation goes to the principal directions of a bounded sample, dealt to the blocks in turn,
so that every block begins with directions along which vectors differ most. These span the
grid of the block's range join, in cells as wide as the block's radius: a row meets the rows of
its own cell and of the cells around it. The rows of a label, block and cell are dealt to chunks
of bounded size, and pairs of chunks are compared inside tasks: a cell that holds a third of all
vectors is many tasks of one size. Where vectors fill space evenly, as random ones do, a grid
of two coordinates leaves out little, and the work is that of comparing within a label.

Pairs are never emitted. A pair counts in the first block that has it as a candidate only, so
that the tasks' counts of links per vector add up; for the components they emit the links that
join something within the task. Equal vectors are one class from the start: a class's members
are all linked with each other and with all that one of them is linked with.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import connected_components, discard, saved, table

COSINE = 0.93
#: Blocks the rotated vectors are cut into, and coordinates of a block that make its grid.
BLOCKS, GRID = 4, 2
#: Vectors on each side of a comparison, on average.
CHUNK = 1024
#: Vectors that the rotation is fitted on, at most (any rotation gives the same links).
SAMPLE = 4000
#: Squared distances this much above a limit still pass: rounding never drops a pair.
SLACK = 1e-6
#: Candidates verified at a time.
AT_ONCE = 1 << 16

#: The half of a cell's surroundings that is compared from it; the other half compares from there.
STEPS = [x for x in itertools.product((-1, 0, 1), repeat=GRID) if x >= (0,) * GRID]


def usable(embedding: Column) -> Column:
    """Vectors that take part: no null or non-finite component, and not zero or null."""
    whole = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(whole & F.exists(embedding, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares stay finite and above zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fit_rotation(vectors: np.ndarray, dimensions: int) -> np.ndarray:
    """Orthogonal matrix to the sample's principal directions, dealt to the blocks in turn."""
    centred = vectors - vectors.mean(axis=0)
    _, directions = np.linalg.eigh(centred.T @ centred)
    directions = directions[:, ::-1]
    blocks = min(BLOCKS, dimensions)
    return directions[:, np.argsort(np.arange(dimensions) % blocks, kind="stable")]


def block_bounds(dimensions: int) -> list[tuple[int, int]]:
    counts = np.bincount(np.arange(dimensions) % min(BLOCKS, dimensions))
    ends = np.cumsum(counts).tolist()
    return list(zip([0, *ends[:-1]], ends))


def share(cosine: float, dimensions: int, bounds: tuple[int, int]) -> float:
    """A block's part of the squared distance that links allow."""
    return (2 - 2 * cosine) * (bounds[1] - bounds[0]) / dimensions + SLACK


def place_in_cells(
    cosine: float, rotations: dict[int, np.ndarray], narrow: bool
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Each row once per block and cell that it is compared in; ``home`` marks its own cell."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, rows in batch.groupby(batch["embedding"].map(len)):
                turned = unit(np.stack(rows["embedding"].to_numpy()).astype(np.float64)) @ rotations[n]
                for block, bounds in enumerate(block_bounds(n)):
                    grid = min(GRID, bounds[1] - bounds[0])
                    radius = np.sqrt(share(cosine, n, bounds) + 2 * SLACK)
                    cells = np.floor(turned[:, bounds[0] : bounds[0] + grid] / radius)
                    for step in {x[:grid] for x in STEPS if x[:grid] >= (0,) * grid}:
                        out = rows[["label"] if narrow else ["label", "id", "embedding", "size"]].copy()
                        out["cell"] = [
                            f"{n}/{block}/{'/'.join(str(int(v)) for v in cell)}"
                            for cell in cells - np.array(step)
                        ]
                        out["home"] = not any(step)
                        yield out

    return place


def compare_chunks(cosine: float, rotations: dict[int, np.ndarray]) -> Callable:
    """Links of one chunk's home rows with another chunk's rows: counts and joining links.

    Output: (a, null, n), a is linked with n rows; (a, b, null), a link that joins something.
    """

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        n = vectors.shape[1]
        units = unit(vectors)
        turned = units @ rotations[n]
        block = int(rows["cell"].iloc[0].split("/")[1])
        bounds = block_bounds(n)
        ids, sizes = rows["id"].to_numpy(), rows["size"].to_numpy()
        left = np.flatnonzero(rows["role"] == 0)
        right = np.flatnonzero(rows["role"] == 1)
        home = rows["home"].to_numpy()
        linked = np.zeros(len(rows), np.int64)
        joins, groups = [], {}

        def root(x):
            while groups.setdefault(x, x) != x:
                groups[x] = groups[groups[x]]
                x = groups[x]
            return x

        first, last = bounds[block]
        b = turned[right, first:last]
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            a = turned[some, first:last]
            near = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
            x, y = np.nonzero(near <= share(cosine, n, bounds[block]) + 2 * SLACK)
            x, y = some[x], right[y]
            # Two rows of one cell meet twice: once is enough.
            once = ~home[y] | (ids[x] < ids[y])
            x, y = x[once], y[once]
            for part in range(0, len(x), AT_ONCE):
                p, q = x[part : part + AT_ONCE], y[part : part + AT_ONCE]
                like = (units[p] * units[q]).sum(axis=1) >= cosine
                p, q = p[like], q[like]
                gaps = (turned[p] - turned[q]) ** 2
                within = np.stack(
                    [
                        gaps[:, i:j].sum(axis=1) <= share(cosine, n, (i, j))
                        for i, j in bounds
                    ]
                )
                own = within.argmax(axis=0) == block
                p, q = p[own], q[own]
                np.add.at(linked, p, sizes[q])
                np.add.at(linked, q, sizes[p])
                for one, other in zip(ids[p], ids[q]):
                    if root(one) != root(other):
                        groups[root(one)] = root(other)
                        joins.append((one, other, None))
        counts = [(ids[x], None, int(linked[x])) for x in np.flatnonzero(linked)]
        out = pd.DataFrame(counts + joins, columns=["a", "b", "n"], dtype=object)
        return out.astype({"n": "Int64"})

    return compare


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Rows are compared if their labels are equal and not null and their lengths are. Unusable
    vectors (see ``usable``) and those without label have no links and are their own component.
    Every row is a vector of its own, also one that repeats a vec_id; components are named by
    their smallest vec_id (null if they have none). Other columns are ignored.
    """
    rows = vectors.select("vec_id", "embedding", "label").withColumn(
        "id",
        F.when(
            usable(F.col("embedding")) & F.col("label").isNotNull(),
            F.md5(F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("array<string>"))),
        ),
    )
    classes = saved(
        rows.where("id is not null")
        .groupBy("id")
        .agg(
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
            F.min("vec_id").alias("least"),
            F.count("*").alias("size"),
        ),
        "embedding-classes",
    )
    found = saved(_found(classes, cosine), "embedding-found")
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("others"))
    parts = connected_components(found.where("b is not null").select("a", "b"), "embedding")
    named = classes.select("id", "least", "size").join(counts, F.col("id") == F.col("a"), "left")
    named = named.drop("a").join(parts, "id", "left")
    named = saved(
        named.withColumn("component", F.coalesce("component", "id")), "embedding-named"
    )
    # Written, so that both sides of the join are shuffled for it and a large component can be
    # split over tasks.
    roots = saved(
        named.groupBy("component").agg(F.min("least").alias("component_id")), "embedding-names"
    )
    ready = saved(named.join(roots, "component"), "embedding-roots")
    discard(classes, found, parts, named, roots)
    named = ready.select(
        F.col("id").alias("class"),
        (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        "component_id",
    )
    return rows.join(named, F.col("id") == F.col("class"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("class").isNull(), F.col("vec_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _found(classes: DataFrame, cosine: float) -> DataFrame:
    kind = dict(classes.dtypes)
    rotations = {}
    for row in classes.select(F.size("embedding").alias("n")).distinct().collect():
        # Bounded: SAMPLE vectors of each length.
        chosen = classes.where(F.size("embedding") == row["n"]).orderBy("id").limit(SAMPLE)
        sample = np.array([x[0] for x in chosen.select("embedding").collect()], np.float64)
        rotations[row["n"]] = fit_rotation(unit(sample), row["n"])
    vectors = classes.select("label", "id", "embedding", "size")
    counted = vectors.mapInPandas(
        place_in_cells(cosine, rotations, narrow=True),
        f"label {kind['label']}, cell string, home boolean",
    )
    sizes = counted.groupBy("label", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / CHUNK).cast("int").alias("lefts"),
        F.ceil(F.count("*") / CHUNK).cast("int").alias("rights"),
    )
    sizes = saved(sizes.where("lefts > 0"), "embedding-cells")
    placed = vectors.mapInPandas(
        place_in_cells(cosine, rotations, narrow=False),
        f"label {kind['label']}, id string, embedding {kind['embedding']}, size long, "
        "cell string, home boolean",
    ).join(sizes, ["label", "cell"])
    left = F.pmod(F.xxhash64("id"), F.col("lefts")).cast("int")
    right = F.pmod(F.xxhash64("id", F.lit(1)), F.col("rights")).cast("int")

    def role(number: int, chunk: Column, others: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), others - 1),
            lambda other: F.struct(
                F.lit(number).alias("role"),
                (chunk if number == 0 else other).alias("i"),
                (other if number == 0 else chunk).alias("j"),
            ),
        )

    nothing = F.array().cast("array<struct<role:int,i:int,j:int>>")
    roles = F.concat(
        F.when(F.col("home"), role(0, left, F.col("rights"))).otherwise(nothing),
        role(1, right, F.col("lefts")),
    )
    blocks = placed.withColumn("x", F.explode(roles)).select(
        "label", "cell", "x.i", "x.j", "x.role", "id", "embedding", "size", "home"
    )
    return blocks.groupBy("label", "cell", "i", "j").applyInPandas(
        compare_chunks(cosine, rotations), "a string, b string, n long"
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors of equal labels."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP10_SQL = f"""
with recursive usable as (
    select row_number() over () as place, vec_id, label, embedding::double[] as v
    from embeddings
    where embedding is not null and label is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
    select a.place as a, b.place as b
    from usable a join usable b
        on a.label = b.label and a.place <> b.place and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= {COSINE}
), reach(place, other) as (
    select place, place from usable
    union
    select reach.place, links.b from reach join links on links.a = reach.other
), counted as (
    select a as place, count(*) as n from links group by a
), named as (
    select r.place, min(u.vec_id) as component_id
    from reach r join usable u on u.place = r.other
    group by r.place
)
select u.vec_id, coalesce(n, 0)::bigint as n_links, component_id,
    u.vec_id is not distinct from component_id as kept
from usable u join named using (place) left join counted using (place)
union all
select vec_id, 0::bigint, vec_id, true
from embeddings
where embedding is null or label is null
    or len(list_filter(embedding, lambda x: x is null or not isfinite(x))) > 0
    or len(list_filter(embedding, lambda x: x <> 0)) = 0
"""
