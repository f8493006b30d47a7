"""Operator 8: approximate nearest neighbours by NN-descent and greedy graph search.

A graph that links every vector to near ones is built in rounds: "a neighbour of a neighbour is
probably a neighbour". A round joins each node with those it links to and those that link to it,
compares them with each other, and offers each what it lacks; each keeps its nearest. Rounds end
when few links change. A query then walks the graph: of the nodes it has met it keeps the nearest, opens the nearest
ones not opened yet, and ends when its beam, the best of them, is open. What it ends with is scored again on
the original vectors, in double precision. How wide beams must be turns on the data and their
number, so it is measured: a bounded sample of queries is compared with every vector, in blocks, and
beams widen until the graph gives the sample's neighbours back, or a wider one adds nothing. All
queries walk each time, from what the narrower beams ended with: a step reads the whole graph for a
sample as well.

Nearness is the inner product. Vectors of each number of coordinates have a graph of their own.
They may be of any norm, so they get one more coordinate that
brings all to the norm of the longest; among these, inner product with a query orders as cosine
does. In the graph vectors are kept as bytes with a scale, for moving, not for results.

Scale. Nodes are dealt by hash to blocks of about BLOCK, one graph over all. A node's place is its
block and its position there. Blocks send each other mail, a row for each two that have something
to say, and work on arrays: what a block needs of another it asks for once, however many of its
nodes link there. Rounds start from cells of a few random hyperplanes, dealt to chunks of bounded
size. A node meets at most LINKS + BACKLINKS others, and a block tells a hub of BACKLINKS links and
offers it LINKS nodes at most, so no hub is gathered. Equal vectors are one node and one walk, whatever their
number, and results take the smallest ids of each. Walks are dealt to blocks too, each with its own
pool of entries. A step sends a block's walks to the blocks of the nodes that they open, where the
lists are read once for all of them, since the graph is bucketed by block, and offers back.
Work grows with nodes times links, and queries times beam.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.llm.common import discard, saved, ship_code, table
from roadpulse.llm.embedding_dedup import usable
from roadpulse.session import new_work_dir

#: Neighbours a node keeps, and links to it that a round uses, at most.
LINKS, BACKLINKS = 32, 24
#: Random partitions that the first lists come from, and vectors compared in a chunk of a cell.
PARTITIONS, CHUNK = 6, 1024
#: Nodes in a block, and in a block of few nodes, on average; nodes in a row of the graph; nodes whose
#: neighbours are compared at a time.
BLOCK, LEAST_BLOCK, PAGE, MEETINGS = 4096, 512, 64, 128
#: Rounds of neighbours of neighbours end when less than this share of all links is new, and how
#: many a node offers to each other one.
CHANGED, OFFERS = 0.05, 8
#: Nodes a query opens, at the first width tried; how many times as many it keeps, which is how much
#: wider the next beam is; and how many it scores again.
BEAM, WIDER, SCORED = 256, 1.5, 64
#: Queries that the width is measured with, at most; the recall to reach; the least that a wider beam
#: must add. A width is measured when no more than this share of the beams is not open; walks with the
#: last one go on to their ends.
SAMPLE, RECALL, GAIN, LATE = 200, 0.95, 0.005, 0.05
#: Nodes chosen by hash for every so many queries, a block of walks, and how many of them, the nearest,
#: a query starts from besides its own.
POOL, SHARING, ENTRIES = 1024, 512, 16
#: Queries that open a node in one step whose scores with its list are computed at a time.
HOT = 4096
#: A place is a block's number, shifted by so many bits, and a position. ROW is where a key has the row.
SHIFT, ROW = 20, 43

#: A row of mail: the block it is for, what it is, the block it is from, arrays as bytes, and a number.
MAIL = "to int, what int, source int, a binary, b binary, c binary, d binary, e binary, f binary, number long"
#: What mail is. STATE of nodes: codes, ids and scores of lists, links back, ids when the round began;
#: number of new links. STATE of walks: queries, directions, sizes, ids, scores, and flags of open nodes
#: of what they keep; number of nodes of beams not open. ENDED is such a state of walks at their end.
STATE, LINK, ASK, CODES, OFFER, MOVE, ENDED = range(7)


def encode(vectors: np.ndarray) -> list[bytes]:
    """A scale (float32) and a byte per coordinate."""
    scale = (np.abs(vectors).max(axis=1, keepdims=True) / 127).astype(np.float32)
    codes = np.rint(vectors / scale).astype(np.int8)
    return [a.tobytes() + b.tobytes() for a, b in zip(scale, codes)]


def decode(codes: np.ndarray) -> np.ndarray:
    """Rows of bytes -> vectors."""
    scales = np.ascontiguousarray(codes[:, :4]).view(np.float32)
    return codes[:, 4:].view(np.int8).astype(np.float32) * scales


def _matrix(data: bytes, kind: type, rows: int) -> np.ndarray:
    flat = np.frombuffer(data, kind)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _posted(rows: list[tuple]) -> pd.DataFrame:
    """Rows of mail (to, what, source, arrays...), or (..., number) where the arrays are six."""
    width = len(MAIL.split(","))
    full = [
        (*x[:3], *[None if y is None else y.tobytes() for y in x[3:9]], *[None] * (9 - len(x)), *(x[9:] or (0,)))
        for x in rows
    ]
    names = [x.split()[0] for x in MAIL.split(",")]
    assert all(len(x) == width for x in full)
    return pd.DataFrame(full, columns=names)


def _dealt(labels: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each label and where it is."""
    order = np.argsort(labels, kind="stable")
    ordered = labels[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(order) else []
    for a, b in zip(first, [*first[1:], len(order)]):
        yield int(ordered[a]), order[a:b]


def _ranks(rows: np.ndarray) -> np.ndarray:
    """How many entries of the same row come before each; equal rows are side by side."""
    if not len(rows):
        return np.empty(0, np.int64)
    first = np.r_[True, rows[1:] != rows[:-1]]
    starts = np.flatnonzero(first)
    return np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))


def best(
    rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, same: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries (row, id, score) the k best of each row, each id once: by row, best first. Ids that
    differ in their last ``same`` bits only count as one, the smallest."""
    keys = (rows.astype(np.uint64) << np.uint64(ROW + same)) | ids.astype(np.uint64)
    order = np.argsort(keys)
    keys = keys[order] >> np.uint64(same)
    order = order[np.r_[True, keys[1:] != keys[:-1]]] if len(order) else order
    rows, ids, scores = rows[order], ids[order], scores[order].astype(np.float32)
    bits = scores.view(np.uint32)
    # Descending as unsigned numbers.
    bits = np.where(bits >> 31, bits, ~bits & np.uint32(0x7FFFFFFF))
    order = np.argsort((rows.astype(np.uint64) << np.uint64(32)) | bits.astype(np.uint64))
    order = order[_ranks(rows[order]) < k]
    return rows[order], ids[order], scores[order]


def _drawn(members: np.ndarray, sources: np.ndarray, salt: int, k: int) -> np.ndarray:
    """Where the k links to each member are that a hash chooses, by member. The k of all are among
    those that each block chooses of its own."""
    x = members.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= (sources.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    order = np.lexsort((x, members))
    return order[_ranks(members[order]) < k]


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(node, embedding, norm) of the distinct vectors of (embedding), all usable, of one length."""
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return (
        vectors.select("embedding")
        .distinct()
        .select(
            F.xxhash64("embedding").alias("node"), "embedding", F.sqrt(squares).alias("norm")
        )
    )


def _labels(spark: SparkSession, blocks: int) -> list[int]:
    """Numbers of blocks that a shuffle to as many partitions deals one to each."""
    some = spark.range(0, 40 * blocks, numPartitions=1).select(F.col("id").cast("int").alias("label"))
    slot = F.pmod(F.hash("label"), F.lit(blocks)).alias("slot")
    return [x["label"] for x in some.groupBy(slot).agg(F.min("label").alias("label")).collect()]


def _label(labels: list[int], *of: str | Column) -> Column:
    """The label that a hash deals a row to."""
    slot = F.pmod(F.xxhash64(*of), F.lit(len(labels))).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in labels]), slot + 1)


def placed(nodes: DataFrame) -> tuple[DataFrame, list[int]]:
    """(to, place, node, embedding, norm), written, and the blocks' numbers."""
    spark, count = nodes.sparkSession, nodes.count()
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // LEAST_BLOCK))
    labels = _labels(spark, max(-(-count // BLOCK), few, 1))
    dealt = nodes.withColumn("to", _label(labels, "node", F.lit(3)))
    position = F.row_number().over(W.partitionBy("to").orderBy("node")) - 1
    place = F.shiftleft(F.col("to").cast("long"), SHIFT) + position
    return saved(dealt.select("to", place.alias("place"), "node", "embedding", "norm"), "nn-nodes"), labels


def _coded(nodes: DataFrame, longest: float) -> DataFrame:
    """(to, place, code): vectors of one length, in bytes."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                lengthened = _lengthened(batch["embedding"], longest)
                yield batch[["to", "place"]].assign(code=encode(lengthened))

    return nodes.select("to", "place", "embedding").mapInPandas(code, "to int, place long, code binary")


def _lengthened(embeddings: pd.Series, longest: float) -> np.ndarray:
    vectors = np.stack(embeddings.to_numpy()).astype(np.float64) / longest
    rest = np.sqrt(np.maximum(1 - (vectors * vectors).sum(axis=1, keepdims=True), 0))
    return np.concatenate([vectors, rest], axis=1)


def _unlisted(coded: DataFrame) -> DataFrame:
    """The state of each block, lists empty."""

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        codes = np.frombuffer(b"".join(rows["code"]), np.uint8)
        ids = np.full((len(rows), LINKS), -1, np.int64)
        scores = np.full((len(rows), LINKS), -np.inf, np.float32)
        return _posted([(rows["to"].iloc[0], STATE, 0, codes, ids, scores, None, ids)])

    return coded.groupBy("to").applyInPandas(gather, MAIL)


def _first_lists(coded: DataFrame, count: int) -> tuple[DataFrame, list[DataFrame]]:
    """Offers: the nearest within the chunks of a few random partitions; and the written tables that
    they are read from."""
    planes = max(int(np.ceil(np.log2(max(count, 1) / CHUNK))), 0)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = decode(np.frombuffer(b"".join(batch["code"]), np.uint8).reshape(len(batch), -1))
            for part in range(PARTITIONS if planes else 1):
                normals = np.random.default_rng(part).normal(size=(vectors.shape[1], planes))
                cells = ((vectors @ normals) > 0) @ (1 << np.arange(planes, dtype=np.int64))
                yield batch.assign(part=np.int32(part), cell=cells)

    cells = saved(
        coded.select("place", "code").mapInPandas(place, "place long, code binary, part int, cell long"),
        "nn-placed",
    )
    chunks = cells.groupBy("part", "cell").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    chunks = saved(chunks, "nn-cells")
    chunk = F.pmod(F.xxhash64("place", "part"), F.col("chunks"))
    dealt = cells.join(chunks, ["part", "cell"]).withColumn("chunk", chunk)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        places = rows["place"].to_numpy()
        vectors = decode(np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1))
        k = min(LINKS, len(places) - 1)
        if not k:
            return _posted([])
        ids, values = [], []
        for at in range(0, len(places), 256):
            scores = vectors[at : at + 256] @ vectors.T
            scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
            near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            ids.append(places[near])
            values.append(np.take_along_axis(scores, near, axis=1))
        return _posted(_offers(np.repeat(places, k), np.concatenate(ids).ravel(), np.concatenate(values).ravel()))

    return dealt.groupBy("part", "cell", "chunk").applyInPandas(compare, MAIL), [cells, chunks]


def _offers(to: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> list[tuple]:
    """Mail that offers nodes (id, score) to places."""
    positions = (to & ((1 << SHIFT) - 1)).astype(np.int32)
    return [
        (label, OFFER, 0, positions[at], ids[at], scores[at].astype(np.float32))
        for label, at in _dealt(to >> SHIFT)
    ]


def _state(rows: pd.DataFrame):
    """Of the state in a block's mail: codes, ids, scores, links back, ids at first; and the block."""
    row = rows[rows["what"] == STATE].iloc[0]
    n = len(row["b"]) // (8 * LINKS)
    back = None if row["d"] is None else _matrix(row["d"], np.int64, n)
    return (
        _matrix(row["a"], np.uint8, n),
        _matrix(row["b"], np.int64, n),
        _matrix(row["c"], np.float32, n),
        back,
        _matrix(row["e"], np.int64, n),
        int(row["to"]),
    )


def _with_offers(
    ids: np.ndarray, scores: np.ndarray, at: list[np.ndarray], new: list[np.ndarray], values: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Lists after offers."""
    row, slot = np.nonzero(ids >= 0)
    rows, found, values = best(
        np.concatenate([row, *at]),
        np.concatenate([ids[row, slot], *new]),
        np.concatenate([scores[row, slot], *values]),
        LINKS,
    )
    ids, scores = np.full_like(ids, -1), np.full_like(scores, -np.inf)
    slots = _ranks(rows)
    ids[rows, slots], scores[rows, slots] = found, values
    return ids, scores


def _kept(rows: pd.DataFrame) -> pd.DataFrame:
    """A block's state after the offers to it."""
    codes, ids, scores, _, first, to = _state(rows)
    mail = rows[rows["what"] == OFFER]
    ids, scores = _with_offers(
        ids,
        scores,
        [np.frombuffer(x, np.int32) for x in mail["a"]],
        [np.frombuffer(x, np.int64) for x in mail["b"]],
        [np.frombuffer(x, np.float32) for x in mail["c"]],
    )
    fresh = sum(
        int(((ids[at : at + 512, :, None] != first[at : at + 512, None, :]).all(axis=2) & (ids[at : at + 512] >= 0)).sum())
        for at in range(0, len(ids), 512)
    )
    return _posted([(to, STATE, 0, codes, ids, scores, None, ids, None, fresh)])


def _linked(salt: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tells nodes of the links to them; a hub of BACKLINKS from a block at most."""
    for batch in batches:
        mail = []
        for at in range(len(batch)):
            codes, ids, scores, _, _, to = _state(batch.iloc[at : at + 1])
            row, slot = np.nonzero(ids >= 0)
            members = ids[row, slot]
            chosen = _drawn(members, (to << SHIFT) + row, salt, BACKLINKS)
            row, slot, members = row[chosen], slot[chosen], members[chosen]
            positions, values = (members & ((1 << SHIFT) - 1)).astype(np.int32), scores[row, slot]
            mail += [
                (label, LINK, to, positions[own], row[own].astype(np.int32), values[own])
                for label, own in _dealt(members >> SHIFT)
            ]
            mail.append((to, STATE, 0, codes, ids, scores, None, ids))
        yield _posted(mail)


def _asked(salt: int, rows: pd.DataFrame) -> pd.DataFrame:
    """Takes links to a node as offers and BACKLINKS of them as links back; asks for codes."""
    codes, ids, scores, _, first, to = _state(rows)
    mail = rows[rows["what"] == LINK]
    at = _joined([np.frombuffer(x, np.int32) for x in mail["a"]], np.int32).astype(np.int64)
    sources = [(s << SHIFT) + np.frombuffer(x, np.int32).astype(np.int64) for s, x in zip(mail["source"], mail["b"])]
    sources = _joined(sources, np.int64)
    values = _joined([np.frombuffer(x, np.float32) for x in mail["c"]], np.float32)
    ids, scores = _with_offers(ids, scores, [at], [sources], [values])
    back = np.full((len(ids), BACKLINKS), -1, np.int64)
    chosen = _drawn((to << SHIFT) + at, sources, salt, BACKLINKS)
    back[at[chosen], _ranks(at[chosen])] = sources[chosen]
    for part in range(0, len(ids), 512):
        known = (back[part : part + 512, :, None] == ids[part : part + 512, None, :]).any(axis=2)
        back[part : part + 512][known] = -1
    needed = np.unique(np.concatenate([ids.ravel(), back.ravel()]))
    needed = needed[(needed >= 0) & (needed >> SHIFT != to)]
    positions = (needed & ((1 << SHIFT) - 1)).astype(np.int32)
    asked = [(label, ASK, to, positions[own]) for label, own in _dealt(needed >> SHIFT)]
    return _posted([(to, STATE, 0, codes, ids, scores, back, first), *asked])


def _answered(rows: pd.DataFrame) -> pd.DataFrame:
    """Sends the codes that were asked for, and what an offer to each node must exceed."""
    codes, ids, scores, back, first, to = _state(rows)
    mail = rows[rows["what"] == ASK]
    out = [(to, STATE, 0, codes, ids, scores, back, first)]
    for source, asked in zip(mail["source"], mail["a"]):
        at = np.frombuffer(asked, np.int32)
        out.append((int(source), CODES, to, at, codes[at], _least(ids[at], scores[at])))
    return _posted(out)


def _least(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    return np.where((ids >= 0).all(axis=1), scores.min(axis=1, initial=np.inf), -3.0).astype(np.float32)


def _known(rows: pd.DataFrame):
    """Places that a block knows, by place, their codes and least scores; and where the members of its
    nodes are among them, with whether there is one."""
    codes, ids, scores, back, _, to = _state(rows)
    mail = rows[rows["what"] == CODES].sort_values("source")
    places = [(to << SHIFT) + np.arange(len(ids), dtype=np.int64)]
    places += [(s << SHIFT) + np.frombuffer(x, np.int32).astype(np.int64) for s, x in zip(mail["source"], mail["a"])]
    known = np.concatenate([codes, *[np.frombuffer(x, np.uint8).reshape(-1, codes.shape[1]) for x in mail["b"]]])
    least = np.concatenate([_least(ids, scores), *[np.frombuffer(x, np.float32) for x in mail["c"]]])
    places = np.concatenate(places)
    order = np.argsort(places)
    places = places[order]
    members = np.concatenate([ids, back], axis=1)
    there = members >= 0
    index = np.where(there, np.searchsorted(places, members), 0)
    return places, known[order], least[order], index, there


def _met(rows: pd.DataFrame) -> pd.DataFrame:
    """Offers among the nodes that are linked with one."""
    codes, ids, scores, _, first, to = _state(rows)
    places, known, least, index, there = _known(rows)
    width = index.shape[1]
    at, new, values = [], [], []
    for part in range(0, len(index), MEETINGS):
        own, has = index[part : part + MEETINGS], there[part : part + MEETINGS]
        vectors = decode(known[own.ravel()]).reshape(len(own), width, -1)
        products = vectors @ vectors.transpose(0, 2, 1)
        products[~(has[:, :, None] & has[:, None, :])] = -np.inf
        products[:, np.arange(width), np.arange(width)] = -np.inf
        near = np.argpartition(products, width - OFFERS, axis=2)[:, :, -OFFERS:]
        near_scores = np.take_along_axis(products, near, axis=2)
        meeting, member, slot = np.nonzero(near_scores > least[own][:, :, None])
        at.append(own[meeting, member])
        new.append(own[meeting, near[meeting, member, slot]])
        values.append(near_scores[meeting, member, slot])
    at, new, values = _joined(at, np.int64), _joined(new, np.int64), _joined(values, np.float32)
    at, new, values = best(at, places[new], values, LINKS)
    mail = _offers(places[at], new, values)
    return _posted([(to, STATE, 0, codes, ids, scores, None, first), *mail])


#: A row of the graph: PAGE nodes of a block from ``first`` on, how many each is linked with, those and their codes.
GRAPH = "to int, first int, sizes binary, ids binary, codes binary"


def _pages(rows: pd.DataFrame) -> pd.DataFrame:
    to = int(rows["to"].iloc[0])
    places, known, _, index, there = _known(rows)
    pages = []
    for part in range(0, len(index), PAGE):
        has = there[part : part + PAGE]
        linked = index[part : part + PAGE][has]
        sizes = has.sum(axis=1).astype(np.int32)
        pages.append((to, part, sizes.tobytes(), places[linked].tobytes(), known[linked].tobytes()))
    return pd.DataFrame(pages, columns=[x.split()[0] for x in GRAPH.split(",")])


def _by_block(mail: DataFrame, blocks: int):
    return mail.repartition(blocks, "to").groupBy("to")


def _swept(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are done, which else stay until the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _answers(states: DataFrame, blocks: int, salt: int) -> DataFrame:
    """Mail after which each block knows the codes of all that its nodes are linked with."""
    mail = states.mapInPandas(partial(_linked, salt), MAIL)
    mail = _by_block(mail, blocks).applyInPandas(lambda rows: _asked(salt, rows), MAIL)
    return _by_block(mail, blocks).applyInPandas(_answered, MAIL)


def build_graph(nodes: DataFrame, labels: list[int], changed: float = CHANGED) -> tuple[DataFrame, float]:
    """Rows of GRAPH over nodes (to, place, embedding, norm), bucketed by block; the longest norm.

    Every round that is not the last brings new links nearer than those they replace, so rounds end.
    """
    spark, blocks = nodes.sparkSession, len(labels)
    size = nodes.agg(F.count("*").alias("n"), F.max("norm").alias("longest")).first()
    longest = size["longest"] or 1.0
    coded = saved(_coded(nodes, longest), "nn-coded")
    offers, used = _first_lists(coded, size["n"])
    states = saved(_by_block(offers.union(_unlisted(coded)), blocks).applyInPandas(_kept, MAIL), "nn-lists")
    discard(coded, *used)
    step = 0
    # One chunk has compared every node with every other one.
    while size["n"] > CHUNK:
        mail = _by_block(_answers(states, blocks, step), blocks).applyInPandas(_met, MAIL)
        before, states = states, saved(_by_block(mail, blocks).applyInPandas(_kept, MAIL), "nn-lists")
        discard(before)
        step += 1
        fresh = states.agg(F.sum("number")).first()[0]
        del mail, before
        _swept(spark)
        if fresh <= changed * LINKS * size["n"]:
            break

    graph = _by_block(_answers(states, blocks, step), blocks).applyInPandas(_pages, GRAPH)
    name = f"nn_graph_{uuid.uuid4().hex}"
    path = new_work_dir(spark, "nn-graph")
    # A task has the rows of one block, or of a few.
    writer = graph.write.bucketBy(blocks, "to").option("compression", "none")
    writer.option("path", path).format("parquet").saveAsTable(name)
    discard(states)
    del graph, writer
    _swept(spark)
    found = spark.table(name)
    found.saved_path, found.saved_name, found.pages = path, name, size["n"] / PAGE
    return found, longest


def drop_graph(graph: DataFrame) -> None:
    """Remove a graph that no plan will read any more."""
    graph.sparkSession.sql(f"drop table {graph.saved_name}")
    discard(graph)


def _started(queries: DataFrame, nodes: DataFrame, longest: float, labels: list[int]) -> DataFrame:
    """The state of a block of walks for each label, over queries (query, place, embedding), written.

    ``query`` is any long, unique; ``place`` is where it starts besides the entries.
    """

    def start(asked: pd.DataFrame, pool: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return _posted([])
        asked = asked.sort_values("query")
        vectors = np.stack(asked["embedding"].to_numpy()).astype(np.float64)
        vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        wide = np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1)
        # Its own node is opened first, whatever its norm.
        rows, ids, scores = [np.arange(len(asked))], [asked["place"].to_numpy()], [np.full(len(asked), 2.0)]
        if len(pool):
            entries, k = _lengthened(pool["embedding"], longest), min(ENTRIES, len(pool))
            products = wide @ entries.T
            near = np.argpartition(-products, k - 1, axis=1)[:, :k]
            rows.append(np.repeat(rows[0], k))
            ids.append(pool["place"].to_numpy()[near].ravel())
            scores.append(np.take_along_axis(products, near, axis=1).ravel())
        # Of two entries for one node, the one kept must not turn on their order.
        own = np.isin(np.concatenate(rows) << ROW | np.concatenate(ids), rows[0] << ROW | ids[0])
        rows, ids, scores = np.concatenate(rows), np.concatenate(ids), np.where(own, 2.0, np.concatenate(scores))
        rows, ids, scores = best(rows, ids, scores, BEAM)
        sizes = np.bincount(rows, minlength=len(asked)).astype(np.int32)
        state = (asked["query"].to_numpy(), wide.astype(np.float32), sizes, ids, scores, np.zeros(len(ids), bool))
        return _posted([(asked["to"].iloc[0], STATE, 0, *state, len(ids))])

    draw = F.pmod(F.xxhash64("place", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    drawn = nodes.where(draw < len(labels) * POOL / max(nodes.count(), 1))
    drawn = drawn.select(_label(labels, "place", F.lit(2)).alias("to"), "place", "embedding").groupBy("to")
    dealt = queries.select(_label(labels, "query").alias("to"), "query", "place", "embedding").groupBy("to")
    return saved(dealt.cogroup(drawn).applyInPandas(start, MAIL), "nn-beams")


def _walks(rows: pd.DataFrame):
    """Of states of walks: queries, ascending, directions; walk, id, score and flag of all they keep."""
    sizes = [np.frombuffer(x, np.int32) for x in rows["c"]]
    queries = np.concatenate([np.frombuffer(x, np.int64) for x in rows["a"]])
    vectors = np.concatenate([_matrix(x, np.float32, len(n)) for x, n in zip(rows["b"], sizes)])
    ids, scores, opened = (
        np.concatenate([np.frombuffer(x, kind) for x in rows[name]])
        for name, kind in (("d", np.int64), ("e", np.float32), ("f", np.bool_))
    )
    order, sizes = np.argsort(queries), np.concatenate(sizes)
    if len(rows) > 1:
        starts = (np.cumsum(sizes) - sizes)[order]
        sizes = sizes[order]
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        queries, vectors, ids, scores, opened = queries[order], vectors[order], ids[at], scores[at], opened[at]
    return queries, vectors, np.repeat(np.arange(len(sizes)), sizes), ids, scores, opened


def _to_open(width: int, walks: np.ndarray, opened: np.ndarray, queries: int) -> np.ndarray:
    """Where the nodes are that walks open next, the nearest of their beams that are not open: as many as
    they have opened."""
    closed = np.flatnonzero((_ranks(walks) < width) & ~opened)
    most = np.maximum(np.bincount(walks[opened], minlength=queries), ENTRIES + 1)
    return closed[_ranks(walks[closed]) < most[walks[closed]]]


def _bars(kept: int, walks: np.ndarray, scores: np.ndarray, queries: int) -> np.ndarray:
    """What a walk need not be told of: the last that it keeps, or what that will be, for scores fall
    evenly as ranks double."""
    sizes = np.bincount(walks, minlength=queries)
    ends = np.cumsum(sizes)
    bars = np.full(queries, -3.0, np.float32)
    some = sizes >= BEAM // 2
    last, middle = scores[ends[some] - 1], scores[ends[some] - sizes[some] + sizes[some] // 2]
    bars[some] = np.where(sizes[some] >= kept, last, 2 * last - middle)
    return bars


def _moves(width: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sends walks to the blocks of the nodes that they open."""
    for batch in batches:
        mail = []
        for i in range(len(batch)):
            queries, vectors, walks, ids, scores, opened = _walks(batch.iloc[i : i + 1])
            chosen = _to_open(width, walks, opened, len(queries))
            bars = _bars(int(width * WIDER), walks, scores, len(queries))
            walks, ids = walks[chosen], ids[chosen]
            positions = (ids & ((1 << SHIFT) - 1)).astype(np.int32)
            for label, at in _dealt(ids >> SHIFT):
                own, slots = np.unique(walks[at], return_inverse=True)
                mail.append(
                    (label, MOVE, int(batch["to"].iloc[i]), queries[own], vectors[own], bars[own], slots.astype(np.int32), positions[at])
                )
        yield _posted(mail)


def _wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(to, first) of the pages that moves ask for."""
    for batch in batches:
        for to, nodes in zip(batch["to"], batch["e"]):
            first = np.unique(np.frombuffer(nodes, np.int32) // PAGE * PAGE)
            yield pd.DataFrame({"to": np.full(len(first), to, np.int32), "first": first})


def _looked_at(kept: int, hot: int, pages: pa.Table, moves: pa.Table) -> pa.Table:
    """Of the nodes linked with opened ones, those near enough for the walks."""
    mail = []
    if moves.num_rows and pages.num_rows:
        mail = _near(kept, hot, pages.to_pylist(), moves.to_pylist())
    return pa.Table.from_pandas(_posted(mail), _MAIL, preserve_index=False)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_MAIL = pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in MAIL.split(","))])


def _near(kept: int, hot: int, pages: list[dict], moves: list[dict]) -> list[tuple]:
    """Offers to walks, as many as they keep at most, scored with ``hot`` of them at a time."""
    walks = [np.frombuffer(x["a"], np.int64) for x in moves]
    sizes = [len(x) for x in walks]
    starts = np.cumsum([0, *sizes])
    vectors = np.concatenate([_matrix(x["b"], np.float32, n) for x, n in zip(moves, sizes)])
    bars = np.concatenate([np.frombuffer(x["c"], np.float32) for x in moves])
    slots = np.concatenate([np.frombuffer(x["d"], np.int32) + a for x, a in zip(moves, starts)])
    nodes = np.concatenate([np.frombuffer(x["e"], np.int32) for x in moves])
    order = np.argsort(nodes, kind="stable")
    slots, nodes = slots[order], nodes[order]
    at, new, values = [], [], []
    for page in pages:
        degrees = np.frombuffer(page["sizes"], np.int32)
        bounds = np.searchsorted(nodes, np.arange(page["first"], page["first"] + len(degrees) + 1))
        ends = np.cumsum(degrees)
        if bounds[0] == bounds[-1] or not ends[-1]:
            continue
        ids = np.frombuffer(page["ids"], np.int64)
        near = decode(_matrix(page["codes"], np.uint8, len(ids)))
        for first, last, a, b in zip(bounds, bounds[1:], ends - degrees, ends):
            for part in range(first, last, hot):
                who = slots[part : min(part + hot, last)]
                scores = vectors[who] @ near[a:b].T
                walk, linked = np.nonzero(scores > bars[who][:, None])
                at.append(who[walk])
                new.append(ids[a:b][linked])
                values.append(scores[walk, linked])
    at, new, values = _joined(at, np.int64), _joined(new, np.int64), _joined(values, np.float32)
    at, new, values = best(at, new, values, kept)
    mail = []
    bounds = np.searchsorted(at, starts)
    for x, own, start, a, b in zip(moves, walks, starts, bounds, bounds[1:]):
        if a < b:
            mail.append((x["source"], OFFER, 0, own[at[a:b] - start], new[a:b], values[a:b]))
    return mail


def _opened(width: int, rows: pd.DataFrame) -> pd.DataFrame:
    """Walks after a step: what was opened, what was found."""
    to = int(rows["to"].iloc[0])
    queries, vectors, walks, ids, scores, opened = _walks(rows[rows["what"] != OFFER])
    opened[_to_open(width, walks, opened, len(queries))] = True
    mail = rows[rows["what"] == OFFER]
    new_walks = np.searchsorted(queries, _joined([np.frombuffer(x, np.int64) for x in mail["a"]], np.int64))
    new_ids = _joined([np.frombuffer(x, np.int64) for x in mail["b"]], np.int64)
    new_scores = _joined([np.frombuffer(x, np.float32) for x in mail["c"]], np.float32)
    # The score of a query's own node, the first, is not that of its code.
    other = new_ids != ids[np.searchsorted(walks, np.arange(len(queries)))][new_walks]
    # Of a node that is kept and found again, the one that says whether it is open comes first.
    walks, ids, scores = best(
        np.concatenate([walks, new_walks[other]]),
        np.concatenate([ids << 1 | ~opened, new_ids[other] << 1 | 1]),
        np.concatenate([scores, new_scores[other]]),
        int(width * WIDER),
        same=1,
    )
    ids, opened = ids >> 1, ids & 1 == 0
    closed = walks[(_ranks(walks) < width) & ~opened]
    going = np.zeros(len(queries), bool)
    going[closed] = True
    sizes = np.bincount(walks, minlength=len(queries)).astype(np.int32)
    out = []
    for what, some in ((STATE, going), (ENDED, ~going)):
        if some.any():
            own = some[walks]
            state = (queries[some], vectors[some], sizes[some], ids[own], scores[own], opened[own])
            out.append((to, what, 0, *state, len(closed) if what == STATE else 0))
    return _posted(out)


def _walked(
    walks: list[DataFrame], graph: DataFrame, width: int, blocks: int, walk_blocks: int, most: int
) -> list[DataFrame]:
    """The written tables that have the walks, after steps until no more than so many nodes of beams are not open.

    The given ones are among them; walks that the last of these has, not at their end, go on.

    A walk ends when all of its beam is open: what it no longer keeps cannot come back, so each does.
    """
    spark, kept, hot = graph.sparkSession, int(width * WIDER), HOT
    *ended, walks = walks
    left = walks.where(F.col("what") == STATE).agg(F.sum("number")).first()[0] or 0
    while left > most:
        going = walks.where(F.col("what") == STATE)
        moves = going.mapInPandas(partial(_moves, width), MAIL)
        pages = graph
        if left < graph.pages / 2:
            # So few nodes are opened that much of the graph need not reach the walks.
            wanted = moves.select("to", "e").mapInPandas(_wanted, "to int, first int").distinct()
            pages = graph.join(F.broadcast(wanted), ["to", "first"], "left_semi")
        near = pages.groupBy("to").cogroup(_by_block(moves, blocks))
        found = near.applyInArrow(lambda pages, moves: _looked_at(kept, hot, pages, moves), MAIL)
        # Walks meet their offers in the one shuffle of these.
        after = _by_block(going.union(found), walk_blocks).applyInPandas(lambda rows: _opened(width, rows), MAIL)
        ended.append(walks)
        walks = saved(after, "nn-beams")
        left = walks.where(F.col("what") == STATE).agg(F.sum("number")).first()[0] or 0
        del going, moves, pages, near, found, after
        _swept(spark)
    return [*ended, walks]


def _gathered(tables: list[DataFrame]) -> DataFrame:
    """All walks, once each: at their end, or as the last table has them."""
    *before, last = tables
    return reduce(DataFrame.union, [*[x.where(F.col("what") == ENDED) for x in before], last])


def _ends(walks: DataFrame) -> DataFrame:
    """(query, place): the nearest nodes that each walk has, SCORED at most."""

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):
                queries, _, walks, ids, _, _ = _walks(batch.iloc[i : i + 1])
                first = _ranks(walks) < SCORED
                yield pd.DataFrame({"query": queries[walks[first]], "place": ids[first]})

    return walks.mapInPandas(ends, "query long, place long")


def _exact_nodes(sample: pd.DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(query, near): the k nodes nearest to each query of the sample but its own, by comparing all."""
    queries = sample["query"].to_numpy()
    own = sample["place"].to_numpy()
    vectors = np.stack(sample["embedding"].to_numpy()).astype(np.float64)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # What a task has met so far, k for each query.
        met = np.full((len(queries), k), -np.inf)
        ids = np.zeros((len(queries), k), np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                names = part["place"].to_numpy()
                scores = vectors @ np.stack(part["embedding"].to_numpy()).astype(np.float64).T
                scores[own[:, None] == names[None, :]] = -np.inf
                scores = np.concatenate([met, scores], axis=1)
                names = np.concatenate([ids, np.broadcast_to(names, (len(queries), len(names)))], axis=1)
                chosen = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                met = np.take_along_axis(scores, chosen, axis=1)
                ids = np.take_along_axis(names, chosen, axis=1)
        there = np.isfinite(met)
        yield pd.DataFrame(
            {"query": np.repeat(queries, there.sum(axis=1)), "near": ids[there], "score": met[there]}
        )

    found = nodes.select("place", "embedding").mapInPandas(compare, "query long, near long, score double")
    nth = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "near"))
    return found.withColumn("nth", nth).where(F.col("nth") <= k).select("query", "near")


def searched(
    queries: DataFrame, nodes: DataFrame, graph: DataFrame, longest: float, blocks: int, k: int
) -> DataFrame:
    """(query, place): what each query of (query, place, embedding) finds, written, with beams as wide
    as a sample of at most SAMPLE queries asks for."""
    spark = graph.sparkSession
    chosen = queries.orderBy(F.xxhash64("query"), "query").limit(SAMPLE)
    chosen = saved(chosen.select("query", "place", "embedding"), "nn-sample")
    exact = saved(_exact_nodes(chosen.toPandas(), nodes, k), "nn-exact")
    total, beam, before = max(exact.count(), 1), BEAM, 0.0
    count = queries.count()
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // 64))
    labels = _labels(spark, max(-(-count // SHARING), few, 1))
    walks = [_started(queries, nodes, longest, labels)]
    while True:
        walks = _walked(walks, graph, beam, blocks, len(labels), int(count * beam * LATE))
        near = _ends(_gathered(walks)).join(F.broadcast(chosen.select("query")), "query", "left_semi")
        recall = exact.join(near.withColumnRenamed("place", "near"), ["query", "near"], "left_semi").count() / total
        if recall >= RECALL or recall < before + GAIN:
            break
        before, beam, narrower = recall, int(beam * WIDER), walks
        # More of what they keep is to be opened.
        again = _gathered(walks).withColumn("what", F.lit(STATE)).withColumn("number", F.lit(count * beam).cast("long"))
        walks = [saved(again, "nn-beams")]
        discard(*narrower)
    walks = _walked(walks, graph, beam, blocks, len(labels), 0)
    found = saved(_ends(_gathered(walks)), "nn-ends")
    discard(chosen, exact, *walks)
    return found


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def nearest_rows(vectors: DataFrame, queries: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` selects its k nearest others.

    ``queries`` is a condition on vec_id. Nearest first, ties to the smaller vec_id; fewer where there
    are fewer. Unusable vectors (see ``usable``) and those without vec_id take no part; a query has
    the vectors of its own number of coordinates for candidates, and each such number a graph of its
    own. All rows of a query's vec_id are its own; rows that repeat a vec_id and its vector count once.
    """
    ship_code(vectors.sparkSession)
    rows = vectors.select("vec_id", "embedding").where("vec_id is not null")
    rows = rows.where(usable(F.col("embedding"))).withColumn("n", F.size("embedding"))
    lengths = rows.where(queries).select("n").distinct().orderBy("n").collect()
    found = [_nearest_of_length(rows.where(F.col("n") == x["n"]).drop("n"), queries, k) for x in lengths]
    if not found:
        shape = f"query_id {dict(rows.dtypes)['vec_id']}, rank int, vec_id {dict(rows.dtypes)['vec_id']}, score double"
        return vectors.sparkSession.createDataFrame([], shape)
    return reduce(DataFrame.union, found)


def _nearest_of_length(rows: DataFrame, queries: Column, k: int) -> DataFrame:
    distinct = saved(nodes_of(rows), "nn-distinct")
    nodes, labels = placed(distinct)
    discard(distinct)
    graph, longest = build_graph(nodes, labels)
    try:
        node = F.xxhash64("embedding")
        asked = rows.where(queries).distinct().withColumn("node", node)
        asked = saved(asked.withColumn("query", F.xxhash64("node", "embedding")), "nn-queries")
        # Rows of equal vectors walk as one.
        walks = asked.select("query", "node", "embedding").distinct()
        walks = walks.join(nodes.select("place", "node", "embedding"), ["node", "embedding"])
        walks = saved(walks.select("query", "place", "embedding"), "nn-walks")
        places = searched(walks, nodes, graph, longest, len(labels), k)
    finally:
        drop_graph(graph)
    ends = saved(
        places.join(nodes.select("place", "node", F.col("embedding").alias("near")), "place"), "nn-near"
    )
    discard(places)
    # The smallest ids of equal vectors; a query needs k of them besides its own.
    by_id = W.partitionBy("node", "embedding").orderBy("vec_id")
    copies = (
        rows.withColumn("node", node)
        .join(ends.select("node").distinct(), "node", "left_semi")
        .distinct()
        .withColumn("nth", F.row_number().over(by_id))
        .where(F.col("nth") <= k + 1)
    )
    scored = (
        ends.join(walks.drop("place"), "query")
        .select("query", "node", "near", inner_product(F.col("embedding"), F.col("near")).alias("score"))
    )
    # A node's copies are those of its very vector, should two vectors share a hash.
    named = scored.join(
        copies.select("node", F.col("embedding").alias("near"), "vec_id"), ["node", "near"]
    )
    # Rows of a query's own vec_id are among them, one for each of its vectors.
    own = asked.groupBy("vec_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    nth = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    top = named.withColumn("nth", nth).where(F.col("nth") <= k + own)
    # Written, so that the rows of one vector can be split over tasks.
    top = saved(top.select("query", "vec_id", "score"), "nn-top")
    discard(ends, nodes, walks)
    by_score = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select("query", F.col("vec_id").alias("query_id"))
        .join(top, "query")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    return nearest_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
