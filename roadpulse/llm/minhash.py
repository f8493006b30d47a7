"""Operator 5: near-duplicate documents by min-max hashing, banding and exact confirmation.

Each random permutation of the shingles gives two signature values, the smallest and the largest
image, so half as many permutations are evaluated as values are kept; the two are unbiased and,
being negatively correlated, vary less together than two independent minima. Runs of values form
bands; documents that share a band are candidates, and every link is confirmed on the full sets.

How the work stays in proportion to the input:

* Documents with equal sets become one *class* by a 128-bit digest (partial aggregation, so a
  class of any size costs a row per task); only one member goes on.
* In a bucket (documents that share a band) each member is first compared with the bucket's
  smallest member only. Links found join components, and later passes compare nothing within
  one component: a bucket of thousands of near copies costs a row per member, not per pair.
* What is left are buckets that hold several components. Documents that such buckets connect
  form a *field*; the last pass compares all its members of different components in blocks of
  bounded size, inside tasks, and emits links that join components only. So no candidate is left
  untested and no pair is emitted to be tested, even where thousands of documents are just
  below the threshold. A field of n documents takes (n / CHUNK)^2 / 2 blocks.
* Joins on bucket keys read both sides from written tables, so a skewed side can be split.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import (
    ASCII_LOWER,
    ASCII_UPPER,
    connected_components,
    discard,
    named,
    saved,
    ship_code,
    table,
)

SHINGLE_WORDS = 4
#: Links need 100 * intersection >= SIMILAR * union.
SIMILAR = 80
#: A band of six values is missed by a pair of similarity 0.8 with 1 - 0.8**6; all 40 with 5e-6.
BANDS, BAND_VALUES = 40, 6
#: Bands whose buckets are compared first, to find the components of large groups cheaply.
FIRST_BANDS = 8
#: Documents of a field that stand on each side of a block, on average.
CHUNK = 128
#: Bytes of text that a task holds expanded at a time (a longer text is taken alone).
SLICE_BYTES = 1 << 20

_random = np.random.default_rng(20240517)  # fixed: signatures of different runs must agree
_PERMUTATIONS = BANDS * BAND_VALUES // 2
_FACTORS = _random.integers(0, 1 << 32, _PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_TERMS = _random.integers(0, 1 << 32, _PERMUTATIONS, dtype=np.uint32)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[[0x20, *range(0x09, 0x0E)]] = 0
_BASE, _STEP = (np.uint64(x) | np.uint64(1) for x in _random.integers(1 << 60, 1 << 63, 2))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (the public splitmix64 finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), _BASE)]))


def shingle_sets(texts: list[str | None], words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes (none for an empty text).

    Words are what ASCII white space separates, A-Z lower-cased. A text with fewer words than
    a shingle has its whole sequence as one. The texts of a slice are hashed together.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode().lower()
        if held and size + len(data) > SLICE_BYTES:
            yield from _slice_sets(held, words)
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield from _slice_sets(held, words)


def _slice_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if len(starts):
        ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        lengths = ends - starts
        place = np.arange(len(data), dtype=np.int64)
        place -= np.repeat(
            np.concatenate([[0], starts]),
            np.diff(np.concatenate([[0], starts, [len(data)]])),
        )
        values = _BYTES[data] * _powers(int(lengths.max()) + 1)[
            np.minimum(place, int(lengths.max()))
        ]
        hashes = _mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64))
    else:
        hashes = np.empty(0, np.uint64)
    firsts = np.cumsum([1, *(len(x) + 1 for x in texts)])
    bounds = np.searchsorted(starts, firsts)
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = hashes[a:b]
        if not len(own):
            yield own
            continue
        n = min(words, len(own))
        mixed = np.full(len(own) - n + 1, n, np.uint64)
        for k in range(n):
            mixed = mixed * _STEP + own[k : len(own) - n + 1 + k]
        yield np.unique(_mix(mixed))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest and largest image of the shingles under each permutation, two rows."""
    low = np.full(_PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    high = np.zeros(_PERMUTATIONS, np.uint32)
    points = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(points), 4096):
        images = points[None, at : at + 4096] * _FACTORS[:, None] + _TERMS[:, None]
        np.minimum(low, images.min(axis=1), out=low)
        np.maximum(high, images.max(axis=1), out=high)
    return np.stack([low, high])


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; a band's values come from as many permutations, all of one kind."""
    runs = values.reshape(BANDS, BAND_VALUES).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_VALUES):
        keys = _mix(keys * _STEP + runs[:, k])
    return keys.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Of each row: doc_id, size, digest and band keys of its set. Few texts are held at a time."""
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            n, digests, keys = [], [], []
            for shingles in shingle_sets(part.column("text").to_pylist(), words):
                n.append(len(shingles))
                known = len(shingles) > 0
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if known else None)
                keys.append(band_keys(signature(shingles)) if known else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "digest", "keys"],
            )


def _sets(batches: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 64):
            part = batch.iloc[at : at + 64]
            found = [x.view(np.int64) for x in shingle_sets(list(part["text"]), words)]
            yield pd.DataFrame({"id": part["id"], "shingles": found})


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Rows of equal doc_id count as one document. A row without words is linked with nothing; one
    without doc_id too, and its component_id is null and it is kept. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    signed = saved(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            partial(_sign, words=words), "doc_id long, n_shingles long, digest binary, keys array<long>"
        ),
        "minhash-signed",
    )
    classes = saved(
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n")),
        "minhash-classes",
    )
    links, used = _links(docs, signed, classes, words)
    links = saved(links, "minhash-found")
    discard(*used)
    # Rows of one doc_id that differ in text: their classes are linked through the document.
    placed = signed.where("digest is not null and doc_id is not null").join(
        classes.select("digest", "id"), "digest"
    )
    several = placed.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("most"))
    several = several.where("a < most").select("doc_id", "a")
    same = several.join(placed, "doc_id").select("a", F.col("id").alias("b")).where("a <> b")
    parts = connected_components(links.union(same), "minhash")
    roots = classes.join(parts, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component_id")
    )
    roots = saved(roots, "minhash-roots")
    discard(links, classes, parts)
    rows = signed.drop("keys").join(roots, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(
    docs: DataFrame, signed: DataFrame, classes: DataFrame, words: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Confirmed links (a, b) between classes, enough of them to give every component, and the
    written tables that they are read from."""
    wanted = signed.where("digest is not null and doc_id is not null").join(
        classes.select("digest", "id"), "digest"
    )
    one = wanted.where("doc_id = id").dropDuplicates(["digest"])
    keyed = one.select(
        "id", F.col("n_shingles").alias("n"), F.posexplode("keys").alias("band", "key")
    )
    keyed = saved(
        keyed.select("id", "n", "key", (F.col("band") < FIRST_BANDS).alias("early")),
        "minhash-bands",
    )
    buckets = saved(
        keyed.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"),
        "minhash-buckets",
    )
    members = saved(keyed.join(buckets, "key"), "minhash-members")
    discard(keyed, buckets)
    ids = saved(members.select("id").distinct(), "minhash-ids")
    sets = saved(
        docs.withColumnRenamed("doc_id", "id")
        .join(ids, "id", "left_semi")
        .dropDuplicates(["id", "text"])
        .mapInPandas(partial(_sets, words=words), "id long, shingles array<long>")
        .where(F.size("shingles") > 0),
        "minhash-sets",
    )
    parts = None
    for rows in (members.where("early"), members):
        found = saved(_confirmed(_star_pairs(rows, parts), sets), "minhash-found")
        links = found if parts is None else found.union(_star_edges(parts))
        before, parts = parts, connected_components(links, "minhash")
        discard(found, *([] if before is None else [before]))
    # What the stars link, and what blocks add to it.
    links = _star_edges(parts).union(_block_links(members, parts, sets))
    return links, [members, ids, sets, parts]


def _star_edges(parts: DataFrame) -> DataFrame:
    return parts.select(F.col("id").alias("a"), F.col("component").alias("b"))


def _with_components(rows: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Rows with the component of their ``id``: itself where nothing is linked with it."""
    if parts is None:
        return rows.withColumn("component", F.col("id"))
    return rows.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _mixed(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    """(key, id, n, component, center) of the buckets that hold several components."""
    placed = _with_components(members.select("id", "n", "key"), parts)
    mixed = (
        placed.groupBy("key")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.min(F.struct("id", "n", "component")).alias("center"),
        )
        .where("least < most")
    )
    return placed.join(saved(mixed.select("key", "center"), "minhash-mixed"), "key")


def _star_pairs(members: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Pairs (a < b) of a bucket's smallest member and its members of other components.

    Pairs whose sizes alone rule a link out are left out: exact.
    """
    pairs = _mixed(members, parts).where(
        (F.col("center.component") != F.col("component"))
        & (100 * F.least("n", "center.n") >= SIMILAR * F.greatest("n", "center.n"))
    )
    return pairs.select(F.col("center.id").alias("a"), F.col("id").alias("b")).distinct()


def _block_links(members: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components that are left when all members of a field are compared."""
    mixed = _mixed(members, parts).select("id", F.col("center.id").alias("center"))
    mixed = saved(mixed.distinct(), "minhash-open")
    fields = connected_components(
        mixed.select(F.col("id").alias("a"), F.col("center").alias("b")), "minhash-fields"
    )
    fields = fields.withColumnRenamed("component", "field")
    sizes = fields.groupBy("field").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    sizes = saved(sizes, "minhash-sizes")
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    placed = _with_components(fields.join(sizes, "field"), parts).withColumn("chunk", chunk)
    blocks = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    blocks = blocks.select(
        "field",
        F.least("chunk", "other").alias("i"),
        F.greatest("chunk", "other").alias("j"),
        "chunk",
        "id",
        "component",
    )
    return (
        blocks.join(sets, "id")
        .groupBy("field", "i", "j")
        .applyInPandas(_compare_block, "a long, b long")
    )


def _compare_block(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that join components, among rows of one chunk or between those of two.

    Shared shingles of a row with all rows before it are counted at once: the row's shingles
    are looked up in the sorted shingles of the block, which know whose they are.
    """
    rows = rows.sort_values("id", ignore_index=True)
    sets = [np.asarray(x) for x in rows["shingles"]]
    sizes = np.array([len(x) for x in sets])
    owners = np.repeat(np.arange(len(sets)), sizes)
    shingles = np.concatenate(sets)
    order = np.argsort(shingles, kind="stable")
    shingles, owners = shingles[order], owners[order]
    ids, parts = rows["id"].to_numpy(), rows["component"].to_numpy().copy()
    chunks = rows["chunk"].to_numpy()
    two = rows["i"].iloc[0] != rows["j"].iloc[0]
    found = []
    for at, own in enumerate(sets):
        first, last = np.searchsorted(shingles, own), np.searchsorted(shingles, own, "right")
        n = last - first
        places = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        shared = np.bincount(owners[places], minlength=len(sets))
        union = sizes + sizes[at] - shared
        like = (100 * shared >= SIMILAR * union) & (np.arange(len(sets)) < at)
        if two:
            like &= chunks != chunks[at]
        for other in np.flatnonzero(like):
            if parts[other] != parts[at]:
                found.append((ids[other], ids[at]))
                parts[parts == parts[at]] = parts[other]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    with_b = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b")), "b")
    both = with_b.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a")), "a")
    shared = both.select(
        "a",
        "b",
        F.size(F.array_intersect("of_a", "of_b")).alias("shared"),
        (F.size("of_a") + F.size("of_b")).alias("total"),
    )
    return shared.where(100 * F.col("shared") >= SIMILAR * (F.col("total") - F.col("shared"))).select(
        "a", "b"
    )


def one_per_group(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` but one row for each component: all columns, nothing else changes.

    Rows that repeat a kept doc_id and its text go too; other texts of that doc_id stay, and so does a
    row without doc_id.
    """
    ship_code(docs.sparkSession)
    groups = near_duplicates(docs, words).where("kept").select("doc_id").distinct()
    digest = "_digest_of_text"
    with_id = docs.where("doc_id is not null").withColumn(digest, F.xxhash64("text"))
    with_id = with_id.dropDuplicates(["doc_id", digest])
    return with_id.join(groups, "doc_id", "left_semi").select(named(docs)).unionByName(
        docs.where("doc_id is null")
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP5_SQL = f"""
with recursive words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^ \\t-\\r]+') as w
    from documents
), sets as (
    select doc_id, case
        when len(w) = 0 then []::varchar[]
        when len(w) < {SHINGLE_WORDS} then [array_to_string(w, ' ')]
        else list_distinct(list_transform(
            range(1, len(w) - {SHINGLE_WORDS - 2}),
            lambda i: array_to_string(w[i:i + {SHINGLE_WORDS - 1}], ' '))) end as s
    from words
), grams as (
    select doc_id, unnest(s) as gram from sets
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id
), links as (
    select a, b from shared
    join sets x on x.doc_id = a join sets y on y.doc_id = b
    where 100 * n >= {SIMILAR} * (len(x.s) + len(y.s) - n)
), reach(doc_id, other) as (
    select doc_id, doc_id from sets
    union
    select reach.doc_id, links.b from reach join links on links.a = reach.other
), least as (
    select doc_id, min(other) as component_id from reach group by doc_id
)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept
from sets join least using (doc_id)
"""
