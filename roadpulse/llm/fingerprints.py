"""Operator 12: document fingerprints by invertible Bloom lookup sketches.

A text is a multiset of paragraphs: lines, cut further at the ends of sentences and after
``WORDS`` words, so that a text without line ends has several, too. Each paragraph's digest is a key
(the second of equal paragraphs another one than the first), put into one cell of each of three
tables. A cell keeps the number of its keys, their sum and the sum of their check values, so the
sketches of two versions subtract cell by cell, and what both hold cancels out. Cells that are left
with one key give it away; taking it out of its other cells opens further ones, and so on: this
peeling recovers the digests of the paragraphs that differ, and from them the likeness.

The fingerprint is the sketch of ``CELLS`` cells a table. It is enough where few paragraphs differ,
however long the texts are. Where peeling stops before all cells are empty, both versions are
sketched again in tables ``GROWTH`` times as large, until it succeeds; no difference is given up.

Cells of many documents are kept in one array, and peeled together. Texts are compared with the
next document's: a pass over the ids finds where ranges of them begin, and texts are then dealt to the
ranges once and read in order, the first text of each range also at the end of the one before.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import ship_code, table

#: Cells of one table in a fingerprint, a power of two, and by how much a larger sketch has more.
CELLS, GROWTH = 8, 4
TABLES = 3
#: Words of a paragraph at most.
WORDS = 8
#: Rows whose sketches are held at a time, and code points of their texts, beyond the first.
HELD_ROWS, HELD_CHARS = 256, 1 << 20
#: Bytes of text in a range of documents that are read in order, on average.
RANGE_BYTES = 16 << 20

# Fingerprints of different runs must agree.
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_CHECK = np.uint64(0x27D4EB2F165667C5)
_REPEAT = np.uint64(0xD6E8FEB86659FD93)

SENTENCE = re.compile(r"(?<=[.!?])\s+")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (the public splitmix64 finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paragraphs(text: str) -> Iterator[str]:
    """Pieces of whole words with single spaces; white space alone makes none."""
    for line in text.splitlines():
        for sentence in SENTENCE.split(line):
            words = sentence.split()
            for at in range(0, len(words), WORDS):
                yield " ".join(words[at : at + WORDS])


def digests(text: str) -> np.ndarray:
    """One 64-bit key per paragraph; equal paragraphs have keys by their number."""
    digest = xxhash.xxh3_64_intdigest
    found = np.array([digest(piece.encode()) for piece in paragraphs(text)], np.uint64)
    found.sort()
    # How many equal ones stand before each.
    new = np.concatenate([[True], found[1:] != found[:-1]])[: len(found)]
    starts = np.flatnonzero(new)
    before = np.arange(len(found)) - starts[np.cumsum(new) - 1] if len(found) else starts
    return np.where(before > 0, _mix(found + before.astype(np.uint64) * _REPEAT), found)


def check_of(keys: np.ndarray) -> np.ndarray:
    return _mix(keys ^ _CHECK).astype(np.uint32)


def places_of(rows: np.ndarray, keys: np.ndarray, cells: int) -> list[np.ndarray]:
    """Cell of each key in each table, all rows' tables lying one after the other."""
    first = rows * (TABLES * cells)
    within = [(_mix(keys ^ seed) & np.uint64(cells - 1)).astype(np.int64) for seed in _SEEDS]
    return [first + table * cells + at for table, at in enumerate(within)]


class Sketches:
    """Cells of several sketches of one size."""

    def __init__(self, count: int, cells: int):
        self.cells, self.count = cells, count
        size = count * TABLES * cells
        self.n, self.key, self.check = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint32)

    def add(self, rows: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        """Put keys into the sketches of their rows, or with sign -1 take them out."""
        sign = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        signed = keys * sign.astype(np.uint64)
        checks = check_of(keys) * sign.astype(np.uint32)
        for places in places_of(rows, keys, self.cells):
            np.add.at(self.n, places, sign)
            np.add.at(self.key, places, signed)
            np.add.at(self.check, places, checks)

    @classmethod
    def of(cls, sets: list[np.ndarray], cells: int) -> Sketches:
        made = cls(len(sets), cells)
        rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        made.add(rows, np.concatenate([*sets, np.zeros(0, np.uint64)]))
        return made

    def minus(self, other: Sketches) -> Sketches:
        left = Sketches(self.count, self.cells)
        left.n, left.key, left.check = self.n - other.n, self.key - other.key, self.check - other.check
        return left

    def pick(self, rows: np.ndarray) -> Sketches:
        """The sketches of some rows, which may be the same one twice."""
        picked = Sketches(len(rows), self.cells)
        for name in ("n", "key", "check"):
            setattr(picked, name, getattr(self, name).reshape(self.count, -1)[rows].reshape(-1))
        return picked

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Empties the cells: (whether all of a sketch are empty, rows, keys and signs recovered)."""
        rows, keys, signs = [], [], []
        look = np.flatnonzero(self.n)
        # A sketch gives no more keys than this even if a false one lets it go round.
        for _ in range(TABLES * self.cells + 1):
            sign = self.n[look]
            key = self.key[look] * sign.astype(np.uint64)
            alone = (np.abs(sign) == 1) & (check_of(key) * sign.astype(np.uint32) == self.check[look])
            row, key, sign = look[alone] // (TABLES * self.cells), key[alone], sign[alone]
            if not len(row):
                break
            # The same key may stand alone in more than one table.
            order = np.lexsort((key, row))
            row, key, sign = row[order], key[order], sign[order]
            first = np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])
            row, key, sign = row[first], key[first], sign[first]
            self.add(row, key, -sign)
            rows.append(row), keys.append(key), signs.append(sign)
            look = np.unique(np.concatenate(places_of(row, key, self.cells)))
        filled = (self.n != 0) | (self.key != 0) | (self.check != 0)
        empty = ~filled.reshape(self.count, -1).any(axis=1)
        none = np.zeros(0, np.int64)
        return (
            empty,
            np.concatenate([none, *rows]),
            np.concatenate([none.astype(np.uint64), *keys]),
            np.concatenate([none, *signs]),
        )

    def packed(self) -> list[bytes]:
        """Each sketch as bytes: all its numbers of keys, then all sums, then all check values."""
        parts = (self.n.astype("<i4"), self.key.astype("<u8"), self.check.astype("<u4"))
        rows = [part.reshape(self.count, -1) for part in parts]
        return [b"".join(part[at].tobytes() for part in rows) for at in range(self.count)]

    def texts(self) -> list[str]:
        """The same in base 64."""
        return [base64.b64encode(sketch).decode() for sketch in self.packed()]

    @classmethod
    def read(cls, text: str) -> Sketches:
        """One sketch back from its text."""
        data = base64.b64decode(text)
        size = len(data) // 16
        made = cls(1, size // TABLES)
        made.n = np.frombuffer(data, "<i4", size).astype(np.int64)
        made.key = np.frombuffer(data, "<u8", size, 4 * size).copy()
        made.check = np.frombuffer(data, "<u4", size, 12 * size).copy()
        return made


def differences(
    base: Sketches, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of rows the keys that only the left one has, and only the right one.

    ``base`` holds the fingerprints of ``sets``; they alone are tried first.
    """
    found: list = [None] * len(left)
    waiting, cells, made = np.arange(len(left)), base.cells, base
    while len(waiting):
        diff = made.pick(left[waiting]).minus(made.pick(right[waiting]))
        empty, rows, keys, signs = diff.peel()
        order = np.argsort(rows, kind="stable")
        rows, keys, signs = rows[order], keys[order], signs[order]
        bounds = np.searchsorted(rows, np.arange(len(waiting) + 1))
        for at in np.flatnonzero(empty):
            key, sign = (x[bounds[at] : bounds[at + 1]] for x in (keys, signs))
            found[waiting[at]] = key[sign > 0], key[sign < 0]
        waiting = waiting[~empty]
        cells *= GROWTH
        used, again = np.unique(np.concatenate([left[waiting], right[waiting]]), return_inverse=True)
        made = Sketches.of([sets[x] for x in used], cells)
        left, right = left.copy(), right.copy()
        left[waiting], right[waiting] = again[: len(waiting)], again[len(waiting) :]
        sets = [sets[x] for x in used]
    return found


def likeness(size: int, only_left: int, only_right: int) -> float:
    """Share of paragraphs that two texts have in common, of all of them; 1.0 for two without any."""
    everything = size + only_right
    return (size - only_left) / everything if everything else 1.0


def fingerprint_texts(texts: list[str], cells: int = CELLS) -> list[str]:
    return Sketches.of([digests(text) for text in texts], cells).texts()


def fingerprint_documents(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Every column of ``docs`` and ``fingerprint``, the sketch of the whole text in base 64.

    Equal texts have equal fingerprints. A null text counts as empty, an empty one has a sketch of
    empty cells. A column of the input called ``fingerprint`` is replaced. Its length does not depend
    on the text's.
    """
    ship_code(docs.sparkSession)

    @F.pandas_udf("string")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            for at in range(0, len(batch), HELD_ROWS):
                yield pd.Series(fingerprint_texts(batch.iloc[at : at + HELD_ROWS].tolist(), cells))

    return docs.drop("fingerprint").withColumn("fingerprint", sketch(F.coalesce("text", F.lit(""))))


def compare_fingerprints(left: str, right: str) -> tuple[list[int], list[int]] | None:
    """Digests that only one of two fingerprints has, or None if more differ than they can tell."""
    diff = Sketches.read(left).minus(Sketches.read(right))
    empty, _, keys, signs = diff.peel()
    if not empty[0]:
        return None
    return keys[signs > 0].tolist(), keys[signs < 0].tolist()


def compare_versions(pairs: DataFrame, left: str = "old", right: str = "new", cells: int = CELLS) -> DataFrame:
    """Every column of ``pairs`` and ``versions``: struct (removed, added: arrays of paragraph digests as
    signed 64-bit numbers, ascending; likeness: double) for the texts in two columns. Null texts count as empty.
    """
    ship_code(pairs.sparkSession)

    @F.pandas_udf("struct<removed:array<long>,added:array<long>,likeness:double>")
    def compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for old, new in batches:
            for at in range(0, len(old), HELD_ROWS):
                texts = [*old.iloc[at : at + HELD_ROWS], *new.iloc[at : at + HELD_ROWS]]
                sets = [digests(text) for text in texts]
                half = np.arange(len(texts) // 2)
                found = differences(Sketches.of(sets, cells), sets, half, half + len(half))
                rows = [
                    (
                        np.sort(a.view(np.int64)),
                        np.sort(b.view(np.int64)),
                        likeness(len(sets[i]), len(a), len(b)),
                    )
                    for i, (a, b) in enumerate(found)
                ]
                yield pd.DataFrame(rows, columns=["removed", "added", "likeness"])

    texts = [F.coalesce(F.col(name), F.lit("")) for name in (left, right)]
    return pairs.drop("versions").withColumn("versions", compare(*texts))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _results(names: list, texts: list[str], cells: int) -> pd.DataFrame:
    """Rows of RESULT for texts in order; the last text is only the next one of the one before it."""
    n = len(texts) - 1
    changed = [edited(text, after) for text, after in zip(texts, texts[1:])]
    sets = [digests(text) for text in texts + changed]
    base = Sketches.of(sets, cells)
    here = np.arange(n)
    found = differences(base, sets, np.concatenate([here, here]), np.concatenate([here + n + 1, here + 1]))
    near = [likeness(len(sets[at % n]), len(a), len(b)) for at, (a, b) in enumerate(found)]
    prints = base.texts()
    return pd.DataFrame(
        {
            "doc_id": pd.array(names[:n], "Int64"),
            "n_chars": [len(text) for text in texts[:n]],
            "edited_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in changed],
            "fingerprint": prints[:n],
            "edited_fingerprint": prints[n + 1 :],
            "near_edited": near[:n],
            "near_next": near[n:],
        }
    )


def _pairs_in_order(cells: int):
    """Rows (range, guest, doc_id, text) in order -> results; the guest that ends a range is only looked at."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, texts, chars, here, ended = [], [], 0, None, False
        for batch in batches:
            columns = (batch[name].tolist() for name in ("range", "guest", "doc_id", "text"))
            for part, guest, name, text in zip(*columns):
                if part != here:
                    names, texts, chars, here, ended = [], [], 0, part, False
                if ended:
                    continue
                names.append(None if pd.isna(name) else int(name))
                texts.append(text)
                chars += len(text)
                ended = guest
                if len(texts) > 1 and (ended or len(texts) > HELD_ROWS or chars > HELD_CHARS):
                    yield _results(names, texts, cells)
                    names, texts, chars = names[-1:], texts[-1:], len(texts[-1])

    return compare


def _first_keys(rows: DataFrame, ranges: int) -> list[tuple[bool, int, int]]:
    """The first (doc_id is null, doc_id, hash) of each of so many ranges of the rows, in order."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.iloc[:1]
                return

    order = [F.col("doc_id").asc_nulls_last(), F.col("hash")]
    keys = rows.select("doc_id", "hash").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    found = keys.mapInPandas(first, "doc_id long, hash long").collect()
    return sorted((x.doc_id is None, x.doc_id or 0, x.hash) for x in found)


def with_next(docs: DataFrame, cells: int = CELLS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows of RESULT: each text's fingerprint, its edited text's, and their and the next one's likeness.

    The next document is the one that follows by doc_id, nulls last, and after the last one the first. Of
    rows with one doc_id the order is that of a hash of the text, then the text: equal rows stay next
    to each other. A null text counts as empty; two texts without a paragraph are alike (1.0). A single
    document is its own next one; an empty table gives no rows. Other columns are not read.

    Ranges hold about ``range_bytes`` of text each, and there are at least as many as shuffle partitions.
    Their first keys, one a range, pass the driver; texts are shuffled once.
    """
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(usual, -(-total // range_bytes))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    firsts = _first_keys(rows, ranges)

    @F.pandas_udf("struct<own:int,before:int>")
    def place(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for nulls, names, hashes in parts:
            keys = list(zip(nulls.tolist(), names.tolist(), hashes.tolist()))
            own = [bisect.bisect_right(firsts, key) - 1 for key in keys]
            # The first document of a range is also the next one of the last in the range before.
            before = [(at - 1) % len(firsts) if firsts[at] == key else None for at, key in zip(own, keys)]
            yield pd.DataFrame({"own": own, "before": pd.array(before, "Int32")})

    placed = rows.withColumn("at", place(F.isnull("doc_id"), F.coalesce("doc_id", F.lit(0)), F.col("hash")))
    places = F.array(
        F.struct(F.col("at.own").alias("range"), F.lit(False).alias("guest")),
        F.struct(F.col("at.before").alias("range"), F.lit(True).alias("guest")),
    )
    placed = placed.select(
        "doc_id", "text", "hash", F.inline(F.filter(places, lambda x: x["range"].isNotNull()))
    )
    # As many tasks as ranges, if they are more than a shuffle has by itself.
    dealt = placed.repartition(*([ranges] if ranges > usual else []), "range")
    ordered = dealt.sortWithinPartitions(
        "range", "guest", F.col("doc_id").asc_nulls_last(), "hash", "text"
    )
    return ordered.select("range", "guest", "doc_id", "text").mapInPandas(_pairs_in_order(cells), RESULT)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole document and of its edited text, and how alike they are."""
    return with_next(table(spark, sf_dir, "documents"))
