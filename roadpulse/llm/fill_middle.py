"""Operator 13: fill-in-middle transformation, cut points found by a Fenwick tree over text blocks.

A text is a sequence of units: a word with the white space before it, or white space at the end.
Two cuts, drawn from a hash of seed and doc_id, part it into prefix, middle and suffix; the parts
are written in another order behind marks, so that a model that reads from left to right learns to
fill the middle in.

The UTF-8 bytes of a text are cut into blocks of fixed length. A Fenwick tree over the blocks holds
how many units end in each and how many code points begin there. The block of a cut is found by
binary lifting over the tree, which also adds up the code points before it, and the boundary is then
looked for within that block alone.

Each row is handled by itself: the plan is a map, without shuffle, broadcast or state.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import ship_code, table

#: Bytes of a block.
BLOCK = 1024
#: Rows whose results are held at a time.
HELD_ROWS = 256

FORMS = PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class FillMiddle:
    """Marks of the three parts, the seed, and how many of a hundred texts are cut and put suffix first."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: int = 42
    cut_percent: int = 50
    suffix_first_percent: int = 80


class BlockTree:
    """Units and code points of a text, counted by blocks of its bytes."""

    def __init__(self, data: bytes, block: int = BLOCK):
        letters = np.frombuffer(data, np.uint8)
        space = (letters == 0x20) | ((letters >= 0x09) & (letters <= 0x0D))
        self.block = block
        self.begins = (letters & 0xC0) != 0x80
        self.ends = ~space
        if data:
            self.ends[:-1] &= space[1:]
            self.ends[-1] = True
        firsts = np.arange(0, len(data), block)
        self.blocks = len(firsts)
        self.units = self._tree(self.ends, firsts)
        self.points = self._tree(self.begins, firsts)
        self.n_units = int(np.count_nonzero(self.ends))

    @staticmethod
    def _tree(flags: np.ndarray, firsts: np.ndarray) -> list[int]:
        """Entry i sums the blocks from i without its lowest bit up to i, counted from 1."""
        counts = np.add.reduceat(flags, firsts, dtype=np.int64) if len(firsts) else firsts
        before = np.concatenate([[0], np.cumsum(counts)])
        places = np.arange(len(before))
        return (before - before[places & (places - 1)]).tolist()

    def cut(self, unit: int) -> tuple[int, int]:
        """Bytes and code points up to the end of the given number of units."""
        if unit == 0:
            return 0, 0
        at, left, points = 0, unit, 0
        step = 1 << (self.blocks.bit_length() - 1)
        while step:
            ahead = at + step
            if ahead <= self.blocks and self.units[ahead] < left:
                at = ahead
                left -= self.units[ahead]
                points += self.points[ahead]
            step >>= 1
        first = at * self.block
        within = np.flatnonzero(self.ends[first : first + self.block])
        end = first + int(within[left - 1]) + 1
        return end, points + int(np.count_nonzero(self.begins[first:end]))


def numbers_of(seed: int, name: str) -> tuple[int, int, int, int]:
    """The first four 32-bit numbers of the SHA-256 of ``seed:name``."""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return tuple(int(digest[at : at + 8], 16) for at in range(0, 32, 8))


def transform(name: str, text: str, how: FillMiddle) -> tuple[int, str, str, int | None, int | None]:
    """Units, form, new text, and code points of prefix and middle (None if the text stays)."""
    data = text.encode()
    tree = BlockTree(data)
    n = tree.n_units
    h1, h2, h3, h4 = numbers_of(how.seed, name)
    marked = any(mark in text for mark in (how.prefix, how.suffix, how.middle))
    if not text or marked or h3 % 100 >= how.cut_percent:
        return n, PLAIN, text, None, None
    units = sorted((h1 % (n + 1), h2 % (n + 1)))
    (first, first_points), (last, last_points) = map(tree.cut, units)
    prefix, middle, suffix = (x.decode() for x in (data[:first], data[first:last], data[last:]))
    if h4 % 100 < how.suffix_first_percent:
        form, parts = SPM, (how.suffix, suffix, how.prefix, prefix, how.middle, middle)
    else:
        form, parts = PSM, (how.prefix, prefix, how.suffix, suffix, how.middle, middle)
    return n, form, "".join(parts), first_points, last_points - first_points


def fill_middle(docs: DataFrame, how: FillMiddle = FillMiddle()) -> DataFrame:
    """Every column of ``docs`` and ``fim``: struct (units, form, text, prefix_chars, middle_chars).

    A null text counts as empty; an empty text, and one that holds a mark already, stays as it is
    (form ``plain``, no lengths). A null doc_id counts as empty text in the hash; rows of one
    doc_id, repeated or not, are cut by the same numbers. A column of the input called ``fim`` is
    replaced. A text takes time and memory in proportion to its length, whatever that is.
    """
    ship_code(docs.sparkSession)

    @F.pandas_udf(
        "struct<units:long,form:string,text:string,prefix_chars:long,middle_chars:long>"
    )
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for names, texts in parts:
            for at in range(0, len(texts), HELD_ROWS):
                held = zip(names.iloc[at : at + HELD_ROWS], texts.iloc[at : at + HELD_ROWS])
                rows = [transform(name, text, how) for name, text in held]
                out = pd.DataFrame(rows, columns=["units", "form", "text", "prefix_chars", "middle_chars"])
                yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.drop("fim").withColumn("fim", cut(name, F.coalesce("text", F.lit(""))))


def restored(form: Column, text: Column, how: FillMiddle = FillMiddle()) -> Column:
    """The original text of a transformed one."""
    marks = "|".join(re.escape(mark) for mark in (how.prefix, how.suffix, how.middle))
    parts = F.split(text, marks)
    return (
        F.when(form == PSM, F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == SPM, F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(text)
    )


def fill_middle_digests(docs: DataFrame, how: FillMiddle = FillMiddle()) -> DataFrame:
    """doc_id, units, form, lengths, and SHA-256 of the new text and of the one rebuilt from it."""
    found = fill_middle(docs.select("doc_id", "text"), how)
    form, text = F.col("fim.form"), F.col("fim.text")
    return found.select(
        "doc_id",
        F.col("fim.units").alias("n"),
        form.alias("form"),
        F.col("fim.prefix_chars").alias("prefix_chars"),
        F.col("fim.middle_chars").alias("middle_chars"),
        F.sha2(text.cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(form, text, how).cast("binary"), 256).alias("restored_sha256"),
    )


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document cut in three and put in another order, or left as it is."""
    return fill_middle_digests(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with units as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(
               coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
           sha256('42:' || doc_id) as h
    from documents
),
numbers as (
    select *, cast(len(u) as bigint) as n,
           cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
           cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4
    from units
),
cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>')
                     or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
                when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from numbers
),
parts as (
    select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m,
           array_to_string(u[b + 1:n], '') as s
    from cuts
)
select doc_id, n, form,
       case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""
