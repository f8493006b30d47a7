"""Operator 11: spelling variants grouped by an asymmetric q-chunk join for one edit.

Two words are near if one inserted, deleted or replaced code point makes one of them the other.
One word contributes two disjoint chunks, its halves; the other all its grams of these lengths at
the places within shift one that an edit can move a chunk to. An edit can change one of the chunks
only, so the other is a gram of the near word: joining chunks with grams finds every pair. The shorter
word gives the chunks, and the key of the join holds its length and which of its chunks it is. So a
gram can match in one place only: where the chunk was, or one further on, behind an inserted letter.

A chunk that many words have would bring all pairs of them together. Where a key has more candidates
than ``CANDIDATES`` for each of its rows, they are not compared: what is left of the words, in which
the edit must be, is parted into two chunks again, and the longer shared part is the new key. Each
turn halves what can differ; at last words of one key are equal in all but one letter, and there are
no more of these than letters. So the work stays in proportion to the number of words whatever parts
they share, no candidate is left out, and every pair found is verified on the whole words.

The counts combine before the shuffle: a word costs one row per task, however often it occurs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import ascii_lower, discard, saved, table

#: Code points and occurrences that a word has at least.
LEAST_CHARS, LEAST_COUNT = 7, 2
#: How many times as often as a word its form occurs, at least.
RATIO = 10
#: Candidates that a key may have for each of its rows before its words are parted further.
CANDIDATES = 64
#: One run in so many is misspelled by ``misspelled``.
MISSPELLED = 31

LETTERS = "[A-Za-zÀ-ÿ]"

# Which side of the join a row is on: gives chunks, gives grams to a word of its own length, or
# to one that is shorter by one.
CHUNK, GRAM, LONGER = 0, 1, 2


def misspelled(name: Column, run: Column) -> Column:
    """``run`` without one of its code points where ``MISSPELLED`` divides the CRC-32 of ``name:run``."""
    number = F.crc32(F.concat(F.coalesce(name.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (number % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(number % MISSPELLED == 0, shorter).otherwise(run)


def count_words(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    spelled: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """(word, n): maximal runs of Latin letters in whole texts, A-Z lower-cased, and how many.

    ``spelled`` makes the word of doc_id and run; it must not make it longer. Null and empty texts
    have no words.
    """
    # Shorter runs cannot become words; no match of this pattern is a part of a longer run.
    pattern = F.lit(f"{LETTERS}{{{least_chars},}}")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("run"))
    word = ascii_lower(F.col("run"))
    if spelled is not None:
        runs = runs.select("doc_id", word.alias("run"))
        word = spelled(F.col("doc_id"), F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _part(first: Column, last: Column) -> Column:
    return F.substring(F.col("word"), first + 1, last - first)


def _parted(rows: DataFrame) -> DataFrame:
    """Each row (key, side, word, n, first, last) once per chunk, the rest of the word between its ends.

    ``word[first:last]`` is where the edit must be. A word that is longer by one has one code point
    more there, so that its second chunk stands one further on.
    """
    more = (F.col("side") == LONGER).cast("int")
    half = F.col("first") + F.floor((F.col("last") - F.col("first") - more) / 2).cast("int")

    def child(number: int, shared: Column, first: Column, last: Column) -> Column:
        key = F.xxhash64("key", F.lit(number), shared)
        return F.struct(key.alias("key"), first.alias("first"), last.alias("last"))

    start, end = F.col("first"), F.col("last")
    children = F.array(
        child(1, _part(start, half), half, end),
        child(2, _part(half + more, end), start, half + more),
    )
    return rows.withColumn("child", F.explode(children)).select(
        "child.key", "side", "word", "n", "child.first", "child.last"
    )


def near_pairs(words: DataFrame, candidates: int = CANDIDATES) -> DataFrame:
    """(a, n_a, b, n_b): every pair of words (word, n) that differ by one edit, once.

    The result is written; ``discard`` it after use.
    """
    length = F.length("word")
    sides = F.array(*[F.struct(F.lit(side).alias("side"), key.alias("key")) for side, key in (
        (CHUNK, length), (GRAM, length), (LONGER, length - 1)
    )])
    rows = words.withColumn("s", F.explode(sides)).select(
        F.col("s.key").cast("long").alias("key"), "s.side", "word", "n",
        F.lit(0).alias("first"), length.alias("last"),
    )
    found = None
    while True:
        rows = saved(_parted(rows), "spelling-chunks")
        chunks, grams = F.count_if(F.col("side") == CHUNK), F.count_if(F.col("side") != CHUNK)
        keys = rows.groupBy("key").agg(chunks.alias("chunks"), grams.alias("grams"))
        keys = keys.where("chunks > 0 and grams > 0").select(
            "key", (F.col("chunks") * F.col("grams") > candidates * (F.col("chunks") + F.col("grams"))).alias("busy")
        )
        held = saved(rows.join(keys, "key"), "spelling-candidates")
        # The shorter word's rest; a single code point cannot be parted.
        rest = F.col("last") - F.col("first") - (F.col("side") == LONGER).cast("int")
        divisible = F.col("busy") & (rest > 1)
        pairs = saved(_verified(held.where(~divisible)), "spelling-pairs")
        found = pairs if found is None else found.union(pairs)
        waiting = held.where(divisible).drop("busy")
        discard(rows)
        if waiting.isEmpty():
            break
        rows = waiting
    return saved(found.distinct(), "spelling-near")


def _verified(rows: DataFrame) -> DataFrame:
    chunks = rows.where(F.col("side") == CHUNK).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    grams = rows.where(F.col("side") != CHUNK).select("key", "side", F.col("word").alias("b"), F.col("n").alias("n_b"))
    # Words of one length meet in both roles.
    once = (F.col("side") == LONGER) | (F.col("a") < F.col("b"))
    near = F.levenshtein("a", "b", 1) == 1
    return chunks.join(grams, "key").where(once).where(near).select("a", "n_a", "b", "n_b")


def group_variants(words: DataFrame, ratio: int = RATIO, candidates: int = CANDIDATES) -> DataFrame:
    """word, form, root, n, n_near, form_n for words (word, n).

    ``form`` is the near word of largest n (of equal ones the first in code-point order) if that is
    at least ``ratio`` times the word's n, else null; ``root`` is where following the forms ends. An
    n grows by ``ratio`` with each step, so a chain is short and has no loop.
    """
    words = saved(words, "spelling-words")
    pairs = near_pairs(words, candidates)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "a", "n_a")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best")
    )
    much = -F.col("best.col1") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        F.when(much, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(much, -F.col("best.col1")).alias("form_n"),
    )
    formed = saved(formed, "spelling-forms")
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(links: DataFrame) -> DataFrame:
    """Follow (word, root) to the end of each chain; a turn doubles the steps that are taken."""
    links = saved(links, "spelling-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(ahead, "root", "left")
        moved = saved(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        discard(links)
        links = moved
        if moved.where("moved").isEmpty():
            return moved.drop("moved")


def find_variants(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    spelled: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """One row per word of ``docs`` with its preferred form, see ``group_variants``.

    Only doc_id (for ``spelled``) and text are read, so other columns and their names do not matter.
    Null and empty texts have no words, rows without doc_id count like others, repeated rows count
    each time, a text of any length is read whole, and an empty table gives no rows.
    """
    return group_variants(count_words(docs, least_chars, least_count, spelled), ratio)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants in all documents, of which one run in 31 is misspelled first."""
    return find_variants(table(spark, sf_dir, "documents"), spelled=misspelled)


OP11_SQL = r"""
with recursive bits(i, v, k) as (
    select range, range, 0 from range(256)
    union all
    select i, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from bits where k < 8
),
crc as (select list(v order by i) as t from bits where k = 8),
runs as (
    select coalesce(cast(doc_id as varchar), '') as id,
           unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[A-Za-z\x{C0}-\x{FF}]{7,}')) as run
    from documents
),
met as (select id, run, count(*) as n from runs group by id, run),
hashed as (
    select run, n, length(run) as l,
           xor(list_reduce(
               flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
                   case when unicode(c) < 128 then [cast(unicode(c) as bigint)]
                        else [cast(192 + unicode(c) // 64 as bigint), cast(128 + unicode(c) % 64 as bigint)] end)),
               lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]), cast(4294967295 as bigint)), 4294967295) as h
    from met, crc
),
spelled as (
    select case when h % 31 = 0 then left(run, cast(h % l as int)) || substr(run, cast(h % l as int) + 2)
                else run end as word, n
    from hashed
),
words as (
    select word, cast(sum(n) as bigint) as n from spelled where length(word) >= 7 group by word having sum(n) >= 2
),
cut as (
    select word, n, i, left(word, i) || substr(word, i + 2) as rest
    from (select word, n, unnest(range(length(word))) as i from words)
),
near as (
    select a.word, b.word as near, b.n as near_n from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word
    union
    select c.word, w.word, w.n from cut c join words w on c.rest = w.word
    union
    select w.word, c.word, c.n from cut c join words w on c.rest = w.word
),
best as (
    select word, count(*) as n_near, max(near_n) as most,
           list(near order by near_n desc, near)[1] as first_near
    from near group by word
),
formed as (
    select words.word, n, coalesce(n_near, 0) as n_near,
           case when most >= 10 * n then first_near end as form, case when most >= 10 * n then most end as form_n
    from words left join best using (word)
),
chain(word, root) as (
    select word, word from formed
    union all
    select chain.word, formed.form from chain join formed on chain.root = formed.word where formed.form is not null
),
ends as (select chain.word, chain.root from chain join formed on chain.root = formed.word where formed.form is null)
select formed.word, form, root, n, cast(n_near as bigint) as n_near, cast(form_n as bigint) as form_n
from formed join ends using (word)
"""
