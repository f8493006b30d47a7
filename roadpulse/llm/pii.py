"""Operator 1: personal data, and words that give away whose it is, by information theory.

Patterns find the protected entities (addresses, numbers). What else a text says may still tell
them: a word that hardly occurs but with one entity reveals it. The corpus measures that. With
p(e) the share of documents that hold entity e, IC(e) = -log2 p(e) is what there is to learn,
PMI(t; e) = log2(p(e | t) / p(e)) what term t tells of it, and IC - PMI = -log2 p(e | t) the bits
that are left to learn once t is known. In a document that holds e, terms that leave GENERALISE bits
or fewer are generalised (a class stands for them), those that leave REMOVE or fewer are removed;
neither if they tell less than LEAST_GAIN bits, as of an entity that most documents hold.

p(e | t) is the lower confidence bound (Wilson's) of the share of documents with t that hold e. So
it takes evidence, and what decides does not turn on the size of the corpus: a word seen once, beside
an entity seen once, leaves 1.9 bits and stays, one that recurs beside its entity in three different
documents and nowhere else leaves 0.9. Documents are told apart by their *contexts*, the words around
the mention: copies of one text are one witness, and count once among the documents with t.

Entities that always stand in the same documents (a person's address and number, a list of customers)
are one *record*; its context is that of its first mention. A record of too few contexts cannot be
disclosed, nor by a term in too few documents or far more than it. What is left out for that would
have been rated below the threshold: the rest are all pairs that can be above it.

Plan: one scan writes the documents with entities, each once; a second counts documents by term, with
map-side combine. Pairs go back to their documents by a join whose skewed side can be split. Texts
without entities are never shuffled, nor are their terms.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import saved, ship_code, table

# The base kinds in the order they are listed, and the kinds of the method.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "general", "remove")

# The base patterns; of an address the part from the @ on.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, as one that begins later fails alike.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"\w+")

#: Terms on each side of a mention that make its context.
CONTEXT = 10
#: Bits of an entity that are left to learn: down to here terms are generalised, or removed.
GENERALISE, REMOVE = 1.0, 0.4
#: Bits of an entity that a term must tell at least.
LEAST_GAIN = 1.0
#: One-sided 95 % of the normal distribution, for the confidence bound.
DEVIATIONS = 1.645
#: Terms whose counts a task holds before it emits them.
HELD_TERMS = 300_000
#: Documents with entities, and code points of them, that a task holds before it emits them.
HELD_ROWS, HELD_CHARS = 256, 1 << 20

Span = tuple[int, int, int]  # place in KINDS, start, end (exclusive), in code points


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern finds them from left to right, in time linear in the text.

    No letter of the local part is an @, so each @ has its own run of letters before it.
    """
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (match := DOMAIN.match(text, at + 1)):
            end = match.end()
            yield start, end
            at = text.find("@", end)
        else:
            end = max(end, at + 1)
            at = text.find("@", at + 1)


def base_spans(text: str | None) -> list[Span]:
    """Personal data by pattern, by kind and then start; none in an empty or null text."""
    text = text or ""
    spans = [(0, *span) for span in _emails(text)]
    if DIGIT.search(text) is None:
        return spans
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
            spans.append((1, match.start(), match.end()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                spans.append((2, match.start(), match.end()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, match[0])) <= 15:
                spans.append((3, match.start(), match.end()))
    return spans


def entity(text: str, span: Span) -> str:
    """One name for all ways to write an entity."""
    kind, start, end = span
    value = text[start:end].lower()
    if kind > 1:
        value = "".join(filter(str.isdigit, value))
    return f"{BASE_KINDS[kind]}:{value}"


HOLDERS = (
    "doc_id long, text string, terms array<string>, "
    "mentions array<struct<entity:string,place:int,context:long>>"
)


def _holders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows with an entity their distinct terms, and per entity its first mention."""
    rows, chars = [], 0

    def emit() -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["doc_id", "text", "terms", "mentions"])
        return frame.astype({"doc_id": "Int64"})

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            if spans := base_spans(text):
                terms, mentions = _beside(text, spans)
                rows.append((None if pd.isna(doc_id) else int(doc_id), text, sorted(terms), mentions))
                chars += len(text)
            if len(rows) >= HELD_ROWS or chars >= HELD_CHARS:
                yield emit()
                rows, chars = [], 0
    yield emit()


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (term, n): n documents of this task hold the term."""
    held: Counter[str] = Counter()

    def emit() -> pd.DataFrame:
        return pd.DataFrame({"term": list(held.keys()), "n": list(held.values())}).astype({"n": "int64"})

    for batch in batches:
        for text in batch["text"]:
            if text:
                held.update(set(map(str.lower, TERM.findall(text))))
            if len(held) >= HELD_TERMS:
                yield emit()
                held.clear()
    yield emit()


def _beside(text: str, spans: list[Span]) -> tuple[set[str], list[dict]]:
    """The distinct terms outside of all mentions, and of each entity place and context."""
    inside = sorted((start, end) for _, start, end in spans)
    terms, starts, at, reach = [], [], 0, 0
    for match in TERM.finditer(text):
        while at < len(inside) and inside[at][0] < match.end():
            reach = max(reach, inside[at][1])
            at += 1
        if match.start() >= reach:
            terms.append(match[0].lower())
            starts.append(match.start())
    mentions: dict[str, dict] = {}
    place = 0
    for span in sorted(spans, key=lambda x: x[1]):
        while place < len(starts) and starts[place] < span[1]:
            place += 1
        if (name := entity(text, span)) not in mentions:
            around = " ".join(terms[max(place - CONTEXT, 0) : place + CONTEXT])
            context = hashlib.blake2b(around.encode(), digest_size=8).digest()
            context = int.from_bytes(context, "little", signed=True)
            mentions[name] = {"entity": name, "place": len(mentions), "context": context}
    return set(terms), list(mentions.values())


def bits_left(witnesses: Column, documents: Column) -> Column:
    """-log2 of the lower confidence bound of a share, as seen in so many documents."""
    z2 = DEVIATIONS**2
    share = witnesses / documents
    spread = F.sqrt(share * (1 - share) / documents + z2 / (4 * documents * documents))
    least = (share + z2 / (2 * documents) - DEVIATIONS * spread) / (1 + z2 / documents)
    return -F.log2(least)


def least_witnesses(bits: float) -> int:
    """Contexts that it takes for a term that stands nowhere else to leave so few bits."""
    share = 2.0**-bits
    return max(math.ceil(share * DEVIATIONS**2 / (1 - share)), 1) if share < 1 else sys.maxsize


def records_of(holders: DataFrame, least: int) -> DataFrame:
    """(key, record, context, holding): the records of each document that have ``least`` contexts.

    Entities of the same documents have the same set digest and so are one record; ``holding`` is
    the number of these documents.
    """
    mentions = holders.select("key", F.inline("mentions"))
    sets = mentions.groupBy("entity").agg(
        F.count("*").alias("holding"), F.bit_xor(F.xxhash64("key")).alias("digest")
    )
    sets = sets.where(F.col("holding") >= least)
    named = mentions.join(sets, "entity")
    here = named.groupBy("key", "digest", "holding").agg(F.min_by("context", "place").alias("context"))
    here = saved(here.select("key", F.xxhash64("digest", "holding").alias("record"), "context", "holding"), "pii-records")
    contexts = here.groupBy("record", "context").count().groupBy("record").agg(F.count("*").alias("contexts"))
    return here.join(contexts.where(F.col("contexts") >= least).select("record"), "record")


def disclosing_terms(
    pairs: DataFrame, documents: int, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """(record, term, kind): terms that disclose a record, with what happens to them.

    ``pairs`` has a row (record, term, context, holding, using) for each document that holds both,
    where ``holding`` and ``using`` documents hold the record and the term.
    """
    witnessed = pairs.groupBy("record", "term", "context").agg(
        F.count("*").alias("n"), F.first("holding").alias("holding"), F.first("using").alias("using")
    )
    rated = witnessed.groupBy("record", "term").agg(
        F.count("*").alias("witnesses"),
        (F.first("using") - F.sum("n")).alias("elsewhere"),
        F.first("holding").alias("holding"),
    )
    left = bits_left(F.col("witnesses"), F.col("witnesses") + F.col("elsewhere"))
    content = -F.log2(F.col("holding") / F.lit(float(max(documents, 1))))
    # Rounded, so that a bound at the threshold falls the same way whatever adds it up.
    rated = rated.withColumn("left", F.round(left, 9))
    told = rated.where((F.col("left") <= generalise) & (content - F.col("left") >= LEAST_GAIN))
    kind = F.when(F.col("left") <= remove, KINDS.index("remove")).otherwise(KINDS.index("general"))
    return told.select("record", "term", kind.alias("kind"))


def _own_terms(docs: DataFrame, holders: DataFrame, generalise: float, remove: float) -> DataFrame | None:
    """(key, marks): of each document the terms to be marked and how, or None if no record can be disclosed."""
    least = least_witnesses(generalise)
    records = saved(records_of(holders, least), "pii-open")
    if records.isEmpty():
        return None
    terms = docs.select("text").mapInPandas(_term_counts, "term string, n long")
    using = terms.groupBy("term").agg(F.sum("n").alias("using")).where(F.col("using") >= least)
    most = records.agg(F.max("holding")).first()[0]
    # Of a record in h documents a term in u tells no more than the share h / u.
    using = using.where(F.col("using") <= most * 2.0**generalise)
    open_ = records.select("key").distinct()
    held = holders.join(open_, "key").select("key", F.explode("terms").alias("term"))
    beside = held.join(using, "term").join(records, "key")
    pairs = saved(beside.where(F.col("using") <= F.col("holding") * 2.0**generalise), "pii-pairs")
    marked = disclosing_terms(pairs, docs.count(), generalise, remove)
    own = pairs.select("key", "record", "term").join(marked, ["record", "term"])
    own = own.groupBy("key", "term").agg(F.max("kind").alias("kind"))
    return own.groupBy("key").agg(F.collect_list(F.struct("term", "kind")).alias("marks"))


FOUND = "doc_id long, text string, pii_spans array<struct<kind:int,first:int,last:int>>"


def find_personal(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """doc_id, text and ``pii_spans`` (array of (kind, first, last), sorted) of every row.

    Null and empty texts have no spans. Every row is a document of its own, also one without
    doc_id or with that of another row. Other columns are ignored; an empty table gives no rows.
    """
    ship_code(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    # Numbered as they are written; who reads them finds the same numbers.
    holders = docs.mapInPandas(_holders, HOLDERS).withColumn("key", F.monotonically_increasing_id())
    holders = saved(holders, "pii-holders")
    own = _own_terms(docs, holders, generalise, remove)
    if own is None:
        marks = F.lit(None).cast("array<struct<term:string,kind:int>>")
        joined = holders.withColumn("marks", marks)
    else:
        joined = holders.join(own, "key", "left")
    marked = joined.select("doc_id", "text", "marks").mapInPandas(_marked, FOUND)
    without = docs.mapInPandas(_without, "doc_id long, text string")
    return marked.union(without.withColumn("pii_spans", F.array().cast(dict(marked.dtypes)["pii_spans"])))


def _without(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows that have no entity."""
    for batch in batches:
        yield batch[[not base_spans(text) for text in batch["text"]]]


def _marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for text, marks in zip(batch["text"], batch["marks"]):
            spans = base_spans(text)
            if marks is not None and len(marks):
                spans = spans + _term_spans(text, spans, {x["term"]: x["kind"] for x in marks})
            found.append([{"kind": k, "first": a, "last": b} for k, a, b in sorted(spans)])
        out = batch[["doc_id", "text"]].copy()
        out["pii_spans"] = pd.Series(found, index=out.index, dtype=object)
        yield out


def _term_spans(text: str, spans: list[Span], kinds: dict[str, int]) -> list[Span]:
    """Where the terms stand in the whole text, outside of the base spans."""
    inside, at, reach, found = sorted(x[1:] for x in spans), 0, 0, []
    for match in TERM.finditer(text):
        while at < len(inside) and inside[at][0] < match.end():
            reach = max(reach, inside[at][1])
            at += 1
        if match.start() >= reach and (kind := kinds.get(match[0].lower())) is not None:
            found.append((kind, match.start(), match.end()))
    return found


def sanitised(text: str | None, spans: list[Span]) -> str | None:
    """The text with base spans named by kind, terms generalised to a class or removed."""
    if text is None:
        return None
    pieces, at = [], 0
    for kind, first, last in sorted(spans, key=lambda x: (x[1], -x[2])):
        if first < at:
            at = max(at, last)
            continue
        pieces.append(text[at:first])
        piece = text[first:last]
        if kind < len(BASE_KINDS):
            pieces.append(f"[{BASE_KINDS[kind].upper()}]")
        elif KINDS[kind] == "general":
            number, name = any(map(str.isdigit, piece)), piece[:1].isupper()
            pieces.append("[NUMBER]" if number else "[NAME]" if name else "[TERM]")
        at = last
    return "".join([*pieces, text[at:]])


def sanitise(docs: DataFrame, **thresholds: float) -> DataFrame:
    """doc_id and the sanitised ``text`` of every row."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [
                sanitised(text, [(x["kind"], x["first"], x["last"]) for x in found])
                for text, found in zip(texts, spans)
            ],
            dtype=object,
        )

    found = find_personal(docs, **thresholds)
    return found.select("doc_id", clean("text", "pii_spans").alias("text"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document: counts, digest of base spans, all spans."""
    found = find_personal(table(spark, sf_dir, "documents")).drop("text")
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda x: x["kind"] < len(BASE_KINDS))
    number = lambda place: F.size(F.filter(spans, lambda x: x["kind"] == place)).cast("long")
    names = F.array(*map(F.lit, KINDS))

    def shown(chosen):
        one = lambda x: F.concat_ws(
            ":", F.get(names, x["kind"]), x["first"].cast("string"), x["last"].cast("string")
        )
        return F.array_join(F.transform(chosen, one), ",")

    return found.select(
        "doc_id",
        *(number(place).alias(f"n_{name}") for place, name in enumerate(BASE_KINDS)),
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
        shown(spans).alias("spans"),
    )
