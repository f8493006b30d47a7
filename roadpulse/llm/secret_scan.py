"""Operator 6: secrets in texts, by patterns and by sliding-window entropy, in SQL functions only.

Patterns give the base spans. Beside them, runs of characters of a class (hexadecimal digits,
base-64 letters) are candidates: a window slides over each, the counts of its characters and from
them its Shannon entropy are kept up to date by the one character that enters and the one that
leaves, and a candidate whose best window reaches its class's threshold is a span of kind
``entropy``, unless the allow-list knows all of it or a base span already covers it.

Everything is an expression of one row, so the plan is a map: no shuffle, no Python, no broadcast.
A text costs time in proportion to its length and its number of matches: a step of a window updates
one count per different character, and results are collected in blocks, so that adding one does not
copy all that was found before.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import table

# The base patterns, in the order in which kinds are listed.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

ASSIGN_LENGTH = 6
ACCESS_LENGTH = 20


@dataclass(frozen=True)
class CharacterClass:
    """Characters a candidate is made of, its least length and the entropy (bits) that tells."""

    characters: str
    least: int
    threshold: float


#: A window of 20 characters has at most log2(20) = 4.32 bits; words have 3 to 3.6.
CLASSES = (
    CharacterClass("0-9a-fA-F", 20, 3.0),
    CharacterClass("A-Za-z0-9+/_=-", 20, 3.9),
)
WINDOW = 20

#: What words, also joined by marks or capitals, do not hold: four consonants or vowels in a row,
#: one small letter between capitals, capitals between small letters.
NO_WORD = (
    r"[b-df-hj-np-tv-xzB-DF-HJ-NP-TV-XZ]{4}|[aeiouAEIOU]{4}|[a-z][A-Z][a-z][A-Z]|[a-z][A-Z]{2,}[a-z]"
)
#: Candidates that are, as a whole, one of these are no secrets: words, numbers, UUIDs, counted
#: alphabets and placeholders. Any Java regular expressions may be given instead; they too are
#: held against the whole candidate. Letters that read as no words are judged by their entropy.
ALLOWED = (
    rf"(?!.*(?:{NO_WORD}))[A-Za-z_/+=-]*",
    r"[0-9_/+=-]*",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i)(?:0123456789(?:abcdef)?|abcdefghij(?:klmnopqrstuvwxyz)?|example|placeholder|changeme"
    r"|x{6,}|[_/+=-])++",
)

#: Stands in texts for the end of a piece; a text's own are first replaced by another
#: noncharacter, which leaves all positions as they were.
MARK, OTHER = "\uFFFF", "\uFFFE"


#: Elements that are folded together (a fold copies its state at each step, so it must stay
#: small), and code points of the pieces that long texts are cut from.
BLOCK, CUT = 64, 1024


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named, in lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _in_blocks(
    values: Column,
    total: Callable[[Column], Column],
    join: Callable[[Column, Column], Column],
    each: Callable[[Column, Column, Column], Column],
) -> Column:
    """All that ``each`` gives of block, number carried to it from those before, and values before it.

    ``total`` is what a block adds to the number, and ``join`` how.
    """

    def use(held: Column) -> Column:
        count = F.floor((F.greatest(F.size(held), F.lit(1)) - 1) / BLOCK).cast("int")
        return _let(
            F.transform(F.sequence(F.lit(0), count), lambda at: F.slice(held, at * BLOCK + 1, F.lit(BLOCK))), carried
        )

    def carried(blocks: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            F.transform(blocks, total),
            none,
            lambda s, more: F.struct(
                join(s["at"], more).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")
            ),
            lambda s: s["starts"],
        )
        parts = F.arrays_zip(blocks.alias("items"), starts.alias("start"))
        return F.flatten(F.transform(parts, lambda x, at: each(x["items"], x["start"], at * BLOCK)))

    return _let(values, use)


def _more(found: Column, more: Column, when: Column) -> Column:
    return F.when(when, F.concat(found, F.array(more))).otherwise(found)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (first, last, piece), code points, end exclusive.

    Every match is wrapped in marks and the text split there, so pieces outside and inside
    matches alternate, and the running sum of their lengths gives the positions.
    """
    wrapped = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(OTHER)), pattern, f"{MARK}$0{MARK}")
    nothing = F.array().cast("array<struct<first:int,last:int,piece:string>>")

    def each(pieces: Column, start: Column, _: Column) -> Column:
        def step(so_far: Column, piece: Column) -> Column:
            end = so_far["at"] + F.length(piece)
            match = F.struct(so_far["at"].alias("first"), end.alias("last"), piece.alias("piece"))
            return F.struct(
                end.alias("at"),
                (~so_far["inside"]).alias("inside"),
                _more(so_far["found"], match, so_far["inside"]).alias("found"),
            )

        # A block has an even number of pieces, so it begins outside of a match.
        none = F.struct(start.alias("at"), F.lit(False).alias("inside"), nothing.alias("found"))
        return F.aggregate(pieces, none, step, lambda end: end["found"])

    def length(pieces: Column) -> Column:
        return F.aggregate(pieces, F.lit(0), lambda so_far, piece: so_far + F.length(piece))

    return _in_blocks(F.split(wrapped, MARK), length, lambda at, more: at + more, each)


def best_entropy(candidate: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy in bits of ``window`` characters in a row (0 if too short).

    With n log2 n summed over the counts in a window, the entropy is log2(w) - sum / w. A step
    changes the counts of the entering and the leaving character only, so the sum changes by
    the terms of these two. The state holds one count for each different character.
    """
    term = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(0.0)
    count = lambda counts, place: F.get(counts, place)

    def slide(places: Column, different: Column) -> Column:
        """Over the place of each character among the different ones, and of the one that leaves then."""
        moves = F.arrays_zip(
            places.alias("enters"),
            F.concat(F.array_repeat(F.lit(-1), window), places).alias("leaves"),
        )

        def step(so_far: Column, move: Column) -> Column:
            enters, leaves = move["enters"], move["leaves"]
            before = count(so_far["counts"], enters)
            had = count(so_far["counts"], leaves) + (enters == leaves).cast("int")
            grown = so_far["sum"] + term(before + 1) - term(before)
            total = F.when(leaves >= 0, grown - term(had) + term(had - 1)).otherwise(grown)
            counts = F.transform(
                so_far["counts"], lambda n, i: n + (i == enters).cast("int") - (i == leaves).cast("int")
            )
            at = so_far["at"] + 1
            bits = F.log2(F.lit(float(window))) - total / window
            return F.struct(
                at.alias("at"),
                counts.alias("counts"),
                total.alias("sum"),
                F.when(at >= window, F.greatest(so_far["best"], bits)).otherwise(0.0).alias("best"),
            )

        none = F.struct(
            F.lit(0).alias("at"),
            F.array_repeat(F.lit(0), F.size(different)).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.lit(0.0).alias("best"),
        )
        # The window is longer than its characters by those that never leave.
        return F.aggregate(F.slice(moves, 1, F.size(places)), none, step, lambda end: end["best"])

    def placed(letters: Column, different: Column) -> Column:
        return F.transform(letters, lambda x: F.array_position(different, x).cast("int") - 1)

    return _let(
        F.split(candidate, ""),
        lambda letters: _let(
            F.array_distinct(letters),
            lambda different: _let(placed(letters, different), lambda places: slide(places, different)),
        ),
    )


SPAN = "struct<first:int,kind:int,last:int>"


def _spans(found: Column, kind: str) -> Column:
    place = KINDS.index(kind)
    return F.transform(
        found,
        lambda x: F.struct(
            x["first"].alias("first"), F.lit(place).alias("kind"), x["last"].alias("last")
        ),
    )


def _shown(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":",
                F.get(names, x["kind"]),
                x["first"].cast("string"),
                x["last"].cast("string"),
            ),
        ),
        ",",
    )


def find_secrets(
    docs: DataFrame,
    classes: tuple[CharacterClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
    window: int = WINDOW,
) -> DataFrame:
    """Every column of ``docs`` and ``secret_spans``: array of (first, kind, last), sorted.

    ``kind`` counts along KINDS. A null or empty text has no spans. Rows stay as they are,
    repeated ones too; a column of the input called ``secret_spans`` is replaced.
    """
    docs = docs.drop("secret_spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(
        matches(text, ASSIGN),
        lambda x: F.length(F.regexp_extract(x["piece"], ASSIGN, 2)) >= ASSIGN_LENGTH,
    )
    access = F.filter(
        matches(text, ACCESS), lambda x: x["last"] - x["first"] >= ACCESS_LENGTH
    )
    base = F.concat(
        _spans(assign, "assign"), _spans(access, "access"), _spans(matches(text, HEX), "hex")
    )
    runs = [_candidates(text, kind, allowed, window) for kind in classes]
    every = F.array_sort(F.concat(base, *[_spans(found, "entropy") for found in runs]))
    return docs.withColumn("secret_spans", _let(every, _uncovered))


def _uncovered(spans: Column) -> Column:
    """Sorted spans without entropy spans that repeat or that a base span covers."""
    entropy = KINDS.index("entropy")

    def reach(block: Column) -> Column:
        """Where the last base span ends, 0 without one."""
        return F.aggregate(
            block,
            F.lit(0),
            lambda so_far, x: F.when(x["kind"] < entropy, F.greatest(so_far, x["last"])).otherwise(so_far),
        )

    def each(block: Column, start: Column, place: Column) -> Column:
        def step(so_far: Column, span: Column) -> Column:
            base = span["kind"] < entropy
            # A span covers another if it begins no later, so was met before, and ends no sooner.
            fresh = base | ((so_far["reach"] < span["last"]) & ~span.eqNullSafe(so_far["before"]))
            return F.struct(
                F.when(base, F.greatest(so_far["reach"], span["last"])).otherwise(so_far["reach"]).alias("reach"),
                span.alias("before"),
                _more(so_far["found"], span, fresh).alias("found"),
            )

        none = F.struct(
            start.alias("reach"),
            F.get(spans, place - 1).alias("before"),
            F.array().cast(f"array<{SPAN}>").alias("found"),
        )
        return F.aggregate(block, none, step, lambda end: end["found"])

    return _in_blocks(spans, reach, lambda a, b: F.greatest(a, b), each)


def _candidates(
    text: Column, kind: CharacterClass, allowed: tuple[str, ...], window: int
) -> Column:
    """Runs of the class that its threshold tells and the allow-list does not know."""
    run = f"(?<![{kind.characters}])[{kind.characters}]{{{kind.least},}}"

    def tells(x: Column) -> Column:
        return ~_any(x["piece"], allowed) & (best_entropy(x["piece"], window) >= kind.threshold)

    return F.filter(matches(text, run), tells)


def _any(piece: Column, patterns: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for pattern in patterns:
        found = found | piece.rlike(rf"\A(?:{pattern})\z")
    return found


def redact(docs: DataFrame, label: str = "[SECRET]") -> DataFrame:
    """``docs`` with each span of ``secret_spans`` in ``text`` replaced by ``label``.

    Spans that overlap are replaced as one. ``secret_spans`` goes; a text without spans, a null
    text too, stays as it is.
    """

    def between(cuts: Column, first: Column, last: Column) -> Column:
        """That part of the text, looked for in the pieces it lies in."""
        begin = F.floor(first / CUT).cast("int")
        pieces = F.slice(cuts, begin + 1, F.floor(last / CUT).cast("int") - begin + 1)
        return F.substring(F.array_join(pieces, ""), first - begin * CUT + 1, last - first)

    def reach(spans: Column) -> Column:
        return F.array_max(F.transform(spans, lambda x: x["last"]))

    def cut(cuts: Column) -> Column:
        def each(spans: Column, start: Column, _: Column) -> Column:
            def step(so_far: Column, span: Column) -> Column:
                fresh = (span["first"] >= so_far["at"]) & ((so_far["at"] > 0) | (span["last"] > 0))
                part = F.concat(between(cuts, so_far["at"], span["first"]), F.lit(label))
                return F.struct(
                    F.greatest(so_far["at"], span["last"]).alias("at"),
                    _more(so_far["parts"], part, fresh).alias("parts"),
                )

            none = F.struct(start.alias("at"), F.array().cast("array<string>").alias("parts"))
            return F.aggregate(spans, none, step, lambda end: end["parts"])

        parts = _in_blocks(F.col("secret_spans"), reach, lambda a, b: F.greatest(a, b), each)
        rest = F.substring("text", reach(F.col("secret_spans")) + 1, F.length("text"))
        return F.concat(F.array_join(parts, ""), rest)

    cuts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return docs.withColumn(
        "text", F.when(F.size("secret_spans") > 0, _let(cuts, cut)).otherwise(F.col("text"))
    ).drop("secret_spans")


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, their digest, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text")).drop("text")
    base = F.filter("secret_spans", lambda x: x["kind"] < KINDS.index("entropy"))
    found = found.withColumn("base", base)
    number = lambda kind: F.size(
        F.filter("base", lambda x: x["kind"] == KINDS.index(kind))
    ).cast("long")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(_shown(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _shown(F.col("secret_spans")).alias("spans"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole document."""
    return secret_digests(table(spark, sf_dir, "documents"))
