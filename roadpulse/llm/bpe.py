"""Operator 7: byte-pair encoding and decoding by dynamic programming over prefixes.

A byte-pair encoding has this property: the encoding of a prefix of a word ends in exactly one
token, and a token ``t`` of length ``k`` is that token for the prefix of length ``i`` iff ``t``
spells its last ``k`` bytes and the pair (last token of the prefix of length ``i - k``, ``t``)
is *compatible*, that is, the two stay apart when their joint text is encoded. So one pass from
left to right stores the last token of each prefix, and back-pointers from the end give the
exact ids. No merge is ever simulated.

* Candidates ``t`` come from an automaton that reports every vocabulary entry ending at a byte.
* Compatibility needs the merge ranks alone: two tokens part unless some piece on the right edge
  of the first and some piece on the left edge of the second merge while both exist.

Words repeat, so a task keeps the ids of the words it has seen in a table of bounded size.
The work is map-only: no shuffle, no broadcast beyond the vocabulary's path.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import table

#: Fixed value: the public pattern that splits text into words for byte-level encodings.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: Words whose ids a task remembers; when full, the table starts anew.
REMEMBERED_WORDS = 250_000

#: Pairs of ids whose compatibility a task remembers.
REMEMBERED_PAIRS = 250_000

#: Texts whose ids a task holds before it passes them on.
HELD_TEXTS = 512

#: Longer words (runs of one class of characters) are encoded but not remembered.
REMEMBERED_LENGTH = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    letters = {chr(byte): byte for byte in shown}
    return letters | {chr(0x100 + place): byte for place, byte in enumerate(hidden)}


def _recent_letters() -> str:
    """Letters and digits to the ``regex`` module that this Python's tables leave unassigned.

    The encodings' own tables leave them unassigned too, so they split as other characters.
    """
    letter = regex.compile(r"[\p{L}\p{N}]")
    points = [*range(0x100, 0xD800), *range(0xE000, sys.maxunicode + 1)]
    return "".join(
        chr(point)
        for point in points
        if unicodedata.category(chr(point)) == "Cn" and letter.match(chr(point))
    )


class BytePairs:
    """One vocabulary: encodes texts to ids and decodes ids to text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        letters = byte_letters()
        model = stored["model"]
        as_bytes = {name: bytes(letters[c] for c in name) for name in model["vocab"]}
        self.bytes_of = {number: as_bytes[name] for name, number in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in stored["added_tokens"]}
        self.bytes_of |= {number: text.encode() for text, number in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}  # of the merge of two ids
        self.made_by: dict[int, tuple[int, int, int]] = {}  # id -> its rank and its two parts
        vocabulary = model["vocab"]
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            self.rank[pair] = rank
            self.made_by.setdefault(vocabulary[left + right], (rank, *pair))
        self.whole: dict[str, int] = {}
        self.endings = ahocorasick.Automaton()
        for name, number in vocabulary.items():
            # Only bytes and merges can come out of the encoding.
            if number in self.made_by or len(as_bytes[name]) == 1:
                spelled = as_bytes[name].decode("latin-1")
                self.endings.add_word(spelled, (number, len(spelled)))
                # A merge is a whole word's encoding if its two parts make it, alone.
                if number not in self.made_by or self._joins(number):
                    self.whole[spelled] = number
        self.endings.make_automaton()
        self.apart: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.usual = regex.compile(SPLIT)
        self.unusual = None
        escaped = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.specials = regex.compile(f"({'|'.join(escaped)})") if escaped else None

    def _joins(self, token: int) -> bool:
        """Whether the text of a merged token is encoded as that token."""
        rank, first, second = self.made_by[token]
        return not any(
            (other := self.rank.get((a, b))) is not None
            and (other < rank)
            and other < a_gone
            and other <= b_gone
            for a, a_gone in self._edge(first, left=False)
            for b, b_gone in self._edge(second, left=True)
        )

    def _edge(self, token: int, left: bool) -> list[tuple[int, float]]:
        """Pieces along one edge of a token, each with the rank at which it is merged away."""
        pieces, gone = [(token, float("inf"))], self.made_by.get(token)
        while gone is not None:
            rank, first, second = gone
            piece = first if left else second
            pieces.append((piece, rank))
            gone = self.made_by.get(piece)
        return pieces

    def stay_apart(self, first: int, second: int) -> bool:
        for a, a_gone in self._edge(first, left=False):
            for b, b_gone in self._edge(second, left=True):
                rank = self.rank.get((a, b))
                # Of equal merges the leftmost goes first: (a, b) beats one that starts at b.
                if rank is not None and rank < a_gone and rank <= b_gone:
                    return False
        return True

    def encode_word(self, word: str) -> tuple[int, ...]:
        spelled = word.encode().decode("latin-1")
        whole = self.whole.get(spelled)
        if whole is not None:
            return (whole,)
        last = [-1] * (len(spelled) + 1)  # of each prefix: its last id
        start = [0] * (len(spelled) + 1)  # and where that one begins
        apart = self.apart
        for place, (token, length) in self.endings.iter(spelled):
            end = place + 1
            if last[end] >= 0:
                continue
            begin = end - length
            if begin:
                before = last[begin]
                if before < 0:
                    continue
                pair = before << 32 | token
                fits = apart.get(pair)
                if fits is None:
                    if len(apart) >= REMEMBERED_PAIRS:
                        apart.clear()
                    fits = apart[pair] = self.stay_apart(before, token)
                if not fits:
                    continue
            last[end], start[end] = token, begin
        ids, end = [], len(spelled)
        while end:
            ids.append(last[end])
            end = start[end]
        return tuple(reversed(ids))

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.unusual is None:
                recent = _recent_letters()
                known = SPLIT.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\p{L}\p{N}]|[RECENT])")
                known = known.replace(r"\p{L}+", r"(?:(?![RECENT])\p{L})+")
                known = known.replace(r"\p{N}+", r"(?:(?![RECENT])\p{N})+")
                self.has_recent = regex.compile(f"[{recent}]") if recent else None
                self.unusual = regex.compile(known.replace("RECENT", recent or r"\p{Cs}"))
            if self.has_recent is not None and self.has_recent.search(text):
                return self.unusual.findall(text)
        return self.usual.findall(text)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        words = self.words
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                ids.append(self.special[part])
                continue
            for word in self.split(part):
                known = words.get(word)
                if known is None:
                    known = self.encode_word(word)
                    if len(word) <= REMEMBERED_LENGTH:
                        if len(words) >= REMEMBERED_WORDS:
                            words.clear()
                        words[word] = known
                ids += known
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(4)
def vocabulary(path: str) -> BytePairs:
    """One per Python worker."""
    return BytePairs(path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary files are; each machine has them in its Python."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every column of ``docs`` and ``token_ids`` (array of int), the ids of the whole text.

    A null text is the empty text: no ids. Repeated rows stay repeated. A column of the input
    called ``token_ids`` is replaced.
    """
    docs = docs.drop("token_ids")
    place = path or vocabulary_path()

    @F.pandas_udf("array<int>")
    def ids_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pairs = vocabulary(place)
        for batch in texts:
            for at in range(0, len(batch), HELD_TEXTS):
                part = batch.iloc[at : at + HELD_TEXTS]
                yield pd.Series([pairs.encode(text or "") for text in part], dtype=object)

    return docs.withColumn("token_ids", ids_of("text"))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Every column of ``encoded`` and ``decoded``, the text its ``token_ids`` spell.

    Bytes that are no UTF-8 become U+FFFD; null ids decode to the empty text.
    """
    place = path or vocabulary_path()

    @F.pandas_udf("string")
    def text_of(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pairs = vocabulary(place)
        for batch in ids:
            yield pd.Series(
                [pairs.decode([] if row is None else list(row)) for row in batch], dtype=object
            )

    return encoded.withColumn("decoded", text_of("token_ids"))


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the text decoded from them.

    One pass per document in one Python stage: ids never travel between processes.
    Null text counts as empty; other columns are ignored; repeated rows stay repeated.
    """
    place = path or vocabulary_path()

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = vocabulary(place)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = pairs.encode(text or "")
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                        hashlib.sha256(pairs.decode(ids).encode()).hexdigest(),
                    )
                )
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole document, as digests."""
    return encode_digests(table(spark, sf_dir, "documents"))
