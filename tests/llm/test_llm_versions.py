"""Spelling variants, fingerprints and fill-in-middle (11 to 13) against plain loops."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from compare import connect, differences
from roadpulse.llm import fill_middle, fingerprints, spelling
from roadpulse.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    (0, None), (1, ""), (2, " \t\n"), (3, "one"), (3, "one"), (3, "other text of the same id"), (None, "no id"),
    (-4, "x" * 300_000 + " end"), (5, "﻿é  \U0001f600 two  words\r\n "), (2**62, "a b " * 60_000),
    (7, "holds <S> already"), (8, "< P> <P <<M"), (9, "thoughtful thoughtful thoughtfull Thoughtful"),
]


def clashing(spark, rows):
    """Documents with columns that are called like ones that operators make."""
    names = "fim word n key fingerprint versions text.x part edge run first last child".split()
    kinds = ", ".join(f"`{name}` string" for name in names)
    return spark.createDataFrame([(*row, *names) for row in rows], f"doc_id long, text string, {kinds}")


# ---------------------------------------------------------------- spelling


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, spelled=False):
    found = collections.Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            if spelled:
                h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 7 and n >= 2}


def variants(words):
    near_of = collections.defaultdict(list)
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and near(a, b):
            near_of[a].append(b)
            near_of[b].append(a)
    forms = {}
    for word, n in words.items():
        best = min(near_of[word], key=lambda x: (-words[x], x), default=None)
        forms[word] = best if best and words[best] >= 10 * n else None
    rows = []
    for word, n in words.items():
        root = word
        while forms[root]:
            root = forms[root]
        rows.append((word, forms[word], root, n, len(near_of[word]), words.get(forms[word])))
    return sorted(rows, key=lambda x: x[0])


def as_rows(rows):
    return sorted((tuple(x) for x in rows.collect()), key=lambda x: x[0])


def words_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.mark.parametrize("candidates", [0, 2, 64])
def test_variants_equal_comparing_all_words(spark, candidates):
    random.seed(11)
    words = {}
    for length in (1, 2, 3, 7, 8, 9):
        for _ in range(150):
            words["".join(random.choices("abé", k=length))] = random.choice([2, 2, 3, 20, 21, 200, 200, 2000])
    found = spelling.group_variants(words_of(spark, words), candidates=candidates)
    assert as_rows(found) == variants(words)


def test_words_that_share_a_half_are_parted_further(spark):
    random.seed(12)
    words = {"international" + "".join(random.choices("abcdefgh", k=13)): 2 for _ in range(3000)}
    words |= {word[:-1] + "z": 30 for word in list(words)[:50]}
    words |= {word[:20] + word[21:]: 40 for word in list(words)[:50]}
    words |= {"q" + word: 2 for word in list(words)[:50]}
    length = spelling.F.length("word")
    level = words_of(spark, words).select(
        length.cast("long").alias("key"), spelling.F.lit(0).alias("side"), "word", "n",
        spelling.F.lit(0).alias("first"), length.alias("last"),
    )
    # One key holds nearly all words; two turns later none of that size is left.
    sizes = []
    for _ in range(3):
        level = spelling._parted(level)
        sizes.append(level.groupBy("key").count().agg({"count": "max"}).first()[0])
    assert sizes[0] > 2900 and sizes[2] < sizes[0]
    index = collections.defaultdict(set)
    for word in words:
        for i in range(len(word)):
            index[len(word), i, word[:i] + word[i + 1 :]].add(word)
    want = {frozenset(x) for held in index.values() for x in itertools.combinations(held, 2)}
    want |= {frozenset((w, k[2])) for k, held in index.items() if k[2] in words for w in held}
    found = spelling.near_pairs(words_of(spark, words)).collect()
    assert len(found) == len(want) and {frozenset((x.a, x.b)) for x in found} == want


def test_forms_lead_to_the_root(spark):
    words = {"aaaaaaaa": 100_000, "aaaaaaab": 10_000, "aaaaaabb": 1000, "aaaaabbb": 100, "aaaabbbb": 10}
    words |= {"aaaaaaac": 10_001, "zzzzzzz": 5, "zzzzzzy": 50, "zzzzzzx": 50, "zzzzzzzz": 49}
    rows = {x.word: x for x in spelling.group_variants(words_of(spark, words)).collect()}
    assert rows["aaaabbbb"].form == "aaaaabbb" and rows["aaaabbbb"].root == "aaaaaaaa"
    assert rows["zzzzzzz"].form == rows["zzzzzzz"].root == "zzzzzzx" and rows["zzzzzzz"].form_n == 50
    assert rows["aaaaaaaa"].form is None and rows["aaaaaaaa"].root == "aaaaaaaa"
    assert rows["aaaaaaac"].form is None and rows["aaaaaaac"].n_near == 2


def test_spelling_of_odd_rows(spark):
    rows = ODD + [(i, "Repeated reapeated repeated Épated×÷ Ÿnaaaaaaa") for i in range(70)]
    found = spelling.find_variants(clashing(spark, rows), spelled=spelling.misspelled)
    assert as_rows(found) == variants(counted(rows, spelled=True))
    plain = spelling.find_variants(clashing(spark, rows))
    assert as_rows(plain) == variants(counted(rows))
    assert spelling.find_variants(clashing(spark, rows[:0])).collect() == []


def test_spelling_query_equals_sql(spark):
    connection = connect(SF_DIR)
    assert differences(spelling.op11_spelling(spark, SF_DIR), connection, spelling.OP11_SQL) == []
    rows = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    assert as_rows(spelling.op11_spelling(spark, SF_DIR)) == variants(counted(rows, spelled=True))


# ---------------------------------------------------------------- fingerprints


def alike(a, b):
    a, b = (collections.Counter(fingerprints.paragraphs(x)) for x in (a, b))
    total = (a | b).total()
    return (a & b).total() / total if total else 1.0


def followers(rows):
    rows = [(name, text or "") for name, text in rows]
    rows.sort(key=lambda x: (x[0] is None, x[0] or 0))
    return [(name, text, rows[(at + 1) % len(rows)][1]) for at, (name, text) in enumerate(rows)]


def check_fingerprints(found, rows):
    want = {}
    for name, text, after in followers(rows):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        want[name] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), *fingerprints.fingerprint_texts([text, changed]),
            pytest.approx(alike(text, changed), abs=1e-12), pytest.approx(alike(text, after), abs=1e-12),
        )
    assert len(found) == len(rows)
    for row in found:
        assert tuple(row)[1:] == want[row.doc_id], row.doc_id


def test_fingerprint_query_equals_counting_paragraphs(spark):
    rows = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    check_fingerprints(fingerprints.op12_fingerprints(spark, SF_DIR).collect(), rows)


def test_fingerprints_of_odd_rows(spark):
    rows = [x for x in ODD if x[0] != 3] + [(3, "one. two.\nthree"), (20, "same. line.\n" * 50), (21, "same. line.\n" * 50)]
    for number in (1, 5):
        docs = clashing(spark, rows).repartition(number)
        check_fingerprints(fingerprints.with_next(docs).collect(), rows)
    alone = fingerprints.with_next(clashing(spark, [(4, "just one")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert fingerprints.with_next(clashing(spark, [])).collect() == []


def test_repeated_ids_keep_all_rows(spark):
    rows = [(1, f"text {i % 3}. and more.") for i in range(40)] + [(None, None)] * 3
    found = fingerprints.with_next(clashing(spark, rows).repartition(4)).collect()
    assert len(found) == 43 and sum(x.doc_id is None for x in found) == 3
    assert {x.fingerprint for x in found} == set(fingerprints.fingerprint_texts([x or "" for _, x in rows]))


def test_fingerprints_give_small_differences_back():
    random.seed(5)
    lines = [f"line {i} of {random.random()}." for i in range(5000)]
    changed = lines[:100] + ["something new."] + lines[102:] + [lines[7]]
    left, right = fingerprints.fingerprint_texts(["\n".join(lines), "\n".join(changed)])
    assert len(left) == len(right) == len(fingerprints.fingerprint_texts([""])[0])
    a, b = (fingerprints.digests("\n".join(x)) for x in (lines, changed))
    removed, added = fingerprints.compare_fingerprints(left, right)
    assert sorted(removed) == sorted(set(a.tolist()) - set(b.tolist())) and len(removed) == 2
    assert sorted(added) == sorted(set(b.tolist()) - set(a.tolist())) and len(added) == 2
    everything = fingerprints.fingerprint_texts(["\n".join(reversed(lines[:400]))])[0]
    assert fingerprints.compare_fingerprints(left, everything) is None


def test_larger_sketches_recover_any_difference():
    random.seed(6)
    sets = [
        np.unique(np.array([random.getrandbits(64) for _ in range(random.choice([0, 1, 2, 30, 700]))], np.uint64))
        for _ in range(60)
    ]
    sets += [np.concatenate([sets[i], sets[i + 1]]) for i in range(0, 20, 2)]
    left, right = np.array([*range(70), 3]), np.array([*range(1, 70), 0, 3])
    found = fingerprints.differences(fingerprints.Sketches.of(sets, 8), sets, left, right)
    for i, j, (a, b) in zip(left, right, found):
        mine, theirs = set(sets[i].tolist()), set(sets[j].tolist())
        assert set(a.tolist()) == mine - theirs and set(b.tolist()) == theirs - mine
        assert len(a) == len(mine - theirs)


def test_versions_side_by_side(spark):
    rows = [("a. b. c.", "a. c. d."), (None, "x"), ("", None), ("same " * 40, "same " * 40)]
    pairs = spark.createDataFrame(rows, "old string, new string")
    found = [x.versions for x in fingerprints.compare_versions(pairs).collect()]
    assert [(len(x.removed), len(x.added), x.likeness) for x in found] == [(1, 1, 0.5), (0, 1, 0.0), (0, 0, 1.0), (0, 0, 1.0)]
    docs = fingerprints.fingerprint_documents(clashing(spark, ODD))
    assert docs.count() == len(ODD) and len({x.fingerprint for x in docs.collect() if x.doc_id in (0, 1, 2)}) == 1


# ---------------------------------------------------------------- fill in middle

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def transformed(name, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if name is None else name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", text, None, None
    if h4 % 100 < 80:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def test_cuts_equal_counting_units():
    random.seed(13)
    for _ in range(400):
        text = "".join(random.choices("aé\U0001f600 \n\t ", k=random.randint(0, 60)))
        units = UNIT.findall(text)
        tree = fill_middle.BlockTree(text.encode(), block=random.choice([1, 2, 7, 1024]))
        assert tree.n_units == len(units)
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert tree.cut(k) == (len(before.encode()), len(before)), (text, k)


def test_fill_middle_of_odd_rows(spark):
    rows = ODD + [(i, f"  some words {i} été\n and \U0001f600 more  ") for i in range(100, 200)]
    docs = fill_middle.fill_middle(clashing(spark, rows)).withColumn(
        "again", fill_middle.restored(fill_middle.F.col("fim.form"), fill_middle.F.col("fim.text"))
    )
    found = docs.select("doc_id", "text", "fim", "again", "word", "`text.x`").collect()
    assert len(found) == len(rows) and {x["fim"].form for x in found} == {"plain", "psm", "spm"}
    for row in found:
        assert tuple(row.fim) == transformed(row.doc_id, row.text), row.doc_id
        assert row.again == (row.text or "") and row.word == "word"
    assert fill_middle.fill_middle(clashing(spark, [])).collect() == []


def test_other_marks(spark):
    how = fill_middle.FillMiddle("[pre|", "$suf.", "(mid", seed=1, cut_percent=100, suffix_first_percent=50)
    docs = spark.createDataFrame([(i, f"a{i} b c <P> d") for i in range(40)], "doc_id long, text string")
    found = fill_middle.fill_middle(docs, how)
    again = fill_middle.restored(fill_middle.F.col("fim.form"), fill_middle.F.col("fim.text"), how)
    rows = found.select("text", "fim.form", again.alias("again")).collect()
    assert {x.form for x in rows} == {"psm", "spm"} and all(x.text == x.again for x in rows)


def test_fill_middle_query_equals_sql(spark):
    connection = connect(SF_DIR)
    assert differences(fill_middle.op13_fill_middle(spark, SF_DIR), connection, fill_middle.OP13_SQL) == []
