"""Operators over many rows at once: 3, 4, 5, 8, 9, 10 and the pipeline."""

from __future__ import annotations

import collections
import os
import random
import shutil
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare
import corpus_pipeline
from llm import plain
from roadpulse.llm import (
    embedding_dedup,
    minhash,
    mixing,
    neighbours,
    quality,
    queries,
    url_filter,
)
from roadpulse.llm.common import connected_components, table

SF_DIR = "/root/testdata/sf0.01"
ROOT = os.path.dirname(os.path.abspath(contract.__file__))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    rows = queries.queries()[name](spark, SF_DIR)
    assert compare.differences(rows, compare.connect(SF_DIR), queries.oracle_sql()[name]) == []


def test_one_query_for_each_operator():
    names = [name for name in contract.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_library_works_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True
    )
    own = [x for x in contract.queries() if not x.startswith("op") and x != "pipeline"]
    assert done.stdout.split()[0] == str(len(own)), done.stderr


def test_components(spark):
    random.seed(2)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(50)]
    edges += [(5000, 5000), (None, 1)]
    groups = plain.Groups({x for edge in edges for x in edge if x is not None})
    for a, b in edges:
        if a is not None and b is not None:
            groups.link(a, b)
    ids = {x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    rows = connected_components(spark.createDataFrame(edges, "a long, b long"), "test")
    assert {r.id: r.component for r in rows.collect()} == {x: groups.root(x) for x in ids}
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty, "test").collect() == []


def near(rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows.collect()}


def test_near_documents_equal_all_pairs(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = minhash.near_duplicates(docs).cache()
    assert near(found) == plain.near_documents(rows)
    assert found.where("kept <> (doc_id = component_id)").count() == 0


def test_near_documents_just_around_the_threshold(spark):
    """A large group around one text whose members are partly linked, partly just not."""
    random.seed(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(random.randint(0, 9)):
            words[random.randrange(150)] = f"x{random.random()}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near(minhash.near_duplicates(docs)) == plain.near_documents(rows)


def test_near_documents_odd_rows(spark):
    texts = [None, "", " \n\t", "one", "ONE", "one two", "a b c d", "A b\tc  d", "a b c d e"]
    texts += ["\u00e9 x b c d", "\u00c9 x b c d", "a\u00a0b c d e", "a b c d e f g h i j", "a b c d e f g h i j k"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert near(minhash.near_duplicates(docs)) == plain.near_documents(rows)


def test_near_dedup_stage_compares_five_words(spark):
    # 45 words, one inner word differs: 0.83 alike on four words, below 0.8 on five.
    one = [f"w{i}" for i in range(45)]
    two = [*one[:20], "other", *one[21:]]
    docs = spark.createDataFrame([(0, " ".join(one)), (1, " ".join(two))], "doc_id long, text string")
    assert minhash.one_per_group(docs).count() == 1
    assert corpus_pipeline.near_dedup(spark, docs, SF_DIR).count() == 2


def test_near_documents_repeated_and_null_ids(spark):
    rows = [(3, "a b c d e"), (3, "a b c d e"), (3, "q w e r t y"), (None, "a b c d e")]
    rows += [(2, "q w e r t y"), (1, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x"))
    found = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)
    assert found == sorted(
        [(3, 2, 1, False), (3, 2, 1, False), (3, 3, 1, False), (None, 2, None, True)]
        + [(2, 3, 1, False), (1, 2, 1, True)],
        key=str,
    )
    left = minhash.one_per_group(docs).collect()
    assert sorted([(r.doc_id, r.text) for r in left], key=str) == [(1, "a b c d e"), (None, "a b c d e")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).collect() == []


def test_min_and_max_values_agree_with_similarity():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.sort(tokens[:2700]), np.sort(tokens[300:])  # 2400 of 3000 shared
    agree = (minhash.signature(a) == minhash.signature(b)).mean(axis=1)
    assert abs(agree - 0.8).max() < 0.12


def mixed(spark, rows, tmp_path):
    place = str(tmp_path / "in")
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(
        f"{place}/documents.parquet"
    )
    return mixing.op3_mixing(spark, place)


def check_mix(docs, rows, close):
    sizes = collections.Counter()
    for _, text, source in docs:
        sizes[source] += len((text or "").encode().split())
    targets = plain.water_filled(sizes)
    taken = collections.Counter()
    by_id = {doc_id: (text, source) for doc_id, text, source in docs}
    assert len(rows) == len(docs)
    for row in rows:
        text, source = by_id[row.doc_id]
        size = len((text or "").encode().split())
        assert (row["size"], row.source_size) == (size, sizes[source])
        assert row.target == pytest.approx(targets[source], rel=1e-9)
        assert 0 <= row.taken <= 2 * size and (not size or row.taken % size == 0)
        taken[source] += row.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= close(source), source


def test_mix_of_documents(spark):
    docs = [(r.doc_id, r.text, r.source) for r in table(spark, SF_DIR, "documents").collect()]
    rows = mixing.op3_mixing(spark, SF_DIR).collect()
    largest = collections.defaultdict(int)
    for _, text, source in docs:
        largest[source] = max(largest[source], len((text or "").split()))
    check_mix(docs, rows, lambda source: largest[source] / 2 + 1)
    assert sorted(rows) == sorted(mixing.op3_mixing(spark, SF_DIR).collect())


def test_mix_over_several_levels(spark, tmp_path):
    random.seed(3)
    docs = [
        (i, "w " * random.randint(0, 30), random.choice(["a"] * 6 + ["b", "\U0001f600", "\uffff", None]))
        for i in range(9000)
    ]
    # The hot source has several leaves; what is left is half a document at most.
    check_mix(docs, mixed(spark, docs, tmp_path).collect(), lambda source: 16)


def test_mix_odd_rows(spark, tmp_path):
    docs = [(1, "a b", "s")] * 5 + [(2, None, "t"), (3, "", None), (None, "x y z", None), (4, "q w e", None)]
    rows = mixed(spark, docs, tmp_path).collect()
    assert len(rows) == len(docs)
    assert [r.taken for r in rows if r.doc_id == 1] == [4] * 5
    assert [r.taken for r in rows if r.doc_id in (2, 3)] == [0, 0]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    again = mixing.mixed_documents(frame.withColumn("size", F.lit("kept")))
    assert again.columns == ["doc_id", "text", "source", "size"]
    counts = collections.Counter(r.doc_id for r in again.collect())
    assert counts[1] == 10 and counts[2] == counts[3] == 1 and counts[4] + counts[None] == 1


def test_mix_of_nothing(spark, tmp_path):
    assert mixed(spark, [], tmp_path).collect() == []


def test_expected_copies_are_kept_over_seeds(spark):
    """Each document's copies average to target / size: the rounding is not biased."""
    sized = spark.createDataFrame([("s", i, 10) for i in range(12)], "source string, key long, size long")
    targets = spark.createDataFrame([("s", 120, 42.0)], "source string, source_size long, target double")
    runs = [
        {r.key: r.copies for r in mixing.copies(sized, targets, seed=seed).collect()} for seed in range(12)
    ]
    assert all(sum(run.values()) in (4, 5) for run in runs)
    assert len({tuple(sorted(run.items())) for run in runs}) > 1


def test_mix_plan_has_no_python(spark, plan):
    text = plan(mixing.op3_mixing(spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text


URLS = [None, "", "x", "http://", "://com/", "http://A.COM", "http://a.com/", "http://com/x"]
URLS += ["https://WWW.Example.com/en/?q#f", "http://example.com/en", "http://x.example.com/en/a"]
URLS += ["ftp://notexample.com/en/", "a://b://net/es/", "http://u@net:80/es/", "http://.net/es/"]
URLS += ["http://\u00c9.net/fr/x\ny", "http://a..net/fr/", "http://net/es/", "http://net/es/"]


def rules(spark, more=()):
    rows = [(host, path, verdict) for verdict, host, path in url_filter.RULES]
    return spark.createDataFrame([*rows, *more], "host string, path string, verdict string")


def test_urls_by_index_join_and_sql_agree(spark):
    random.seed(1)
    parts = ["a.", "net", "com", ".", "example.", "www.", "/en/", "/es/", "/", "?", "#", "e"]
    urls = URLS + ["http://" + "".join(random.choices(parts, k=random.randint(0, 8))) for _ in range(800)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filter.judge_urls(pages, rules(spark))
    joined = url_filter.judge_urls(pages, rules(spark), most_index_bytes=0)
    assert sorted(found.collect(), key=str) == sorted(joined.collect(), key=str)
    connection = compare.duckdb.connect()
    connection.register("pages", pages.toPandas())
    assert compare.differences(found.drop("url"), connection, url_filter.OP4_SQL) == []


def test_urls_odd_rules_and_columns(spark):
    pages = spark.createDataFrame(
        [(1, "http://net/es/", "h"), (1, "http://net/es/", "h"), (2, None, None)],
        "page_id long, url string, host string",
    )
    more = [(None, "/", "block"), ("", "/", "block"), ("net", "/es/", "block"), ("net", None, "block")]
    for bound in (0, 1 << 20):
        rows = url_filter.judge_urls(pages, rules(spark, more), most_index_bytes=bound).collect()
        assert sorted(map(tuple, rows), key=str) == [
            (1, "http://net/es/", "net", "/es/", "net/es/", "block"),
            (1, "http://net/es/", "net", "/es/", "net/es/", "block"),
            (2, None, "", "", None, "allow"),
        ]
        none = url_filter.judge_urls(pages, rules(spark).limit(0), most_index_bytes=bound)
        assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "allow")}
        assert url_filter.judge_urls(pages.limit(0), rules(spark), most_index_bytes=bound).collect() == []


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda strings: np.full(len(strings), 7, np.uint64))
    stored = [("net/", "block"), ("com/", "allow"), ("org/", "block")]
    index = url_filter.DigestArray(*url_filter.DigestArray.write(str(tmp_path), stored))
    assert index.find(["com/", "net/", "x/"]) == [("com/", "allow"), ("net/", "block"), None]


def test_near_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(30, 8))
    rows = []
    for i in range(400):
        vector = base[i % 30] + rng.normal(size=8) * rng.choice([0, 0.1, 0.2, 0.4])
        vector = vector * rng.choice([1, 1e-3, 1e20])
        rows.append((i, [float(x) for x in vector], i % 3 if i % 17 else None))
    rows += [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 8, 1), (1003, [None] * 8, 1)]
    rows += [(1004, [float("nan")] * 8, 1), (1005, [float("inf")] * 8, 1), (None, rows[1][1], 1)]
    rows += [(5, rows[5][1], 2)] * 2 + [(2000, [1.0], 1), (2001, [2.0], 1), (2002, [-1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(frame.withColumn("id", F.lit("x")))
    got = sorted([(r.vec_id, r.n_links, r.component_id) for r in found.collect()], key=str)
    assert got == plain.near_vectors(rows)


def test_near_vectors_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    rng = np.random.default_rng(4)
    rows = [
        (i, [float(x) for x in np.r_[np.ones(6), 0, 0] + rng.normal(size=8) * 0.3], 1)
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = embedding_dedup.near_duplicates(frame)
    got = sorted([(r.vec_id, r.n_links, r.component_id) for r in found.collect()], key=str)
    assert got == plain.near_vectors(rows)


def test_near_vectors_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).collect() == []


def check_nearest(found, rows, least):
    want = plain.nearest_rows(rows)
    got = collections.defaultdict(dict)
    for row in found:
        got[row.query_id][row["rank"]] = (row.vec_id, row.score)
    hits = total = 0
    for query, best in want.items():
        mine = got[query]
        assert sorted(mine) == list(range(1, len(best) + 1))
        ordered = [mine[rank] for rank in sorted(mine)]
        assert ordered == sorted(ordered, key=lambda x: (-x[1], x[0]))
        scores = dict(best)
        assert all(s == pytest.approx(scores[v], rel=1e-9) for v, s in ordered if v in scores)
        hits += len({x[0] for x in ordered} & {x[0] for x in best})
        total += len(best)
    assert hits >= least * total


def test_nearest_rows_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    found = neighbours.op8_neighbours(spark, "/root/testdata/sf0.1").collect()
    check_nearest(found, rows, 0.9)


def test_nearest_rows_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=5) * rng.lognormal()]) for i in range(200)]
    rows += [(400 + i, [1.0, 2.0, 0.0, 0.0, 1.0]) for i in range(50)]
    rows += [(500, None), (520, [0.0] * 5), (540, [None] * 5), (560, [float("nan")] * 5)]
    frame = spark.createDataFrame([*rows, (None, [1.0] * 5), (580, [1.0])], "vec_id long, embedding array<double>")
    found = neighbours.nearest_rows(frame.withColumn("score", F.lit("x")), F.col("vec_id") % 20 == 0, 20)
    check_nearest(found.collect(), rows, 0.99)


def test_nearest_rows_of_several_lengths_and_repeated_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=3 + i % 3)]) for i in range(90)]
    rows += [(20, [1.0, 0.5, 0.25]), (20, [0.5, 1.0, 0.25]), (7, [0.1, 0.2, 0.3]), (7, [0.1, 0.2, 0.3])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest_rows(frame, F.col("vec_id") % 20 == 0, 20).collect()
    distinct = sorted({(v, tuple(x)) for v, x in rows})
    got = collections.defaultdict(list)
    for row in sorted(found, key=lambda x: x["rank"]):
        got[row.query_id].append((row.vec_id, round(row.score, 9)))
    for query in range(0, 90, 20):
        want = []
        for vector in [x for v, x in distinct if v == query]:
            scores = [
                (v, round(sum(a * b for a, b in zip(vector, x)), 9))
                for v, x in distinct
                if v != query and len(x) == len(vector)
            ]
            want += sorted(scores, key=lambda x: (-x[1], x[0]))[:20]
        assert sorted(got[query]) == sorted(want)


def test_nearest_rows_of_a_hot_node(spark, monkeypatch):
    """Copies of one vector walk once, and lists that many walks open meet them in a join of their own."""
    monkeypatch.setattr(neighbours, "HOT", 3)
    monkeypatch.setattr(neighbours, "SHARING", 50)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(1500)]
    rows += [(20 * i, [1.0] * 6) for i in range(100, 400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest_rows(frame, F.col("vec_id") % 20 == 0, 20).collect()
    check_nearest(found, rows, 0.99)
    assert [x for x in spark.catalog.listTables() if x.name.startswith("nn_graph")] == []


def test_best_entries_equal_a_plain_loop():
    rng = np.random.default_rng(3)
    rows, ids = rng.integers(0, 5, 600), rng.integers(0, 60, 600)
    scores = rng.normal(size=(5, 30)).astype(np.float32)[rows, ids >> 1]
    want = []
    for row in range(5):
        smallest = {}
        for i, score in sorted(zip(ids[rows == row], scores[rows == row])):
            smallest.setdefault(i >> 1, (-score, i))
        want += [(row, i, -score) for score, i in sorted(smallest.values())[:7]]
    assert [*zip(*neighbours.best(rows, ids, scores, 7, same=1))] == want


def test_neighbours_graph_moves_rows_of_blocks_not_of_links(spark, monkeypatch):
    """Two blocks of nodes exchange one row, whatever their links; a row of the graph has many nodes."""
    monkeypatch.setattr(neighbours, "BLOCK", 400)
    answers, sent = neighbours._answers, []

    def counted(states, blocks, salt):
        sent.append(answers(states, blocks, salt).count())
        return answers(states, blocks, salt)

    monkeypatch.setattr(neighbours, "_answers", counted)
    vectors = np.random.default_rng(4).normal(size=(2000, 8))
    frame = spark.createDataFrame([([float(x) for x in v],) for v in vectors], "embedding array<double>")
    nodes, labels = neighbours.placed(neighbours.nodes_of(frame))
    graph, longest = neighbours.build_graph(nodes, labels)
    try:
        pages = graph.collect()
    finally:
        neighbours.drop_graph(graph)
    assert len(labels) == 5 and max(sent) <= 5 * 6
    assert len(pages) <= 2000 / neighbours.PAGE + 5
    found = nodes.orderBy("place").collect()
    places = np.array([x.place for x in found])
    wide = np.array([x.embedding for x in found]) / longest
    wide = np.c_[wide, np.sqrt(np.maximum(1 - (wide * wide).sum(axis=1), 0))]
    near, hits = wide @ wide.T - 9 * np.eye(2000), 0
    for page in pages:
        ids = np.frombuffer(page.ids, np.int64)
        codes = neighbours.decode(np.frombuffer(page.codes, np.uint8).reshape(len(ids), -1))
        assert np.abs(codes - wide[np.searchsorted(places, ids)]).max() < 0.01
        ends = np.cumsum(np.frombuffer(page.sizes, np.int32))
        for i, (a, b) in enumerate(zip([0, *ends], ends)):
            own = np.searchsorted(places, (page.to << neighbours.SHIFT) + page.first + i)
            assert places[own] not in ids[a:b] and len(set(ids[a:b])) == b - a <= neighbours.LINKS + neighbours.BACKLINKS
            hits += len(set(places[np.argsort(-near[own])[:10]]) & set(ids[a:b]))
    assert hits >= 0.97 * 20_000


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(3, [1.0]), (5, [1.0])]])
def test_nearest_of_almost_nothing(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert neighbours.nearest_rows(frame, F.col("vec_id") % 20 == 0, 20).collect() == []


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    rows = [r for r in quality.op9_quality(spark, "/root/testdata/sf0.1").collect()]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    good = [r.predicted for r in held if labels[r.doc_id] == 1]
    bad = [r.predicted for r in held if labels[r.doc_id] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_quality_votes_equal_a_plain_loop(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, "/root/testdata/sf0.01", "labels"))
    rows = quality.with_scores(docs, model).orderBy("doc_id").collect()[::10]
    for row in rows:
        point = quality.project(quality.terms(row.text)[None, :], model.projection)[0]
        cosines = [float(sum(a * b for a, b in zip(point, other))) for other in model.vectors]
        nearest = sorted(range(len(cosines)), key=lambda i: -cosines[i])[: quality.NEIGHBOURS]
        votes, total = quality.PRIOR_WEIGHT * model.prior, quality.PRIOR_WEIGHT
        for i in nearest:
            weight = max(cosines[i], 0) ** quality.SHARPNESS
            votes, total = votes + weight * model.labels[i], total + weight
        assert row.score == pytest.approx(votes / total, abs=1e-4)


def test_quality_held_out_rows_are_never_learnt_from(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    held = docs.where(quality.held_out(F.col("doc_id")))
    labels = held.select("doc_id", F.lit(0).alias("quality"))
    assert len(quality.fit(docs, labels).labels) == 0
    import zlib

    want = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(r.doc_id for r in held.collect()) == want


def test_quality_odd_rows(spark):
    rows = [(1, ""), (2, None), (None, "a b"), (4, "a" * 100_000), (4, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    scored = quality.with_scores(docs, quality.fit(docs, none)).collect()
    assert [r.score for r in scored] == [1.0] * 5
    odd = spark.createDataFrame([(1, 1), (1, None), (4, 0), (4, 0), (None, 1)], "doc_id long, quality int")
    scored = quality.with_scores(docs, quality.fit(docs, odd)).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
    assert quality.good_documents(docs.limit(0), odd).collect() == []


def test_pipeline_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    names = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "secrets", "mixing", "tokens"]

    good = stages["quality"](spark, docs, SF_DIR).cache()
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == names and kept < set(rows)
    clean = [i for i in rows if labels.get(i) == 1]
    assert sum(i in kept for i in clean) > 0.98 * len(clean)

    single = stages["near_dedup"](spark, good, SF_DIR).cache()
    groups = plain.near_documents([(i, rows[i].text) for i in kept], corpus_pipeline.STAGE_SHINGLE_WORDS)
    assert single.columns == names
    assert sorted(r.doc_id for r in single.collect()) == sorted({x for _, x in groups.values()})

    safe = stages["secrets"](spark, single, SF_DIR).cache()
    assert safe.columns == names and safe.count() == single.count()
    for row in safe.collect():
        found = plain.secrets(rows[row.doc_id].text)
        assert not plain.secrets(row.text)
        if not found and "[SECRET]" not in (row.text or ""):
            assert row == rows[row.doc_id]
        elif row.text is not None:
            assert row.n_chars == len(row.text)

    mix = stages["mixing"](spark, safe, SF_DIR).cache()
    assert mix.columns == names
    copies = collections.Counter(r.doc_id for r in mix.collect())
    assert max(copies.values()) == 2 and set(copies) <= {r.doc_id for r in safe.collect()}

    tokens = stages["tokens"](spark, mix, SF_DIR)
    assert tokens.count() == mix.count()
    assert tokens.where("n_tokens <> size(token_ids)").count() == 0


def test_pipeline_on_nothing(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], shape).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_odd_columns(spark):
    """Extra columns, also with names that operators use themselves or that need quotes."""
    rows = [(i, f"some words of text number {i}", "s", 1, "x", "y") for i in range(6)]
    names = ["doc_id", "text", "source", "id", "a.b", "n`c"]
    docs = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(0, 1)], "doc_id long, quality int")
    kept = minhash.one_per_group(quality.good_documents(docs, labels))
    assert kept.columns == names and kept.count() == 6
    assert mixing.mixed_documents(kept).columns == names
    pages = docs.withColumn("url", F.lit("http://net/es/")).withColumn("rule", F.lit("old"))
    judged = url_filter.judge_urls(pages, rules(spark))
    assert judged.columns == [*names, "url", "host", "path", "rule", "verdict"]
    assert {r.rule for r in judged.collect()} == {"net/es/"}


def test_consumed_tables_can_be_discarded(spark):
    from roadpulse.llm.common import discard, saved

    rows = saved(spark.range(3).toDF("id"), "test")
    assert rows.count() == 3 and os.path.isdir(rows.saved_path.removeprefix("file:"))
    discard(rows)
    assert not os.path.exists(rows.saved_path.removeprefix("file:"))


def test_components_of_text_ids(spark):
    edges = spark.createDataFrame([("c", "b"), ("b", "a"), ("x", "y")], "a string, b string")
    found = {r.id: r.component for r in connected_components(edges, "test").collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
