"""The pipeline on a small corpus: each stage against its rule on the stage's own input."""

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from hitscope.session import scratch_path
from test_line_join import brute as brute_lines
from test_ngram_join import brute as brute_components


@pytest.fixture(scope="module")
def stages(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioudnrst") for _ in range(rng.randrange(2, 6)))
    texts = []
    for i in range(260):
        lines = [" ".join(word() for _ in range(rng.randrange(3, 40))) for _ in range(rng.randrange(1, 4))]
        if i % 3 == 0:
            lines.insert(0, " ".join([rng.choice(["zorgling", "zorglet"]), word(), rng.choice(["zorgling", "mudhat"])]))
        elif texts and i % 5 == 0:
            lines = texts[rng.randrange(len(texts))].split("\n") + [word()]
        elif texts and i % 7 == 0:
            lines = texts[rng.randrange(len(texts))].split("\n")
        texts.append("\n".join(lines))
    rows = [(i, t, "en", f"src{i % 4 % 3}", len(t)) for i, t in enumerate(texts)]
    path = scratch_path(spark, "tests")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int("zorgl" in t)) for i, t in enumerate(texts)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stored = scratch_path(spark, "tests")
        stage(spark, docs, path).write.parquet(stored)
        after = spark.read.parquet(stored)
        out.append((name, docs, after))
        docs = after
    return path, out


def test_each_stage(stages):
    _, out = stages
    (_, docs, clean), (_, _, lines), (_, _, single), (_, _, mixed), (_, _, tokens) = out
    assert all(after.columns == docs.columns for _, _, after in out[:-1])
    before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in clean.collect()}
    assert sum((d in after) == ("zorgl" not in t) for d, t in before.items()) > 0.97 * len(before)
    assert all(after[d] == before[d] for d in after)
    want = {d: t for d, _, n, t in brute_lines(list(after.items())) if not n or t.split()}
    left = {r.doc_id: r for r in lines.collect()}
    assert {d: r.text for d, r in left.items()} == want and all(r.n_chars == len(r.text) for r in left.values())
    assert {r.doc_id for r in single.collect()} == {c for _, _, c in brute_components(list(want.items()))}
    times, size = Counter(r.doc_id for r in mixed.collect()), {r.doc_id: (r.source, len(re.findall(r"\S+", r.text))) for r in single.collect()}
    assert set(times) <= set(size) and max(times.values()) <= 2
    total, taken = defaultdict(int), defaultdict(int)
    for d, (source, n) in size.items():
        total[source] += n
        taken[source] += n * times.get(d, 0)
    weights = {"src0": 3, "src1": 1, "src2": 2}
    for s in total:
        assert taken[s] <= 2 * total[s]
    assert sum(taken.values()) == pytest.approx(1.5 * sum(total.values()), rel=0.1)
    assert taken["src1"] < taken["src0"] and set(weights) == set(total)
    assert sorted(r.doc_id for r in tokens.collect()) == sorted(times.elements())


def test_run_equals_the_stages(spark, stages):
    path, out = stages
    got = sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, path).collect())
    assert got == sorted((r.doc_id, r.ids_sha256) for r in out[-1][2].collect())


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, copies int, row int"


def through(spark, rows, labels):
    """The tables after each stage, for documents with columns whose names the operators use too."""
    path = scratch_path(spark, "tests")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stored = scratch_path(spark, "tests")
        stage(spark, docs, path).write.parquet(stored)
        docs = spark.read.parquet(stored)
        out.append((name, docs.columns, docs.collect()))
    return out


def test_odd_rows_through_all_stages(spark):
    """Nulls in every column, empty and very long texts, repeated rows and clashing names."""
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(60_000))
    rows = [(1, long, "en", "a", len(long), 1, 1), (2, None, None, None, None, None, None), (3, "", "en", "b", 0, 1, 1), (None, "a text without an id stands here", "en", "a", 32, 1, 1)]
    rows += [(10, "the same row four times", "en", "c", 23, 1, 1)] * 4 + [(20 + i, f"document number {i} has words of its own like x{i}", "en", "ab"[i % 2], 45, i, i) for i in range(30)]
    out = through(spark, rows, [])
    (_, columns, clean), (_, _, lines), (_, _, single), (_, _, mixed), (_, _, tokens) = out
    assert columns == [c.split()[0] for c in COLUMNS.split(", ")] == out[3][1]
    assert len(clean) == len(lines) == len(single) == len(rows)
    assert sorted(map(str, clean)) == sorted(map(str, single)) or len({r.doc_id for r in single}) == len({r.doc_id for r in clean})
    assert next(r for r in single if r.doc_id == 1).text == long
    assert not [r for r in mixed if not r.text] and max(Counter(r.doc_id for r in mixed if r.doc_id != 10).values()) <= 2
    assert sorted(str(r.doc_id) for r in tokens) == sorted(str(r.doc_id) for r in mixed)


def test_empty_tables_through_all_stages(spark):
    assert all(rows == [] for _, _, rows in through(spark, [], []))
