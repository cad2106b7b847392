import random
import re

import pytest
from pyspark.sql import functions as F

from hitscope.llm import ngram_join


def brute(rows):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = [x for x in (least.get(root(i)), d) if x is not None]
        least[root(i)] = min(ids) if ids else None
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def corpus(seed, bases=12, copies=12):
    """Chains of edits: copies of copies, so that components are wider than links."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcd')}{rng.randrange(60)}"
    passage = [word() for _ in range(40)]
    rows, i = [], 0
    for _ in range(bases):
        text = [word() for _ in range(rng.choice([3, 8, 30, 120]))] + (passage if rng.random() < 0.4 else [])
        family = [text]
        for _ in range(rng.randrange(copies)):
            t = list(rng.choice(family))
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = word()
            family.append(t)
        for t in family:
            rows.append((i * 17 % 5003, rng.choice([" ", "\n"]).join(x.upper() if rng.random() < 0.1 else x for x in t)))
            i += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, documents, seed):
    rows = corpus(seed)
    assert sorted(map(tuple, ngram_join.join(documents(rows).repartition(3)).collect()), key=str) == brute(rows)


def test_a_large_group_without_a_common_hub(spark, documents):
    """Each copy differs from the base in a place of its own; two families share most of their text."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(1000)}" for _ in range(80)]
    rows = []
    for i in range(150):
        t = list(base)
        for k in range(1 + i % 3):
            t[(i * 7 + k * 29) % 80] = f"x{i}"
        rows.append((i, " ".join(t)))
    for i in range(40):
        rows.append((500 + i, " ".join(base[:50] + [f"y{i // 2}_{k}" for k in range(30)])))
    assert sorted(map(tuple, ngram_join.join(documents(rows)).collect()), key=str) == brute(rows)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (6, "a b c d e"), (None, "a b c d e"), (None, "zz"), (9, "é " * 3000), (8, "é " * 2000)]
    got = sorted(map(tuple, ngram_join.join(documents([(a, b, 2) for a, b in rows], ", node int")).collect()), key=str)
    assert got == brute(rows)
    assert ngram_join.join(documents([])).collect() == []


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i * 7919 % 10007, (i + 1) * 7919 % 10007) for i in range(60)] + [(20001, 20000)], "a long, b long")
    got = {r.node: r.label for r in ngram_join.components(links).collect()}
    assert len(got) == 63 and len(set(got.values())) == 2 and got[20000] == got[20001]


def test_one_of_each_keeps_columns(spark, documents):
    rows = corpus(4)
    frame = documents([(a, b, 2) for a, b in rows], ", label int")
    out = ngram_join.one_of_each(frame)
    assert out.columns == frame.columns
    assert {r.doc_id for r in out.collect()} == {c for _, _, c in brute(rows)}


def test_a_chain_in_order_takes_few_rounds(spark, monkeypatch):
    rounds = []
    stored = ngram_join._stored
    monkeypatch.setattr(ngram_join, "_stored", lambda frame, name: (rounds.append(name), stored(frame, name))[1])
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(1000, 1001), (7, 7)], "a long, b long"))
    got = {r.node: r.label for r in ngram_join.components(links).collect()}
    assert {got[i] for i in range(301)} == {0} and got[1001] == 1000 and len(rounds) < 30


def thue_morse(a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(1024))


def test_words_that_collide_under_a_polynomial_hash_do_not_link(documents):
    x, y = thue_morse("a", "b"), thue_morse("b", "a")
    rows = [(1, " ".join([x] * 4 + ["c", "d"])), (2, " ".join([y] * 4 + ["c", "d"])), (3, " ".join([x] * 4 + ["c", "d"]))]
    assert {r.doc_id: r.component_id for r in ngram_join.join(documents(rows)).collect()} == {1: 1, 2: 2, 3: 1}


def test_a_very_long_text(documents):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, long), (2, long + " more"), (3, "w1 w2 w3 w4 w5")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(documents(rows)).collect()}
    assert got == {1: (149_996, 1), 2: (149_997, 1), 3: (1, 3)}


def test_a_large_group_without_adaptive_execution(spark, documents):
    """One group of near copies, with AQE off: all linked, and no task of the last join has them all."""
    rows = [(i, " ".join(f"t{k}" for k in range(40)) + f" end{i % 500}") for i in range(3000)]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ngram_join.join(documents(rows)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert {r.component_id for r in got} == {0} and len(got) == 3000
