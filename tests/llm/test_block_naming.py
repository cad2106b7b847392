import hashlib
import random
import re
from collections import defaultdict

from hitscope.llm import block_naming


def brute(rows):
    groups, out = defaultdict(set), set()
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].add(doc)
    for doc, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        keep = min(groups[body])
        out.add((doc, keep, len(groups[body]), doc == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out)


def test_against_brute_force(spark, documents):
    rng = random.Random(5)
    base = ["é" * n + "x y" * n for n in (0, 1, 700, 2048, 5000)] + ["a  b", "a b", "a\n\tb", " a b", None, "", " ", "\t\t"]
    rows = [(i, rng.choice(base)) for i in range(300)]
    got = sorted(map(tuple, block_naming.deduplicate(documents([(a, b, 1) for a, b in rows], ", kept int")).collect()))
    assert got == brute(rows)


def test_small_blocks_many_levels(spark, documents):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.choice([3, 17, 33])))) for i in range(60)] + [(100 + i, "ab" * 40) for i in range(9)]
    own = block_naming.identities(documents(rows), block_bytes=2).collect()
    names = {r.doc_id: (r.level, r.name) for r in own}
    assert len(own) == len(rows)
    body = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t) for d, t in rows}
    for a in body:
        for b in body:
            assert (names[a] == names[b]) == (body[a] == body[b])


def test_heavy_contents(spark, documents, monkeypatch):
    monkeypatch.setattr(block_naming, "HEAVY_FROM", 3)
    rows = [(i, "same " * 900 if i % 2 else f"own {i % 40} " * 300) for i in range(120)]
    assert sorted(map(tuple, block_naming.deduplicate(documents(rows)).collect())) == brute(rows)


def test_repeated_rows_and_null_id(spark, documents):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "b"), (None, "c")]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in block_naming.deduplicate(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (1, 1, 2, True), (None, 1, 2, False), (None, None, 1, True)], key=str)


def test_empty_table(spark, documents):
    assert block_naming.deduplicate(documents([])).collect() == []


def test_a_very_long_text(spark, documents):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, long), (2, long.replace(" ", "\n", 5)), (3, long + "x"), (4, "x" * 700_000)]
    assert {r.doc_id: r.keep_id for r in block_naming.deduplicate(documents(rows)).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
