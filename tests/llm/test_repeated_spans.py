import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hitscope.llm import repeated_spans
from hitscope.llm.count_min import gaps_packed, gaps_unpacked, sketch

K = 13


def brute(rows):
    least = {}
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - K + 1):
            key = tuple(w[i : i + K])
            least[key] = min(least.get(key, 1 << 62), 1 << 62 if d is None else d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - K + 1):
            if least[tuple(w[i : i + K])] < (1 << 62 if d is None else d):
                gone.update(range(i, i + K))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    passages = [[f"p{k}é{j}" for j in range(rng.choice([12, 13, 14, 40]))] for k in range(8)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(4)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(30))]
        rows.append((i * 7 % 1009, "".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words)))
    return rows


def got(frame, **heavy):
    return sorted(map(tuple, repeated_spans.digest(frame, **heavy).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, documents, seed):
    rows = corpus(seed)
    assert got(documents(rows).repartition(5)) == brute(rows)


def test_heavy_windows(spark, documents):
    rows = corpus(3)
    low = {"heavy_in_slice": 4, "heavy_from": 5}
    assert len(sketch(documents(rows).coalesce(1), repeated_spans._window_hashes, **low).heavy)
    assert got(documents(rows).coalesce(1), **low) == brute(rows)


def test_odd_rows(spark, documents):
    same = " ".join(f"w{i}" for i in range(20))
    rows = [(1, same), (1, same), (1, same + " x"), (2, same.upper()), (2, f"a  {same}\n\nb"), (None, same), (3, None), (4, ""), (5, "one two"), (6, same[:-4])]
    assert got(documents([(a, b, 3) for a, b in rows], ", n_words int")) == brute(rows)
    assert got(documents([])) == []


def test_sketch_loses_nothing(spark, documents):
    rows = corpus(5)
    seen = sketch(documents(rows), repeated_spans._window_hashes)
    once, often = set(), set()
    for _, t in rows:
        w = t.split()
        for i in range(len(w) - K + 1):
            key = " ".join(w[i : i + K])
            (often if key in once else once).add(key)
    import pyarrow as pa

    from hitscope.llm.textio import sequence_hashes, words

    found = words(pa.array(sorted(often)))
    hashes, _, _ = sequence_hashes(found.hashes(), found.first, K)
    assert len(hashes) == len(often) and seen.may_repeat(hashes).all()


def test_gaps_round_trip():
    rng = np.random.default_rng(1)
    for top in (1, 10, 254, 255, 256, 100_000):
        values = np.cumsum(rng.integers(0, top, 500))
        assert gaps_unpacked(gaps_packed(values)).tolist() == values.tolist()
    assert len(gaps_unpacked(b"")) == 0


def thue_morse(a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(1024))


def digest_of(documents, rows):
    return {r.doc_id: r.n_removed for r in repeated_spans.digest(documents(rows)).collect()}


def test_words_that_collide_under_a_polynomial_hash_stay(documents):
    x, y = thue_morse("a", "b"), thue_morse("b", "a")
    rest = " ".join(f"w{i}" for i in range(12))
    assert digest_of(documents, [(1, f"{x} {rest}"), (2, f"{y} {rest}"), (3, f"{x} {rest}")]) == {1: 0, 2: 0, 3: 13}


def test_windows_of_one_hash_are_told_apart(documents, monkeypatch):
    """With hashes of a few bits only, the further bits of the words decide."""
    full = repeated_spans.sequence_hashes

    def few(hashes, first, size):
        values, doc, start = full(hashes, first, size)
        return values >> np.uint64(62) << np.uint64(62), doc, start

    rows = [(i, " ".join(f"d{i % 40}w{k}" for k in range(15))) for i in range(80)]
    found = repeated_spans.words(pa.array([t for _, t in rows]))
    monkeypatch.setattr(repeated_spans, "sequence_hashes", few)
    ids = np.arange(80, dtype=np.int64)
    values, doc, start = few(found.hashes(), found.first, 13)
    checks = repeated_spans.sequence_checks(found.hashes(), start, 13)
    own = start - found.first[doc]
    count = np.bincount(doc).astype(np.uint32)
    length = np.diff(found.first).astype(np.uint32)
    far = own + np.repeat(np.cumsum(np.append(0, length[:-1])), count)
    row = [0, ids.tobytes(), np.zeros(80, np.int32).tobytes(), count.tobytes(), length.tobytes(), repeated_spans.gaps_packed(far), values.tobytes(), checks.tobytes()]
    batch = pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int32()), *(pa.array([c], pa.binary()) for c in row[1:])], ["range", "ids", "tags", "counts", "lengths", "starts", "hashes", "checks"])
    gone = [r for b in repeated_spans._grouped(np.empty(0, np.uint64))(iter([batch])) for r in b.to_pylist()]
    assert {r["order"] for r in gone} == set(range(40, 80))


def test_a_very_long_text(documents):
    long = " ".join(f"w{i}" for i in range(200_000))
    assert digest_of(documents, [(1, long), (2, long), (3, "w5 " * 12)]) == {1: 0, 2: 200_000, 3: 0}
