import itertools
import random

import numpy as np
import pyarrow as pa

from hitscope.llm import textio


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_that_collide_under_powers_modulo_two_to_the_64():
    """Any base has this collision at 1024 and more letters."""
    for n in (64, 1024, 2048):
        x, y = thue_morse(n), thue_morse(n, "b", "a")
        h = textio.words(pa.array([x, y, f"{x} {y}"])).hashes()
        assert h[0] != h[1] and h[0] == h[2] and h[1] == h[3]


def test_equal_words_hash_alike_wherever_they_stand():
    rng = random.Random(3)
    pool = ["a", "ab", "é", "x" * 63, "x" * 64, "x" * 65, "y" * 5000, "B\x00c"]
    texts = [" \t\n"[i % 3] * (i % 7) + "  ".join(rng.choice(pool) for _ in range(i % 50)) for i in range(300)]
    found = textio.words(pa.array(texts))
    by_word: dict = {}
    for word, h in zip(itertools.chain(*([w for w in t.replace("\t", " ").replace("\n", " ").split(" ") if w] for t in texts)), found.hashes().tolist(), strict=True):
        by_word.setdefault(word, set()).add(h)
    assert all(len(h) == 1 for h in by_word.values()) and len({next(iter(h)) for h in by_word.values()}) == len(by_word)


def test_lower_case_and_many_words():
    found = textio.words(pa.array(["Ab AB ab " + "W" * 100 + " " + "w" * 100]))
    h = found.hashes(lower=True)
    assert len(set(h[:3].tolist())) == 1 and h[3] == h[4]
    words = [f"{a}{b}{c}" for a, b, c in itertools.product("abcdefghij", repeat=3)] * 300
    h = textio.words(pa.array([" ".join(words)])).hashes()
    assert len(np.unique(h)) == 1000


def test_distinct_values_of_groups():
    rng = np.random.default_rng(4)
    for high in (3, 1 << 40):
        values = rng.integers(0, high, 5000).astype(np.uint64) * np.uint64(high if high < 9 else 1)
        group = rng.integers(0, 50, 5000)
        got = distinct = textio.distinct_in_groups(values, group)
        assert list(zip(got[1].tolist(), got[0].tolist())) == sorted(set(zip(group.tolist(), values.tolist())))
    got = textio.distinct_in_groups(values, group + (1 << 20))
    assert np.array_equal(got[0], distinct[0])
    assert [len(x) for x in textio.distinct_in_groups(values[:0], group[:0])] == [0, 0]


def test_block_keys_tell_words_apart_as_strings_do():
    rng = random.Random(5)
    pool = ["a", "a\x00", "\x00", "\x00\x00", "é", "abcdefg", "abcdefgh", "abcdefg\x00", "abcdefgh\x00", "abcdefgha", *(k * "x" for k in range(15, 18)), *(k * "y" for k in range(62, 67)), "z" * 5000]
    texts = [" " * (i % 3) + " ".join(rng.choice(pool) for _ in range(i % 40)) for i in range(200)] + pool
    for part in (pa.array(texts), pa.array(texts).slice(7)):
        by_word: dict = {}
        for word, k in zip(itertools.chain(*(t.split() for t in part.to_pylist())), textio.words(part).keys().tolist(), strict=True):
            by_word.setdefault(word, set()).add(k)
        assert all(len(k) == 1 for k in by_word.values()) and len({next(iter(k)) for k in by_word.values()}) == len(by_word)
    k = textio.words(pa.array(["Ab AB ab @[ `{ É é " + "W" * 100 + " " + "w" * 100])).keys(lower=True)
    assert len(set(k[:3].tolist())) == 1 and len(set(k[2:7].tolist())) == 5 and k[7] == k[8]
    x, y = thue_morse(64), thue_morse(64, "b", "a")
    assert len(set(textio.words(pa.array([x, y])).keys().tolist())) == 2
    assert len(textio.words(pa.array([], pa.string())).keys()) == 0


def test_usual_breaks_are_those_of_the_table():
    every = bytes(range(256))
    data = pa.array([every, every[::-1]], pa.binary())
    usual, given = textio.words(data), textio.words(data, textio._SPACES)
    assert np.array_equal(usual.start, given.start) and np.array_equal(usual.end, given.end) and np.array_equal(usual.breaks, given.breaks)
