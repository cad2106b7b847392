import base64
import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hitscope.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    ids, starts, first = byte_bpe.vocabulary(PATH).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)], starts, first


ODD = [
    "", " ", "  ", "\n", " \n", "a", "'", "''", "'s", " 's", "''s", "\n's", "'s's", "'re'll've'd'm't", "'rex", "'l", "'ll", "x'll y",
    "a  b", "a \n b", "a\n\nb", "a\n", "a \t", "12 34.5", "½ ² ٣", "é à ñ ß 中文 字", " a  b", "　", "  x", "\x1c\x1dx",
    "<|endoftext|>", "a\x00b", "\U0001f600\U0001f600 \U0001f600", "'S 'LL", "a" * 700, "ab" * 500, "-" * 333, "中" * 200, "x'", "x' s",
]


def test_odd_texts_equal_the_known_tokeniser(known):
    got, _, _ = encoded(ODD)
    assert got == [known.encode_ordinary(t) for t in ODD]


def test_every_code_point(known):
    texts = ["".join(f"a{chr(c)}{chr(c)}1 {chr(c)}" for c in range(a, a + 4096) if not 0xD800 <= c < 0xE000) for a in range(0, 0x30000, 4096)]
    got, _, _ = encoded(texts)
    wrong = [a for a, (g, t) in enumerate(zip(got, texts, strict=True)) if g != known.encode_ordinary(t)]
    assert not wrong


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab sltrevmd'\n\t 1é中.- "), max_size=40), max_size=6))
def test_any_text_equals_the_known_tokeniser(texts):
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)} if not _KNOWN else None
    if not _KNOWN:
        _KNOWN.append(tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    assert encoded(texts)[0] == [_KNOWN[0].encode_ordinary(t) for t in texts]


_KNOWN: list = []


def test_scan_equals_the_step_by_step_states():
    rng = random.Random(3)
    symbols = np.array([rng.randrange(9) for _ in range(20_000)], np.uint8)
    elements, _, _, _, _ = byte_bpe._monoid()
    state, want = byte_bpe.FRESH, []
    for s in symbols.tolist():
        want.append(state)
        state = byte_bpe._step(state, s)[0]
    assert byte_bpe._states_before(elements[symbols]).tolist() == want


def test_offsets_map_ids_to_their_bytes():
    texts = ["Où est-ce?  It's 12\n", "", "née"]
    ids, starts, first = byte_bpe.vocabulary(PATH).encode(pa.array(texts))
    words = byte_bpe.vocabulary(PATH)
    for d, text in enumerate(texts):
        raw = text.encode()
        for i in range(first[d], first[d + 1]):
            size = words.lengths[ids[i]]
            at = words.offsets[ids[i]]
            assert raw[starts[i] : starts[i] + size] == words.blob[at : at + size].tobytes()


def test_query_over_a_frame(spark, documents, known):
    rows = [(1, "It's  here\n"), (2, None), (3, ""), (4, "x" * 50_000 + " end"), (4, "x" * 50_000 + " end"), (None, "née '")]
    frame = documents([(a, b, 7) for a, b in rows], ", ids int")
    got = sorted(map(tuple, byte_bpe.tokenise(frame, PATH).collect()), key=str)
    want = []
    for doc, text in rows:
        ids = known.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table(spark, documents):
    assert byte_bpe.tokenise(documents([]), PATH).collect() == []


def test_a_very_long_text_and_word(known):
    texts = ["word " * 100_000, "ab" * 20_000, " " * 50_000 + "x"]
    assert encoded(texts)[0] == [known.encode_ordinary(t) for t in texts]
