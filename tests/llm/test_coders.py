"""Exact round trips of the coders, against plain Python."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from haulback.llm import elias_fano, simple8b
from haulback.llm.packing import CAPACITY, packed
from haulback.llm.token_ids import TextEncoder, tokenizer_path


@pytest.fixture(scope="module")
def encoder():
    return TextEncoder(tokenizer_path())


ODD_TEXTS = [
    "", " ", "\n", "a  b", " a  b ", "a\tb \n c", " x y", "foo.\nBar baz,\nqux", "été à la\n\nfoo", "日本語 です", "I'm it's don't x's",
    "a1b2 12 34.5 +1 (389) 555", "x's, 'll", "a \n b", "foo <|endoftext|> bar", "a\x1cb c\x1d d", "ªº ǆ ɏ", "..., !!", "a b c", "word&&& x***", "é a",
]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_ids_are_the_librarys(encoder, text):
    assert np.frombuffer(encoder(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab cé\n\t.,'s1&| ß"), max_size=40))
def test_ids_of_any_text_are_the_librarys(text):
    encoder = _shared()
    assert np.frombuffer(encoder(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


_made = []


def _shared():
    if not _made:
        _made.append(TextEncoder(tokenizer_path()))
    return _made[0]


def test_pieces_outlive_a_full_cache(encoder, monkeypatch):
    monkeypatch.setattr("haulback.llm.token_ids.KEPT_PIECES", 6)
    text = "one two three four five six seven one two three, four. five"
    for _ in range(3):
        assert np.frombuffer(encoder(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_null_has_no_ids(encoder):
    assert encoder(None) == b""
    assert isinstance(encoder.tokenizer, Tokenizer)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
@pytest.mark.parametrize("top", [1, 2, 5, 100, 50257, 1 << 31, 1 << 60, 1 << 63])
def test_simple8b_round_trip(n, top):
    values = np.random.default_rng(n).integers(0, top, n).astype(np.uint64)
    values[::50] += np.uint64(1 << 63) if top == 5 else np.uint64(0)
    words, offsets = simple8b.encode(values)
    assert (simple8b.decode(words, offsets, n) == values).all()
    assert len(offsets) == -(-n // simple8b.BLOCK)


def test_simple8b_blocks_are_read_on_their_own():
    values = np.arange(5000, dtype=np.uint64)
    words, offsets = simple8b.encode(values)
    third = simple8b.decode(words, offsets[2:3], simple8b.BLOCK)
    assert (third == values[2 * simple8b.BLOCK : 3 * simple8b.BLOCK]).all()


def test_simple8b_packs_small_values_densely():
    assert len(simple8b.encode(np.zeros(240, dtype=np.uint64))[0]) <= 2
    assert len(simple8b.encode(np.full(60, 1, dtype=np.uint64))[0]) == 1


def test_simple8b_file_round_trip():
    docs = [np.arange(k, dtype="<u4").tobytes() for k in (1, 0, 700, 3)]
    assert simple8b.read_file(simple8b.write_file(docs)) == docs
    with pytest.raises(ValueError):
        simple8b.read_file(b"x" * 60)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 4000])
@pytest.mark.parametrize("top", [1, 3, 100, 10**6, 1 << 40, 1 << 63])
def test_elias_fano_against_plain_search(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n).astype(np.uint64))
    code = elias_fano.encode(values)
    made = elias_fano.EliasFano(code)
    assert made.n == n and made.end == len(code)
    assert (made.access(np.arange(n)) == values).all()
    asked = np.concatenate([rng.integers(0, top, 300).astype(np.uint64), values[:50], values[:50] + np.uint64(1), np.array([0, 1 << 63], dtype=np.uint64)])
    assert (made.successor(asked) == np.searchsorted(values, asked)).all()


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 30, 100_000).astype(np.uint64))
    assert len(elias_fano.encode(values)) < 100_000 * (30 - 16 + 4) / 8 + 1000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, CAPACITY), max_size=60))
def test_packing_places_every_piece_once_within_capacity(lengths):
    groups = packed(lengths)
    assert sorted(k for g in groups for k in g) == list(range(len(lengths)))
    assert all(sum(lengths[k] for k in g) <= CAPACITY for g in groups)


def test_packing_leaves_little_padding():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 257, 4096).tolist()
    groups = packed(lengths)
    assert len(groups) * CAPACITY < 1.01 * sum(lengths)
    sums = [sum(lengths[k] for k in g) for g in groups]
    assert max(sums) - min(sums) < CAPACITY / 10
