"""Random inputs for the pieces that replace a library's or a plain loop's work."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tielens.llm import common, jaccard_join, packing, ppm, tokens

words = st.text(st.sampled_from("ab cD\n\té 　\x1c.,'0\r\x0b"), max_size=40)
_encoder = tokens.Encoder(tokens.default_path())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(words, st.text(max_size=30).filter(lambda t: not any(0xD800 <= ord(c) <= 0xDFFF for c in t))), max_size=8))
def test_encoder(texts):
    ids, counts = _encoder.encode([t.encode() for t in texts])
    want = [_encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


@settings(max_examples=200, deadline=None)
@given(st.lists(words, min_size=1, max_size=8))
def test_words_and_shingles(texts):
    data = [t.encode() for t in texts]
    split = [t.lower().split() for t in data]
    h, counts = common.word_hashes(data)
    assert counts.tolist() == list(map(len, split))
    flat = [w for s in split for w in s]
    assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))
    for s, got in zip(split, jaccard_join.shingle_sets(data), strict=True):
        assert len(got) == (len({tuple(s[i : i + 5]) for i in range(len(s) - 4)}) if len(s) >= 5 else int(bool(s)))


@settings(max_examples=100, deadline=None)
@given(st.lists(words, min_size=1, max_size=6))
def test_symbols(texts):
    data = [t.encode() for t in texts]
    grams, sizes = ppm.symbols(data)
    normal = [b" ".join(t.lower().split()) + b"\n" for t in data]
    assert sizes.tolist() == list(map(len, normal))
    want = [int.from_bytes((b"\n" * 7 + t)[i : i + 8], "little") for t in normal for i in range(len(t))]
    assert grams.tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 127), st.integers(1, 20), max_size=30))
def test_plan_places_every_tail_once(demand):
    plan = packing.Plan(demand, 128)
    seen: dict[int, list[tuple[int, int]]] = {}
    for n, k in demand.items():
        sequence, offset = plan.place(np.full(k, n), np.arange(k))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            for at, length, where, first in [(0, n, s, o)] if s >= 0 else plan.cuts(o, n):
                assert 0 <= at < n
                seen.setdefault(where, []).append((first, length))
    for parts in seen.values():
        at = 0
        for first, length in sorted(parts):
            assert first == at
            at += length
        assert at <= 128
    assert sum(length for p in seen.values() for _, length in p) == sum(n * k for n, k in demand.items())


def test_more_pieces_than_the_table():
    small = tokens.Encoder(tokens.default_path(), 3)
    for text in ("a b", " ".join(f"w{i}" for i in range(50)), "a b c d e", "x"):
        ids, _ = small.encode([text.encode()])
        assert ids.tolist() == small.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_knows_the_classes_of_characters():
    texts = [f"a{c}b {c} 1{c}.{c}{c}\n{c}  x{c}" for c in map(chr, range(1, 0x500))]
    ids, counts = _encoder.encode([t.encode() for t in texts])
    want = [e.ids for e in _encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]


mixed = st.text(st.sampled_from("aBéß×÷Жяӿ҂ſ中’'23²½ª!.$_ \t\n\r\x00\x7f\x85 "), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(mixed, st.lists(st.sampled_from(["don't", "'s", " ", "  ", "\n", "<|endoftext|>", "l" * 30, "é" * 20, "x"]), max_size=12).map("".join)), max_size=6))
def test_encoder_on_mixed_classes(texts):
    for enc in (_encoder, tokens.Encoder(tokens.default_path(), 4) if len(texts) == 2 else _encoder):
        ids, counts = enc.encode([t.encode() for t in texts])
        want = [_encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [x for w in want for x in w]
