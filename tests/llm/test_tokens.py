"""Token operators against the libraries whose ids they give."""

from __future__ import annotations

import hashlib
import random
import time
from itertools import accumulate
from zlib import crc32

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millwatch.llm import packing, sentencepiece_codec, token_files, wordpiece_counts
from millwatch.llm.byte_bpe import Encoder
from millwatch.llm.queries import BYTES, END_ID, PIECES

TEXTS = st.lists(
    st.sampled_from(list("abcdeth inosTHE  \n\t\r▁éñß漢字\U0001f600<0x>s/|#.,'0123456789\x00\x1c\xa0 "))
    | st.sampled_from(["th", "tion", " the", "  ", "    ", "'s", "ing", "</s>", "<|endoftext|>"]),
    max_size=50,
).map("".join)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def reference_bpe():
    return Tokenizer.from_file(BYTES)


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_sentencepiece_ids_and_text(text):
    codec = sentencepiece_codec.codec(PIECES)
    processor = _processor()
    ids = processor.encode(text)
    assert codec.encode(text) == ids
    assert codec.decode(ids) == processor.decode(ids)


_cached = []


def _processor():
    if not _cached:
        _cached.append(sentencepiece.SentencePieceProcessor(model_file=PIECES))
    return _cached[0]


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_byte_bpe_ids(text):
    if len(_cached) < 2:
        _processor()
        tokenizer = Tokenizer.from_file(BYTES)
        _cached.extend([tokenizer, Encoder(BYTES)])
    ids = _cached[1].encode(text, add_special_tokens=False).ids
    assert np.frombuffer(_cached[2].encode([text])[0], "<u4").tolist() == ids


def test_byte_bpe_of_even_texts_and_signs(reference_bpe):
    """Words in one call, signs apart, and characters at the edges of what counts as a letter."""
    rng = random.Random(8)
    bits = ["a", "Z", "é", "ß", "Ж", "9", "½", "²", "ª", "×", "漢", "\u0301", "\U0001f600", "'s", "'", ".", ",", "$", "&&"]
    bits += ["`", "hello", "ɏ", "ɐ", "_", "ⅷ", "\u180e", "\u200b", "\x00", "<|endoftext|>"]
    word = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(1, 5)))
    texts = [rng.choice([" ", "\n", "\t"]).join(word() for _ in range(rng.randint(1, 8))) for _ in range(8000)]
    texts += [" ".join(word() + "!" * 200 for _ in range(20)), "", "x" * 9000 + "?" * 9000]
    expected = [e.ids for e in reference_bpe.encode_batch(texts, add_special_tokens=False)]
    coder = Encoder(BYTES)
    got = [np.frombuffer(b, "<u4").tolist() for k in range(0, len(texts), 500) for b in coder.encode(texts[k : k + 500])]
    assert got == expected


def test_long_words_and_blanks(pieces):
    codec = sentencepiece_codec.codec(PIECES)
    rng = random.Random(2)
    for text in (" " * 100, "a" * 5000, "".join(rng.choice("abcdefgh") for _ in range(4000)), "漢" * 300):
        assert codec.encode(text) == pieces.encode(text)


def test_digests_of_hard_rows(hard_documents, no_documents, pieces):
    texts = hard_documents.select("doc_id", "text").collect()
    got = sentencepiece_codec.encoded_digests(hard_documents, PIECES).collect()
    expected = []
    for r in texts:
        ids = pieces.encode(r.text or "")
        both = ",".join(map(str, ids)), pieces.decode(ids)
        expected.append((r.doc_id, len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in both]))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    full = sentencepiece_codec.encode_texts(hard_documents, PIECES).collect()
    assert sorted(len(r.ids) for r in full) == sorted(e[1] for e in expected)
    assert sentencepiece_codec.encoded_digests(no_documents, PIECES).count() == 0


def greedy(word: str, known: set[str]) -> int:
    rest, n = "▁" + word, 0
    while rest:
        size = next(
            (k for k in range(min(len(rest), 40), 0, -1) if rest[:k] in known and (rest[0] == "▁") == (n == 0)), 0
        )
        if not size:
            return wordpiece_counts.UNKNOWN
        rest, n = rest[size:], n + 1
    return n


def test_word_piece_counts_equal_greedy_matching(pieces):
    known = {pieces.id_to_piece(k) for k in range(pieces.get_piece_size()) if not pieces.is_byte(k)}
    known -= {"<unk>", "<s>", "</s>"}
    trie = wordpiece_counts.automaton(PIECES)
    rng = random.Random(4)
    words = ["", "▁", "a▁b", "漢字", "internationalisation", "x漢"]
    words += ["".join(rng.choice("aeionrstlhdTé漢8.") for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    assert [trie.count(w) for w in words] == [greedy(w, known) for w in words]


def test_small_automaton():
    trie = wordpiece_counts.Automaton(["▁ab", "▁a", "bc", "b", "c", "cde"])
    assert [trie.count(w) for w in ("ab", "abc", "abcd", "abcde", "abb", "x")] == [1, 2, -1, 2, 2, -1]


def test_counts_of_hard_rows(hard_documents, no_documents):
    got = {r.doc_id: r for r in wordpiece_counts.word_piece_counts(hard_documents, PIECES).collect()}
    assert (got[2].n_words, got[3].n_words, got[4].n_words, got[1].n_words) == (0, 0, 0, 9)
    assert got[1].n_tokens >= 9 and got[6].n_unknown_words > 0
    assert wordpiece_counts.word_piece_counts(no_documents, PIECES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24]), max_size=40))
def test_places_round_trip(places):
    control, data = token_files.encode_places(np.array(places, np.uint32))
    assert len(control) == -(-len(places) // 4)
    assert token_files.decode_places(control, data, len(places)).tolist() == places


def test_places_are_coded_without_four_bytes_each():
    """The bytes that a mask over all four bytes of each place gives, in far less time."""
    places = np.minimum(np.random.default_rng(4).zipf(1.3, 500_000) - 1, 40_000).astype(np.uint32)
    lengths_of = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.int64)
    masks = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)

    def plain_encode():
        code = (places > 0xFF).astype(np.uint8) + (places > 0xFFFF) + (places > 0xFFFFFF)
        control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
        octets = places.astype("<u4").view(np.uint8).reshape(-1, 4)
        return control.tobytes(), octets[np.arange(4)[None, :] <= code[:, None]].tobytes()

    def plain_decode():
        lengths = lengths_of[np.frombuffer(control, np.uint8)].ravel()
        starts = np.cumsum(lengths) - lengths
        octets = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
        value = octets[starts]
        for k in range(1, int(lengths.max())):
            value |= octets[starts + k] << np.uint32(8 * k)
        return value & masks[lengths]

    def least_time(work):
        def once():
            began = time.process_time()
            work()
            return time.process_time() - began

        return min(once() for _ in range(5))

    control, data = token_files.encode_places(places)
    assert (control, data) == plain_encode()
    assert np.array_equal(token_files.decode_places(control, data, len(places)), plain_decode())
    plain = least_time(plain_encode) + least_time(plain_decode)
    quick = least_time(lambda: token_files.encode_places(places))
    quick += least_time(lambda: token_files.decode_places(control, data, len(places)))
    assert quick < 0.7 * plain


def test_file_round_trip():
    tokens = np.array([5, 5, 5, 70000, 2, 5, 2], np.uint32)
    docs = token_files.Documents([None, -4, 9], np.array([0, 3, 4]), tokens)
    back = token_files.from_bytes(token_files.to_bytes(docs))
    assert back.doc_ids == [None, -4, 9]
    assert back.lengths.tolist() == [0, 3, 4] and back.tokens.tolist() == tokens.tolist()
    with pytest.raises(ValueError, match="not a file"):
        token_files.from_bytes(b"x" * 100)


def encoded(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")


@pytest.mark.parametrize("file_tokens", [50, 2_000_000])
def test_token_files_equal_plain_encoding(hard_documents, tmp_path, reference_bpe, file_tokens):
    docs = hard_documents.repartition(4)
    files = token_files.write_token_files(docs, BYTES, END_ID, str(tmp_path / "files"), file_tokens)
    got = sorted(token_files.read_token_files(files, str(tmp_path / "files")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r.start for r in got] == [0, *accumulate(r.n_tokens for r in got)][:-1]
    texts = sorted((r.doc_id or 0, r.text or "") for r in hard_documents.collect())
    expected = [encoded(reference_bpe, t) for _, t in texts]
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(e), crc32(e.tobytes())) for e in expected]


def test_token_files_of_no_rows(no_documents):
    assert token_files.token_files(no_documents, BYTES, END_ID).count() == 0


def check_packing(counts, packing_, capacity):
    used: dict[int, int] = {}
    for pattern, n in packing_:
        assert n > 0 and sum(s * t for s, t in pattern) <= capacity
        for s, t in pattern:
            used[s] = used.get(s, 0) + n * t
    assert used == {s: n for s, n in counts.items() if n}


def fewest(counts, capacity):
    """By trying everything; small cases only."""
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    best = len(items)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= items[k]:
                rest = list(rooms)
                rest[rest.index(room)] -= items[k]
                place(k + 1, rest)
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best


@settings(max_examples=120, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(0, 2), max_size=6))
def test_bin_completion_finds_the_fewest(counts):
    found = packing.pack_lengths(counts, 20)
    check_packing(counts, found, 20)
    assert packing.lower_bound({s: n for s, n in counts.items() if n}, 20) <= packing.n_bins(found)
    assert packing.n_bins(found) == fewest(counts, 20)


def test_search_beats_best_fit_decreasing():
    counts = {6: 1, 5: 2, 4: 1, 3: 2, 2: 2}  # 30 in all, three bins of ten
    assert packing.n_bins(packing.pack_lengths(counts, 10)) == 3
    hard = {7: 3, 6: 3, 5: 4, 3: 6, 2: 6}
    check_packing(hard, packing.pack_lengths(hard, 12), 12)


def test_large_numbers_of_documents():
    rng = random.Random(6)
    counts = {s: rng.randint(1, 10**6) for s in range(1, 1025)}
    found = packing.pack_lengths(counts, 1024)
    check_packing(counts, found, 1024)
    assert packing.n_bins(found) <= packing.lower_bound(counts, 1024) * 1.01


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packed_documents(hard_documents, reference_bpe, capacity):
    got = packing.pack_documents(hard_documents, BYTES, END_ID, capacity).collect()
    sequences: dict[int, list] = {}
    lengths: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    for rows in sequences.values():
        rows.sort()
        assert [o for o, _ in rows] == [0, *accumulate(n for _, n in rows)][:-1]
        assert sum(n for _, n in rows) <= capacity
    expected: dict = {}
    for r in hard_documents.collect():
        ids = encoded(reference_bpe, r.text)
        expected[r.doc_id] = expected.get(r.doc_id, 0) + len(ids)
        own = [x for x in got if x.doc_id == r.doc_id]
        assert all(x.ids_crc32 == crc32(ids[x.start : x.start + x.length].tobytes()) for x in own)
        if r.doc_id not in (5, None):
            assert sorted(x.piece for x in own) == list(range(-(-len(ids) // capacity)))
            assert all(x.length == capacity for x in own if x.piece)
    assert lengths == expected


def test_packing_no_rows(no_documents):
    assert packing.pack_documents(no_documents, BYTES, END_ID).count() == 0


def test_special_tokens_as_the_library_cuts_them():
    """With and without white space, beside signs, and words too long to be remembered."""
    tokenizer, own = Tokenizer.from_file(BYTES), Encoder(BYTES)
    rng = random.Random(4)
    bits = ["<|endoftext|>", "a", "Zé", " ", "\n", "  ", "|>", "<|", "!", "1", "\xa0", "endoftext"]
    for _ in range(4000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 9)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == ids, text
    own.encode([f"{k:0100d} x" for k in range(2000)])
    assert max(map(len, own.known)) <= 64


def test_places_of_ids_beyond_the_table():
    """Ids are ranked alike whether they are counted in a table or sorted."""
    few = np.array([5, 7, 7, 5, 9, 7], np.uint32)
    many = few + np.uint32(1 << 30)
    for tokens in (few, many, few[:0]):
        docs = token_files.Documents([1], np.array([len(tokens)]), tokens)
        back = token_files.from_bytes(token_files.to_bytes(docs))
        assert back.tokens.tolist() == tokens.tolist()
    assert len(token_files.to_bytes(token_files.Documents([1], np.array([6]), few))) == len(
        token_files.to_bytes(token_files.Documents([1], np.array([6]), many))
    )
