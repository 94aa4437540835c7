import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cotrend.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def mine():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(vocabulary, text):
    return np.frombuffer(vocabulary.encode(text), np.int32).tolist()


CASES = [
    "", "   \n\t", "Hello, World!", "don't I'LL '", "a" * 500, "the" * 300, "ΑΣ ΟΔΟΣ Σ", "İstanbul", "é é",
    "x<|endoftext|>y <|startoftext|>", "日本語のテキスト123٣", "😀👍🏽" * 20, "\x00\x01 a\x1cb", "ﬁ Ǆ ß ẞ", "-" * 90 + "abc" * 40,
]


@pytest.mark.parametrize("text", CASES)
def test_same_ids_as_the_library(mine, library, text):
    assert ids(mine, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeéñß '\n.,!-019Σσ日😀\x1c"), max_size=60))
def test_same_ids_on_random_text(mine, library, text):
    assert ids(mine, text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("context, step", [("{}", 1), ("a{}b1", 16), ("é{}\u0301 x", 16)])
def test_every_code_point(mine, library, context, step):
    odd = set(map(ord, bpe.odd_characters()))
    texts = [context.format(chr(c)) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c % step == 0 or c in odd)]
    found = library.encode_batch(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, found) if ids(mine, t) != e.ids] == []


def test_odd_characters_among_others(mine, library):
    odd = bpe.odd_characters()
    for k in range(0, len(odd), 37):
        text = f"Straße {odd[k : k + 5]}ΣΑΣ a\u0323\u0301{odd[k]}\u0323 \x1c12\u2028{odd[k]}"
        assert ids(mine, text) == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_certain(mine):
    for token in list(mine.ids)[::97]:
        raw = bytes(bpe.byte_symbols().index(c) for c in token.removesuffix(mine.suffix))
        assert mine.fragments(raw) == [raw] or not raw
    assert len(mine.fragments("a😀".encode())) > 1


def test_stores_are_emptied_when_full(mine, library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNKS_KEPT", 3)
    text = "one two three four five six seven eight"
    for _ in range(3):
        assert ids(mine, text) == library.encode(text, add_special_tokens=False).ids


def test_frames(documents, library):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "The end.", None, None), (3, "The end.", None, None), (None, "x", "x", "x")]
    rows.append((9, "long word " * 20_000, "en", "a"))
    encoded = bpe.encode(documents(rows), PATH)
    found = {(r.doc_id, len(r.ids)): r for r in bpe.decode(encoded, PATH).collect()}
    assert encoded.count() == len(rows)
    assert found[1, 0].text == "" and found[2, 0].text == ""
    right = library.encode("The end.", add_special_tokens=False).ids
    assert found[3, len(right)].ids == right
    assert found[3, len(right)].text == library.decode(right, skip_special_tokens=False)
    long = library.encode("long word " * 20_000, add_special_tokens=False).ids
    assert found[9, len(long)].text == library.decode(long, skip_special_tokens=False)


def test_empty_table(documents):
    assert bpe.decode(bpe.encode(documents([]), PATH), PATH).count() == 0
