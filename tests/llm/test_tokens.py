import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from cotrend.llm import tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
FIRST_BYTES = [(f"<0x{i:02X}>", -1e9) for i in range(256)]


@pytest.fixture(scope="module")
def both():
    pieces, byte_pieces = tokens.read_pieces(PATH)
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces, *FIRST_BYTES], unk_id=0, byte_fallback=True))
    return tokens.Pieces(pieces, byte_pieces), library


def expected(library, text):
    return len(library.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "\n\n x", "a\n", "日本語テキスト", "😀😀 x", "▁▁ a▁b", "ñandú çé", "a" * 300])
def test_same_count_as_the_library(both, text):
    assert both[0].count(text) == expected(both[1], text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" abthe▁\n日😀é0"), max_size=60))
def test_same_count_on_random_text(both, text):
    assert both[0].count(text) == expected(both[1], text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab▁", min_size=1, max_size=3), st.integers(-4, 0)), min_size=1, max_size=12),
       st.text(alphabet="abc ", max_size=12))
def test_ties_and_unknown_characters(pieces, text):
    own = {p: float(s) for p, s in pieces}
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *own.items()], unk_id=0, byte_fallback=False))
    # the library takes the lowest score from its list, which holds the unknown piece too
    mine = tokens.Pieces(list(own.items()), False)
    mine.unknown = min(0.0, *own.values()) - 10
    whole = "▁" + text.replace(" ", "▁")
    assert mine.best(whole) == len(library.encode(whole, add_special_tokens=False).ids)


def test_frames(documents):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "The end.", None, None), (3, "The end.", None, None), (4, "x " * 50_000, "", "")]
    counted = sorted((r.doc_id, r.n_tokens) for r in tokens.count_tokens(documents(rows), PATH).collect())
    assert counted[:2] == [(1, 0), (2, 0)] and counted[2] == counted[3] and counted[4][1] == 50_001
    assert tokens.count_tokens(documents([]), PATH).count() == 0
