"""BPE encoding and decoding by forced-boundary splitting.

Merges only ever join neighbours into a token of the vocabulary. Two bytes that stand side by side inside
no token can thus never come to lie in one token: between them there is always a cut. A word is split at its
certain cuts, the fragments are encoded on their own, and their ids are concatenated.

The vocabulary is a ``tokenizers`` JSON file of the kind "words of a pattern, byte-level symbols, a suffix at
the end of a word". It is read on the driver and broadcast: its size does not depend on the data.

Cases: a null text counts as empty; an empty text has no ids and decodes to the empty text; a text of white
space only likewise; rows are encoded one by one, so repeated rows and ties need no rule; an empty table gives
an empty table; ids outside the vocabulary are an error on decoding, null ids decode like no ids; texts of any length
are encoded whole; columns other than doc_id and text are not looked at, whatever their names.

The tables of characters of Python, of ``regex`` and of ``tokenizers`` come from different versions of Unicode. The driver asks
once which characters they treat differently (``odd_characters``); texts that hold one are normalised and cut into words by
the library's own normaliser and pattern, all others by the faster ones here. Words are encoded alike.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from cotrend.llm.common import map_batches

#: Entries kept per Python worker; a store is emptied when full, which only costs time.
CHUNKS_KEPT = 350_000
#: Longer chunks and words are encoded without being kept.
KEPT_LENGTH = 40
#: Fragments up to this length are merged by plain search, longer ones with a heap.
SHORT = 24


#: One mark of each of several combining classes, as probes for the order in which marks are composed.
MARKS = "\u0334\u3099\u094d\u05b0\u0321\u0323\u0301\u0345"


@lru_cache(maxsize=1)
def odd_characters() -> str:
    """All characters whose class, lower case or combining class differs between the libraries, in order."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c) != "\n"]
    blocks = [every[i : i + 4096] for i in range(0, len(every), 4096)]
    odd: set[str] = set()
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        theirs = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True)
        ours = regex.compile(name).findall
        for block in blocks:
            text = "".join(block)
            odd |= set(ours(text)) ^ set("".join(piece for piece, _ in theirs.pre_tokenize_str(text)))

    def compare(probe: Callable[[str], str], theirs: Callable[[str], str], ours: Callable[[str], str], among: list) -> None:
        for block in among:
            text = "\n".join(map(probe, block))  # a line break stays apart in all that is compared
            pairs = zip(block, theirs(text).split("\n"), ours(text).split("\n"))
            odd.update(c for c, a, b in pairs if a != b)

    compose, composed = normalizers.NFC().normalize_str, partial(unicodedata.normalize, "NFC")
    compare(lambda c: c, normalizers.Lowercase().normalize_str, lambda text: text.replace("Σ", "σ").lower(), blocks)
    compare(lambda c: f"a{c}\u0301", compose, composed, blocks)
    marks = [[c for c in every if unicodedata.combining(c)]]
    for mark in MARKS:
        compare(lambda c, m=mark: f"a{c}{m}", compose, composed, marks)
        compare(lambda c, m=mark: f"a{m}{c}", compose, composed, marks)
    return "".join(sorted(odd))


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and certain cuts of one vocabulary file."""

    def __init__(self, spec: str, odd: str | None = None):
        data = json.loads(spec)
        odd = odd_characters() if odd is None else odd
        self.odd = frozenset(odd)
        model = data["model"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        symbols = byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.symbol = [self.ids[s] for s in symbols]
        self.last_symbol = [self.ids[s + self.suffix] for s in symbols]
        self.ranks: dict[tuple[int, int], int] = {}
        self.joined: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.ids[left], self.ids[right]] = rank
            self.joined.append(self.ids[left + right])
        self.joinable: set[bytes] = set()
        for token in self.ids:
            raw = bytes(byte_of[c] for c in token.removesuffix(self.suffix))
            self.joinable.update(raw[i : i + 2] for i in range(len(raw) - 1))
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find_words = regex.compile(pattern).findall
        self.split_odd = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.normalise_odd = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split if self.added else None
        self.token_list = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.string())
        self.kept: dict[str, bytes] = {}
        self.kept_words: dict[str, bytes] = {}

    def fragments(self, raw: bytes) -> list[bytes]:
        """``raw`` split at its certain cuts."""
        cuts = [i for i in range(1, len(raw)) if raw[i - 1 : i + 1] not in self.joinable]
        return [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)])]

    def encode_word(self, word: str) -> bytes:
        """Ids as 4-byte integers; ``word`` is one match of the pattern."""
        pieces = self.fragments(word.encode())
        out: list[int] = []
        for k, piece in enumerate(pieces):
            symbols = [self.symbol[b] for b in piece]
            if k == len(pieces) - 1:
                symbols[-1] = self.last_symbol[piece[-1]]
            out += self.merge(symbols)
        return array("i", out).tobytes()

    def merge(self, symbols: list[int]) -> list[int]:
        """Lowest rank first, leftmost first among equals, until no pair merges."""
        if len(symbols) > SHORT:
            return self.merge_long(symbols)
        rank_of, joined = self.ranks.get, self.joined
        ranks = [rank_of(pair, NONE) for pair in zip(symbols, symbols[1:])]
        while ranks:
            rank = min(ranks)
            if rank == NONE:
                break
            i = ranks.index(rank)
            symbols[i : i + 2] = [joined[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of((symbols[i - 1], symbols[i]), NONE)
            if i < len(ranks):
                ranks[i] = rank_of((symbols[i], symbols[i + 1]), NONE)
        return symbols

    def merge_long(self, symbols: list[int]) -> list[int]:
        """The same with linked neighbours and a heap: n log n steps for a word of n bytes."""
        n = len(symbols)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        alive = [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (rank := self.ranks.get((symbols[i], symbols[j]), NONE)) != NONE:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or (symbols[i], symbols[j]) != (left, right):
                continue
            symbols[i] = self.joined[rank]
            alive[j], after[i] = False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [s for s, here in zip(symbols, alive) if here]

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of normalised text, word by word."""
        out = []
        for word in self.find_words(chunk):
            ids = self.kept_words.get(word)
            if ids is None:
                ids = self.encode_word(word)
                if len(word) <= KEPT_LENGTH:
                    self.kept_words[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as 4-byte integers; strings of added tokens become their ids."""
        if self.split_added and any(t in text for t in self.added):
            out = []
            for k, part in enumerate(self.split_added(text)):
                out.append(np.int32(self.added[part]).tobytes() if k % 2 else self.encode_plain(part))
            return b"".join(out)
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        """Composed, lower-cased character by character (no rule for a final sigma), then encoded.

        No word of the pattern holds white space, so text between white space is looked up as a whole.
        """
        if not text.isascii():
            if not self.odd.isdisjoint(text):
                return b"".join([self.encode_word(word) for word, _ in self.split_odd(self.normalise_odd(text))])
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if NOT_SPACE.search(text):  # str.split() takes these for white space, the pattern does not
            return self.encode_chunk(text)
        chunks, kept = text.split(), self.kept
        if len(kept) > CHUNKS_KEPT:
            kept.clear()
        if len(self.kept_words) > CHUNKS_KEPT:
            self.kept_words.clear()
        for chunk in set(chunks).difference(kept):
            if len(chunk) <= KEPT_LENGTH:
                kept[chunk] = self.encode_chunk(chunk)
        return b"".join([kept[c] if c in kept else self.encode_chunk(c) for c in chunks])


NONE = 1 << 60
NOT_SPACE = regex.compile(r"[\x1C-\x1F]")

_open: dict[int, Vocabulary] = {}


def opened(spec: tuple[str, str]) -> Vocabulary:
    """The vocabulary of a file's content and the odd characters, set up once per Python worker."""
    key = hash(spec)
    if key not in _open:
        _open.clear()
        _open[key] = Vocabulary(*spec)
    return _open[key]


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id``, ``ids``: the token ids of every whole text, without special tokens put in."""
    with open(vocabulary_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast((file.read(), odd_characters()))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary = opened(spec.value)
        found = [vocabulary.encode(t or "") for t in batch.column("text").to_pylist()]
        offsets = np.zeros(len(found) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
        flat = pa.array(np.frombuffer(b"".join(found), np.int32))
        ids = pa.ListArray.from_arrays(pa.array(offsets), flat)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id``, ``ids``, ``text``: the tokens of each list of ids, joined as a file without decoder says."""
    with open(vocabulary_path, encoding="utf-8") as file:
        spec = encoded.sparkSession.sparkContext.broadcast((file.read(), odd_characters()))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("ids")
        lengths = pc.fill_null(pc.list_value_length(ids), 0)
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(lengths, out=offsets[1:])
        tokens = opened(spec.value).token_list.take(ids.flatten())
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), tokens), " ")
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, joined], ["doc_id", "ids", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, text string")
