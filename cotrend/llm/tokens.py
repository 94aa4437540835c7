"""Token counts by count-only Viterbi over unigram pieces.

An Aho-Corasick automaton gives every piece that ends at a place of the text; dynamic programming carries two
numbers per place, the best score and the pieces of the best path. No path is kept, as only its size is asked for.

Rules, those of the unigram model of the ``tokenizers`` library: of two paths with equal score the one whose last
piece is longer wins; a character without a piece of its own may be passed as unknown for the lowest score
minus 10, and counts one token for each of its UTF-8 bytes where the vocabulary has byte pieces, else one token
for a whole run of unknown characters.

The white-space sign only begins pieces (or fills them), so a text is cut before each run of it, and around line
feeds when no piece holds them; between such cuts the best paths add up, and each part is counted once per
Python worker and looked up afterwards.

Scores are summed in double precision. Whole scores, as those of the vocabulary named in the queries, add up
without rounding, so the result does not depend on where a text is cut.

Cases: null or empty texts have 0 tokens; every other text gets one white-space sign in front; very long words
are counted without being kept; repeated rows are counted one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import map_batches

SIGN = "▁"
#: Entries kept per Python worker; the store is emptied when full, which only costs time.
PARTS_KEPT = 500_000
KEPT_LENGTH = 40
UNKNOWN_PENALTY = 10.0


class Pieces:
    """Counts tokens of texts under one list of ``(piece, score)``."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool):
        self.scores = dict(pieces)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        inner = any(SIGN in p.lstrip(SIGN) for p in self.scores)
        holds_feed = any("\n" in p for p in self.scores)
        # a run of unknown characters is one token without byte pieces: then no cut is certain around them
        self.cut_lines = not holds_feed and byte_pieces and not inner
        self.cut_words = not inner
        self.split_runs = re.compile(f"{SIGN}*[^{SIGN}]+|{SIGN}+").findall
        self.kept: dict[str, int] = {}

    def best(self, part: str) -> int:
        """Pieces of the best path through ``part``."""
        n = len(part)
        score: list[float] = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        unknown_end = [False] * (n + 1)

        def pass_unknown(end: int) -> None:
            """The path by an unknown last character: the shortest one, so it comes last and wins no tie."""
            if part[end - 1] not in self.scores and score[end - 1] + self.unknown > score[end]:
                score[end] = score[end - 1] + self.unknown
                if self.byte_pieces:
                    count[end] = count[end - 1] + len(part[end - 1].encode())
                else:
                    count[end] = count[end - 1] + (not unknown_end[end - 1])
                unknown_end[end] = True

        done = 0
        for last, (size, value) in self.automaton.iter(part):  # by end, longest first
            end = last + 1
            while done < end - 1:
                done += 1
                pass_unknown(done)
            total = score[end - size] + value
            if total > score[end]:
                score[end], count[end], unknown_end[end] = total, count[end - size] + 1, False
        while done < n:
            done += 1
            pass_unknown(done)
        return count[n]

    def of(self, part: str) -> int:
        found = self.kept.get(part)
        if found is None:
            found = self.best(part)
            if len(part) <= KEPT_LENGTH:
                self.kept[part] = found
        return found

    def count(self, text: str) -> int:
        if not text:
            return 0
        if len(self.kept) > PARTS_KEPT:
            self.kept.clear()
        text = SIGN + text.replace(" ", SIGN)
        if not self.cut_words:
            return self.best(text)
        total, lines = 0, [text]
        if self.cut_lines:
            lines = text.split("\n")
            total = len(lines) - 1
        kept = self.kept
        for line in lines:
            if line:
                for part in self.split_runs(line):
                    total += kept[part] if part in kept else self.of(part)
        return total


def read_pieces(model_path: str) -> tuple[list[tuple[str, float]], bool]:
    """Ordinary pieces with scores of a sentencepiece file, and whether it has byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    every = range(model.get_piece_size())
    plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain], any(map(model.is_byte, every))


_open: dict[int, Pieces] = {}


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` (long) of every whole text."""
    pieces, byte_pieces = read_pieces(model_path)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    key = hash((model_path, len(pieces)))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if key not in _open:
            _open.clear()
            _open[key] = Pieces(shared.value, byte_pieces)
        count = _open[key].count
        sizes = pa.array([count(t or "") for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes], ["doc_id", "n_tokens"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_tokens long")
