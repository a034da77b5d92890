"""Token counts of whole texts without tokenising them: count-only Viterbi.

A unigram tokenizer takes the split of a text into vocabulary pieces with the
highest sum of scores.  For the count alone no split has to be kept: an
Aho-Corasick automaton lists all pieces that end at each character, and dynamic
programming carries, per character, the best score so far and the number of
tokens on the way.  The tokenizer's rules hold exactly: a character without a
piece of its own may be passed at the lowest piece score less 10 and gives one
token per UTF-8 byte (byte fallback); of equal scores the one whose last piece
starts first wins.  White space is written as a mark, with one mark before the
text.

No piece of the vocabulary has a mark after another character (checked when the
vocabulary is read), so every split has a border before each run of marks, and
characters that are in no piece are borders too.  The parts in between are
counted on their own and remembered; scores are sums over parts.  With
whole-number scores (as in the public vocabulary) these sums are exact.

Row-local: nothing is shuffled, a lost task is run again.  The vocabulary is
read by the driver (``MAX_PIECES`` at most) and broadcast.

Results for odd input: a null or empty text has no tokens and score 0; long
texts and long parts are counted whole, in linear time; a repeated row gives a
repeated result; an empty table gives an empty table; other columns pass
through, and an output name that clashes with one of them is an error.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabkit.llm.common import Memo, check_free, holds, slices, task_memory

# Fixed values of the tokenizer.
MARK = "▁"
UNKNOWN_PENALTY = 10.0

#: A larger vocabulary is refused (it is broadcast).
MAX_PIECES = 2_000_000
#: Longer parts are not remembered.
MEMO_PART = 64
#: Parts that a worker remembers (held twice at most).
MEMO_PARTS = 200_000


class PartMemo(Memo):
    """A memo that does not keep long parts."""

    def __missing__(self, part: str) -> tuple[int, int, float]:
        return super().__missing__(part) if len(part) <= MEMO_PART else self.make(part)


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, without its byte, control
    and unknown pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.vocab_size() > MAX_PIECES:
        raise ValueError(f"{path}: more than {MAX_PIECES} pieces")
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]


class UnigramCounter:
    """Counts for one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.single = frozenset(piece for piece, _ in pieces if len(piece) == 1)
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece, _ in pieces):
            self.parts = re.compile(".+", re.DOTALL)
        elif any("\n" in piece for piece, _ in pieces):
            self.parts = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        else:
            self.parts = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
        self._part = PartMemo(self.count_part, MEMO_PARTS)

    def forget(self) -> None:
        """Drop what was remembered of texts."""
        self._part.forget()

    def count_part(self, part: str) -> tuple[int, int, float]:
        """Tokens, those of them that are fallback bytes, and score."""
        return self._plain(part) if self.single.issuperset(part) else self._any(part)

    def _plain(self, part: str) -> tuple[int, int, float]:
        """The same where every character is a piece: none is passed, so that
        only the matches have to be walked through."""
        best, back = [], []  # score and begin of the last piece, before each character
        last, top, begin = -1, 0.0, 0
        for end, (length, score) in self.automaton.iter(part):
            start = end + 1 - length
            if end != last:
                best.append(top)
                back.append(begin)
                top, begin, last = best[start] + score, start, end
            else:
                score += best[start]
                if score > top or score == top and start < begin:
                    top, begin = score, start
        tokens, at = 0, len(part)
        back.append(begin)
        while at:
            at = back[at]
            tokens += 1
        return tokens, 0, top

    def _any(self, part: str) -> tuple[int, int, float]:
        n = len(part)
        best, tokens, spare = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        matches = self.automaton.iter(part)
        end, match = next(matches, (n, None))
        for at in range(n):  # settles the splits that end after character ``at``
            top, start, alone = None, 0, False
            while end == at:
                length, score = match
                alone |= length == 1
                score += best[at + 1 - length]
                if top is None or score > top or score == top and at + 1 - length < start:
                    top, start = score, at + 1 - length
                end, match = next(matches, (n, None))
            passed = best[at] + self.unknown
            if not alone and (top is None or passed > top):
                size = len(part[at].encode("utf-8", "surrogatepass"))
                best[at + 1], tokens[at + 1], spare[at + 1] = passed, tokens[at] + size, spare[at] + size
            else:
                best[at + 1], tokens[at + 1], spare[at + 1] = top, tokens[start] + 1, spare[start]
        return tokens[n], spare[n], best[n]

    def count(self, text: str | None) -> tuple[int, int, float]:
        if not text:
            return 0, 0, 0.0
        parts = self.parts.findall(MARK + text.replace(" ", MARK))
        tokens, spare, scores = zip(*map(self._part.__getitem__, parts))
        return sum(tokens), sum(spare), sum(scores)


_COUNTERS: dict[str, UnigramCounter] = {}
holds("token_counts", _COUNTERS.clear)


def _counter(key: str, pieces) -> UnigramCounter:
    """One counter per Python worker and call."""
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = UnigramCounter(pieces.value)
    return _COUNTERS[key]


def count_tokens(df: DataFrame, model_path: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``n_tokens``, ``n_fallback_bytes`` and ``score``."""
    check_free(df, "n_tokens", "n_fallback_bytes", "score")
    pieces = df.sparkSession.sparkContext.broadcast(read_pieces(model_path))
    key = uuid.uuid4().hex
    kept = [i for i, c in enumerate(df.columns) if keep_text or c != text]
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("token_counts"):
            counter = _counter(key, pieces)
            for batch in chain.from_iterable(map(slices, batches)):
                tokens, spare, scores = zip(*map(counter.count, batch.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept), pa.array(tokens, pa.int64()), pa.array(spare, pa.int64()),
                     pa.array(scores, pa.float64())],
                    names=[*(batch.schema.names[i] for i in kept), "n_tokens", "n_fallback_bytes", "score"])
            counter.forget()

    schema = T.StructType([*(df.schema[i] for i in kept), T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_fallback_bytes", T.LongType()), T.StructField("score", T.DoubleType())])
    return df.mapInArrow(run, schema)
