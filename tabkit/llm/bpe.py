"""Byte-level BPE encoding and decoding of whole texts.

``encode`` adds the token ids of a text column, ``decode`` turns ids back
into bytes.  Both are row-local: Spark splits the rows, nothing is shuffled,
and a lost task is simply run again; batches of rows are bounded in bytes
(``session.bound_batches``).  The rank file (about 1 MB) is read once
by the driver, checked against ``MAX_RANK_FILE`` and broadcast, so executors
need no file of their own.

Method.  Every byte is one Latin-1 character, so a ``pyahocorasick``
automaton over the vocabulary finds all tokens inside a piece in one pass.
From each position the longest match is tried first; a token may follow its
predecessor only if merging would leave the border between the two alone
(memoised per token pair).  A sequence all of whose borders hold is the one
right sequence of its bytes, so two tokens that may not follow each other give
way to the ids of their joint bytes (memoised too) if the border before holds
then.  If it does not, the search goes on from the first border that failed:
where nothing fits, the last token is taken back
and its next shorter match tried, and the abandoned position is never entered
again -- a valid sequence for a prefix is unique, so every position is
abandoned once at most; each match is searched in a slice no longer than the
longest token, so the work is linear in the piece.  The result is the sequence
that merging by rank gives.

Results for odd input: a null text is encoded as an empty one (no ids); null
ids decode to empty bytes; a repeated row gives a repeated result; an empty
table gives an empty table; other columns pass through, and an output name
that clashes with one of them is an error.
"""

from __future__ import annotations

import base64
import string
from collections.abc import Iterator
from functools import cached_property
from itertools import chain
from struct import Struct

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabkit.llm.common import Memo, check_free, holds, slices, task_memory
from tabkit.session import bound_batches

#: A rank file above this size is refused (it is broadcast).
MAX_RANK_FILE = 64 * 1024 * 1024
#: Longer pieces are not kept in a memo.
MEMO_PIECE = 64
#: Marks that the pattern parts from a letter before them.
MARKS = frozenset(string.punctuation)
#: Entries of a worker's memos (each held twice at most): of chunks between
#: blanks, of pieces inside them, of adjacent tokens, and of those that do not stay.
MEMO_CHUNKS, MEMO_PIECES, MEMO_FITS, MEMO_MENDED = 200_000, 50_000, 150_000, 50_000


class TextMemo(Memo):
    """A memo that does not keep long texts and those that run over lines."""

    def __missing__(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.make(text)
            if len(text) > MEMO_PIECE or text.find("\n", 1) > 0:
                return value
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[text] = value
        return value


class _Edge(Exception):
    """A piece between spaces that cannot be tokenised on its own."""


def read_tokens(rank_lines: bytes) -> dict[bytes, int]:
    """Tokens of a rank file, with their ids."""
    out = {}
    for line in rank_lines.splitlines():
        if line.strip():
            token, _, number = line.rpartition(b" ")
            out[base64.b64decode(token)] = int(number)
    return out


class TokenBytes:
    """Decoder: all tokens' bytes in one row."""

    def __init__(self, rank_lines: bytes):
        self._row = self._laid({number: token for token, number in read_tokens(rank_lines).items()})

    @staticmethod
    def _laid(tokens: dict[int, bytes]) -> pa.BinaryArray:
        """The bytes of each id; null for ids that the vocabulary lacks."""
        return pa.array([tokens.get(n) for n in range(max(tokens) + 1)], pa.binary())

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of rows of ids that lie one after another in ``ids``, row k
        up to ``ends[k]``; returned the same way."""
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(ends), np.int32)
        if ids.min() < 0 or ids.max() >= len(self._row):
            raise ValueError("an id that is not in the vocabulary")
        found = self._row.take(pa.array(ids))  # laid one after another
        if found.null_count:
            raise ValueError("an id that is not in the vocabulary")
        _, after, data = found.buffers()
        after = np.frombuffer(after, np.int32, len(ids) + 1)
        return np.frombuffer(data, np.uint8, after[-1]), after[ends]


class BytePairCodec(TokenBytes):
    """Encoder for one rank table and split pattern.  Ids are kept as the bytes
    of 32-bit numbers."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.rank = read_tokens(rank_lines)
        self.token = {number: token for token, number in self.rank.items()}
        self.length = {number: len(token) for token, number in self.rank.items()}
        self.longest = max(map(len, self.rank), default=1)
        self.pieces = regex.compile(pattern)
        self._pack = [Struct(f"<{n}i").pack for n in range(MEMO_PIECE)]
        self._halves = Memo(self._last_merge, entries=1 << 30)  # one entry per token
        self._shorter = Memo(self._next_shorter, entries=1 << 30)  # one entry per token
        self._fits = Memo(self._may_follow, MEMO_FITS)
        self._mended = Memo(self._mend, MEMO_MENDED)
        self._piece = TextMemo(self._encode_piece, MEMO_PIECES)
        self._chunk = TextMemo(self._encode_chunk, MEMO_CHUNKS)

    def forget(self) -> None:
        """Drop what was remembered of texts."""
        for memo in (self._fits, self._mended, self._piece, self._chunk):
            memo.forget()

    @cached_property
    def _row(self) -> pa.BinaryArray:
        return self._laid(self.token)

    @cached_property
    def _line_end(self) -> bytes:
        return self._pieces("\n")

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for token, number in self.rank.items():
            if self._halves[number]:
                found.add_word(token.decode("latin-1"), number)
        found.make_automaton()
        return found

    def _last_merge(self, number: int) -> tuple[int, ...]:
        """The two tokens that merging joins last to make this one; a byte is
        its own half; empty where merging never yields the token."""
        whole = self.token[number]
        parts = [whole[i:i + 1] for i in range(len(whole))]
        while len(parts) > 2:
            found = [(r, i) for i in range(len(parts) - 1)
                     if (r := self.rank.get(parts[i] + parts[i + 1])) is not None]
            if not found or found == [(number, 0)]:
                return ()
            _, i = min(found)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return tuple(self.rank[p] for p in parts)

    def _next_shorter(self, number: int) -> int:
        """The longest token that merging can yield and this one starts with;
        -1 if there is none."""
        token = self.token[number]
        for cut in range(len(token) - 1, 0, -1):
            other = self.rank.get(token[:cut])
            if other is not None and self._halves[other]:
                return other
        return -1

    def _may_follow(self, pair: int) -> bool:
        """Whether two adjacent tokens (``left << 32 | right``) stay as they
        are.

        Going back in time, the one formed last is undone at each step; what
        then meets at the border would have merged if its rank came before
        the ranks at which its two sides were used up (equal ranks: the one
        on the left first)."""
        left, right = pair >> 32, pair & 0xFFFFFFFF
        left_used = right_used = len(self.token) << 8
        while True:
            joint = self.rank.get(self.token[left] + self.token[right])
            if joint is not None and joint < left_used and joint <= right_used:
                return False
            left_byte, right_byte = len(self.token[left]) == 1, len(self.token[right]) == 1
            if left_byte and right_byte:
                return True
            if right_byte or not left_byte and left > right:
                left_used, left = left, self._halves[left][1]
            else:
                right_used, right = right, self._halves[right][0]

    def _encode_piece(self, piece: str) -> bytes:
        """Ids of one match of the split pattern."""
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.rank.get(raw)
        if whole is not None:
            return whole.to_bytes(4, "little")
        fits, longest = self._fits, self.automaton.iter_long
        text = piece if len(raw) == len(piece) else raw.decode("latin-1")
        # taking the longest match again and again is right for many pieces;
        # for others, the two tokens at a border that does not hold give way
        # to the ids of their joint bytes, which end where they did
        ids = [token for _, token in longest(text)]
        left, good = ids[0], 0
        out = [left]
        for right in ids[1:]:
            border = left << 32 | right
            if fits[border]:
                out.append(right)
                left = right
            else:
                good = good or len(out)
                out.pop()
                mended = self._mended[border]
                if out and not fits[out[-1] << 32 | mended[0]]:
                    return self._go_on(text, ids[:good])
                out += mended
                left = mended[-1]
        return self._packed(out)

    def _mend(self, pair: int) -> tuple[int, ...]:
        """Ids of the joint bytes of two tokens that do not stay as they are."""
        joint = self.token[pair >> 32] + self.token[pair & 0xFFFFFFFF]
        return tuple(np.frombuffer(self._go_on(joint.decode("latin-1"), []), "<i4").tolist())

    def _go_on(self, text: str, ids: list[int]) -> bytes:
        """Ids of a piece that begins with the longest matches ``ids``, whose
        borders hold."""
        n, length, fits, shorter = len(text), self.length, self._fits, self._shorter
        longest, reach = self.automaton.iter_long, self.longest
        at = sum(map(length.__getitem__, ids))
        untried: dict[int, int] = {}  # per position: the longest token not tried there yet
        dead: set[int] = set()
        while at < n:
            token = untried.get(at)
            if token is None:
                _, token = next(longest(text[at:at + reach]))
            left = ids[-1] << 32 if ids else -1
            while token >= 0:
                after = at + length[token]
                if after not in dead and (left < 0 or fits[left | token]):
                    break
                token = shorter[token]
            if token >= 0:
                untried[at] = shorter[token]
                ids.append(token)
                at = after
            elif ids:
                dead.add(at)
                last = ids.pop()
                at -= length[last]
                untried[at] = shorter[last]
            else:
                raise ValueError("the vocabulary does not cover every byte")
        return self._packed(ids)

    def _packed(self, ids: list[int]) -> bytes:
        return self._pack[len(ids)](*ids) if len(ids) < MEMO_PIECE else np.array(ids, "<i4").tobytes()

    def _pieces(self, text: str) -> bytes:
        """Ids of a text, by all matches of the pattern."""
        return b"".join(map(self._piece.__getitem__, self.pieces.findall(text)))

    def _line_start(self, part: str) -> bytes:
        """Ids of what follows a line's end."""
        return self._piece[part] if part.isalpha() else self._pieces(part)

    def _encode_chunk(self, chunk: str) -> bytes:
        """Ids of one space and what follows it up to the next space."""
        if chunk.isalpha():  # one match of the pattern
            return self._encode_piece(" " + chunk)
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Edge
        if chunk[-1] in MARKS and (word := chunk[:-1]).isalpha():  # two
            return self._chunk[word] + self._piece[chunk[-1]]
        if "\n" in chunk:
            first, *rest = chunk.split("\n")
            if not any(not part or part[0].isspace() or part[-1].isspace() for part in rest) and not first[-1].isspace():
                # a line's end between two non-space characters is one match
                return self._chunk[first] + b"".join([self._line_end + self._line_start(part) for part in rest])
        found = self.pieces.findall(" " + chunk)
        if found and found[0].startswith(" ") and found[0][1:].isalpha():  # a word is kept in one place
            return self._chunk[found[0][1:]] + b"".join(map(self._piece.__getitem__, found[1:]))
        return b"".join(map(self._piece.__getitem__, found))

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text."""
        return np.frombuffer(self.encoded(text), "<i4")

    def encoded(self, text: str | None) -> bytes:
        """Token ids of a whole text, as bytes.

        No match of the pattern runs from a non-space into a space, so a
        space between two non-space characters always begins a match: the
        text is cut there and each chunk looked up.  Texts with any other
        spacing go through the pattern as a whole."""
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            if first and first[-1].isspace():
                raise _Edge
            return self._pieces(first) + b"".join(map(self._chunk.__getitem__, rest))
        except _Edge:
            return self._pieces(text)


_HELD: dict[tuple, BytePairCodec | TokenBytes] = {}
holds("bpe", _HELD.clear)


def _held(make, ranks, *pattern: str):
    """One encoder or decoder per Python worker and vocabulary."""
    key = (make, len(ranks.value), hash(ranks.value), *pattern)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make(ranks.value, *pattern)
    return _HELD[key]


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(MAX_RANK_FILE + 1)
    if len(raw) > MAX_RANK_FILE:
        raise ValueError(f"{path}: more than {MAX_RANK_FILE} bytes")
    return raw


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of column ``text`` as ``array<int>``."""
    check_free(df, out)
    bound_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory("bpe"):
            codec = _held(BytePairCodec, ranks, pattern)
            for batch in chain.from_iterable(map(slices, batches)):
                rows = [codec.encoded(t) for t in batch.column(at).to_pylist()]
                ends = np.zeros(len(rows) + 1, np.int32)
                np.cumsum([len(r) // 4 for r in rows], out=ends[1:])
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, out])
            codec.forget()

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the token ids in column ``ids``.  An id that
    the vocabulary lacks is an error."""
    check_free(df, out)
    bound_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _held(TokenBytes, ranks)
        for batch in chain.from_iterable(map(slices, batches)):
            rows = batch.column(at)
            flat = rows.flatten()  # null rows hold no ids
            if flat.null_count:
                raise ValueError("a null among the ids of a row")
            ends = np.cumsum(np.nan_to_num(pc.list_value_length(rows).to_numpy(zero_copy_only=False)).astype(np.int64))
            data, ends = codec.decode(flat.to_numpy(), ends)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            raw = pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], names=[*batch.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.BinaryType())]))
