"""Token counts by compiled finite-state tokenizers.

Two deterministic transducers read a text, and only counts come out:

* The splitter reads character symbols and says before which characters a piece begins.
  It has eight states, so the state map of any run of symbols is one element of a small
  transition monoid. Texts are cut into chunks of equal length, every chunk's map is
  composed, the maps are composed by a parallel prefix scan, and each chunk is then read
  from the state that the scan gives it. All chunks go forward together in numpy.
* The merger reads the bytes of a piece. Each transition is annotated with the number of
  tokens that the byte adds to the merged prefix (it may be negative). Its states are
  what the future can depend on: the longest suffix that begins some token, and the last
  token and relative count at each place within it. They are compiled when first reached.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from .bpe import PairTable, Vocabulary
from .rows import map_texts
from .unicode_classes import SPACE_POINTS, points

CHUNK = 64
MAX_STATES = 250_000
MEMO_PIECES = 500_000

# States of the splitter: what is open after the last character.
CLOSED, WORD, NUMBER, OTHER, BLANKS, LEAD, TAIL1, TAIL2 = range(8)
# Symbols. S_NEXT: a space before a non-space; S_MORE: a space before white space or the end; W_*: other white space.
# A_0: an apostrophe that begins no contraction; A_1, A_2: one whose contraction has one or two letters. END: between texts.
LETTER, DIGIT, SIGN, S_NEXT, S_MORE, W_NEXT, W_MORE, A_0, A_1, A_2, END = range(11)


def splitter_step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece begins at this character)."""
    if symbol == END:
        return CLOSED, True
    if symbol == LETTER:
        if state in (TAIL1, TAIL2):
            return (CLOSED if state == TAIL1 else TAIL1), False
        return WORD, state not in (WORD, LEAD)
    if symbol == DIGIT:
        return NUMBER, state not in (NUMBER, LEAD)
    if symbol in (SIGN, A_0) or symbol in (A_1, A_2) and state in (OTHER, LEAD):
        return OTHER, state not in (OTHER, LEAD)
    if symbol in (A_1, A_2):
        return (TAIL1 if symbol == A_1 else TAIL2), True
    if symbol == S_NEXT:
        return LEAD, True
    if symbol == W_NEXT:
        return CLOSED, True
    return BLANKS, state != BLANKS


class Splitter:
    """The splitter's tables: next state, output, and its transition monoid with a product table."""

    def __init__(self):
        steps = [[splitter_step(q, s) for s in range(END + 1)] for q in range(8)]
        self.next = np.array([[t[0] for t in row] for row in steps], np.uint8)
        self.begins = np.array([[t[1] for t in row] for row in steps], bool)
        letters = [tuple(self.next[:, s].tolist()) for s in range(END + 1)]
        maps = [tuple(range(8))]
        known = {maps[0]: 0}
        for m in maps:  # grows while it is read
            for a in letters:
                n = tuple(a[q] for q in m)
                if n not in known:
                    known[n] = len(maps)
                    maps.append(n)
        self.element = np.array([known[a] for a in letters], np.uint16)
        self.product = np.array([[known[tuple(b[q] for q in a)] for b in maps] for a in maps], np.uint16)  # a, then b
        self.image = np.array(maps, np.uint8)

    def piece_starts(self, symbols: np.ndarray) -> np.ndarray:
        """A flag for each symbol: whether a piece begins there."""
        n = len(symbols)
        width = -(-n // CHUNK)
        padded = np.full(width * CHUNK, END, np.uint8)
        padded[:n] = symbols
        columns = np.ascontiguousarray(padded.reshape(width, CHUNK).T)
        of_chunk = self.element[columns[0]]
        for column in columns[1:]:
            of_chunk = self.product[of_chunk, self.element[column]]
        upto = of_chunk.copy()  # inclusive scan of the chunks' maps
        step = 1
        while step < width:
            upto[step:] = self.product[upto[:-step], upto[step:]]
            step *= 2
        state = np.full(width, CLOSED, np.uint8)
        state[1:] = self.image[upto[:-1], CLOSED]
        begins = np.empty(columns.shape, bool)
        for j, column in enumerate(columns):
            begins[j] = self.begins[state, column]
            state = self.next[state, column]
        return begins.T.reshape(-1)[:n]


# Character classes, before the look at what follows.
C_LETTER, C_DIGIT, C_SPACE, C_WHITE, C_SIGN, C_QUOTE, C_END = range(7)


@cache
def class_table() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, C_SIGN, np.uint8)
    table[points("L")] = C_LETTER
    table[points("N")] = C_DIGIT
    table[SPACE_POINTS] = C_WHITE
    table[0x20] = C_SPACE
    table[ord("'")] = C_QUOTE
    return table


def symbols_of(chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of characters; ``ends`` are the places that stand between texts."""
    kind = class_table()[chars]
    kind[ends] = C_END
    after = np.append(kind[1:], C_END)
    symbols = np.array([LETTER, DIGIT, S_NEXT, W_NEXT, SIGN, A_0, END], np.uint8)[kind]
    more = (after == C_SPACE) | (after == C_WHITE) | (after == C_END)
    symbols[(kind == C_SPACE) & more] = S_MORE
    symbols[(kind == C_WHITE) & more] = W_MORE
    at = np.flatnonzero(kind == C_QUOTE)
    if len(at):
        tail = np.concatenate([chars, np.zeros(2, chars.dtype)])
        one, two = tail[at + 1], tail[at + 2]
        is_one = np.isin(one, [ord(c) for c in "stmd"])
        is_two = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            is_two |= (one == ord(a)) & (two == ord(b))
        symbols[at[is_one]] = A_1
        symbols[at[is_two]] = A_2
    return symbols


class Merger(dict):
    """The merger, and a bounded memo of the counts of pieces: piece -> tokens."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.pairs = PairTable(vocabulary)
        self.begins = {t[:k] for t in vocabulary.ids for k in range(1, len(t) + 1)}
        self._reset()

    def _reset(self) -> None:
        start = ("", ("",), (0,))
        self.states = [start]
        self.numbers = {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def __missing__(self, piece: str) -> int:
        count = self.count(piece.encode("utf-8"))
        if len(piece) <= 64:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = count
        return count

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: the sum of the annotations on its path."""
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                key = self.states[state]
                if len(self.states) >= MAX_STATES:
                    self._reset()
                    moves = self.moves
                    state = self._number(key)
                move = moves[state << 8 | byte] = self._compile(key, chr(byte))
            state = move[0]
            total += move[1]
        return total

    def _number(self, key: tuple) -> int:
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
        return self.numbers[key]

    def _compile(self, state: tuple, byte: str) -> tuple[int, int]:
        """(next state, tokens that ``byte`` adds).

        A state is (suffix, last, counts): the longest suffix of the prefix read that begins a token, and for each
        place from the suffix's start to its end the last token of the prefix up to there, with that prefix's count
        less the count at the end. "" stands for the piece's beginning, where no token is last.
        """
        suffix, last, counts = state
        suffix += byte
        for k in range(len(suffix)):
            token = suffix[k:]
            if token in self.vocabulary.ids and self.pairs["", token] and self.pairs[last[k], token]:
                added = counts[k] + 1
                break
        else:
            raise ValueError("the vocabulary lacks a byte of the text")
        last, counts = (*last, token), (*(c - added for c in counts), 0)
        while suffix not in self.begins:
            suffix, last, counts = suffix[1:], last[1:], counts[1:]
        return self._number((suffix, last, counts)), added


class Counter:
    """Counts of whole texts under one vocabulary."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.splitter = Splitter()
        self.merger = Merger(self.vocabulary)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text; strings of added tokens are one token each, and split what stands around them."""
        segments: list[str] = []
        owner: list[int] = []
        found = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.vocabulary.added_split is not None and any(t in text for t in self.vocabulary.added):
                parts = self.vocabulary.added_split.split(text)
                found[i] += len(parts) // 2
                parts = [p for p in parts[::2] if p]
            else:
                parts = [text]
            segments.extend(parts)
            owner.extend([i] * len(parts))
        if not segments:
            return found
        whole = "\0".join(segments) + "\0"
        chars = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        ends = np.cumsum([len(s) + 1 for s in segments]) - 1
        begins = np.flatnonzero(self.splitter.piece_starts(symbols_of(chars, ends)))
        bounds = begins.tolist()
        pieces = [whole[a:b] for a, b in zip(bounds, bounds[1:])]
        # A piece that begins at an end is the gap between two texts; the last end closes the last piece.
        gap = np.isin(begins[:-1], ends, assume_unique=True)
        for k in np.flatnonzero(gap).tolist():
            pieces[k] = ""
        tokens = np.fromiter(map(self.merger.__getitem__, pieces), np.int64, len(pieces))
        upto = np.concatenate([[0], np.cumsum(tokens)])  # counts of texts are differences of prefix sums
        at_end = upto[np.searchsorted(begins, ends)]
        np.add.at(found, owner, np.diff(at_end, prepend=0))
        return found


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every whole text.

    A null or empty text has no bytes and no tokens. Rows are independent: ties and repeated rows give equal counts,
    an empty table none; a text of any length is read to its end; other columns aren't read. Nothing is shuffled.
    """

    def run(ids, texts):
        tokens = counter(path).counts(texts)
        return [ids, [len((t or "").encode("utf-8")) for t in texts], tokens, (tokens > limit).tolist()]

    return map_texts(docs, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", rows=256)
