"""A SentencePiece model file read as plain data: pieces, scores, kinds and flags.

Only what encoding needs is read; a model with a character map or one that
folds white space is refused, as its normalisation is not covered here.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick

SPACE = "▁"
#: Piece kinds and model types of the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
PAIRS = 300_000         # judged pairs of pieces remembered per process (about 30 MB)


def _fields(raw: bytes):
    """(number, value) of a message's fields; nested messages stay bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            size = varint()
            yield tag >> 3, raw[at:at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield tag >> 3, struct.unpack("<d" if size == 8 else "<f", raw[at:at + size])[0]
            at += size


@dataclass
class PieceModel:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    unk_id: int = 0
    _pairs: dict[int, bool] = field(default_factory=dict, repr=False)

    @classmethod
    def read(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, raw: bytes) -> PieceModel:
        out = cls([], [], [])
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                out.pieces.append(piece[1].decode())
                out.scores.append(piece.get(2, 0.0))
                out.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                out.model_type = trainer.get(3, UNIGRAM)
                out.byte_fallback = bool(trainer.get(35, 0))
                if trainer.get(24, 0):
                    raise ValueError("white space as suffix is not supported")
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("models with a character map are not supported")
                if spec.get(4, 1):
                    raise ValueError("models that fold white space are not supported")
                out.dummy_prefix = bool(spec.get(3, 1))
        out.unk_id = out.kinds.index(UNKNOWN)
        return out

    @cached_property
    def ids(self) -> dict[str, int]:
        """Pieces that text can match (no control, unknown or byte pieces)."""
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (NORMAL, USER_DEFINED)}

    @cached_property
    def score_of(self) -> dict[str, float]:
        return {p: self.scores[i] for p, i in self.ids.items()}

    @cached_property
    def lengths(self) -> list[int]:
        """Characters of each piece."""
        return [len(p) for p in self.pieces]

    @cached_property
    def byte_ids(self) -> list[int]:
        at = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        return [at[f"<0x{b:02X}>"] for b in range(256)] if self.byte_fallback else []

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Aho-Corasick automaton over the pieces; values are (id, length)."""
        a = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            a.add_word(piece, (i, len(piece)))
        a.make_automaton()
        return a

    @cached_property
    def splits(self) -> bool:
        """No piece continues past white space, so text splits before each run of spaces."""
        return not any(SPACE in p.lstrip(SPACE) for p in self.ids) and "\n" not in "".join(self.ids)

    def unknown(self, char: str) -> list[int]:
        """Ids of a character that no piece covers."""
        return [self.byte_ids[b] for b in char.encode()] if self.byte_fallback else [self.unk_id]

    def merged(self, text: str) -> list[str]:
        """BPE by definition: again and again join the neighbours whose joint piece
        scores best, the leftmost first. For short strings."""
        parts, score, none = list(text), self.score_of.get, -math.inf
        joint = [score(a + b, none) for a, b in zip(parts[:-1], parts[1:], strict=True)]
        while joint:
            best = max(joint)
            if best == none:
                break
            at = joint.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del joint[at]
            if at:
                joint[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(joint):
                joint[at] = score(parts[at] + parts[at + 1], none)
        return parts

    @cached_property
    def _space_period(self) -> tuple[int, list[list[str]]] | None:
        """(longest piece of spaces, parts of all shorter runs), where longer runs are such
        pieces and the rest. Runs merge from the left as their pieces score alike, so what
        stands before a longest piece never changes again; checked on runs of four."""
        longest = max((len(p) for p in self.ids if not p.strip(SPACE)), default=1)
        parts = [self.merged(SPACE * n) for n in range(4 * longest)]
        fine = all(parts[n] == [SPACE * longest] * (n // longest) + parts[n % longest] for n in range(len(parts)))
        return (longest, parts[:longest]) if fine else None

    def space_run(self, n: int) -> list[str]:
        """The parts of ``n`` spaces."""
        if self._space_period is None:
            return self.merged(SPACE * n)
        longest, rest = self._space_period
        return [SPACE * longest] * (n // longest) + rest[n % longest]

    def space_count(self, n: int) -> int:
        """How many parts ``n`` spaces have."""
        if self._space_period is None:
            return len(self.merged(SPACE * n))
        longest, rest = self._space_period
        return n // longest + len(rest[n % longest])

    def forget(self) -> None:
        """Lets go of what encoding has derived; it is made again when needed."""
        self._pairs.clear()
        self.__dict__.pop("automaton", None)

    def compatible(self, a: int, b: int) -> bool:
        """Do pieces a and b stay as they are when they stand side by side?
        (``a`` = -1: is b alone kept whole?) Remembered per process."""
        key = a * len(self.pieces) + b
        known = self._pairs.get(key)
        if known is None:
            left, right = self.pieces[a] if a >= 0 else "", self.pieces[b]
            known = self.merged(left + right) == ([left, right] if left else [right])
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            self._pairs[key] = known
        return known

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("automaton", "ids", "score_of", "byte_ids", "lengths", "splits", "_space_period")} | {"_pairs": {}}
