"""A SentencePiece model's piece table, read once on the driver from a path."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = "▁"
#: the piece table goes to every task; a model beyond this size is refused
MAX_PIECES = 1_000_000


@dataclass(frozen=True)
class Pieces:
    """Ids and scores of the ordinary pieces, the id of each byte piece, and the model kind."""
    kind: str                           # "bpe" or "unigram"
    ids: dict[str, int]
    scores: dict[str, float]
    bytes_at: dict[int, int]            # byte value -> id
    surface: list[bytes]                # id -> bytes

    def __post_init__(self):
        if len(self.surface) > MAX_PIECES:
            raise ValueError("too many pieces to hand to every task")

    @property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    @property
    def bigrams(self) -> frozenset[str]:
        """Neighbouring characters that some piece holds; no piece spans any other place."""
        return frozenset(a + b for p in self.ids for a, b in zip(p, p[1:]))


def read_model(path: str) -> Pieces:
    """Read a model file.  Supported: identity normalisation, white space kept, byte fallback."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return from_proto(model)


def from_proto(model) -> Pieces:
    kinds = {1: "unigram", 2: "bpe"}
    if model.trainer_spec.model_type not in kinds:
        raise ValueError("only unigram and BPE models are supported")
    if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models that leave the text as it is are supported")
    if not model.normalizer_spec.add_dummy_prefix:
        raise ValueError("only models that put a space before the text are supported")
    normal, unknown, byte = 1, 2, 6
    ids, scores, bytes_at, surface = {}, {}, {}, []
    for i, p in enumerate(model.pieces):
        if p.type == byte:
            value = int(p.piece[3:5], 16)
            bytes_at[value] = i
            surface.append(bytes([value]))
        elif p.type == normal:
            ids[p.piece], scores[p.piece] = i, p.score
            surface.append(p.piece.replace(SPACE, " ").encode())
        else:
            surface.append(" ⁇ ".encode() if p.type == unknown else b"")
    if len(bytes_at) != 256:
        raise ValueError("the model has no byte pieces for unknown characters")
    return Pieces(kinds[model.trainer_spec.model_type], ids, scores, bytes_at, surface)


_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def plain(text: str) -> bool:
    """Are the words of a text that is not empty what stands between its spaces?"""
    return "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " "


def pre_tokens(text: str) -> list[str]:
    """The text's words, each without the one space that stands before it (the first word's is
    the dummy prefix); further spaces before a word belong to it.  No piece spans two words."""
    if not text:
        return []
    if plain(text):
        return text.split(" ")
    return [w[1:] for w in _WORD.findall(SPACE + text.replace(" ", SPACE))]


def spaces_inside(pieces: Pieces) -> bool:
    return any(SPACE in p.lstrip(SPACE) for p in pieces.ids)


def bigram_codes(pieces: Pieces) -> np.ndarray:
    """The neighbouring characters that some piece holds, packed and sorted."""
    return np.array(sorted(ord(b[0]) << 32 | ord(b[1]) for b in pieces.bigrams) or [0], np.uint64)


#: entries of the table of character pairs; models with more are searched
MAX_PAIRS = 1 << 24


@lru_cache(maxsize=4)
def _pair_table(codes: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Row of each first character, column of each second one, and the table of neighbours."""
    packed = np.frombuffer(codes, np.uint64)
    first, rows = np.unique(packed >> np.uint64(32), return_inverse=True)
    second, columns = np.unique(packed & np.uint64(0xFFFFFFFF), return_inverse=True)
    width = len(second) + 1
    if (len(first) + 1) * width > MAX_PAIRS:
        return None
    row_of, column_of = np.zeros(0x110000, np.int32), np.zeros(0x110000, np.int32)
    row_of[first.astype(np.int64)] = np.arange(1, len(first) + 1) * width
    column_of[second.astype(np.int64)] = np.arange(1, width)
    table = np.zeros((len(first) + 1) * width, bool)
    table[(rows + 1) * width + columns + 1] = True
    return row_of, column_of, table


def _joined(chars: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """For every character but the last: does some piece hold it and the one after it?"""
    found = _pair_table(codes.tobytes())
    if found is None:
        wide = chars.astype(np.uint64)
        pairs = wide[:-1] << np.uint64(32) | wide[1:]
        return codes[np.minimum(np.searchsorted(codes, pairs), len(codes) - 1)] == pairs
    row_of, column_of, table = found
    return table[row_of[chars[:-1]] + column_of[chars[1:]]]


def cut_words(words: list[str], codes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Units of all words (each with its space), one after the other, and how many each word has:
    words are cut where no piece can span."""
    if not words:
        return [], np.empty(0, np.int64)
    text = SPACE + SPACE.join(words)
    cut = ~_joined(np.frombuffer(text.encode("utf-32-le"), np.uint32), codes)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    cut[ends[:-1] - 1] = True
    bounds = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(text)]))
    at = bounds.tolist()
    flat = [text[a:b] for a, b in zip(at, at[1:])]
    return flat, np.diff(np.concatenate(([0], np.searchsorted(bounds, ends))))


def cut_array(words: pa.StringArray, codes: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """:func:`cut_words` for an Arrow array of words."""
    if not len(words):
        return pa.array([], pa.string()), np.empty(0, np.int64)
    one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    text = SPACE + pc.binary_join(one, SPACE)[0].as_py()
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    cut = ~_joined(chars, codes)
    ends = np.cumsum(pc.utf8_length(words).to_numpy().astype(np.int64) + 1)
    cut[ends[:-1] - 1] = True
    bounds = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(text)]))
    size = (chars >= 0x80).astype(np.int8) + (chars >= 0x800) + (chars >= 0x10000) + 1
    at = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))[bounds].astype(np.int32)
    flat = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(text.encode()))
    return flat, np.diff(np.concatenate(([0], np.searchsorted(bounds, ends))))


def merge(text: str, scores: dict[str, float], least: int = 1) -> list[str]:
    """BPE: join the neighbouring symbols that make the best-scored piece, leftmost first,
    until no two make a piece (or ``least`` symbols are left)."""
    parts = list(text)
    while len(parts) > least:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def unordered(scores: dict[str, float]) -> set[str]:
    """BPE: the pieces that are not merged from symbols of better scores.  Where none of them
    stands, no merge makes a better one possible: a symbol's merges lie within it and go as they
    would in its piece alone, so all merges come in the order of score and place."""
    out = set()
    for piece, score in scores.items():
        cuts = [(a, b) for a, b in ((piece[:i], piece[i:]) for i in range(1, len(piece)))
                if all(len(x) == 1 or x in scores for x in (a, b))]
        if any(len(x) > 1 and scores[x] <= score for cut in cuts for x in cut):
            last = merge(piece, scores, 2)               # longer if the piece is never made
            if len(last) == 2 and any(len(x) > 1 and scores[x] <= score for x in last):
                out.add(piece)
    return out


def compatible(scores: dict[str, float]):
    """Function (a, b): do two pieces stay as they are when they stand side by side?"""
    @lru_cache(maxsize=1 << 18)
    def check(a: str, b: str) -> bool:
        return merge(a + b, scores) == ([a, b] if a else [b])
    return check
