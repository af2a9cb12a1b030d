"""Token counts by dynamic programming that words share along a trie.

The distinct words of a batch of documents are visited in the order of a trie's depth-first
walk (sorted, each keeping the states of the prefix it shares with the one before), so the
forward state of every prefix is computed once.  A word's count is stored at its end.

For a unigram model the forward state is (best score, tokens).  For a BPE model the sum of
scores does not give the model's own segmentation; its forward state is (last piece, tokens):
the segmentation of a prefix ends in the one piece that stays as it is beside the last piece
of the remaining prefix.  Both agree with the SentencePiece library.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pieces import Pieces, bigram_codes, compatible, cut_words, pre_tokens

#: counts kept between batches of a task; the memory of a task stays bounded
MAX_KNOWN = 200_000


class PrefixCounter:
    """Counts of words, visited in sorted order."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.longest = pieces.longest
        self.fits = compatible(pieces.scores)
        # a piece the model never arrives at by merging cannot end a segmentation
        self.lowest = min(pieces.scores.values(), default=0.0) - 10.0

    def _next(self, word: str, depth: int, states: list) -> tuple:
        if self.p.kind == "bpe":
            for size in range(min(depth, self.longest), 0, -1):
                piece = word[depth - size:depth]
                if size > 1 and piece not in self.p.ids:
                    continue
                last, count = states[depth - size]
                if self.fits(last, piece):
                    return piece, count + (1 if piece in self.p.ids else len(piece.encode()))
            raise AssertionError("a single symbol always fits")
        best = None
        for size in range(1, min(depth, self.longest) + 1):
            piece = word[depth - size:depth]
            if piece in self.p.ids:
                score, count = states[depth - size][:2]
                found = (score + self.p.scores[piece], count + 1, size)
            elif size == 1:
                score, count = states[depth - 1][:2]
                found = (score + self.lowest, count + len(piece.encode()), 1)
            else:
                continue
            if best is None or found[0] > best[0]:
                best = found
        return best

    def ids(self, word: str) -> list[int]:
        """Token ids of one word, by the same forward states and the way back."""
        states = [("", 0) if self.p.kind == "bpe" else (0.0, 0)]
        for depth in range(1, len(word) + 1):
            states.append(self._next(word, depth, states))
        out, end = [], len(word)
        while end:
            size = len(states[end][0]) if self.p.kind == "bpe" else states[end][2]
            piece = word[end - size:end]
            own = self.p.ids.get(piece)
            out.append([self.p.bytes_at[b] for b in piece.encode()] if own is None else [own])
            end -= size
        return [i for part in reversed(out) for i in part]

    def counts(self, words) -> dict[str, int]:
        first = ("", 0) if self.p.kind == "bpe" else (0.0, 0)
        out, before, states = {}, "", [first]
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1:]
            for depth in range(shared + 1, len(word) + 1):
                states.append(self._next(word, depth, states))
            out[word] = states[-1][1]
            before = word
        return out


def count_tokens(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id and ``n_tokens`` (long), the number of tokens of the whole
    text.  Null and empty texts have 0 tokens; repeated rows stay; an empty table gives an
    empty result; other columns are not read.  Nothing is shuffled."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([source.schema["id"], T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, codes, known, found = PrefixCounter(pieces), bigram_codes(pieces), {}, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(1)
                found_in = [pre_tokens(t.as_py()) for t in texts]
                words = set().union(*found_in)
                if len(known) > MAX_KNOWN:
                    known.clear()
                if len(found) > MAX_KNOWN:
                    found.clear()
                new = [w for w in words if w not in known]
                flat, sizes = cut_words(new, codes)
                # new words are mostly made of units that were counted before
                found.update(counter.counts({u for u in flat if u not in found}))
                ends = np.concatenate(([0], np.cumsum(np.fromiter(map(found.__getitem__, flat), np.int64, len(flat)))))
                known.update(zip(new, np.diff(ends[np.concatenate(([0], np.cumsum(sizes)))]).tolist()))
                sums = [sum(map(known.__getitem__, t)) for t in found_in]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sums, pa.int64())], ["id", "n_tokens"])

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
