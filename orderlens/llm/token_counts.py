"""Exact token counts of a byte-fallback BPE model by rank-synchronous array merging.

The model's vocabulary is read from its file; the merging is done here, on arrays. A text becomes
symbols (code points, spaces as U+2581, one such prefixed). Two neighbouring symbols can ever
merge only if some vocabulary entry contains their two characters side by side, so the text is cut
everywhere else without changing the result. The distinct pieces of a batch that were not seen
before are held as one ragged array. In each round every piece merges its lowest-ranked pair (the
leftmost of equals), all pieces at once, until none has a pair left; what remains is counted. A
character that is no entry counts as many tokens as its UTF-8 has bytes.

A piece of more than ``LONG_PIECE`` symbols (one character repeated ten thousand times, say) would
need as many rounds; such pieces merge in the same order from a heap, in n log n steps.

A task only ever holds one batch of rows, a table of pieces already counted (emptied at
``REMEMBERED`` entries) and the vocabulary. No shuffle. Defined results: a null or empty text has 0
bytes and 0 tokens; repeated rows and null ids are counted like any row; other columns play no part.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from orderlens.llm.common import TextFunction, map_texts

REMEMBERED = 400_000
LONG_PIECE = 512
SPACE = "▁"
_NONE = np.iinfo(np.int64).max
_PIECES = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Merges:
    """The vocabulary of a sentencepiece BPE model as sorted arrays of pairs."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        entries = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                entries[model.id_to_piece(i)] = -model.get_score(i)
        symbols = {c: n for n, c in enumerate(sorted({c for p in entries for c in p}))}
        self.chars = np.array([ord(c) for c in symbols], dtype=np.int64)
        # Characters that occur in entries without being one are symbols, but count as bytes.
        self.bytes_of = np.array([0 if c in entries else len(c.encode()) for c in symbols])
        for p in entries:
            symbols.setdefault(p, len(symbols))
        ranks = {v: r for r, v in enumerate(sorted(set(entries.values())))}
        pairs, neighbours = {}, set()
        for p, score in entries.items():
            for k in range(1, len(p)):
                neighbours.add(symbols[p[k - 1]] << 32 | symbols[p[k]])
                if p[:k] in symbols and p[k:] in symbols:
                    pairs[symbols[p[:k]] << 32 | symbols[p[k:]]] = (ranks[score], symbols[p])
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        self.neighbours = np.array(sorted(neighbours), dtype=np.int64)

    def _find(self, sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
        return at, sorted_keys[at] == wanted

    def count(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece (all spaces already U+2581)."""
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        at, known = self._find(self.chars, points)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        alone = np.where(known, self.bytes_of[at], width)
        symbol = np.where(known, at, -1)
        joined = self._find(self.neighbours, symbol[:-1] << 32 | symbol[1:])[1]
        joined &= (owner[:-1] == owner[1:]) & known[:-1] & known[1:]
        part = np.concatenate(([0], np.cumsum(~joined)))
        return np.bincount(
            owner[np.flatnonzero(np.concatenate(([True], ~joined)))],
            weights=self._merge(symbol, part, alone),
            minlength=len(pieces),
        ).astype(np.int64)

    def _merge(self, symbol: np.ndarray, part: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """Surviving symbols of each part; a symbol that is no entry counts its bytes."""
        result = np.zeros(part[-1] + 1, dtype=np.int64)
        # A symbol with bytes of its own may vanish in a merge, so its extra is added at the end.
        extra = np.maximum(alone - 1, 0)
        sizes = np.bincount(part)
        for p in np.flatnonzero(sizes > LONG_PIECE):
            mine = part == p
            result[p] = self._merge_long(symbol[mine].tolist(), extra[mine].tolist())
        keep = (sizes <= LONG_PIECE)[part]
        symbol, part, extra = symbol[keep], part[keep], extra[keep]
        while len(symbol):
            at, found = self._find(self.keys, symbol[:-1] << 32 | symbol[1:])
            found &= (part[:-1] == part[1:]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0)
            # Lowest rank, then leftmost, in one number; the last symbol of a part has no pair.
            order = np.full(len(symbol), _NONE)
            place = np.flatnonzero(found)
            order[place] = self.ranks[at[place]] << 32 | place
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            best = np.minimum.reduceat(order, starts)
            active = best != _NONE
            lengths = np.diff(np.append(starts, len(symbol)))
            settled = np.repeat(~active, lengths)
            if settled.any():
                np.add.at(result, part[settled], 1 + extra[settled])
            left = best[active] & 0xFFFFFFFF
            symbol = symbol.copy()
            symbol[left] = self.merged[at[left]]
            extra[left] = 0
            keep = ~settled
            keep[left + 1] = False
            symbol, part, extra = symbol[keep], part[keep], extra[keep]
        return result

    def _pair(self, left: int, right: int) -> tuple[int, int] | None:
        if left < 0 or right < 0:
            return None
        at, found = self._find(self.keys, np.array([left << 32 | right]))
        return (int(self.ranks[at[0]]), int(self.merged[at[0]])) if found[0] else None

    def _merge_long(self, symbol: list[int], extra: list[int]) -> int:
        after = [*range(1, len(symbol)), -1]
        before = [*range(-1, len(symbol) - 1)]
        waiting: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (pair := self._pair(symbol[i], symbol[after[i]])):
                heapq.heappush(waiting, (pair[0], i, symbol[i], symbol[after[i]], pair[1]))

        for i in range(len(symbol)):
            offer(i)
        alive = [True] * len(symbol)
        while waiting:
            _, i, left, right, merged = heapq.heappop(waiting)
            j = after[i]
            if not alive[i] or symbol[i] != left or j < 0 or symbol[j] != right:
                continue
            symbol[i], extra[i], alive[j] = merged, 0, False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return sum(1 + e for e, a in zip(extra, alive, strict=True) if a)


class Counter:
    """Token counts of texts, remembering the pieces it has met."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.seen: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.seen) > REMEMBERED:
            self.seen = {}
        split = [self._pieces(t) for t in texts]
        new = list(set().union(*split).difference(self.seen))
        for i in range(0, len(new), 50_000):
            some = new[i : i + 50_000]
            self.seen.update(zip(some, self.merges.count(some).tolist(), strict=True))
        known = self.seen.__getitem__
        return [sum(map(known, pieces)) for pieces in split]

    @staticmethod
    def _pieces(text: str) -> list[str]:
        return _PIECES.findall(SPACE + text.replace(" ", SPACE)) if text else []


def count_tokens(
    docs: DataFrame,
    model_file: Callable[[], str],
    limit: int,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per document: key, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``model_file`` gives, where it is called, a path of the model that can be opened there.
    """

    def make() -> TextFunction:
        counter = Counter(Merges(model_file()))

        def count(texts: list[str]) -> tuple[None, dict[str, list]]:
            n = counter(texts)
            return None, {
                "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": n,
                "over_limit": [x > limit for x in n],
            }

        return count

    return map_texts(docs, make, "n_bytes long, n_tokens long, over_limit boolean", text, [key])
