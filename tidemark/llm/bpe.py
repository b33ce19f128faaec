"""A SentencePiece BPE vocabulary and its merges, one pre-token at a time."""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

SPACE = "▁"
SPLIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
CROSSING = re.compile(f"[^{SPACE}]{SPACE}")


class Vocabulary:
    """Pieces, scores and byte pieces of a model file.

    No piece has a space mark after another character (checked here), so merges never cross the start of a new word,
    and a text may be cut there into pre-tokens that are encoded alone.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.is_byte = [model.is_byte(i) for i in range(size)]
        for i, piece in enumerate(self.pieces):
            if self.is_byte[i]:
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        if any(CROSSING.search(piece) for piece in self.ids):
            raise ValueError("this vocabulary has pieces that cross the start of a word")
        self.longest = max(map(len, self.ids))

    def symbol_ids(self, symbol: str) -> list[int]:
        found = self.ids.get(symbol)
        return [found] if found is not None else [self.byte_ids[b] for b in symbol.encode("utf-8", "replace")]

    def merge(self, pre_token: str) -> list[str]:
        """Merge neighbours, best score first, leftmost first among equals, until no pair forms a piece."""
        if len(pre_token) > 48:
            return self._merge_long(pre_token)
        parts, scores = list(pre_token), self.scores
        pairs = [scores.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, score in enumerate(pairs):
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = scores.get(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = scores.get(parts[at - 1] + parts[at])

    def _merge_long(self, pre_token: str) -> list[str]:
        n, scores = len(pre_token), self.scores
        parts: list[str | None] = list(pre_token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (score := scores.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, parts[i] + parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j], after[i] = joined, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [part for part in parts if part is not None]

    def encode(self, pre_token: str) -> list[int]:
        return [i for symbol in self.merge(pre_token) for i in self.symbol_ids(symbol)]


def pre_tokens(text: str) -> list[str]:
    """The text with its leading space mark, cut before each space mark that follows another character."""
    return SPLIT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def plain_words(text: str) -> list[str] | None:
    """The words if single spaces alone separate them: then each stands for a space mark and the word. Else None."""
    if SPACE in text or "  " in text or text[:1] == " " or text[-1:] == " ":
        return None
    return text.split(" ") if text else []


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary, loaded once in each worker process."""
    return Vocabulary(path)
