"""A fixed public vocabulary of text pieces, and an Aho-Corasick automaton over it that many words walk in step."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PATH = "/opt/tokenizers/piece_bpe_32k.model"
_CHAR = 21  # bits of a code point


@dataclass
class Vocabulary:
    """Piece texts (with spaces for the space mark), scores and ids; ids of the 256 byte pieces."""

    pieces: list[str]
    scores: np.ndarray
    ids: np.ndarray
    byte_ids: np.ndarray


def load(path: str = PATH) -> Vocabulary:
    """Read on the driver alone; executors get the pieces by broadcast."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    byte_ids = np.full(256, -1, np.int32)
    pieces, scores, ids = [], [], []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces.append(model.id_to_piece(i).replace("▁", " "))
            scores.append(model.get_score(i))
            ids.append(i)
    return Vocabulary(pieces, np.array(scores, np.float64), np.array(ids, np.int32), byte_ids)


class Automaton:
    """States are prefixes of pieces; ``output`` leads from a state to the longest piece that ends there (0: none)."""

    def __init__(self, pieces: list[str]):
        edges: dict[tuple[int, str], int] = {}
        depth, piece, parent, letter = [0], [-1], [0], [""]
        for number, text in enumerate(pieces):
            at = 0
            for c in text:
                to = edges.get((at, c))
                if to is None:
                    to = edges[at, c] = len(depth)
                    depth.append(depth[at] + 1)
                    piece.append(-1)
                    parent.append(at)
                    letter.append(c)
                at = to
            piece[at] = number
        fail, link = [0] * len(depth), [0] * len(depth)
        for state in sorted(range(1, len(depth)), key=depth.__getitem__):
            up = fail[parent[state]]
            while depth[state] > 1 and up and (up, letter[state]) not in edges:
                up = fail[up]
            fail[state] = edges.get((up, letter[state]), 0) if depth[state] > 1 else 0
            link[state] = fail[state] if piece[fail[state]] >= 0 else link[fail[state]]
        self.edges = edges
        self.fail, self.link, self.depth, self.piece = (np.array(x, np.int32) for x in (fail, link, depth, piece))
        keys = np.array([(s << _CHAR) | ord(c) for s, c in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], np.array(list(edges.values()), np.int32)[order]
        self.first = np.where(self.piece >= 0, np.arange(len(depth)), self.link).astype(np.int32)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The states after reading one character each."""
        out, left, now = np.zeros_like(state), np.arange(len(state)), state
        while len(left):
            key = (now.astype(np.int64) << _CHAR) | char[left]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[left[hit]] = self.targets[at[hit]]
            go = ~hit & (now > 0)
            left, now = left[go], self.fail[now[go]]
        return out

    def walk(self, chars: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
        """For words in rows, longest first: each position, how many words reach it, and the pieces that end there.

        Pieces come as (rows, states), following output links from the longest to the shortest.
        """
        state = np.zeros(len(sizes), np.int32)
        for j in range(chars.shape[1]):
            active = int(np.searchsorted(-sizes, -j, "left"))
            state = self.step(state[:active], chars[:active, j])
            yield j, active, self._outputs(state)

    def _outputs(self, state: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        node = self.first[state]
        rows = np.flatnonzero(node)
        node = node[rows]
        while len(rows):
            yield rows, node
            node = self.link[node]
            on = node > 0
            rows, node = rows[on], node[on]


def blocks(words: list[str], cells: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words as rows of code points, longest first: their numbers, code points and sizes, in blocks of bounded area."""
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        wide = max(int(sizes[order[at]]), 1)
        take = order[at : at + max(1, cells // wide)]
        own = sizes[take]
        chars = np.zeros((len(take), wide), np.int32)
        flat = np.frombuffer("".join([words[i] for i in take]).encode("utf-32-le", "surrogatepass"), np.int32)
        chars[np.arange(wide) < own[:, None]] = flat
        yield take, chars, own
        at += len(take)
