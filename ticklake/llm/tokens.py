"""Token ids of texts with a byte-level vocabulary read from a file; nothing is trained.

Ids fit 16 bits and are kept as little-endian bytes. Pieces of text between two words are encoded once
per worker and remembered: a piece that starts at a single space after a non-space always starts a new
pretoken, so encoding pieces apart gives the ids of the whole.
"""

from __future__ import annotations

import base64
import re

import numpy as np

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed: the pretoken pattern the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 200_000  # pieces; beyond that the memory starts anew
LONG_PIECE = 64  # characters; longer pieces are not remembered
DTYPE = np.dtype("<u2")

_UNSURE = re.compile(r"\s \s|^ | $")
_SURE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class Encoder(dict):
    """Bytes of the ids of a piece; pieces are looked up like keys."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.vocabulary: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.vocabulary[rank] = piece
        self._bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self._bpe.encode_ordinary(piece), DTYPE).tobytes()
        if len(piece) <= LONG_PIECE:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, without any reserved id."""
        if not text:
            return b""
        parts = _SURE_SPACE.split(text) if _UNSURE.search(text) else text.split(" ")
        get = self.__getitem__
        return get(parts[0]) + b"".join([get(" " + p) for p in parts[1:]])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist())).decode()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
