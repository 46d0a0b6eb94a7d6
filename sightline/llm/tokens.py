"""Public tokenizers inside tasks: ids of texts and the bytes behind every id."""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_char() -> dict[str, int]:
    """The byte each printable stand-in of a byte-level vocabulary means: printable Latin-1 as is, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class ByteBpe:
    """A byte-level BPE read from the file of ``tokenizers``.

    The same merges as ranks run several times faster, so they encode all texts
    but those that hold the string of a special token, which the ranks don't know.
    With ``special`` such a string is its token, else it is plain text.
    """

    def __init__(self, path: str = BYTE_BPE, special: bool = True):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte_of = _byte_of_char()
        added = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in content["model"]["vocab"].items() if t not in added}
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = not special
        self.special = [*added] if special else []
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.bytes = [b""] * (max([*ranks.values(), *added.values()]) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        for token, i in added.items():
            self.bytes[i] = token.encode()

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceBpe:
    """A sentence-piece model; its pieces stand for UTF-8 with U+2581 as space, or for one byte."""

    def __init__(self, path: str = PIECE_BPE):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def lengths(vocabulary: list[bytes]) -> np.ndarray:
    """Bytes of every id."""
    return np.array([len(b) for b in vocabulary], dtype="int64")
