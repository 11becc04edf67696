"""Byte-level BPE ids of a public vocabulary, for use inside tasks."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Vocabulary:
    """Where the vocabulary lies: the ``tokenizers`` file and the same vocabulary as ranks.

    The ranks feed a faster encoder. It is used only for texts on which both agree: all
    code points below 256 and no special-token string.
    """

    path: str
    ranks_path: str | None = None

    @staticmethod
    def public() -> Vocabulary:
        import public_tokenizers

        return Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_file(vocabulary.path)
        self._specials = [t.content for t in self._exact.get_added_tokens_decoder().values()]
        self._fast = None
        if vocabulary.ranks_path:
            import base64

            import public_tokenizers
            import tiktoken

            with open(vocabulary.ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _agrees(self, text: str) -> bool:
        if self._fast is None or any(s in text for s in self._specials):
            return False
        if text.isascii():
            return True
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def encode(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit integers; a null text has none."""
        if not text:
            return np.empty(0, "<u4")
        if self._agrees(text):
            return np.array(self._fast.encode_ordinary(text), "<u4")
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, "<u4")


@functools.cache
def encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(vocabulary)
