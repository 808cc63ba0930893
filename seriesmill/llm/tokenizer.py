"""Byte-level BPE from a rank file, loaded once per Python worker."""

from __future__ import annotations

import base64
import functools
import re

import tiktoken

#: Default rank file: byte-level BPE with 50,256 ids; the id after them ends a document.
RANK_FILE = "byte_bpe_50k.tiktoken"
# The pattern that splits text before the merges of these rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The same without the look-ahead, which matters only before or at the end of a run of spaces.
_SINGLE_SPACES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
_RUN = re.compile(r"\s\s|\s\Z")


def default_path() -> str:
    """Place of the installed public rank file."""
    import public_tokenizers

    return public_tokenizers.path(RANK_FILE)


class Tokenizer:
    """Encodes ordinary text; strings of special tokens are text like any other."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._any = tiktoken.Encoding("any", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._single = tiktoken.Encoding("single", pat_str=_SINGLE_SPACES, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1

    def encode(self, text: str) -> list[int]:
        """Token ids. The pattern without look-ahead is faster and used where both split alike."""
        chosen = self._any if _RUN.search(text) else self._single
        return chosen.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self._any.decode(ids)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)
