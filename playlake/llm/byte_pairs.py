"""Byte-level byte-pair encoding with a published vocabulary.

The ids are those of the `tokenizers` library for the same vocabulary (a test compares the two); the
ranks are run by `tiktoken`, which is several times faster.
"""

import base64
from collections.abc import Callable
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken

END_OF_TEXT = "<|endoftext|>"


@cache
def _encoding(ranks_file: str) -> tiktoken.Encoding:
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {END_OF_TEXT: len(ranks)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def byte_pairs(ranks_file: str | None = None) -> Callable[[], Callable[[list[bytes]], list[np.ndarray]]]:
    """Maker of the function from texts to ids. The file must be at the same path on every machine."""

    def make() -> Callable[[list[bytes]], list[np.ndarray]]:
        encoding = _encoding(ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        return lambda texts: [np.array(ids(encoding, t.decode()), dtype=np.uint32) for t in texts]

    return make


def ids(encoding: tiktoken.Encoding, text: str) -> list[int]:
    # As in the library, the name of the end token is that token wherever it stands.
    return encoding.encode(text, allowed_special="all") if END_OF_TEXT in text else encoding.encode_ordinary(text)
