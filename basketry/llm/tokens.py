"""Token ids of texts, for use inside Spark tasks.

The vocabulary file is a parameter: a path, or the name of a file of the
installed public tokenizers, looked up on the machine that runs the task.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
# a text with such a run goes to the slower encoder, whose time does not grow
# with the square of a run and which has no backtracking limit
_LONG_RUN = re.compile(r"\s{2000}|\S{2000}")


def vocabulary_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and
    the others as the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file.

    The vocabulary is read from the file and run by the faster of two installed
    encoders, which gives the same ids (tests compare them).
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self._path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in self.special}
        self._fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.n_ids = 1 + max([*ranks.values(), *self.special.values()])

    @functools.cached_property
    def slow(self):
        """The reference encoder, loaded only where it is needed."""
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        return Tokenizer.from_file(self._path)

    def ids(self, text: str, special: bool = True) -> np.ndarray:
        """Ids as uint32. ``special``: whether a special token's name in the
        text becomes that token (the vocabulary's default) or ordinary text."""
        if len(text) >= 2000 and _LONG_RUN.search(text):
            self.slow.encode_special_tokens = not special
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        if special:
            return self._fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32, copy=False)
        return self._fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.uint32, copy=False)


@functools.lru_cache(maxsize=2)
def encoder(name: str = VOCABULARY) -> Encoder:
    return Encoder(vocabulary_path(name))
