"""Byte-level BPE ids, equal to those of the tokenizers library.

Texts whose characters are all ``KNOWN``, on which both libraries are tested to agree, are encoded by tiktoken
from the same file's vocabulary, which is its merges by rank; this takes a ninth of the time. Others
are left to the tokenizers library. Long texts are encoded in parts that end where no token reaches across.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np

#: Characters of which both libraries agree whether they are letters, numbers, white space or others.
KNOWN = "\x00-ɏ‐-‧€"
_known = re.compile(f"[{KNOWN}]*").fullmatch
#: Characters of a part, about.
PART = 100_000
_cut = re.compile(r"(?<=\S)(?=[\t-\r ])")
# Fixed value: the pre-tokenizer's pattern, as byte-level tokenizer files have it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def parts(text: str, size: int = PART) -> Iterator[str]:
    """text in parts of about that size, cut only between a character that is no white space and one
    that is: tokens of white space and others end or begin there. Without such a place a part is longer."""
    start = 0
    while len(text) - start > size and (m := _cut.search(text, start + size)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: visible Latin-1
    characters stand for themselves, others for those from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        byte = _byte_letters()
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def part(self, text: str) -> np.ndarray:
        if _known(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """The ids of the whole text, uint32."""
        if len(text) <= PART:
            return self.part(text)
        return np.concatenate([self.part(p) for p in parts(text)])

    parts = staticmethod(parts)

    def lengths(self, texts: list[str]) -> list[int]:
        """The number of ids of each text: a batch for each library."""
        known = [bool(_known(t)) for t in texts]
        fast = iter(self.fast.encode_batch([t for t, k in zip(texts, known, strict=True) if k], num_threads=1, allowed_special="all"))
        slow = iter(self.library.encode_batch_fast([t for t, k in zip(texts, known, strict=True) if not k], add_special_tokens=False))
        return [len(next(fast)) if k else len(next(slow).ids) for k in known]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each file and process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
