"""Token ids of texts by a byte-level tokenizer file.

The tokenizer file's own library is exact but slow. Its vocabulary is also
given to a faster encoder of the same kind, with a piece rule that needs no
look-ahead: it parts texts alike unless two white-space characters meet. Texts
where they do, and those with a special token's string, go to the tokenizer.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from perennial.llm import worker

# Fixed value: the piece rule of byte-level tokenizers, without its case for runs of white space.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_RUNS = re.compile(r"\s\s")


def default_path() -> str:
    """The public byte-level tokenizer of 50,257 ids, where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    path = path or default_path()
    return worker.kept(f"encoder {path}", lambda: Encoder(path))


def _bytes_of_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself, or the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte = _bytes_of_letters()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in self.specials}
        self._fast = tiktoken.Encoding("pieces", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text, null as empty, without special tokens of its own."""
        if not text:
            return np.zeros(0, np.uint32)
        if _RUNS.search(text) or any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._fast.encode_ordinary(text), np.uint32)
