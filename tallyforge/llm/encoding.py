"""Byte-level BPE ids as little-endian 32-bit bytes, for use inside tasks.

`json_path` names a vocabulary file in the JSON form of the `tokenizers`
library. Where a rank file (`.tiktoken`) of the same vocabulary lies beside it,
the faster library that reads rank files encodes the text; ids are equal, which
tests/llm/test_tokens_and_chats.py checks. Added tokens named in the JSON file are cut
out of a text first, as `tokenizers` does with add_special_tokens=False.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np

from tallyforge.llm.common import claim, worker_cache

_LOADED: dict[str, "ByteBpe"] = worker_cache("encoding")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteBpe:
    def __init__(self, json_path: str):
        with open(json_path) as f:
            added = json.load(f)["added_tokens"]
        self.added = {a["content"]: int(a["id"]) for a in added}
        self.split = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        ranks_path = os.path.splitext(json_path)[0] + ".tiktoken"
        if os.path.exists(ranks_path):
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ordinary = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            inner = Tokenizer.from_file(json_path)
            self.ordinary = lambda text: inner.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if self.split is None or not self.split.search(text):
            return self.ordinary(text)
        out: list[int] = []
        for part in self.split.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out.extend(self.ordinary(part))
        return out

    def packed(self, text: str) -> bytes:
        return np.asarray(self.ids(text), dtype="<u4").tobytes()


def encoder(json_path: str) -> ByteBpe:
    """One encoder per worker process and path."""
    claim("encoding")
    if json_path not in _LOADED:
        _LOADED[json_path] = ByteBpe(json_path)
    return _LOADED[json_path]
