"""Token ids of whole texts by a tokenizers file, inside a Python worker.

Corpora repeat their words. For the two usual byte-level pre-tokenizers a text
of Latin-1 characters is cut into pre-tokens by an equivalent regular
expression, and each distinct pre-token goes through the tokenizer's model
once per worker. Texts with any other character or with the string of an added
token (such as <|endoftext|>), and every text under any other tokenizer file, go
through the tokenizer whole. Both ways give the ids of
``Tokenizer.encode(text, add_special_tokens=False)``, which writes an added
token's string in a text as that token's id.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

#: Pre-tokens that a worker remembers; once full, further ones are encoded each time.
KNOWN = 250_000

# The pre-tokenizer patterns of the two public tokenizer files.
WORDS_WITH_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS_ONLY = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The same for texts that hold none of OTHER: there \p{L} is [^\W\d_] and \p{N} is \d.
LATIN_WITH_SPACE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
LATIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Not Latin-1, or a character on which the engines' classes of spaces and digits may differ.
OTHER = re.compile("[\x1c-\x1f\x80-\xa0²³¹¼-¾Ā-\U0010ffff]")


def byte_characters() -> dict[int, str]:
    """Byte-level tokenizers write each byte as one printable character: printable
    Latin-1 bytes as themselves, the rest in order from U+0100."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def latin_cutter(spec: dict):
    """The function that cuts a Latin-1 text into the pre-tokens of this tokenizer file, or None."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if (spec.get("model") or {}).get("type") != "BPE" or spec["model"].get("dropout"):
        return None
    if norm is not None and any(t.get("normalized") for t in spec.get("added_tokens") or []):
        return None  # such tokens are found in the normalised text only
    if (pre.get("type") == "ByteLevel" and norm is None and not pre.get("add_prefix_space", True)
            and pre.get("use_regex", True)):
        return LATIN_WITH_SPACE.findall
    parts = pre.get("pretokenizers", [])
    steps = [s.get("type") for s in (norm or {}).get("normalizers", [])]
    if ([p.get("type") for p in parts] == ["Split", "ByteLevel"] and parts[0].get("invert")
            and parts[0].get("behavior") == "Removed" and parts[0]["pattern"].get("Regex") == WORDS_ONLY
            and not parts[1].get("add_prefix_space", True) and steps == ["NFC", "Replace", "Lowercase"]):
        return lambda text: LATIN_WORDS.findall(text.lower())
    return None


class Encoder:
    """``ids(texts)``: little-endian unsigned 32-bit ids of each text; none are added around it.
    None and "" give no ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._cut = latin_cutter(spec)
        self._added = [t["content"] for t in spec.get("added_tokens") or []]
        self._whole = lambda t: np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        shown, tokenize = byte_characters(), tok.model.tokenize

        class Known(dict):
            def __missing__(self, word: str) -> bytes:
                byte_word = word.encode().decode("latin-1").translate(shown)
                ids = b"".join([t.id.to_bytes(4, "little") for t in tokenize(byte_word)])
                if len(self) < KNOWN and len(word) <= 40:
                    self[word] = ids
                return ids

        self._known = Known()

    def ids(self, texts) -> list[bytes]:
        cut, look, added = self._cut, self._known.__getitem__, self._added
        return [b"" if not t else self._whole(t) if cut is None or OTHER.search(t) or any(a in t for a in added)
                else b"".join(map(look, cut(t))) for t in texts]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return Encoder(path)
