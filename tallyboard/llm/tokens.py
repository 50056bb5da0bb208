"""Token ids of a byte-level BPE tokenizer file, exactly as the tokenizers library gives them."""

from __future__ import annotations

import functools
import json
import os
import re

#: Fixed value: how byte-level BPE vocabularies of this kind cut text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of these characters alone are cut alike by every regular expression library; others go to the slow path.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡§«°»¿À-ɏ–—‘’“”…€]*")
#: The same cuts for such texts, for Python's own faster library.
PLAIN_WORDS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, to that byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """What a tokenizer file holds: token bytes to ids, and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        letters = byte_letters()
        self.path = path
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.ranks = {
            bytes(letters[c] for c in token): k for token, k in held["model"]["vocab"].items() if token not in self.special
        }

    @functools.cached_property
    def bytes_of(self) -> list[bytes]:
        out = [b""] * (1 + max([*self.ranks.values(), *self.special.values()]))
        for token, k in self.ranks.items():
            out[k] = token
        for token, k in self.special.items():
            out[k] = token.encode()
        return out

    def plain(self, text: str) -> bool:
        """Whether the fast path cuts this text as the library does."""
        return PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def split_special(self, text: str) -> list[str]:
        """The text cut at special tokens, which stay as parts."""
        if not self.special:
            return [text]
        return re.split("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")", text)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: itself if it is a token, else merged pair by pair, lowest rank first."""
        known = self.ranks.get(piece)
        return [known] if known is not None else self.merger(piece)

    @functools.cached_property
    def merger(self):
        return self.fast._core_bpe.encode_single_piece

    @functools.cached_property
    def library(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @functools.cached_property
    def fast(self):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.plain(text):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One copy for each worker process."""
    return Vocabulary(path)
