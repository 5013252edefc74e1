"""Token ids of whole texts with a public tokenizer file, by a cache over white-space separated chunks."""

from __future__ import annotations

import os
import re
import struct

#: Chunks whose ids one worker remembers before it starts anew.
CACHED = 300_000
# What the quick way is sure of: printable ASCII and single Latin letters that are stable under NFC and have
# one-character lower case. Any other text goes through the tokenizer as a whole.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ňŊ-ž]*")
# The pre-tokenizer's pieces, for such texts.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of the byte-level alphabet."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordTokenizer:
    """Little-endian 32-bit ids of a text, as bytes, equal to what ``tokenizers`` gives without special tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.cache: dict[str, bytes] = {}

    def __reduce__(self):
        raise TypeError("make one in each worker")

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for piece in _PIECE.findall(chunk):
            if not piece.isascii():
                piece = "".join([self.letters[b] for b in piece.encode()])
            ids += [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if "<|" in text or not _PLAIN.fullmatch(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        cache = self.cache
        chunks = text.lower().split()
        try:
            return b"".join([cache[c] for c in chunks])
        except KeyError:
            if len(cache) > CACHED:
                cache.clear()
            out = []
            for c in chunks:
                got = cache.get(c)
                if got is None:
                    got = cache[c] = self._chunk(c)
                out.append(got)
            return b"".join(out)


_made: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each file and worker process."""
    if path not in _made:
        _made[path] = WordTokenizer(path)
    return _made[path]
