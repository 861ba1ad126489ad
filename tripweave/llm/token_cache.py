"""Token ids of whole texts through a bounded cache of space-separated chunks.

The byte-level split pattern never lets a token cross a single space between
two other characters that are not white space (the space opens the next token),
the place before a point or comma that follows a letter or digit, or a single
line feed.  So a text may be cut there and the ids of the pieces joined; the
result equals one call over the whole text (tested against it).  Running text
repeats its pieces, so most of them come from the cache.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

#: Places where the quick cut below would part one token: a space or line feed
#: next to other white space, a point or comma after anything but a letter or digit.
#: Each pattern opens with the characters that it looks for, which is quick to scan.
_ODD_SPACE = re.compile(r"[ \n](?:\s|(?<=\s.))", re.DOTALL)
_ODD_POINT = re.compile(r"[.,](?<![^\W_].)")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def chunks(text: str) -> list[str]:
    """Pieces of ``text`` whose ids can be computed one by one."""
    line = text.replace("\n", " ")
    # printable text has no other white space than the space, which is quick to tell
    if ("  " in line or not line.isprintable()) and ("\0" in text or _ODD_SPACE.search(text)) or _ODD_POINT.search(text):
        return _CUT.split(text)
    return (text.replace(" ", "\x00 ").replace(",", "\x00,").replace(".", "\x00.")
            .replace("\n", "\x00\n\x00").split("\x00"))


class ChunkIds(dict):
    """Ids (packed little-endian uint32) of texts, by cached chunk.

    Two generations of about ``cap`` chunks each bound the memory: when the
    young one is full it becomes the old one, and what is met again moves
    back.  Chunks longer than ``longest`` are encoded but not kept."""

    def __init__(self, encode: Callable[[str], list[int]], cap: int = 500_000, longest: int = 64):
        super().__init__()
        self.encode, self.cap, self.longest = encode, cap, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            got = self.encode(chunk)
            ids = struct.pack(f"<{len(got)}I", *got)   # a few ids: quicker than an array
        if len(chunk) <= self.longest:
            self[chunk] = ids
        return ids

    def clear(self) -> None:
        super().clear()
        self.old = {}

    def packed(self, text: str | None) -> bytes:
        """Ids of one whole text (null: empty)."""
        if not text:
            return b""
        if len(self) >= self.cap:
            young = dict(self)
            self.clear()
            self.old = young
        return b"".join(map(self.__getitem__, chunks(text)))


_LOADED: dict[tuple[str, int], ChunkIds] = {}


def library_ids(tokenizer_json: str, cap: int = 500_000) -> ChunkIds:
    """The cache over the ``tokenizers`` library for this worker process; a chunk
    in one of its two generations of ``cap`` takes about 200 bytes."""
    key = (f"library-{cap}", hash(tokenizer_json))
    if key not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # one task, one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        _LOADED[key] = ChunkIds(lambda chunk: tokenizer.encode(chunk, add_special_tokens=False).ids, cap)
    return _LOADED[key]


def tokenizer_text(path: str | None = None) -> str:
    """Content of a tokenizer file (default: the public byte-level BPE).  It is
    read on the driver and broadcast, 1.5 MB, so executors need no such file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()
