r"""Cutting a text where byte-level pre-tokenisation surely cuts it.

The public pattern always ends a match before a space unless white space stands on both sides of
that space: a run of white space is split as "all but the last" and "the last, with the word that
follows". So a text may be cut before each space, and equal units encode equally, which lets a task
remember them. Texts with white space around a space are encoded in one go instead.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

from lapsewise.llm.common import Cache

#: str's white space includes all that the tokenizers' patterns call white space.
_INSIDE_SPACE = re.compile(r"\s \s")


def slices(text: str, size: int) -> Iterator[str]:
    """``text`` in order, cut near every ``size`` characters before a space that stands between
    two other characters; where there is none, the slice goes on."""
    start = 0
    while len(text) - start > size:
        cut = start + size
        while (cut := text.find(" ", cut)) > 0 and (text[cut - 1].isspace() or text[cut + 1 : cut + 2].isspace()):
            cut += 1
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


class UnitEncoder:
    """Token ids of texts as packed unsigned 32-bit numbers. ``encode`` gives the ids of any string."""

    def __init__(self, encode: Callable[[str], list[int]]):
        self.encode = encode
        self.after_space = Cache(lambda unit: array("I", encode(" " + unit)).tobytes())

    def pack(self, text: str) -> bytes:
        return array("I", self.encode(text)).tobytes()

    def ids(self, text: str, size: int = 1_000_000) -> bytes:
        if len(text) <= size:
            return self._ids(text)
        return b"".join(map(self._ids, slices(text, size)))

    def _ids(self, text: str) -> bytes:
        if _INSIDE_SPACE.search(text):
            return self.pack(text)
        first, *units = text.split(" ")
        return self.pack(first) + b"".join(map(self.after_space.__getitem__, units))
