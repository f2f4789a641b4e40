"""Tokenizer files, opened once per Python worker, and a memo of bounded size for what repeats in texts."""

from __future__ import annotations

import os
import re
from functools import lru_cache

#: Entries of the younger half of a memo.
MEMO = 1 << 18


class Memo(dict):
    """key -> work(key), for at most 2 * MEMO keys: when the young half is full it becomes the old one."""

    def __init__(self, work, size: int = MEMO) -> None:
        super().__init__()
        self._work, self._size, self._old = work, size, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._work(key)
        self[key] = value
        return value

    def trim(self) -> None:
        """To be called between texts: `map(memo.__getitem__, ...)` must not run while the halves change."""
        if len(self) > self._size:
            self._old = dict(self)
            self.clear()


#: A space after a character that no tokenizer here joins to it. Neither a pretoken nor a special token spans it.
_CUT = re.compile(r"(?<=\S) ")
_ODD = re.compile(r"\s ")


def pieces(text: str) -> list[str]:
    """`text` cut before single spaces; every piece but the first stands for itself after a space."""
    return text.split(" ") if _ODD.search(text) is None else _CUT.split(text)


@lru_cache(maxsize=None)
def open_tokenizer(name: str):
    """`name`: a file of the public tokenizers, or a path that each executor has."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found
