"""Token ids of texts, fast, for the tokenizer that lower-cases and drops white space.

Texts of plain characters alone (ASCII without apostrophe and "<|", Latin letters) are
lower-cased and cut here into the parts that the tokenizer's own splitter makes: runs of
letters, single digits, runs of other signs. A part's ids come from the tokenizer's model
once and are kept. The apostrophe and "<|" mean more to the splitter, so words with them
or with other characters go through the whole tokenizer. It never joins over white space,
so ids of a text are those of its parts in order (tested against whole texts).
"""

from __future__ import annotations

import re
import struct
from functools import cache

PARTS_KEPT = 400_000
#: What is not plain.
ODD = re.compile(r"[^!-&(-~À-ÖØ-öø-ÿ \n]|<\|")
PARTS = re.compile(
    r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \n]+"
)


def byte_letters() -> dict[int, str]:
    """The letters that stand for UTF-8 bytes in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordIds(dict):
    """Packed little-endian ids of lower-case parts, looked up as they turn up."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.odd_words: dict[str, bytes] = {}
        letters = byte_letters()
        self.latin = {
            c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)
        }  # for str.translate

    def __missing__(self, part: str) -> bytes:
        if len(self) >= PARTS_KEPT:
            self.clear()
        ids = [t.id for t in self.model.tokenize(part.translate(self.latin))]
        self[part] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, PARTS.findall(text.lower())))

    def _odd(self, word: str) -> bytes:
        if len(self.odd_words) >= PARTS_KEPT:
            self.odd_words.clear()
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        self.odd_words[word] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if not ODD.search(text):
            return self._plain(text)
        known = self.odd_words.get
        return b"".join(
            known(word) or self._odd(word) if ODD.search(word) else self._plain(word)
            for word in text.replace("\n", " ").split(" ")
        )


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
