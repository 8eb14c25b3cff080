"""Token ids of whole texts with a public vocabulary file, as little-endian 32-bit bytes.

Most of a tokenizer's time goes into words it has seen before. For the vocabulary of lower-cased
words (``lowered_words=True``) white space always ends a token and the text is first split into
letters, single digits and other signs, so ids are kept per such part and looked up; the library
encodes each part once. Texts with characters beyond Latin-1 are kept per white-space word, and
texts that may hold a special token's string go through the library whole.
"""

import re
from functools import cache

import numpy as np

# The vocabulary's own split, spelled out for Latin-1: letters, one digit, or other signs.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANKS = r"\x09-\x0D\x20\x85\xa0"
_PARTS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
)
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
KEPT_PARTS = 600_000


class TextIds:
    """Ids of texts as bytes, four to an id."""

    def __init__(self, path: str, lowered_words: bool = True):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.lowered_words = lowered_words
        self.kept: dict[str, bytes] = {}
        names = self.library.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """One call for all parts: each ends with the one token of it that carries the word end."""
        ids = np.array(
            self.library.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids,
            dtype="<u4",
        )
        cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        if len(cuts) != len(parts) + 1 or cuts[-1] != 4 * len(ids):
            return self._encode(parts)
        data = ids.tobytes()
        return [data[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def __call__(self, text: str) -> bytes:
        if not self.lowered_words or "<|" in text:
            return self._encode([text])[0]
        try:
            text.encode("latin-1")
            parts, encode = _PARTS.findall(text.lower()), self._encode_parts
        except UnicodeEncodeError:
            parts, encode = _WORDS.findall(text), self._encode
        kept = self.kept
        new = [x for x in dict.fromkeys(parts) if x not in kept]
        if new:
            if len(kept) + len(new) > KEPT_PARTS:
                kept.clear()
                new = list(dict.fromkeys(parts))
            kept.update(zip(new, encode(new), strict=True))
        return b"".join([kept[x] for x in parts])


@cache
def text_ids(path: str, lowered_words: bool = True) -> TextIds:
    """One per Python worker and vocabulary."""
    return TextIds(path, lowered_words)
