"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

The vocabularies used here drop white space and never join characters across
it, so the ids of a text are those of its words in turn. Each Python worker
keeps the ids of words it has met; the library encodes the others. A text that
holds the start of a special token's string goes through the library whole.
"""

from __future__ import annotations

import os
from array import array
from unicodedata import is_normalized

from taxaweave.llm.common import cut_at_blanks


#: Words whose ids a worker keeps at most (about 200 bytes each).
KEPT_WORDS = 1_000_000

#: ASCII punctuation without the apostrophe, which may start a pre-token of letters.
CLOSING = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_signs() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(256 + n) for n, b in enumerate(odd)}


BYTE_SIGNS = _byte_signs()

_ENCODERS: dict[tuple[str, int], "Encoder"] = {}


class Encoder(dict):
    """word (bytes, ASCII lower case) -> its ids as little-endian uint32 bytes.

    An unknown word goes through the library. Two short cuts skip its costly
    alignment tracking where the result cannot differ: closing ASCII
    punctuation after a letter or digit is a pre-token of its own, so stem and
    punctuation are looked up apart; a word of letters that normalising leaves
    alone is one pre-token, which the library's model splits directly.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kept = kept

    def whole(self, data: bytes) -> bytes:
        ids = self.tokenizer.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        stem = text.rstrip(CLOSING)
        end = stem[-1:].lower()
        if len(stem) < len(text) and (end.isalpha() or end.isascii() and end.isdigit()):
            ids = self[stem.encode()] + self[text[len(stem):].encode()]
        elif text.isalpha() and (text.isascii() or is_normalized("NFC", text)) and (low := "".join(map(str.lower, text))).isalpha():
            ids = array("I", [t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(BYTE_SIGNS))]).tobytes()
        else:
            ids = self.whole(word)
        self[word] = ids
        return ids

    def ids(self, text: bytes | None) -> bytes:
        """Ids of one text (UTF-8 bytes; null: none) as little-endian uint32."""
        if not text:
            return b""
        if b"<|" in text:
            return self.whole(text)
        out = []
        for piece in cut_at_blanks(text):
            if len(self) > self.kept:
                self.clear()
            out.append(b"".join(map(self.__getitem__, piece.lower().split())))
        return out[0] if len(out) == 1 else b"".join(out)


def encoder(path: str, kept: int = KEPT_WORDS) -> Encoder:
    """The worker's encoder for a tokenizer file; made once per worker."""
    if (path, kept) not in _ENCODERS:
        _ENCODERS[path, kept] = Encoder(path, kept)
    return _ENCODERS[path, kept]


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
