"""Token ids of the tokenizers library, with a memo of the pieces between spaces.

Both public tokenizers never join characters across a single space that stands between two other
characters, so the ids of a text are those of its pieces. A text for which that is not certain
(a special token, other white space next to a space) goes to the library whole. A piece of Latin-1
characters is cut by the public pattern and goes straight to the library's model, as the library's
longer way would do.
"""

from __future__ import annotations

import re
from array import array

import public_tokenizers
import regex
from tokenizers import Tokenizer

# Entries and length of pieces that a worker remembers.
MEMO_ROOM = 600_000
MEMO_LETTERS = 48

_RUNS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_loaded: dict[str, "Encoder"] = {}


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Fixed rule of the format: visible characters of Latin-1 stand for themselves, the others are
    numbered from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes whole texts as the library does with add_special_tokens=False."""

    def __init__(self, name: str):
        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.library.no_truncation()
        self.library.no_padding()
        self.marks = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # In byte-level vocabularies the space before a piece belongs to it.
        self.space = "" if self.library.normalizer else " "
        self.lower = bool(self.library.normalizer)
        self.letters = dict(enumerate(byte_letters()))
        # The pre-token patterns of the two public vocabularies.
        pattern = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        if self.lower:
            pattern = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        self.split = regex.compile("'s|'t|'re|'ve|'m|'ll|'d|" + pattern)
        self.memo: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def model(self, token: str) -> bytes:
        """Ids of one pre-token of Latin-1 letters."""
        if token.isalpha() and token.isascii():
            word = token
        else:
            word = token.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.library.model.tokenize(word)]).tobytes()

    def piece(self, text: str, space: str) -> bytes:
        """Ids of a piece that stands behind the given space."""
        if not text.isascii() and max(text) >= "Ā":
            return self.whole(space + text)
        if self.lower:
            text = text.lower()
        if text.isalpha():
            return self.model(space + text)
        out, bare = [], self.bare
        for token in self.split.findall(space + text):
            ids = self.memo.get(token[1:]) if space and token[0] == " " else bare.get(token)
            if ids is None:
                ids = self.model(token)
                if len(token) <= 4:
                    bare[token] = ids
            out.append(ids)
        return b"".join(out)

    def runs(self, text: str) -> bytes:
        """Pieces that begin with their spaces and line ends."""
        found = _RUNS.findall(text)
        for core in filter(None, (run.lstrip(" \n") for run in found)):
            if core[0].isspace() or core[-1].isspace():
                return self.whole(text)
        return b"".join(map(self.whole, found))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit numbers; null is empty."""
        memo = self.memo
        out = []
        for text in texts:
            if not text or any(mark in text for mark in self.marks):
                out.append(self.whole(text) if text else b"")
                continue
            parts = text.split(" ")
            first = parts.pop(0) if self.space else ""
            got = list(map(memo.get, parts))
            long, odd = {}, self.space and len(parts) and first[-1:].isspace()
            for at in [i for i, ids in enumerate(got) if ids is None]:
                part = parts[at]
                ids = memo.get(part) or long.get(part)
                if ids is None:
                    if self.space and (not part or part[0].isspace() or part[-1].isspace()):
                        odd = True
                        break
                    ids = self.piece(part, self.space)
                    if len(part) <= MEMO_LETTERS:
                        memo[part] = ids
                    else:
                        long[part] = ids
                got[at] = ids
            if odd:
                out.append(self.runs(text))
            else:
                out.append((self.piece(first, "") if first else b"") + b"".join(got))
            if len(memo) + len(self.bare) > MEMO_ROOM:
                memo.clear()
                self.bare.clear()
        return out


def encoder(name: str) -> Encoder:
    """The encoder of this worker."""
    if name not in _loaded:
        _loaded[name] = Encoder(name)
    return _loaded[name]
