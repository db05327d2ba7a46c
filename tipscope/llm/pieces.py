"""Exact token ids of whole texts by pieces cut at proven boundaries.

A cut before an ASCII white-space character that follows a character which is
surely not white space is a token boundary whatever stands left or right of
it: the splitting patterns of the vocabularies never let a token run from such
a character into white space, match left to right without memory, and merge
inside one match only.  So a text's ids are the concatenated ids of its pieces.

A worker keeps a bounded table of pieces it has met; a new piece goes to the
library.  Pieces of Latin letters and trailing ASCII punctuation split into
their two matches without the library's pattern engine, which is its slow part,
and go to its merge model directly; all others are encoded by the whole
tokenizer.  That short way is used only if it agrees with the whole tokenizer
on a set of probes.
"""
from __future__ import annotations

import os
import re
import gc
import sys
import types
from array import array
from collections.abc import Iterable

# ASCII white space, and all that any reading of white space could add.
ASCII_SPACE = "\\t\\n\\x0b\\x0c\\r "
OTHER_SPACE = "\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u2060\\u3000\\ufeff"
PIECE = re.compile(f"(?s:.)(?:[^{ASCII_SPACE}]+|(?<=[{ASCII_SPACE}{OTHER_SPACE}])[{ASCII_SPACE}])*")
# White space other than blanks and line ends, and blanks or line ends not between words.
_OTHER = re.compile(f"[\\t\\x0b\\x0c\\r{OTHER_SPACE}]")
_DOUBLE = ("  ", "\n\n", " \n", "\n ")
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)\Z")
_PROBES = (" the", "the", "\nThe", " The,", " über%%%", "\nÉtrennyé.", "Ça", " Thththtiontion", " x&&&", " A", "ñandú;", " OF!!", "Straße?!", " ÿ.")

#: Bytes of memory the piece table may hold before it starts anew.
TABLE_BYTES = 128 << 20
_ENTRY_BYTES = 190  # key, value and table slot of a usual piece


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _byte_letters() -> list[str]:
    """Byte-level vocabularies write bytes as visible letters: printable Latin-1
    bytes as themselves, the others as the letters from U+0100 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class _Table(dict):
    """Piece to ids as little-endian unsigned 32-bit bytes; learns what is missing."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn, self.room = learn, TABLE_BYTES

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.learn(piece)
        self.room -= _ENTRY_BYTES + len(piece) + len(ids)
        return ids


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._model = self.tokenizer.model
        letters = _byte_letters()
        self._letters = str.maketrans({chr(b): letters[b] for b in range(256)})
        self._way: tuple[bool, bool] | None = None
        for way in ((True, False), (False, True)):  # (blank is part of the word's match, case is lowered)
            self._way = way
            self._start()
            if all(self.ids_of(p) == self._whole(p) for p in _PROBES):
                break
        else:
            self._way = None
        self._start()

    def _start(self) -> None:
        self._spaced = _Table(self._learn_spaced)  # what follows a blank
        self._leading = _Table(self._learn_leading)  # what follows nothing or a line end
        self._tails: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _match(self, text: str) -> bytes:
        """Ids of one match of the splitting pattern."""
        shown = text.encode().decode("latin-1").translate(self._letters)
        return array("I", [t.id for t in self._model.tokenize(shown)]).tobytes()

    def _tail(self, tail: str) -> bytes:
        ids = self._tails.get(tail)
        if ids is None:
            ids = self._match(tail)
            if len(tail) < 8:
                self._tails[tail] = ids
        return ids

    def _learn_spaced(self, part: str) -> bytes:
        found = _PLAIN.match(part) if self._way else None
        if found is None:
            return self._whole(" " + part)
        word, tail = found.groups()
        if tail:  # the word itself is learnt too: it comes with other tails
            return self._spaced[word] + self._tail(tail)
        keeps_blank, lower = self._way
        return self._match(" " + word if keeps_blank else word.lower() if lower else word)

    def _learn_leading(self, part: str) -> bytes:
        found = _PLAIN.match(part) if self._way else None
        if found is None:
            return self._whole(part)
        word, tail = found.groups()
        if tail:
            return self._leading[word] + self._tail(tail)
        return self._match(word.lower() if self._way[1] else word)

    def ids_of(self, piece: str) -> bytes:
        """Ids of one piece (see ``PIECE``)."""
        rest = piece[1:]
        if piece[0] == " " and rest and not rest[0].isspace():
            return self._spaced[rest]
        if piece[0] == "\n" and self._way and _PLAIN.match(rest):
            return (self._tail("\n") if self._way[0] else b"") + self._leading[rest]
        return self._leading[piece]

    def _lines(self, text: str) -> Iterable[bytes]:
        """Ids of a text whose words stand between single blanks and line ends."""
        end = self._tail("\n") if self._way[0] else b""
        spaced, leading = self._spaced.__getitem__, self._leading
        for k, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            if k:
                yield end if _PLAIN.match(first) else b""
                yield leading[first] if _PLAIN.match(first) else leading["\n" + first]
            else:
                yield leading[first]
            yield from map(spaced, rest)

    def _parts(self, text: str) -> Iterable[bytes]:
        """The ids of each piece of a text, in order."""
        if not text:
            return ()
        if self._way is None or text[0] in " \n" or text[-1] in " \n" or any(d in text for d in _DOUBLE) or _OTHER.search(text):
            return map(self.ids_of, PIECE.findall(text))
        return self._lines(text)

    def make_room(self) -> None:
        """Start the table anew if it is full; called before each text or chunk."""
        if self._spaced.room + self._leading.room < TABLE_BYTES:
            self._start()

    def encode(self, text: str | None) -> bytes:
        """Ids of a text; NULL counts as empty."""
        self.make_room()
        return b"".join(self._parts(text or ""))

    def count(self, text: str | None) -> int:
        self.make_room()
        return sum(map(len, self._parts(text or ""))) // 4


def encoder_of(path: str) -> PieceEncoder:
    """The worker's encoder of a vocabulary; it outlives a task if the worker does."""
    kept = sys.modules.setdefault("corpus_worker_state", types.ModuleType("corpus_worker_state"))
    encoders = vars(kept).setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = PieceEncoder(path)
    return encoders[path]


def release_encoders() -> None:
    """Give back the tables of encoders that earlier tasks of the worker left: called
    by operators that encode nothing and need the memory."""
    kept = sys.modules.get("corpus_worker_state")
    if kept is not None and vars(kept).pop("encoders", None):
        gc.collect()
