"""Encoding of texts piece by piece, with remembered pieces.

The split pattern of the byte-level vocabularies cuts before every space that a
visible character follows, and makes a single line feed between visible
characters a match of its own. So in a text whose lines and words are set apart
by exactly one line feed or space, each word with the space before it can be
encoded alone, and so can the signs right after its letters; words repeat. Other
texts are first cut at white space as the pattern would. Control characters that
not all libraries take for white space send a text to be encoded whole. All ways
give the same ids.
"""

from __future__ import annotations

import re
import string
import weakref
from collections.abc import Callable, Iterable, Iterator

#: All white space of any of the libraries, and what only some of them take for it.
SPACE = re.compile(r"\s")
UNSURE = re.compile("[\x1c-\x1f\u180e]")
#: Where the pattern cuts around white space: between its parts each stands alone.
AROUND_SPACE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Pieces in a generation of a worker's memory, and characters encoded together.
REMEMBERED = 500_000
#: Signs after a word are a match of their own; the apostrophe may begin another.
MARKS = string.punctuation.replace("'", "")
BATCH_CHARS = 1 << 20


class Memory(dict[str, bytes]):
    """What was worked out lately: two generations, of which the older one goes when the younger is full.

    A key that is not known is made when it is first asked for.
    """

    def __init__(self, make: Callable[[str], bytes], size: int = REMEMBERED) -> None:
        super().__init__()
        self.make, self.size = make, size
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def age(self) -> None:
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()


#: The encoders of this worker.
_LOADED: weakref.WeakSet[PieceEncoder] = weakref.WeakSet()


def forget_pieces() -> None:
    """Give a worker's remembered pieces back, where it goes on with something else: they would only take memory from that."""
    for encoder in _LOADED:
        for memory in (encoder.words, encoder.signs, encoder.loose):
            memory.clear()
            memory.old = {}


class PieceEncoder:
    """Packed ids of texts, 4 bytes each, little-endian.

    ``spell`` gives the packed ids of a piece; ``whole`` those of any text. A
    text in which ``apart`` is found is always encoded whole.
    """

    def __init__(self, spell: Callable[[str], bytes], whole: Callable[[str], bytes], apart: re.Pattern | None = None) -> None:
        self.spell, self.whole, self.apart = spell, whole, apart
        self.words = Memory(self.word)  # a line feed in front stands for the start of a line, nothing for a space
        self.signs = Memory(spell)
        self.loose = Memory(spell)  # parts of texts with white space of any form
        self.line_feed = spell("\n")
        _LOADED.add(self)

    def word(self, piece: str) -> bytes:
        """A word with the space or line feed before it; of one with signs after its letters, the word becomes known as well."""
        first = piece[:1] == "\n"
        own = piece[1:] if first else piece
        if not own.isalpha():
            word = own.rstrip(MARKS)
            if word.isalpha():
                signs = own[len(word) :]
                return self.words[piece[: -len(signs)]] + self.signs[signs]
            if not own or SPACE.search(own):
                raise KeyError(piece)
        return self.line_feed + self.spell(own) if first else self.spell(" " + own)

    def encode(self, texts: list[str]) -> list[bytes]:
        for memory in (self.words, self.signs, self.loose):
            memory.age()
        out, known, before = [], self.words.__getitem__, len(self.line_feed)
        for text in texts:
            if not text:
                out.append(b"")
                continue
            if self.apart and self.apart.search(text):
                out.append(self.whole(text))
                continue
            cut = f"\n{text}".replace("\n", " \n").split(" ")
            try:
                out.append(b"".join(map(known, cut[1:]))[before:])
            except KeyError:  # white space of another form
                out.append(self.parts(text))
        return out

    def parts(self, text: str) -> bytes:
        """The ids of a text with any white space."""
        if UNSURE.search(text):
            return self.whole(text)
        return b"".join(map(self.loose.__getitem__, AROUND_SPACE.findall(text)))


def encoded(rows: Iterable[tuple], encoder: PieceEncoder) -> Iterator[tuple]:
    """Each row, whose last value is its text, with the packed ids in its place."""
    waiting: list[tuple] = []
    chars = 0
    for row in rows:
        waiting.append(row)
        chars += len(row[-1])
        if chars >= BATCH_CHARS:
            yield from _flush(waiting, encoder)
            waiting, chars = [], 0
    yield from _flush(waiting, encoder)


def _flush(rows: list[tuple], encoder: PieceEncoder) -> Iterator[tuple]:
    for row, ids in zip(rows, encoder.encode([r[-1] for r in rows]), strict=True):
        yield *row[:-1], ids
