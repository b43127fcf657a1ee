"""Pieces of a text, as a tokenizer file's normaliser and splitting pattern cut it, from chunks of any size.

Texts of ``PLAIN`` characters (ASCII and Latin letters) are lower-cased and cut by one expression. Other texts go through the
normaliser and splitter that the file itself names, so rules of scripts and Unicode versions are the tokenizer's own.
Pieces never depend on text before their start. Only the end of a chunk is open: the last piece may go on, and a
character may still compose with the next, so these few characters wait for the next chunk.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

# Lower-case forms of Latin letters, some of which lie behind the range.
LETTERS = "a-zß-öø-ɏ" + "".join(sorted({chr(c).lower() for c in range(0xC0, 0x250) if c != 0x130 and chr(c).lower() > "ɏ"}))
# The splitting pattern of the word tokenizer, for lower-cased Latin text.
CUT = re.compile(rf"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s{LETTERS}0-9]+")
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-įı-ɏ]*").fullmatch
# First letters of contractions of two letters.
HALF = ("r", "v", "l")
# End of fixed values.
#: From this length on an open piece is passed on in parts.
OPEN_CHARS = 4096


@functools.cache
def composing() -> frozenset[str]:
    """Characters that may change with the character before them under canonical composition."""
    found = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


def settled(text: str) -> int:
    """Length of the longest start of ``text`` whose normal form no later text changes."""
    for i in range(len(text) - 1, -1, -1):
        c = text[i]
        if c < "\x80":
            return i
        if unicodedata.combining(c) == 0 and unicodedata.category(c) != "Cn" and c not in composing():
            return i
    return 0


class Front:
    """Normaliser, splitter and special tokens of a tokenizer file."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.find_special = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.starts = {s[:k] for s in self.special for k in range(1, len(s))}
        self.longest = max(map(len, self.special), default=0)

    def normalise(self, text: str) -> str:
        return text.lower() if PLAIN(text) else self.tokenizer.normalizer.normalize_str(text)

    def cut(self, text: str) -> list[str]:
        """Pieces of normalised text."""
        if PLAIN(text):
            return CUT.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def kind(self, char: str) -> str:
        """L(etter), N(umber), S(pace) or O(ther), as the splitter sees it."""
        spans = [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{char}!")]
        return {((0, 1), (2, 3)): "S", ((0, 2), (2, 3)): "L", ((0, 1), (1, 3)): "O"}.get(tuple(spans), "N")

    def half_special(self, text: str) -> int:
        """Place where the text may end in the beginning of a special token."""
        for i in range(max(0, len(text) - self.longest), len(text)):
            if text[i:] in self.starts:
                return i
        return len(text)


class Pieces:
    """Feed chunks, get items: a piece, an id (special token), or ``(part, last)`` of a long piece."""

    def __init__(self, front: Front):
        self.front = front
        self.raw = ""
        self.open = ""
        self.running: str | None = None

    def feed(self, chunk: str, last: bool = False) -> Iterator[str | int | tuple[str, bool]]:
        text = self.raw + chunk
        end = len(text) if last else self.front.half_special(text)
        at = 0
        for m in self.front.find_special.finditer(text, 0, end):
            yield from self._section(text[at : m.start()], True)
            yield self.front.special[m.group()]
            at = m.end()
        ready = end if last else at + settled(text[at:end])
        self.raw = text[ready:]
        yield from self._section(text[at:ready], last)

    def _section(self, text: str, closed: bool) -> Iterator[str | tuple[str, bool]]:
        text = self.open + self.front.normalise(text)
        self.open = ""
        if self.running:
            n = 0
            while n < len(text) and self.front.kind(text[n]) == self.running:
                n += 1
            done = closed or n < len(text)
            yield text[:n], done
            if not done:
                return
            self.running, text = None, text[n:]
        if not text:
            return
        found = self.front.cut(text)
        if closed:
            yield from found
            return
        if not found or not text.endswith(found[-1]):
            yield from found
            return
        held = 2 if found[-1] in HALF and len(found) > 1 and text.endswith("'" + found[-1]) and found[-2] == "'" else 1
        self.open = "".join(found[-held:])
        yield from found[:-held]
        kind = self.front.kind(self.open[-1]) if len(self.open) > OPEN_CHARS else "N"
        if kind != "N":
            # Characters at its end may still normalise with the next, which the raw rest sees to.
            self.running = kind
            yield self.open, False
            self.open = ""
