"""Places where a long text may be cut without changing its pre-tokens.

Byte-level BPE vocabularies split a text with one pattern before any merge::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

No match crosses from a character that is no white space to one that is, nor
from an ASCII letter or digit to ASCII punctuation, between ASCII letters and
digits, or from ASCII punctuation to a digit. (Punctuation to letter may be a
contraction.) In a run of white space before other characters, a match ends
before the last character of the run. Cutting there leaves every match as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: White space as Unicode has it.
SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_PUNCT = "!-/:-@\\[-`{-~"
_EDGE = re.compile(
    f"(?<=[^{SPACE}])(?=[{SPACE}])|(?<=[{SPACE}])(?=[{SPACE}][^{SPACE}])|(?<=[A-Za-z])(?=[0-9{_PUNCT}])"
    f"|(?<=[0-9])(?=[A-Za-z{_PUNCT}])|(?<=[{_PUNCT}])(?=[0-9])"
)
_SPACES = re.compile(f"[{SPACE}]+")
PIECE = 1 << 16
#: White space before a space, so that a space alone does not tell where a word begins.
_ODD = re.compile(f"[{SPACE}] ")
_LED = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def safe_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut at safe places only.

    A stretch without a safe place stays whole, however long it is, and stands
    alone.
    """
    at, end = 0, len(text)
    while end - at > size:
        found = _EDGE.search(text, at + size)
        cut = found.start() if found else end
        if cut - at > 2 * size:
            # A long stretch lies in between: cut it off from its neighbours.
            for edge in _EDGE.finditer(text, at + 1, cut):
                if edge.start() > at:
                    yield text[at:edge.start()]
                    at = edge.start()
        yield text[at:cut]
        at = cut
    if at < end or not end:
        yield text[at:]


def is_space(piece: str) -> bool:
    return _SPACES.fullmatch(piece) is not None


def led_words(piece: str) -> tuple[str, list[str], list[str]]:
    """A piece as pre-tokens that end where white space begins.

    Returns the head, which no space leads; the words that a single space
    leads, without that space; and words led by other white space, whole.
    """
    if _ODD.search(piece):
        return "", [], _LED.findall(piece)
    head, *led = piece.split(" ")
    return (head, led[:-1], [" "]) if led and not led[-1] else (head, led, [])
