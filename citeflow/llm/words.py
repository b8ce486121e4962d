"""Words of UTF-8 texts, as bytes: every byte of a non-ASCII character is 0x80 or more."""

from __future__ import annotations

# Lower-cases A-Z and blanks every other ASCII byte that is neither a letter nor a digit.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def alnum_blanked(text: bytes | None) -> bytes:
    """Same length as ``text``; words are what stands between blanks."""
    return (text or b"").translate(_ALNUM)


def alnum_words(text: bytes | None) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z lower-cased."""
    return alnum_blanked(text).split()


def spaced_words(text: bytes | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of the text with A-Z lower-cased."""
    return (text or b"").lower().split()
