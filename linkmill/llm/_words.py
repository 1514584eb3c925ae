"""Words of a text: runs of letters and digits, with A-Z lower-cased; every character beyond ASCII belongs to a word."""

from __future__ import annotations

_TABLE = bytes(b if b >= 128 or chr(b).isdigit() or "a" <= chr(b) <= "z" else b + 32 if "A" <= chr(b) <= "Z" else 32 for b in range(256))


def split_words(text: str | None) -> list[bytes]:
    """The words as UTF-8; in UTF-8 the bytes of characters beyond ASCII are 128 and more, so bytes can be mapped singly."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []
