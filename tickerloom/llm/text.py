"""Byte-level word splitting shared by the operators."""

UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def utf8(text):
    """UTF-8 bytes of a text; a missing text has none."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
