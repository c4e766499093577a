"""Bytes of a page to text.

The rule, first match first: a byte order mark; the charset that a ``<meta>`` in the first ``HEAD`` bytes names, if
the bytes follow it; UTF-8, if the bytes are valid UTF-8; windows-1252, with U+FFFD for bytes it has no sign for.
So every page has a text, and the same bytes always give the same one.
"""

from __future__ import annotations

import codecs
import re

HEAD = 1024
_BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
_DECLARED = re.compile(rb"<meta\b[^>]*?\bcharset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.IGNORECASE)
# Python codecs that are no character sets of web pages
_NOT_CHARSETS = frozenset({"idna", "punycode", "unicode_escape", "raw-unicode-escape", "unicode-escape", "undefined", "utf-7"})


def declared_charset(head: bytes) -> str | None:
    """The codec of the first charset that a ``<meta>`` names; None without one or if it is unknown.

    ASCII and Latin-1 mean windows-1252 on the web; a page whose ``<meta>`` can be read as ASCII isn't in UTF-16, so
    that label means UTF-8.
    """
    found = _DECLARED.search(head)
    if not found:
        return None
    try:
        codec = codecs.lookup(found[1].decode("ascii"))
        b"0".decode(codec.name, "replace")  # codecs between bytes, such as hex, raise here
    except LookupError:
        return None
    if codec.name in _NOT_CHARSETS:
        return None
    if codec.name in ("ascii", "iso8859-1"):
        return "cp1252"
    return "utf-8" if codec.name.startswith(("utf-16", "utf-32")) else codec.name


def page_text(data: bytes) -> str:
    """The text of a page's bytes, without a byte order mark."""
    for bom, codec in _BOMS:
        if data.startswith(bom):
            return data[len(bom):].decode(codec, "replace")
    for codec in (declared_charset(data[:HEAD]), "utf-8"):
        try:
            if codec is not None:
                return data.decode(codec)
        except UnicodeDecodeError:
            continue
    return data.decode("cp1252", "replace")
