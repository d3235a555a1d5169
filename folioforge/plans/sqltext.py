"""SQL twins of the text functions: what DuckDB lacks is written out from the Unicode tables."""

from __future__ import annotations

import functools
import unicodedata

from folioforge.functions import text as X


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@functools.cache
def _tables() -> tuple[str, str, str]:
    """Characters whose compatibility decomposition is one character, those characters, and a map of the longer ones."""
    one, to, many = [], [], []
    for code in range(0x80, 0x10000):
        ch = chr(code)
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3 or not unicodedata.decomposition(ch):
            continue
        made = unicodedata.normalize("NFKD", ch)
        if unicodedata.normalize("NFKC", ch) == ch:
            continue  # composes back to itself
        if len(made) == 1:
            one.append(ch)
            to.append(made)
        else:
            many.append((ch, made))
    pairs = ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in many)
    return "".join(one), "".join(to), f"MAP {{{pairs}}}"


def nfkc(expr: str) -> str:
    """The compatibility form: single characters by translate, longer ones by a map, then canonical composition."""
    one, to, many = _tables()
    plain = f"translate({expr}, {quoted(one)}, {quoted(to)})"
    classes = "[\\x{A0}-\\x{FFFF}]"
    expanded = f"CASE WHEN regexp_matches({plain}, {quoted(classes)}) THEN coalesce(array_to_string(list_transform(string_split({plain}, ''), lambda c: coalesce(({many})[c], c)), ''), {plain}) ELSE {plain} END"
    return f"nfc_normalize({expanded})"


def dropped(expr: str, pattern: str) -> str:
    return f"regexp_replace({expr}, {quoted(pattern)}, '', 'g')"


def toc_title_key(expr: str) -> str:
    return dropped(f"lower({nfkc(expr)})", X.TOC_TITLE_DROPS)


def shop_title_key(expr: str) -> str:
    return dropped(f"lower({nfkc(expr)})", X.SHOP_TITLE_DROPS)


def search_key(expr: str) -> str:
    return f"translate(lower({nfkc(expr)}), {quoted(X.KATAKANA)}, {quoted(X.HIRAGANA)})"


def publisher_key(expr: str) -> str:
    return dropped(dropped(f"lower({nfkc(expr)})", X.COMPANY_FORMS), X.PUBLISHER_DROPS)
