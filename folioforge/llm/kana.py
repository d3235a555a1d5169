"""Kana and Latin spellings of Japanese names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_A = "あいうえお"
# The Hepburn letters of each kana row; irregular syllables are named one by one below.
_ROWS = {"": "あいうえお", "k": "かきくけこ", "s": "さしすせそ", "t": "たちつてと", "n": "なにぬねの", "h": "はひふへほ", "m": "まみむめも", "r": "らりるれろ", "g": "がぎぐげご", "z": "ざじずぜぞ", "d": "だぢづでど", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ"}
_IRREGULAR = {"し": "shi", "ち": "chi", "つ": "tsu", "ふ": "fu", "じ": "ji", "ぢ": "ji", "づ": "zu", "や": "ya", "ゆ": "yu", "よ": "yo", "わ": "wa", "を": "o", "ん": "n", "ー": "", "ゔ": "vu", "ゐ": "i", "ゑ": "e"}
_SMALL = {"ゃ": "a", "ゅ": "u", "ょ": "o"}
_TINY = {"ぁ": "a", "ぃ": "i", "ぅ": "u", "ぇ": "e", "ぉ": "o"}


def syllables() -> dict[str, str]:
    """Kana (one or two characters) to Latin letters."""
    out = {k: c + v for c, row in _ROWS.items() for k, v in zip(row, "aiueo")} | _IRREGULAR
    for c, row in _ROWS.items():
        lead = out[row[1]][:-1]  # ki -> k, shi -> sh
        for small, v in _SMALL.items():
            out[row[1] + small] = lead + v if lead in ("sh", "ch", "j") else lead + "y" + v
    return out | _TINY | _SMALL


_TABLE = syllables()


def romaji(text: str) -> str:
    """Latin letters of a hiragana text; a doubled consonant for the small tsu; other characters stay."""
    out, i = "", 0
    double = False
    while i < len(text):
        for size in (2, 1):
            piece = text[i : i + size]
            if len(piece) == size and piece in _TABLE:
                latin = _TABLE[piece]
                out += (latin[:1] if double and latin else "") + latin
                double = False
                break
        else:
            size = 1
            if text[i] == "っ":
                double = True
            else:
                out += text[i]
        i += size
    return out


def loose_latin(text: str) -> str:
    """Latin spellings on one footing: long vowels, n before labials, t for a doubled consonant."""
    import re

    text = re.sub(r"t(?=[pkg])|t(?=ch)", lambda m: text[m.end()], text)
    text = re.sub(r"m(?=[bpm])", "n", text)
    text = re.sub(r"o[uh](?=[^aeiou]|$)|oo", "o", text)
    return re.sub(r"uu", "u", text)


KATAKANA = "".join(chr(c) for c in range(0x30A1, 0x30F7))
HIRAGANA = "".join(chr(c - 0x60) for c in range(0x30A1, 0x30F7))


def hiragana(col: Column) -> Column:
    """Katakana to hiragana, in the JVM."""
    return F.translate(col, KATAKANA, HIRAGANA)


def to_hiragana(text: str) -> str:
    return text.translate(dict(zip(map(ord, KATAKANA), HIRAGANA)))
