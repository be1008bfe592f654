"""Text to word pieces for a byte-pair vocabulary with word ends.

Reads the steps declared in a tokenizers JSON file: NFC, white space to one
space, lower case, a split by pattern, then bytes as letters. Special strings
of the file inside a text are pieces of their own, found before normalisation.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import regex

#: Unicode white space, which the library's \\s means.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class PieceSplitter:
    """Splits texts as the normaliser and pre-tokeniser of ``spec`` do."""

    def __init__(self, spec: str):
        self.spec = json.loads(spec)
        steps = [s["type"] for s in self.spec["normalizer"]["normalizers"]]
        split, byte_level = self.spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("not a vocabulary of lower-cased words split by pattern")
        if byte_level["add_prefix_space"] or byte_level["use_regex"]:
            raise ValueError("not a plain byte alphabet")
        self.pattern = split["pattern"]["Regex"]
        self.find = regex.compile(self.pattern.replace(r"[^\s", f"[^{WHITE}")).findall
        # the same pattern for texts below U+0100, its classes spelled out for the faster module
        low = [chr(c) for c in range(256)]
        letters, digits = ("".join(re.escape(c) for c in low if unicodedata.category(c)[0] == kind) for kind in "LN")
        simple = self.pattern.replace(r"\s", WHITE).replace(r"\p{L}", letters).replace(r"\p{N}", digits)
        self.find_simple = re.compile(simple).findall
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(names)})").split if names else lambda text: [text]
        self.differing = differing_marks()

    def pieces(self, text: str) -> list[str]:
        """Pieces in order; a special string is one piece, as written."""
        return self._sections(text, self.plain)

    def words(self, text: str) -> list[str]:
        """Special strings and runs between white space, as written; the pieces
        of the text are the pieces of these in order. Texts with separators that
        are white space in Python only come as pieces already."""
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        return self._sections(text, self.plain if odd else str.split)

    def _sections(self, text: str, split) -> list[str]:
        if not any(s in text for s in self.special):
            return split(text)
        out: list[str] = []
        for i, part in enumerate(self.cut(text)):
            out += [part] if i % 2 else split(part)
        return out

    def plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.find(text.lower())
        try:
            text.encode("latin-1")  # all its letters are known and composed
        except UnicodeEncodeError:
            letters = set(text)
            if not self.differing.isdisjoint(letters) or any(unicodedata.category(c) == "Cn" for c in letters):
                return self._by_library(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.find(text.lower())

    def _by_library(self, text: str) -> list[str]:
        """For code points that the tables here do not know, the library's own tables decide."""
        from tokenizers import Regex, normalizers, pre_tokenizers
        steps = [normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]
        split = pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        return [piece for piece, _ in split.pre_tokenize_str(normalizers.Sequence(steps).normalize_str(text))]


@lru_cache(maxsize=1)
def differing_marks() -> frozenset[str]:
    """Combining marks that the library's tables order otherwise than the tables
    here: before or after the mark U+0334, which goes before nearly all others."""
    from tokenizers import normalizers
    nfc, marks = normalizers.NFC(), [c for c in map(chr, range(0x300, 0x20000)) if unicodedata.combining(c)]
    return frozenset(c for c in marks if any(nfc.normalize_str(t) != unicodedata.normalize("NFC", t)
                                             for t in (f"b{c}\u0334", f"b\u0334{c}", f"b{c}\u0301\u0334", f"b\u0301{c}")))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else 256 and up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]
