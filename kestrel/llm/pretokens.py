"""Pre-tokens of byte-level BPE vocabularies, as the vocabulary's library cuts them.

Texts made of common Latin characters alone are split by the published pattern,
with its classes written out for those characters; every other text goes through the library's own normalizer and
pre-tokenizer, so results do not hang on which Unicode version a pattern engine
was built with. Merging pre-tokens into tokens is not done here.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

# Characters on which every Unicode version and engine agrees: ASCII (with tab,
# line feed, carriage return), Latin-1 letters and signs, Latin Extended-A,
# general punctuation without spaces and controls. None composes with another.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-¬®-ſ‐-‧‰-⁞]")
# Of those: white space, letters, numbers.
_CLASSES = {r"\s": "\t\n\r ", r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ſ", r"\p{N}": "0-9²³¹¼½¾"}


def _written_out(pattern: str) -> re.Pattern:
    """The pattern with its Unicode classes written out for the usual characters."""
    def bracket(m: re.Match) -> str:
        inner = m[2]
        for name, chars in _CLASSES.items():
            inner = inner.replace(name, chars)
        return f"[{m[1]}{inner}]"

    out = re.sub(r"\[(\^?)((?:\\s|\\p\{[LN]\})+)\]", bracket, pattern)
    for name, chars in _CLASSES.items():
        out = out.replace(name, f"[{chars}]")
    return re.compile(out.replace(r"\S", f"[^{_CLASSES[r'\s']}]"))


def byte_alphabet() -> list[str]:
    """Character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0x100
    for b in shown:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b] = chr(extra)
            extra += 1
    return out


class PreTokenizer:
    """Splits texts for one vocabulary file given as its JSON text.

    ``split(text)`` returns pre-tokens in order, as strings over the byte
    alphabet, and special tokens as their integer id."""

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        d = json.loads(spec)
        self.model = d["model"]
        self.library = Tokenizer.from_str(spec)
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") \
            if self.special else None
        pre = d["pre_tokenizer"]
        if pre["type"] == "ByteLevel" and pre["use_regex"]:
            self.pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        else:
            self.pattern = pre["pretokenizers"][0]["pattern"]["Regex"]
        self.find = _written_out(self.pattern).findall
        kinds = [n["type"] for n in (d["normalizer"] or {}).get("normalizers", [])]
        self.lower = "Lowercase" in kinds
        self.composed = "NFC" in kinds
        self.to_alphabet = str.maketrans({i: c for i, c in enumerate(byte_alphabet())})

    def _plain(self, text: str, put: Callable[[list], None]) -> None:
        if _UNUSUAL.search(text) is None:  # already composed: none of these characters composes with another
            put(self.find(text.lower() if self.lower else text))
            return
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        back = self.library.pre_tokenizer.pre_tokenize_str(text)
        put([_Mapped(t) for t, _ in back])

    def split(self, text: str) -> list:
        """Pre-tokens of ``text``: plain strings (see ``symbols``), strings already
        over the byte alphabet (``_Mapped``), or the integer id of a special token."""
        if not text:
            return []
        out: list = []
        if self.cut is not None and "<|" in text:
            for k, piece in enumerate(self.cut.split(text)):
                if k % 2:
                    out.append(self.special[piece])
                elif piece:
                    self._plain(piece, out.extend)
            return out
        self._plain(text, out.extend)
        return out

    def symbols(self, pretoken: str) -> str:
        """The pre-token over the byte alphabet."""
        if type(pretoken) is _Mapped:
            return str.__str__(pretoken)
        return pretoken.encode().decode("latin-1").translate(self.to_alphabet)


class _Mapped(str):
    """A pre-token that already is over the byte alphabet. It never equals a plain
    string, so both kinds can be keys of one table."""

    __slots__ = ()

    def __eq__(self, other: object) -> bool:
        return type(other) is _Mapped and str.__eq__(self, other)

    def __ne__(self, other: object) -> bool:
        return not self == other

    def __hash__(self) -> int:
        return ~str.__hash__(self)

    def __str__(self) -> str:
        return "".join(self)


_WORKER: dict = {}


def per_worker(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, once in each Python worker process."""
    if key not in _WORKER:
        _WORKER[key] = make()
    return _WORKER[key]
