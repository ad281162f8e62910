"""Exact token ids of texts through units that repeat: white-space pieces, encoded once and remembered.

A unit is a stretch of text whose ids don't depend on what stands around it. Both splits below cut only
where every pre-tokeniser in question cuts too, so a text's ids are its units' ids in a row. Texts with
characters on whose class Python and the tokenizers library may differ are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np

#: Units that a worker remembers in each of its two generations.
REMEMBERED = 200_000
#: The same for units of tokenizers; beyond them their words are remembered.
UNITS = 60_000
#: Words without the marks after them that a worker remembers.
STEMS = 400_000
#: Units that are sent to the library in one text.
JOINED = 256
#: White space for Python, not for Unicode: texts with them aren't cut.
ODD = re.compile("[\x1c-\x1f]")
SPACE_AND_WORD = re.compile(r"\s*\S+|\s+")

# ASCII marks but the apostrophe, which may belong to the letters after it; a public pre-tokeniser's pattern.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS_OR_DIGIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def library(spec: str):
    """The tokenizers library's object of a tokenizer file's text, without truncation, padding or threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def words(text: str) -> list[str]:
    """Units of tokenizers that drop white space."""
    return [text] if ODD.search(text) else text.split()


def spaced(text: str) -> list[str]:
    """Units of tokenizers that keep white space: each begins with the white space before it; a single line end is one by itself.

    The joined units are the text. Single blanks and line ends between words, the usual case, are cut by ``str.split``.
    """
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [text]
    if "\0" in text or " ".join(text.split()) != text.replace("\n", " "):
        return SPACE_AND_WORD.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0") if text else []


def encoded(tokenizer, units: list[str]) -> list[bytes]:
    """Ids of each unit as little-endian unsigned 32-bit integers.

    Units are joined by a special token's string, at which the library cuts before anything else, as few calls
    are cheaper than many. Units that hold such a string themselves go alone.
    """
    special = next((t for t in sorted(tokenizer.get_added_tokens_decoder().items())
                    if t[1].special and not (t[1].lstrip or t[1].rstrip or t[1].single_word or t[1].normalized)), None)
    out: list[bytes] = [b""] * len(units)
    plain = [i for i, unit in enumerate(units) if special and special[1].content not in unit and len(unit) < 4096]
    alone = sorted(set(range(len(units))) - set(plain))
    for i, found in zip(alone, tokenizer.encode_batch_fast([units[i] for i in alone], add_special_tokens=False)):
        out[i] = np.array(found.ids, "<u4").tobytes()
    if plain:
        number, mark = special[0], special[1].content
        groups = [plain[at : at + JOINED] for at in range(0, len(plain), JOINED)]
        joined = tokenizer.encode_batch_fast([mark.join(units[i] for i in g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, joined):
            ids = np.array(found.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == number), len(ids))
            if len(ends) != len(group):  # a unit made the mark's id by itself
                for i, one in zip(group, tokenizer.encode_batch_fast([units[i] for i in group], add_special_tokens=False)):
                    out[i] = np.array(one.ids, "<u4").tobytes()
                continue
            data, start = ids.tobytes(), 0
            for i, end in zip(group, ends.tolist()):
                out[i] = data[4 * start : 4 * end]
                start = end + 1
    return out


def byte_of_character() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 characters stand for their byte, the next free ones for the others."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids of units, as the library gives them.

    A unit of Latin letters and the marks after them is two pre-tokens under the byte-level pre-tokenisers that ``_shape``
    knows. The letters are handed to the library's BPE model as they are and remembered, the marks are remembered too;
    that leaves out normalisers and patterns, most of the work. All other units, and all units of
    tokenizers of another shape, are encoded by the whole library.
    """

    def __init__(self, spec: str, remembered: int = STEMS):
        self.tokenizer, self.remembered = library(spec), remembered
        self.model = self.tokenizer.model
        self.direct, self.lower, self.blank = self._shape(json.loads(spec))
        character = {b: c for c, b in byte_of_character().items()}
        self.alphabet = {i: "".join(character[b] for b in chr(i).encode()) for i in (32, *range(128, 256))}
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _shape(parts: dict) -> tuple[bool, bool, bool]:
        """Whether letters may go to the model directly, in lower case, and with a blank before them."""
        steps = lambda part, name: part.get(name, [part]) if part else []
        normal = steps(parts["normalizer"], "normalizers")
        before = steps(parts["pre_tokenizer"], "pretokenizers")
        known = parts["model"]["type"] == "BPE" and not parts["model"]["dropout"] and all(
            step["type"] in ("NFC", "Lowercase")
            or step["type"] == "Replace" and (step["pattern"], step["content"]) == ({"Regex": r"\s+"}, " ") for step in normal)
        # an added token inside letters and marks would be cut out first
        known &= all(re.search(r"[^\w\s][A-Za-z]", token["content"]) for token in parts["added_tokens"])
        known &= bool(before) and before[-1]["type"] == "ByteLevel" and not before[-1]["add_prefix_space"]
        if known and len(before) == 1 and before[0]["use_regex"]:
            return True, any(step["type"] == "Lowercase" for step in normal), True
        split = known and len(before) == 2 and not before[1]["use_regex"] and before[0]["type"] == "Split" and before[0]["invert"] and (
            before[0]["pattern"], before[0]["behavior"]) == ({"Regex": LETTERS_OR_DIGIT}, "Removed")
        return split, any(step["type"] == "Lowercase" for step in normal), False

    def _letters(self, word: str) -> bytes | None:
        """Ids of a pre-token of Latin letters, or None if it isn't one."""
        own = word[1:] if self.blank and word[:1] == " " else word
        if not own.isalpha() or not (own.isascii() or max(own) < "\u0100"):
            return None
        name = word.translate(self.alphabet) if own is not word or not own.isascii() else word
        ids = array("I", [token.id for token in self.model.tokenize(name)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def __call__(self, units: list[str]) -> list[bytes]:
        if not self.direct:
            return encoded(self.tokenizer, units)
        if len(self.known) > self.remembered:
            self.known.clear()
        known, letters, lower = self.known, self._letters, self.lower
        out: list[bytes] = []
        whole = []  # places of units for the whole library
        for unit in units:
            word = unit.rstrip(MARKS)
            tail = unit[len(word) :]
            if lower:
                word = word.lower()
            ids = known.get(word)
            if ids is None:
                ids = letters(word)
                if ids is None:
                    whole.append(len(out))
                    out.append(b"")
                    continue
                known[word] = ids
            if tail:
                more = known.get(tail)
                if more is None:
                    more = known[tail] = encoded(self.tokenizer, [tail])[0]
                ids += more
            out.append(ids)
        for i, ids in zip(whole, encoded(self.tokenizer, [units[i] for i in whole])):
            out[i] = ids
        return out


class Memo:
    """Values of units, remembered in two generations of bounded size; ``find`` gives those of unknown units."""

    def __init__(self, find, remembered: int = REMEMBERED):
        self.find, self.remembered = find, remembered
        self.young: dict = {}
        self.old: dict = {}

    def know(self, lists: list[list[str]]) -> dict:
        """A dictionary that has every unit of the lists."""
        if len(self.young) > self.remembered:
            self.old, self.young = self.young, {}
        young = self.young
        unknown = set().union(*lists).difference(young)
        if unknown:
            missing = []
            for unit in unknown:
                value = self.old.get(unit)
                if value is None:
                    missing.append(unit)
                else:
                    young[unit] = value
            young.update(zip(missing, self.find(missing)))
        return young
