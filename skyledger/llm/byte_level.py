"""Reading a byte-level BPE vocabulary and splitting text into its pre-tokens."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

import regex

# The code points that Unicode calls white space, and the letters and numbers
# below U+02B0, which is all that FAST has to know.
SPACES = "\t-\r \x85\xa0  -     　"
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ʯ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"


def _pattern(letters: str, numbers: str, spaces: str) -> str:
    """Words, numbers and symbols take one space in front; the last space of a run is theirs."""
    symbols = f"[^{spaces}{letters}{numbers}]"
    return (f" ?[{letters}]+| ?[{numbers}]+|'(?:[stmd]|re|ve|ll)| ?{symbols}+"
            f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


FAST = re.compile(_pattern(LETTERS, NUMBERS, "\t-\r \x85\xa0"))
FULL = regex.compile(_pattern(r"\p{L}", r"\p{N}", SPACES))
BEYOND_FAST = re.compile("[^\x00-ʯ]")


def pre_tokens(text: str) -> list[str]:
    """The pieces that merges never cross; joined they give the text again."""
    known = text.isascii() or not BEYOND_FAST.search(text)
    return (FAST if known else FULL).findall(text)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file.

    Bytes with a visible Latin-1 character stand for themselves; the others, in order,
    take the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """Labels are the bytes of each id; merges come in order, as (left id, right id, id)."""

    labels: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        words = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, words))) if words else None

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at special strings: (plain text, None) and (special string, its id)."""
        if self._special is None or not self._special.search(text):
            return [(text, None)] if text else []
        found, end = [], 0
        for match in self._special.finditer(text):
            if match.start() > end:
                found.append((text[end:match.start()], None))
            found.append((match[0], self.special[match[0]]))
            end = match.end()
        if end < len(text):
            found.append((text[end:], None))
        return found


def load_vocabulary(source: str) -> Vocabulary:
    """The vocabulary in the JSON text of a byte-level BPE tokenizer.

    Settings that would change the ids and are not handled here raise an error.
    """
    spec = json.loads(source)
    model, splitter = spec["model"], spec["pre_tokenizer"]
    plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
    if (model["type"] != "BPE" or any(model.get(key) for key in plain)
            or model.get("byte_fallback") or model.get("ignore_merges") or spec.get("normalizer")
            or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"]
            or not splitter.get("use_regex", True)):
        raise ValueError("not a plain byte-level BPE tokenizer")
    to_byte, ids = byte_symbols(), model["vocab"]
    labels = {i: bytes(to_byte[c] for c in token) for token, i in ids.items()}
    merges = []
    for pair in model["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((ids[left], ids[right], ids[left + right]))
    special = {}
    for token in spec["added_tokens"]:
        if any(token[key] for key in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']!r} has settings not handled here")
        special[token["content"]] = token["id"]
        labels[token["id"]] = token["content"].encode()
    return Vocabulary(labels, merges, special)


def read_vocabulary_file(path: str) -> str:
    """The text of a vocabulary file, read by the driver; a vocabulary is a few MB at most."""
    with open(path, encoding="utf-8") as file:
        return file.read()
