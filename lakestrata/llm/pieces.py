"""Piecewise tokenizer calls with a bounded memo.

Both vocabularies of ``public_tokenizers`` cut a text, from left to right, into
pieces that are encoded independently of each other, and pieces repeat.  A
text is cut here into *units*, each of which ends where a piece surely ends:

* a run of Latin letters before an ASCII character (which then is no letter);
* a run of ASCII signs and digits without apostrophes before a Latin letter,
  white space or the end (signs and digits inside it are cut by the library);
* anything else up to the next white space that parts two words.

A worker encodes each distinct unit once with the tokenizers library and joins
the results.  Special strings of the vocabulary are cut out of a text first.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import compress, islice
from operator import not_

from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

# Unicode white space as the tokenizers' patterns read \s (fixed values)
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f"  # without the dotted capital I, whose lower case is two characters
SIGNS = "!-&(-@\\[-`{-~"
_led_units = re.compile(
    f" ?[{LETTERS}]++(?=[\\x00-\\x7f]|\\Z)| ?[{SIGNS}]++(?=[{LETTERS} \\n]|\\Z)|\\n(?=[^{SPACES}])"
    f"|[\\s\\S]+?(?=(?<=[^{SPACES}]) (?=[^{SPACES}])|\\Z)"
).findall
_free_units = re.compile(
    f"[{LETTERS}]++(?=[\\x00-\\x7f]|\\Z)|[{SIGNS}]++(?=[{LETTERS}{SPACES}]|\\Z)|[^{SPACES}]+"
).findall
_led_word = re.compile(f" ?[{LETTERS}]+").fullmatch
_ascii_word = re.compile("[A-Za-z]+").fullmatch
LONG = 256


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, without truncation or padding; special strings in a text count as special."""
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class Memo:
    """unit -> value of at most about twice ``limit`` recently used units; long ones are not kept."""

    def __init__(self, make: Callable[[list[str]], Iterable], limit: int = 200_000):
        self.make, self.limit = make, limit
        self.new: dict = {}
        self.old: dict = {}
        self.long: list[str] = []

    def of(self, units: Iterable[str]) -> dict:
        """A mapping that holds every given unit, valid until the next call."""
        new = self._next()
        self._add({p for p in units if p not in new})
        return new

    def values(self, units: list[str]) -> list:
        """The value of every given unit, in order; a unit that is kept is looked up once."""
        new = self._next()
        out = list(map(new.get, units))
        gaps = list(compress(range(len(out)), map(not_, out)))
        self._add({units[i] for i in gaps})
        for i in gaps:
            out[i] = new[units[i]]
        return out

    def rest(self, keep: int = 20_000) -> None:
        """Give up all but ``keep`` units, those that came first and so tend to be common ones.

        For the end of a task: an executor keeps more workers than it has
        cores and uses them in turn, so each would hold a full memo."""
        self._next()
        self.old, self.new = {}, dict(islice(self.new.items() if self.new else self.old.items(), keep))

    def _next(self) -> dict:
        for p in self.long:
            del self.new[p]
        self.long = []
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        return self.new

    def _add(self, units: set[str]) -> None:
        new, old, missing = self.new, self.old, []
        for p in units:
            v = old.get(p)
            if v is None:
                missing.append(p)
            else:
                new[p] = v
        if missing:
            new.update(zip(missing, self.make(missing), strict=True))
        self.long = [p for p in missing if len(p) > LONG]


@lru_cache(maxsize=8)
def _splitter(path: str, spaces_lead: bool) -> Callable[[str], list[str]]:
    units = _led_units if spaces_lead else _free_units
    special = sorted((t.content for t in tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True)
    if not special:
        return units
    pattern = re.compile(f"({'|'.join(map(re.escape, special))})")
    cut, found = pattern.split, pattern.search

    def split(text):
        if not found(text):
            return units(text)
        out = []
        for i, part in enumerate(cut(text)):  # every other part is a special string
            out += [part] if i % 2 else units(part)
        return out

    return split


def byte_level_split(path: str) -> Callable[[str], list[str]]:
    """Units that keep the space before them (byte-level vocabularies)."""
    return _splitter(path, True)


def space_free_split(path: str) -> Callable[[str], list[str]]:
    """Units between white space (vocabularies that drop it)."""
    return _splitter(path, False)


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else the next one from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b != 173]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _ids(x: Iterable[int]) -> bytes:
    return array("I", x).tobytes()


def _by_model(tok: Tokenizer, is_word, to_model: Callable[[str], str]) -> Callable[[list[str]], Iterable[bytes]]:
    """Words (one piece each) go straight to the vocabulary's model, other units through the library whole."""
    model = tok.model

    def make(units):
        other = [w for w in units if not is_word(w)]
        encoded = {w: e.ids for w, e in zip(other, tok.encode_batch_fast(other, add_special_tokens=False), strict=True)}
        for w in units:
            x = encoded.get(w)
            yield _ids(x) if x is not None else _ids([t.id for t in model.tokenize(to_model(w))])

    return make


@lru_cache(maxsize=4)
def byte_level_memo(path: str) -> Memo:
    """Unit of :func:`byte_level_split` -> its ids as little-endian unsigned 32-bit integers.

    One memo per Python worker, which its later tasks go on using."""
    tok, chars = tokenizer(path), _byte_chars()
    plain = isinstance(tok.model, models.BPE) and tok.normalizer is None and isinstance(tok.pre_tokenizer, pre_tokenizers.ByteLevel)
    is_word = _led_word if plain else (lambda w: None)
    return Memo(_by_model(tok, is_word, lambda w: w.encode().decode("latin-1").translate(chars)), 400_000)


@lru_cache(maxsize=4)
def space_free_memo(path: str, leaf: int, encode_long: Callable[[Tokenizer, str, int], list[int]]) -> Memo:
    """Unit of :func:`space_free_split` -> its ids; units longer than ``leaf`` go to ``encode_long``."""
    tok = tokenizer(path)
    # an ASCII word in lower case is one piece that normalisation and byte characters leave as it is
    plain = isinstance(tok.model, models.BPE) and isinstance(tok.normalizer, normalizers.Sequence) and tok.normalizer.normalize_str("Ab") == "ab"
    short = _by_model(tok, _ascii_word if plain else (lambda w: None), str.lower)

    def make(units):
        few = [w for w in units if len(w) <= leaf]
        ids = dict(zip(few, short(few), strict=True))
        for w in units:
            yield ids[w] if w in ids else _ids(encode_long(tok, w, leaf))

    return Memo(make, 100_000)
