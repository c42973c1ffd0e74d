"""Token ids of whole texts by the tokenizers library, with a bounded cache of words.

Both public vocabularies split a text at a single space before they look at anything
else, so the ids of a text are the ids of its space-separated parts in turn. A worker
keeps the ids of the first ``CACHE`` different parts it meets; the others are encoded
once per batch. Ids are little-endian unsigned 32-bit.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

CACHE = 1_200_000

# Letters that normalisation leaves as they are, but for their case; and marks that are pieces of their own after one.
_LETTERS = "".join(chr(c) for c in range(256) if chr(c).isalpha() and c not in (0xAA, 0xB5, 0xBA))
_MARKS = ".,;:!?"
_PLAIN = re.compile(rf"([{_LETTERS}]+)([{_MARKS}]?)\Z")
assert sys.byteorder == "little" and array("I").itemsize == 4

_loaded: dict[tuple[str, bool, bool], Encoder] = {}


class Encoder:
    """``bytes`` of ids for texts. ``spaced``: parts after the first are encoded with their space.

    ``ordinary``: strings of special tokens in a text are encoded as any other text, so their ids do not occur.
    """

    def __init__(self, path: str, spaced: bool, ordinary: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        model = self.tokenizer.model
        model._resize_cache(0)  # each word comes once, so the library's own cache only costs time
        self.tokenizer.model = model
        self.spaced = spaced
        self.known: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

        self.model = model
        # Letters as the vocabulary spells them; a plain word is one piece for the model, its mark another.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelt = {ord(c): split(c)[0][0] for c in _LETTERS}
        self.mark = {m: self._coded([m])[0] for m in ("", *_MARKS)}
        self.spelt_lead = split(" a")[0][0][:-1] if spaced else ""
        self.folds = self._coded(["A"]) == self._coded(["a"])

    def _coded(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(c.ids, "<u4").tobytes() for c in coded]

    def _ids(self, words: list[str], lead: bool) -> list[bytes]:
        """Ids of each word (or longer text), ``lead``: with a space before it.

        Words of plain letters go straight to the vocabulary's model; anything else
        takes the library's whole way.
        """
        known = self.known if lead or not self.spaced else self.first
        tokenize, spell, before = self.model.tokenize, self.spelt, self.spelt_lead if lead else ""
        out: list[bytes | None] = []
        for word in words:
            plain = _PLAIN.match(word)
            if not plain:
                out.append(None)
                continue
            core, mark = plain.groups()
            ids = known.get(core) if mark else None
            if ids is None:
                if self.folds:
                    core = core.lower()
                shown = before + (core if core.isascii() else core.translate(spell))
                ids = array("I", [t.id for t in tokenize(shown)]).tobytes()
            out.append(ids + self.mark[mark])
        rest = [i for i, ids in enumerate(out) if ids is None]
        gap = " " if lead else ""
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            for i, ids in zip(some, self._coded([gap + words[i] for i in some]), strict=True):
                out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") for t in texts]
        if self.spaced:  # several spaces in a row are not parts of their own here
            split = [[t] if "" in parts[1:] else parts for t, parts in zip(texts, split, strict=True)]
        known, first = self.known, self.first if self.spaced else self.known
        new_first = list({parts[0] for parts in split}.difference(first))
        first.update(zip(new_first, self._ids(new_first, lead=False), strict=True))
        # Each part is looked up once; only those that are not known yet are looked at again.
        coded, new, look = [], set(), known.get
        for parts in split:
            found = list(map(look, parts))
            found[0] = first[parts[0]]
            if None in found:
                new.update([part for part, ids in zip(parts, found, strict=True) if ids is None])
            coded.append(found)
        added = dict(zip(new, self._ids(list(new), lead=self.spaced), strict=True))
        out = []
        for parts, found in zip(split, coded, strict=True):
            if None in found:
                found = [added[part] if ids is None else ids for part, ids in zip(parts, found, strict=True)]
            out.append(b"".join(found))
        full = len(known) + len(first) + len(added) > CACHE
        if full:
            for word in new_first:
                first.pop(word, None)
        else:
            known.update((word, ids) for word, ids in added.items() if len(word) <= 64)
            for word in new_first:
                if len(word) > 64:
                    first.pop(word, None)
        return out


def encoder(path: str, spaced: bool, ordinary: bool = False) -> Encoder:
    key = (path, spaced, ordinary)
    if key not in _loaded:
        _loaded[key] = Encoder(*key)
    return _loaded[key]
