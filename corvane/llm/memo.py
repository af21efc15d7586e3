"""Memoised byte-level BPE: texts are cut where the pre-tokenizer always cuts, and each distinct unit of a batch is
encoded once; the units' values are then gathered by their codes, so no Python runs for a single token."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space before a character that no regex engine calls white space always starts a pre-token.
CUT = re.compile(r" (?=\S)")
#: A space that is no such cut.
_NO_CUT = re.compile(r" (?!\S)")


class Memo:
    """Values of keys, the missing ones computed many at once; keeps the last two generations of at most `limit` entries."""

    def __init__(self, compute: Callable[[list], list], limit: int, longest: int = 200):
        self.compute, self.limit, self.longest = compute, limit, longest
        self.new: dict = {}
        self.old: dict = {}

    def of(self, keys: list) -> list:
        out = list(map(self.new.get, keys))
        lost = [k for k, v in enumerate(out) if v is None]
        wanted, back = [keys[k] for k in lost], {}
        if lost and self.old:
            found = list(map(self.old.get, wanted))
            for k, w, v in zip(lost, wanted, found, strict=True):
                if v is not None:
                    out[k] = back[w] = v
            if back:
                lost = [k for k, v in zip(lost, found, strict=True) if v is None]
                wanted = [w for w, v in zip(wanted, found, strict=True) if v is None]
        if lost:
            values = self.compute(wanted)
            for k, v in zip(lost, values, strict=True):
                out[k] = v
            # long keys hardly ever return
            back.update(zip(wanted, values, strict=True) if max(map(len, wanted)) <= self.longest else ((w, v) for w, v in zip(wanted, values, strict=True) if len(w) <= self.longest))
        if back:
            if len(self.new) + len(back) > self.limit:
                self.old, self.new = self.new, {}
            self.new.update(back)
        return out

    def forget(self) -> None:
        self.new, self.old = {}, {}


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself, or the next free letter from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


LETTERS = byte_letters()
_TO = {b: c for b, c in enumerate(LETTERS)}


def lettered(text: str) -> str:
    """UTF-8 bytes of the text, each as its letter."""
    if text.isascii():
        return text.replace(" ", LETTERS[32]) if text.isprintable() else text.translate(_TO)
    return text.encode("utf-8", "surrogatepass").decode("latin-1").translate(_TO)


def pre_tokens(unit: str, pattern: Callable[[str], list[str]]) -> list[str]:
    """The pattern's matches in a unit; words with or without a closing mark need no search."""
    body = unit[1:] if unit[0] == " " else unit
    if body.isalpha():
        return [unit]
    if body[-1:] in (".", ",") and body[:-1].isalpha():
        return [unit[:-1], unit[-1]]
    return pattern(unit)


def checked(pattern: str) -> Callable[[str], list[str]]:
    """findall of a pre-token pattern; ValueError if it doesn't cut where CUT and pre_tokens take it to."""
    import regex

    found = regex.compile(pattern).findall
    for text, want in (("ab cd", ["ab", " cd"]), ("ab, cd.", ["ab", ",", " cd", "."]), (" ab", [" ab"]), ("a \u00e9\u4e2d", ["a", " \u00e9\u4e2d"]), ("1 .x", ["1", " .", "x"]), ("a  b", ["a", " ", " b"])):
        if found(text) != want:
            raise ValueError(f"the pattern cuts {text!r} into {found(text)}")
    return found


class Units:
    """Values of a text's units, in order; compute gets units with their leading space and returns a list of values:
    bytes, or tuples of bytes."""

    def __init__(self, compute: Callable[[list[str]], list], limit: int):
        self.first = Memo(compute, limit)
        self.later = Memo(lambda units: compute([" " + unit for unit in units]), limit)

    def forget(self) -> None:
        self.first.forget()
        self.later.forget()

    def of(self, text: str) -> list:
        if not text:
            return []
        first, *rest = CUT.split(text) if _NO_CUT.search(text) else text.split(" ")
        return [*(self.first.of([first]) if first else []), *self.later.of(rest)]

    def joined(self, texts: pa.Array, separators: tuple[bytes, ...], whole: np.ndarray | None = None, encode: Callable[[str], object] | None = None) -> list[pa.Array]:
        """For each field of the values, every text's values joined by the field's separator. whole: texts for `encode`.

        With one separator a value is bytes, with more a tuple of so many.
        """
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        n, sizes = len(lists), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        ids, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        del lists, coded
        starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(n), sizes)
        first = np.zeros(len(ids), bool)
        first[starts] = True
        # a space before white space or at the end is no cut; such texts are cut one by one
        spaced = np.fromiter((not w or w[0].isspace() for w in names), bool, len(names))
        alone = np.bincount(owner, spaced[ids] & ~first, n) > 0
        if whole is not None:
            alone |= whole
        used = np.zeros(len(names), bool)
        used[ids[~first & ~alone[owner]]] = True
        single = len(separators) == 1
        empty = b"" if single else (b"",) * len(separators)
        entries = [empty] * len(names)
        some = np.flatnonzero(used).tolist()
        for k, value in zip(some, self.later.of([names[k] for k in some]), strict=True):
            entries[k] = value
        keep = ~alone[owner] | first
        leads = [names[k] for k in ids[starts].tolist()]
        plain = [k for k in range(n) if leads[k] and not alone[k]]
        heads = [empty] * n
        for k, value in zip(plain, self.first.of([leads[k] for k in plain]), strict=True):
            heads[k] = value
        for k in np.flatnonzero(alone).tolist():
            text = texts[k].as_py()
            if whole is not None and whole[k]:
                heads[k] = encode(text)
            elif single:
                heads[k] = separators[0].join(self.of(text))
            else:
                found = self.of(text)
                heads[k] = tuple(s.join([x[f] for x in found]) for f, s in enumerate(separators))
        keep[starts[[not leads[k] and not alone[k] for k in range(n)]]] = False
        entries += heads
        ids[starts] = len(names) + np.arange(n)
        at = pa.array(ids[keep])
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=n))]).astype(np.int32))
        return [pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(entries if single else [e[f] for e in entries], pa.binary()).take(at)), pa.scalar(s, pa.binary())) for f, s in enumerate(separators)]
