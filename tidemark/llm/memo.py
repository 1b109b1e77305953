"""Tokens of words that are met again and again, kept per worker.

The library encodes a text piece by piece: neither vocabulary merges across the places where
its own splitting pattern cuts. A text is cut at some of those places, and only pieces not
met before go to the library, many of them as one text. A vocabulary with another pattern is
not cut: the library then encodes whole texts.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm.decontamination import words_in

#: pieces kept per worker; beyond it those met once, and then the seldom ones, are forgotten
KEPT = 600_000
#: new pieces that go to the library as one text
JOINED = 4096
#: bytes of a piece that is worth keeping, or looking into
SHORT = 64

_SIGNS = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
#: what bytes count as, zero for those that part pieces: white space with A-Z lowered, or spaces alone
_LOWERED = np.array([0 if b in b" \t\n\x0b\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_UNSPACED = np.array([0 if b == 32 else b for b in range(256)], np.uint8)
_PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def open_tokenizer(vocabulary: str) -> Tokenizer:
    """A tokenizer from a name in ``public_tokenizers`` or the path of a file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(vocabulary if os.sep in vocabulary else public_tokenizers.path(vocabulary))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _rules(tokenizer: Tokenizer) -> str:
    """How a tokenizer normalises, splits and finishes, as text."""
    whole = json.loads(tokenizer.to_str())
    return json.dumps([whole["normalizer"], whole["pre_tokenizer"], whole["post_processor"], [t["content"][:2] for t in whole["added_tokens"]]])


def _sizes(encoding, pieces: list[str]) -> np.ndarray:
    """How many tokens each of some pieces has, that were encoded as one text with a character more for each.

    Pieces that are one word each for the library are told apart by its numbers of words, others by
    where their tokens start.
    """
    words = np.bincount(np.array([0 if w is None else w for w in encoding.word_ids], np.int64))
    if len(words) == len(pieces) and words.all() and all(p.isalpha() for p in pieces):
        return words
    starts = np.fromiter((o[0] for o in encoding.offsets), np.int64, len(encoding.ids))
    ends = np.cumsum([len(p) + 1 for p in pieces])
    return np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(pieces))


def _parted(word: bytes) -> tuple[bytes, bytes]:
    """A word and the run of punctuation behind it, where the pattern of either vocabulary cuts."""
    head = word.rstrip(_SIGNS)
    return (head, word[len(head) :]) if head and len(head) < len(word) and head[-1] in _PLAIN else (word, b"")


def _distinct(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray | None = None) -> tuple[list[bytes], np.ndarray]:
    """The different words of a batch (of at most some 10^6, told apart by 64 bits), and which of them each is.

    Those marked ``first`` get a zero byte in front.
    """
    _, one, place = np.unique(hashes, return_index=True, return_inverse=True)
    raw = low.tobytes()
    found = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
    if first is not None:
        for i in np.flatnonzero(first[one]).tolist():
            found[i] = b"\0" + found[i]
    return found, place


def _by_kind(texts: list[str]) -> tuple[list[int], list[int]]:
    """The places of words of letters, and of all others."""
    plain, rest = [], []
    for i, t in enumerate(texts):
        (plain if t.isalpha() else rest).append(i)
    return plain, rest


class Memo:
    """Numbers of pieces, and how often each was met."""

    def __init__(self, kept: int = KEPT):
        self.kept, self.number, self.times = kept, {}, np.zeros(0, np.int64)

    def numbers(self, pieces: list[bytes], times: np.ndarray, learn) -> np.ndarray:
        """The number of each of some different pieces; ``learn`` gives theirs to those not met before."""
        found = list(map(self.number.get, pieces))
        if None in found:
            learn([p for p, n in zip(pieces, found) if n is None])
            found = list(map(self.number.get, pieces))
        out = np.array(found, np.int64)
        self.times = np.pad(self.times, (0, len(self.number) - len(self.times)))
        self.times[out] += times
        return out

    def add(self, pieces: list[bytes]) -> None:
        """Number pieces on, in this order."""
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(pieces))))

    def forgotten(self) -> np.ndarray | None:
        """Make room if there is need; the former numbers of the pieces that stay."""
        if len(self.number) <= self.kept:
            return None
        pieces = list(self.number)
        least = max(2, int(np.partition(self.times, -self.kept // 2)[-self.kept // 2]) + 1)
        stay = np.flatnonzero((self.times >= least) & (np.fromiter(map(len, pieces), np.int64, len(pieces)) <= SHORT))
        self.number = {pieces[i]: k for k, i in enumerate(stay.tolist())}
        self.times = self.times[stay]
        return stay


class WordIds:
    """Ids as little-endian 32-bit bytes, for a vocabulary that drops white space and lower-cases.

    Its pattern takes no white space, so words can be encoded one by one; many new ones go to
    the library as one text, and the ids come back by the place in it where each starts.
    """

    def __init__(self, vocabulary: str, kept: int = KEPT):
        self.tokenizer, self.memo = open_tokenizer(vocabulary), Memo(kept)
        self.by_word = _rules(self.tokenizer) == _rules(open_tokenizer("word_bpe_49k.json"))
        self.ids, self.starts, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() for e in found]
        plain = [i for i, t in enumerate(texts) if "<|" not in t and "\0" not in t]
        raw = [texts[i].encode() for i in plain]
        bounds = np.concatenate(([0], np.cumsum(list(map(len, raw)), dtype=np.int64)))
        low, starts, ends, hashes = words_in(np.frombuffer(b"".join(raw), np.uint8), bounds, _LOWERED)
        distinct, place = _distinct(low, starts, ends, hashes)
        at = self.memo.numbers(distinct, np.bincount(place, minlength=len(distinct)), self._learn)[place]
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        flat = self.ids[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        cuts = np.concatenate(([0], ends))[np.searchsorted(starts, bounds)].tolist()
        stay = self.memo.forgotten()
        if stay is not None:
            sizes, starts = self.sizes[stay], self.starts[stay]
            self.starts = np.cumsum(sizes) - sizes
            self.ids = self.ids[np.repeat(starts - self.starts, sizes) + np.arange(int(sizes.sum()))]
            self.sizes = sizes
        out = dict(zip(plain, [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]))
        # what may hold a special string goes to the library as it is
        return [out[i] if i in out else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for i, t in enumerate(texts)]

    def _learn(self, words: list[bytes]) -> None:
        number = self.memo.number
        parted = [_parted(w) for w in words]
        alone = list({p for two in parted for p in two if p and p not in number})
        texts = [w.decode() for w in alone]
        ids, sizes, order = [self.ids], [self.sizes], []
        for kind in _by_kind(texts):
            for at in range(0, len(kind), JOINED):
                some = kind[at : at + JOINED]
                order += some
                words_ = [texts[i] for i in some]
                e = self.tokenizer.encode(" ".join(words_), add_special_tokens=False)
                ids.append(np.array(e.ids, "<u4"))
                sizes.append(_sizes(e, words_))
        self._store(ids, sizes)
        self.memo.add([alone[i] for i in order])
        composed = [(w, two) for w, two in zip(words, parted) if two[1]]
        if composed:
            pairs = np.array([(number[h], number[t]) for _, (h, t) in composed])
            flat = pairs.ravel()
            sizes = self.sizes[flat]
            ends = np.cumsum(sizes)
            taken = self.ids[np.repeat(self.starts[flat] - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
            self._store([self.ids, taken], [self.sizes, sizes.reshape(-1, 2).sum(axis=1)])
            self.memo.add([w for w, _ in composed])

    def _store(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes


class PieceCounts:
    """Numbers of tokens, for the byte-level vocabulary whose words take a space in front.

    Its pattern starts anew before a space that something visible follows, so where spaces stand
    alone a text is split at them and counts add up. Many new pieces go to the library as one text.
    """

    #: white space beyond ASCII, or control characters that only some libraries call white space
    _odd = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
    _uneven = ("  ", " \n", " \t", " \r", " \x0b", " \x0c")

    def __init__(self, tokenizer: Tokenizer, kept: int = KEPT):
        self.tokenizer, self.memo, self.counts = tokenizer, Memo(kept), np.zeros(0, np.int64)
        self.by_piece = _rules(tokenizer) == _rules(open_tokenizer("byte_bpe_50k.json"))

    def _even(self, text: str) -> bool:
        """Whether all spaces stand alone, with something visible behind each."""
        return not ("<|" in text or "\0" in text or text.endswith(" ") or any(x in text for x in self._uneven) or self._odd.search(text))

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_piece:
            return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        even = [i for i, t in enumerate(texts) if self._even(t)]
        raw = [texts[i].encode() for i in even]
        bounds = np.concatenate(([0], np.cumsum(list(map(len, raw)), dtype=np.int64)))
        low, starts, ends, hashes = words_in(np.frombuffer(b"".join(raw), np.uint8), bounds, _UNSPACED)
        first = np.isin(starts, bounds)  # these have no space in front
        hashes[first] ^= np.uint64(0x5BD1E995)
        distinct, place = _distinct(low, starts, ends, hashes, first)
        at = self.memo.numbers(distinct, np.bincount(place, minlength=len(distinct)), self._learn)[place]
        counts = np.concatenate(([0], np.cumsum(self.counts[at])))
        out = dict(zip(even, np.diff(counts[np.searchsorted(starts, bounds)]).tolist()))
        stay = self.memo.forgotten()
        if stay is not None:
            self.counts = self.counts[stay]
        return [out[i] if i in out else len(self.tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)]

    def _parts(self, piece: bytes) -> list[bytes]:
        """A piece at the line feeds that stand alone in it, and before punctuation at the end of a word."""
        spaced = piece[:1] != b"\0"
        raw = piece if spaced else piece[1:]
        if any(x in raw for x in (b"\t", b"\r", b"\x0b", b"\x0c", b"<|")) or len(raw) > SHORT or self._odd.search(raw.decode()):
            return [piece]
        lines = raw.split(b"\n")
        if not all(lines):
            return [piece]
        out = []
        for i, line in enumerate(lines):
            head, tail = _parted(line)
            out += [b"\0\n"] * (i > 0) + [head if spaced and not i else b"\0" + head] + [b"\0" + tail] * (tail != b"")
        return out

    def _learn(self, pieces: list[bytes]) -> None:
        number = self.memo.number
        split = [self._parts(p) for p in pieces]
        alone = list({x for xs in split for x in xs if x not in number})
        texts, counts, order = [x.decode() for x in alone], [self.counts], []
        spaced = [i for i, t in enumerate(texts) if t[:1] != "\0"]
        rest = [i for i, t in enumerate(texts) if t[:1] == "\0"]
        for kind in _by_kind([texts[i] for i in spaced]):
            for at in range(0, len(kind), JOINED):
                some = [spaced[i] for i in kind[at : at + JOINED]]
                order += some
                words = [texts[i] for i in some]
                counts.append(_sizes(self.tokenizer.encode(" " + " ".join(words), add_special_tokens=False), words))
        for at in range(0, len(rest), JOINED):
            some = rest[at : at + JOINED]
            order += some
            found = self.tokenizer.encode_batch([texts[i][1:] for i in some], add_special_tokens=False)
            counts.append(np.array([len(e.ids) for e in found], np.int64))
        self.counts = np.concatenate(counts)
        self.memo.add([alone[i] for i in order])
        composed = [(p, xs) for p, xs in zip(pieces, split) if p not in number]
        self.counts = np.concatenate((self.counts, np.array([sum([self.counts[number[x]] for x in xs]) for _, xs in composed], np.int64)))
        self.memo.add([p for p, _ in composed])
