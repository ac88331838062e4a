"""Token ids of whole texts by a public word-level BPE vocabulary, with a cache of pieces of words in each worker."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from partura.llm.words import chunks, word_hashes

CACHE_PIECES = 1_500_000  # about 30 bytes each

_cached: dict[str, "WordEncoder"] = {}
# Letters of ASCII and Latin-1; marks without an apostrophe.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_MARK_BYTES = b".,!?;:*#$%&|()\"-"
_MARKS = re.compile(rb"[" + re.escape(_MARK_BYTES) + rb"]+")

# What a byte is: 0 white space, 1 letter, 2 mark, 3 anything else.
_KINDS = np.full(256, 3, np.uint8)
_KINDS[[32, *range(9, 14)]] = 0
_KINDS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = 1
_KINDS[list(_MARK_BYTES)] = 2
_LATIN = np.zeros(256, bool)  # second bytes of letters of Latin-1
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True


def split_marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space between the letters and the marks of words that are letters and then marks."""
    if not len(data):
        return data, offsets
    kind = _KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[_LATIN[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = 1
    before = np.empty_like(kind)
    before[0], before[1:] = 0, kind[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = 0
    starts = (kind > 0) & (before == 0)
    word = np.cumsum(starts) - 1
    other = (kind == 3) | ((kind == 1) & (before == 2)) | ((kind == 2) & starts)
    plain = np.ones(int(word[-1]) + 2, bool)
    plain[word[other]] = False
    cuts = np.flatnonzero((kind == 2) & (before == 1))
    cuts = cuts[plain[word[cuts]]]
    return np.insert(data, cuts, 32), offsets + np.searchsorted(cuts, offsets)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable in Latin-1, else the next from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


_LETTER = _byte_letters()
_TO_LETTERS = dict(enumerate(_LETTER))


def encoder(path: str) -> "WordEncoder":
    """The worker's encoder for a vocabulary file."""
    if path not in _cached:
        _cached[path] = WordEncoder(path)
    return _cached[path]


class WordEncoder:
    """Encodes texts piece by piece.

    The vocabulary drops white space and never joins across it, so the ids of a text are those of its words in
    order. A word of Latin letters and a tail of marks without an apostrophe is cut once more between the two,
    as the vocabulary's own pattern does. Texts with special tokens, or with white space beyond ASCII, go whole.
    Pieces are known by a hash, in sorted arrays; those new in a run of texts are encoded in one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)  # for pieces that are letters of the vocabulary already
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._clear()

    def _clear(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 20, self.dtype), 0

    def _plain(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.dtype)

    def _pieces(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        known = [_LETTERS.fullmatch(part) or _MARKS.fullmatch(part) for part in parts]
        lower = [
            (part.lower().decode() if part.isascii() else self._shown(part)) if m else "" for m, part in zip(known, parts)
        ]
        simple = np.array([k for k, m in enumerate(known) if m], np.int64)
        found = self.bare.encode([lower[k] for k in simple.tolist()], is_pretokenized=True, add_special_tokens=False)
        lengths = np.zeros(len(parts), np.int64)
        lengths[simple] = np.bincount(np.array(found.word_ids, np.int64), minlength=len(simple))
        ids = np.array(found.ids, self.dtype)
        rest = [k for k, m in enumerate(known) if not m]
        if not rest:
            return ids, lengths
        whole = [self._plain(parts[k]) for k in rest]
        for k, own in zip(rest, whole):
            lengths[k] = len(own)
        out = np.empty(int(lengths.sum()), self.dtype)
        odd = np.zeros(len(parts), bool)
        odd[rest] = True
        places = np.repeat(odd, lengths)
        out[~places], out[places] = ids, np.concatenate(whole)
        return out, lengths

    @staticmethod
    def _shown(part: bytes) -> str:
        return part.decode().lower().encode().decode("latin-1").translate(_TO_LETTERS)

    def _learn(self, names: np.ndarray, parts: list[bytes]) -> None:
        ids, lengths = self._pieces(parts)
        total = len(ids)
        if self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool) + total, self.dtype)])
        self.pool[self.used : self.used + total] = ids
        starts = self.used + np.cumsum(lengths) - lengths
        self.used += total
        at = np.searchsorted(self.names, names)
        self.names = np.insert(self.names, at, names)
        self.starts, self.lengths = np.insert(self.starts, at, starts), np.insert(self.lengths, at, lengths)

    def _known(self, names: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.names, names)
        at[at == len(self.names)] = 0
        return self.names[at] == names if len(self.names) else np.zeros(len(names), bool)

    def encode(self, texts: pa.Array):
        """The ids of each text in turn, as numpy arrays; null is as empty."""
        for _, data, offsets in chunks(texts):
            yield from self._chunk(data, offsets)

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        n = len(offsets) - 1
        raw = data.tobytes()
        odd = (*self.specials, *_ODD_SPACE)
        whole = {}
        if any(s in raw for s in odd):
            for k in range(n):
                text = raw[offsets[k] : offsets[k + 1]]
                if any(s in text for s in odd):
                    whole[k] = text
        data, offsets = split_marks(data, offsets)
        h, rows, starts, ends = word_hashes(data, offsets)
        if not len(h):
            return [self._plain(whole[k]) if k in whole else np.zeros(0, self.dtype) for k in range(n)]
        names, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(names))
        if len(self.names) + len(new) > CACHE_PIECES:
            self._clear()
            new = np.arange(len(names))
        if len(new):
            raw = data.tobytes()
            some = first[new]
            self._learn(names[new], [raw[i:j] for i, j in zip(starts[some].tolist(), ends[some].tolist())])
        word = np.searchsorted(self.names, names)[inverse]
        lengths, begin = self.lengths[word], self.starts[word]
        total = np.cumsum(lengths)
        source = np.arange(total[-1]) + np.repeat(begin - (total - lengths), lengths)
        ids = self.pool[source]
        sizes = np.bincount(rows, weights=lengths, minlength=n).astype(np.int64)
        out = np.split(ids, np.cumsum(sizes)[:-1])
        for k, text in whole.items():
            out[k] = self._plain(text)
        return out


# White space beyond ASCII that the vocabulary's own pattern may treat in its own way, and characters whose lower case
# or composition depends on their neighbours.
_ODD_SPACE = tuple(
    chr(c).encode()
    for c in (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
