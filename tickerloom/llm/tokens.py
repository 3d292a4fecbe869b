"""Token ids of whole texts with a public tokenizer file.

The tokenizer drops white space and never looks across it. Texts are taken a megabyte at a time
and cut into pre-tokens here. A store of bounded size numbers them and holds their ids, which are gathered
for the whole part at once; the merges of all new ones of one length are applied side by side. That holds for chunks of
Latin letters, digits and ASCII marks; any other chunk goes through the whole library pipeline.
"""

import json
import re
from itertools import chain

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Pre-tokens that are kept; beyond that all are forgotten before the next part.
CACHED_CHUNKS = 500_000
END_ID = 1
# Characters that are encoded together: their pre-tokens take a multiple of their bytes.
PART_CHARS = 1 << 20
# Longer pre-tokens go to the library one by one.
LONGEST_PIECE = 32

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# An apostrophe (contractions), '<' (special tokens), or a character beyond Latin letters.
_ODD = re.compile(rf"[^\s{_LETTERS}0-9!-&(-/:;=-@\[-`{{-~]")
_PIECES = re.compile(rf"[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
# Python splits at these, the tokenizer doesn't.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"\s")
_NO_RANK = np.int64(1 << 40)


class _Places(dict):
    """Numbers for pieces; `new` lists those that were met for the first time."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, piece):
        self[piece] = place = len(self)
        self.new.append(piece)
        return place


class Merges:
    """Byte-pair merges of many words of one length at once."""

    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.size = len(vocabulary)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged[order]
        # The symbol of each character inside a word and at its end.
        single = {ord(c): i for c, i in vocabulary.items() if len(c) == 1}
        self.inner, self.last = np.zeros((2, max(single) + 1), np.int64)
        for c, i in single.items():
            self.inner[c], self.last[c] = i, vocabulary.get(chr(c) + suffix, i)
        # Pairs of such symbols, which all words begin with, are looked up by their place.
        self.first = int(max(self.inner.max(), self.last.max())) + 1
        pair = np.arange(self.first)
        self.rank_of, self.place_of = self._find(pair[:, None], pair[None, :])

    def _find(self, left, right):
        """Rank of each pair and the place of its merge."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NO_RANK), at

    def encode(self, words):
        """Ids of words of one length, joined; how many each word has, and the order of the words."""
        letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
        ids = np.concatenate([self.inner[letters[:, :-1]], self.last[letters[:, -1:]]], axis=1)
        out, row = [], np.arange(len(words))
        ranks, found = (table[ids[:, :-1], ids[:, 1:]] for table in (self.rank_of, self.place_of))
        while len(row):
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            here = np.arange(len(row))
            more = ranks[here, best] < _NO_RANK if ranks.shape[1] else np.zeros(len(row), bool)
            out.append((row[~more], ids[~more]))
            row, ids, ranks, found, best = (x[more] for x in (row, ids, ranks, found, best))
            if not len(row):
                break
            here = np.arange(len(row))
            merged = self.merged[found[here, best]]
            # One symbol and one pair fewer; only the pairs beside the merged symbol are new.
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > best[:, None]), axis=1)
            ids[here, best] = merged
            columns = columns[:-1]
            source = columns + (columns >= best[:, None])
            ranks, found = (np.take_along_axis(x, source, axis=1) for x in (ranks, found))
            for side in (-1, 0):
                at = best + side
                rows = np.flatnonzero((at >= 0) & (at < ids.shape[1] - 1))
                at = at[rows]
                ranks[rows, at], found[rows, at] = self._find(ids[rows, at], ids[rows, at + 1])
        sizes = np.concatenate([np.full(len(r), i.shape[1]) for r, i in out])
        return np.concatenate([i.reshape(-1) for _, i in out]), sizes, np.concatenate([r for r, _ in out])


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
        self.as_bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        self.merges = Merges(self.tokenizer)
        self._forget()

    def _forget(self):
        """An empty store: the ids of piece k are `flat[starts[k]:starts[k] + sizes[k]]`."""
        self.places = _Places()
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, text):
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _one_piece(self, piece):
        return np.array([t.id for t in self.model.tokenize(piece)], np.uint32)

    def _pieces(self, text):
        """Pre-tokens of a text; chunks that can't be cut here stay whole, marked by a line end."""
        if not _ODD.search(text):
            return _PIECES.findall(text.lower())
        out, plain = [], []
        for chunk in text.split():
            if _ODD.search(chunk):
                out += _PIECES.findall(" ".join(plain).lower())
                out.append("\n" + chunk)
                plain = []
            else:
                plain.append(chunk)
        return out + _PIECES.findall(" ".join(plain).lower())

    def _learn(self):
        """Store the ids of the new pieces."""
        new, self.places.new = self.places.new, []
        found, by_length = [], {}
        for k, piece in enumerate(new):
            if piece[0] == "\n":
                found.append((self._whole(piece), [k]))
                continue
            shown = piece if piece.isascii() else piece.translate(self.as_bytes)
            if len(shown) > LONGEST_PIECE:
                found.append((self._one_piece(shown), [k]))
                continue
            if len(shown) not in by_length:
                by_length[len(shown)] = [], []
            places, words = by_length[len(shown)]
            places.append(k)
            words.append(shown)
        sizes = np.zeros(len(new), np.int64)
        starts = np.zeros(len(new), np.int64)
        flat, end = [self.flat], len(self.flat)
        for ids, places in found:
            flat.append(ids)
            sizes[places], starts[places] = len(ids), end
            end += len(ids)
        for places, words in by_length.values():
            ids, counts, order = self.merges.encode(words)
            flat.append(ids.astype(np.uint32))
            places = np.array(places)[order]
            sizes[places], starts[places] = counts, end + np.cumsum(counts) - counts
            end += len(ids)
        self.flat = np.concatenate(flat)
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def encode_all(self, texts):
        """The ids of each text, in order."""
        waiting, size = [], 0
        for text in texts:
            text = text or ""
            if len(text) > PART_CHARS and not _SEPARATORS.search(text):
                yield from self._joined(waiting)
                waiting, size = [], 0
                yield b"".join(ids for part in _parts(text) for ids in self._joined([self._pieces(part)]))
                continue
            waiting.append(self._whole(text) if _SEPARATORS.search(text) else self._pieces(text))
            size += len(text)
            if size >= PART_CHARS:
                yield from self._joined(waiting)
                waiting, size = [], 0
        yield from self._joined(waiting)

    def _joined(self, waiting):
        lists = [w for w in waiting if isinstance(w, list)]
        if len(self.places) >= CACHED_CHUNKS:
            self._forget()
        counts = np.array([len(w) for w in lists], np.int64)
        places = np.fromiter(map(self.places.__getitem__, chain.from_iterable(lists)), np.int64, int(counts.sum()))
        if self.places.new:
            self._learn()
        sizes = self.sizes[places]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[places] - ends[:-1], sizes) + np.arange(ends[-1])
        raw = self.flat[at].astype("<u4", copy=False).tobytes()
        edges = (4 * ends[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        k = 0
        for w in waiting:
            if isinstance(w, list):
                yield raw[edges[k] : edges[k + 1]]
                k += 1
            else:
                yield w.astype("<u4", copy=False).tobytes()

    def encode(self, text):
        return next(self.encode_all([text]))


def _parts(text):
    """A long text in parts that end at white space."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + PART_CHARS)
        to = space.start() if space else len(text)
        yield text[at:to]
        at = to


_ENCODERS = {}


def encoder(path):
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
