"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over the characters once. It keeps one best partial path per
position and only for positions that a piece may still start from, a window as
long as the longest piece; as soon as all paths that survive in the window go
back to one boundary, the ids before it are committed and forgotten.

Which path is best depends on the model. For a unigram model it is the one of
the highest sum of scores, the longest last piece on ties. A BPE model has no
sums: its encoding is the one segmentation that merging leaves, and a
segmentation is that one exactly if merging any two neighbours' joined text
gives these two back. So a path survives at a position if its last piece stands
beside the piece before it, and each position has one such path. Both give the
ids that the model's own library gives.

Boundaries that no piece of the vocabulary crosses (before a word's space mark,
around characters that it does not know) are points where all paths converge, so
the stretches between them are searched apart and short ones remembered. For a BPE model
the short stretches of a batch that are not remembered are searched side by side:
the same search, one character further at a time in all of them, on arrays.

Cases: a null or empty text has no ids; unknown characters become byte pieces,
or the unknown id where the model has none; a text of any length is encoded
whole; decoding gives the text back exactly, but for U+2581, which the format
itself uses for a space, and for unknown ids; a null list decodes to null; a null or
unknown id within a list, and control ids, decode to nothing. Only the model
formats without a character map are read; others are refused.
"""

from __future__ import annotations

import functools
import re
import struct
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import arrow_udf

from .common import holding

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 120_000
"""Short stretches that a worker remembers before it starts anew."""
NEIGHBOURS = 50_000
"""Pairs of pieces that the search of a long stretch remembers before it starts anew."""
PAIR_SLOTS = 1 << 20
"""Places for pairs of pieces that the search of short stretches remembers, in an array."""
SHORT = 48
TOGETHER = 1 << 17
"""Characters whose stretches are searched side by side."""
MULTIPLIER = 0x9E3779B97F4A7C15
DECODED = 1 << 16
"""Ids that are decoded at once."""
LISTS_TOGETHER = 50
TEXTS_TOGETHER = 250
"""Texts of a batch that are encoded and decoded before the next ones."""

# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
START, LONE = -1, -2
"""Stand for the start of a stretch and an unknown character among ids."""
UNKNOWN_SURFACE = " ⁇ "


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = message[at : at + size], at + size
        yield tag >> 3, value


class Vocabulary:
    """The pieces of a model file, and the search over them."""

    def __init__(self, model: bytes) -> None:
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.surface: list[bytes] = []
        self.unknown = 0
        self.kind, self.prefix, self.squeeze = UNIGRAM, True, True
        for number, value in fields(model):
            if number == 1:
                self._piece(dict(fields(value)))
            elif number == 2:
                self.kind = dict(fields(value)).get(3, UNIGRAM)
            elif number == 3:
                rules = dict(fields(value))
                if rules.get(2):
                    raise ValueError("models with a character map are not supported")
                self.prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        if self.kind not in (UNIGRAM, BPE) or self.squeeze:
            raise ValueError("only unigram and BPE models that keep all spaces are supported")
        self.least = min(self.scores.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        self.kept_as = "H" if len(self.surface) <= 1 << 16 else "I"
        self.neighbours: dict[tuple[int, int], bool] = {}
        self.text = {at: piece for piece, at in self.ids.items()} | {START: "", LONE: ""}
        self.size = {at: len(piece) for piece, at in self.ids.items()} | {LONE: 1}
        self.matches = ahocorasick.Automaton()
        for piece, at in self.ids.items():
            self.matches.add_word(piece, (len(piece), at))
        self.matches.make_automaton()
        self.single = {piece for piece in self.ids if len(piece) == 1}
        if self.kind == BPE and not set("".join(self.ids)) <= self.single:
            raise ValueError("a character of a BPE piece is no piece itself")
        self.stretches = self._stretches()
        self.cache: dict[str, bytes] = {}
        self.side_by_side = _SideBySide(self) if self.kind == BPE else None
        self.surfaces = np.frombuffer(b"".join(self.surface), np.uint8)
        self.surface_size = np.array([len(x) for x in self.surface], np.int64)
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size

    def _piece(self, piece: dict) -> None:
        at, text, kind = len(self.surface), piece[1].decode().replace(MARK, " "), piece.get(3, NORMAL)
        shown = text.encode()
        if kind in (NORMAL, USER_DEFINED):
            self.ids[text] = at
            self.scores[text] = struct.unpack("<f", piece.get(2, bytes(4)))[0]
        elif kind == BYTE:
            self.bytes[int(text[3:5], 16)] = at
            shown = bytes([int(text[3:5], 16)])
        elif kind == UNKNOWN:
            self.unknown, shown = at, UNKNOWN_SURFACE.encode()
        else:
            shown = b""
        self.surface.append(shown)

    def _stretches(self) -> re.Pattern:
        """Splits a text only at boundaries that no piece crosses."""
        pairs = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        alphabet = set("".join(self.ids))
        crossing = any(pair[1] == " " != pair[0] for pair in pairs)
        if crossing:
            return re.compile(r"[\s\S]+")
        plain = {c for c in map(chr, range(33, 127)) if not c.isalnum()}
        before = {c: {pair[0] for pair in pairs if pair[1] == c} - plain - {" "} for c in plain}
        escaped = lambda signs: "".join(map(re.escape, sorted(signs)))
        # A word ends before a sign, but for the signs that many letters join with
        # and for the few letters that others join with.
        tied = {c for c in plain if len(before[c]) > 20}
        joined = set().union(*(before[c] for c in plain - tied))
        lone = escaped({c for c in map(chr, range(128)) if c not in alphabet} - {" "})
        word = f" *[^ {escaped(plain | joined)}{lone}]++"
        if tied | joined:
            word += f"(?![{escaped(tied | joined)}])"
        return re.compile(f"{word}| *[^ {lone}]+| +|[{lone}]")

    def merged(self, text: str) -> list[str]:
        """The library's merging, on a text of two pieces at most."""
        parts, get, none = list(text), self.scores.get, -np.inf
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], none)
        return parts

    def beside(self, left: int, right: int) -> bool:
        """Whether merging keeps two pieces apart. Nothing merges with an unknown character."""
        if len(self.neighbours) > NEIGHBOURS:
            self.neighbours.clear()
        known = self.neighbours[left, right] = self.apart(left, right)
        return known

    def apart(self, left: int, right: int) -> bool:
        pieces = [p for p in (self.text[left], self.text[right]) if p]
        return self.merged("".join(pieces)) == pieces

    def search(self, text: str) -> list[int]:
        return self._merged_path(text) if self.kind == BPE else self._best_path(text)

    def _merged_path(self, text: str) -> list[int]:
        """The path whose neighbours all stand beside each other. ``last`` is the window from ``base`` on."""
        if len(text) <= 4 * self.longest and self.single.issuperset(text):
            return self._within_window(text)
        out: list[int] = []
        base, last, long = 0, [START], 4 * self.longest
        known = self.neighbours.get
        for end, (size, at) in self.matches.iter(text):
            stop = end + 1 - base
            while len(last) < stop:
                last.append(LONE)
            if len(last) == stop and size <= stop:
                before = last[stop - size]
                beside = known((before, at))
                if beside or beside is None and self.beside(before, at):
                    last.append(at)
                    if stop >= long and (cut := self._converged(last)):
                        out += self._path(last[: cut + 1], text, base)
                        last, base = last[cut:], base + cut
        last += [LONE] * (len(text) - base + 1 - len(last))
        return out + self._path(last, text, base)

    def _within_window(self, text: str) -> list[int]:
        """The same for a text of known characters that the window holds whole."""
        last: list[int | None] = [START] + [None] * len(text)
        known, size = self.neighbours.get, self.size
        for end, (length, at) in self.matches.iter(text):
            if last[end + 1] is None:
                before = last[end + 1 - length]
                beside = known((before, at))
                if beside or beside is None and self.beside(before, at):
                    last[end + 1] = at
        back, stop = [], len(text)
        while stop:
            back.append(last[stop])
            stop -= size[last[stop]]
        return back[::-1]

    def _best_path(self, text: str) -> list[int]:
        """The path of the highest sum of scores, with the longest last piece on ties."""
        out: list[int] = []
        base, last, score, long = 0, [START], [0.0], 4 * self.longest
        ends: dict[int, list[tuple[int, int]]] = {}
        for end, match in self.matches.iter(text):
            ends.setdefault(end, []).append(match)
        for end in range(len(text)):
            stop, best, best_score = end + 1 - base, LONE, -np.inf
            for size, at in ends.pop(end, ()):
                if size <= stop and (total := score[stop - size] + self.scores[self.text[at]]) > best_score:
                    best, best_score = at, total
            if text[end] not in self.ids and (total := score[stop - 1] + self.least) > best_score:
                best, best_score = LONE, total
            last.append(best)
            score.append(best_score)
            if stop >= long and (cut := self._converged(last)):
                out += self._path(last[: cut + 1], text, base)
                last, score, base = last[cut:], score[cut:], base + cut
        return out + self._path(last, text, base)

    def _converged(self, last: list[int]) -> int:
        """The last boundary on all paths that a later piece can continue."""
        ends = set(range(max(0, len(last) - self.longest), len(last)))
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(latest - self.size[last[latest]])
        return ends.pop()

    def _path(self, last: list[int], text: str, base: int) -> list[int]:
        """The ids that lead to the end of the window."""
        back, stop = [], len(last) - 1
        while stop > 0:
            at = last[stop]
            if at != LONE:
                back.append(at)
            elif self.bytes:
                back += [self.bytes[b] for b in reversed(text[base + stop - 1].encode())]
            elif not back or back[-1] != self.unknown:
                back.append(self.unknown)
            stop -= self.size[at]
        return back[::-1]

    def found(self, stretch: str) -> bytes:
        return array(self.kept_as, self.search(stretch)).tobytes()

    def known(self, stretches: set[str]) -> dict[str, bytes]:
        """A dictionary with the ids of all these stretches."""
        missing = stretches.difference(self.cache)
        if len(self.cache) + len(missing) > REMEMBERED:
            self.cache.clear()
            missing = stretches
        short = [x for x in missing if len(x) <= SHORT]
        for stretch in self.side_by_side.search(short, self.cache) if self.side_by_side else short:
            self.cache[stretch] = self.found(stretch)
        if len(short) == len(missing):
            return self.cache
        return self.cache | {x: self.found(x) for x in missing if len(x) > SHORT}

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text, as bytes of the array type ``kept_as``."""
        out: list[bytes] = []
        held: list[list[str]] = []
        size = 0

        def write() -> None:
            known = self.known(set().union(*held))
            out.extend(b"".join(map(known.__getitem__, parts)) for parts in held)

        for text in texts:
            marked = (" " if self.prefix else "") + text.replace(MARK, " ") if text else ""
            held.append(self.stretches.findall(marked))
            size += len(marked)
            if size > TOGETHER:
                write()
                held, size = [], 0
        write()
        return out

    def encode_lists(self, texts: pa.Array) -> pa.ListArray:
        """The ids of the texts of a batch."""
        lists = self.encode_all(texts.to_pylist())
        values = np.frombuffer(b"".join(lists), self.kept_as).astype(np.int32)
        offsets = np.cumsum([0, *map(len, lists)]) // np.dtype(self.kept_as).itemsize
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_all([text])[0], self.kept_as)

    def decode_all(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The texts of lists of ids, given as one array and the lists' sizes.

        Surfaces are gathered as bytes for all lists at once.
        """
        good = (ids >= 0) & (ids < len(self.surface))
        ids = np.where(good, ids, 0)
        own = np.where(good, self.surface_size[ids], 0)
        parts = []
        for start in range(0, len(ids), DECODED):
            size, first = own[start : start + DECODED], self.surface_start[ids[start : start + DECODED]]
            shift = first - (np.cumsum(size) - size)
            parts.append(self.surfaces[np.repeat(shift, size) + np.arange(size.sum())])
        data = np.concatenate([*parts, np.zeros(0, np.uint8)])
        ends = np.concatenate([[0], np.cumsum(own)])[np.cumsum(sizes)]
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        if self.prefix:
            spaced = np.flatnonzero((ends > starts) & (np.append(data, np.uint8(0))[starts] == 32))
            data = np.delete(data, starts[spaced])
            gone = np.zeros(len(ends), np.int64)
            gone[spaced] = 1
            ends = ends - np.cumsum(gone)
            starts = np.concatenate([[0], ends[:-1]])
        return self._texts(data, starts, ends)

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """The texts of a batch, some lists at a time: the arrays of a whole batch are many times its size."""
        parts = []
        for start in range(0, len(lists), LISTS_TOGETHER):
            some = lists.slice(start, LISTS_TOGETHER)
            sizes = some.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ids = some.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            parts.append(pc.if_else(some.is_valid(), self.decode_all(ids, sizes), pa.scalar(None, pa.string())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    @staticmethod
    def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        raw = data.tobytes()
        first = np.append(data, np.uint8(0))[starts[ends > starts]]
        whole = not ((first & 0xC0) == 0x80).any()
        try:
            raw.decode()
        except UnicodeDecodeError:
            whole = False
        if not whole:
            return pa.array([raw[a:b].decode("utf-8", errors="replace") for a, b in zip(starts, ends)], pa.string())
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        texts = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw))
        return texts.cast(pa.string())

    def decode(self, ids) -> str:
        known = [i for i in ids if i is not None]
        return self.decode_all(np.array(known, np.int64), np.array([len(known)]))[0].as_py()


class _SideBySide:
    """The search of many short stretches of known characters at once, for a BPE model."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        letters = sorted(set("".join(vocabulary.ids)))
        self.letter = np.full(0x110000, -1, np.int16 if len(letters) < 1 << 15 else np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters))
        self.width = len(letters)
        number = {c: i for i, c in enumerate(letters)}
        children: dict[int, int] = {}
        ends = [-1]
        for piece, at in vocabulary.ids.items():
            node = 0
            for c in piece:
                key = node * self.width + number[c]
                node = children.setdefault(key, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = at
        self.first = np.full(self.width, -1, np.int32)
        # The other steps of the trie in an open table with one step a place.
        bits = max(8, (4 * len(children)).bit_length())
        self.shift, self.places = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(self.places, -1, np.int64)
        self.child = np.full(self.places, -1, np.int32)
        for key, node in children.items():
            if key < self.width:
                self.first[key] = node
                continue
            place = (key * MULTIPLIER & (1 << 64) - 1) >> 64 - bits
            while self.keys[place] >= 0:
                place = (place + 1) % self.places
            self.keys[place], self.child[place] = key, node
        self.piece = np.array(ends, np.int32)
        self.start = len(vocabulary.surface)
        self.pieces = self.start + 1
        self.size = np.zeros(self.pieces, np.int64)
        for text, at in vocabulary.ids.items():
            self.size[at] = len(text)
        self.pairs = np.full(PAIR_SLOTS, -1, np.int32 if self.pieces < 1 << 15 else np.int64)

    def next(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The node that a letter leads to, or -1."""
        key = node * np.int64(self.width) + letter
        place = ((key.astype(np.uint64) * np.uint64(MULTIPLIER)) >> self.shift).astype(np.int64)
        held = self.keys[place]
        out = np.where(held == key, self.child[place], np.int32(-1))
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):
            place[open_] = (place[open_] + 1) % self.places
            held = self.keys[place[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.child[place[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out

    def beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging keeps two pieces apart, pair by pair."""
        key = left.astype(np.int64) * self.pieces + right
        slot = (((key.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(40)) % np.uint64(PAIR_SLOTS)).astype(np.int64)
        held = self.pairs[slot].astype(np.int64)
        known = held >> 1 == key
        if not known.all():
            new, place = np.unique(key[~known], return_inverse=True)
            ask = self.vocabulary.apart
            told = np.array([ask(START if k // self.pieces == self.start else k // self.pieces, k % self.pieces) for k in new.tolist()])
            held[~known] = 2 * new[place] + told[place]
            self.pairs[slot[~known]] = held[~known]
        return (held & 1).astype(bool)

    def search(self, stretches: list[str], found: dict[str, bytes]) -> list[str]:
        """Puts the ids of stretches into ``found``; returns those with characters that are no pieces."""
        if not stretches:
            return []
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        letters = self.letter[np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(sizes)), sizes)
        strange = np.zeros(len(sizes), bool)
        strange[word[letters < 0]] = True
        rest = [stretches[i] for i in np.flatnonzero(strange)]
        if strange.any():
            letters, word = letters[~strange[word]], word[~strange[word]]
        stop = np.cumsum(np.where(strange, 0, sizes))
        begin = stop - np.where(strange, 0, sizes)
        # Every place where a piece begins, and how far: (word, start, end, piece).
        longest = int(sizes.max())
        wide = longest + 1
        # The place of a letter's boundary in the table of paths, and of its stretch's end.
        cell = (np.arange(len(letters)) - begin[word] + word * wide).astype(np.int32)
        room = (stop[word] - np.arange(len(letters))).astype(np.int16)
        at = np.arange(len(letters), dtype=np.int32)
        matches, length = [], 0
        while len(at):
            node = self.next(node, letters[at + length]) if length else self.first[letters]
            length += 1
            live = node >= 0
            at, node = at[live], node[live]
            piece = self.piece[node]
            whole = piece >= 0
            start = cell[at[whole]]
            matches.append((start, start + np.int32(length), piece[whole]))
            more = room[at] > length
            at, node = at[more], node[more]
        start, end, piece = (np.concatenate(m) for m in zip(*matches)) if matches else (np.zeros(0, np.int32),) * 3
        last = np.full(len(sizes) * wide, -1, np.int32)
        last[::wide] = self.start
        order = np.argsort((end % wide).astype(np.int16), kind="stable")
        start, end, piece = start[order], end[order], piece[order]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(end % wide, minlength=wide))])
        for stop_at in range(1, wide):
            some = slice(cuts[stop_at], cuts[stop_at + 1])
            good = self.beside(last[start[some]], piece[some])
            last[end[some][good]] = piece[some][good]
        last = last.reshape(-1, wide)
        # Back from the ends: the pieces of every stretch, last ones first.
        left = np.where(strange, 0, sizes)
        row, back = np.flatnonzero(left), []
        count = np.zeros(len(sizes), np.int64)
        while len(row):
            piece = last[row, left[row]]
            back.append((row, count[row], piece))
            count[row] += 1
            left[row] -= self.size[piece]
            row = row[left[row] > 0]
        stop = np.cumsum(count)
        ids = np.zeros(int(stop[-1]), self.vocabulary.kept_as)
        for row, place, piece in back:
            ids[stop[row] - 1 - place] = piece
        raw, width = ids.tobytes(), ids.itemsize
        ends = (stop * width).tolist()
        for i, (a, b) in enumerate(zip([0, *ends], ends)):
            if not strange[i]:
                found[stretches[i]] = raw[a:b]
        return rest


@functools.lru_cache(maxsize=2)
def _read(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def vocabulary(model: bytes) -> Vocabulary:
    holding("pieces", _read.cache_clear)
    return _read(model)


def model_bytes(path: str = MODEL) -> bytes:
    """The model file, read by the driver; tasks get its bytes, which its size bounds."""
    with open(path, "rb") as file:
        model = file.read()
    vocabulary(model)
    return model


def encoded(text: Column, model: bytes) -> Column:
    """The ids of a text column."""

    @arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return vocabulary(model).encode_lists(texts)

    return encode(text)


def checked(text: Column, model: bytes) -> Column:
    """The ids of a text column, and whether they decode to the text, as a struct.

    One function for both: of two, one on the other's result, Spark would call the first one twice.
    """

    @arrow_udf("struct<ids: array<int>, round_trip: boolean>")
    def check(texts: pa.Array) -> pa.Array:
        words, ids, same = vocabulary(model), [], []
        for start in range(0, max(1, len(texts)), TEXTS_TOGETHER):
            some = texts.slice(start, TEXTS_TOGETHER)
            ids.append(words.encode_lists(some))
            same.append(pc.equal(words.decode_lists(ids[-1]), some.fill_null("")))
        return pa.StructArray.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(same)], ["ids", "round_trip"])

    return check(text)


def decoded(ids: Column, model: bytes) -> Column:
    """The text of a column of ids."""

    @arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        return vocabulary(model).decode_lists(lists)

    return decode(ids)
