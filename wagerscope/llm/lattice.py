"""Segmentation of distinct words by forward values over shared prefixes.

Distinct words in sorted order are a trie walked depth-first: each word keeps the
forward values of the prefix it shares with the word before, and only the rest is
computed.  For a unigram model the forward value of a prefix is the best score of
its segmentations (Viterbi).  For a byte-pair model it is the last piece of the
prefix's encoding: an encoding's beginning is the encoding of that beginning, and
a piece may follow another only if the two, merged on their own, stay as they are;
exactly one piece that ends a prefix passes that test.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the SentencePiece model format: field numbers and enum values.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: How far below the worst piece an unknown character scores in a unigram model.
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
#: Verdicts on pairs that a walk remembers, and the longest words that are walked in arrays.
REMEMBERED, LONGEST = 100_000, 48
_WORDS = re.compile(" *[^ ]+| +")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Lexicon:
    """Pieces, scores and settings of a SentencePiece model file."""

    def __init__(self, data: bytes):
        self.texts: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer, normalizer = {3: UNIGRAM}, {3: 1, 4: 1, 5: 1}
        for number, value in _fields(data):
            if number == PIECES:
                piece = {2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                self.texts.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0])
                self.kinds.append(piece[3])
            elif number == TRAINER:
                trainer.update(_fields(value))
            elif number == NORMALIZER:
                normalizer.update(_fields(value))
        self.kind = trainer[3]
        self.dummy_prefix = bool(normalizer[3])
        if self.kind not in (UNIGRAM, BPE) or normalizer.get(2) or normalizer[4] or not normalizer[5]:
            raise ValueError("only unigram and byte-pair models that leave the text as it is are supported")
        if any(k not in (NORMAL, UNKNOWN, 3, BYTE) for k in self.kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k == NORMAL}
        self.scores = {t: scores[i] for t, i in self.ids.items()}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = [i for i, k in enumerate(self.kinds) if k == BYTE]
        if self.bytes and len(self.bytes) != 256:
            raise ValueError("byte pieces are not complete")
        #: By last character, the lengths of pieces that end with it, longest first.
        lengths: dict[str, set[int]] = {}
        for t in self.ids:
            lengths.setdefault(t[-1], set()).add(len(t))
        self.lengths = {c: sorted(x, reverse=True) for c, x in lengths.items()}

    def fallback(self, char: str) -> list[int]:
        """Ids of a character that no piece covers."""
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ``ids``; control pieces have none."""
        return self.spelled(self.spellings[i] for i in ids)

    def spelled(self, parts: Iterable[bytes]) -> str:
        text = b"".join(parts).decode("utf-8", "replace")
        return text.removeprefix(" ") if self.dummy_prefix else text

    @property
    def spellings(self) -> list[bytes]:
        """The bytes that each id stands for."""
        out = []
        for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)):
            if k == BYTE:
                out.append(bytes([self.bytes.index(i)]))
            else:
                out.append(t.replace(SPACE, " ").encode() if k == NORMAL else b" \xe2\x81\x87 " if k == UNKNOWN else b"")
        return out


class Walk:
    """Forward values along sorted words; each prefix is computed once while it is on the path."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        worst = min(lexicon.scores.values(), default=0.0)
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.follows: dict[tuple[str, str], bool] = {}
        self.steps = 0

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether merging the characters of both together ends with exactly these two pieces."""
        key = (left, right)
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > REMEMBERED:
                self.follows.clear()
            known = self.follows[key] = self.merged_apart(left, right)
        return known

    def merged_apart(self, left: str, right: str) -> bool:
        scores, parts, border = self.lexicon.scores, [*left, *right], len(left)
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0 or at == border - 1:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            border -= at < border
        return border == 1 and parts[0] + parts[1] not in scores

    def _unigram(self, word: str, i: int, best: list, back: list) -> None:
        ids, scores = self.lexicon.ids, self.lexicon.scores
        top, start = None, -1
        for size in self.lexicon.lengths.get(word[i - 1], ()):
            if size <= i:
                piece = word[i - size : i]
                if piece in ids:
                    s = best[i - size] + scores[piece]
                    if top is None or s > top:
                        top, start = s, i - size
        if word[i - 1] not in ids:
            s = best[i - 1] + self.unknown_score
            if top is None or s > top:
                top, start = s, i - 1
        best.append(top)
        back.append(start)

    def _pair(self, word: str, i: int, last: list, back: list) -> None:
        ids = self.lexicon.ids
        for size in self.lexicon.lengths.get(word[i - 1], ()):
            if 1 < size <= i:
                piece, j = word[i - size : i], i - size
                if piece in ids and (j == 0 or self._stay_apart(last[j], piece)):
                    last.append(piece)
                    back.append(j)
                    return
        last.append(word[i - 1])
        back.append(i - 1)

    def over(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each word of the sorted ``words`` with the starts of its pieces by prefix length."""
        unigram = self.lexicon.kind == UNIGRAM
        step = self._unigram if unigram else self._pair
        value, back, before = [0.0 if unigram else ""], [0], ""
        for word in words:
            shared, limit = 0, min(len(word), len(before))
            while shared < limit and word[shared] == before[shared]:
                shared += 1
            del value[shared + 1 :], back[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                step(word, i, value, back)
            self.steps += len(word) - shared
            before = word
            yield word, back

    def ids(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each of the sorted words with its piece ids."""
        known, fallback = self.lexicon.ids, self.lexicon.fallback
        for word, back in self.over(words):
            out, i = [], len(word)
            while i:
                piece = word[back[i] : i]
                got = known.get(piece)
                if got is None:
                    out.extend(reversed(fallback(piece)))
                else:
                    out.append(got)
                i = back[i]
            out.reverse()
            yield word, out

    def counts(self, words: Iterable[str]) -> Iterator[tuple[str, int]]:
        """Each of the sorted words with its number of pieces, counted along the same prefixes."""
        known, fallback = self.lexicon.ids, self.lexicon.fallback
        total, before = [0], ""
        for word, back in self.over(words):
            shared, limit = 0, min(len(word), len(before))
            while shared < limit and word[shared] == before[shared]:
                shared += 1
            del total[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                piece = word[back[i] : i]
                total.append(total[back[i]] + (1 if piece in known else len(fallback(piece))))
            before = word
            yield word, total[-1]


def split(text: str, dummy_prefix: bool = True) -> list[str]:
    """The words of a text without their first space; no piece reaches across words.

    A word is a run of spaces and what follows up to the next space.
    """
    text = text.replace(SPACE, " ")
    if not text:
        return []
    if dummy_prefix and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    whole = f" {text}" if dummy_prefix else text
    return [w[1:] if w[0] == " " else f"\0{w}" for w in _WORDS.findall(whole)]


def marked(key: str) -> str:
    """The word that ``split`` shortened to ``key``, spaces as the model writes them."""
    return key[1:] if key.startswith("\0") and len(key) > 1 else SPACE + key.replace(" ", SPACE)


class PairTrie:
    """``Walk`` for many words of a byte-pair model at once: the trie level by level, in arrays.

    A node is a distinct prefix; it takes from its parent the beginnings of pieces
    that are still open, so each prefix is computed once.  Verdicts on whether two
    pieces stay apart are kept by their ids in a table of fixed size.  A character
    that no piece has is a piece of its own, numbered from ``foreign`` on.
    """

    SLOTS = 1 << 20
    CODES = 0x110000

    def __init__(self, lexicon: Lexicon, walk: Walk):
        self.lexicon, self.walk, self.foreign = lexicon, walk, len(lexicon.texts)
        rank = {c: i for i, c in enumerate(sorted(c for c in lexicon.ids if len(c) == 1))}
        self.n_chars = len(rank)
        #: By code point: the character's number, -1 for a foreign one, -2 for one that only longer pieces have.
        self.rank = np.full(self.CODES, -1, np.int32)
        self.rank[[ord(c) for t in lexicon.ids for c in t]] = -2
        self.rank[[ord(c) for c in rank]] = list(rank.values())
        # A state is a beginning of a piece; the last one is a foreign character's.
        states, moves, piece = {"": 0}, {}, [-1]
        for text, i in lexicon.ids.items():
            if all(c in rank for c in text):
                at = 0
                for n, c in enumerate(text, 1):
                    key = at * len(rank) + rank[c]
                    at = states.setdefault(text[:n], len(states))
                    moves[key] = at
                    if at == len(piece):
                        piece.append(-1)
                piece[at] = i
        self.keys = np.array(sorted(moves), np.int64)
        self.targets = np.array([moves[k] for k in self.keys.tolist()], np.int32)
        self.piece = np.array([*piece, -1], np.int32)
        self.pairs, self.apart = np.full(self.SLOTS, -1, np.int64), np.zeros(self.SLOTS, bool)

    def matrix(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points (-1 after the end), lengths, and which words the trie can take."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.array(words).view(np.int32).reshape(len(words), -1)
        after = np.arange(codes.shape[1]) >= size[:, None]
        taken = ((self.rank[codes] > -2) | after).all(axis=1)
        codes[after] = -1
        return codes, size, taken

    def _text(self, piece: int) -> str:
        return self.lexicon.texts[piece] if piece < self.foreign else chr(piece - self.foreign)

    def _width(self, pieces: np.ndarray) -> np.ndarray:
        """How many ids each piece is: one, or a foreign character's fallback."""
        if not self.lexicon.bytes:
            return np.ones(len(pieces), np.int64)
        code = pieces - self.foreign
        return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        n = self.foreign + self.CODES
        key = left * n + right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out = self.apart[slot]
        unknown = np.flatnonzero(self.pairs[slot] != key)
        if len(unknown):
            fresh, back = np.unique(key[unknown], return_inverse=True)
            merged, text = self.walk.merged_apart, self._text
            out[unknown] = np.array([merged(text(k // n), text(k % n)) for k in fresh.tolist()], bool)[back]
            at = slot[unknown]
            self.pairs[at] = key[unknown]
            stays = self.pairs[at] == key[unknown]  # of several keys for one slot, one stays
            self.apart[at[stays]] = out[unknown[stays]]
        return out

    def nodes(self, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each word's node, and by node its last piece, the node before that piece (-1: none) and its number of ids.

        Words are sorted and distinct.
        """
        n, total = len(size), 0
        shared = np.zeros(n, np.int64)  # characters in common with the word before
        if n > 1:
            same = (codes[1:] == codes[:-1]) & (codes[1:] >= 0)
            shared[1:] = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
        ends = np.zeros(n, np.int64)
        pieces, before, counts = ([np.zeros(0, np.int64)] for _ in range(3))
        # Of the level above: first word by node; number, last piece and number of ids by node; and its open
        # beginnings of pieces as (state, node before it, that node's last piece and number of ids).
        rows, known = np.zeros(1, np.int64), np.array([[-1, -1, 0]])
        opened, opened_at = np.zeros((0, 4), np.int64), np.zeros(2, np.int64)
        for level in range(1, int(size.max(initial=0)) + 1):
            children = np.flatnonzero((shared < level) & (size >= level))
            parent = np.searchsorted(rows, children, "right") - 1
            many = opened_at[parent + 1] - opened_at[parent] + 1
            node = np.repeat(np.arange(len(children)), many)
            own = np.zeros(len(node), bool)
            own[np.cumsum(many) - 1] = True
            entries = np.zeros((len(node), 4), np.int64)
            entries[own, 1:] = known[parent]
            entries[~own] = opened[spread(opened_at[parent], many - 1)]
            code = codes[children, level - 1].astype(np.int64)
            char = self.rank[code][node]
            key = np.where(char < 0, -1, entries[:, 0] * self.n_chars + char)
            spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            state = np.where(self.keys[spot] == key, self.targets[spot], -1)
            state[own & (char < 0)] = len(self.piece) - 1
            alive = np.flatnonzero(state >= 0)
            node, opened = node[alive], entries[alive]
            opened[:, 0] = state[alive]
            # Beginnings that are pieces, longest first; the character alone comes last and needs no verdict.
            piece = np.where(char[alive] < 0, self.foreign + code[node], self.piece[opened[:, 0]])
            whole = np.flatnonzero(piece >= 0)
            piece, prior = piece[whole], opened[whole, 2]
            chosen = np.searchsorted(node[whole], np.arange(len(children)))
            stop = np.append(chosen[1:], len(whole)) - 1
            todo = np.flatnonzero((chosen < stop) & (prior[chosen] >= 0))
            while len(todo):
                todo = todo[~self._stay_apart(prior[chosen[todo]], piece[chosen[todo]])]
                chosen[todo] += 1
                todo = todo[chosen[todo] < stop[todo]]
            picked = opened[whole[chosen]]
            pieces.append(piece[chosen])
            before.append(picked[:, 1])
            counts.append(picked[:, 3] + self._width(pieces[-1]))
            rows, known = children, np.stack([total + np.arange(len(children)), pieces[-1], counts[-1]], axis=1)
            over = size[children] == level
            ends[children[over]] = known[over, 0]
            total += len(children)
            opened_at = np.searchsorted(node, np.arange(len(children) + 1))
        return ends, np.concatenate(pieces), np.concatenate(before), np.concatenate(counts)

    def ids(self, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after another, and how many each word has."""
        ends, pieces, before, counts = self.nodes(codes, size)
        lengths = counts[ends]
        out = np.zeros(int(lengths.sum()), np.int32)
        at, place = ends, np.cumsum(lengths)
        fallback: dict[int, list[int]] = {}
        while len(at):
            piece = pieces[at]
            place = place - self._width(piece)
            out[place] = piece
            for i in np.flatnonzero(piece >= self.foreign).tolist():
                p = int(piece[i])
                got = fallback.get(p)
                if got is None:
                    got = fallback[p] = self.lexicon.fallback(self._text(p))
                out[place[i] : place[i] + len(got)] = got
            at = before[at]
            at, place = at[at >= 0], place[at >= 0]
        return out, lengths

    def counts(self, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many ids each word has."""
        ends, _, _, counts = self.nodes(codes, size)
        return counts[ends]


class Segmenter:
    """Piece ids of the distinct words of a slice of texts; no word is kept between slices."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.walk = lexicon, Walk(lexicon)
        self.trie = PairTrie(lexicon, self.walk) if lexicon.kind == BPE else None

    def cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Where each text's words begin and end, the distinct words, and each word's place among those."""
        dummy = self.lexicon.dummy_prefix
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        odd = pc.match_substring_regex(texts, "^ |  | $|^$").to_numpy(zero_copy_only=False) | (not dummy)
        plain, strange = np.flatnonzero(~odd), np.flatnonzero(odd)
        cut = pc.split_pattern(texts.take(pa.array(plain)), " ")
        if len(strange):
            other = [split(t, dummy) for t in texts.take(pa.array(strange)).to_pylist()]
            cut = pa.concat_arrays([cut, pa.array(other, cut.type)])
            cut = cut.take(pa.array(np.argsort(np.concatenate([plain, strange]))))
        words = cut.flatten().dictionary_encode()
        counts = cut.value_lengths().to_numpy().astype(np.int64)
        return np.concatenate([[0], np.cumsum(counts)]), words.dictionary, words.indices.to_numpy()

    def _sorted(self, keys: pa.Array) -> tuple[np.ndarray, tuple | None, list[int], list[str]]:
        """Which words the trie takes, in order, as its matrix; and which are walked, in order, and those marked words."""
        if pc.any(pc.starts_with(keys, "\0")).as_py():
            words = pa.array([marked(k) for k in keys.to_pylist()], pa.string())
        else:
            words = pc.binary_join_element_wise(SPACE, pc.replace_substring(keys, " ", SPACE), "")
        order = pc.sort_indices(words)  # by bytes: as by code points
        words, order = words.take(order).to_pylist(), order.to_numpy().astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero(size <= LONGEST) if self.trie else np.zeros(0, np.int64)
        if not len(short):
            return short, None, order.tolist(), words
        codes, size, taken = self.trie.matrix(words if len(short) == len(words) else [words[i] for i in short.tolist()])
        rest = np.ones(len(words), bool)
        rest[short[taken]] = False
        slow = np.flatnonzero(rest).tolist()
        return order[short[taken]], (codes[taken], size[taken]), order[slow].tolist(), [words[i] for i in slow]

    def word_counts(self, keys: pa.Array) -> np.ndarray:
        """The number of pieces of each key's word."""
        fast, matrix, slow, walked = self._sorted(keys)
        out = np.zeros(len(keys), np.int64)
        if matrix:
            out[fast] = self.trie.counts(*matrix)
        if slow:
            out[slow] = [n for _, n in self.walk.counts(walked)]
        return out

    def word_ids(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all keys' words, one word after another, and how many each has."""
        fast, matrix, slow, walked = self._sorted(keys)
        parts = []
        if matrix:
            parts.append((fast, *self.trie.ids(*matrix)))
        if slow:
            found = [np.array(i, np.int32) for _, i in self.walk.ids(walked)]
            parts.append((np.array(slow), np.concatenate(found), np.array([len(i) for i in found])))
        lengths = np.zeros(len(keys), np.int64)
        for at, _, n in parts:
            lengths[at] = n
        begins = np.cumsum(lengths) - lengths
        out = np.zeros(int(lengths.sum()), np.int32)
        for at, values, n in parts:
            out[spread(begins[at], n)] = values
        return out, lengths

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and where each text's begin."""
        at, keys, codes = self.cut(texts)
        ids, lengths = self.word_ids(keys)
        begins, each = (np.cumsum(lengths) - lengths)[codes], lengths[codes]
        return ids[spread(begins, each)], np.concatenate([[0], np.cumsum(each)])[at]

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each text's number of words and of pieces."""
        at, keys, codes = self.cut(texts)
        each = self.word_counts(keys)[codes]
        return np.diff(at), np.diff(np.concatenate([[0], np.cumsum(each)])[at])


def spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``begin, begin + 1, ...`` of each stretch, one stretch after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))
