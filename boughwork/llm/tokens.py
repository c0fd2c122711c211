"""Byte-level BPE encoding with the ``tokenizers`` library, one call for each new word.

Byte-level BPE never merges across its pre-token boundaries, and a boundary always lies
before a single space or a single newline between two other characters. Such texts are cut
there, many at a time, as Arrow arrays; each distinct piece is encoded once per worker and its
ids are copied to where the piece stands. A text with any other run of white space, or with
the string of an added token, is encoded whole. Both ways give the library's own ids.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Every character but space and newline that some engine counts as white space.
_OTHER_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
#: Texts that are not cut: white space of another kind, or not between two other characters;
#: or with the mark below.
_WHOLE = f"[\x01{_OTHER_SPACE}]|[ \n][ \n]|\\A[ \n]|[ \n]\\z"
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: What closes a word after a letter is a pre-token of its own; a mark before it, which no text
#: that is cut may hold, makes it a piece.
_MARK = "\x01"
_TAIL = f"([{_LATIN}])([.,!?;:%&$*#|]+)( |\\z)"
#: Words that share one encoding call; fixed, so that no call grows with the input.
_GROUP = 200
#: Bytes of the texts that are cut up at a time, so that their pieces stay few.
_CHUNK = 1 << 22


def _byte_letters() -> dict[int, str]:
    """By byte, the letter that stands for it in the vocabulary: printable bytes stand for
    themselves, the others take letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i]`` up to ``starts[i] + sizes[i]``, one range after the other."""
    at = np.repeat((starts - np.cumsum(sizes) + sizes).astype(np.int64), sizes)
    at += np.arange(len(at))
    return at


class _Pool:
    """Distinct pieces and their ids: those of piece ``i`` are ``ids[start[i] : start[i] + size[i]]``."""

    def __init__(self):
        self.pieces = pa.array([], pa.large_string())
        self.ids = np.zeros(0, "<u4")
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.pieces)

    def find(self, pieces: pa.Array) -> np.ndarray:
        """The place of each of some distinct pieces, -1 where it is new. They are fewer than
        the pool's, so those look themselves up among them."""
        place = np.full(len(pieces), -1, np.int64)
        found = pc.index_in(self.pieces, pieces)
        place[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        return place

    def add(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.start = np.r_[self.start, len(self.ids) + np.cumsum(sizes) - sizes]
        self.size = np.r_[self.size, sizes]
        self.ids = np.r_[self.ids, ids]

    def take(self, places: np.ndarray) -> np.ndarray:
        return self.ids[_spread(self.start[places], self.size[places])]

    def keep(self, places: np.ndarray) -> None:
        """Forget all but these."""
        self.ids, self.size, self.pieces = self.take(places), self.size[places], self.pieces.take(pa.array(places))
        self.start = np.cumsum(self.size) - self.size


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of ``(ids, sizes)`` for as many rows each, the rows' ids put together."""
    sizes = sum(n for _, n in parts)
    ids, at = np.zeros(int(sizes.sum()), "<u4"), np.cumsum(sizes) - sizes
    for own, n in parts:
        ids[_spread(at, n)] = own
        at = at + n
    return ids, sizes


class WordEncoder:
    """Ids of texts.

    ``max_words`` bounds the cache: past it, only what the texts at hand hold is kept. A lost
    word costs time only. With ``added_tokens`` the string of an added token in a text is that
    token, as the library has it by default; without, that of a special one is ordinary text.
    """

    def __init__(self, path: str, max_words: int = 800_000, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self._tokenizer.encode_special_tokens = True  # but for texts that hold one of those
        letters = _byte_letters()
        self._letters = {b: c for b, c in letters.items() if chr(b) != c}
        self._space, self._line = letters[0x20], letters[0x0A]
        self._latin = Tokenizer.from_file(path)  # for words in the vocabulary's letters, a line letter between them
        self._latin.pre_tokenizer = pre_tokenizers.Split(self._line, "isolated")
        self._newline = np.array(self._raw(["\n"])[0], "<u4")
        self._max = max_words
        self._spaced, self._bare = _Pool(), _Pool()  # after a space (or from a newline on), and with nothing before

    def _raw(self, texts: list[str], latin: bool = False) -> list[list[int]]:
        tokenizer = self._latin if latin else self._tokenizer
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _whole(self, text: str) -> np.ndarray:
        special = any(x in text for x in self._added)
        self._tokenizer.encode_special_tokens = not special
        ids = np.array(self._raw([text])[0], "<u4")
        self._tokenizer.encode_special_tokens = True
        return ids

    def _grouped(self, words: pa.Array, joint: str, latin: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word as it stands after a newline and ``joint``, and their numbers."""
        step = 50 * _GROUP
        if len(words) > step:  # the library holds some hundred bytes for each id of a call
            parts = [self._grouped(words.slice(i, step), joint, latin) for i in range(0, len(words), step)]
            return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])
        edges = [*range(0, len(words), _GROUP), len(words)]
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), words.cast(pa.string())), f"\n{joint}").to_pylist()
        groups = [joint + g for g in groups]
        if latin:
            space, line = self._space, self._line
            groups = [g.replace(" ", space).replace("\n", line) if g.isascii() else g.encode("utf-8").decode("latin-1").translate(self._letters) for g in groups]
        mark = self._newline[0] if len(self._newline) == 1 else 0xFFFFFFFF
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for a, b, found in zip(edges, edges[1:], self._raw(groups, latin)):
            array = np.array([*found, mark], "<u4")
            marked = array == mark
            ends = np.flatnonzero(marked)
            if len(ends) == b - a:
                ids.append(array[~marked])
                sizes.append(np.diff(ends, prepend=-1) - 1)
            else:
                each = self._raw([joint + w for w in words[a:b].to_pylist()])
                ids.append(np.array([x for one in each for x in one], "<u4"))
                sizes.append(np.array([*map(len, each)], np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def _add(self, pool: _Pool, words: pa.Array, joint: str) -> np.ndarray:
        """Encode words new to ``pool``, which stand after ``joint``; their places."""
        latin = pc.match_substring_regex(words, f"\\A[{_LATIN}]+\\z").to_numpy(zero_copy_only=False)
        plain = pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
        place = np.zeros(len(words), np.int64)
        for own in (latin & plain, latin & ~plain, ~latin):
            if own.any():
                place[own] = len(pool) + np.arange(own.sum())
                some = words.filter(pa.array(own))
                pool.add(some, *self._grouped(some, joint, bool(latin[own][0])))
        return place

    def _begin(self, words: pa.Array) -> np.ndarray:
        """The places of words with nothing before them."""
        coded = words.dictionary_encode()
        place = self._bare.find(coded.dictionary)
        new = np.flatnonzero(place < 0)
        place[new] = self._add(self._bare, coded.dictionary.take(pa.array(new)), "")
        return place[coded.indices.to_numpy()]

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """The places of distinct pieces that don't begin a text: words after a space, and
        what begins with a newline or the mark, whose rest has nothing before it."""
        pool = self._spaced
        place = pool.find(pieces)
        heads = [pc.starts_with(pieces, c).to_numpy(zero_copy_only=False) for c in ("\n", _MARK)]
        spaced = np.flatnonzero((place < 0) & ~heads[0] & ~heads[1])
        place[spaced] = self._add(pool, pieces.take(pa.array(spaced)), " ")
        for head, ids in zip(heads, (self._newline, self._newline[:0])):
            new = np.flatnonzero((place < 0) & head)
            if len(new):
                own = pieces.take(pa.array(new))
                words = self._begin(pc.utf8_slice_codeunits(own, 1))
                place[new] = len(pool) + np.arange(len(new))
                before = np.tile(ids, len(new)), np.full(len(new), len(ids))
                pool.add(own, *_joined([before, (self._bare.take(words), self._bare.size[words])]))
        return place

    def _cut(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts cut before each space, newline and mark (a piece keeps all but its space)."""
        if len(self._bare) > self._max // 2:
            self._bare = _Pool()
        texts = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " \n"), _TAIL, rf"\1 {_MARK}\2\3")
        lists = pc.split_pattern(texts, " ")
        edges = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        code, heads = coded.indices.to_numpy(), edges[:-1]
        first = self._begin(coded.dictionary.take(pa.array(code[heads])))
        inner = np.ones(len(code), bool)
        inner[heads] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[code[inner]] = True
        place = np.zeros(len(used), np.int64)
        places = place[used] = self._places(coded.dictionary.filter(pa.array(used)))
        at = place[code]
        sizes = self._spaced.size[at] if len(self._spaced) else np.zeros(len(code), np.int64)
        sizes[heads] = self._bare.size[first]
        ids = np.zeros(int(sizes.sum()), "<u4")
        at_first = np.repeat(~inner, sizes)
        ids[at_first] = self._bare.take(first)
        ids[~at_first] = self._spaced.take(at[inner])
        upto = np.r_[0, np.cumsum(sizes)][edges].tolist()
        if len(self._spaced) > self._max:
            self._spaced.keep(places)
        return [ids[a:b] for a, b in zip(upto, upto[1:])]

    def encode(self, texts: pa.Array | Sequence[str | None]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text; null and empty texts have none."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        out = [np.zeros(0, "<u4")] * len(texts)
        length = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        whole = pc.match_substring_regex(texts, _WHOLE)
        for token in self._added:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        whole = whole.to_numpy(zero_copy_only=False) & (length > 0)
        for i in np.flatnonzero(whole).tolist():
            out[i] = self._whole(texts[i].as_py())
        plain = np.flatnonzero(~whole & (length > 0))
        chunk = np.cumsum(length[plain]) // _CHUNK
        for own in np.split(plain, np.flatnonzero(np.diff(chunk)) + 1):
            if len(own):
                for i, ids in zip(own.tolist(), self._cut(texts.take(pa.array(own)))):
                    out[i] = ids
        return out


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a vocabulary file; Python workers are reused between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path, added_tokens=True)
    return _encoders[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
