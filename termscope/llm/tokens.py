"""Token ids of whole texts, by the public word-piece vocabulary, many words at a time."""

from __future__ import annotations

import unicodedata
from hashlib import blake2b

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from termscope.llm.arrays import SHORT, U64, mix

#: Code points below this compose with nothing and have one lower-case form each, but
#: for the one excepted; texts with others are encoded by the library as they are.
_PLAIN = 0x300
_EXCEPTED = 0x130
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)

_SLOT_BITS = 21
_SLOTS = 1 << _SLOT_BITS
_STORE = 1 << 22


def _classes() -> np.ndarray:
    found = np.full(_PLAIN, _OTHER, np.uint8)
    for c in range(_PLAIN):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            found[c] = _LETTER
        elif kind == "N":
            found[c] = _NUMBER
    found[[*range(9, 14), 0x20, 0x85, 0xA0]] = _SPACE
    return found


def _lowered() -> np.ndarray:
    return np.array([ord(chr(c).lower()[0]) for c in range(_PLAIN)], np.uint32)


class WordEncoder:
    """Encodes texts with a vocabulary that treats each word by itself.

    The vocabulary lowers letters, drops white space and merges within a word only: a
    run of letters, one number sign, or a run of other signs; a leading apostrophe with
    one of seven endings is a word too. So each distinct word is encoded once, by the
    library, and looked up after that in a table of fixed size, which forgets words
    that lose their slot. Texts outside the plain range go to the library whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.kinds = _classes()
        self.lower = _lowered()
        self.merger = Tokenizer.from_file(path)
        self.merger.normalizer = normalizers.Sequence([])
        self.merger.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        names = self.library.get_vocab()
        self.closes = np.zeros(max(names.values()) + 1, bool)
        self.closes[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.powers = np.ones(1, U64)
        self.inverse = np.ones(1, U64)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(_SLOTS, U64)
        self.at = np.zeros(_SLOTS, np.int64)
        self.size = np.zeros(_SLOTS, np.int32)
        self.store = np.zeros(_STORE, np.uint32)
        self.used = 0

    def _hash_powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) < n:
            base = 0xD1342543DE82EF95
            for name, b in (("powers", base), ("inverse", pow(base, -1, 1 << 64))):
                factors = np.full(2 * n, b, U64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=U64))
        return self.powers[:n], self.inverse[:n]

    def _plain(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each text can be split here."""
        odd = (codes >= _PLAIN) | (codes == _EXCEPTED)
        odd[:-1] |= (codes[:-1] == ord("<")) & (codes[1:] == ord("|"))
        total = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(odd, out=total[1:])
        return total[offsets[1:]] == total[offsets[:-1]]

    def _words(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts and ends of the words of plain texts, and these in lower case."""
        n = len(codes)
        kind = self.kinds[codes]
        codes = self.lower[codes]
        start = np.ones(n, bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        start[offsets[:-1][offsets[:-1] < n]] = True
        mark = np.flatnonzero((codes == ord("'")) & start)
        text_end = offsets[np.searchsorted(offsets, mark, "right")]
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
            hit = mark + len(ending) < text_end
            for k, sign in enumerate(ending):
                hit &= padded[mark + 1 + k] == ord(sign)
            at = mark[hit]
            start[at + 1] = False
            after = at + 1 + len(ending)
            after = after[after < n]
            start[after] = True
        starts = np.flatnonzero(start)
        end = np.append(starts[1:], n)
        word = kind[starts] != _SPACE
        return starts[word], end[word], codes

    def _encode_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words and how many each has, by the library.

        They are split and lowered already, so they are encoded as one text of words
        between blanks, by the vocabulary's merges alone.
        """
        found = self.merger.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        last = np.flatnonzero(self.closes[ids])
        return ids, np.diff(last, prepend=-1)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=offsets[1:])
        plain = self._plain(codes, offsets)
        out: list[np.ndarray | None] = [None] * len(texts)
        for i in np.flatnonzero(~plain):
            out[i] = np.array(
                self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32
            )
        keep = np.flatnonzero(plain)
        if len(keep) < len(texts):
            chosen = np.repeat(plain, np.diff(offsets))
            codes = codes[chosen]
            offsets = np.append(0, np.cumsum(np.diff(offsets)[plain]))
        ids, ends = self._encode_plain(codes, offsets)
        for k, i in enumerate(keep):
            out[i] = ids[ends[k] : ends[k + 1]]
        return out

    def _encode_plain(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, codes = self._words(codes, offsets)
        up, down = self._hash_powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, U64)
        np.cumsum((codes.astype(U64) + U64(1)) * up[:-1], out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)) | U64(1)
        for i in np.flatnonzero(ends - starts > SHORT):
            # The polynomial of different long words may be the same.
            word = blake2b(codes[starts[i] : ends[i]].tobytes(), digest_size=8)
            keys[i] = U64(int.from_bytes(word.digest(), "little")) | U64(1)
        slot = (keys >> U64(64 - _SLOT_BITS)).astype(np.int64)
        known = self.keys[slot] == keys
        begin, size = self.at[slot], self.size[slot].astype(np.int64)
        missing = np.flatnonzero(~known)
        if len(missing):
            new, first, inverse = np.unique(keys[missing], return_index=True, return_inverse=True)
            rows = missing[first]
            words = [
                codes[a:b].tobytes().decode("utf-32-le", "surrogatepass")
                for a, b in zip(starts[rows], ends[rows])
            ]
            ids, counts = self._encode_new(words)
            if self.used + len(ids) > len(self.store):
                # Start over, with room for the words of this batch.
                keep_store, keep_used = self.store, self.used
                self._forget()
                self.store = np.zeros(max(_STORE, 2 * (keep_used + len(ids))), np.uint32)
                self.store[:keep_used] = keep_store[:keep_used]
                self.used = keep_used
                fresh = True
            else:
                fresh = False
            at = self.used + np.cumsum(counts) - counts
            self.store[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            begin[missing], size[missing] = at[inverse], counts[inverse]
            place = (new >> U64(64 - _SLOT_BITS)).astype(np.int64)
            self.keys[place], self.at[place], self.size[place] = new, at, counts
        else:
            fresh = False
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        index = np.arange(total[-1]) + np.repeat(begin - total[:-1], size)
        tokens = self.store[index]
        text_ends = total[np.searchsorted(starts, offsets)]
        if fresh:
            self._forget()
        return tokens, text_ends
