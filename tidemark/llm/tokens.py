"""Token ids of whole texts by a public byte-level BPE vocabulary, with pieces remembered.

The vocabulary's pre-tokenizer never joins characters across a single space (or line feed) that stands between
non-space characters, nor a run of letters with the punctuation after it. So such texts are cut there, each distinct
piece is encoded by the tokenizers library once a task, and its ids are reused. Texts with any other white space are
encoded whole, and so are texts that hold an added token such as "<|endoftext|>", which the library turns into that
token's id. All ways give the ids of the plain call of the library.
"""

from __future__ import annotations

import struct
from functools import lru_cache
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces that a process remembers, and the longest of them.
REMEMBERED, LONGEST = 400_000, 64
#: Punctuation that is cut off a word; an apostrophe isn't, as it can start a suffix.
TAIL = ".,;:!?#$%&*|"
#: How byte-level vocabularies write a space, and words that are encoded together.
SPACE_MARK, TOGETHER = "\u0120", 64


def _ids(tokenizer: Tokenizer, text: str) -> bytes:
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


def _spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places at, at + 1, ..., at + n - 1 of each entry, one entry after another."""
    ends = np.cumsum(n)
    return np.repeat(at - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


class _Pool:
    """Ids of numbered entries, one after another in one array. Entry 0 has none."""

    def __init__(self):
        self.ids, self.at, self.n, self.entries, self.used = np.zeros(1 << 16, dtype="<u4"), np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64), 1, 0

    def add(self, ids: np.ndarray, n: np.ndarray) -> range:
        """The numbers of new entries of n ids each."""
        entries, used = self.entries + len(n), self.used + len(ids)
        if used > len(self.ids):
            self.ids = np.resize(self.ids, 2 * used)
        if entries > len(self.at):
            self.at, self.n = np.resize(self.at, 2 * entries), np.resize(self.n, 2 * entries)
        self.ids[self.used : used] = ids
        self.n[self.entries : entries] = n
        self.at[self.entries : entries] = self.used + np.cumsum(n) - n
        numbers, self.entries, self.used = range(self.entries, entries), entries, used
        return numbers

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these entries, joined."""
        return self.ids[_spread(self.at[numbers], self.n[numbers])]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers. Null counts as empty.

    A piece is what stands between spaces, or starts with a line feed; a text's first piece stands as after a line feed,
    whose ids are then taken off. Pieces that are remembered are numbers of the pool; 0 is one that makes its text irregular.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, int] = {}
        self.pool = _Pool()
        self.feed = len(_ids(self.tokenizer, "\n")) // 4
        self.starts = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.starts[i] = token.startswith(SPACE_MARK)

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        out, here, kept = [b""] * len(texts), [i for i, t in enumerate(texts) if t], (self.pool.entries, self.pool.used)
        if not here:
            return out
        split = pc.split_pattern(pc.replace_substring(pa.array(["\n" + texts[i] for i in here], pa.large_string()), "\n", " \n"), " ")
        # Each text's first item is the empty string before its line feed.
        first = np.asarray(split.offsets)
        flat = split.flatten().dictionary_encode()
        pieces = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        new = np.flatnonzero(numbers < 0).tolist()
        found = self._learn([pieces[i] for i in new if len(pieces[i]) <= LONGEST])
        if len(self.known) + len(found) <= REMEMBERED:
            self.known.update(found)
            kept = self.pool.entries, self.pool.used
        found |= self._learn([pieces[i] for i in new if len(pieces[i]) > LONGEST])
        numbers[new] = [found[pieces[i]] for i in new]
        each = numbers[np.asarray(flat.indices)]
        each[first[:-1]] = 0
        odd = np.add.reduceat(each == 0, first[:-1]) > 1
        ids = self.pool.of(each)
        ends = np.concatenate(([0], np.cumsum(self.pool.n[each])))[first].tolist()
        for i, a, b, plain in zip(here, ends, ends[1:], (~odd).tolist(), strict=False):
            text = texts[i]
            out[i] = ids[a + self.feed : b].tobytes() if plain and not any(t in text for t in self.added) else _ids(self.tokenizer, text)
        self.pool.entries, self.pool.used = kept
        return out

    def _learn(self, new: list[str]) -> dict[str, int]:
        """The entries of new pieces, and of words that they start with.

        In a text of words, a word's first token and no other starts with a space, which tells the words' ids apart.
        """
        found, words, alone, tailed = {}, {}, [], []
        for piece in new:
            if piece.isalpha():
                words[piece] = 0
                continue
            word = piece.rstrip(TAIL)
            if word.isalpha():
                tailed.append((piece, word, piece[len(word) :]))
                continue
            body = piece[1:] if piece[:1] == "\n" else piece
            if not body or body.split() != [body]:
                found[piece] = 0
                continue
            word = body.rstrip(TAIL)
            if word is not body and word.isalpha():
                start = piece[: len(piece) - len(body) + len(word)]
                tailed.append((piece, start, body[len(word) :]))
            else:
                alone.append(piece)
        # A tail's key can't be a piece: it starts with two line feeds.
        for _, word, tail in tailed:
            if word not in self.known:
                if word[:1] == "\n":
                    alone.append(word)
                else:
                    words[word] = 0
            if "\n\n" + tail not in self.known:
                alone.append("\n\n" + tail)
        words = list(words)
        groups = [" " + " ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        found.update(zip(words, self._added(groups, True), strict=True))
        alone = list(dict.fromkeys(alone))
        found.update(zip(alone, self._added([x[2:] if x[:2] == "\n\n" else x if x[:1] == "\n" else " " + x for x in alone], False), strict=True))
        if tailed:
            number = lambda x: found[x] if x in found else self.known[x]
            parts = np.array([(number(w), number("\n\n" + t)) for _, w, t in tailed])
            found.update(zip([p for p, *_ in tailed], self.pool.add(self.pool.of(parts.ravel()), self.pool.n[parts].sum(axis=1)), strict=True))
        return found

    def _added(self, texts: list[str], words: bool) -> range:
        """New entries of the pool: each text, or each word of the texts."""
        if not texts:
            return range(0)
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), dtype="<u4")
        ends = [*np.flatnonzero(self.starts[ids]).tolist(), len(ids)] if words else list(accumulate(map(len, found), initial=0))
        return self.pool.add(ids, np.diff(ends))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    return Encoder(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
