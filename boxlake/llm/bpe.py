"""BPE encoding and decoding by batched numpy merge rounds.

Symbols of many words lie in one flat array. A round looks every adjacent pair up in the sorted pair keys by binary
search, takes the lowest rank of each word, and merges that pair wherever it stands in that word. Merged words leave the
next round's array when they have no pair left. A word is cut beforehand wherever no token of the vocabulary could cross,
so that a round takes one merge from each of many short pieces, however long the word is.

The vocabulary is one that lower-cases and drops white space, with word ends. Each result of merging must come from one
pair only (checked when the file is read): then a pair can't get a lower rank by a merge of the same round, and merging
all places of a pair at once gives what one merge at a time does.
"""

from __future__ import annotations

import json
import unicodedata
from hashlib import sha256

import numpy as np
import regex
from pyspark.sql import DataFrame

from boxlake.llm.common import map_text, vocabulary

#: The word pattern of the vocabulary file's pre-tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Most chunks a task remembers; then it starts anew, so that memory stays bounded.
CACHE = 300_000


def byte_letters() -> list[str]:
    """The printable letter for each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest follow from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for a word-end BPE vocabulary in the tokenizers library's JSON."""

    def __init__(self, data: bytes) -> None:
        spec = json.loads(data)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.base = max(self.tokens) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges]
        left, right, out = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        if len(np.unique(out)) != len(out):
            raise ValueError("a token of this vocabulary is made by two merges")
        keys = left * self.base + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), out[order]
        letters = byte_letters()
        self.of_byte = np.array([self.vocab[c] for c in letters], np.int64)
        self.of_last = np.array([self.vocab[c + self.end] for c in letters], np.int64)
        self.crossed = self._crossed([t for a, b in merges for t in (a + b,)], letters)
        self.words = regex.compile(WORDS)
        self.marks = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True))) if self.special else None

    def _crossed(self, tokens: list[str], letters: list[str]) -> np.ndarray:
        """(byte, next byte, whether the next ends the word): whether any merged token holds the two side by side."""
        byte, out = {c: b for b, c in enumerate(letters)}, np.zeros((256, 256, 2), bool)
        for token in tokens:
            last = token.endswith(self.end)
            own = [byte[c] for c in token.removesuffix(self.end)]
            for k, (a, b) in enumerate(zip(own, own[1:], strict=False)):
                out[a, b, int(last and k == len(own) - 2)] = True
        return out

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each non-empty word, given as UTF-8."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.of_byte[flat]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = self.of_last[flat[ends - 1]]
        # No merge crosses two bytes that no token holds side by side: words fall into pieces there.
        ends_word = np.zeros(len(flat), np.int64)
        ends_word[ends - 1] = 1
        apart = np.append(True, ~self.crossed[flat[:-1], flat[1:], ends_word[1:]] | (ends_word[:-1] == 1))
        owner = np.cumsum(apart) - 1
        word = np.repeat(np.arange(len(words)), sizes)[apart]
        done_owner, done_symbols = [], []
        none = np.int64(len(self.keys))
        while len(symbols):
            pair = symbols[:-1] * self.base + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & (owner[:-1] == owner[1:]), self.ranks[at], none)
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(owner)))
            live = np.repeat(lowest < none, counts)
            if not live.all():
                done_owner.append(owner[~live])
                done_symbols.append(symbols[~live])
            hit = (rank == np.repeat(lowest, counts)) & live
            made = np.append(self.made[at], 0)
            # In a row of places (a pair of equal symbols), every second one merges, from the left.
            spot = np.flatnonzero(hit)
            fresh = np.append(True, np.diff(spot) != 1) if len(spot) else np.zeros(0, bool)
            row_start = np.maximum.accumulate(np.where(fresh, np.arange(len(spot)), 0))
            spot = spot[(np.arange(len(spot)) - row_start) % 2 == 0]
            symbols = symbols.copy()
            symbols[spot] = made[spot]
            live[spot + 1] = False
            symbols, owner = symbols[live], owner[live]
        if not done_owner:
            return []
        owner, symbols = np.concatenate(done_owner), np.concatenate(done_symbols)
        order = np.argsort(owner, kind="stable")
        return np.split(symbols[order], np.cumsum(np.bincount(word[owner], minlength=len(words)))[:-1])

    def split(self, text: str) -> list[str | int]:
        """Chunks without white space in order, and ids of special tokens."""
        if self.marks is None or not self.marks.search(text):
            return self._chunks(text)
        out: list[str | int] = []
        at = 0
        for m in self.marks.finditer(text):
            out += [*self._chunks(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self._chunks(text[at:])

    def _chunks(self, text: str) -> list[str]:
        # str.split also splits at the four separators U+001C to U+001F, which the vocabulary's pattern doesn't.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return regex.findall(r"\S+", text)
        return text.split()

    def chunk_words(self, chunk: str) -> list[bytes]:
        """Normalised words of a chunk: NFC, letters lowered one by one, then the word pattern."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        return [w.encode() for w in self.words.findall(chunk.lower())]

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, joined by a space: what a file without a decoder asks for."""
        return " ".join([self.tokens[i] for i in ids])


class ChunkCoder:
    """Encodes texts by their chunks; what it remembers for each chunk is bounded by ``CACHE``."""

    def __init__(self, data: bytes) -> None:
        self.bpe = WordBpe(data)
        self._forget()

    def _forget(self) -> None:
        """Keep the special tokens only."""
        self.ids: dict[str | int, str] = {i: str(i) for i in self.bpe.special.values()}
        self.tokens: dict[str | int, str] = {i: self.bpe.decode([i]) for i in self.bpe.special.values()}

    def learn(self, chunks: set[str]) -> None:
        """Encode and decode chunks that aren't known yet, all at once."""
        words: dict[bytes, int] = {}
        todo = [(c, [words.setdefault(w, len(words)) for w in self.bpe.chunk_words(c)]) for c in chunks]
        coded = [x.tolist() for x in self.bpe.encode_words(list(words))] if words else []
        ids = [" ".join(map(str, x)) for x in coded]
        decoded = [self.bpe.decode(x) for x in coded]
        for c, own in todo:
            self.ids[c] = ids[own[0]] if len(own) == 1 else " ".join([ids[k] for k in own])
            self.tokens[c] = decoded[own[0]] if len(own) == 1 else " ".join([decoded[k] for k in own])

    def rows(self, texts: list[str | None]) -> list[tuple[str, str]]:
        """Decimal ids, and the decoded text, of each text; both joined by one space."""
        split = [self.bpe.split(t or "") for t in texts]
        new = set().union(*split).difference(self.ids)
        if len(self.ids) + len(new) > CACHE:
            self._forget()
            new = set().union(*split).difference(self.ids)
        self.learn(new)
        return [(" ".join(map(self.ids.__getitem__, s)), " ".join(map(self.tokens.__getitem__, s))) for s in split]


def encode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string): whole texts, encoded and decoded again.

    Null and empty texts give no ids and an empty decoded text. Repeated rows give repeated rows; other columns are not read.
    """
    data = vocabulary(vocab_path)

    def make():
        coder = ChunkCoder(data)

        def f(part):
            rows = coder.rows(part.column(1).to_pylist())
            return [part.column(0), [list(map(int, a.split())) for a, _ in rows], [b for _, b in rows]]

        return f

    return map_text(df, [id_col, text_col], make, f"{id_col} bigint, ids array<int>, decoded string")


def digests(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each whole text; cases as in ``encode``."""
    data = vocabulary(vocab_path)

    def make():
        coder = ChunkCoder(data)

        def f(part):
            rows = [(a.encode(), b.encode()) for a, b in coder.rows(part.column(1).to_pylist())]
            return [part.column(0), [a.count(b" ") + 1 if a else 0 for a, _ in rows], [sha256(a).hexdigest() for a, _ in rows], [sha256(b).hexdigest() for _, b in rows]]

        return f

    return map_text(df, [id_col, text_col], make, f"{id_col} bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
