"""Byte-pair encoding by speculation and verification.

A word is first cut greedily into the longest vocabulary tokens. A sequence of
tokens is what the merges give exactly when every token is its own encoding and
every adjacent pair of tokens is the encoding of the two tokens' joined text, so
the guesses of a whole batch are verified with one vectorised look-up of all their
adjacent pairs. Only words with a failing pair go through the merges one by one.

Text handling (normal form, lower case, pre-tokens, byte alphabet, word-end mark,
special tokens) follows the vocabulary file ``word_bpe_49k.json``.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from simtrail.llm.common import extended_schema, slices

WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
# ASCII marks that often follow a word; any run of them is one pre-token of the pattern.
MARKS = ".,;:!?)\"]"
# Characters on which str.split() cuts although they are not white space for the vocabulary's pattern.
ODD_SPACE = regex.compile("[\x1c-\x1f]")
# Words remembered per Python worker: two generations of this many, the older one goes (a cache, never a cap on words).
MEMORY_WORDS = 250_000
NEVER = 1 << 60
# Letters by which the guess finds the longest token of at most that many letters, and whether longer ones may fit.
HEAD = 4
# Above every character of the byte alphabet.
LETTERS = 0x200


def byte_alphabet() -> list[str]:
    """One printable character for each byte value: the byte itself where printable, else from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0x100
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class Memory:
    """Two generations of remembered ids; what the younger one asks for moves to it."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> dict[str, bytes]:
        if len(self.now) > MEMORY_WORDS:
            self.old, self.now = self.now, {}
        return self.now

    def missing(self, keys: set[str]) -> set[str]:
        old = self.old
        if not old:
            return keys
        found = [key for key in keys if key in old]  # set operations with old.keys() would walk through all of it
        self.now.update((key, old[key]) for key in found)
        return keys.difference(found)


class Encoder:
    """Encodes and decodes with one vocabulary file (its JSON content)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.end: str = model.get("end_of_word_suffix") or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = (
            regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special
            else None
        )
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.tokens: list[str | None] = [None] * size
        for s, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = s
        self.size = size
        # pair of tokens (left * size + right) -> rank of its merge, rank -> token it gives
        vocab = self.vocab
        self.ranks = {vocab[a] * size + vocab[b]: i for i, (a, b) in enumerate(merges)}
        self.merged = [vocab[a + b] for a, b in merges]
        # the same as arrays, for many words at once: sorted pairs, their ranks, tokens by rank
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        self.rank_keys, self.key_ranks = keys[order], np.fromiter(self.ranks.values(), np.int64, keys.size)[order]
        self.merged_tokens = np.array(self.merged, np.int64)
        alphabet = byte_alphabet()
        self.letters = {b: c for b, c in enumerate(alphabet)}
        self.inner = {c: vocab[c] for c in alphabet if c in vocab}
        self.last = {c: vocab[c + self.end] for c in alphabet if c + self.end in vocab}
        self.inner_ids, self.last_ids = (
            np.array([found.get(chr(i), -1) for i in range(LETTERS)], np.int64) for found in (self.inner, self.last)
        )
        # tokens that are their own encoding; the longest of them that begins with these letters (or is that short)
        own = self._own_tokens()
        self.own = {self.tokens[t]: t for t in own}
        self.reach: dict[str, int] = {}
        for token in own:
            body = self.names[token][0]
            self.reach[body[:HEAD]] = max(self.reach.get(body[:HEAD], 0), len(body))
        self.heads: dict[str, tuple[int, int, int | None]] = {}
        self.pair_keys = np.empty(0, np.int64)
        self.pair_good = np.empty(0, bool)
        self.memory = Memory()  # of words and of runs without white space alike
        self.merged_words = 0

    # --- symbols and exact merging -------------------------------------------------

    def _letters_of(self, token: int) -> tuple[str, bool]:
        """A token's characters (one a byte), and whether it ends a word."""
        name = self.tokens[token]
        ends = bool(self.end) and name.endswith(self.end) and len(name) > len(self.end)
        return (name[: -len(self.end)] if ends else name), ends

    def merge(self, letters: str, ends: bool = True) -> list[int]:
        """The merges in order of rank, leftmost first: the definition of the encoding. Unknown letters are left out."""
        inner = self.inner
        if ends:
            parts = [inner[c] for c in letters[:-1] if c in inner]
            parts += [self.last[c] for c in letters[-1:] if c in self.last]
        else:
            parts = [inner[c] for c in letters if c in inner]
        rank, size, merged = self.ranks.get, self.size, self.merged
        ranks = [rank(a * size + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i = ranks.index(least)
            new = merged[least]
            parts[i : i + 2] = (new,)
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] * size + new, NEVER)
            if i < len(ranks):
                ranks[i] = rank(new * size + parts[i + 1], NEVER)
        return parts

    def _ranks_of(self, pairs: np.ndarray) -> np.ndarray:
        if not self.rank_keys.size:
            return np.full(pairs.size, NEVER)
        at = np.minimum(np.searchsorted(self.rank_keys, pairs), self.rank_keys.size - 1)
        return np.where(self.rank_keys[at] == pairs, self.key_ranks[at], NEVER)

    def merge_all(self, words: list[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`merge` of many words: all ids one after another, and where each word's begin (one entry more).

        The symbols of all words lie in one array; a round merges the best pair of every word that still has one.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        codes[codes >= LETTERS] = LETTERS - 1
        symbols = self.inner_ids[codes]
        tails = (np.cumsum(sizes) - 1)[ends & (sizes > 0)]
        symbols[tails] = self.last_ids[codes[tails]]
        known = symbols >= 0
        word = np.repeat(np.arange(len(words)), sizes)[known]
        symbols = symbols[known]
        sizes = np.bincount(word, minlength=len(words))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        out, lengths = np.empty(symbols.size, np.int64), np.zeros(len(words), np.int64)
        live = np.flatnonzero(sizes)  # words at work; their symbols are contiguous, in this order
        sizes = sizes[live]
        ranks = np.full(symbols.size, NEVER)
        if symbols.size > 1:
            ranks[:-1] = np.where(word[1:] == word[:-1], self._ranks_of(symbols[:-1] * self.size + symbols[1:]), NEVER)
        while live.size:
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks, starts)
            done = least == NEVER
            if done.any():
                ready = np.repeat(done, sizes)
                place = np.arange(symbols.size) - np.repeat(starts - begin[live], sizes)
                out[place[ready]] = symbols[ready]
                lengths[live[done]] = sizes[done]
                symbols, ranks = symbols[~ready], ranks[~ready]
                live, sizes, least = live[~done], sizes[~done], least[~done]
                if not live.size:
                    break
                starts = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(ranks == np.repeat(least, sizes))
            at = hits[np.searchsorted(hits, starts)]  # the leftmost of each word
            symbols[at] = self.merged_tokens[least]
            keep = np.ones(symbols.size, bool)
            keep[at + 1] = False
            symbols, ranks = symbols[keep], ranks[keep]
            at -= np.arange(at.size)
            starts -= np.arange(at.size)
            sizes = sizes - 1
            # the pair to the left, and the one to the right, of each new symbol
            left = at[at > starts]
            ranks[left - 1] = self._ranks_of(symbols[left - 1] * self.size + symbols[left])
            right = at[at < starts + sizes - 1]
            ranks[at] = NEVER
            ranks[right] = self._ranks_of(symbols[right] * self.size + symbols[right + 1])
        final = np.concatenate([[0], np.cumsum(lengths)])
        taken = np.arange(final[-1]) + np.repeat(begin[:-1] - final[:-1], lengths)
        return out[taken], final

    def _own_tokens(self) -> list[int]:
        tokens = sorted(set(self.vocab.values()))
        self.names = {t: self._letters_of(t) for t in tokens}
        ids, begin = self.merge_all([n for n, _ in self.names.values()], np.array([e for _, e in self.names.values()], bool))
        single = np.flatnonzero(np.diff(begin) == 1)
        return [t for t, i in zip(np.array(tokens)[single].tolist(), ids[begin[single]].tolist(), strict=True) if t == i]

    # --- speculation ----------------------------------------------------------------

    def guess(self, letters: str) -> list[int] | None:
        """Longest vocabulary token first, left to right; None where no token fits."""
        out, at, n, find, heads = [], 0, len(letters), self.own.get, self.heads.get
        while n - at > HEAD:
            head = letters[at : at + HEAD]
            bound, size, token = heads(head) or self._head(head)
            if bound > HEAD:
                if at + bound >= n:
                    whole = find(letters[at:] + self.end)
                    if whole is not None:
                        out.append(whole)
                        return out
                    bound = n - at - 1
                for longer in range(bound, HEAD, -1):
                    got = find(letters[at : at + longer])
                    if got is not None:
                        size, token = longer, got
                        break
            if token is None:
                return None
            out.append(token)
            at += size
        while at < n:
            token = find(letters[at:] + self.end)
            stop = n
            while token is None:
                stop -= 1
                if stop <= at:
                    return None
                token = find(letters[at:stop])
            out.append(token)
            at = stop
        return out

    def _head(self, head: str) -> tuple[int, int, int | None]:
        """Longest token that begins with ``head``, and length and id of the longest one that ``head`` begins with."""
        size = next((k for k in range(len(head), 0, -1) if head[:k] in self.own), 0)
        got = self.heads[head] = (self.reach.get(head, 0), size, self.own.get(head[:size]))
        if len(self.heads) > MEMORY_WORDS:
            self.heads.clear()
        return got

    # --- verification ---------------------------------------------------------------

    def _pairs_good(self, keys: np.ndarray) -> np.ndarray:
        """Whether each pair (left * size + right) is the encoding of its own joined text."""
        new = np.unique(keys)
        if self.pair_keys.size:
            at = np.minimum(np.searchsorted(self.pair_keys, new), self.pair_keys.size - 1)
            new = new[self.pair_keys[at] != new]
        if new.size:
            a, b = np.divmod(new, self.size)
            seconds = [self.names[t] for t in b.tolist()]
            joined = [self.names[t][0] + right for t, (right, _) in zip(a.tolist(), seconds, strict=True)]
            ids, begin = self.merge_all(joined, np.array([ends for _, ends in seconds]))
            good = np.diff(begin) == 2
            first = begin[:-1][good]
            good[good] = (ids[first] == a[good]) & (ids[first + 1] == b[good])
            all_keys = np.concatenate([self.pair_keys, new])
            order = np.argsort(all_keys, kind="stable")
            self.pair_keys, self.pair_good = all_keys[order], np.concatenate([self.pair_good, good])[order]
        return self.pair_good[np.searchsorted(self.pair_keys, keys)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of pre-tokens (already normalised): guess all, verify all pairs at once, merge the failing ones."""
        letters = [self._word_letters(w) for w in words]
        guesses = [self.guess(s) for s in letters]
        sizes = np.array([len(g) if g else 0 for g in guesses])
        flat = np.array([t for g in guesses if g for t in g], np.int64)
        failing = sizes == 0
        if flat.size > 1:
            owner = np.repeat(np.arange(len(words)), sizes)
            inner = owner[1:] == owner[:-1]
            left, right, where = flat[:-1][inner], flat[1:][inner], owner[1:][inner]
            if left.size:
                failing[where[~self._pairs_good(left * self.size + right)]] = True
        out = [b"" if bad else array("I", g).tobytes() for g, bad in zip(guesses, failing.tolist(), strict=True)]
        again = np.flatnonzero(failing).tolist()
        self.merged_words += len(again)
        ids, begin = self.merge_all([letters[i] for i in again], np.ones(len(again), bool))
        packed, cuts = ids.astype("<u4").tobytes(), (4 * begin).tolist()
        for i, start, stop in zip(again, cuts, cuts[1:], strict=False):
            out[i] = packed[start:stop]
        return out

    def _word_letters(self, word: str) -> str:
        if word.isascii() and word.isprintable():  # these stand for themselves in the byte alphabet
            return word
        return word.encode().decode("latin-1").translate(self.letters)

    # --- texts ------------------------------------------------------------------------

    def _chunks(self, part: str) -> list[str]:
        """Runs without white space of a text part, in normal form and lower case (character by character)."""
        if not part.isascii():
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
        part = part.lower()
        return WORD.findall(part) if ODD_SPACE.search(part) else part.split()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null text is an empty one."""
        known = self.memory.turn()
        plan: list[list[bytes | list[str]]] = []
        new: set[str] = set()
        for text in texts:
            parts: list[bytes | list[str]] = []
            pieces = [text or ""]
            if self.special_re is not None and any(s in pieces[0] for s in self.special):
                pieces = self.special_re.split(pieces[0])
            for piece in pieces:
                if piece in self.special:
                    parts.append(np.array([self.special[piece]], "<u4").tobytes())
                elif piece:
                    chunks = self._chunks(piece)
                    parts.append(chunks)
                    new.update(set(chunks).difference(known))
            plan.append(parts)
        new = self.memory.missing(new)
        if new:
            self._learn(list(new))
        get = known.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts) for parts in plan]

    def _learn(self, chunks: list[str]) -> None:
        known, parts = self.memory.now, {}
        words: set[str] = set()
        for chunk in chunks:
            if chunk.isascii():
                word = chunk.rstrip(MARKS)
                if word.isalpha():  # a word alone, or one and its marks, which are one pre-token
                    words.add(word)
                    if len(word) < len(chunk):
                        mark = chunk[len(word) :]
                        words.add(mark)
                        parts[chunk] = (word, mark)
                    continue
            parts[chunk] = WORD.findall(chunk)
            words.update(parts[chunk])
        distinct = list(self.memory.missing(words.difference(known)))
        known.update(zip(distinct, self.encode_words(distinct), strict=True))
        for chunk, ws in parts.items():
            if len(ws) == 2:
                known[chunk] = known[ws[0]] + known[ws[1]]
            elif len(ws) != 1 or ws[0] != chunk:
                known[chunk] = b"".join([known[w] for w in ws])

    def decode(self, ids: bytes | None) -> str:
        """The ids' tokens, joined by one blank (the vocabulary file names no decoder); unknown ids give nothing."""
        tokens, n = self.tokens, self.size
        got = [tokens[i] if i < n else None for i in np.frombuffer(ids or b"", "<u4").tolist()]
        return " ".join(t for t in got if t is not None)


_LOADED: dict[int, Encoder] = {}


def worker_encoder(content) -> Encoder:
    """The encoder of a broadcast vocabulary file, built once per Python worker."""
    key = hash(content.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(content.value)
    return _LOADED[key]


def broadcast_vocabulary(df: DataFrame, tokenizer_path: str):
    """The vocabulary file as a broadcast (its size is fixed by the file, about 1.7 MB here)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(
    df: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "token_ids", decoded_col: str | None = None
) -> DataFrame:
    """Add the token ids of ``text_col`` as packed little-endian uint32 (binary), ``n_tokens`` and, if named,
    the text decoded from those ids.

    Null and empty texts get no ids (empty binary, 0, ''). Whole texts of any length are encoded; repeated
    rows are encoded alike; columns of ``df`` of the same name as a new one are replaced, others kept.
    Special tokens written out in a text become their ids. A narrow step: no shuffle.
    """
    vocabulary = broadcast_vocabulary(df, tokenizer_path)
    extra: list[tuple[str, T.DataType]] = [(ids_col, T.BinaryType()), ("n_tokens", T.LongType())]
    if decoded_col:
        extra.append((decoded_col, T.StringType()))
    schema, arrow = extended_schema(df, extra)
    kept = [f.name for f in schema.fields[: -len(extra)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_encoder(vocabulary)
        for batch in slices(batches):
            ids = coder.encode(batch.column(text_col).to_pylist())
            cols = [batch.column(c) for c in kept]
            cols += [pa.array(ids, pa.binary()), pa.array([len(b) // 4 for b in ids], pa.int64())]
            if decoded_col:
                cols.append(pa.array([coder.decode(b) for b in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)
        coder.memory = Memory()  # the worker may go on with other work

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of packed ids (see :func:`encode`); null ids give ''."""
    vocabulary = broadcast_vocabulary(df, tokenizer_path)
    schema, arrow = extended_schema(df, [(text_col, T.StringType())])
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_encoder(vocabulary)
        for batch in slices(batches):
            texts = [coder.decode(b) for b in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(texts, pa.string())], schema=arrow)

    return df.mapInArrow(run, schema)
