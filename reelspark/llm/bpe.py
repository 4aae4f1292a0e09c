"""BPE encoding and decoding of whole texts with a backtracking encoder.

A token sequence is the BPE encoding of a word exactly if every adjacent pair
is *compatible*: merging the pair's own symbols gives back those two tokens.
So the encoder takes, at each place, the longest token that an Aho-Corasick
automaton finds there and that is compatible with the token before it, falls
back to shorter ones, and steps back where none fits. Dead ends are marked,
so each place is tried once per token length. Pair verdicts are kept in a
table. Decoding gathers bytes through an offset table.

The vocabulary file brings the merge list, the normaliser and the
pre-tokeniser; words are found per white-space chunk, as neither step looks
across white space, and bounded worker caches keep the ids of chunks and of
normalised words.

Defined results: a null or empty text has no ids and decodes to the empty
text; special strings in a text become their tokens, as the library does.
Repeated rows are encoded each; other columns pass through.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytebpe import load_tokenizer
from .common import TwoGenerations, worker_store

WORD_BPE = "word_bpe_49k.json"
STEP = 128               # rows that a worker encodes at once
CACHE_CHUNKS = 200_000   # of each of two generations
CACHE_WORDS = 150_000    # of each of two generations
CACHE_PAIRS = 250_000
_END = 0x100                 # offset of a word's last symbol
# Fixed value: the pre-tokeniser's pattern of word_bpe_49k.json.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_CONTROL = re.compile("[\x1c-\x1f]")
_SPACES_ONLY = re.compile("[^\\S\x1c-\x1f]+")
_DECODE_BLOCK = 1 << 18


def byte_chars() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = iter(range(0x100, 0x200))
    return {chr(b if b in plain else next(extra)): b for b in range(256)}


class Merges:
    """Tokens as symbol strings, with the merge that made each.

    A symbol is a byte's character, or that plus ``_END`` at a word's end.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        size = max(vocab.values()) + 1
        self.symbols = [""] * size
        self.parts: list = [None] * size
        self.rank = [-1] * size
        for char, byte in byte_chars().items():
            self.symbols[vocab[char]] = chr(byte)
            if suffix:
                self.symbols[vocab[char + suffix]] = chr(byte + _END)
        self.pair_rank = {}
        for rank, (a, b) in enumerate(merges):
            left, right = vocab[a], vocab[b]
            token = vocab[a + b]
            if self.parts[token] is not None or rank <= max(self.rank[left], self.rank[right]):
                raise ValueError(f"merge {rank} does not build on earlier merges")
            self.symbols[token] = self.symbols[left] + self.symbols[right]
            self.parts[token] = (left, right)
            self.rank[token] = rank
            self.pair_rank[left, right] = rank
        self.size = [len(s) for s in self.symbols]
        self.automaton = ahocorasick.Automaton()
        for token, s in enumerate(self.symbols):
            if s:
                self.automaton.add_word(s, (token, len(s)))
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at one edge of ``token`` while it is built, each
        with the rank of the merge that ends it."""
        out, until = [], len(self.pair_rank)
        while True:
            out.append((token, until))
            if self.parts[token] is None:
                return out
            until = self.rank[token]
            token = self.parts[token][side]

    def fits(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` stay as they are when merged together: no
        merge across their border comes before the merges inside them. Equal
        merges go from left to right."""
        known = self.compatible.get((a, b))
        if known is None:
            ranks = self.pair_rank
            right = self._edge(b, 0)
            known = not any(
                m is not None and m < until_x and m <= until_y
                for x, until_x in self._edge(a, 1) for y, until_y in right
                for m in (ranks.get((x, y)),))
            if len(self.compatible) >= CACHE_PAIRS:
                self.compatible.clear()
            self.compatible[a, b] = known
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word given as symbols."""
        greedy = [v[0] for _, v in self.automaton.iter_long(word)]
        if len(greedy) == 1 and self.size[greedy[0]] == len(word):
            return greedy
        fits = self.fits
        if all([fits(a, b) for a, b in zip(greedy, greedy[1:])]) and sum(map(self.size.__getitem__, greedy)) == len(word):
            return greedy
        return self.backtrack(word)

    def backtrack(self, word: str) -> list[int]:
        n = len(word)
        starts: list[list] = [[] for _ in range(n)]
        for end, (token, size) in self.automaton.iter(word):
            starts[end + 1 - size].append((size, token))
        for found in starts:
            found.sort()  # the longest last
        dead = bytearray(n + 1)
        path: list[int] = []
        left = [list(starts[0])]
        at = 0
        while at < n:
            options = left[-1]
            while options:
                size, token = options.pop()
                if not dead[at + size] and (not path or self.fits(path[-1], token)):
                    path.append(token)
                    at += size
                    left.append(list(starts[at]) if at < n else [])
                    break
            else:
                if not path:
                    raise ValueError("no encoding: a symbol is not in the vocabulary")
                dead[at] = 1
                left.pop()
                at -= self.size[path.pop()]
        return path


class BpeEncoder:
    """Encoder of one vocabulary file."""

    def __init__(self, name: str = WORD_BPE):
        import json
        tok = load_tokenizer(name)
        spec = json.loads(tok.to_str())
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = Merges(model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]], self.suffix)
        self.normalise = tok.normalizer.normalize_str
        self.pre_tokenise = tok.pre_tokenizer.pre_tokenize_str
        self.bytes_of = byte_chars()
        self.special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")")
        self.cache = TwoGenerations(CACHE_CHUNKS)
        self.words = TwoGenerations(CACHE_WORDS)

    def _words(self, chunk: str) -> list[str]:
        """Normalised words of a chunk; those of plain letters as they are,
        others as a space and the byte characters."""
        if chunk.isascii() or max(chunk) < "ɐ":
            low = (chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)).lower()
            return [low] if low.isalpha() else _WORDS.findall(low)
        return [" " + "".join(chr(self.bytes_of[c]) for c in w) for w, _ in self.pre_tokenise(self.normalise(chunk))]

    def _word_ids(self, word: str) -> bytes:
        """Ids of a word of ``_words``; a space before it, which no word holds,
        marks byte characters."""
        symbols = word[1:] if word[0] == " " else word.encode().decode("latin-1")
        ids = self.merges.encode(symbols[:-1] + chr(ord(symbols[-1]) + _END) if self.suffix else symbols)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk_ids(self, chunk: str) -> bytes:
        out = []
        for w in self._words(chunk):
            ids = self.words.get(w)
            if ids is None:
                ids = self._word_ids(w)
                if len(w) <= 64:
                    self.words.put(w, ids)
            out.append(ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            parts = self.cut.split(text)
            return b"".join(struct.pack("<I", self.special[p]) if k % 2 else self.encode_packed(p)
                            for k, p in enumerate(parts))
        chunks = text.split() if not _CONTROL.search(text) else [c for c in _SPACES_ONLY.split(text) if c]
        get = self.cache.get
        values = list(map(self.cache.young.get, chunks))
        at = -1
        for _ in range(values.count(None)):
            at = values.index(None, at + 1)
            chunk = chunks[at]
            ids = get(chunk)
            if ids is None:
                ids = self._chunk_ids(chunk)
                if len(chunk) <= 64:
                    self.cache.put(chunk, ids)
            values[at] = ids
        return b"".join(values)


class BpeDecoder:
    """Spellings of all ids in one byte string, with their offsets."""

    def __init__(self, name: str = WORD_BPE):
        tok = load_tokenizer(name)
        names = {i: s for s, i in tok.get_vocab(with_added_tokens=True).items()}
        spelled = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(spelled), np.uint8)

    def decode_packed(self, packed: bytes | None) -> bytes:
        """UTF-8 text of packed ids: token spellings joined by one space."""
        ids = np.frombuffer(packed or b"", "<u4")
        out = []
        for at in range(0, len(ids), _DECODE_BLOCK):
            some = ids[at:at + _DECODE_BLOCK]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            place = np.arange(ends[-1]) + np.repeat(self.offsets[some] - (ends - lengths), lengths)
            out.append(self.data[place].tobytes())
        return b"".join(out)[:-1]


def encoder(name: str = WORD_BPE) -> BpeEncoder:
    """The worker's encoder of a vocabulary file."""
    store = worker_store("encoders")
    if name not in store:
        store[name] = BpeEncoder(name)
    return store[name]


def decoder(name: str = WORD_BPE) -> BpeDecoder:
    """The worker's decoder of a vocabulary file."""
    store = worker_store("decoders")
    if name not in store:
        store[name] = BpeDecoder(name)
    return store[name]


def _with_columns(docs: DataFrame, source: str, new: str, make) -> DataFrame:
    """``docs`` without ``source`` and with the columns ``new`` (DDL) that
    ``make()(values)`` returns as arrays, ``STEP`` rows at a time: a worker
    holds one step's texts and ids whatever the batch. Columns of the added
    names are replaced."""
    added = T.StructType.fromDDL(new)
    others = [f for f in docs.schema.fields if f.name != source and f.name not in added.names]
    names = [f.name for f in others] + added.names
    rows = docs.select(F.col(source), *[F.col(f.name) for f in others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                part = b.slice(at, STEP)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *fn(part.column(0).to_pylist())], names)

    return rows.mapInArrow(run, T.StructType([*others, *added.fields]))


def _utf8(spelled: list[bytes]) -> pa.Array:
    return pa.array(spelled, pa.binary()).cast(pa.string())


def encode(docs: DataFrame, text: str = "text", tokenizer: str = WORD_BPE) -> DataFrame:
    """``docs`` with ``ids_packed``, the packed ids of every whole text, in place of the text."""
    def make():
        e = encoder(tokenizer)
        return lambda texts: [pa.array([e.encode_packed(t) for t in texts], pa.binary())]

    return _with_columns(docs, text, "ids_packed binary", make)


def decode(tokens: DataFrame, packed: str = "ids_packed", tokenizer: str = WORD_BPE) -> DataFrame:
    """``tokens`` with ``decoded``, the text of its packed ids, in place of them."""
    def make():
        d = decoder(tokenizer)
        return lambda ids: [_utf8([d.decode_packed(p) for p in ids])]

    return _with_columns(tokens, packed, "decoded string", make)


def round_trip(docs: DataFrame, text: str = "text", tokenizer: str = WORD_BPE, lists: bool = False) -> DataFrame:
    """``docs`` with ``ids_packed`` (or ``ids``, an array, if ``lists``) and
    ``decoded`` in place of the text: encoded, and the ids decoded again, by
    one worker."""
    def make():
        e, d = encoder(tokenizer), decoder(tokenizer)

        def both(texts: list) -> list:
            packed = [e.encode_packed(t) for t in texts]
            decoded = _utf8([d.decode_packed(p) for p in packed])
            if not lists:
                return [pa.array(packed, pa.binary()), decoded]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
            ids = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids), decoded]

        return both

    return _with_columns(docs, text, f"{'ids array<int>' if lists else 'ids_packed binary'}, decoded string", make)
