"""Byte-level BPE of whole texts through a cache of text chunks.

The pre-tokeniser of byte_bpe_50k.json never joins a character with a space
after it unless both neighbours of that space are white space. So a text may be cut
before every space that has a non-space on either side, and each chunk is encoded on its
own with the same ids as in the whole text. A line feed between two characters
that are not white space is a pre-token of its own, so lines are cut there too.
Most chunks repeat; a bounded worker cache of two generations holds their ids
and the tokenizers library encodes the rest. ``encode`` looks up every chunk;
``encode_lists`` has Arrow cut and number the chunks of a run of rows, looks
up the distinct ones and puts the id lists together by number.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import slices, worker_store

BYTE_BPE = "byte_bpe_50k.json"
LARGE_TEXT = 1 << 28        # bytes of a run from which Arrow gets 64-bit offsets, as cutting adds marks
_CUT = re.compile(r"(?<=\S) | (?=\S)")
# U+180E was white space in older Unicode versions.
_LINE = re.compile("(?<=[^\\s\u180e])\n(?=[^\\s\u180e])")
# Fixed values of the vocabulary file's format: characters for bytes that do
# not print (the others stand for themselves), and the one for a space.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_SPACE = _BYTE_CHARS[0x20]
_SPACES = "\u180e" + "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_MARKED_WORD = f"^\\x00?[{_LETTERS}]+[{re.escape(_MARKS)}]+$"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on the machine that calls it."""
    import public_tokenizers
    return public_tokenizers.path(name)


def load_tokenizer(name: str):
    """The tokenizer without padding or truncation, once per worker process."""
    store = worker_store("tokenizers")
    if name not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(name if "/" in name else tokenizer_path(name))
        t.no_padding()
        t.no_truncation()
        store[name] = t
    return store[name]


def _chunks(text: str) -> list[str]:
    """Chunks of one text. A chunk after a space is given without that space;
    one that holds its own spaces or begins the text has a NUL mark instead.
    A text that holds NULs is one chunk."""
    if "\0" in text:
        return ["\0" + text]
    if "\n" in text:
        lines = _LINE.split(text)
        if len(lines) > 1:
            out = _chunks(lines[0])
            for line in lines[1:]:
                out.append("\0\n")
                out += _chunks(line)
            return out
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _careful_chunks(text)
    parts = text.split(" ")
    parts[0] = "\0" + parts[0]
    return parts


def _careful_chunks(text: str) -> list[str]:
    """As ``_chunks``, for texts in which white space stands beside a space."""
    if "\0" in text:
        return ["\0" + text]
    cuts = [m.start() for m in _CUT.finditer(text)]
    parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)]) if a < b]
    return [p[1:] if p[0] == " " and len(p) > 1 and not p[1].isspace() else "\0" + p for p in parts]


def _uncertain(chunks: pa.Array) -> np.ndarray:
    """Whether a cut at every space and line feed may have been wrong beside
    a chunk: it is empty, or begins or ends with white space."""
    bare = pc.utf8_ltrim(chunks, "\0")
    wrong = pc.or_(pc.equal(bare, ""), pc.not_equal(bare, pc.utf8_trim(bare, _SPACES)))
    return pc.and_(wrong, pc.not_equal(chunks, "\0\n")).to_numpy(zero_copy_only=False)


class ChunkCoder:
    """Maps texts to one value per chunk: ``value(ids)`` of the chunk's ids,
    where the value of joined ids is the sum (+) of their values.

    ``known`` (chunk -> value) is the first tier. Misses are encoded and kept
    in a worker cache of chunks of at most 64 characters, ``cache_entries`` in
    each of two generations; ``known`` is in the young one.
    """

    def __init__(self, name, value, store, known=None, cache_entries=300_000):
        self.tok = load_tokenizer(name)
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = special
        self.cut = re.compile("(" + "|".join(sorted(map(re.escape, special), key=len, reverse=True)) + ")") if special else None
        self.marks: dict = {"": None}
        self.value = value
        self.known = known or {}
        generations = worker_store(store)
        self.young = generations.setdefault("young", {})
        self.old = generations.setdefault("old", {})
        self.generations = generations
        self.young.update(self.known)
        self.cache_entries = cache_entries + len(self.known)

    def encode_chunks(self, chunks: list[str]) -> list:
        """Values of chunks, from the tokenizers library.

        A run of letters after a space or at a line's begin is one pre-token and
        goes straight to the library's model; so is a run of ASCII marks (but
        ``'``) after it. Other chunks, and letters that a Unicode version may
        class anew (U+0250 and above), go through the whole library.
        """
        out, words = self._encode_chunks(chunks)
        self.keep(words)
        return out

    def _encode_chunks(self, chunks: list[str]) -> tuple[list, dict]:
        """As ``encode_chunks``, with the words' values, not kept yet."""
        out: list = [None] * len(chunks)
        rest = []
        tokenize, value, marks, young = self.tok.model.tokenize, self.value, self.marks, self.young.get
        words: dict = {}
        for k, c in enumerate(chunks):
            word = c.rstrip(_MARKS)
            bare = word[1:] if word[:1] == "\0" else word  # begins a line: without the space
            if bare.isalpha() and (bare.isascii() or max(bare) < "\u0250"):
                got = words.get(word)
                if got is None and len(word) < len(c):
                    got = young(word)
                if got is None:
                    plain = bare if bare.isascii() else bare.encode().decode("latin-1").translate(_BYTE_CHARS)
                    got = words[word] = value([t.id for t in tokenize(plain if bare is not word else _SPACE + plain)])
                if len(word) < len(c):
                    run = c[len(word):]
                    mark = marks.get(run)
                    if mark is None:
                        mark = value([t.id for t in tokenize(run)])
                        if len(marks) < 10_000 and len(run) <= 64:
                            marks[run] = mark
                    got = got + mark
                out[k] = got
            else:
                rest.append(k)
        texts = [chunks[k][1:] if chunks[k][0] == "\0" else " " + chunks[k] for k in rest]
        for k, e in zip(rest, self.tok.encode_batch_fast(texts, add_special_tokens=False)):
            out[k] = self.value(e.ids)
        return out, words

    def _flat_chunks(self, text: str, chunks=_chunks) -> list[str]:
        """Chunks of a whole text; the library cuts at special tokens first."""
        if not text:
            return []
        if not any(s in text for s in self.special):
            return chunks(text)
        return [c for k, part in enumerate(self.cut.split(text)) if part
                for c in (["\0" + part] if k % 2 else chunks(part))]

    def keep(self, values: dict) -> None:
        """Put values into the young generation, which turns old when full."""
        if len(self.young) + len(values) > self.cache_entries:
            self.old = self.generations["old"] = self.young
            self.young = self.generations["young"] = dict(self.known)
        self.young.update((c, v) for c, v in values.items() if len(c) <= 64)

    def encode(self, texts: list):
        """Yield for every text (None: empty) the list of its chunks' values."""
        for run in slices(texts, 1 << 20):
            get = self.young.get
            rows, misses = [], set()
            for text in run:
                parts = self._flat_chunks(text)
                values = list(map(get, parts))
                gaps = [i for i, v in enumerate(values) if v is None]
                lacking = [parts[i] for i in gaps]
                misses.update(lacking)
                rows.append((values, gaps, lacking))
            spaced = {c for c in misses if c[0].isspace()}
            if spaced:
                misses -= spaced
                for k, (_, _, lacking) in enumerate(rows):
                    if not spaced.isdisjoint(lacking):
                        parts = self._flat_chunks(run[k], _careful_chunks)
                        values = list(map(get, parts))
                        gaps = [i for i, v in enumerate(values) if v is None]
                        lacking = [parts[i] for i in gaps]
                        misses.update(lacking)
                        rows[k] = (values, gaps, lacking)
            again = self.old.get
            fresh = {c: v for c in misses if (v := again(c)) is not None}
            wanted = [c for c in misses if c not in fresh]
            for at in range(0, len(wanted), 20_000):
                fresh.update(zip(wanted[at:at + 20_000], self.encode_chunks(wanted[at:at + 20_000])))
            for values, gaps, lacking in rows:
                for i, c in zip(gaps, lacking):
                    values[i] = fresh[c]
                yield values
            self.keep(fresh)

    def numbered_chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Chunks of texts (null: empty) by number: the end of each text's
        numbers, the numbers of all texts, and the distinct chunks.

        Arrow cuts at every space and line feed. Texts in which that may be
        wrong, and those that hold NULs or special tokens, are cut one by one.
        """
        kind = pa.large_string() if texts.nbytes > LARGE_TEXT else pa.string()
        texts = texts.cast(kind).fill_null("")
        lines = pc.replace_substring(texts, "\n", " \0\n \0")
        lists = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\0", kind), lines, pa.scalar("", kind)), " ")
        coded = lists.flatten().dictionary_encode()
        ends = lists.offsets.to_numpy()[1:]
        odd = np.zeros(len(texts), bool)
        for s in ("\0", *self.special):
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        uncertain = _uncertain(coded.dictionary)
        if uncertain.any():
            odd[np.searchsorted(ends, np.flatnonzero(uncertain[coded.indices.to_numpy()]), "right")] = True
        if odd.any():
            rows = np.flatnonzero(odd)
            order = np.arange(len(texts))
            order[rows] = len(texts) + np.arange(len(rows))
            careful = [pa.array([self._certain_chunks(texts[k].as_py())], lists.type) for k in rows]
            lists = pa.concat_arrays([lists, *careful]).take(pa.array(order))
            coded = lists.flatten().dictionary_encode()
            ends = lists.offsets.to_numpy()[1:]
        return ends, coded.indices.to_numpy(), coded.dictionary

    def _certain_chunks(self, text: str) -> list[str]:
        parts = self._flat_chunks(text)
        return self._flat_chunks(text, _careful_chunks) if any(c[0].isspace() for c in parts) else parts

    def values(self, chunks: list[str]) -> list:
        """Values of distinct chunks, from the cache or the library."""
        out = list(map(self.young.get, chunks))
        gaps = [k for k, v in enumerate(out) if v is None]
        names = [chunks[k] for k in gaps]
        got = list(map(self.old.get, names))
        wanted = [i for i, v in enumerate(got) if v is None]
        for at in range(0, len(wanted), 20_000):
            part = wanted[at:at + 20_000]
            for i, v in zip(part, self._encode_chunks([names[i] for i in part])[0]):
                got[i] = v
        for k, v in zip(gaps, got):
            out[k] = v
        self.keep(dict(zip(names, got)))
        return out

    def chunk_lists(self, chunks: pa.Array) -> pa.ListArray:
        """Lists of the distinct chunks' ids. Letters and the marks after them
        are looked up apart, as ``encode_chunks`` encodes them."""
        marked = pc.match_substring_regex(chunks, _MARKED_WORD)
        words = pc.if_else(marked, pc.utf8_rtrim(chunks, _MARKS), chunks).dictionary_encode()
        runs = pc.if_else(marked, pc.utf8_ltrim(chunks, "\0" + _LETTERS), pa.scalar("", chunks.type))
        marks = pc.binary_join_element_wise(pa.scalar("\0", chunks.type), runs, pa.scalar("", chunks.type)).dictionary_encode()
        known = _packed_lists([v for d in (words, marks) for v in self.values(d.dictionary.to_numpy(zero_copy_only=False).tolist())])
        parts = np.stack((words.indices.to_numpy(), marks.indices.to_numpy() + len(words.dictionary)), axis=1).ravel()
        both = known.take(pa.array(parts))
        return _lists(both.offsets.to_numpy()[2::2], both.flatten())

    def encode_lists(self, texts: pa.Array, end: bytes, run_bytes: int = 8 << 20) -> Iterator[pa.ListArray]:
        """Lists of the texts' ids and the packed ``end``, for runs of rows in
        order; the coder's values must be ids packed as 32-bit integers.

        A run's distinct chunks are looked up once; Arrow puts them together.
        """
        n_bytes = pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(n_bytes) // run_bytes)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(texts)]):
            if a == z:
                continue
            ends, numbers, chunks = self.numbered_chunks(texts.slice(a, z - a))
            known = pa.concat_arrays([self.chunk_lists(chunks), _packed_lists([end])])
            ids = known.take(pa.array(np.insert(numbers, ends, len(chunks))))
            yield _lists(ids.offsets.to_numpy()[ends + np.arange(1, len(ends) + 1)], ids.flatten())


def _lists(ends: np.ndarray, items: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), items)


def _packed_lists(values: list[bytes]) -> pa.ListArray:
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    return _lists(np.cumsum(sizes), pa.array(np.frombuffer(b"".join(values), "<i4")))
