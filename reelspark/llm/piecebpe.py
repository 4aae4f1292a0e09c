"""SentencePiece encoding and decoding of whole texts that keeps the offsets.

Encoding has three steps. The text is normalised by the longest prefix that
the model's compiled character map holds at each place; every normalised byte
records the place in the original text that it comes from. The normalised text
is merged into pieces, the best score first and the leftmost of equals.
Every piece is then projected to the bytes of the original text through the
recorded places. Decoding gathers spellings through an offset table.

Pieces never reach over some borders: a border whose two characters no piece
holds side by side. The text is cut there, and a bounded worker cache of two
generations keeps the ids of the chunks.

The vocabulary file brings pieces, scores, character map and the rules for
spaces. Only BPE models with byte fallback and without user-defined or unused
pieces are taken; others raise ``ValueError``.

Defined results: a null or empty text has no ids, one bound (0) and decodes to
the empty text. Special strings in a text are ordinary characters. Repeated
rows are encoded each; other columns pass through, but those named like an
added one are replaced. Texts of any length are encoded whole, in a time about
linear in their length.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import _with_columns
from .bytebpe import tokenizer_path
from .common import worker_store

PIECE_BPE = "piece_bpe_32k.model"
CACHE_CHUNKS = 300_000       # chunks of each of the two generations
LONG_CHUNK = 48              # characters from which a chunk is merged with a heap
SPACE = "▁"             # stands for a space in pieces
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE_MODEL = 2


class CharMap:
    """The compiled character map: keys of a byte trie in a double array, with
    their replacements in one block of NUL-ended strings."""

    def __init__(self, compiled: bytes):
        self.to: dict[str, str] = {}
        if compiled:
            size = struct.unpack_from("<I", compiled)[0]
            self._read(np.frombuffer(compiled, "<u4", size // 4, 4), compiled[4 + size:])
        self.sizes: dict[str, list[int]] = {}
        for key in self.to:
            self.sizes.setdefault(key[0], []).append(len(key))
        for first, sizes in self.sizes.items():
            self.sizes[first] = sorted(set(sizes), reverse=True)

    def _read(self, units: np.ndarray, block: bytes) -> None:
        units = units.astype(np.int64)
        labels = units & 0x800000FF
        offsets = (units >> 10) << ((units & 0x200) >> 6)
        symbols = np.arange(1, 256)
        stack = [(0, b"")]
        while stack:
            node, key = stack.pop()
            if key and units[node] >> 8 & 1:
                at = int(units[node ^ offsets[node]] & 0x7FFFFFFF)
                self.to[key.decode()] = block[at:block.index(b"\0", at)].decode()
            children = node ^ offsets[node] ^ symbols
            inside = children < len(units)
            for c in symbols[inside][labels[children[inside]] == symbols[inside]]:
                stack.append((int(node ^ offsets[node] ^ c), key + bytes([c])))

    def longest(self, text: str, at: int) -> tuple[str, int]:
        """(replacement, characters replaced) of the longest key at a place."""
        for size in self.sizes.get(text[at], ()):
            new = self.to.get(text[at:at + size])
            if new is not None:
                return new, size
        return text[at], 1


class Normaliser:
    """Normalises texts and aligns the result with them."""

    def __init__(self, spec, as_suffix: bool = False):
        self.map = CharMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.space = SPACE if spec.escape_whitespaces else " "
        self.as_suffix = as_suffix

    def align(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the byte
        of ``text`` that it comes from (the first of a character or key)."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.map.to or self.squeeze or self.as_suffix:
            return self._align_by_prefix(text)
        raw = np.frombuffer(text.encode(), np.uint8)
        place = np.arange(len(raw))
        if not text.isascii():
            place = np.maximum.accumulate(np.where(raw & 0xC0 != 0x80, place, 0))
        if self.space != " ":
            place = np.repeat(place, np.where(raw == 0x20, len(self.space.encode()), 1))
        before = np.zeros(len(self.space.encode()) if self.dummy else 0, np.int64)
        return (self.space if self.dummy else "") + text.replace(" ", self.space), np.concatenate([before, place, [len(raw)]])

    def _align_by_prefix(self, text: str) -> tuple[str, np.ndarray]:
        out: list[str] = []
        starts: list[int] = []
        at = done = 0
        while self.squeeze and at < len(text):
            new, size = self.map.longest(text, at)
            if new != " ":
                break
            done += len(text[at:at + size].encode())
            at += size
        if at == len(text):
            return "", np.full(1, done)
        if self.dummy and not self.as_suffix:
            out.append(" ")
            starts.append(done)
        after_space = self.squeeze
        while at < len(text):
            new, size = self.map.longest(text, at)
            if after_space:
                new = new.lstrip(" ")
            if new:
                out.append(new)
                starts += [done] * len(new)
                after_space = self.squeeze and new[-1] == " "
            done += len(text[at:at + size].encode())
            at += size
        norm = "".join(out).replace(" ", self.space)
        if self.squeeze:
            kept = len(norm.rstrip(self.space))
            if kept < len(norm):
                norm, done = norm[:kept], starts[kept]
                del starts[kept:]
        if self.dummy and self.as_suffix:
            norm += self.space
            starts.append(done)
        place = np.repeat(np.array(starts, np.int64), [len(c.encode()) for c in norm])
        return norm, np.concatenate([place, [done]])


def _same_group(pieces: list[str]) -> list[str]:
    """Character classes whose members some piece holds side by side."""
    up: dict[str, str] = {}

    def find(c: str) -> str:
        while up.setdefault(c, c) != c:
            up[c] = c = up[up[c]]
        return c

    for p in pieces:
        for a, b in zip(p, p[1:]):
            if SPACE not in (a, b):
                up[find(a)] = find(b)
    groups: dict[str, list[str]] = {}
    for c in sorted(up):
        groups.setdefault(find(c), []).append(c)
    return ["".join(g) for g in sorted(groups.values(), key=len, reverse=True)]


def _replace_bytes(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


class PieceCodec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, name: str = PIECE_BPE):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(name if "/" in name else tokenizer_path(name), "rb") as f:
            model.ParseFromString(f.read())
        trainer, kinds = model.trainer_spec, {p.type for p in model.pieces}
        if trainer.model_type != BPE_MODEL or not trainer.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{name}: not a BPE model with byte fallback and without user-defined or unused pieces")
        self.normaliser = Normaliser(model.normalizer_spec, trainer.treat_whitespace_as_suffix)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.order = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        spelled = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                spelled.append(bytes([value]))
            elif p.type == UNKNOWN:
                spelled.append(trainer.unk_surface.encode())
            else:
                spelled.append(b"" if p.type == CONTROL else p.piece.replace(SPACE, " ").encode())
        self.kinds = np.array([p.type for p in model.pieces], np.int8)
        self.normal_bytes = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.strip = self.normaliser.dummy or self.normaliser.squeeze
        self.leads = np.array([p.type == NORMAL and p.piece[:1] == SPACE for p in model.pieces])
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.chunks = self._chunk_pattern([p for p in self.ids if len(p) > 1])
        self.fresh: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        codecs.register_error("piece-bytes", _replace_bytes)

    @staticmethod
    def _chunk_pattern(pieces: list[str]):
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            return None  # pieces reach over words: no cuts
        classes = "|".join(f"[{re.escape(g)}]+" for g in _same_group(pieces))
        return re.compile(f"{SPACE}*(?:{classes or '(?!)'})|{SPACE}*[^{SPACE}]|{SPACE}+", re.DOTALL)

    def _merge(self, chars: list[str]) -> list[str]:
        """Pieces of a short run of characters."""
        get, never = self.order.get, float("inf")
        cost = [get(a + b, never) for a, b in zip(chars, chars[1:])]
        while cost:
            best = min(cost)
            if best == never:
                break
            k = cost.index(best)
            chars[k:k + 2] = [chars[k] + chars[k + 1]]
            del cost[k]
            if k < len(cost):
                cost[k] = get(chars[k] + chars[k + 1], never)
            if k:
                cost[k - 1] = get(chars[k - 1] + chars[k], never)
        return chars

    def _merge_long(self, text: str) -> list[str]:
        """As ``_merge`` with a heap, for runs of any length."""
        get = self.order.get
        parts: list = list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(c, i, 2) for i in range(n - 1) if (c := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j == n or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (c := get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (c, a, len(parts[a]) + len(parts[b])))
        return [p for p in parts if p is not None]

    def _chunk_ids(self, chunk: str) -> bytes:
        one = self.ids.get(chunk) if len(chunk) == 1 else None
        if one is not None:
            return struct.pack("<i", one)
        ids: list[int] = []
        for p in self._merge(list(chunk)) if len(chunk) < LONG_CHUNK else self._merge_long(chunk):
            i = self.ids.get(p)
            if i is None:
                ids += [self.byte_ids[b] for b in p.encode()]
            else:
                ids.append(i)
        return struct.pack(f"<{len(ids)}i", *ids)

    def _normalised_ids(self, norm: str) -> np.ndarray:
        chunks = self.chunks.findall(norm) if self.chunks else [norm]
        get = self.fresh.get
        values = list(map(get, chunks))
        at = -1
        for _ in range(values.count(None)):
            at = values.index(None, at + 1)
            chunk = chunks[at]
            ids = get(chunk)
            if ids is None:
                ids = self.old.get(chunk)
                if ids is None:
                    ids = self._chunk_ids(chunk)
                if len(chunk) <= 64:
                    if len(self.fresh) >= CACHE_CHUNKS:
                        self.old, self.fresh = self.fresh, {}
                        get = self.fresh.get
                    self.fresh[chunk] = ids
            values[at] = ids
        return np.frombuffer(b"".join(values), "<i4")

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a whole text and their bounds: piece k is projected to the
        bytes from bound k to bound k + 1 of the text. All but the last byte
        of a character without a piece are empty spans."""
        norm, place = self.normaliser.align(text or "")
        ids = self._normalised_ids(norm)
        ends = np.cumsum(self.normal_bytes[ids])
        return ids, place[np.concatenate([[0], ends])].astype(np.int32)

    def decode(self, ids: np.ndarray | None) -> str:
        """Text of ids. Bytes that form no character become U+FFFD each."""
        ids = np.asarray(ids if ids is not None else [], np.int64)
        ids = ids[self.kinds[ids] != CONTROL]
        if not len(ids):
            return ""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - lengths), lengths)
        raw = self.data[place].tobytes()
        return raw[int(self.strip and self.leads[ids[0]]):].decode("utf-8", "piece-bytes")


def codec(name: str = PIECE_BPE) -> PieceCodec:
    """The worker's codec of a vocabulary file."""
    store = worker_store("piece-codecs")
    if name not in store:
        store[name] = PieceCodec(name)
    return store[name]


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, text: str = "text", model: str = PIECE_BPE) -> DataFrame:
    """``docs`` with ``ids`` and ``bounds`` of every whole text in place of it."""
    def make():
        c = codec(model)

        def run(texts: list) -> list:
            found = [c.encode(t) for t in texts]
            return [_lists([i for i, _ in found]), _lists([b for _, b in found])]

        return run

    return _with_columns(docs, text, "ids array<int>, bounds array<int>", make)


def decode(tokens: DataFrame, ids: str = "ids", model: str = PIECE_BPE) -> DataFrame:
    """``tokens`` with ``decoded``, the text of its ids, in place of them."""
    def make():
        c = codec(model)
        return lambda lists: [pa.array([c.decode(v) for v in lists], pa.string())]

    return _with_columns(tokens, ids, "decoded string", make)


def round_trip(docs: DataFrame, text: str = "text", model: str = PIECE_BPE) -> DataFrame:
    """``docs`` with ``ids``, ``bounds`` and ``decoded`` in place of the text,
    encoded and decoded again by one worker."""
    def make():
        c = codec(model)

        def both(texts: list) -> list:
            found = [c.encode(t) for t in texts]
            return [_lists([i for i, _ in found]), _lists([b for _, b in found]),
                    pa.array([c.decode(i) for i, _ in found], pa.string())]

        return both

    return _with_columns(docs, text, "ids array<int>, bounds array<int>, decoded string", make)
