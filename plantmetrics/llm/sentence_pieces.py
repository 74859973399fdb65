"""SentencePiece encoding with byte offsets, and decoding.

Normalisation walks the text by longest prefix through the model's compiled character map
(an identity map leaves characters as they are), marks spaces, and records for every
normalised byte the byte of the original it came from. The pieces tile the normalised text,
so their running lengths, looked up in that record, are spans of the original bytes.

Ids are the library's own. A BPE piece never crosses from a word into the next space mark
when no vocabulary entry does (checked on the model), so such models are encoded by the
library word by word and repeated words are looked up; any other model gets whole texts.

Defined cases: a null text is taken as empty (no tokens, decoded text empty); texts of any
length are encoded whole; each row gives one row, repeated ids and null ids included; an
empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words remembered by a task (about 100 MB); the memory starts anew when it is full.
REMEMBERED = 200_000
MARK = "▁"


class CharacterMap:
    """The compiled map: a double-array trie of UTF-8 prefixes, and their replacements."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.targets = blob[4 + size:] if size else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes matched at ``at`` by the longest known prefix, and what replaces them."""
        if not self.units:
            return None
        found, unit = None, self.units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                value = self.units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.targets[value:self.targets.index(b"\0", value)]
        return found


class Normalizer:
    """Normalised bytes with the original byte offset of each (one more for the end)."""

    def __init__(self, spec) -> None:
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.mark = MARK.encode() if self.escape else b" "

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode()
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        if not self.map.units and not self.squeeze:
            return self._identity(data)
        chars: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                width = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                found = width, data[at:at + width]
            chars += [(found[1][i:i + 1], at) for i in range(len(found[1]))]
            at += found[0]
        if self.squeeze:
            kept, space = [], True
            for c, p in chars:
                if c != b" " or not space:
                    kept.append((c, p))
                space = c == b" "
            while kept and kept[-1][0] == b" ":
                kept.pop()
            chars = kept
        if not chars:
            return b"", np.array([len(data)])
        if self.prefix:
            chars.insert(0, (b" ", chars[0][1]))
        out = [(self.mark if c == b" " else c, p) for c, p in chars]
        align = [p for c, p in out for _ in c]
        return b"".join(c for c, _ in out), np.array([*align, len(data)], dtype=np.int64)

    def _identity(self, data: bytes) -> tuple[bytes, np.ndarray]:
        raw = np.frombuffer(data, dtype=np.uint8)
        width = np.where(raw == 32, len(self.mark), 1)
        align = np.repeat(np.arange(len(raw)), width)
        lead = np.zeros(len(self.mark) if self.prefix else 0, dtype=np.int64)
        norm = (self.mark if self.prefix else b"") + data.replace(b" ", self.mark)
        return norm, np.concatenate([lead, align, [len(raw)]])


class Codec:
    """The library's encoder and decoder for one model file, with offsets."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        self.normalize = Normalizer(proto.normalizer_spec)
        #: Bytes of normalised text that a piece covers; -1 where that depends on the text.
        self.width = np.array([{6: 1, 2: -1}.get(p.type, len(p.piece.encode())) for p in proto.pieces], dtype=np.int64)
        spec = proto.normalizer_spec
        self.by_word = (proto.trainer_spec.model_type == 2 and not spec.precompiled_charsmap and spec.add_dummy_prefix
                        and spec.escape_whitespaces and not spec.remove_extra_whitespaces
                        and not proto.trainer_spec.treat_whitespace_as_suffix
                        and not any(MARK in p.piece.lstrip(MARK) or p.type == 4 for p in proto.pieces))
        self.single_space = [self.sp.piece_to_id(MARK)]
        self.known: dict[str, list[int]] = {}
        self._words = re.compile(" +[^ ]*")

    def encode(self, text: str) -> list[int]:
        if not self.by_word or not text:
            return self.sp.encode(text, num_threads=1)
        words = self._words.findall(" " + text)
        known = self.known
        missing = list({w for w in words if w not in known})
        if missing:
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
                missing = list(set(words))
            # the library adds the first space itself
            known.update(zip(missing, self.sp.encode([w[1:] for w in missing], num_threads=1), strict=True))
            if " " in known:
                known[" "] = self.single_space
        return list(chain.from_iterable(map(known.__getitem__, words)))

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Start and end byte of every piece in the original text."""
        norm, align = self.normalize(text)
        width = self.width[np.asarray(ids, dtype=np.int64)]
        if (width < 0).any():
            width = self._unknown(norm, ids, width)
        stop = np.cumsum(width)
        if (stop[-1] if len(stop) else 0) != len(norm):
            raise ValueError("the pieces do not tile the normalised text")
        # a piece ends where the byte after its last normalised byte's source character begins
        return align[stop - width], align[stop]

    def _unknown(self, norm: bytes, ids: list[int], width: np.ndarray) -> np.ndarray:
        """An unknown piece covers the text up to the next known piece."""
        pieces = [self.sp.id_to_piece(i).encode() if w >= 0 else None for i, w in zip(ids, width, strict=True)]
        at, out = 0, width.copy()
        for k, p in enumerate(pieces):
            if p is None:
                follow = next((q for q in pieces[k + 1:] if q is not None), None)
                out[k] = (norm.index(follow, at + 1) if follow else len(norm)) - at
            at += int(out[k])
        return out


def _encode(docs: DataFrame, model_file: str, columns: dict[str, tuple[str, pa.DataType]], row, text: str, key: str) -> DataFrame:
    types = list(columns.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_file)
        for b in batches:
            for first in range(0, b.num_rows, 256):
                part = b.slice(first, 256)
                rows = [row(codec, t.as_py() or "") for t in part.column(1)]
                cols = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)]
                yield pa.record_batch([part.column(0).cast(pa.int64()), *cols], names=["doc_id", *columns])

    schema = "doc_id long, " + ", ".join(f"{c} {t}" for c, (t, _) in columns.items())
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def encode(docs: DataFrame, model_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``ids``, ``starts`` and ``ends`` (original bytes of each piece), ``decoded``."""
    ints = ("array<int>", pa.list_(pa.int32()))

    def row(codec: Codec, t: str) -> tuple:
        ids = codec.encode(t)
        starts, ends = codec.spans(t, ids)
        return ids, starts, ends, codec.sp.decode(ids) if ids else ""

    return _encode(docs, model_file, {"ids": ints, "starts": ints, "ends": ints, "decoded": ("string", pa.string())},
                   row, text, key)


def digests(docs: DataFrame, model_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """What ``encode`` returns, as digests: ``n_tokens``, ``ids_sha256`` (decimal ids joined by
    commas), ``decoded_sha256`` and ``spans_sha256`` (little-endian 32-bit starts, then ends)."""
    text_type = ("string", pa.string())

    def row(codec: Codec, t: str) -> tuple:
        ids = codec.encode(t)
        starts, ends = codec.spans(t, ids)
        decoded = codec.sp.decode(ids) if ids else ""
        spans = starts.astype("<i4").tobytes() + ends.astype("<i4").tobytes()
        hexes = [hashlib.sha256(x).hexdigest() for x in (str(ids)[1:-1].replace(" ", "").encode(), decoded.encode(), spans)]
        return len(ids), *hexes

    return _encode(docs, model_file, {"n_tokens": ("long", pa.int64()), "ids_sha256": text_type,
                                      "decoded_sha256": text_type, "spans_sha256": text_type}, row, text, key)
