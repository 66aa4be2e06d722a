"""SentencePiece encoding and decoding with offsets into the original bytes.

The model's normaliser runs here, not in the library: at each position the longest prefix
found in the compiled character map (a double-array trie in the model file) is replaced,
other characters stay, spaces become U+2581, and every byte of the normalised text keeps
the offset of the source byte it came from. The library's model, with its own normaliser
switched off, then segments the normalised text, and the summed byte lengths of the pieces
index the alignment: each piece has a span of original bytes.

Where no piece of the vocabulary holds U+2581 after another character (checked when the
model is opened), a piece cannot cross the start of a run of U+2581. Texts are then
segmented run by run and equal runs are segmented once per worker, in a bounded memory.

Defined results: null is the empty text, which gives the begin and end ids only; texts are
never cut; rows that repeat are encoded alike; an empty table gives an empty table; other
columns pass through in a struct.
"""

from __future__ import annotations

import codecs
import functools
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_format

from panelloom.llm.common import release, text_runs

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MEMO_RUNS, MEMO_CHARS, SLICE_BYTES = 100_000, 64, 1 << 20
RUN = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
RESULT = (
    "ids BINARY, begins BINARY, ends BINARY, decoded STRING, n_tokens BIGINT, span_bytes BIGINT"
)

codecs.register_error("each-byte", lambda error: ("�", error.start + 1))


class CharacterMap:
    """The compiled map: a double array of 32-bit units, then NUL-ended replacements."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest prefix at ``at`` and its replacement; length 0: none."""
        units, found = self.units, (0, b"")
        if not units:
            return found
        shift = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node = shift(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= shift(unit)
            if unit >> 8 & 1:
                begin = units[node] & 0x7FFFFFFF
                found = (i + 1 - at, self.replacements[begin : self.replacements.index(0, begin)])
        return found


class Codec:
    """A model's normaliser, segmenter and decoder."""

    def __init__(self, path: str) -> None:
        proto = model_format.ModelProto()
        with open(path, "rb") as source:
            proto.ParseFromString(source.read())
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        self.space = SPACE.encode() if spec.escape_whitespaces else b" "
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models that mark spaces behind words are not supported")
        spec.precompiled_charsmap = b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        spec.escape_whitespaces = False
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.begin, self.end = self.segmenter.bos_id(), self.segmenter.eos_id()
        self.kinds = [piece.type for piece in proto.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        # Bytes per id in the normalised text; an unknown piece's length comes from the text.
        self.sizes = np.array(
            [1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces], np.uint32
        )
        surface = proto.trainer_spec.unk_surface.encode()
        self.surfaces = [
            bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
            else b"" if p.type == CONTROL
            else surface if p.type == UNKNOWN
            else p.piece.replace(SPACE, " ").encode()
            for p in proto.pieces
        ]
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        self.cuts = not any(crossing.search(p.piece) for p in proto.pieces)
        self.byte_fallback = proto.trainer_spec.byte_fallback
        # Two generations: runs in use move to the newer one before the older is dropped.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, for each of them and the end, its source byte offset."""
        source = text.encode("utf-8")
        if not self.map.units and not self.squeeze and b"\0" not in source:
            return self._plain(source)
        return self._mapped(source)

    def _plain(self, source: bytes) -> tuple[bytes, np.ndarray]:
        head = self.space if self.prefix and source else b""
        raw = np.frombuffer(source, np.uint8)
        width = np.where(raw == 32, len(self.space), 1)
        align = np.zeros(len(head) + int(width.sum()) + 1, np.int64)
        align[len(head) : -1] = np.repeat(np.arange(len(raw)), width)
        align[-1] = len(raw)
        return head + source.replace(b" ", self.space), align

    def _mapped(self, source: bytes) -> tuple[bytes, np.ndarray]:
        parts: list[tuple[bytes, int, int]] = []
        at = 0
        while at < len(source):
            length, new = self.map.longest(source, at)
            if not length:
                length = 1
                while at + length < len(source) and source[at + length] & 0xC0 == 0x80:
                    length += 1
                new = source[at : at + length]
            parts.append((new, at, at + length))
            at += length
        out, align = bytearray(), []
        end = len(source)
        if self.squeeze:
            while parts and parts[0][0] == b" ":
                parts.pop(0)
        if self.prefix and parts:
            out += self.space
            align += [parts[0][1]] * len(self.space)
        open_space = self.squeeze
        for new, low, high in parts:
            if self.squeeze and open_space:
                new = new.lstrip(b" ")
            same = new == source[low:high]
            for i, byte in enumerate(new):
                piece = self.space if byte == 32 else bytes([byte])
                out += piece
                align += [low + i if same else low] * len(piece)
            if new:
                open_space = self.squeeze and new.endswith(b" ")
        if self.squeeze:
            while out.endswith(self.space):
                del out[-len(self.space) :]
                end = align[len(out)]
                del align[len(out) :]
        return bytes(out), np.array([*align, end], np.int64)

    def _segment(self, runs: list[str]) -> dict[str, bytes]:
        """(id, byte length) pairs of each run, as packed 32-bit integers."""
        lists = self.segmenter.encode(runs, num_threads=1)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        pairs = np.empty((int(counts.sum()), 2), np.uint32)
        pairs[:, 0] = np.fromiter(chain.from_iterable(lists), np.uint32, len(pairs))
        pairs[:, 1] = self.sizes[pairs[:, 0]]
        if not self.byte_fallback and (pairs[:, 0] == self.unknown).any():
            strings = chain.from_iterable(self.segmenter.encode(runs, out_type=str))
            pairs[:, 1] = [len(piece.encode()) for piece in strings]
        packed = pairs.tobytes()
        stops = (8 * np.cumsum(counts)).tolist()
        return {
            run: packed[low:high]
            for run, low, high in zip(runs, [0, *stops], stops, strict=False)
        }

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids with begin and end, and the begin and end byte of every piece's span."""
        normal = [self.normalise(text) for text in texts]
        strings = [raw.decode("utf-8") for raw, _ in normal]
        cut = [RUN.findall(s) if self.cuts else [s] if s else [] for s in strings]
        if len(self.memo) > MEMO_RUNS:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        wanted = {run for runs in cut for run in runs} - memo.keys()
        known = wanted & older.keys()
        memo.update((run, older[run]) for run in known)
        memo.update(self._segment(list(wanted - known)))
        long_runs = [run for run in wanted if len(run) > MEMO_CHARS]
        for runs, (_, align) in zip(cut, normal, strict=True):
            pairs = np.frombuffer(b"".join(map(memo.__getitem__, runs)), "<u4").reshape(-1, 2)
            stops = np.cumsum(pairs[:, 1], dtype=np.int64)
            ids = np.empty(len(pairs) + 2, np.uint32)
            ids[0], ids[1:-1], ids[-1] = self.begin, pairs[:, 0], self.end
            begins, ends = np.zeros(len(ids), np.uint32), np.full(len(ids), align[-1], np.uint32)
            begins[1:-1], ends[1:-1] = align[stops - pairs[:, 1]], align[stops]
            ends[0], begins[-1] = 0, align[-1]
            yield ids, begins, ends
        for run in long_runs:
            del memo[run]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, as the library's decoder gives it."""
        raw = b"".join(map(self.surfaces.__getitem__, ids))
        if self.prefix or self.squeeze:
            first = next((i for i in ids if self.kinds[i] != CONTROL), None)
            if first is not None and self.kinds[first] == NORMAL and raw[:1] == b" ":
                raw = raw.lstrip(b" ") if self.squeeze else raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return raw.decode("utf-8", "each-byte")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and model file."""
    return Codec(path)


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Rows as ``_doc`` (all columns but the text) with ``ids``, ``begins`` and ``ends`` (packed
    little-endian unsigned 32-bit integers, one per piece), ``decoded``, ``n_tokens`` and
    ``span_bytes``, the original bytes that the spans cover. ``model_path`` must be readable
    on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_path)
        for batch in batches:
            for low, high, texts in text_runs(batch.column("_text"), SLICE_BYTES):
                rows = []
                for ids, begins, ends in coder.encode(texts):
                    covered = int((ends.astype(np.int64) - begins).sum())
                    rows.append(
                        (
                            ids.astype("<u4").tobytes(), begins.astype("<u4").tobytes(),
                            ends.astype("<u4").tobytes(), coder.decode(ids.tolist()), len(ids),
                            covered,
                        )
                    )
                kinds = [pa.binary(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
                columns = [
                    pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)
                ]
                names = [part.split()[0] for part in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_doc").slice(low, high - low), *columns], ["_doc", *names]
                )
        release()

    others = [F.col(f"`{name}`") for name in docs.columns if name != text_col]
    others = others or [F.lit(None).cast("int").alias("nothing")]
    rows = docs.select(F.struct(*others).alias("_doc"), F.col(text_col).alias("_text"))
    kind = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"_doc {kind}, {RESULT}")


